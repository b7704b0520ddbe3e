"""Language of a text by rank-order profiles of character n-grams and the out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadfeat.llm.quality import held_out

#: Most frequent n-grams of a language and of a document that are compared.
PROFILE = 400
#: Divides the share of the largest distance in the score.
SHARPNESS = 20.0
#: Characters of a text that are counted at once.
CHARS_AT_ONCE = 1 << 18
#: Counts that a task holds for all languages before it adds up equal n-grams, and before it passes them on.
HELD, PASSED_ON = 1 << 20, 1 << 19

_GAP = ord("_")
#: Bits of a code point; an n-gram's code holds those of up to three.
_BITS = 21
#: Different letters in a text up to which its n-grams are counted in a dense table.
_DENSE = 64


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _spelled(text: str) -> np.ndarray:
    """Code points of a lower-cased text with one gap before, between and after its words (runs of letters)."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    points = np.where(letter, points, _GAP)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = letter[0]
    out = np.concatenate([[_GAP], points[keep]])
    return out if out[-1] == _GAP else np.append(out, _GAP)


def code_of(gram: str) -> int:
    """An n-gram as a number; longer ones have larger numbers."""
    code = 0
    for c in gram:
        code = code << _BITS | ord(c)
    return code


def added(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal codes added up, in ascending order."""
    out, at = np.unique(codes, return_inverse=True)
    return out, np.bincount(at, counts, len(out)).astype(np.int64)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes, ascending, and counts of the 1- to 3-grams of a whole text's words, each word padded by a gap on both sides."""
    spelled = _spelled(text)
    if len(spelled) <= CHARS_AT_ONCE:
        return _counted(spelled)
    parts, at = [], 0
    while at < len(spelled) - 1:
        # Cut at a gap, which then ends one part and begins the next.
        gaps = np.flatnonzero(spelled[at + CHARS_AT_ONCE :] == _GAP)
        end = at + CHARS_AT_ONCE + gaps[0] if len(gaps) else len(spelled) - 1
        parts.append(_counted(spelled[at : end + 1]))
        at = end
    return added(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _counted(spelled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(spelled):
        return spelled, spelled
    symbols, x = np.unique(spelled, return_inverse=True)
    gap, k = int(np.searchsorted(symbols, _GAP)), len(symbols)
    inner = x[1:-1] != gap
    singles, pairs, triples = x[x != gap], x[:-1] * k + x[1:], (x[:-2] * k + x[1:-1])[inner] * k + x[2:][inner]
    if k <= _DENSE:
        tables = [np.bincount(v) for v in (singles, pairs, triples)]
        found = [np.flatnonzero(t) for t in tables]
        counts = np.concatenate([t[f] for t, f in zip(tables, found, strict=True)])
    else:
        unique = [np.unique(v, return_counts=True) for v in (singles, pairs, triples)]
        found, counts = [u[0] for u in unique], np.concatenate([u[1] for u in unique])
    one, two, three = found
    two_code = symbols[two // k] << _BITS | symbols[two % k]
    head = three // k
    three_code = (symbols[head // k] << _BITS | symbols[head % k]) << _BITS | symbols[three % k]
    return np.concatenate([symbols[one], two_code, three_code]), counts


class Profiles:
    """Ranks of the profiles' n-grams, by language."""

    def __init__(self, profiles: dict[str, dict[int, int]]):
        self.names = list(profiles)
        self.codes = np.array(sorted({c for p in profiles.values() for c in p}), np.int64)
        self.ranks = np.array([[p.get(c, PROFILE) for c in self.codes.tolist()] for p in profiles.values()], np.int64)

    def distances(self, text: str) -> tuple[np.ndarray, int]:
        """Out-of-place distance to every profile, and the number of n-grams compared: the text's most frequent, ties by code."""
        codes, counts = grams(text)
        top = codes[np.argsort(-counts, kind="stable")[:PROFILE]]
        if not len(self.codes) or not len(top):
            return np.zeros(len(self.names)), 0
        at = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        ranks = np.where(self.codes[at] == top, self.ranks[:, at], PROFILE)
        return np.where(ranks < PROFILE, np.abs(ranks - np.arange(len(top))), PROFILE).sum(axis=1), len(top)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def rows(lang: str, sums: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(sums[0]), pa.string()), *map(pa.array, sums)], ["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
            found = grams(text.as_py())
            held.setdefault(lang, []).append(found)
            size += len(found[0])
            if size > HELD:
                sums = {x: added(*(np.concatenate(c) for c in zip(*parts, strict=True))) for x, parts in held.items()}
                size = sum(len(s[0]) for s in sums.values())
                held = {x: [s] for x, s in sums.items()}
                if size > PASSED_ON:
                    yield from (rows(x, s) for x, s in sums.items())
                    held, size = {}, 0
    for lang, parts in held.items():
        yield rows(lang, added(*(np.concatenate(c) for c in zip(*parts, strict=True))))


def language_profiles(docs: DataFrame) -> dict[str, dict[int, int]]:
    """Ranks of each language's most frequent n-grams, by code, from all rows with text and lang. One short list a language."""
    known = docs.where("text is not null and lang is not null").select("lang", "text")
    sums = known.mapInArrow(_learn, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # A plain bound on row_number lets Spark keep the first of each task before it shuffles.
    ranked = sums.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PROFILE)
    profiles: dict[str, dict[int, int]] = {}
    for r in ranked.collect():
        profiles.setdefault(r.lang, {})[r.gram] = r.place - 1
    return dict(sorted(profiles.items()))


def predict_language(docs: DataFrame, profiles: dict[str, dict[int, int]]) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row, from its text alone.

    The language with the smallest out-of-place distance, the first by name on ties; the score weighs the
    distances of all languages. Texts without a letter, null texts, and all texts if nothing was learned are ``und``, 0.
    Repeated rows are predicted each; a text counts whole, however long, in pieces that share no n-gram; further
    columns don't matter, whatever their names; no rows give no rows.
    """
    known = Profiles(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text in batch["text"]:
                distance, n = known.distances(text.as_py() or "")
                if n:
                    weight = np.exp(-SHARPNESS * (distance - distance.min()) / (n * PROFILE))
                    langs.append(known.names[int(distance.argmin())])
                    scores.append(float(weight.max() / weight.sum()))
                else:
                    langs.append("und")
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return base.mapInArrow(run, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``; profiles learn only from rows that are not held out."""
    predicted = predict_language(docs, language_profiles(docs.where(~held_out())))
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
