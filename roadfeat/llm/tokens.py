"""Token ids of whole texts by a public tokenizer file, with a bounded memory of words seen before."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from itertools import compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roadfeat.llm.shared import give_back

#: Bytes that a worker's memory of words may take (of those that follow a blank, and of others; the larger one where blanks are dropped);
#: most words of a corpus are met once. Memory and time only, results do not depend on them.
REMEMBERED_BYTES = (176 << 20, 112 << 20)
#: Bytes of a remembered word beside its own, and of its place in the table.
WORD_BYTES = 220
#: Longest word in bytes that is remembered, characters of texts that are split at once, and new words of one encoding call.
LONGEST_WORD, AT_ONCE, ENCODED = 64, 8 << 20, 2_000


class _Words:
    """Ids of words as bytes, each asked for once for many texts.

    They are remembered in two tables: a word that only the older one has moves to the newer, which takes the older one's place when
    it is full. So words that are met once are forgotten.
    """

    def __init__(self, encode, dtype: np.dtype, memory: slice, mark: str, prefix: str = ""):
        self.encode, self.dtype, self.memory, self.mark, self.prefix = encode, dtype, memory, mark, prefix
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        (self.mark_id,) = encode(mark)

    def __call__(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of distinct words; None for those that are no words by themselves."""
        if 2 * len(self.newer) * WORD_BYTES > max(REMEMBERED_BYTES[self.memory]):
            self.newer, self.older = {}, self.newer
        found = list(map(self.newer.get, words))
        missing = list(compress(range(len(found)), map(is_, found, repeat(None))))
        known = self._learn([words[at] for at in missing])
        for at in missing:
            found[at] = known.get(words[at])
        return found

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words that the newer table lacks, where those that are not too long are added."""
        met = list(map(self.older.get, words))
        known = self._new([w for w, ids in zip(words, met, strict=True) if ids is None])
        known.update((w, ids) for w, ids in zip(words, met, strict=True) if ids is not None)
        self.newer.update((w, ids) for w, ids in known.items() if len(w) <= LONGEST_WORD)
        return known

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        raise NotImplementedError

    def _marked(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of words that were encoded with a mark between them."""
        ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
        return np.append(0, ends[:-1] + 1), ends

    def _together(self, words: list[bytes], between: str, cut) -> dict[bytes, bytes]:
        """Encode many words in one text, whose ids ``cut`` parts again; words of a text that it can't part are encoded one by one."""
        size, known = self.dtype.itemsize, {}
        for first in range(0, len(words), ENCODED):
            some = words[first : first + ENCODED]
            text = self.prefix + (between + self.prefix).encode().join(some).decode()
            ids = np.array(self.encode(text), self.dtype)
            starts, ends = cut(ids)
            if len(ends) == len(some):
                parts = map(slice, (starts * size).tolist(), (ends * size).tolist())
                known.update(zip(some, map(ids.tobytes().__getitem__, parts), strict=True))
            else:
                known.update((w, self._alone(w)) for w in some)
        return known

    def _alone(self, word: bytes) -> bytes:
        return np.array(self.encode(self.prefix + word.decode()), self.dtype).tobytes()


class _SpacedWords(_Words):
    """Words of a tokenizer that joins a blank to the word after it, which is ``prefix``, or words without one.

    ``opening`` tells the ids that start with a blank: a word has one at its start alone, so words with ``prefix`` need no mark.
    """

    def __init__(self, encode, dtype: np.dtype, prefix: str, opening: np.ndarray):
        super().__init__(encode, dtype, slice(0, 1) if prefix else slice(1, 2), "\n", prefix)
        self.opening = opening

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        # White space at an end would meet the blanks around the word.
        plain = [w for w in words if w.isalpha() or (w and not ((t := w.decode())[0].isspace() or t[-1].isspace()))]
        return self._together(plain, "", self._opened) if self.prefix else self._together(plain, self.mark, self._marked)

    def _opened(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(self.opening[ids])
        return starts, np.append(starts[1:], len(ids))


class _BareWords(_Words):
    """Lower-cased words for tokenizers that drop white space; ``closing`` tells the ids that end a word, if any do."""

    def __init__(self, encode, dtype: np.dtype, closing: np.ndarray):
        super().__init__(encode, dtype, slice(None), " ~ ")
        self.closing = closing

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        letters = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        mark = self.mark.strip().encode()
        others = [w for w in rest if w and mark not in w]
        known = {w: self._alone(w) if w else b"" for w in rest if not w or mark in w}
        # Without closing tokens, words of letters need the mark too.
        if len(self.closing):
            known |= self._together(letters, " ", self._closed)
        else:
            others += letters
        return known | self._together(others, self.mark, self._marked)

    def _closed(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.flatnonzero(self.closing[ids]) + 1
        return np.append(0, ends[:-1]), ends


class Encoder:
    """Little-endian ids of whole texts, equal to the tokenizer's own ``encode`` without special tokens added.

    Both vocabularies split a text at white space before they merge: ``byte_bpe`` joins a single blank to
    the word after it, ``word_bpe`` drops white space. So the ids of a text are those of its words in a
    row. Arrow splits many texts and numbers their distinct words, each of which is looked up once; the tokenizer encodes it once and it is
    remembered. Texts in which a blank or line feed is
    beside other white space or at an end are encoded as a whole by ``byte_bpe``, where runs of
    white space are tokens. ``tests/llm/test_tokens.py`` compares both ways.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.line_feed = self.whole("\n")
        self.drops_space = not self.line_feed
        if self.drops_space:
            suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
            closing = self._ids_where(lambda token: token.endswith(suffix)) if suffix else np.zeros(0, bool)
            self.words = _BareWords(self.ids, self.dtype, closing)
            # Written with A-Z, these are no tokens of their own, but would be when lower-cased.
            self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        else:
            (blank,) = self.ids(" ")
            blank = self.tokenizer.id_to_token(blank)
            opening = self._ids_where(lambda token: token.startswith(blank))
            self.bare, self.spaced = (_SpacedWords(self.ids, self.dtype, prefix, opening) for prefix in ("", " "))

    def _ids_where(self, holds) -> np.ndarray:
        """Which ids belong to tokens for which ``holds``."""
        marks = np.zeros(self.tokenizer.get_vocab_size(), bool)
        marks[[i for token, i in self.tokenizer.get_vocab().items() if holds(token)]] = True
        return marks

    def ids(self, text: str) -> list[int]:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return found.ids

    def whole(self, text: str) -> bytes:
        return np.array(self.ids(text), self.dtype).tobytes()

    def release(self) -> None:
        """Give memory back when a task ends; workers live on, with the words that they remember."""
        give_back()

    def __call__(self, text: str | None) -> bytes:
        return next(self.many([text]))

    def many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text in turn."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= AT_ONCE:
                yield from self._some(held)
                held, size = [], 0
        yield from self._some(held)

    def _some(self, texts: list[str]) -> Iterator[bytes]:
        # Arrays of their own: ascii_lower misreads some that are cast from slices.
        made = self._bare if self.drops_space else self._spaced
        yield from made(texts, pa.array(texts, pa.large_string()))

    def _spaced(self, texts: list[str], array: pa.Array) -> Iterator[bytes]:
        split = pc.split_pattern(pc.replace_substring(array, "\n", " \n "), " ")
        words, sizes = split.flatten(), np.diff(split.offsets)
        whole = np.zeros(len(texts), bool)
        whole[_rows_of(sizes, np.flatnonzero(pc.equal(pc.binary_length(words), 0)))] = True
        if whole.any():
            words, sizes = words.filter(pa.array(~np.repeat(whole, sizes))), np.where(whole, 0, sizes)
        codes, distinct = _numbered(words)
        # A word at the start of a line has no blank before it and is told apart by a code of its own.
        line_feed = pc.index(distinct, pa.scalar(b"\n", distinct.type)).as_py()
        after = np.zeros(len(codes) + 1, bool)
        after[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        after[1:] |= codes == line_feed
        codes = codes + len(distinct) * after[:-1]
        used = np.zeros(2 * len(distinct), bool)
        used[codes] = True
        kinds = np.flatnonzero(used)
        asked = distinct.take(pa.array(kinds % max(1, len(distinct)))).to_pylist()
        spaced = int(np.searchsorted(kinds, len(distinct)))
        ids = self.spaced(asked[:spaced]) + self.bare(asked[spaced:])
        codes = (np.cumsum(used) - 1)[codes]
        if line_feed >= 0:
            ids[int(np.searchsorted(kinds, line_feed))] = self.line_feed
        unknown = np.fromiter(map(is_, ids, repeat(None)), bool, len(ids))
        if unknown.any():
            whole[_rows_of(sizes, np.flatnonzero(unknown[codes]))] = True
        for at, made in enumerate(_joined(ids, codes, sizes)):
            yield self.whole(texts[at]) if whole[at] else made

    def _bare(self, texts: list[str], array: pa.Array) -> Iterator[bytes]:
        # word_bpe lower-cases after composing characters; A-Z can be lower-cased first. Texts are split at ASCII white space.
        lower, whole = pc.ascii_lower(array), np.zeros(len(texts), bool)
        for special in self.special:
            whole |= np.asarray(pc.match_substring(lower, special))
        if whole.any():
            lower = pc.if_else(pa.array(whole), pa.scalar("", lower.type), lower)
        split = pc.ascii_split_whitespace(lower)
        codes, distinct = _numbered(split.flatten())
        ids = self.words(distinct.to_pylist())
        for at, made in enumerate(_joined(ids, codes, np.diff(split.offsets))):
            yield self.whole(texts[at]) if whole[at] else made


def _rows_of(sizes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The rows that hold these places, of rows with so many places each."""
    return np.searchsorted(np.cumsum(sizes), places, "right")


def _numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the distinct words by number."""
    found = words.cast(pa.large_binary()).dictionary_encode()
    return np.asarray(found.indices).astype(np.int64), found.dictionary


def _joined(ids: list[bytes | None], codes: np.ndarray, sizes: np.ndarray) -> Iterator[bytes]:
    """For rows of so many codes each, the ids of their codes in a row."""
    flat = pa.array(ids, pa.large_binary()).take(pa.array(codes))
    _, offsets, data = flat.buffers()
    ends = np.frombuffer(offsets, np.int64, len(codes) + 1)[np.cumsum(sizes)].tolist() if len(codes) else [0] * len(sizes)
    view, start = memoryview(data or b""), 0
    for end in ends:
        yield view[start:end].tobytes()
        start = end


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of that file, made once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
