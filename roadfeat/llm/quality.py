"""Document quality by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadfeat.llm.shared import store, text_batches

#: Statistics of a text, all shares or logarithms, in the order of ``statistics``.
STATISTICS = (
    "log_words",
    "mean_word_bytes",
    "upper_share",
    "digit_share",
    "exclamation_share",
    "symbol_share",
    "other_mark_share",
    "space_share",
    "high_byte_share",
    "distinct_words",
    "repeated_lines",
    "log_words_in_line",
    "bare_mark_words",
)
_SYMBOLS = np.frombuffer(b"#*$%&|<>~^=+_@\\{}[]", np.uint8)
_MARKS = np.frombuffer(b".,;:'\"()-?/`", np.uint8)


def statistics(text: bytes | None) -> list[float]:
    """The statistics of a whole text; null counts as empty."""
    data = text or b""
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n, w = max(1, len(data)), max(1, len(words))
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = max(1, int(seen[65:91].sum() + seen[97:123].sum()))
    return [
        np.log1p(len(words)),
        np.log1p((n - seen[[9, 10, 11, 12, 13, 32]].sum()) / w),
        np.sqrt(seen[65:91].sum() / letters),
        np.sqrt(seen[48:58].sum() / n),
        np.sqrt(seen[33] / n),
        np.sqrt(seen[_SYMBOLS].sum() / n),
        np.sqrt(seen[_MARKS].sum() / n),
        np.sqrt(seen[32] / n),
        np.sqrt(seen[128:].sum() / n),
        len(set(words)) / w,
        np.sqrt(1 - len(set(lines)) / max(1, len(lines))),
        np.log1p(len(words) / max(1, len(lines))),
        np.sqrt(sum(1 for x in words if len(x) == 1 and not x.isalnum()) / w),
    ]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = pa.array([statistics(t.as_py()) for t in batch["text"]], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], rows], ["doc_id", "x"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)`` of every row, written to the shared folder."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return store(text_batches(base).mapInArrow(_statistics, "doc_id long, x array<double>"), "quality-statistics")


@dataclass
class Discriminant:
    """Class means and the inverse Cholesky factors of the shrunken class covariances."""

    means: np.ndarray
    inverse_factors: np.ndarray
    log_scale: np.ndarray
    slope: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Chance of class 1 for each row, from the difference of the classes' log densities."""
        logs = [
            s - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1)
            for m, f, s in zip(self.means, self.inverse_factors, self.log_scale, strict=True)
        ]
        return 1 / (1 + np.exp(-np.clip(self.slope * (logs[1] - logs[0]), -500, 500)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(STATISTICS) + 1
    sums = np.zeros((2, d, d))
    for batch in batches:
        if batch.num_rows:
            x = np.column_stack([np.ones(batch.num_rows), np.asarray(batch["x"].flatten()).reshape(batch.num_rows, -1)])
            y = np.asarray(batch["y"])
            for k in (0, 1):
                sums[k] += x[y == k].T @ x[y == k]
    for k in (0, 1):
        at = np.indices((d, d)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(d * d, k)), pa.array(at[0]), pa.array(at[1]), pa.array(sums[k].ravel())], ["k", "i", "j", "v"]
        )


def fit(rows: DataFrame, shrink: float = 0.15, ridge: float = 0.02, slope: float = 0.5) -> Discriminant:
    """Fit on ``(x, y)``: each class covariance is shrunk towards the pooled one and by a share of its own diagonal.

    Counts, sums and products are summed over all rows, one small matrix for each task. ``slope`` flattens
    the log density difference, as statistics of one text depend on each other. A class without
    rows takes the moments of the other; without any rows every score is 0.5.
    """
    d = len(STATISTICS)
    sums = np.zeros((2, d + 1, d + 1))
    for r in rows.select("x", "y").mapInArrow(_moments, "k long, i long, j long, v double").groupBy("k", "i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r.k, r.i, r.j] = r.v
    counts = sums[:, 0, 0]
    if not counts.any():
        return Discriminant(np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2))
    for k in (0, 1):
        if not counts[k]:
            sums[k] = sums[1 - k]
    n = sums[:, 0, 0]
    means = sums[:, 0, 1:] / n[:, None]
    covs = sums[:, 1:, 1:] / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (n[:, None, None] * covs).sum(0) / n.sum()
    floor = np.diag(np.diag(pooled) * ridge + 1e-6)
    factors = [np.linalg.cholesky((1 - shrink) * c + shrink * pooled + floor) for c in covs]
    prior = np.log(np.maximum(counts, 0.5) / counts.sum())
    scale = np.array([p - np.log(np.diag(f)).sum() for p, f in zip(prior, factors, strict=True)])
    return Discriminant(means, np.stack([np.linalg.inv(f) for f in factors]), scale, slope)


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """``(doc_id, score)`` of every row of ``document_statistics``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch["x"].flatten()).reshape(batch.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.scores(x))], ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of documents that no model may learn from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def quality_model(stats: DataFrame, labels: DataFrame) -> Discriminant:
    """The discriminant fitted on all labelled rows that are not held out.

    Labels that are null or neither 0 nor 1 are ignored; a document with several labels takes the lowest.
    """
    known = (
        labels.where("quality in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("long").alias("y"))
    )
    return fit(stats.where(~held_out()).join(known, "doc_id"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score)`` of every row; labels teach only where ``held_out`` is false.

    Null and empty texts have the statistics of an empty text and a score like any other; repeated rows are scored each.
    """
    stats = document_statistics(docs)
    return score(stats, quality_model(stats, labels)).select("doc_id", held_out().alias("held_out"), "score")


def good_documents(docs: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``; texts are scored where they are read, nothing is shuffled."""
    model, at = quality_model(document_statistics(docs), labels), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(at).cast(pa.binary())]).reshape(-1, len(STATISTICS))
            yield batch.filter(pa.array(model.scores(x) >= least, pa.bool_()))

    return text_batches(docs).mapInArrow(run, docs.schema)
