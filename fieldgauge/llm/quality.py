"""Document quality from statistics of the text, by kernel ridge regression.

Each text becomes a few dozen numbers (shares of kinds of characters, repeated words and
lines, lengths). Random Fourier features of these approximate a Gaussian kernel. Every
task adds up its share of the normal equations, the sums are added by row of the matrix,
and only the finished matrix of fixed size reaches the driver. Isotonic regression on
documents kept out of the fit turns the ridge scores into probabilities.

Labels come from rows of the folds for learning only; ids, languages and sources are no
input of a score. Without any usable label every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, fold, isotonic, stored, text_array

FOLDS = 5
HELD_OUT = 0
CALIBRATION = 4
FEATURES = 256
RIDGE = 1e-3
THRESHOLD = 0.3
BINS = 1000
SEED = 17

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:'\"()-",
    "shout": b"!?",
    "sign": b"#$%&*+<=>@^_~|\\/{}[]`",
    "space": b" \t",
    "line": b"\n\r",
}
_KIND_BYTES = [np.frombuffer(chars, np.uint8) for chars in _KINDS.values()]
STATISTICS = (
    [f"share_{kind}" for kind in _KINDS]
    + ["share_wide", "log_bytes", "log_words", "log_lines", "word_length", "log_longest_word", "log_line_bytes"]
    + ["distinct_words", "top_word", "repeated_pairs", "distinct_lines", "letter_words", "share_top_sign"]
)


def statistics(text: str) -> list[float]:
    """The numbers named in STATISTICS; all 0 for an empty text."""
    raw = text.encode()
    size = len(raw)
    if not size:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = [float(counts[own].sum()) / size for own in _KIND_BYTES]
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    total = max(1, len(words))
    repeats: dict[bytes, int] = {}
    for word in words:
        repeats[word] = repeats.get(word, 0) + 1
    pairs = len(set(zip(words, words[1:]))) if len(words) > 1 else 0
    return [
        *shares,
        float(counts[128:].sum()) / size,
        np.log1p(size),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        (size - counts[_KIND_BYTES[-1]].sum()) / total / 10,
        np.log1p(max(map(len, words), default=0)),
        np.log1p(size / max(1, len(lines))),
        len(repeats) / total,
        max(repeats.values(), default=0) / total,
        1 - pairs / (len(words) - 1) if len(words) > 1 else 0.0,
        len(set(lines)) / max(1, len(lines)),
        sum(map(bytes.isalpha, repeats)) / max(1, len(repeats)),
        float(counts[_KIND_BYTES[5]].max()) / size,
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def text_statistics(texts: pa.Array) -> pa.Array:
    return pa.array([statistics(t) for t in text_array(texts).to_pylist()], pa.list_(pa.float64()))


@dataclass
class Model:
    """Everything a score needs; a few hundred kilobytes whatever the data."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    points: list[tuple[float, float]]
    directions: np.ndarray
    phases: np.ndarray

    def features(self, numbers: np.ndarray) -> np.ndarray:
        turned = np.clip((numbers - self.mean) / self.scale, -8, 8) @ self.directions + self.phases
        wave = np.sqrt(2 / len(self.phases)) * np.cos(turned)
        return np.concatenate([wave, np.ones((len(numbers), 1))], axis=1)

    def raw(self, numbers: np.ndarray) -> np.ndarray:
        return self.features(numbers) @ self.weights

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        if not self.points:
            return np.full(len(numbers), 0.5)
        raw = self.raw(numbers)
        known = np.interp(raw, *zip(*self.points))
        # A trace of the raw score orders documents within a level.
        return 0.999 * known + 0.001 * np.clip(raw, 0, 1)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(STATISTICS))


def _moments(batches):
    total = np.zeros((3, len(STATISTICS)))
    for batch in batches:
        own = _numbers(batch.column(0))
        total += np.stack([np.full(own.shape[1], len(own)), own.sum(axis=0), (own**2).sum(axis=0)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(3), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["row", "sums"]
    )


def _equations(model: Model):
    def run(batches):
        size = len(model.phases) + 1
        total = np.zeros((size + 1, size))
        for batch in batches:
            wave = model.features(_numbers(batch.column(0)))
            label = batch.column(1).to_numpy(zero_copy_only=False)
            total[:size] += wave.T @ wave
            total[size] += label @ wave
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["row", "sums"]
        )

    return run


def _add_rows(key, rows):
    import pandas as pd

    return pd.DataFrame({"row": [key[0]], "sums": [np.sum(np.stack(rows["sums"].to_list()), axis=0)]})


def _summed(partial: DataFrame) -> np.ndarray:
    """Rows of partial matrices added up; the result has a fixed size."""
    added = partial.groupBy("row").applyInPandas(_add_rows, "row int, sums array<double>").collect()
    return np.array([r.sums for r in sorted(added, key=lambda r: r["row"])])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    features: int = FEATURES,
    ridge: float = RIDGE,
) -> Model:
    """Learn from the labelled rows outside the held-out fold.

    Labels other than 0 and 1 are left out; a label that repeats counts as often.
    """
    bound_batches(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & (fold(doc_id, FOLDS) != HELD_OUT)).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("label")
    )
    rows = stored(
        docs.where(fold(doc_id, FOLDS) != HELD_OUT)
        .select(F.col(doc_id).alias("_id"), text_statistics(F.col(text)).alias("numbers"))
        .join(known, "_id")
        .select("numbers", "label", (fold("_id", FOLDS) == CALIBRATION).alias("kept_out")),
        "statistics",
    )
    rng = np.random.default_rng(SEED)
    width = len(STATISTICS)
    model = Model(
        np.zeros(width), np.ones(width), np.zeros(features + 1), [],
        rng.normal(0, 1 / np.sqrt(width), (width, features)), rng.uniform(0, 2 * np.pi, features),
    )
    learn = rows.where("not kept_out")
    sums = _summed(learn.select("numbers").mapInArrow(_moments, "row int, sums array<double>"))
    if not len(sums) or not sums[0][0]:
        return model
    count = sums[0][0]
    model.mean = sums[1] / count
    model.scale = np.sqrt(np.maximum(sums[2] / count - model.mean**2, 1e-6))
    sums = _summed(learn.select("numbers", "label").mapInArrow(_equations(model), "row int, sums array<double>"))
    size = features + 1
    model.weights = np.linalg.solve(sums[:size] / count + ridge * np.eye(size), sums[size] / count)

    @F.arrow_udf(T.LongType())
    def bins(numbers: pa.Array) -> pa.Array:
        return pa.array(np.rint(np.clip(model.raw(_numbers(numbers)), -1, 2) * BINS).astype(np.int64))

    # At most 3,001 bins, so the calibration curve is a fixed amount of data too.
    def curve(source: DataFrame):
        return (
            source.select(bins("numbers").alias("bin"), "label")
            .groupBy("bin")
            .agg(F.sum("label").alias("hits"), F.count("*").alias("rows"))
            .collect()
        )

    binned = curve(rows.where("kept_out")) or curve(learn)
    model.points = isotonic([r.bin / BINS for r in binned], [r.hits for r in binned], [r["rows"] for r in binned])
    return model


def score(model: Model, text: str = "text") -> Column:
    """Score of a text between 0 and 1; a null text counts as empty."""

    @F.arrow_udf(T.DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        numbers = np.array([statistics(t) for t in text_array(texts).to_pylist()]).reshape(-1, len(STATISTICS))
        return pa.array(model.scores(numbers))

    return run(F.col(text))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row; a null id is not held out."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(fold(doc_id, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score(model, text).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns whose score reaches the threshold."""
    return docs.where(score(model, text) >= threshold)
