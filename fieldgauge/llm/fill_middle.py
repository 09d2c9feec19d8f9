"""Fill-in-the-middle: prefix, middle and suffix of a text in another order, and back.

A text is cut between code points, but kept as bytes. Where the boundary of a given rank
lies is answered by a learned rank index: boundary offsets grow almost evenly with their
rank, so a few straight segments predict each to within ERROR bytes, and one stored byte
per boundary, the residual, makes the prediction exact. A cut is one multiplication and
one look-up, however long the text is, and the index can be stored and asked later.

Rows without a text count as empty ones. An empty text, or one that holds a marker, stays
as it is (`plain`), because it could not be taken apart again. Rows without an id are cut
like one whose id is the empty text. Every row gives one row, in any number of repeats.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, release_memory, text_array

# The markers.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
PLAIN, PSM, SPM = "plain", "psm", "spm"

# How far a segment's prediction may be off, in bytes; residuals have one signed byte.
ERROR = 100
# Bytes whose boundaries are looked at together; a segment ends there at the latest.
BLOCK = 1 << 20
# Boundaries that a new segment is tried on first; doubled as long as they fit.
TRIAL = 1024

INDEX = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("ranks", T.ArrayType(T.LongType())),
        T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("slopes", T.ArrayType(T.DoubleType())),
        T.StructField("residuals", T.BinaryType()),
    ]
)
INDEX_ARROW = pa.struct(
    [
        ("n", pa.int64()),
        ("ranks", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("slopes", pa.list_(pa.float64())),
        ("residuals", pa.binary()),
    ]
)


def fit_segment(offsets: np.ndarray, start: int, error: int) -> tuple[int, float]:
    """End and slope of the longest segment from the boundary `start` on.

    The line goes through the first boundary. Each further one narrows the cone of slopes
    that keep all within the error; the segment ends before the cone closes.
    """
    low, high, stop, step = -np.inf, np.inf, start + 1, TRIAL
    while stop < len(offsets):
        rise = offsets[stop : stop + step] - offsets[start]
        run = np.arange(stop - start, stop - start + len(rise))
        lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
        highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
        closed = np.flatnonzero(lows > highs)
        fits = int(closed[0]) if len(closed) else len(rise)
        if fits:
            low, high = float(lows[fits - 1]), float(highs[fits - 1])
        stop += fits
        if len(closed):
            break
        step *= 2
    return stop, (low + high) / 2 if stop > start + 1 else 0.0


@dataclass
class RankIndex:
    """Byte offsets of `n` + 1 boundaries: those before each code point, and the end."""

    n: int = 0
    ranks: list[int] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)
    slopes: list[float] = field(default_factory=list)
    residuals: bytes = b""

    @classmethod
    def fit(cls, text: bytes | memoryview, error: int = ERROR) -> RankIndex:
        raw = np.frombuffer(text, np.uint8)
        own, rank, residuals = cls(), 0, []
        for begin in range(0, max(len(raw), 1), BLOCK):
            block = raw[begin : begin + BLOCK]
            # Every byte but those that go on a code point begins one.
            bounds = np.flatnonzero((block & 0xC0) != 0x80) + begin
            if begin + BLOCK >= len(raw):
                bounds = np.append(bounds, len(raw))
            start = 0
            while start < len(bounds):
                stop, slope = fit_segment(bounds, start, error)
                first = int(bounds[start])
                own.ranks.append(rank + start)
                own.offsets.append(first)
                own.slopes.append(slope)
                guess = first + np.floor(slope * np.arange(stop - start)).astype(np.int64)
                residuals.append((bounds[start:stop] - guess).astype(np.int8).tobytes())
                start = stop
            rank += len(bounds)
        own.n, own.residuals = rank - 1, b"".join(residuals)
        return own

    def offset(self, rank: int) -> int:
        """Where boundary `rank` lies: predicted, then corrected."""
        at = bisect_right(self.ranks, rank) - 1
        guess = self.offsets[at] + int(np.floor(self.slopes[at] * (rank - self.ranks[at])))
        residual = self.residuals[rank]
        return guess + (residual - 256 if residual > 127 else residual)


def raw_texts(texts: pa.Array):
    """The UTF-8 bytes of each text, without copies of the whole array."""
    texts = text_array(texts)
    data = texts.buffers()[2]
    view = memoryview(data) if data is not None else memoryview(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1].tolist()
    return [bytes(view[a:b]) for a, b in zip(ends, ends[1:])]


@F.arrow_udf(INDEX)
def rank_index(texts: pa.Array) -> pa.Array:
    """The index of each text as a struct, to be stored and asked by `boundary_offset`."""
    return pa.array([vars(RankIndex.fit(t)) for t in raw_texts(texts)], INDEX_ARROW)


@F.arrow_udf(T.LongType())
def boundary_offset(indexes: pa.Array, ranks: pa.Array) -> pa.Array:
    """Byte offset of the boundary of a rank; null outside 0 to n, and for nulls."""
    found = []
    for index, rank in zip(indexes.to_pylist(), ranks.to_pylist()):
        inside = index is not None and rank is not None and 0 <= rank <= index["n"]
        found.append(RankIndex(**index).offset(rank) if inside else None)
    return pa.array(found, pa.int64())


def seeds(doc_id: str | Column, salt: str = "1:") -> list[Column]:
    """Four whole numbers of each row: groups of eight digits of a hash of its id."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    digits = F.sha2(F.concat(F.lit(salt), text), 256)
    return [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def join_parts(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    p, s, m = MARKERS
    return b"".join([p, prefix, s, suffix, m, middle] if form == PSM else [s, suffix, p, prefix, m, middle])


def rebuild(output: bytes, form: str) -> bytes:
    """The text that `output` was made of.

    The text holds no marker and no marker begins as another ends, so the first place at
    which one is found is the one that was put in.
    """
    if form == PLAIN:
        return output
    p, s, m = MARKERS
    first, second = (p, s) if form == PSM else (s, p)
    cut = output.index(second, len(first))
    last = output.index(m, cut + len(second))
    one, two, middle = output[len(first) : cut], output[cut + len(second) : last], output[last + len(m) :]
    return one + middle + two if form == PSM else two + middle + one


OUTPUT = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)
OUTPUT_ARROW = pa.schema(
    [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())]
)


def transform_one(text: bytes, h: tuple[int, ...], plain_share: int, spm_share: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    index = RankIndex.fit(text)
    n = index.n
    if not n or h[2] % 100 >= 100 - plain_share or any(m in text for m in MARKERS):
        return n, PLAIN, None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = index.offset(first), index.offset(second)
    form = SPM if h[3] % 100 < spm_share else PSM
    return n, form, first, second - first, join_parts(form, text[:a], text[a:b], text[b:])


def fill_middle(plain_share: int = 10, spm_share: int = 20):
    """Arrow function of a text and its four seeds. In a hundred rows `plain_share` stay
    plain, and of the others `spm_share` have the suffix first."""

    @F.arrow_udf(OUTPUT)
    def run(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        hashes = zip(*(h.to_pylist() for h in (h1, h2, h3, h4)))
        rows = [transform_one(t, h, plain_share, spm_share) for t, h in zip(raw_texts(texts), hashes)]
        columns = list(zip(*rows)) or [()] * len(OUTPUT_ARROW)
        arrays = [pa.array(c, pa.large_binary() if f.name == "output" else f.type) for c, f in zip(columns, OUTPUT_ARROW)]
        arrays[-1] = arrays[-1].cast(pa.large_string())
        release_memory()
        return pa.StructArray.from_arrays(arrays, fields=list(OUTPUT_ARROW))

    return run


@F.arrow_udf(T.StringType())
def restore(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The whole text again, from an output and its form."""
    found = [rebuild(o, f) for o, f in zip(raw_texts(outputs), forms.to_pylist())]
    return pa.array(found, pa.large_binary()).cast(pa.large_string())


def with_fill_middle(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "fill_middle",
    salt: str = "1:", plain_share: int = 10, spm_share: int = 20,
) -> DataFrame:
    """Add a struct (n, form, prefix_chars, middle_chars, output); all other columns stay.

    The cuts depend on the id and the length alone, so a run again gives the same. A
    column that has the name `into` already is replaced.
    """
    bound_batches(df.sparkSession)
    made = fill_middle(plain_share, spm_share)(F.col(text), *seeds(doc_id, salt))
    return df.withColumn(into, made)
