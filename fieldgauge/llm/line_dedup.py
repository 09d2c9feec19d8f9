"""Delete blocks of lines that an earlier document has already.

Documents meet through shared runs of lines: from each line on, and up to each line, the
shortest run of consecutive lines that has enough words. For most lines that is the line
alone; short lines are taken together with their neighbours. A run that at least two
documents hold leads from each of them to the first that holds it. Whatever block of enough
words a document shares with an earlier one, each line of it lies in such a run, so it is
led to some earlier document that has these lines too. The two documents' line hashes are
then aligned by patience diff, and runs of aligned lines that have enough words together
are deleted from the later document. Short lines inside such a run go with it; alone they
never do. Patience diff keeps order: of two crossed lines one is deleted, and of a line that
the later document has more often than the earlier one the others stay.

A document leads to two others per line at most, whatever the number of copies, so nothing
grows with the square of a group. The pairs of a first document that more than RARE others
lead to are dealt out over several keys.

Earlier means a smaller doc_id. Lines are compared without blanks at their ends, by a
64-bit hash and the number of words.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, stored

RARE = 1000
WORDS = 5
# An odd number, so that its powers have inverses among 64-bit numbers.
BASE = 0x9E3779B97F4A7C15


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, not necessarily neighbours, in which both numbers rise."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, right) in enumerate(pairs):
        place = bisect_left(tails, right)
        before[n] = at[place - 1] if place else -1
        tails[place : place + 1] = [right]
        at[place : place + 1] = [n]
    chain, n = [], at[-1] if at else -1
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


def align(left: list, right: list) -> list[tuple[int, int]]:
    """Places of equal lines in the same order, by patience diff.

    Equal ends first, then lines that occur once on both sides, then the gaps between
    them likewise. A gap without such lines takes each line's next place on the right.
    """
    found, todo = [], [(0, len(left), 0, len(right))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and left[a] == right[b]:
            found.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and left[a_end - 1] == right[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            found.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        on_left, on_right = Counter(left[a:a_end]), Counter(right[b:b_end])
        place = {line: n for n, line in enumerate(right[b:b_end], b) if on_right[line] == 1}
        anchors = increasing(
            [(n, place[line]) for n, line in enumerate(left[a:a_end], a) if on_left[line] == 1 and line in place]
        )
        if anchors:
            for n, m in anchors:
                found.append((n, m))
                todo.append((a, n, b, m))
                a, b = n + 1, m + 1
            todo.append((a, a_end, b, b_end))
            continue
        places = defaultdict(list)
        for m in range(b, b_end):
            places[right[m]].append(m)
        for n in range(a, a_end):
            own = places.get(left[n], ())
            nearest = bisect_left(own, b)
            if nearest < len(own):
                found.append((n, own[nearest]))
                b = own[nearest] + 1
    return sorted(found)


def common_blocks(left: list, right: list, words: list[int], least: int) -> list[int]:
    """Lines on the left that lie in aligned runs of at least `least` words."""
    removed, run, last = [], [], None
    for pair in [*align(left, right), (None, None)]:
        if run and pair != (last[0] + 1, last[1] + 1):
            if sum(words[n] for n in run) >= least:
                removed += run
            run = []
        run.append(pair[0])
        last = pair
    return removed


def aligned(least: int):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(own: pa.Array, own_words: pa.Array, other: pa.Array, other_words: pa.Array) -> pa.Array:
        found = []
        for a, aw, b, bw in zip(own.to_pylist(), own_words.to_pylist(), other.to_pylist(), other_words.to_pylist()):
            found.append(common_blocks(list(zip(a, aw)), list(zip(b, bw)), aw, least))
        return pa.array(found, pa.list_(pa.int32()))

    return run


@F.arrow_udf(T.StringType())
def without_lines(texts: pa.Array, removed: pa.Array) -> pa.Array:
    """The text without the lines of these numbers; null numbers leave it as it is."""
    found = []
    for text, numbers in zip(texts, removed):
        if text.is_valid and numbers.is_valid and len(numbers):
            gone = set(numbers.as_py())
            found.append("\n".join(line for n, line in enumerate(text.as_py().split("\n")) if n not in gone))
        else:
            found.append(text.as_py())
    return pa.array(found, pa.string())


def line_arrays(text: str | Column) -> tuple[Column, Column]:
    """Hash and number of words of each line."""
    lines = F.transform(F.split(text, "\n"), lambda line: F.trim(F.regexp_replace(line, r"\s+", " ")))
    return (
        F.transform(lines, lambda line: F.xxhash64(line)),
        F.transform(lines, lambda line: F.when(line == "", 0).otherwise(F.size(F.split(line, " ")))),
    )


def run_hashes(hashes: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of words of the shortest runs of `least` words from and up to each
    line that has words; each once. A run of one line has the line's own hash."""
    so_far = np.concatenate([[0], np.cumsum(words)])
    spoken = np.flatnonzero(words > 0)
    ends = np.searchsorted(so_far, so_far[spoken] + least)
    starts = np.searchsorted(so_far, so_far[spoken + 1] - least, "right") - 1
    forward, backward = ends < len(so_far), starts >= 0
    start = np.concatenate([spoken[forward], starts[backward]])
    end = np.concatenate([ends[forward], spoken[backward] + 1])
    # A run's hash is the sum of line hash times power of its place in the run.
    powers, inverse = (np.full(len(words) + 1, base, np.uint64) for base in (BASE, pow(BASE, -1, 1 << 64)))
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(hashes.view(np.uint64) * powers[:-1], out=sums[1:])
    found = (sums[end] - sums[start]) * inverse[start]
    found, first = np.unique(found.view(np.int64), return_index=True)
    return found, (so_far[end] - so_far[start])[first]


def runs_of(least: int):
    """Arrow function of the lines' hashes and words."""
    kind = pa.struct([("hash", pa.int64()), ("words", pa.int64())])

    @F.arrow_udf("array<struct<hash:bigint,words:bigint>>")
    def run(hashes: pa.Array, words: pa.Array) -> pa.Array:
        found = [run_hashes(h.values.to_numpy(), w.values.to_numpy().astype(np.int64), least) for h, w in zip(hashes, words)]
        bounds = np.cumsum([0, *(len(h) for h, _ in found)])
        none = np.zeros(0, np.int64)
        values = [np.concatenate([none, *(pair[side] for pair in found)]) for side in (0, 1)]
        runs = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(values, kind)], fields=list(kind))
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs)

    return run


def removed_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, text_hash, removed: line numbers to delete, for the documents that have any."""
    bound_batches(df.sparkSession)
    hashes, counts = line_arrays("_text")
    docs = stored(
        df.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
        .select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("_text"))
        .select("doc_id", F.xxhash64("_text").alias("text_hash"), hashes.alias("hashes"), counts.alias("words"))
        .distinct(),
        "lines",
    )
    who = F.struct("doc_id", "text_hash").alias("who")
    runs = docs.select(who, F.explode(runs_of(words)("hashes", "words")).alias("run")).select("who", "run.hash", "run.words")
    # First by document, so that a run counts once in each; the second step is reduced in
    # each task before it is dealt out.
    shared = stored(
        runs.groupBy("hash", "words", "who.doc_id")
        .agg(F.min("who").alias("who"))
        .groupBy("hash", "words")
        .agg(F.min("who").alias("first"), F.count("*").alias("docs"))
        .where("docs > 1"),
        "shared-runs",
    )
    later = runs.join(shared, ["hash", "words"]).where("who.doc_id > first.doc_id")
    own = docs.select(who, F.col("hashes").alias("own"), F.col("words").alias("own_words"))
    other = docs.select(who.alias("first"), F.col("hashes").alias("other"), F.col("words").alias("other_words"))
    salt = F.pmod(F.xxhash64("who"), F.ceil(F.col("docs") / RARE))
    pairs = later.groupBy("who", "first").agg(F.max("docs").alias("docs"))
    pairs = stored(pairs.select("who", "first", salt.alias("salt")).join(own, "who"), "pairs")
    dealt = pairs.select("first", "salt").distinct().join(other, "first")
    blocks = pairs.join(dealt, ["first", "salt"]).select(
        "who", aligned(words)("own", "own_words", "other", "other_words").alias("removed")
    )
    return (
        blocks
        .where(F.size("removed") > 0)
        .groupBy("who")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("removed")))).alias("removed"))
        .select("who.*", "removed")
    )


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def dedup_lines(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, removed: str | None = None
) -> DataFrame:
    """All rows and columns, the text without lines of earlier documents.

    `removed` names a column for the numbers of the deleted lines. A text of which nothing
    is left becomes empty; null texts stay null. Rows that repeat an id with the same text
    get the same result; with different texts each is compared with smaller ids only. Rows
    without an id stay as they are and are nobody's earlier document. Other columns can have
    any names.
    """
    gone_id, gone_hash, gone = (free_name(df, f"_gone_{n}") for n in ("id", "hash", "lines"))
    found = removed_lines(df, doc_id, text, words).select(
        F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash), F.col("removed").alias(gone)
    )
    same = (F.col(doc_id).cast("long") == F.col(gone_id)) & (
        F.xxhash64(F.col(text).cast("string")) == F.col(gone_hash)
    )
    joined = df.join(found, same, "left").withColumn(text, without_lines(F.col(text), F.col(gone)))
    columns = [F.col(c) for c in df.columns if c != removed]
    return joined.select(*columns, *([F.coalesce(gone, F.array().cast("array<int>")).alias(removed)] if removed else []))
