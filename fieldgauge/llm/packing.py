"""Pack documents into sequences of a fixed number of tokens, as few as possible.

Hierarchical best fit. A task encodes its documents and packs their pieces by best fit in
windows of a bounded number of tokens: bins that are full, or nearly so, are written; the
others go on into the next window as single items. What is left of a task are a few
underfull bins. These are the items of the next level, where several tasks' bins meet in
one group and are packed again, and so on until one group is left. A bin's pieces are
looked up at the end, for the bins of later levels only.

A group of a level holds at most GROUP bins. If no more bins fit together although there
are several groups (say, all are just over half full) the levels end there.

Null texts count as empty, which is one end id. Repeated rows are packed once each; equal
lengths are taken in order of arrival. An empty table gives no rows. Other columns of the
input play no part.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, stored, text_array, text_slices
from .tokens import SLICE_BYTES, encoder, with_end

LENGTH = 4096
# Tokens packed at once in a task, and bins packed at once in a group of a later level.
WINDOW = 2 << 20
GROUP = 50_000
FAN_IN = 16
# A bin with no more room than this counts as nearly full.
SLACK = 2
PIECES = "doc_id long, piece int, start long, length long, ids array<int>, bin long, offset long, room int"


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Numbers of the items in each bin: longest first, each to the fullest bin that takes it."""
    bins: list[list[int]] = []
    rooms: list[int] = []  # the different amounts of room, ascending
    by_room: dict[int, list[int]] = {}
    for item in sorted(range(len(sizes)), key=lambda n: -sizes[n]):
        at = bisect.bisect_left(rooms, sizes[item])
        if at == len(rooms):
            left, chosen = length - sizes[item], len(bins)
            bins.append([item])
        else:
            room = rooms[at]
            chosen = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
            bins[chosen].append(item)
            left = room - sizes[item]
        if left not in by_room:
            by_room[left] = []
            bisect.insort(rooms, left)
        by_room[left].append(chosen)
    return bins


class Window:
    """Pieces of one task that wait for a bin; bins carried over count as one item."""

    def __init__(self, length: int, part: int):
        self.length, self.next_bin = length, part << 32
        self.items: list[tuple[int, list[tuple]]] = []
        self.tokens = 0

    def add(self, size: int, piece: tuple) -> None:
        self.items.append((size, [piece]))
        self.tokens += size

    def flush(self, last: bool) -> list[tuple]:
        """Rows of the bins that are done; with `last` of all bins."""
        found, kept = [], []
        for members in best_fit([size for size, _ in self.items], self.length):
            size = sum(self.items[n][0] for n in members)
            pieces = [piece for n in members for piece in self.items[n][1]]
            if not last and self.length - size > SLACK:
                kept.append((size, pieces))
                continue
            at = 0
            for piece in pieces:
                found.append((*piece, self.next_bin, at, self.length - size))
                at += piece[3]
            self.next_bin += 1
        self.items = kept
        # Bins carried over don't fill the next window, or a window of them alone would
        # never take in new pieces.
        self.tokens = 0
        return found


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, piece, start, size, ids, bins, at, room = zip(*rows)
    bounds = np.concatenate([[0], np.cumsum(size)])
    values = pa.array(np.concatenate(ids).astype("<i4"))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
            pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values),
            pa.array(bins, pa.int64()), pa.array(at, pa.int64()), pa.array(room, pa.int32()),
        ],
        ["doc_id", "piece", "start", "length", "ids", "bin", "offset", "room"],
    )


def as_batches(rows: list[tuple], at_once: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), at_once):
        yield as_batch(rows[at : at + at_once])


def pack_task(vocab: str, length: int, window_tokens: int):
    def run(batches):
        known = encoder(vocab)
        # Ids of small vocabularies wait for their bin in half the space.
        kind = np.dtype("<u2" if known.tokenizer.get_vocab_size() <= 65536 else "<u4")
        window = Window(length, TaskContext.get().partitionId())
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for begin, some in text_slices(text_array(batch.column(1)), SLICE_BYTES):
                ids, bounds = with_end(*known.encode(some))
                ids = ids.astype(kind)
                for n, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for piece, start in enumerate(range(a, b, length)):
                        own = ids[start : min(start + length, b)]
                        window.add(len(own), (doc_ids[begin + n], piece, start - a, len(own), own))
                if window.tokens >= window_tokens:
                    yield from as_batches(window.flush(last=False))
        known.forget()
        yield from as_batches(window.flush(last=True))

    return run


def pack_group(length: int):
    """Best fit over the bins of one group: each bin gets a new bin and its place there."""

    def run(key, bins):
        import pandas as pd

        bins = bins.sort_values("bin", ignore_index=True)
        sizes, numbers = bins["size"].tolist(), bins["bin"].tolist()
        rows = []
        for members in best_fit(sizes, length):
            whole = sum(sizes[n] for n in members)
            at = 0
            for n in members:
                rows.append((numbers[n], numbers[members[0]], at, whole))
                at += sizes[n]
        return pd.DataFrame(rows, columns=["bin", "new_bin", "shift", "new_size"])

    return run


def merge_bins(bins: DataFrame, length: int, fan_in: int, most: int) -> DataFrame:
    """(bin, size) to (bin, sequence_id, shift), by rounds of best fit up a tree of groups."""
    count, tasks = bins.agg(F.count("*"), F.count_distinct(F.shiftright("bin", 32))).first()
    groups = tasks // fan_in
    placed = bins.select("bin", F.col("bin").alias("sequence_id"), F.lit(0).cast("long").alias("shift"))
    left = bins
    while count > 1:
        groups = max(1, groups, -(-count // most))
        # Bins are dealt out by hash, so that every group sees bins of many tasks.
        keyed = left.withColumn("group", F.pmod(F.xxhash64("bin"), F.lit(groups)))
        merged = stored(
            keyed.groupBy("group").applyInPandas(
                pack_group(length), "bin long, new_bin long, shift long, new_size long"
            ),
            "merged-bins",
        )
        step = merged.select(F.col("bin").alias("sequence_id"), "new_bin", F.col("shift").alias("more"))
        placed = stored(
            placed.join(step, "sequence_id", "left").select(
                "bin",
                F.coalesce("new_bin", "sequence_id").alias("sequence_id"),
                (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"),
            ),
            "placed-bins",
        )
        full = length - SLACK
        left = merged.where("new_size < %d" % full).groupBy(F.col("new_bin").alias("bin")).agg(
            F.max("new_size").alias("size")
        )
        now = left.count()
        if groups == 1 or now > 0.99 * count:
            break
        count, groups = now, groups // fan_in
    return placed


def pack(
    df: DataFrame,
    vocab: str,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    window: int = WINDOW,
    fan_in: int = FAN_IN,
    most: int = GROUP,
) -> DataFrame:
    """Pieces with their ids and places: doc_id, piece, start, length, ids, sequence_id, offset."""
    spark = df.sparkSession
    bound_batches(spark)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = stored(rows.mapInArrow(pack_task(vocab, length, window), PIECES), "pieces")
    done = pieces.where(F.col("room") <= SLACK)
    open_pieces = pieces.where(F.col("room") > SLACK)
    bins = open_pieces.groupBy("bin").agg(F.sum("length").alias("size"))
    placed = merge_bins(stored(bins, "open-bins"), length, fan_in, most)
    columns = ["doc_id", "piece", "start", "length", "ids"]
    return done.select(*columns, F.col("bin").alias("sequence_id"), "offset").unionByName(
        open_pieces.join(placed, "bin").select(
            *columns, "sequence_id", (F.col("offset") + F.col("shift")).alias("offset")
        )
    )
