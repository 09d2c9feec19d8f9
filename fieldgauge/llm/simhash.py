"""Near copies by SimHash: fingerprints that differ in few bits, found with vantage points.

A fingerprint is cut into 16 blocks of four bits. Each level of the tree has a vantage
point of its own, one block long, and sorts fingerprints by the Hamming distance of their
block to it: a leaf is a list of 16 distances. The blocks don't overlap, so by the
triangle inequality two fingerprints that differ in at most two bits lie in leaves whose
distances differ by at most two in sum. Every fingerprint therefore goes to its own leaf
and to the leaves one step away, across one boundary; two fingerprints within reach always
meet in a leaf between them. There their bits are compared, so the links are exact.

Only different fingerprints are searched, so copies cost one entry. A leaf that holds a
crowd of near copies gives each member one link to the first of its kind, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, stored, text_array, text_slices
from .components import components

SEED = 42
WORDS = 3
MAX_BITS = 2
LEVELS = 16
BLOCK_BITS = 4
# One vantage point of four bits per level, joined to one number.
VANTAGE = 0x0F1E2D3C4B5A6978
# Up to this size a leaf's members are all compared at once; beyond, each looks up its
# possible neighbours instead, which grows with the members and not their square.
CROWD = 2048


def fingerprints(texts: pa.Array, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Fingerprints as signed 64-bit numbers; a text without words has 0."""
    from xxhash import xxh64_intdigest

    found = np.zeros(len(texts), np.int64)
    for begin, some in text_slices(texts, 1 << 20):
        hashes, ends = [], []
        for raw in some.cast(pa.large_binary()).to_pylist():
            known = raw.lower().split()
            if len(known) >= words:
                hashes += [
                    xxh64_intdigest(b" ".join(s), seed) for s in zip(*(known[n:] for n in range(words)))
                ]
            elif known:
                hashes.append(xxh64_intdigest(b" ".join(known), seed))
            ends.append(len(hashes))
        counts = np.diff(ends, prepend=0)
        full = np.flatnonzero(counts)
        if not len(full):
            continue
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (np.array(ends) - counts)[full], axis=0, dtype=np.int64)
        most = (2 * ones > counts[full][:, None]).astype(np.uint8)
        found[begin + full] = np.packbits(most, axis=1, bitorder="little").view("<i8")[:, 0]
    return found


def fingerprint(words: int = WORDS, seed: int = SEED):
    @F.arrow_udf(T.LongType())
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(fingerprints(text_array(texts), words, seed))

    return run


def as_hex(fp: str) -> Column:
    """The fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def leaves(fp: str) -> Column:
    """The leaf of a fingerprint and those one step away, as numbers to the base five."""
    apart = F.col(fp).bitwiseXOR(F.lit(VANTAGE))
    mask = (1 << BLOCK_BITS) - 1
    levels = [
        F.bit_count(F.shiftrightunsigned(apart, BLOCK_BITS * n).bitwiseAND(F.lit(mask))).cast("long")
        for n in range(LEVELS)
    ]
    base = BLOCK_BITS + 1
    own = sum((d * base**n for n, d in enumerate(levels)), F.lit(0).cast("long"))
    near = [own]
    for n, d in enumerate(levels):
        near += [F.when(d > 0, own - base**n), F.when(d < BLOCK_BITS, own + base**n)]
    return F.filter(F.array(*near), lambda leaf: leaf.isNotNull())


def crowd_labels(fps: np.ndarray, bits: int) -> np.ndarray:
    """For each member of a leaf the number of the first member it is linked with."""
    label = np.arange(len(fps))
    if len(fps) <= CROWD:
        left, right = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits)
    else:
        order = np.argsort(fps)
        ranked = fps[order]
        one = [np.uint64(1 << n) for n in range(64)]
        masks = list(one)
        if bits >= 2:
            masks += [one[a] | one[b] for a in range(64) for b in range(a)]
        if bits > 2:
            raise ValueError("crowded leaves are searched up to two bits")
        lefts, rights = [], []
        for mask in masks:
            wanted = ranked ^ mask
            at = np.minimum(np.searchsorted(ranked, wanted), len(ranked) - 1)
            hit = np.flatnonzero(ranked[at] == wanted)
            lefts.append(order[hit])
            rights.append(order[at[hit]])
        left, right = np.concatenate(lefts), np.concatenate(rights)
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def leaf_links(bits: int):
    """Rows sorted by leaf to links (a, b) between the documents of linked fingerprints."""

    def links(leaf, fps, docs):
        edges = np.flatnonzero(np.diff(leaf)) + 1
        starts = np.concatenate([[0], edges])
        sizes = np.diff(np.concatenate([starts, [len(leaf)]]))
        found = []
        # Small leaves, all at once: each member with the one so many places after it.
        small = np.repeat(sizes <= 8, sizes)
        for step in range(1, min(8, len(leaf))):
            pairs = np.flatnonzero(
                (leaf[step:] == leaf[:-step]) & small[step:] & (np.bitwise_count(fps[step:] ^ fps[:-step]) <= bits)
            )
            found.append(np.stack([docs[pairs], docs[pairs + step]]))
        for n in np.flatnonzero(sizes > 8):
            own = slice(starts[n], starts[n] + sizes[n])
            label = crowd_labels(fps[own], bits)
            member = np.flatnonzero(label != np.arange(len(label)))
            found.append(np.stack([docs[own][member], docs[own][label[member]]]))
        return np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((2, 0), np.int64)

    def run(batches):
        rest = [np.empty(0, np.int64)] * 3
        for batch in batches:
            now = [
                np.concatenate([old, batch.column(n).to_numpy(zero_copy_only=False)]) for n, old in enumerate(rest)
            ]
            if not len(now[0]):
                continue
            # The last leaf may go on in the next batch.
            cut = int(np.searchsorted(now[0], now[0][-1]))
            rest = [column[cut:] for column in now]
            if cut:
                a, b = links(now[0][:cut], now[1][:cut].view(np.uint64), now[2][:cut])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        if len(rest[0]):
            a, b = links(rest[0], rest[1].view(np.uint64), rest[2])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def fingerprint_links(firsts: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(fp, doc), all fp different, to links (a, b) that connect all fp within `bits` bits."""
    if bits > 2:
        raise ValueError("leaves one step away cover two bits")
    placed = firsts.select(F.explode(leaves("fp")).alias("leaf"), "fp", "doc")
    return placed.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(leaf_links(bits), "a long, b long")


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """doc_id, fp (signed 64-bit) and component_id of every row.

    component_id is the smallest doc_id that links lead to. Null texts count as empty;
    texts without words all have the fingerprint 0. Rows that repeat an id get one result
    each. Rows without an id take no part: they have a fingerprint and a null component.
    """
    bound_batches(df.sparkSession)
    marked = stored(
        df.select(F.col(doc_id).cast("long").alias("doc_id"), fingerprint(words)(F.col(text)).alias("fp")),
        "fingerprints",
    )
    firsts = stored(
        marked.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("doc")), "first-documents"
    )
    found = components(fingerprint_links(firsts, bits)).select(F.col("node").alias("doc"), "component")
    reached = firsts.join(found, "doc", "left").select(
        "fp", F.coalesce("component", "doc").alias("_component")
    )
    return marked.join(reached, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("_component")).alias("component_id")
    )


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the first document of each component, and of rows without an id.

    Rows that repeat an id are one document and stay together.
    """
    dropped = near_duplicates(df, doc_id, text).where("doc_id <> component_id").select(F.col("doc_id").alias(doc_id))
    return df.join(dropped.distinct(), doc_id, "left_anti").select(*df.columns)
