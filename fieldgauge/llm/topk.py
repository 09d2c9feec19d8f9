"""Exact top-k by inner product with a vector-approximation file.

Vectors of whole numbers lie in blocks. Of each block there is an approximation: per
dimension the block's range is cut into cells of equal width, and a vector is the list of
its cells' numbers, four bits each. A scan over the cells gives for each query and vector
the lowest and the highest score that is possible. Exact vectors are then read in the
order of the highest possible score, until the k-th result so far is above all bounds that
are left. The k best of each block are merged per query.

Queries go through in parts of a bounded number, one after the other, each against all
blocks of vectors; the vectors are never shuffled. Of the queries the driver holds one part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch
from .common import bound_batches, stored

SCALE = 256
CELLS = 16
BLOCK_ROWS = 4096
QUERY_ROWS = 4096
QUERIES_AT_ONCE = 128
READ = 64
# Sums of products below this are exact in a double.
EXACT = 2.0**52

RESULT = ("query_id", "rank", "vec_id", "score")
BLOCKS = (
    "dim int, rows int, ids binary, low binary, width binary, cells binary, exact binary"
)


def whole_vectors(ids: pa.Array, vectors: pa.Array, scale: int):
    """(dim, ids, whole numbers) per length, without vectors that take no part."""
    raw = [(i, v) for i, v in zip(ids.to_pylist(), vectors) if i is not None and v.is_valid]
    by_size: dict[int, list] = {}
    for vec_id, vector in raw:
        values = vector.values
        if values.null_count == 0:
            by_size.setdefault(len(values), []).append((vec_id, values.to_numpy(zero_copy_only=False)))
    for dim, own in by_size.items():
        matrix = np.array([v for _, v in own], np.float64).reshape(len(own), dim)
        good = np.isfinite(matrix).all(axis=1)
        if good.any():
            yield dim, np.array([i for i, _ in own], np.int64)[good], np.floor(scale * matrix[good])


def make_blocks(scale: int, block_rows: int):
    def run(batches):
        for batch in batches:
            for dim, ids, numbers in whole_vectors(batch.column(0), batch.column(1), scale):
                for at in range(0, len(ids), block_rows):
                    own, vec_ids = numbers[at : at + block_rows], ids[at : at + block_rows]
                    low = own.min(axis=0)
                    width = np.maximum(np.ceil((own.max(axis=0) - low + 1) / CELLS), 1)
                    cells = np.clip((own - low) // width, 0, CELLS - 1).astype(np.uint8)
                    if dim % 2:
                        cells = np.pad(cells, ((0, 0), (0, 1)))
                    packed = cells[:, ::2] << 4 | cells[:, 1::2]
                    values = [dim, len(vec_ids), vec_ids, low, width, packed, own]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v if isinstance(v, int) else v.tobytes()], t) for v, t in zip(values, [pa.int32()] * 2 + [pa.binary()] * 5)],
                        ["dim", "rows", "ids", "low", "width", "cells", "exact"],
                    )

    return run


def vector_blocks(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The vector-approximation file, one row per block.

    Vectors that are null, hold a null or a value that is not finite, or have no id are
    left out. Vectors of different lengths lie in different blocks.
    """
    bound_batches(df.sparkSession)
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    return stored(rows.mapInArrow(make_blocks(scale, block_rows), BLOCKS), "vector-blocks")


def cell_bounds(cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each vector's cell in each dimension."""
    dim = len(low)
    both = np.stack([cells >> 4, cells & 15], axis=2).reshape(len(cells), -1)[:, :dim]
    least = low + both * width
    return least, least + width - 1


def nearest_in_block(queries, query_ids, row, k: int):
    """(query, vec_id, score) of the k best of a block for each query."""
    dim, rows = row["dim"], row["rows"]
    ids = np.frombuffer(row["ids"], np.int64)
    low, width = (np.frombuffer(row[c]) for c in ("low", "width"))
    cells = np.frombuffer(row["cells"], np.uint8).reshape(rows, -1)
    exact = np.frombuffer(row["exact"]).reshape(rows, dim)
    least, most = cell_bounds(cells, low, width)
    reach = max(np.abs(least).max(initial=0), np.abs(most).max(initial=0))
    found = []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries[at : at + QUERIES_AT_ONCE]
        rising, falling = np.maximum(some, 0), np.minimum(some, 0)
        small = dim * reach * np.abs(some).max(initial=0) < EXACT
        if small:
            lower = rising @ least.T + falling @ most.T
            upper = rising @ most.T + falling @ least.T
        for n, query in enumerate(some):
            others = ids != query_ids[at + n]
            if not others.any():
                continue
            if not small:
                # Beyond what doubles hold exactly, whole numbers of any size; scores are
                # first cut to the range of a long, then ranked.
                whole = [int(v) for v in query]
                scores = [sum(a * int(b) for a, b in zip(whole, vector)) for vector in exact]
                scores = [min(max(s, -(2**63)), 2**63 - 1) for s in scores]
                ranked = sorted((-s, int(ids[m])) for m, s in enumerate(scores) if others[m])[:k]
                found += [(query_ids[at + n], i, -s) for s, i in ranked]
                continue
            own_lower = lower[n][others]
            sure = np.partition(own_lower, len(own_lower) - k)[len(own_lower) - k] if len(own_lower) > k else -np.inf
            candidates = np.flatnonzero(others & (upper[n] >= sure))
            candidates = candidates[np.argsort(-upper[n][candidates], kind="stable")]
            best_score, best_id = np.empty(0), np.empty(0, np.int64)
            start, size = 0, READ
            while start < len(candidates):
                # An equal score could still win by its smaller id.
                if len(best_score) == k and best_score[-1] > upper[n][candidates[start]]:
                    break
                read = candidates[start : start + size]
                best_score = np.concatenate([best_score, exact[read] @ query])
                best_id = np.concatenate([best_id, ids[read]])
                order = np.lexsort((best_id, -best_score))[:k]
                best_score, best_id = best_score[order], best_id[order]
                start, size = start + size, 2 * size
            found += [(query_ids[at + n], i, int(s)) for i, s in zip(best_id.tolist(), best_score)]
    return found


def search(queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """queries: by dimension the ids and the vectors."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if row["dim"] not in queries:
                    continue
                ids, vectors = queries[row["dim"]]
                found = nearest_in_block(vectors, ids, row, k)
                columns = list(zip(*found)) or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
                )

    return run


def top_k(
    blocks: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all vectors but the query's own id.

    Ties go to the smaller vec_id. Queries that take no part give no rows; with fewer than
    k other vectors of the same length all of them come. Rows that repeat an id are
    vectors of their own as candidates; a repeated query is answered once.
    """
    known = queries.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(
        "vec_id is not null"
    )
    spark, path = blocks.sparkSession, scratch(blocks.sparkSession, "nearest")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    parts = max(1, -(-known.count() // query_rows))
    for n in range(parts):
        part = known.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == n).dropDuplicates(["vec_id"]).toArrow()
        part = part.combine_chunks()
        own = {
            dim: (ids, numbers)
            for dim, ids, numbers in whole_vectors(part.column(0), part.column(1).combine_chunks(), scale)
        }
        found = blocks.mapInArrow(search(own, k), "query_id long, vec_id long, score long")
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        # Written before the next part is fetched, so the driver and the plans hold one.
        best.select(*RESULT).write.mode("append").parquet(path)
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(path)
