import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import queries, topk

SF = "/root/testdata/sf0.01"


def plain(rows, wanted, k=5):
    vectors = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = set()
    for q, a in {i: v for i, v in vectors if i in wanted}.items():
        cut = lambda s: min(max(s, -(2**63)), 2**63 - 1)
        scores = sorted((-cut(sum(x * y for x, y in zip(a, b))), i) for i, b in vectors if i != q and len(a) == len(b))
        found |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return found


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(queries.ORACLE["op9_exact_top_k"]).fetchall()
    got = queries.op9_exact_top_k(spark, SF)
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert len(want) == 50


@pytest.mark.parametrize("block_rows, query_rows, dim", [(7, 3, 5), (4096, 4096, 8)])
def test_ties_nulls_and_lengths(spark, block_rows, query_rows, dim):
    rng = random.Random(dim)
    rows = [(n, [rng.choice([-0.5, 0.25, 0.1, 0.9]) for _ in range(dim)]) for n in range(120)]
    rows += [(n, [0.5] * dim) for n in range(200, 260)] + [(n, [1.0, 2.0]) for n in (300, 301, 302)]
    rows += [(400, None), (401, [None] * dim), (402, [float("nan")] * dim), (403, [float("inf")] * dim), (None, [0.5] * dim)]
    rows += [(500, []), (501, []), (600, [1.0] * 11)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    asked = df.where("vec_id % 10 = 0 or vec_id in (500, 402, 301)")
    got = topk.top_k(topk.vector_blocks(df, block_rows=block_rows), asked, query_rows=query_rows)
    wanted = {i for i, _ in rows if i is not None and (i % 10 == 0 or i in (301, 402))}
    rows32 = [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert {tuple(r) for r in got.collect()} == plain(rows32, wanted)


def test_numbers_beyond_doubles(spark):
    rows = [(n, [float(2**20 + n), -float(2**19) * n, 3.0]) for n in range(9)] + [(n, [float(2**30 + n), n, 1.0]) for n in (20, 21)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.top_k(topk.vector_blocks(df), df.where("vec_id in (5, 20)"), k=3).collect()}
    assert got == plain(rows, {5, 20}, 3)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.vector_blocks(df), df).count() == 0


def test_bounds_hold_and_most_vectors_are_not_read():
    rng = np.random.default_rng(1)
    numbers = np.floor(256 * rng.normal(0, 0.1, (2000, 64)))
    low = numbers.min(axis=0)
    width = np.maximum(np.ceil((numbers.max(axis=0) - low + 1) / topk.CELLS), 1)
    cells = ((numbers - low) // width).astype(np.uint8)
    least, most = topk.cell_bounds(cells[:, ::2] << 4 | cells[:, 1::2], low, width)
    assert (least <= numbers).all() and (numbers <= most).all()
    upper = np.maximum(numbers[0], 0) @ most.T + np.minimum(numbers[0], 0) @ least.T
    kth = np.sort(numbers[1:] @ numbers[0])[-5]
    assert (upper >= kth).mean() < 0.5
