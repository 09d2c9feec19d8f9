"""Files that let readers skip, compaction in place, the JSON document, frequent values."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.functions.bits import interleave, scaled, spread_bits
from fieldgauge.operators import latest, lines
from fieldgauge.sources import archive, exports
from fieldgauge.sources.change_log import ChangeLog


def scans(df):
    """Run a frame; rows that its scans put out, after row groups and pages were skipped."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            yield from walk(node.plan())
        elif name == "FileSourceScanExec":
            yield node.metrics().get("numOutputRows").get().value()
        else:
            children = node.children()
            for i in range(children.size()):
                yield from walk(children.apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


# ---- clustering


def test_interleaved_bits(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(1 << 31), rng.randrange(1 << 31)) for _ in range(200)] + [(0, 0), ((1 << 31) - 1, 0), (0, (1 << 31) - 1)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", interleave(F.col("a"), F.col("b")).alias("z"), spread_bits(F.col("a")).alias("s"))
    for r in df.collect():
        want = 0
        for bit in range(31):
            want |= ((r.a >> bit) & 1) << (2 * bit + 1) | ((r.b >> bit) & 1) << (2 * bit)
        assert r.z == want and r.s == sum(((r.a >> b) & 1) << (2 * b) for b in range(31))


def test_scaled_bounds(spark):
    df = spark.createDataFrame([(5,), (10,), (15,), (20,), (None,), (99,), (-7,)], "n long")
    got = [r[0] for r in df.select(scaled(F.col("n"), 5, 20, 4)).collect()]
    assert got == [0, 5, 10, 15, None, 15, 0]
    assert [r[0] for r in df.select(scaled(F.col("n"), 5, 5)).limit(1).collect()] == [0]


SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("station_id", "status_timestamp", "n")])


def test_slices_inside_a_month(spark, tmp_path):
    first = 1704067200
    rows = spark.range(400_000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("station_id"),
        (F.lit(first) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(30 * 86400))).alias("status_timestamp"),
        F.col("id").alias("n"),
    )
    archive.write_clustered(archive.with_partitions(rows), str(tmp_path / "z"), files=4, page_rows=1000)
    clustered = archive.read_clustered(spark, str(tmp_path / "z"), SPAN)
    assert clustered.count() == 400_000
    for stations, seconds in (((100, 120), (first + 86400, first + 3 * 86400)), ((7, 7), (first, first + 30 * 86400)), ((0, 999), (first, first + 7200))):
        span = archive.read_span(clustered, stations, seconds)
        want = rows.where(F.col("station_id").between(*stations) & F.col("status_timestamp").between(*seconds))
        assert sorted(r.n for r in span.collect()) == sorted(r.n for r in want.collect())
        read = sum(scans(span))
        assert want.count() <= read <= 40_000


def test_clustering_odd_rows(spark, tmp_path):
    rows = [(None, 1704067200, 1), (3, 1704067200, 2), (3, 1704067200, 2), (2**62, 1709251200, 3), (-5, 1709251200, 4)]
    df = archive.with_partitions(spark.createDataFrame(rows, SPAN))
    archive.write_clustered(df, str(tmp_path / "z"))
    back = archive.read_clustered(spark, str(tmp_path / "z"), SPAN)
    assert sorted(r.n for r in back.collect()) == [1, 2, 2, 3, 4]
    assert [r.n for r in archive.read_span(back, (-10, 5), (1709251200, 1709251200)).collect()] == [4]
    archive.write_clustered(df.limit(0), str(tmp_path / "none"))
    assert archive.read_clustered(spark, str(tmp_path / "none"), SPAN).collect() == []


# ---- small files


def files_below(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_full_files_stay(spark, tmp_path):
    path, schema = str(tmp_path / "a"), T.StructType([T.StructField(n, T.LongType()) for n in ("station_id", "n")])
    rows = lambda station, count, start: spark.range(start, start + count).select(
        F.lit(station).cast("bigint").alias("station_id"), F.col("id").alias("n"), F.lit(2024).alias("year"), F.lit("05").alias("month")
    )
    archive.write_archive(rows(1, 200_000, 0).coalesce(1), path, batch="big", gather=False)
    for batch in range(6):
        archive.write_archive(rows(1, 50, 1_000_000 + 100 * batch), path, batch=f"b{batch}")
        archive.write_archive(rows(2, 50, 2_000_000 + 100 * batch), path, batch=f"b{batch}")
    archive.write_archive(rows(3, 10, 3_000_000), path, batch="alone")
    before = files_below(path)
    want = sorted((r.station_id, r.n) for r in archive.read_archive(spark, path, schema).collect())
    gone = archive.merge_small_files(spark, path, schema, file_bytes=400_000)
    after = files_below(path)
    assert gone == 12
    # The full file and the one that is alone in its folder keep their names and content.
    kept = {f for f in before if "batch=big" in f or "batch=alone" in f}
    assert len(kept) == 2 and {f: before[f] for f in kept} == {f: after[f] for f in kept if f in after}
    assert len(after) == 4
    assert sorted((r.station_id, r.n) for r in archive.read_archive(spark, path, schema).collect()) == want
    # Nothing left to do.
    assert archive.merge_small_files(spark, path, schema, file_bytes=400_000) == 0
    assert files_below(path) == after


def test_merging_in_several_jobs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "FILES_AT_ONCE", 3)
    path, schema = str(tmp_path / "a"), T.StructType([T.StructField(n, T.LongType()) for n in ("station_id", "n")])
    for batch in range(3):
        rows = spark.range(40).select((F.col("id") % 4).alias("station_id"), (F.col("id") + 100 * batch).alias("n"), F.lit(2024).alias("year"), F.lit("01").alias("month"))
        archive.write_archive(rows, path, batch=f"b{batch}")
    assert archive.merge_small_files(spark, path, schema) == 12
    assert len(files_below(path)) == 4
    assert archive.read_archive(spark, path, schema).count() == 120


# ---- look-ups


def event_log(spark, path):
    """Four batches with interleaved keys, each in one row group."""
    log = ChangeLog(spark, path)
    for batch in range(4):
        rows = spark.range(20_000).where(F.col("id") % 4 == batch).select(
            F.format_string("k%06d", "id").alias("key"), F.lit("v").alias("value"), F.col("id").alias("version")
        )
        log.append(rows.coalesce(1), batch)
    return log


def test_bloom_filters_skip_batches(spark, tmp_path):
    view = event_log(spark, str(tmp_path / "log")).rebuild()
    keys = [f"k{4 * i + 2:06d}" for i in range(5)]
    found = latest.lookup_list(view, "key", [*keys, "k999999", "absent"])
    assert sorted(r.key for r in found.collect()) == keys
    # All four batches have the keys between their least and greatest; one holds them.
    assert sum(scans(latest.lookup_list(view, "key", keys))) == 5_000


def test_runtime_filter_for_many_keys(spark, tmp_path):
    log = event_log(spark, str(tmp_path / "log"))
    log.compact((0, 1))
    wanted = spark.range(30_000).select(F.format_string("k%06d", "id").alias("key"), (F.col("id") % 1000).alias("kind"))
    wanted.write.parquet(str(tmp_path / "wanted"))
    chosen = spark.read.parquet(str(tmp_path / "wanted")).where("kind = 7")
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = latest.lookup_many(log.rebuild(), "key", chosen)
        rows = found.collect()
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert sorted(r.key for r in rows) == [f"k{i:06d}" for i in range(7, 20_000, 1000)]
    # Below the aggregate, so on the scans of the snapshot and of the batches.
    assert plan.count("might_contain") == 2 and plan.index("Aggregate") < plan.index("might_contain")


def test_lookup_of_nothing(spark, tmp_path):
    view = event_log(spark, str(tmp_path / "log")).rebuild()
    none = spark.createDataFrame([(None,)], "k string")
    assert latest.lookup_many(view, "key", none, "k").collect() == []
    assert latest.lookup_list(view, "key", []).collect() == []


# ---- the JSON document


def document(path):
    return "".join(open(f"{path}/{name}", encoding="utf-8").read() for name in sorted(os.listdir(path)) if not name.startswith(("_SUCCESS", ".")))


@pytest.mark.parametrize("files", [None, 1, 7, 64])
def test_document_in_parts(spark, tmp_path, files):
    rows = [(f"k{i}", f'{{"n": {i}, "t": "a\\"b"}}') for i in range(50)]
    rows += [("plain", "no object, but {"), ("none", None), ('quo"te\n', "x\ny"), ("", "[1]"), ("ключ", '{"é": 1}'), (None, "{}"), (",", ",")]
    path = str(tmp_path / "doc")
    exports.write_json_document(spark.createDataFrame(rows, "key string, value string"), path, files=files)
    loaded = json.loads(document(path), object_pairs_hook=lambda pairs: pairs)
    assert len(loaded) == len(rows)
    got = {k: dict(v) if isinstance(v, list) else v for k, v in loaded}
    want = {}
    for key, value in rows:
        is_object = value is not None and value.startswith("{")
        want["null" if key is None else key] = json.loads(value) if is_object else value
    assert got == want
    back = {r.key: r.value for r in exports.read_json_document(spark, path).collect()}
    assert set(back) == set(want) and back["none"] is None and back["plain"] == "no object, but {"


def test_empty_document(spark, tmp_path):
    path = str(tmp_path / "doc")
    exports.write_json_document(spark.createDataFrame([], "key string, value string"), path)
    assert json.loads(document(path)) == {}
    assert exports.read_json_document(spark, path).collect() == []
    with pytest.raises(ValueError):
        exports.write_json_document(spark.createDataFrame([], "key string, value string"), path, files=100_000)


# ---- frequent values


def test_sketched_top_k(spark):
    rng = random.Random(3)
    values = [f"v{int(rng.paretovariate(0.6))}" for _ in range(20_000)] + [None] * 50 + [f"once{i}" for i in range(5_000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(6)
    for k, buckets in ((1, 64), (10, 64), (10, 4096), (40, 3), (5, 1)):
        assert lines.top_k_sketched(df, "v", k, buckets).collect() == lines.top_k(df, "v", k).collect()


def test_sketched_top_k_without_frequent_values(spark):
    few = spark.createDataFrame([("a",), ("b",), ("a",)], "v string")
    assert [tuple(r) for r in lines.top_k_sketched(few, "v").collect()] == [("a", 2), ("b", 1)]
    flat = spark.range(3_000).select(F.col("id").cast("string").alias("v"))
    assert lines.top_k_sketched(flat, "v", 7, 256).collect() == lines.top_k(flat, "v", 7).collect()
    assert lines.top_k_sketched(flat.limit(0), "v").collect() == []
