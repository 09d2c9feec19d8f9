import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import queries, token_files
from fieldgauge.llm.common import table
from fieldgauge.llm.tokens import LETTERS, Encoder, as_letters, distinct_words

SF = "/root/testdata/sf0.001"


def wanted(rows, vocab):
    tokenizer = Encoder(vocab).tokenizer
    at, found = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        found.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return found


def test_query_gives_the_library_s_ids(spark, vocab):
    docs = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect())
    got = queries.op2_token_files(spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == wanted(docs, vocab)


@pytest.mark.parametrize("encoding", token_files.ENCODINGS)
def test_odd_rows_round_trip(spark, vocab, tmp_path, encoding):
    rows = [(5, "again"), (3, None), (5, "again"), (1, ""), (9, "long word " * 20000), (7, "don't <|endoftext|> é")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, ids string, part int")
    path = f"{tmp_path}/{encoding}"
    token_files.write_tokens(df, path, vocab, encoding=encoding, row_group_bytes=1 << 20, page_bytes=4096)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids) for r in token_files.read_tokens(spark, path).collect())
    want = wanted(sorted(rows, key=lambda r: r[0]), vocab)
    assert [(d, s, n, zlib.crc32(np.array(i, "<u4").tobytes())) for s, d, n, i in got] == want
    assert "ids" not in token_files.read_metadata(spark, path).columns
    all_ids = [i for *_, ids in got for i in ids]
    span = token_files.read_span(spark, path, 4, 3000).orderBy("start").collect()
    assert [i for r in span for i in r.ids] == all_ids[4:3004]
    files = [f for f in (tmp_path / encoding / "tokens").glob("*.parquet") if pq.read_metadata(f).num_rows]
    column = pq.read_metadata(files[0]).row_group(0).column(4)
    kinds = set(column.encodings)
    assert ("DELTA_BINARY_PACKED" in kinds) == (encoding == "delta")
    assert any("DICTIONARY" in k for k in kinds) == (encoding == "dictionary")
    assert column.has_offset_index


def test_metadata_does_not_read_ids(spark, vocab, tmp_path):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    token_files.write_tokens(df, f"{tmp_path}/t", vocab)
    plan = token_files.read_metadata(spark, f"{tmp_path}/t").where("doc_id = 1")._jdf.queryExecution().toString()
    scan = plan[plan.index("== Physical Plan") :]
    assert "ids" not in scan and "EqualTo(doc_id,1)" in scan


def test_empty_table(spark, vocab, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_tokens(df, f"{tmp_path}/none", vocab)
    assert token_files.read_tokens(spark, f"{tmp_path}/none").count() == 0


def test_span_reads_few_rows(spark, vocab, tmp_path):
    """Bounds reach the reader as numbers, and pages outside the span are not read."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some words of a text " * 10).alias("text"))
    path = f"{tmp_path}/t"
    token_files.write_tokens(df, path, vocab, page_bytes=4096)
    all_ids = [i for r in token_files.read_tokens(spark, path).orderBy("start").select("ids").collect() for i in r.ids]
    for start, length in ((0, 1), (77_777, 500), (len(all_ids) - 3, 100), (40_000, 60_000), (-5, 10), (len(all_ids), 5), (9, 0)):
        span = token_files.read_span(spark, path, start, length)
        got = [i for r in span.orderBy("start").collect() for i in r.ids]
        assert got == all_ids[max(start, 0) : max(start + length, 0)]
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    try:
        plan = token_files.read_span(spark, path, 77_777, 500)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(part for part in plan.split("PushedFilters: ")[1:] if "part_start" in part)
    assert "GreaterThanOrEqual(part_start," in pushed and "LessThan(part_start," in pushed


def test_spans_over_files(spark, vocab, tmp_path):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), F.col("id").cast("int") % 7).alias("text"))
    path = f"{tmp_path}/t"
    # Otherwise so few rows end up in one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        token_files.write_tokens(df, path, vocab)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    all_ids = [i for r in token_files.read_tokens(spark, path).orderBy("start").select("ids").collect() for i in r.ids]
    assert spark.read.parquet(f"{path}/parts").count() > 1
    for start in range(0, len(all_ids), 97):
        span = token_files.read_span(spark, path, start, 350)
        assert [i for r in span.orderBy("start").collect() for i in r.ids] == all_ids[start : start + 350]


def test_words_seen_before_are_only_looked_up(vocab, monkeypatch):
    known = Encoder(vocab)
    texts = pa.array(["Alpha beta, naïve 日本 it's 's alpha", "", "beta alpha日 x<|y ÉÉ éé", "it's beta"], pa.large_string())
    want = [known.tokenizer.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    asked = []
    word = Encoder.word
    monkeypatch.setattr(Encoder, "word", lambda self, w: asked.append(w) or word(self, w))
    for limit in (known.memory, 0, known.memory):
        known.memory = limit
        for first, count in ((0, 4), (1, 1), (0, 1)):
            asked.clear()
            ids, bounds = known.encode(texts.slice(first, count))
            got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
            assert got == want[first : first + count]
    # Of the last texts, all but the word of two pieces is known as it is.
    assert asked == ["it's"]


def test_distinct_words_are_plain_strings():
    words, places, bounds = distinct_words(pa.array(["b A b", "", "ñ, 日"], pa.large_string()))
    assert [type(w) for w in words] == [str] * len(words)
    assert [[words[p] for p in places[a:b]] for a, b in zip(bounds, bounds[1:])] == [["b", "a", "b"], [""], ["ñ,", "日"]]
    assert distinct_words(pa.array([], pa.large_string()))[0] == []


def test_letters_of_bytes():
    for piece in ("abc", "é", "ß²", "日本", "\x80\xff"):
        assert as_letters(piece) == "".join(LETTERS[b] for b in piece.encode())
