import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldgauge.llm import fill_middle as fm
from fieldgauge.llm import queries


def offsets(text):
    return np.cumsum([0] + [len(c.encode()) for c in text]).tolist()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=300), st.sampled_from([1, 3, 100]))
def test_every_boundary(text, error):
    index = fm.RankIndex.fit(text.encode(), error)
    assert index.n == len(text)
    assert [index.offset(i) for i in range(len(text) + 1)] == offsets(text)


def test_segments_over_blocks(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(fm, "BLOCK", 1000)
    monkeypatch.setattr(fm, "TRIAL", 4)
    for error in (1, 10, 100):
        text = "".join(rng.choice(["a" * 40, "é" * 9, "日本" * 30, "🙂", "x日"]) for _ in range(400))
        index = fm.RankIndex.fit(text.encode(), error)
        assert [index.offset(i) for i in range(len(text) + 1)] == offsets(text)
        residuals = np.frombuffer(index.residuals, np.int8)
        assert np.abs(residuals).max() <= error + 1 and len(residuals) == len(text) + 1
    # Plain ASCII is one line.
    monkeypatch.undo()
    assert len(fm.RankIndex.fit(b"a" * 900_000).ranks) == 1


def transformed(doc_id, text, salt="1:", plain=10, spm=20):
    """The transformation over a list of characters."""
    text = text or ""
    digits = hashlib.sha256(f"{salt}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < spm else "psm"
    return n, form, a, b - a, f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def odd_rows():
    rng = random.Random(4)
    pieces = ["a", "<", "P>", "S", ">", "M>", "é", "日", "🙂", "́", "\x00", "\n", "<P", "<S"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(1, "again"), (1, "again"), (None, "no id"), (1000, None), (1001, "")]
    return rows + [(2000 + n, "é日" * 100_000 + "x" * 900_000) for n in range(2)]


@pytest.mark.parametrize("shares", [(10, 20), (0, 0), (0, 100), (100, 0)])
def test_against_characters(spark, shares):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, form string, fill_middle string")
    got = (
        fm.with_fill_middle(df, plain_share=shares[0], spm_share=shares[1])
        .select("doc_id", "text", "form", "fill_middle", fm.restore("fill_middle.output", "fill_middle.form").alias("again"))
        .collect()
    )
    assert len(got) == len(rows)
    want = sorted(((r[0], r[1] or "", transformed(*r, "1:", *shares)) for r in rows), key=repr)
    assert sorted(((r.doc_id, r.text or "", tuple(r.fill_middle)) for r in got), key=repr) == want
    assert all(r.again == (r.text or "") and r.form == "x" for r in got)


def test_stored_index(spark):
    rows = [(n, "aé日🙂" * n, n) for n in range(60)] + [(100, None, 0), (101, "x", 2), (102, "x", -1), (103, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, cut long")
    got = df.withColumn("index", fm.rank_index("text")).withColumn("at", fm.boundary_offset("index", "cut")).collect()
    for r in got:
        ends = offsets(r.text or "")
        assert r.at == (ends[r.cut] if r.cut is not None and 0 <= r.cut < len(ends) else None)


def test_empty_table_and_salt(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fm.with_fill_middle(empty).collect() == []
    df = spark.createDataFrame([("key", "some text here")], "doc_id string, text string")
    row = fm.with_fill_middle(df, salt="2:", plain_share=0).first()
    assert tuple(row.fill_middle) == transformed("key", "some text here", "2:", 0)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op13_fill_middle(spark, sf).collect()
    assert len(rows) == len(docs)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for r in rows:
        n, form, a, m, output = transformed(r.doc_id, docs[r.doc_id])
        assert tuple(r) == (r.doc_id, n, form, a, m, sha(output), sha(docs[r.doc_id]))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
