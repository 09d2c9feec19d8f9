import pytest
from test_decontaminate import plain as plain_leaks
from test_line_dedup import kept as kept_lines
from test_line_dedup import plain as plain_lines
from test_packing import check_layout
from test_packing import wanted as plain_pieces
from test_simhash import plain_components, plain_fingerprint

import corpus_pipeline
from fieldgauge.llm import line_dedup, queries
from fieldgauge.llm.common import stored, table
from fieldgauge.llm.token_files import ids_crc32

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage."""
    docs, found = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), "stage")
        found[name] = docs, after
        docs = after
    return found


def texts(df):
    rows = df.select("doc_id", "text").collect()
    found = {r.doc_id: r.text for r in rows}
    assert len(found) == len(rows)
    return found


def test_columns_and_order(spark, stages):
    assert list(stages) == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"
    ]
    columns = table(spark, SF, "documents").columns
    for name, (_, after) in stages.items():
        if name != "best-fit packing":
            assert after.columns == columns


def test_quality_rejects_what_the_operator_rejects(spark, stages):
    before, after = stages["quality classifier"]
    predicted = {r.doc_id: r.predicted for r in queries.op1_quality_classifier(spark, SF).collect()}
    assert set(texts(after)) == {d for d in texts(before) if predicted[d]}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good = {d for d in texts(before) if labels.get(d) == 1}
    assert len(good - set(texts(after))) <= 0.02 * len(good)


def test_lines(stages):
    before, after = stages["line dedup"]
    docs = texts(before)
    assert texts(after) == kept_lines(docs, plain_lines(docs, line_dedup.WORDS))


def test_near_copies(stages):
    before, after = stages["SimHash near-dedup"]
    docs = texts(before)
    first = plain_components({d: plain_fingerprint(t) for d, t in docs.items()})
    assert texts(after) == {d: t for d, t in docs.items() if first[d] == d}


def test_contaminated(spark, stages):
    before, after = stages["benchmark decontamination"]
    docs = texts(before)
    leaks = {d for d, _ in plain_leaks({d: t for d, t in docs.items() if len(t) < 1500}, texts_of_items(spark))}
    kept = texts(after)
    assert leaks and not leaks & set(kept)
    assert all(kept[d] == docs[d] for d in kept)
    assert {d for d in docs if d not in kept and len(docs[d]) < 1500} == leaks


def texts_of_items(spark):
    return {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}


def test_packing(spark, stages, vocab):
    before, after = stages["best-fit packing"]
    rows = after.withColumn("crc", ids_crc32("ids")).collect()
    got = sorted(((r.doc_id, r.piece, r.start, r.length, r.crc) for r in rows), key=str)
    assert got == plain_pieces(list(texts(before).items()), vocab, 4096)
    check_layout(rows, 4096)


def test_run_gives_the_last_stage(spark, stages):
    key = lambda df: sorted((r.doc_id, r.piece, r.length) for r in df.select("doc_id", "piece", "length").collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages["best-fit packing"][1])


def odd_documents(spark):
    """Nulls in any column, empty and very long texts, repeated rows, names that clash."""
    item = next(iter(texts_of_items(spark).values()))
    rows = [
        (None, "a text without an id, of some words in a row", "en", None, 5),
        (1, None, None, "s", None),
        (2, "", "en", "s", 0),
        (2, "", "en", "s", 0),
        (3, "word " * 250_000, "en", "s", 1),
        (4, "w" * 1_000_000, "en", "s", 1),
        (5, "The first line of this text has some words.\nAnd the second one has others.", "en", "s", 1),
        (6, "The first line of this text has some words.\nAnd the second one has others.", "de", "t", 2),
        (7, f"Before it. {item} After it.", "en", "s", 3),
        (8, "  \n\t\n .,;", "en", "s", 4),
    ]
    own = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    clashing = ["_gone_id", "who", "label", "score", "first", "ids", "component_id", "fp", "found", "words", "_id"]
    return own.selectExpr("*", *[f"{n} AS {name}" for n, name in enumerate(clashing)])


@pytest.mark.parametrize("number", range(5))
@pytest.mark.parametrize("empty", [False, True])
def test_stages_with_odd_rows(spark, number, empty):
    docs = odd_documents(spark)
    docs = docs.limit(0) if empty else docs
    name, stage = corpus_pipeline.STAGES[number]
    after = stage(spark, docs, SF)
    rows = after.collect()
    if name != "best-fit packing":
        assert after.columns == docs.columns
        before = docs.select("doc_id", "text").collect()
        assert len(rows) <= len(before) and {r.doc_id for r in rows} <= {r.doc_id for r in before}
    if empty:
        assert rows == []
    elif name == "line dedup":
        found = {r.doc_id: r.text for r in rows}
        assert len(rows) == 10 and found[6] == "" and found[1] is None and found[5] == before[6].text
    elif name == "SimHash near-dedup":
        # The null and the two empty texts are one group; 5 and 6 are copies.
        assert sorted(str(r.doc_id) for r in rows) == ["1", "3", "4", "5", "7", "8", "None"]
    elif name == "benchmark decontamination":
        assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "2", "3", "4", "5", "6", "8", "None"]
    elif name == "best-fit packing":
        check_layout(rows, 4096)
        assert {str(r.doc_id) for r in rows} == {"1", "2", "3", "4", "5", "6", "7", "8", "None"}
