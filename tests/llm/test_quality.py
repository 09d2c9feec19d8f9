import zlib

import numpy as np
import pytest

from fieldgauge.llm import quality, queries
from fieldgauge.llm.common import isotonic, table

SF = "/root/testdata/sf0.01"


def auc(labels, scores):
    good = [s for l, s in zip(labels, scores) if l]
    bad = [s for l, s in zip(labels, scores) if not l]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_held_out_accuracy(spark):
    rows = queries.op1_quality_classifier(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50
    assert auc([labels[r.doc_id] for r in held], [r.score for r in held]) > 0.97
    assert np.mean([labels[r.doc_id] == r.predicted for r in held]) > 0.95


def test_sums_over_tasks_are_the_whole_matrix(spark):
    rng = np.random.default_rng(0)
    numbers = rng.normal(size=(200, len(quality.STATISTICS)))
    width = len(quality.STATISTICS)
    model = quality.Model(np.zeros(width), np.ones(width), np.zeros(9), [], rng.normal(size=(width, 8)), rng.uniform(size=8))
    df = spark.createDataFrame([(row.tolist(), float(n % 2)) for n, row in enumerate(numbers)], "numbers array<double>, label double")
    got = quality._summed(df.repartition(7).mapInArrow(quality._equations(model), "row int, sums array<double>"))
    wave, label = model.features(numbers), np.arange(200) % 2
    assert np.allclose(got, np.concatenate([wave.T @ wave, [label @ wave]]))


def test_isotonic_against_all_cuts():
    rng = np.random.default_rng(3)
    for _ in range(30):
        n = rng.integers(1, 7)
        hits, counts = rng.integers(0, 4, n).astype(float), rng.integers(4, 6, n).astype(float)
        points = isotonic(list(range(n)), hits.tolist(), counts.tolist())
        shares = [s for _, s in points]
        assert shares == sorted(shares)
        # min-max formula of isotonic regression
        want = [
            max(min(hits[a : b + 1].sum() / counts[a : b + 1].sum() for b in range(i, n)) for a in range(i + 1))
            for i in range(n)
        ]
        assert set(np.round(want, 9)) == set(np.round(shares, 9))


def test_nulls_repeats_and_clashing_columns(spark):
    text = "Plain words in a row, as they come. " * 4
    rows = [(n, f"{text}{n}" if n % 3 else "$$$ !!! " * 30) for n in range(300)] + [(None, text), (400, None), (400, None), (401, ""), (402, "x" * 300_000)]
    df = spark.createDataFrame([(*r, 0.0, 1) for r in rows], "doc_id long, text string, score double, label int")
    labels = spark.createDataFrame(
        [(n, int(n % 3 > 0)) for n in range(200)] + [(5, None), (6, 7), (None, 1), (7, 1), (7, 1)], "doc_id long, quality int"
    )
    model = quality.fit(df, labels)
    got = quality.scored(df, model).collect()
    assert len(got) == len(rows)
    assert all(r.score > 0.5 if r.doc_id % 3 else r.score < 0.3 for r in got if r.doc_id is not None and 200 <= r.doc_id < 300)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    assert quality.scored(df.limit(0), model).count() == 0
    unknown = quality.fit(df, labels.limit(0))
    assert {(r.score, r.predicted) for r in quality.scored(df, unknown).collect()} == {(0.5, 1)}


@pytest.mark.parametrize("text", ["", " ", "\n\n", "é", "a" * 10, "日本語 text"])
def test_statistics_of_odd_texts(text):
    numbers = quality.statistics(text)
    assert len(numbers) == len(quality.STATISTICS) and np.isfinite(numbers).all()
