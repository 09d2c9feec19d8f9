import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from fieldgauge.llm import queries, toxicity
from fieldgauge.llm.common import table

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = queries.op8_toxicity(spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert all(zlib.crc32(str(e).encode()) % 4 != 2 and e in labels for e in r.evidence)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    toxic = [r.predicted for r in held if labels[r.doc_id]]
    clean = [r.predicted for r in held if not labels[r.doc_id]]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.03
    # Calibration: of the documents scored high about as many are toxic as the scores say.
    high = [r for r in held if r.score > 0.5]
    assert abs(np.mean([labels[r.doc_id] for r in high]) - np.mean([r.score for r in high])) < 0.12


def test_neighbours_against_all_examples():
    rng = random.Random(4)
    idf = np.array([rng.uniform(1, 5) for _ in range(30)])
    vector = lambda: toxicity.unit_vector(Counter(rng.choices(range(30), k=rng.randint(0, 8))), idf)
    vectors = [vector() for _ in range(700)]
    index = toxicity.Index(vectors, [rng.randint(0, 1) for _ in vectors], list(range(700)), 30, block=16)
    for _ in range(60):
        query = vector()
        own = dict(query)
        cosines = [sum(own.get(t, 0) * w for t, w in v) for v in vectors]
        want = sorted(((-round(c, 12), n) for n, c in enumerate(cosines) if c > 0))[:15]
        assert [(-round(c, 12), n) for c, n in index.nearest(query, 15)] == want


def test_nulls_repeats_and_clashing_columns(spark):
    rng = random.Random(1)
    words = [f"w{n}" for n in range(200)]
    text = lambda n: " ".join(rng.choices(words, k=20) + (["Nasty!"] if n % 4 == 0 else []))
    rows = [(n, text(n)) for n in range(600)] + [(None, "nasty"), (700, None), (700, None), (701, ""), (704, "word " * 80000 + "nasty")]
    df = spark.createDataFrame([(*r, 0.0, "x") for r in rows], "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame(
        [(n, int(n % 4 == 0)) for n in range(400)] + [(5, None), (6, 9), (None, 1), (8, 1), (8, 1)], "doc_id long, toxic int"
    )
    model = toxicity.fit(df, labels)
    assert "nasty" in model.words
    got = toxicity.scored(df, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.predicted == int(r.doc_id is None or r.doc_id % 4 == 0 and r.doc_id not in (700,))
    assert toxicity.scored(df.limit(0), model).count() == 0
    unknown = toxicity.fit(df, labels.limit(0))
    assert all(abs(r.score - 0.5) < 1e-3 for r in toxicity.scored(df, unknown).collect())


def test_small_sample_is_the_same_for_any_order(spark):
    df, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    a = toxicity.fit(df, labels, sample=500, examples=100)
    b = toxicity.fit(df.repartition(5), labels.repartition(3), sample=500, examples=100)
    assert a.words == b.words and a.index.vectors == b.index.vectors and a.points == b.points
    texts = pa.array(["you idiot", "", "clown moron clown"], pa.large_string())
    assert a.votes(texts) == b.votes(texts)


def test_only_checked_copies_are_left_out(spark):
    rng = random.Random(6)
    text = lambda: " ".join(["extraordinary", *(f"w{rng.randrange(500)}" for _ in range(60))])
    one, other = text(), text()
    near = one.split()
    near[30] = "changed"
    rows = [(1, one, 1), (2, other, 1), (3, one, 1), (4, " ".join(near), 1), (5, one, 0), (6, "", 0), (7, None, 0), (8, "few", 0)]
    found = spark.createDataFrame(rows, "_id long, text string, label int").withColumn("kind", toxicity.kind_of_text("text"))
    assert found.where("_id < 6").select("kind").distinct().count() == 1
    kept = toxicity.without_copies(found).collect()
    assert sorted(r._id for r in kept) == [1, 2, 5, 6, 8]
