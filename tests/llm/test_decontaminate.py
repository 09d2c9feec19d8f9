import random
import re

import numpy as np
import pytest

from fieldgauge.llm import decontaminate as dc
from fieldgauge.llm import queries
from fieldgauge.llm.common import table

SF = "/root/testdata/sf0.001"


def words(text):
    return re.sub(r"[\x00-\x7f]", lambda m: m[0] if m[0].isalnum() else " ", (text or "").lower()).split()


def plain_score(item, doc):
    """Smith-Waterman, one cell at a time."""
    best, before = 0, [0] * (len(doc) + 1)
    for a in item:
        now = [0]
        for n, b in enumerate(doc):
            now.append(max(0, before[n] + (2 if a == b else -1), before[n + 1] - 1, now[n] - 1))
        best, before = max(best, *now), now
    return best / (2 * len(item))


def plain(docs, items, threshold=dc.THRESHOLD):
    found = {}
    for d, text in docs.items():
        for i, item in items.items():
            if words(item) and words(text) and (s := plain_score(words(item), words(text))) >= threshold:
                found[d, i] = s
    return found


def test_query_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").where("length(text) < 1500").collect()}
    items = {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}
    got = {(r.doc_id, r.item_id): r.score for r in queries.op5_decontamination(spark, SF).collect()}
    want = plain(docs, items)
    assert {k: s for k, s in got.items() if k[0] in docs} == want
    assert want


@pytest.mark.parametrize("block_words", [60, 10**6])
def test_edited_copies(spark, block_words):
    rng = random.Random(3)
    vocabulary = [f"w{n}" for n in range(300)] + ["the", "of", "and"] * 40
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {n: " ".join(text(rng.randint(25, 45))) for n in range(8)} | {8: "Tiny item!", 9: "", 10: "one"}
    docs = {}
    for d in range(120):
        body = text(rng.randint(0, 150))
        if d % 3 == 0:
            copy = items[rng.randrange(8)].split()
            for _ in range(rng.randint(0, 6)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 2)
            body[50:50] = [w.upper() + "," for w in copy]
        if d % 10 == 0:
            body += ["tiny", "Item"]
        docs[d] = " ".join(body)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    its = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = dc.contaminated(df, its, block_words=block_words).collect()
    got = {(r.doc_id, r.item_id): r.score for r in rows}
    want = plain(docs, items)
    assert {k[0] for k in want} >= set(range(0, 120, 10))
    # Of copies with so many changes that no seed is left, none has a high score.
    assert set(got) <= set(want)
    assert all(s < 0.7 for k, s in want.items() if k not in got)
    assert all(abs(got[k] - want[k]) < 0.08 and got[k] <= want[k] for k in got)
    for r in rows:
        part = words(docs[r.doc_id])[r.first_word : r.last_word + 1]
        assert plain_score(words(items[r.item_id]), part) == r.score

@pytest.mark.parametrize("copies", [1, 40])
def test_every_edited_copy_at_the_threshold(spark, copies):
    rng = random.Random(11)
    vocabulary = [f"w{n}" for n in range(2000)] + ["the", "of", "and"] * 200
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {n: text(size) for n, size in enumerate([20, 40, 80, 7, 30])}
    docs = {}
    for i, item in items.items():
        for every in (5, 4, 3):
            changed = [f"x{n}" if n % every == every - 1 else w for n, w in enumerate(item)]
            for _ in range(copies):
                docs[len(docs)] = text(30) + changed + text(rng.randint(0, 60))
        # A word put in after each word leaves no two words together.
        docs[len(docs)] = text(9) + [v for n, w in enumerate(item) for v in (w, f"y{n}")]
        docs[len(docs)] = text(5) + item + text(5)
    docs = {d: " ".join(own) for d, own in docs.items()}
    items = {i: " ".join(own) for i, own in items.items()}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    its = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in dc.contaminated(df, its).collect()}
    want = plain(docs, items)
    assert len(want) >= len(docs) - copies * len(items)
    assert got == want


def test_alignment_against_plain():
    rng = random.Random(7)
    pairs = [([rng.randint(0, 5) for _ in range(rng.randint(1, 9))], [rng.randint(0, 5) for _ in range(rng.randint(1, 20))]) for _ in range(200)]
    items, windows = np.full((200, 9), -2), np.full((200, 20), -3)
    for n, (a, b) in enumerate(pairs):
        items[n, : len(a)], windows[n, : len(b)] = a, b
    score, first, last = dc.smith_waterman(items, windows)
    for n, (a, b) in enumerate(pairs):
        assert score[n] / (2 * len(a)) == plain_score(a, b)
        if score[n]:
            assert plain_score(a, b[first[n] : last[n] + 1]) == plain_score(a, b)


def test_nulls_repeats_and_clashing_columns(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, passage), (1, passage), (2, None), (3, ""), (None, f"x {passage}"), (4, "y " * 60000 + passage), (5, "clean")]
    df = spark.createDataFrame([(*r, 0, 0.0) for r in rows], "doc_id long, text string, item_id int, score double")
    items = spark.createDataFrame([(7, passage, 1), (7, passage, 2), (8, None, 3), (None, "clean", 4)], "item_id long, text string, doc_id int")
    got = [(r.doc_id, r.item_id) for r in dc.contaminated(df, items).collect()]
    assert sorted(got, key=str) == sorted([(1, 7)] * 4 + [(None, 7)] * 2 + [(4, 7)] * 2 + [(5, None)], key=str)
    kept = dc.drop_contaminated(df, items)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert dc.contaminated(df.limit(0), items).count() == 0
    assert dc.drop_contaminated(df, items.limit(0)).count() == len(rows)
