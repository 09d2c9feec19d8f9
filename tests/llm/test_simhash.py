import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

from fieldgauge.llm import queries, simhash
from fieldgauge.llm.common import table
from fieldgauge.llm.components import components

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[n : n + 3]) for n in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(fps, bits=2):
    """doc -> smallest doc reachable, comparing every pair."""
    docs = sorted(fps)
    parent = {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for n, a in enumerate(docs):
        for b in docs[:n]:
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in docs}


def test_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    fps = {d: plain_fingerprint(t) for d, t in docs.items()}
    want = plain_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash_near_duplicates(spark, SF).collect()}
    assert got == {d: (f"{fps[d]:016x}", want[d]) for d in docs}


def test_odd_texts():
    texts = [None, "", " \n", "One", "one two", "A B C", "a\x0bb\x1cc d", "É é", "x " * 5000, "日本 語 x y"]
    got = simhash.fingerprints(simhash.text_array(pa.array(texts)))
    assert [int(np.uint64(f)) for f in got.view(np.uint64)] == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("crowd", [4, 2048])
def test_links_against_all_pairs(spark, crowd, monkeypatch):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    fps = set()
    while len(fps) < 500:
        near = rng.choice(centres)
        for bit in rng.sample(range(64), rng.randint(0, 5)):
            near ^= 1 << bit
        fps.add(near)
    known = {d: f for d, f in enumerate(sorted(fps, key=lambda f: f * 7 % 1000003))}
    monkeypatch.setattr(simhash, "CROWD", crowd)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), d) for d, f in known.items()], "fp long, doc long")
    pairs = [(r.a, r.b) for r in simhash.fingerprint_links(df).collect()]
    assert all((known[a] ^ known[b]).bit_count() <= 2 or crowd for a, b in pairs)
    got = {r.node: r.component for r in components(simhash.fingerprint_links(df)).collect()}
    want = plain_components(known)
    sizes = Counter(want.values())
    assert got == {d: c for d, c in want.items() if sizes[c] > 1}


def test_crowded_leaf_both_ways():
    rng = random.Random(9)
    fps = np.array(sorted({(1 << rng.randrange(64)) | (1 << rng.randrange(64)) | rng.getrandbits(3) for _ in range(3000)}), np.uint64)
    many = simhash.crowd_labels(fps, 2)
    few = plain_components({n: int(f) for n, f in enumerate(fps[:400])})
    assert simhash.crowd_labels(fps[:400], 2).tolist() == [few[n] for n in range(400)]
    old = simhash.CROWD
    simhash.CROWD = 1
    try:
        assert simhash.crowd_labels(fps, 2).tolist() == many.tolist()
    finally:
        simhash.CROWD = old


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(4, "a b c d"), (9, "a b c d"), (9, "a b c d"), (2, None), (3, ""), (None, "a b c d"), (None, None)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, fp int, doc int, component_id int")
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(4, 4), (9, 4), (9, 4), (2, 2), (3, 2), (None, None), (None, None)], key=str)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (0, "a b c d"), (2, ""), (4, "a b c d")]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(6)
    pairs = [(n, n + 1) for n in range(100, 400)] + [(1000, n) for n in range(1001, 1400)] + [(5, 5), (7, 6), (6, 7)]
    rng.shuffle(pairs)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    by = defaultdict(set)
    for node, c in got.items():
        by[c].add(node)
    assert by == {100: set(range(100, 401)), 1000: set(range(1000, 1400)), 6: {6, 7}}
