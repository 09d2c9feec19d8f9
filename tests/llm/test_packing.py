import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from fieldgauge.llm import packing, queries
from fieldgauge.llm.common import table
from fieldgauge.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"


def check_layout(rows, length):
    """Sequences are gapless and not too long; returns their number."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


def wanted(docs, vocab, length):
    tokenizer = Encoder(vocab).tokenizer
    found = []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for n, start in enumerate(range(0, len(ids), length)):
            own = ids[start : start + length]
            found.append((doc_id, n, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(found, key=str)


def test_query(spark, vocab):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    rows = queries.op3_best_fit_packing(spark, SF).collect()
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == wanted(docs, vocab, 4096)
    assert check_layout(rows, 4096) <= -(-sum(r.length for r in rows) // 4096) + 1


@pytest.mark.parametrize("most", [4, 50_000])
def test_levels(spark, vocab, most):
    rng = random.Random(1)
    docs = [(n, "a " * rng.choice([0, 3, 9, 40, 130])) for n in range(400)] + [(None, None), (7, "a a"), (7, "a a")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, bin int").repartition(13)
    rows = packing.pack(df, vocab, length=64, window=200, fan_in=3, most=most).collect()
    got = [(r.doc_id, r.piece, r.start, r.length, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows]
    assert sorted(got, key=str) == wanted(docs, vocab, 64)
    bins = check_layout(rows, 64)
    # Windows of three bins, and bins count as full with two tokens of room.
    assert bins <= -(-sum(r.length for r in rows) // 64) * (1.05 if most > 100 else 1.2) + 1


def test_nothing_fits_together(spark, vocab):
    df = spark.createDataFrame([(n, "a " * 39) for n in range(100)], "doc_id long, text string").repartition(5)
    rows = packing.pack(df, vocab, length=64, fan_in=2, most=8).collect()
    assert check_layout(rows, 64) == 100


def test_empty_table(spark, vocab):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), vocab).count() == 0


def test_best_fit_against_plain_search():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(0, 60))]
        rooms = []
        for size in sorted(sizes, reverse=True):
            fits = [n for n, room in enumerate(rooms) if room >= size]
            if fits:
                rooms[min(fits, key=lambda n: rooms[n])] -= size
            else:
                rooms.append(30 - size)
        bins = packing.best_fit(sizes, 30)
        assert sorted(n for b in bins for n in b) == list(range(len(sizes)))
        assert sorted(30 - sum(sizes[n] for n in b) for b in bins) == sorted(rooms)
