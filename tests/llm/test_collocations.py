import random
import re
from collections import Counter

import numpy as np
import pytest

from fieldgauge.llm import collocations as co

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def spans(words, sizes=range(1, co.LONGEST + 1)):
    return [" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)]


def brute_counts(rows):
    counts = Counter()
    for lang, text in rows:
        for words in pieces(text):
            counts.update((lang or co.NO_LANGUAGE, s) for s in spans(words))
    return counts


def brute(rows, least, top):
    counts = brute_counts(rows)
    frequent = {k: f for k, f in counts.items() if f >= least}
    found = {}
    for (lang, phrase), a in frequent.items():
        words = phrase.split(" ")
        if len(words) < 2:
            continue
        parts = [(counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]) for k in range(1, len(words))]
        score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(parts))
        inside = any(
            lang == other and 100 * f >= 80 * a and len(longer.split(" ")) > len(words) and phrase in spans(longer.split(" "), [len(words)])
            for (other, longer), f in frequent.items()
        )
        if not inside:
            found.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    total = Counter()
    for (lang, phrase), f in counts.items():
        total[lang] += f if " " not in phrase else 0
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, total[lang], -score)
        for lang, some in found.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(some)[:top], 1)
    )


def random_rows(seed, count=60):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "New", "york", "é日", "x y", "big", "q" * 30, "\x1c"]
    rows = []
    for _ in range(count):
        parts = [rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\x0b"]) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice(["en", "de", None]), "".join(parts)))
    return rows + rows[:20] + [("en", None), ("en", ""), (None, " ,. "), ("fr", "alone"), ("en", "again and " * 900), ("de", "new york " * 40)]


def test_chunks_hold_every_phrase_once(monkeypatch):
    """Whatever the triggers, phrases that start in a chunk are all phrases of the text."""
    rng = random.Random(3)
    for trigger, most in ((1, 256), (3, 256), (16, 256), (1 << 60, 5), (1 << 60, 1)):
        monkeypatch.setattr(co, "TRIGGER", trigger)
        monkeypatch.setattr(co, "MOST_STARTS", most)
        texts = [t or "" for _, t in random_rows(rng.random(), 25)]
        got = Counter()
        for chunk, n, spoken, owner in zip(*co.cut([t.encode() for t in texts])):
            words = chunk.decode().split(" ")
            assert all(words) and 0 < n <= len(words) and len(words) - n <= co.REACH
            assert spoken == sum(w != co.BREAK for w in words[:n])
            own = (words[i : i + size] for size in range(1, 5) for i in range(min(n, len(words) - size + 1)))
            got.update((owner, " ".join(s)) for s in own if co.BREAK not in s)
        assert got == Counter((k, s) for k, t in enumerate(texts) for w in pieces(t) for s in spans(w))


def test_equal_passages_make_equal_chunks():
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randint(0, 999)}{rng.choice(',;. ')}" for _ in range(600))
    one, two = (co.cut([f"{head} {passage} {tail}".encode()])[0] for head, tail in (("a b c", "d"), ("e", "f g h i")))
    assert len(set(one) & set(two)) >= len(one) - 4 > 20


@pytest.mark.parametrize("bits", [3, 16, None])
def test_against_brute_force(spark, bits):
    rows = random_rows(7)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    chunks = co.stored(co.chunk_counts(docs), "chunks")
    got = {(r.lang, r.phrase): r.f for r in co.phrase_counts(chunks, 10, bits).collect()}
    assert got == {k: f for k, f in brute_counts(rows).items() if f >= 10}


@pytest.mark.parametrize("top", [2000, 5])
def test_ranks_against_brute_force(spark, top):
    rows = random_rows(11, 150)
    docs = spark.createDataFrame([(1, 2, *r) for r in rows], "phrase int, chunk int, lang string, text string")
    got = sorted(map(tuple, co.collocations(docs, least=8, top=top).collect()))
    want = brute(rows, 8, top)
    assert got == want and len(want) > 10


def test_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    counts = spark.createDataFrame(
        [("en", "a b", big - 1), ("en", "a", big), ("en", "b", big + 3), ("en", "a b c", big - 2), ("en", "c", big), ("en", "b c", big)],
        "lang string, phrase string, f bigint",
    )
    got = {r.phrase: (r.l, r.r, r.score) for r in co.scored(counts).collect()}
    assert got["a b"] == (big, big + 3, 2_000_000 * (big - 1) // (2 * big + 3))
    # Both cuts of the longest come to the same floor: the first one counts.
    assert got["a b c"] == (big, big, 2_000_000 * (big - 2) // (2 * big))
    assert {r.phrase for r in co.not_contained(co.scored(counts), counts).collect()} == {"a b c"}


def test_share_is_exact_at_the_limit(spark):
    for f, kept in ((79, {"a b", "b c", "a b c"}), (80, {"a b c"})):
        counts = spark.createDataFrame(
            [("en", "a b", 100), ("en", "b c", 100), ("en", "a b c", f), ("de", "a b", 100)] + [(g, w, 500) for g in ("en", "de") for w in "abc"],
            "lang string, phrase string, f bigint",
        )
        got = {(r.lang, r.phrase) for r in co.not_contained(co.scored(counts), counts).collect()}
        assert got == {("en", p) for p in kept} | {("de", "a b")}


def test_empty_table_and_long_texts(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert co.collocations(empty).collect() == []
    assert co.collocations(spark.createDataFrame([("en", None), (None, "")], "lang string, text string")).collect() == []
    long = [("en", "one two " * 200_000), ("en", "x" * 2_000_000)]
    got = {r.phrase: (r.rank, r.a, r.l, r.r, r.n) for r in co.collocations(spark.createDataFrame(long, "lang string, text string")).collect()}
    # All longer phrases occur nearly as often, so the shorter ones go.
    assert got == {"one two one two": (1, 199_999, 200_000, 200_000, 400_001), "two one two one": (2, 199_998, 200_000, 199_999, 400_001)}


def test_buckets_never_hide_a_frequent_phrase(spark):
    rows = random_rows(5)
    chunks = co.stored(co.chunk_counts(spark.createDataFrame(rows, "lang string, text string")), "chunks")
    floors = co.frequent_buckets(chunks, [2], {}, 10, 14)
    words = co.Words(co.pa.Table.from_batches(chunks.toArrow().to_batches()))
    places = words.places(2, {})
    passing = {(r["lang"], r["phrase"]) for r in words.phrases(2, places[co.passes(words.hashes[1][places], floors[2])]).to_pylist()}
    assert {k for k, f in brute_counts(rows).items() if f >= 10 and k[1].count(" ") == 1} <= passing
    assert isinstance(floors[2], np.ndarray) and floors[2].nbytes == (1 << 14) // 8
