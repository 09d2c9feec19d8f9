import difflib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from fieldgauge.llm import line_dedup, queries
from fieldgauge.llm.common import table

SF = "/root/testdata/sf0.001"


def split(docs):
    """Lines and numbers of words of each document."""
    lines = {d: [" ".join(re.sub(r"[ \t\n\x0B\f\r]+", " ", x).strip(" ").split(" ")) for x in t.split("\n")] for d, t in docs.items()}
    return lines, {d: [len(x.split(" ")) if x else 0 for x in own] for d, own in lines.items()}


def shortest_runs(words, least):
    """(start, end) of the shortest runs of enough words from and up to each line with words."""
    found = set()
    for n in (n for n, w in enumerate(words) if w):
        found |= {next(((n, m) for m in range(n, len(words) + 1) if sum(words[n:m]) >= least), None)}
        found |= {next(((m, n + 1) for m in range(n, -1, -1) if sum(words[m : n + 1]) >= least), None)}
    return found - {None}


def plain(docs, least, all_pairs=False):
    """doc -> numbers of deleted lines, from all documents that share a run, or from all
    earlier documents."""
    lines, words = split(docs)
    first, gone = {}, {}
    for d in sorted(docs):
        runs = [tuple(lines[d][a:b]) for a, b in shortest_runs(words[d], least)]
        earlier = sorted({first.setdefault(run, d) for run in runs} - {d}) if not all_pairs else [p for p in docs if p < d]
        gone[d] = {n for p in earlier for n in line_dedup.common_blocks(lines[d], lines[p], words[d], least)}
    return gone


def kept(docs, gone):
    return {d: "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d]) for d, t in docs.items()}


def check_all_pairs(docs, gone, least):
    """Against what all pairs of documents would delete: no line more, and none less but
    those that the document holds twice, or has in another order than their first holder,
    of which patience diff leaves one."""
    lines, words = split(docs)
    every = plain(docs, least, all_pairs=True)
    assert all(gone[d] <= every[d] for d in docs)
    first = {}
    for d in sorted(docs):
        runs = {(a, b): tuple(lines[d][a:b]) for a, b in shortest_runs(words[d], least)}
        holders = {span: first.setdefault(run, d) for span, run in runs.items()}
        for n in (n for n in every[d] - gone[d] if words[d][n]):
            own = [f for (a, b), f in holders.items() if a <= n < b and f < d]
            pairs = {f: line_dedup.align(lines[d], lines[f]) for f in own}
            twice = lines[d].count(lines[d][n]) > 1
            there = {f: [m for m, line in enumerate(lines[f]) if line == lines[d][n]] for f in own}
            crossed = any((n - a) * (m - b) < 0 for f in own for m in there[f] for a, b in pairs[f])
            assert own and (twice or crossed), (d, n)


def test_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r.text for r in queries.op10_line_dedup(spark, SF).collect()}
    gone = plain(docs, line_dedup.WORDS)
    assert got == kept(docs, gone) and got != docs
    check_all_pairs(docs, gone, line_dedup.WORDS)


def test_random_documents(spark):
    rng = random.Random(8)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))) for _ in range(40)] + ["the very common line here"]
    docs = {}
    for d in range(150):
        lines = [rng.choice(pool[:40]) if rng.random() < 0.3 else f"own {d} {n} x y z" for n in range(rng.randint(0, 9))]
        if docs and rng.random() < 0.4:
            old = rng.choice(list(docs.values())).split("\n")
            lines[1:1] = old[rng.randint(0, len(old)) :]
        docs[d] = "\n".join(lines + ["the very  common line here "] * (rng.random() < 0.5))
    df = spark.createDataFrame([(d, t) for d, t in docs.items()], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    gone = plain(docs, 5)
    assert got == kept(docs, gone)
    check_all_pairs(docs, gone, 5)


def test_runs_against_plain_ones():
    rng = np.random.default_rng(1)
    for _ in range(200):
        words = rng.integers(0, 9, rng.integers(0, 30)) * rng.integers(0, 2)
        hashes = rng.integers(-(2**63), 2**63, len(words))
        found, counts = line_dedup.run_hashes(hashes, words, 5)
        want = {}
        for a, b in shortest_runs(words.tolist(), 5):
            value = sum(int(h) * line_dedup.BASE ** (n) for n, h in enumerate(hashes[a:b])) % 2**64
            want[value - 2**64 if value >= 2**63 else value] = int(sum(words[a:b]))
        assert dict(zip(found.tolist(), counts.tolist())) == want


def test_passage_in_short_lines(spark):
    block = "\n".join(f"three words {n}" for n in range(20))
    docs = {1: f"first own line of text\n{block}\nend", 2: f"second own line of text\n{block}\nother end", 3: "three words 3\nand so on"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == docs | {2: "second own line of text\nother end"}


def test_block_shared_with_a_later_holder(spark):
    long = "one two three four five six"
    block = f"yes\nno\n{long}\nmaybe so"
    docs = {1: f"something else here\n{long}\nand nothing more of it", 2: f"second\n{block}\nends", 3: f"third\n{block}\nstops"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: docs[1], 2: "second\nyes\nno\nmaybe so\nends", 3: "third\nstops"}


def test_any_column_names(spark):
    names = ["_gone_id", "_gone", "_gone_hash", "_gone_lines", "_GONE_ID_", "who", "first", "hash", "words", "salt", "own", "other", "run"]
    rows = [(d, "one two three four five\nrest", *range(len(names))) for d in (1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    for frame in (df, df.limit(0)):
        got = line_dedup.dedup_lines(frame)
        assert got.columns == df.columns
        assert sorted(tuple(r)[1:] for r in got.collect()) == ([("", *rows[0][2:]), rows[0][1:]] if frame is df else [])


def test_very_long_texts(spark):
    long = "\n".join(f"line {n} of a very long text" for n in range(30_000))
    df = spark.createDataFrame([(1, long), (2, long + "\nnew"), (3, "w " * 300_000), (4, "w " * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: long, 2: "new", 3: "w " * 300_000, 4: ""}


def test_align_against_all_orders():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, 9) for _ in range(rng.randint(0, 12))] for _ in range(2))
        pairs = line_dedup.align(a, b)
        assert all(a[x] == b[y] for x, y in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        if sorted(a) == sorted(set(a)) and sorted(b) == sorted(set(b)):
            chain = sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
            assert len(pairs) >= chain


def test_aligned_block_takes_short_lines_along(spark):
    block = "one two three four five\nyes\nsix seven eight nine ten"
    rows = [(1, f"start of it all now\n{block}"), (2, f"yes\n{block}\nyes"), (3, "yes"), (4, "six seven eight nine ten\none two three four five")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got[1] == rows[0][1] and got[2] == "yes\nyes" and got[3] == "yes"
    # Order matters: only one of two crossed lines can be aligned.
    assert got[4] in ("six seven eight nine ten", "one two three four five")


def test_nulls_repeats_and_clashing_columns(spark):
    text = "a line of five words"
    rows = [(1, text), (2, text), (2, text), (2, text + "\nmore"), (3, None), (None, text), (4, ""), (5, "x\n" * 20000 + text)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, who int, removed int, hashes int")
    got = line_dedup.dedup_lines(df, removed="removed")
    assert sorted(got.columns) == sorted(df.columns)
    found = sorted((str(r.doc_id), r.text if r.text is None else r.text[:20], len(r.removed)) for r in got.collect())
    assert found == sorted([("1", text, 0), ("2", "", 1), ("2", "", 1), ("2", "more", 1), ("3", None, 0), ("None", text, 0), ("4", "", 0), ("5", ("x\n" * 20)[:20], 1)])
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_block_of_many_documents_takes_short_lines_along(spark):
    block = "one two three four five\nyes\nsix seven eight nine ten"
    for many in (900, 1100):
        df = spark.createDataFrame([(n, f"own line number {n} here\n{block}\nno") for n in range(many)], "doc_id long, text string")
        got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
        assert got == {n: f"own line number {n} here" + (f"\n{block}\nno" if n == 0 else "") for n in range(many)}
