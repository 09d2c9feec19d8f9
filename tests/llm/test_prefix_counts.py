import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import prefix_counts as pf
from fieldgauge.llm import queries
from fieldgauge.llm.tokens import Encoder, as_letters

ODD = [
    "", " ", "don't we'll 're x'r '", "a" * 70, "thhesehationing" * 6, "日本語の文章" * 9, "<|endoftext|>",
    "x<|endoftext|>y <|startoftext|", "été" * 12, "naïve ÀÉÎ ß²½x", "!!!" * 20 + "?'s", "한국어" * 12,
    "각" * 10, "tab\tand\x0bmore\x1cno\x85next end x", "12345abc99" * 6, "🙂🙃" * 15, "İİstanbul",
    "abc" * 9 + "<|endoftext|>" + "q" * 30, "a" * 30 + "\u00a0", "a" * 30 + "\u00a0 end",
    "Informationstechnologie\u00a0:\u00a0Anwendungsgebiete\u00a0", "日本\u3000語の" * 8 + "\u2003", "q\u0301" * 20,
    "e\u0301te\u0323\u0301" * 15, "\u1680\u2028\x85" * 10 + "x", "<|endoftext|>" * 12 + "<|endoftext", "a\x01b\x7f\x1c" * 9,
    "don\u00a0't\u00a0we'l", "e\u0301=\u0338'\u0301s" * 6,
]
BLANKS = "\u00a0\u0085\u2003\u3000\u1680\u2028"


@pytest.fixture(scope="module")
def known(vocab):
    return pf.PrefixEncoder(vocab)


def texts(count=150):
    rng = random.Random(5)
    letters = "aeiouthnrsld'.,!$|<>0129éÀßñ日語́ \n\t" + BLANKS
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(count)]
    unbroken = letters.replace(" ", "").replace("\n", "").replace("\t", "") + "<|endoftext|>"[:3]
    long = ["".join(rng.choice(unbroken) for _ in range(rng.randint(25, 90))) for _ in range(count)]
    return ODD + some + long


def test_ids_are_the_library_s(vocab):
    own = Encoder(vocab)
    given = texts()
    ids, bounds = own.encode(pa.array(given, pa.large_string()))
    for n, text in enumerate(given):
        want = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[bounds[n] : bounds[n + 1]].tolist() == want, text


def test_every_latin_character(vocab):
    own = Encoder(vocab)
    for code in range(0x21, 0x100):
        for word in (chr(code), f"a{chr(code)}b", f"1{chr(code)}'", chr(code) * 3):
            ids, _ = own.encode(pa.array([word], pa.large_string()))
            assert ids.tolist() == own.tokenizer.encode(word, add_special_tokens=False).ids, repr(word)


def test_every_prefix_has_the_library_s_count(known):
    given = texts()
    steps = known.text_steps(pa.array(given, pa.large_string()))
    for text, step in zip(given, steps):
        sums = pf.np.cumsum(pf.np.frombuffer(step, pf.STEP)).tolist()
        want = [len(known.tokenizer.encode(text[: n + 1], add_special_tokens=False).ids) for n in range(len(text))]
        assert sums == want, repr(text)


def test_pieces_by_dynamic_program(known):
    rng = random.Random(3)
    for _ in range(300):
        piece = "".join(rng.choice(["th", "er", "ing", "a", "e", "tion", "s", "é"]) for _ in range(rng.randint(1, 60)))
        counts = [len(known.model.tokenize(as_letters(piece[:n]))) for n in range(1, len(piece) + 1)]
        assert known.run_counts(piece) == counts


def test_questions(spark, vocab, known):
    given = texts(30) + [None]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    df = df.withColumn("prefix_steps", F.lit("clash"))
    rows = (
        pf.with_prefix_steps(df, vocab)
        .select(
            "doc_id", "text",
            pf.tokens_in_prefix("prefix_steps", F.length("text")).alias("n"),
            pf.tokens_in_prefix("prefix_steps", F.lit(7)).alias("seven"),
            pf.longest_prefix("prefix_steps", F.lit(4)).alias("fits"),
        )
        .collect()
    )
    assert len(rows) == len(given)
    for row in rows:
        text = row.text or ""
        count = lambda t: len(known.tokenizer.encode(t, add_special_tokens=False).ids)
        assert row.seven == count(text[:7])
        assert row.n == (None if row.text is None else count(text))
        assert row.fits == max(n for n in range(len(text) + 1) if count(text[:n]) <= 4)


def test_query(spark, known):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op7_prefix_token_counts(spark, sf)
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    rows = got.collect()
    assert len(rows) == len(docs)
    count = lambda t: len(known.tokenizer.encode(t, add_special_tokens=False).ids)
    for r in rows:
        text = docs[r.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), count(text), count(text) > 2048)
        assert r.chars_within_limit == len(text) if not r.over_limit else count(text[: r.chars_within_limit]) <= 2048


def test_very_long_words(known):
    """Ten thousand special strings in one word, and one word of a million letters."""
    many = "<|endoftext|>" * 10_000 + "x"
    counts = known.word_counts(many)
    assert len(counts) == len(many)
    assert counts[12::13][:10_000] == list(range(1, 10_001)) and counts[-1] == 10_001
    for n in (1, 5, 13, 40, 400):
        assert counts[n - 1] == known.count(many[:n])
    for long in ("abcde" * 200_000, "a" * 40_000, "x\u00a0y" * 20_000):
        counts = known.word_counts(long)
        assert len(counts) == len(long)
        for n in (1, 77, 3_000, len(long)):
            assert counts[n - 1] == known.count(long[:n])


def test_empty_table(spark, vocab):
    empty = spark.createDataFrame([], "doc_id long, text string")
    df = pf.with_prefix_steps(empty, vocab).select(pf.tokens_in_prefix("prefix_steps", F.lit(3)).alias("n"))
    assert df.collect() == []
