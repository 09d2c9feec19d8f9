"""Which URLs to keep: rules on hosts first, a learned score for all others.

Host names run words together. A unigram model over the words of all pages cuts each part
of a host into its most probable words (Viterbi). Multinomial naive Bayes over these words
and the words of the path decides; its examples are the pages of the table itself, those
with a word of a fixed list of abuse in their host against the rest.

No count is cut. Words of up to SHORT letters, names and tokens with more than one in
HELD of all occurrences are few whatever the table, so every task has them; all others are
joined: names with the counts of the words in them, and URLs with their names and weights.
"""

from __future__ import annotations

import math
import re
from collections import ChainMap
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, plain_words, stored, text_array, text_slices

# Words of abuse.
# The first list marks a host as an example, the second only adds words to the model.
SURE = (
    "ads adult bets betting casino escort jackpot keygen malware payday phish pills poker porn scam sex slots spam "
    "tracker viagra warez xxx"
).split()
ABUSE = SURE + "bet bingo bonus cheap crack farm free hack loan loans lottery nude pill torrent track virus win".split()

# What every task holds: words of so many letters, and names and tokens that make up at
# least one in so many. The rest is joined; neither changes results.
SHORT = 3
HELD = 50_000
LONGEST = 24
NUMBER = "0"
_SPLIT = re.compile(r"[^0-9a-zÀ-ɏ]+")
_LETTERS = re.compile("[a-z]+")
_TAG = re.compile(r"<[^>]*>")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """`text` is a host and the beginning of a path, such as example.com/de/."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A to Z in lower case, and path; both empty without a `://`."""
    after = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, after, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, after, 2), F.lit(""))
    return F.translate(host, _UPPER, _UPPER.lower()), path


def first_rule(rules: Iterable[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    chain = lambda value: reduce(
        lambda rest, rule: F.when(rule.fits(host, path), F.lit(getattr(rule, value))).otherwise(rest),
        reversed(ordered),
        F.lit(None).cast("string"),
    )
    return chain("text"), chain("verdict")


def count_words(batches):
    """Words of the pages' visible texts with their number, per run of pages."""
    for batch in batches:
        for _, some in text_slices(text_array(batch.column(0))):
            plain = pa.array([_TAG.sub(" ", t) for t in some.to_pylist()], pa.large_string())
            counted = pc.value_counts(plain_words(plain).flatten())
            words, counts = counted.field("values"), counted.field("counts")
            keep = pc.and_(pc.ascii_is_alpha(words), pc.less_equal(pc.utf8_length(words), LONGEST))
            yield pa.RecordBatch.from_arrays(
                [words.filter(keep).cast(pa.string()), counts.filter(keep)], ["word", "n"]
            )


@dataclass
class Segmenter:
    """Cuts names into words by the most probable path under a unigram model.

    A letter run that is no word costs as much as a word that was never seen, and more
    for each of its letters.
    """

    counts: dict[str, int]
    # Occurrences of all words, if `counts` has only some.
    all_words: int | None = None

    def __post_init__(self):
        total = (sum(self.counts.values()) if self.all_words is None else self.all_words) + 1
        self.cost = {w: math.log(total / n) for w, n in self.counts.items()}
        self.unknown = math.log(10 * total)
        self.letter = math.log(26)

    def word_cost(self, word: str) -> float:
        known = self.cost.get(word)
        return self.unknown + self.letter * len(word) if known is None else known

    def words(self, name: str) -> list[str]:
        if not name:
            return []
        best, cut = [0.0], [0]
        for end in range(1, len(name) + 1):
            options = ((best[at] + self.word_cost(name[at:end]), -at) for at in range(max(0, end - LONGEST), end))
            cost, at = min(options)
            best.append(cost)
            cut.append(-at)
        found, end = [], len(name)
        while end:
            found.append(name[cut[end] : end])
            end = cut[end]
        return found[::-1]


def names_of(host: str, path: str) -> tuple[list[str], str, list[str]]:
    """Names in a host before its last part, that part, and the names in a path."""
    front, _, last = host.rpartition(".")
    return [p for p in _SPLIT.split(front) if p], last, [p for p in _SPLIT.split(path.lower()) if p]


@F.arrow_udf(T.ArrayType(T.StringType()))
def distinct_names(hosts: pa.Array, paths: pa.Array) -> pa.Array:
    """The names of a URL that are no numbers."""
    found = []
    for host, path in zip(text_array(hosts).to_pylist(), text_array(paths).to_pylist()):
        front, _, rest = names_of(host, path)
        found.append(sorted({n for n in front + rest if not n.isdigit()}))
    return pa.array(found, pa.list_(pa.string()))


@F.arrow_udf(T.ArrayType(T.StringType()))
def longer_parts(names: pa.Array) -> pa.Array:
    """Distinct runs of letters in a name that may be words of more than SHORT letters."""
    found = []
    for name in names.to_pylist():
        own = {
            run[at:end]
            for run in _LETTERS.findall(name)
            for at in range(len(run))
            for end in range(at + SHORT + 1, min(at + LONGEST, len(run)) + 1)
        }
        found.append(sorted(own))
    return pa.array(found, pa.list_(pa.string()))


def segments(short: dict[str, int], all_words: int):
    base = Segmenter(short, all_words)

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(names: pa.Array, words: pa.Array, counts: pa.Array) -> pa.Array:
        found = []
        for name, own, n in zip(names.to_pylist(), words.to_pylist(), counts.to_pylist()):
            longer = Segmenter(dict(zip(own or (), n or ())), all_words)
            longer.cost = ChainMap(longer.cost, base.cost)
            found.append(longer.words(name))
        return pa.array(found, pa.list_(pa.string()))

    return run


def url_tokens(held: dict[str, list[str]]):
    """Words of host and path; numbers count as one word, the last part of a host as itself."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(hosts: pa.Array, paths: pa.Array, names: pa.Array, words: pa.Array) -> pa.Array:
        found = []
        both = zip(text_array(hosts).to_pylist(), text_array(paths).to_pylist(), names.to_pylist(), words.to_pylist())
        for host, path, own, cut in both:
            known = ChainMap(dict(zip(own or (), cut or ())), held)
            front, last, rest = names_of(host, path)
            cut = lambda kind, parts: [
                f"{kind}:{w}" for p in parts for w in ([NUMBER] if p.isdigit() else known[p])
            ]
            found.append(cut("host", front) + ([f"end:{last}"] if last else []) + cut("path", rest))
        return pa.array(found, pa.list_(pa.string()))

    return run


def held_and_rest(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with at least one in HELD of the sum of `n`, HELD at most, and all others."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    return counted.where(F.col("n") * HELD >= total), counted.where(F.col("n") * HELD < total)


def log_odds(tokens: list[str], weights: dict[str, float], prior: float) -> float:
    """Naive Bayes log odds of "block"."""
    return prior + sum(weights.get(t, 0.0) for t in tokens)


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """word and n over all pages, no word left out; the fixed words are always in."""
    bound_batches(pages.sparkSession)
    fixed = pages.sparkSession.createDataFrame([(w,) for w in sorted(set(ABUSE))], "word string")
    return stored(
        pages.select(F.col(html)).mapInArrow(count_words, "word string, n long")
        .unionByName(fixed.withColumn("n", F.lit(0).cast("long")))
        .groupBy("word").agg(F.greatest(F.sum("n"), F.lit(1)).alias("n")),
        "page-words",
    )


def cut_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """`names` (name, n) with the words of each name."""
    all_words = counts.agg(F.sum("n")).first()[0]
    short = {r.word: r.n for r in counts.where(F.length("word") <= SHORT).collect()}
    longer = (
        names.select("name", F.explode(longer_parts("name")).alias("word"))
        .join(counts.where(F.length("word") > SHORT).withColumnRenamed("n", "times"), "word")
        .groupBy("name").agg(F.collect_list("word").alias("own"), F.collect_list("times").alias("times"))
    )
    both = names.join(longer, "name", "left")
    return stored(both.select("name", "n", segments(short, all_words)("name", "own", "times").alias("words")), "cut-names")


def with_tokens(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows of host and path with their tokens."""
    each = stored(
        rows.select("host", "path").distinct()
        .select("host", "path", F.explode(distinct_names("host", "path")).alias("name")),
        "url-names",
    )
    names = stored(each.groupBy("name").agg(F.count("*").alias("n")), "names")
    held, rest = held_and_rest(cut_names(names, counts))
    own = (
        each.join(rest, "name").groupBy("host", "path")
        .agg(F.collect_list(F.struct("name", "words")).alias("own"))
    )
    run = url_tokens({r.name: r.words for r in held.collect()})
    return rows.join(own, ["host", "path"], "left").select(
        *rows.columns, run("host", "path", F.col("own.name"), F.col("own.words")).alias("tokens")
    )


def fit_bayes(marked: DataFrame) -> tuple[DataFrame, float]:
    """Weights of all tokens (token, n, weight) and the prior, with add-one smoothing."""
    sure = F.array(*[F.lit(f"host:{w}") for w in SURE])
    rows = marked.select("tokens", F.arrays_overlap("tokens", sure).alias("bad"))
    totals = rows.agg(
        F.count_if("bad"), F.count_if(~F.col("bad")),
        F.sum(F.when(F.col("bad"), F.size("tokens"))), F.sum(F.when(~F.col("bad"), F.size("tokens"))),
    ).first()
    bad, good, bad_tokens, good_tokens = (v or 0 for v in totals)
    per_token = stored(
        rows.select(F.explode("tokens").alias("token"), "bad")
        .groupBy("token").agg(F.count_if("bad").alias("bad"), F.count("*").alias("n")),
        "url-token-counts",
    )
    size = per_token.count()
    weight = F.log((F.col("bad") + 1) / F.lit(bad_tokens + size or 1)) - F.log(
        (F.col("n") - F.col("bad") + 1) / F.lit(good_tokens + size or 1)
    )
    return per_token.select("token", "n", weight.alias("weight")), math.log((bad + 1) / (good + 1))


def judge(
    pages: DataFrame, rules: Iterable[Rule], page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """page_id, host, path, rule, verdict, tokens and log_odds of every row.

    A null url has no host and no path, hence no tokens: the prior decides. Null pages add
    no words. Repeated rows count as often; other columns are not looked at.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    marked = stored(with_tokens(rows, word_counts(pages, html)), "url-tokens")
    weights, prior = fit_bayes(marked)
    frequent, rest = held_and_rest(weights)
    held = {r.token: r.weight for r in frequent.collect()}
    own = (
        marked.select("host", "path", "tokens").distinct()
        .select("host", "path", F.explode(F.array_distinct("tokens")).alias("token"))
        .join(rest, "token").groupBy("host", "path")
        .agg(F.collect_list(F.struct("token", "weight")).alias("own"))
    )

    @F.arrow_udf(T.DoubleType())
    def odds(tokens: pa.Array, names: pa.Array, values: pa.Array) -> pa.Array:
        each = zip(tokens.to_pylist(), names.to_pylist(), values.to_pylist())
        return pa.array([log_odds(t, ChainMap(dict(zip(n or (), v or ())), held), prior) for t, n, v in each], pa.float64())

    rule, verdict = first_rule(rules, F.col("host"), F.col("path"))
    learned = F.when(F.col("log_odds") > 0, "block").otherwise("allow")
    found = marked.join(own, ["host", "path"], "left")
    return found.withColumn("log_odds", odds("tokens", F.col("own.token"), F.col("own.weight"))).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "tokens", "log_odds"
    )
