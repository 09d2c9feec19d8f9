"""Toxicity by the nearest labelled examples, found exactly with a block-max index.

A bounded sample of labelled documents (SAMPLE rows, the smallest hashes of their ids) is
used for learning; of checked near copies with one label one counts, or the words of a text
that was copied a thousand times would all go with its label. Terms whose presence goes with
the label, by a likelihood ratio far beyond chance, form the vocabulary; their document frequency is counted over all
documents. A text is the unit vector of its terms' TF-IDF weights.

Examples are numbered and cut into blocks. The index holds for each term its postings and
its greatest weight in each block. A query adds up these greatest weights to a bound per
block, goes through the blocks from the highest bound down, and stops when the k-th best
cosine so far is above the next bound: the neighbours are exact. Their labels vote, weighted
by distance, and isotonic regression on sampled documents that are no examples makes the
vote a probability. The neighbours' ids are the evidence.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, fold, isotonic, plain_words, stored, text_array, text_slices
from .tokens import Memory

FOLDS = 4
HELD_OUT = 2
# Bounds of what is learned from: labelled rows, of which so many at most are examples,
# and terms.
SAMPLE = 20_000
EXAMPLES = 4_000
TERMS = 512
# A likelihood ratio that chance reaches in about one of a million terms.
LEAST_RATIO = 24.0
# A term has to raise the odds of the label by this factor; words of the language that
# labelled documents happen to be in don't.
LEAST_LIFT = 3.0
NEIGHBOURS = 15
# Letters of a word that tells documents apart.
LONG_WORD = 9
# Two texts are copies if they share so much of their runs of words (Jaccard).
SHINGLE = 5
COPY = 0.8
BLOCK = 128
THRESHOLD = 0.3
BINS = 1000

SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("vote", T.DoubleType()),
        T.StructField("evidence", T.ArrayType(T.LongType())),
    ]
)


def likelihood_ratio(hits: np.ndarray, docs: np.ndarray, all_hits: float, all_docs: float) -> np.ndarray:
    """2 log likelihood ratio of "the label depends on the term" against "it does not"."""
    table = np.stack([hits, docs - hits, all_hits - hits, all_docs - docs - all_hits + hits])
    rows = np.stack([docs, docs, all_docs - docs, all_docs - docs])
    columns = np.array([[all_hits], [all_docs - all_hits]] * 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * np.nan_to_num(table * np.log(table * all_docs / (rows * columns))).sum(axis=0)


def unit_vector(counts: Counter, idf: np.ndarray) -> list[tuple[int, float]]:
    """(term, weight) of a text, terms ascending; empty if it has no term."""
    weights = [(t, (1 + np.log(n)) * idf[t]) for t, n in sorted(counts.items())]
    norm = np.sqrt(sum(w * w for _, w in weights))
    return [(t, float(w / norm)) for t, w in weights]


@dataclass
class Index:
    """Inverted index over unit vectors with the greatest weight per term and block."""

    vectors: list[list[tuple[int, float]]]
    labels: list[int]
    ids: list
    terms: int
    block: int = BLOCK
    postings: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(init=False)
    most: np.ndarray = field(init=False)

    def __post_init__(self):
        blocks = -(-len(self.vectors) // self.block)
        self.most = np.zeros((self.terms, blocks))
        by_term: dict[int, list[tuple[int, float]]] = {}
        for n, vector in enumerate(self.vectors):
            for term, weight in vector:
                by_term.setdefault(term, []).append((n, weight))
        self.postings = {}
        for term, own in by_term.items():
            number = np.array([n for n, _ in own])
            weight = np.array([w for _, w in own])
            np.maximum.at(self.most[term], number // self.block, weight)
            starts = np.searchsorted(number, np.arange(blocks + 1) * self.block)
            self.postings[term] = number, weight, starts

    def nearest(self, vector: list[tuple[int, float]], k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """(cosine, example) of the k greatest cosines above 0, ties to smaller numbers."""
        known = [(t, w) for t, w in vector if t in self.postings]
        bound = sum((w * self.most[t] for t, w in known), np.zeros(self.most.shape[1]))
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            # Rounding may lift a sum a little above its bound.
            if bound[b] <= 0 or len(best) == k and best[-1][0] > bound[b] + 1e-9:
                break
            sums = np.zeros(self.block)
            for term, weight in known:
                number, weights, starts = self.postings[term]
                own = slice(starts[b], starts[b + 1])
                sums[number[own] - b * self.block] += weight * weights[own]
            found = np.flatnonzero(sums)
            best += [(float(sums[n]), int(b * self.block + n)) for n in found]
            best = sorted(best, key=lambda s: (-round(s[0], 12), s[1]))[:k]
        return best

    def vote(self, vector: list[tuple[int, float]]) -> tuple[float, list]:
        """Share of label 1 among the neighbours, near ones counting more, and their ids."""
        near = self.nearest(vector)
        weights = [1 / (1.05 - cosine) for cosine, _ in near]
        hits = sum(w for w, (_, n) in zip(weights, near) if self.labels[n])
        return hits / (sum(weights) + 1), [self.ids[n] for _, n in near]


@dataclass
class Model:
    words: list[str]
    idf: np.ndarray
    index: Index
    points: list[tuple[float, float]] = field(default_factory=list)

    def __post_init__(self):
        self.value_set = pa.array(self.words, pa.large_string())
        self._memory = None

    def __getstate__(self):
        return self.__dict__ | {"_memory": None}

    def counts(self, texts: pa.Array) -> list[tuple]:
        """The terms of each text with their number of times, as a sorted tuple."""
        lists = plain_words(texts)
        found = pc.fill_null(pc.index_in(lists.flatten(), value_set=self.value_set), -1)
        found = found.to_numpy(zero_copy_only=False)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        at = np.flatnonzero(found >= 0)
        text = np.searchsorted(bounds, at, "right") - 1
        own: list[Counter] = [Counter() for _ in range(len(texts))]
        for t, term in zip(text.tolist(), found[at].tolist()):
            own[t][term] += 1
        return [tuple(sorted(c.items())) for c in own]

    def votes(self, texts: pa.Array) -> list[tuple[float, list]]:
        if self._memory is None:
            # Texts with the same terms have the same neighbours.
            self._memory = Memory(lambda key: self.index.vote(unit_vector(Counter(dict(key)), self.idf)), 50_000)
        return [self._memory[key] for _, part in text_slices(texts) for key in self.counts(part)]

    def calibrated(self, vote: float) -> float:
        return float(np.interp(vote, *zip(*self.points))) if self.points else 0.5


@F.arrow_udf(T.ArrayType(T.StringType()))
def distinct_terms(texts: pa.Array) -> pa.Array:
    lists = plain_words(text_array(texts))
    return pa.array([list(set(own) - {""}) for own in lists.to_pylist()], pa.list_(pa.string()))


@F.arrow_udf(T.LongType())
def kind_of_text(texts: pa.Array) -> pa.Array:
    """The same number for copies and nearly always for near copies, to compare them by.

    It is the smallest hash among the long words; other texts may share it.
    """
    from xxhash import xxh64_intdigest

    found = []
    for text, own in zip(texts.to_pylist(), plain_words(text_array(texts)).to_pylist()):
        least = min((xxh64_intdigest(w, 7) for w in set(own) if len(w) >= LONG_WORD), default=None)
        found.append((xxh64_intdigest(text or "", 8) if least is None else least) - 2**63)
    return pa.array(found, pa.int64())


@F.arrow_udf(T.ArrayType(T.LongType()))
def shingles(texts: pa.Array) -> pa.Array:
    """Distinct hashes of the runs of SHINGLE words, ascending; shorter texts are one run."""
    from xxhash import xxh64_intdigest

    found = []
    for own in plain_words(text_array(texts)).to_pylist():
        runs = {" ".join(own[n : n + SHINGLE]) for n in range(max(1, len(own) - SHINGLE + 1))}
        found.append(sorted(xxh64_intdigest(r) - 2**63 for r in runs))
    return pa.array(found, pa.list_(pa.int64()))


@F.arrow_udf(T.DoubleType())
def similarity(left: pa.Array, right: pa.Array) -> pa.Array:
    """Jaccard similarity of arrays of distinct values."""
    found = []
    for n in range(len(left)):
        a, b = (side[n].values.to_numpy() for side in (left, right))
        both = len(np.intersect1d(a, b, assume_unique=True))
        found.append(both / (len(a) + len(b) - both))
    return pa.array(found, pa.float64())


def without_copies(found: DataFrame) -> DataFrame:
    """Rows of _id, text, label and kind but copies of the least _id of their kind and label."""
    marked = stored(found.withColumn("shingles", shingles("text")), "shingled-texts")
    first = marked.groupBy("kind", "label").agg(F.min(F.struct("_id", "shingles")).alias("first"))
    kept = marked.join(first, ["kind", "label"]).where(
        (F.col("_id") == F.col("first._id")) | (similarity("shingles", "first.shingles") < COPY)
    )
    return stored(kept.select(*found.columns), "texts-without-copies")


def _document_counts(words: list[str]):
    value_set = pa.array(words, pa.large_string())

    def run(batches):
        total, rows = np.zeros(len(words) + 1, np.int64), 0
        for batch in batches:
            for _, some in text_slices(text_array(batch.column(0))):
                lists = plain_words(some)
                found = pc.fill_null(pc.index_in(lists.flatten(), value_set=value_set), len(words))
                found = found.to_numpy(zero_copy_only=False).astype(np.int64)
                bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                text = np.searchsorted(bounds, np.arange(len(found)), "right") - 1
                once = np.unique(text * (len(words) + 1) + found) % (len(words) + 1)
                total += np.bincount(once, minlength=len(words) + 1)
                rows += len(some)
        total[len(words)] = rows
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), pa.array(total)], ["term", "docs"])

    return run


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    examples: int = EXAMPLES,
    terms: int = TERMS,
) -> Model:
    """Learn from labelled rows outside the held-out fold, at most `sample` of them.

    Labels other than 0 and 1 are left out. Without labels every score is 0.5.
    """
    bound_batches(docs.sparkSession)
    chosen = stored(
        labels.where(F.col(label).isin(0, 1) & (fold(doc_id, FOLDS) != HELD_OUT))
        .select(F.col(doc_id).cast("long").alias("_id"), F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id", "label")
        .limit(sample),
        "labelled-sample",
    )
    # At most `sample` rows of two numbers, so it may be sent to every executor.
    found = stored(
        docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "_id")
        .withColumn("kind", kind_of_text("text")),
        "labelled-texts",
    )
    rows = without_copies(found)
    all_hits, all_docs = rows.agg(F.sum("label"), F.count("*")).first()
    if not all_docs:
        return Model([], np.zeros(0), Index([], [], [], 0))
    counted = (
        rows.select("label", F.explode(distinct_terms("text")).alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("hits"), F.count("*").alias("docs"))
    )

    @F.arrow_udf(T.DoubleType())
    def ratio(hits: pa.Array, docs: pa.Array) -> pa.Array:
        h, d = (c.to_numpy(zero_copy_only=False).astype(float) for c in (hits, docs))
        lift = (h + 0.5) / (d - h + 0.5) * (all_docs - all_hits + 0.5) / (all_hits + 0.5)
        return pa.array(np.where(lift >= LEAST_LIFT, likelihood_ratio(h, d, float(all_hits), float(all_docs)), 0.0))

    # Chance alone cannot give a term of few documents a high ratio, so these are spared.
    best = (
        counted.where("docs >= 3")
        .select("word", ratio("hits", "docs").alias("ratio"))
        .where(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.desc("ratio"), "word")
        .limit(terms)
        .collect()
    )
    words = sorted(r.word for r in best)
    model = Model(words, np.zeros(len(words)), Index([], [], [], len(words)))
    if words:
        found = (
            docs.select(F.col(text))
            .mapInArrow(_document_counts(words), "term long, docs long")
            .groupBy("term")
            .agg(F.sum("docs").alias("docs"))
            .collect()
        )
        counts = dict(map(tuple, found))
        total = counts[len(words)]
        model.idf = np.array([1 + np.log((1 + total) / (1 + counts[t])) for t in range(len(words))])

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def term_counts(texts: pa.Array) -> pa.Array:
        own = [k for _, part in text_slices(text_array(texts)) for k in model.counts(part)]
        return pa.array([[v for pair in key for v in pair] for key in own], pa.list_(pa.int64()))

    # Texts without any term can be nobody's neighbour and only matter for calibration.
    order = [F.xxhash64("_id", F.lit("example")), "_id"]
    shown = (
        rows.where(F.pmod(F.xxhash64("_id", F.lit("half")), F.lit(2)) == 0)
        .select("_id", "label", term_counts("text").alias("terms"))
        .where(F.size("terms") > 0)
        .orderBy(*order)
        .limit(examples)
        .collect()
    )
    vectors = [unit_vector(Counter(dict(zip(r.terms[::2], r.terms[1::2]))), model.idf) for r in shown]
    model.index = Index(vectors, [r.label for r in shown], [r._id for r in shown], len(words))

    @F.arrow_udf(T.LongType())
    def bins(texts: pa.Array) -> pa.Array:
        return pa.array([round(vote * BINS) for vote, _ in model.votes(text_array(texts))], pa.int64())

    curve = (
        rows.where(F.pmod(F.xxhash64("_id", F.lit("half")), F.lit(2)) == 1)
        .select(bins("text").alias("bin"), "label")
        .groupBy("bin")
        .agg(F.sum("label").alias("hits"), F.count("*").alias("rows"))
        .collect()
    )
    model.points = isotonic([r.bin / BINS for r in curve], [r.hits for r in curve], [r["rows"] for r in curve])
    return model


def score(model: Model, text: str = "text") -> Column:
    """score, vote and evidence (ids of the nearest examples, nearest first) of a text."""

    @F.arrow_udf(SCORED)
    def run(texts: pa.Array) -> pa.Array:
        found = [
            {"score": 0.999 * model.calibrated(vote) + 0.001 * vote, "vote": vote, "evidence": ids}
            for vote, ids in model.votes(text_array(texts))
        ]
        kind = pa.struct([("score", pa.float64()), ("vote", pa.float64()), ("evidence", pa.list_(pa.int64()))])
        return pa.array(found, kind)

    return run(F.col(text))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row.

    Null and empty texts have no neighbours and get the score of texts without terms. A
    null id is not held out. Other columns are not looked at.
    """
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(fold(doc_id, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score(model, text).alias("found"),
    ).select(
        "doc_id", "held_out", "found.score", (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"),
        "found.evidence",
    )
