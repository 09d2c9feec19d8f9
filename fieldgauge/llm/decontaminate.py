"""Find passages of test items in documents, also when they were edited.

An alignment with m matches in r unbroken runs has at least r - 1 errors, so its score is at
most m + p + 1, where p = m - r counts the pairs of neighbouring words inside the runs. An
item of L words reaches the threshold t only where ceil(2 t L) - 1 of its 2 L - 1 words and
word pairs occur, all within L (3 - 2 t) words of the text. Leaving out c of them leaves that
number less c to be found among the others, whichever they are.

Two passes over the texts. The first counts in how many documents each word and pair of the
items occurs, only to leave out those that are dearest to look for. The second counts the
others in overlapping windows, and Smith-Waterman alignment of the whole item against each
window that has enough gives the score. So every passage at the threshold is found, with the
score that the whole text would give, whatever the number of copies.

The score is the alignment's sum over the sum of a perfect copy, 0 to 1, so word changes,
insertions and gaps lower it and a part of the item scores as its share.

Items go through in blocks of a bounded number of words, so a benchmark of any size works;
the texts are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, plain_words, text_array, text_slices

GRAMS = (1, 2)
THRESHOLD = 0.5
# Share of the words and pairs a passage must have that is still looked for when the most
# frequent ones are left out. It changes the work only, not what is found.
LOOKED_FOR = 0.25
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_WORDS = 200_000
ALIGNED_AT_ONCE = 256
# Bounds of what is held at once: window cells, windows joined into one, words looked up.
CELLS, JOINED, LOOKED_UP = 1 << 20, 8, 1 << 21

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("first_word", T.IntegerType()),
            T.StructField("last_word", T.IntegerType()),
        ]
    )
)


@dataclass
class Items:
    """Items of one block: words by number, and the n-grams that lead to them."""

    ids: list
    texts: list[str]
    vocabulary: pa.Array = field(init=False)
    words: list[np.ndarray] = field(init=False)
    grams: dict[int, np.ndarray] = field(init=False)

    def __post_init__(self):
        lists = plain_words(pa.array(self.texts, pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        bounds = lists.offsets.to_numpy()
        self.vocabulary = coded.dictionary
        places = coded.indices.to_numpy().astype(np.int64)
        blank = pc.index(self.vocabulary, "").as_py()
        self.words = [places[a:b][places[a:b] != blank] for a, b in zip(bounds[:-1], bounds[1:])]
        self.grams = {
            n: np.unique(np.concatenate([np.zeros(0, np.int64), *(self.codes(w, n) for w in self.words)])) for n in GRAMS
        }

    def codes(self, words: np.ndarray, n: int) -> np.ndarray:
        """A number for each n-gram; those with a word that no item has are negative."""
        size = len(self.vocabulary)
        count = max(0, len(words) - n + 1)
        code, known = np.zeros(count, np.int64), np.ones(count, bool)
        for k in range(n):
            own = words[k : k + count]
            code = code * size + own
            known &= own >= 0
        return np.where(known, code, -1)

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The items' word numbers in the texts, -1 for other words, and the texts' bounds."""
        lists = plain_words(texts)
        found = pc.fill_null(pc.index_in(lists.flatten(), value_set=self.vocabulary), -1)
        bounds = lists.offsets.to_numpy()
        return found.to_numpy(zero_copy_only=False).astype(np.int64), bounds - bounds[0]

    def hits(self, places: np.ndarray, bounds: np.ndarray, grams: dict[int, np.ndarray]):
        """Text, place and number of each n-gram that occurs, for each n-gram length."""
        for n, known in grams.items():
            code = self.codes(places, n)
            at = np.flatnonzero(code >= 0)
            rank = np.searchsorted(known, code[at])
            good = (rank < len(known)) & (known[np.minimum(rank, len(known) - 1)] == code[at])
            at, rank = at[good], rank[good]
            text = np.searchsorted(bounds, at, "right") - 1
            inside = at + n <= bounds[text + 1]
            yield n, text[inside], at[inside], rank[inside]


def count_grams(items: Items):
    """In how many documents each n-gram occurs, added up per task."""

    def run(batches):
        total = {n: np.zeros(len(known), np.int64) for n, known in items.grams.items()}
        for batch in batches:
            for _, some in text_slices(text_array(batch.column(0))):
                for n, text, _, rank in items.hits(*items.places(some), items.grams):
                    once = np.unique(text * len(total[n]) + rank) % len(total[n])
                    total[n] += np.bincount(once, minlength=len(total[n]))
        for n, counts in total.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seen), n), pa.int32()), pa.array(seen, pa.int64()), pa.array(counts[seen])],
                ["n", "rank", "docs"],
            )

    return run


@dataclass
class Seeds:
    """What is looked for: per n-gram length the n-grams and the items each leads to."""

    grams: dict[int, np.ndarray]
    # For each n-gram its run in `item`, numbered through over all lengths.
    first: dict[int, np.ndarray]
    item: np.ndarray
    # Per item: seeds that a window must have, and a third of the window's words.
    need: np.ndarray
    stride: np.ndarray


def choose_seeds(items: Items, docs: dict[int, np.ndarray], threshold: float) -> Seeds:
    """The rarest words and pairs of each item, as many as no passage can do without."""
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {n: [] for n in GRAMS}
    need, stride = np.ones(len(items.words), np.int64), np.ones(len(items.words), np.int64)
    for item, words in enumerate(items.words):
        size = len(words)
        if not size:
            continue
        ranks = [np.searchsorted(items.grams[n], items.codes(words, n)) for n in GRAMS]
        # A little less than the bound, against rounding.
        least = max(1, int(np.ceil(MATCH * threshold * size - 1e-6)) - 1)
        need[item] = max(1, int(np.ceil(LOOKED_FOR * least)))
        stride[item] = max(1, int(np.ceil(size * (3 - 2 * threshold) / 2 + 1e-6)))
        count = np.concatenate([docs[n][own] for n, own in zip(GRAMS, ranks)])
        seeds = np.sort(np.argsort(count, kind="stable")[: len(count) - least + need[item]])
        cut = np.searchsorted(seeds, size)
        for n, own in zip(GRAMS, (ranks[0][seeds[:cut]], ranks[1][seeds[cut:] - size])):
            found[n].append((own, np.full(len(own), item)))
    grams, first, item, total = {}, {}, [], 0
    for n, parts in found.items():
        rank, own = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*parts))
        order = np.argsort(rank, kind="stable")
        used, at = np.unique(rank[order], return_index=True)
        grams[n], first[n] = items.grams[n][used], total + np.append(at, len(rank))
        item.append(own[order])
        total += len(rank)
    return Seeds(grams, first, np.concatenate(item), need, stride)


def smith_waterman(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local score of each item in its window, with the first and last place there.

    Word numbers, one pair per row; pad items with -2 and windows with -3. Scores travel
    together with their starting place as one number, the score in its upper part.
    """
    rows, width = windows.shape
    shift = 32
    columns = np.arange(width)
    fresh = columns.astype(np.int64)  # score 0, starting here
    ramp = (-GAP * columns).astype(np.int64) << shift
    before = np.broadcast_to(fresh, (rows, width)).copy()
    best, last = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for k in range(items.shape[1]):
        word = items[:, k : k + 1]
        # An item that has ended scores worse and worse and cannot win any more.
        step = np.where(windows == word, MATCH, np.where(word == -2, -(10**6), MISMATCH)).astype(np.int64) << shift
        diagonal = np.empty_like(before)
        diagonal[:, 0] = fresh[0]
        diagonal[:, 1:] = np.where(before[:, :-1] >> shift > 0, before[:, :-1], fresh[1:])
        now = np.maximum(diagonal + step, before + (GAP << shift))
        now = np.maximum.accumulate(now + ramp, axis=1) - ramp
        now = np.where(now >> shift > 0, now, fresh)
        top = now.argmax(axis=1) if width else np.zeros(rows, int)
        value = now[np.arange(rows), top]
        better = value >> shift > best >> shift
        best, last = np.where(better, value, best), np.where(better, top, last)
        before = now
    return best >> shift, best & ((1 << shift) - 1), last


def find_passages(items: Items, seeds: Seeds, threshold: float):
    """Arrow function: text to the items found in it."""

    def seeds_found(places, bounds):
        """Item * words + beginning of the third of a window, and the seeds found there."""
        total, keys, counts = len(places) + 1, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, text, at, rank in items.hits(places, bounds, seeds.grams):
            begin, each = seeds.first[n][rank], np.diff(seeds.first[n])[rank]
            ends = np.cumsum(each)
            start = 0
            while start < len(at):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + LOOKED_UP, "right")))
                some = slice(start, stop)
                number = np.arange(ends[stop - 1] - before) + np.repeat(begin[some] - ends[some] + each[some] + before, each[some])
                origin, stride = np.repeat(bounds[text[some]], each[some]), seeds.stride[seeds.item[number]]
                third = origin + (np.repeat(at[some], each[some]) - origin) // stride * stride
                # A seed counts once in each third, where it occurs more than once too.
                once = np.unique(number * total + third)
                key, count = np.unique(seeds.item[once // total] * total + once % total, return_counts=True)
                keys.append(key)
                counts.append(count)
                start = stop
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(back, np.concatenate(counts), len(key)).astype(np.int64)

    def candidates(places, bounds):
        """(text, item, first place, end) of each run of windows with enough seeds."""
        total = len(places) + 1
        key, count = seeds_found(places, bounds)
        item, third = key // total, key % total
        origin = bounds[np.searchsorted(bounds, third, "right") - 1]
        keys, counts = [], []
        for k in range(3):  # windows that begin here, one third before and two before
            begin = third - k * seeds.stride[item]
            keys.append((item * total + begin)[begin >= origin])
            counts.append(count[begin >= origin])
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        enough = np.bincount(back, np.concatenate(counts), len(key)) >= seeds.need[key // total]
        item, begin = key[enough] // total, key[enough] % total
        text = np.searchsorted(bounds, begin, "right") - 1
        found: list[list[int]] = []
        for t, i, a, stride in zip(text.tolist(), item.tolist(), begin.tolist(), seeds.stride[item].tolist()):
            if found and found[-1][:2] == [t, i] and a == found[-1][3] - 2 * stride and a < found[-1][2] + JOINED * stride:
                found[-1][3] = a + 3 * stride
            else:
                found.append([t, i, a, a + 3 * stride])
        return [(t, i, a, min(int(bounds[t + 1]), b)) for t, i, a, b in found]

    def passages(texts: pa.Array) -> list[list[dict]]:
        places, bounds = items.places(texts)
        best: list[dict] = [{} for _ in range(len(texts))]
        todo = sorted(candidates(places, bounds), key=lambda c: c[3] - c[2])
        while todo:
            # The widest first, as many as fit.
            at_once = max(1, min(ALIGNED_AT_ONCE, CELLS // (todo[-1][3] - todo[-1][2])))
            todo, some = todo[:-at_once], todo[-at_once:]
            width, length = max(b - a for _, _, a, b in some), max(len(items.words[i]) for _, i, _, _ in some)
            windows, wanted = np.full((len(some), width), -3), np.full((len(some), length), -2)
            for n, (_, item, a, b) in enumerate(some):
                windows[n, : b - a] = places[a:b]
                wanted[n, : len(items.words[item])] = items.words[item]
            for (t, item, a, _), score, first, last in zip(some, *smith_waterman(wanted, windows)):
                share = float(score) / (MATCH * len(items.words[item]))
                old = best[t].get(item)
                place = (int(a + first - bounds[t]), int(a + last - bounds[t]))
                if share >= threshold and (old is None or (-share, place) < (-old[0], old[1])):
                    best[t][item] = (share, place)
        return [
            [
                {"item_id": items.ids[item], "score": share, "first_word": place[0], "last_word": place[1]}
                for item, (share, place) in sorted(own.items())
            ]
            for own in best
        ]

    @F.arrow_udf(FOUND)
    def run(texts: pa.Array) -> pa.Array:
        found = [own for _, part in text_slices(text_array(texts)) for own in passages(part)]
        return pa.array(
            found,
            pa.list_(
                pa.struct(
                    [("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32())]
                )
            ),
        )

    return run


def item_blocks(items: DataFrame, item_id: str, text: str, block_words: int):
    """The items in blocks of about so many words, one block at a time on the driver."""
    known = items.where(F.col(text).isNotNull()).select(
        F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")
    )
    words = known.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    for n in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n).collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        block = Items([r.item_id for r in rows], [r.text for r in rows])
        if any(map(len, block.words)):
            yield block


def passages_found(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> Column:
    """A column for rows of `docs`: array of (item_id, score, first_word, last_word).

    Words count from 0. Of several passages with one item the best counts, then the first.
    Null and empty texts and items have no words and match nothing; items that repeat are
    found once each.
    """
    bound_batches(docs.sparkSession)
    found = []
    for block in item_blocks(items, item_id, item_text, block_words):
        counted = docs.select(F.col(text)).mapInArrow(count_grams(block), "n int, rank long, docs long")
        counts = {n: np.zeros(len(known), np.int64) for n, known in block.grams.items()}
        for row in counted.groupBy("n", "rank").agg(F.sum("docs").alias("docs")).collect():
            counts[row.n][row["rank"]] = row.docs
        found.append(find_passages(block, choose_seeds(block, counts, threshold), threshold)(F.col(text)))
    if not found:
        return F.array().cast(FOUND)
    return found[0] if len(found) == 1 else F.concat(*found)


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document and item found: doc_id, item_id, score, first_word, last_word."""
    found = passages_found(docs, items, text, **options)
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(found).alias("found")).select("doc_id", "found.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """All rows and columns of documents in which no item is found."""
    return docs.where(F.size(passages_found(docs, items, text, **options)) == 0)
