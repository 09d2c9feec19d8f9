"""Collocations: phrases whose words occur together more often than apart, counted exactly.

Counting uses a prefix-free parse. A text is a row of tokens: its words, and a break
wherever punctuation or a line end keeps phrases apart. It is cut wherever the hash of the
next REACH tokens falls on a trigger value, so equal passages are cut alike whatever
stands around them, and a chunk takes these REACH tokens along. Every phrase of up to
REACH + 1 words then lies whole inside the chunk in which it starts, and is counted there
alone: at the tokens that a chunk took along no phrase starts. Documents that copy each
other share their chunks, so the dictionary of distinct chunks with their frequencies is
what gets counted.

Phrases are first counted by hash into a table of fixed size, from which one bit per bucket is kept: whether it reaches the least frequency. A phrase that is
frequent enough, and each phrase inside it, always falls into such buckets; the others
are left out before anything is shuffled. The table decides about the cost and never about
the result: what passes is counted exactly, by its words. With many more words than
buckets times the least frequency all buckets fill up, and all phrases are shuffled.

Texts are taken whole; a null text is empty and a null language is `und`. Repeated
documents count as often as they occur. Empty tables give no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, release_memory, stored, text_array, text_slices

# Words of the longest phrase; a chunk takes one less along from the next.
LONGEST = 4
REACH = LONGEST - 1
LEAST = 30
# One of so many places is a trigger, and a chunk ends after so many starts at the latest.
TRIGGER = 16
MOST_STARTS = 256
# A phrase goes into a longer one that has this share of its occurrences.
SHARE = 80
SCALE = 2_000_000
RANK_SHARES = 64
NO_LANGUAGE = "und"

# Buckets of the table of hashes, as powers of two; it follows the number of words. The
# bits of all of them come to 2 MB per length of phrases at most.
LEAST_BITS, MOST_BITS = 14, 24
# Buckets that travel as one row.
RANGE_BITS = 12
# Text of chunks that is counted together.
GATHER_BYTES = 4 << 20

BREAK = "\n"
# Bytes of a text to what the parse sees: small letters, blanks, and one sign for whatever
# ends a piece; and the sign between texts, which none has any more.
_SEEN = bytes(
    ord(BREAK) if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if chr(b) == "\t" else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)
_TEXT_END = b"\x0b"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def hashes_of(words: pa.Array) -> np.ndarray:
    """A hash of each text, the same on every machine."""
    return hash_array(words.to_numpy(zero_copy_only=False), categorize=False)


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The hash of two parts in this order."""
    mix = (first * _MIX) ^ (second + (first >> np.uint64(29)))
    mix = (mix ^ (mix >> np.uint64(32))) * _MIX
    return mix ^ (mix >> np.uint64(29))


# ---- chunks


def cut(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of the texts: their tokens, joined by blanks; the number of tokens in each at
    which phrases can start; how many of these are words; and the number of its text."""
    raw = _TEXT_END.join(t.translate(_SEEN) for t in texts) + _TEXT_END
    seen = np.frombuffer(raw.replace(b"\n", b" \n "), np.uint8)
    text_end = seen == _TEXT_END[0]
    blank = text_end | (seen == 0x20)
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    after = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    breaks = seen[begins] == 0x0A
    owner = np.searchsorted(np.flatnonzero(text_end), begins)
    # Of breaks in a row one stays.
    again = breaks[1:] & breaks[:-1] & (owner[1:] == owner[:-1])
    stays = ~np.concatenate([[False], again])[: len(begins)]
    kept = ~blank
    kept[begins[~stays]] = False
    begins, after, breaks, owner = begins[stays], after[stays], breaks[stays], owner[stays]
    count = len(begins)
    if not count:
        return [], begins, begins, begins
    sizes = after - begins
    letters = seen[kept].tobytes()
    # Each token with the one separator after it.
    kept[after] = True
    line = np.where(blank, np.uint8(0x20), seen)[kept].tobytes()
    places = np.concatenate([[0], np.cumsum(sizes + 1)])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    ).dictionary_encode()
    hashes = hashes_of(words.dictionary)[words.indices.to_numpy()]
    new = np.concatenate([[True], owner[1:] != owner[:-1]])
    trigger = np.zeros(count, bool)
    if count >= REACH:
        key = hashes[: count - REACH + 1]
        for n in range(1, REACH):
            key = mixed(key, hashes[n : count - REACH + 1 + n])
        whole = owner[REACH - 1 :] == owner[: count - REACH + 1]
        trigger[: count - REACH + 1] = whole & (key % np.uint64(TRIGGER) == 0)
    starts = np.flatnonzero(new | trigger)
    # Long stretches without a trigger are cut by their length.
    extra = (np.diff(np.append(starts, count)) - 1) // MOST_STARTS
    if extra.any():
        more = [s + MOST_STARTS * np.arange(1, n + 1) for s, n in zip(starts[extra > 0], extra[extra > 0])]
        starts = np.sort(np.concatenate([starts, *more]))
    stops = np.append(starts[1:], count)
    # A chunk takes up to REACH tokens along, as many as its text has.
    last = np.append(np.flatnonzero(new)[1:], count)
    ends = np.minimum(stops + REACH, last[np.searchsorted(last, starts, "right")])
    froms, tos = places[starts].tolist(), (places[ends] - 1).tolist()
    spoken = np.concatenate([[0], np.cumsum(~breaks)])
    return [line[a:b] for a, b in zip(froms, tos)], stops - starts, spoken[stops] - spoken[starts], owner[starts]


def chunk_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, chunk, starts, weight, words): the distinct chunks, how often each occurs,
    and the words that start in all its occurrences."""
    bound_batches(docs.sparkSession)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in text_slices(text_array(batch["text"])):
                chunks, starts, words, owner = cut([t.encode() for t in part.to_pylist()])
                arrays = [
                    batch["lang"].take(pa.array(owner + at)),
                    pa.array(chunks, pa.large_binary()).cast(pa.large_string()),
                    pa.array(starts, pa.int32()),
                    pa.array(words, pa.int64()),
                ]
                found = pa.Table.from_arrays(arrays, ["lang", "chunk", "starts", "words"])
                found = found.group_by(["lang", "chunk", "starts"]).aggregate([([], "count_all"), ("words", "sum")])
                yield from found.rename_columns(["lang", "chunk", "starts", "weight", "words"]).to_batches(10_000)

    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))
    return (
        given.mapInArrow(parse, "lang string, chunk string, starts int, weight bigint, words bigint")
        .groupBy("lang", "chunk", "starts")
        .agg(F.sum("weight").alias("weight"), F.sum("words").alias("words"))
    )


# ---- phrases inside chunks


class Words:
    """The words of many chunks in a row."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        lists = pc.split_pattern(table["chunk"].combine_chunks().cast(pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        self.names = coded.dictionary
        self.codes = coded.indices.to_numpy().astype(np.int64)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        chunk = np.repeat(np.arange(len(lists)), np.diff(bounds))
        at = np.arange(len(chunk))
        broken = np.where(self.codes == pc.index(self.names, BREAK).as_py(), at, len(at))
        following = np.minimum.accumulate(broken[::-1])[::-1]
        # Words up to the next break or the end of the chunk; a break itself has none.
        self.left = np.minimum(bounds[1:][chunk], following) - at
        self.starting = at - bounds[:-1][chunk] < table["starts"].to_numpy()[chunk]
        self.weights = table["weight"].to_numpy()[chunk]
        langs = table["lang"].combine_chunks().dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy().astype(np.int64)[chunk]
        own = hashes_of(self.names)[self.codes]
        self.hashes = [mixed(hashes_of(self.langs)[self.lang], own)]
        for n in range(1, LONGEST):
            longer = self.hashes[-1].copy()
            longer[:-n] = mixed(longer[:-n], own[n:])
            self.hashes.append(longer)

    def places(self, n: int, floors: dict[int, np.ndarray]) -> np.ndarray:
        """Where phrases of n words start that count in this chunk and can be frequent, as
        far as that is known of their parts."""
        places = np.flatnonzero(self.starting & (self.left >= n))
        for size in sorted(floors):
            for shift in range(n - size + 1):
                places = places[passes(self.hashes[size - 1][places + shift], floors[size])]
        return places

    def phrases(self, n: int, places: np.ndarray) -> pa.Table:
        """(lang, phrase, f) of the phrases at these places, each once."""
        # The number of a phrase is made of that of its first words and that of its last;
        # they are numbered anew before a product outgrows 64 bits.
        number, bound = self.lang[places], len(self.langs)
        for k in range(n):
            if bound * len(self.names) >= 1 << 62:
                known, number = np.unique(number, return_inverse=True)
                bound = len(known)
            number, bound = number * len(self.names) + self.codes[places + k], bound * len(self.names)
        _, first, number = np.unique(number, return_index=True, return_inverse=True)
        sums = np.zeros(len(first), np.int64)
        np.add.at(sums, number, self.weights[places])
        at = places[first]
        parts = [self.names.take(pa.array(self.codes[at + k])) for k in range(n)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if n > 1 else parts[0]
        return pa.Table.from_arrays([self.langs.take(pa.array(self.lang[at])), phrase, pa.array(sums)], ["lang", "phrase", "f"])


def passes(hashes: np.ndarray, floor: np.ndarray) -> np.ndarray:
    bits = (len(floor) * 8).bit_length() - 1
    bucket = hashes >> np.uint64(64 - bits)
    return (floor[bucket >> np.uint64(3)] >> (bucket & np.uint64(7)).astype(np.uint8)) & 1 == 1


def gathered(batches: Iterator[pa.RecordBatch], size: int = GATHER_BYTES) -> Iterator[pa.Table]:
    """Batches put together to tables of about `size` bytes."""
    held, room = [], 0
    for batch in batches:
        held.append(batch)
        room += batch.nbytes
        if room >= size:
            yield pa.Table.from_batches(held)
            held, room = [], 0
    if room:
        yield pa.Table.from_batches(held)
    release_memory()


def frequent_buckets(
    chunks: DataFrame, sizes: list[int], floors: dict[int, np.ndarray], least: int, bits: int
) -> dict[int, np.ndarray]:
    """For each phrase length a bit per bucket of hashes: whether its phrases come to `least`.

    A task sends each range of buckets once, with counts that stop at `least`; the ranges
    are added up as they arrive, so no task holds more than one table of counts. What
    comes to the driver are the bits.
    """
    spark = chunks.sparkSession
    range_size = 1 << min(RANGE_BITS, bits)
    ranges = (1 << bits) // range_size
    kind = np.dtype("<u2")
    assert least < 1 << 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {n: np.zeros(1 << bits, np.int32) for n in sizes}
        for table in gathered(batches):
            words = Words(table)
            for n in sizes:
                places = words.places(n, floors)
                bucket = (words.hashes[n - 1][places] >> np.uint64(64 - bits)).astype(np.int64)
                # A weight beyond `least` says no more than `least`.
                np.add.at(tables[n], bucket, np.minimum(words.weights[places], least).astype(np.int32))
                np.minimum(tables[n], least, out=tables[n])
        for n, table in tables.items():
            parts = table.reshape(ranges, range_size)
            for r in np.flatnonzero(parts.any(axis=1)).tolist():
                yield pa.RecordBatch.from_pylist([{"n": n, "range": r, "counts": parts[r].astype(kind).tobytes()}], COUNTS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = row["n"], row["range"]
                counts = np.frombuffer(row["counts"], kind).astype(np.int32)
                sums[key] = np.minimum(sums[key] + counts, least) if key in sums else counts
        for (n, r), counts in sums.items():
            packed = np.packbits(counts >= least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_pylist([{"n": n, "range": r, "counts": packed}], COUNTS)

    schema = "n int, range int, counts binary"
    shared = chunks.mapInArrow(count, schema).repartition("n", "range").mapInArrow(merge, schema)
    found = {n: np.zeros((ranges, range_size // 8), np.uint8) for n in sizes}
    # At most 2**bits bits per length.
    for row in shared.collect():
        found[row["n"]][row["range"]] = np.frombuffer(row["counts"], np.uint8)
    return {n: bits.reshape(-1) for n, bits in found.items()}


COUNTS = pa.schema([("n", pa.int32()), ("range", pa.int32()), ("counts", pa.binary())])


def phrase_counts(chunks: DataFrame, least: int = LEAST, bits: int | None = None) -> DataFrame:
    """(lang, phrase, f): exact counts of the phrases of 1 to LONGEST words that occur
    `least` times or more. `chunks` should be stored, it is read several times."""
    if bits is None:
        words = chunks.agg(F.sum("words")).first()[0] or 0
        bits = min(max(int(words).bit_length(), LEAST_BITS), MOST_BITS)
    short = frequent_buckets(chunks, [1, 2], {}, least, bits)
    floors = short | frequent_buckets(chunks, list(range(3, LONGEST + 1)), short, least, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(batches):
            words = Words(table)
            for n in range(1, LONGEST + 1):
                places = words.places(n, {size: floor for size, floor in floors.items() if size <= n})
                yield from words.phrases(n, places).to_batches(10_000)

    counted = chunks.mapInArrow(count, "lang string, phrase string, f bigint")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


# ---- scores


def _exact(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more.

    A phrase is cut after each of its words but the last; l and r are the counts of the
    two parts, and the cut with the lowest score counts, the first of equal ones.
    """
    words = F.split("phrase", " ")
    phrases = counts.where(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("f").alias("a"), words.alias("_words"))
    cuts = phrases.select(
        "lang", "phrase", "a", "_words", F.explode(F.sequence(F.lit(1), F.size("_words") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("_words", F.lit(1), F.col("k")), " ").alias("_first"),
        F.array_join(F.slice("_words", F.col("k") + 1, F.size("_words")), " ").alias("_rest"),
    )
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    # Each part occurs as often as its phrase at least, so every row finds both.
    both = cuts.join(part("_first", "l"), ["lang", "_first"]).join(part("_rest", "r"), ["lang", "_rest"])
    both = both.withColumns({"_a": _exact("a"), "_lr": _exact("l") + _exact("r")})
    score = F.expr(f"cast({SCALE} as decimal(7,0)) * _a div _lr")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_cut")
    return both.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")


def not_contained(candidates: DataFrame, counts: DataFrame, share: int = SHARE) -> DataFrame:
    """Candidates without those that lie in a longer phrase with `share` percent of their
    occurrences."""
    words = F.split("phrase", " ")
    longer = counts.select("lang", "f", words.alias("_words")).where(F.size("_words") > 2)
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("_words") - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.size("_words") - n + 1),
                lambda at: F.array_join(F.slice("_words", at, n), " "),
            ),
        )
    )
    inside = (
        longer.select("lang", "f", F.explode(spans).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("_most"))
    )
    kept = F.col("_most").isNull() | (_exact("_most") * 100 < _exact("a") * share)
    return candidates.join(inside, ["lang", "phrase"], "left").where(kept).drop("_most")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", *, least: int = LEAST, top: int = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language, by
    score, then count, then in byte order.

    n is the number of words of the language. Shares and scores are whole numbers,
    computed without rounding.
    """
    chunks = stored(chunk_counts(docs, text, lang), "chunks")
    total = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
    counts = stored(phrase_counts(chunks, least), "phrases")
    kept = not_contained(scored(counts), counts)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # The best of each share of a language first, so that the one task that ranks a language
    # gets RANK_SHARES * top rows at most, whatever the number of tasks before it.
    share = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SHARES))
    place = F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))
    best = kept.withColumn("_share", share).withColumn("_place", place).where(F.col("_place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
