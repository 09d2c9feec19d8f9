"""Token counts of every prefix of a text, from one pass over it.

The token count of a prefix is the count up to the last finished piece plus the count of
the unfinished piece, and that is looked up by word. Inside a piece, whatever its length,
a dynamic program over positions finds the last token of every prefix: the encoding of a
prefix is the encoding of a shorter prefix plus one token, and of all tokens that end there
only one forms a pair with the token before it which the merges would leave as it is.

What is stored per text is the step of the count at each character (two bytes, nearly
always 0 or 1). Running sums of the steps answer how many tokens a prefix has and which
prefix fits a budget, without encoding anything again. Counts may fall from one prefix to
the next, because a longer word can have fewer tokens.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from functools import lru_cache
from operator import sub
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, text_array, text_slices
from .tokens import LETTERS, PIECE, SLICE_BYTES, Encoder, Memory

STEP = np.dtype("<i2")
# Prefixes up to this length are shared by so many pieces that they are remembered.
HEAD = 6
# Entries of each of the memories of such prefixes and of pairs of tokens, about 100 bytes each.
MEMORIES = 400_000
# Pieces that are remembered, so many of late and as many before, about 250 bytes each.
PIECES = 500_000
# What a string can be in the vocabulary, as bits.
INSIDE, ENDING = 1, 2
# Pieces that are looked at again before a half-finished character.
MARGIN = 2


def is_contraction(piece: str) -> bool:
    return len(piece) > 1 and piece[0] == "'" and piece[1].isalpha()


def as_steps(counts: list[int]) -> bytes:
    return pack(f"<{len(counts)}h", *map(sub, counts, [0, *counts[:-1]]))


class PrefixEncoder(Encoder):
    """As Encoder, but what is known of a word is the step of the count at each character."""

    kind = STEP
    # The steps of a piece cost more to find than its ids.
    memory = PIECES

    def __init__(self, path: str):
        super().__init__(path)
        self.heads = Memory(self._head, MEMORIES)
        self.inner_pairs = Memory(self._inner_pair, MEMORIES)
        self.last_pairs = Memory(self._last_pair, MEMORIES)
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self._inner = None

    @property
    def inner(self):
        """The same merges without word ends, for the part of a piece before its last token."""
        if self._inner is None:
            from tokenizers.models import BPE

            with open(self.path, encoding="utf-8") as file:
                model = json.load(file)["model"]
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            self._inner = BPE(vocab=model["vocab"], merges=merges)
            self._suffix = model["end_of_word_suffix"] or ""
            # What a string can be: a token inside a word, one that ends a word, or both.
            self._kinds = {}
            for token in model["vocab"]:
                ends = token.endswith(self._suffix)
                name = token.removesuffix(self._suffix) if ends else token
                self._kinds[name] = self._kinds.get(name, 0) | (ENDING if ends else INSIDE)
            self._reach = max(map(len, self._kinds))
        return self._inner

    def _inner_pair(self, pair: tuple[str, str]) -> bool:
        left, right = pair
        return [t.value for t in self.inner.tokenize(left + right)] == [t for t in pair if t]

    def _last_pair(self, pair: tuple[str, str]) -> bool:
        left, right = pair
        return [t.value for t in self.model.tokenize(left + right)] == [t for t in (left, right + self._suffix) if t]

    def count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def make_piece(self, piece: str) -> bytes:
        return as_steps(self.piece_counts(piece))

    def make_other(self, word: str) -> bytes:
        return as_steps(self.word_counts(word))

    def piece_counts(self, piece: str) -> list[int]:
        return self.contraction_counts(piece) if is_contraction(piece) else self.run_counts(piece)

    def contraction_counts(self, piece: str) -> list[int]:
        """A cut contraction falls into pieces that the whole one doesn't have."""
        cut = [PIECE.findall(piece[:n]) for n in range(1, len(piece) + 1)]
        return [sum(self.run_counts(p)[-1] for p in own) for own in cut]

    def _head(self, head: str) -> tuple[str | None, int, int]:
        shorter = [("", 0, 0), *(self.heads[head[:n]] for n in range(1, len(head)))]
        last, number, ended = map(list, zip(*shorter))
        self._extend(head, last, number, ended)
        return last[-1], number[-1], ended[-1]

    def _extend(self, text: str, last: list[str | None], number: list[int], ended: list[int]) -> None:
        """Add what is known of each further prefix, from its shorter prefixes: the last
        token and the number of tokens if the word goes on, and the number if it ends there.

        Of the tokens that end there, the last one is that which the merges leave as it is
        behind the last token of the prefix before it.
        """
        kinds, reach, inner, closing = self._kinds, self._reach, self.inner_pairs, self.last_pairs
        for end in range(len(last), len(text) + 1):
            token_here, number_here, ended_here, wanted = None, 0, 0, INSIDE | ENDING
            for start in range(end - 1, max(-1, end - reach - 1), -1):
                token = text[start:end]
                kind = kinds.get(token, 0) & wanted
                if not kind:
                    continue
                before = last[start]
                if before is None:
                    continue
                pair = before, token
                if kind & INSIDE and inner[pair]:
                    token_here, number_here = token, number[start] + 1
                    wanted &= ENDING
                if kind & ENDING and closing[pair]:
                    ended_here = number[start] + 1
                    wanted &= INSIDE
                if not wanted:
                    break
            last.append(token_here)
            number.append(number_here)
            ended.append(ended_here or len(self.model.tokenize(text[:end])))

    def run_counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a piece that is one run of letters or one of signs."""
        assert self.inner
        shown = piece.isascii() and piece.isprintable()
        text = piece if shown else "".join(LETTERS[b] for b in piece.encode())
        heads = self.heads
        known = [heads[text[:n]] for n in range(1, min(len(text), HEAD) + 1)]
        last, number, ended = map(list, zip(("", 0, 0), *known))
        self._extend(text, last, number, ended)
        if len(text) == len(piece):
            return ended[1:]
        ends = np.cumsum([len(char.encode()) for char in piece])
        return [ended[end] for end in ends.tolist()]

    def word_counts(self, word: str) -> list[int]:
        """Tokens of each prefix of a word of any characters, special strings included."""
        counts, base, at = [], 0, 0
        for special in self.special.finditer(word):
            # Until its last character is there, a special string is ordinary text.
            own = self.plain_counts(word[at : special.end() - 1])
            counts += [base + n for n in own]
            base += (own[special.start() - at - 1] if special.start() > at else 0) + 1
            counts.append(base)
            at = special.end()
        return counts + [base + n for n in self.plain_counts(word[at:])]

    def plain_counts(self, word: str) -> list[int]:
        # Clusters are normalised on their own: a new one starts at a character that does
        # not combine with those before it.
        begins: list[int] = []
        for n, char in enumerate(word):
            own = word[begins[-1] : n] if begins else ""
            if (
                not begins
                or char.isascii()
                or not unicodedata.combining(char)
                and unicodedata.normalize("NFC", own + char)
                == unicodedata.normalize("NFC", own) + unicodedata.normalize("NFC", char)
            ):
                begins.append(n)
        normalise = self.tokenizer.normalizer.normalize_str
        parts = [normalise(word[a:b]) for a, b in zip(begins, [*begins[1:], len(word)])]
        text = "".join(parts)
        # Where each cluster begins and ends in the normalised text.
        at = [0, *np.cumsum([len(p) for p in parts]).tolist()]
        counts, stop, starts = [0], 0, set()
        for _, (start, end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            # What lies between pieces has no tokens, so the count stays.
            before = counts[-1]
            counts += [before] * (start - stop)
            counts += [before + n for n in self.piece_counts(text[start:end])]
            stop = end
            starts.add(start)
        counts += [counts[-1]] * (len(text) - stop)
        found = []
        anchors = [n for n in range(len(begins)) if at[n] in starts]
        for n, (a, b) in enumerate(zip(begins, [*begins[1:], len(word)])):
            if b - a > 1:
                # A part of a cluster is not a prefix of the normalised text: these are
                # counted anew from a cluster at which a piece begins.
                back = bisect_right(anchors, n) - 1 - MARGIN
                first = anchors[back] if back >= 0 else 0
                found += [counts[at[first]] + self.count(word[begins[first] : a + m]) for m in range(1, b - a)]
            found.append(counts[at[n + 1]])
        return found

    def text_steps(self, texts: pa.Array) -> list[bytes]:
        """The steps of whole texts; white space has the step 0."""
        steps, ends = self.encode(texts)
        found = []
        for n, text in enumerate(texts.to_pylist()):
            own = steps[ends[n] : ends[n + 1]]
            chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
            blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
            out = np.zeros(len(chars), STEP)
            out[~blank] = own
            found.append(out.tobytes())
        return found


@lru_cache(maxsize=2)
def prefix_encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(path)


def prefix_steps(path: str):
    """Arrow function: text to the stored steps; null counts as the empty text."""

    @F.arrow_udf(T.BinaryType())
    def steps(texts: pa.Array) -> pa.Array:
        known = prefix_encoder(path)
        found = [s for _, part in text_slices(text_array(texts), SLICE_BYTES) for s in known.text_steps(part)]
        return pa.array(found, pa.binary())

    return steps


def _sums(steps: pa.Array):
    for value in steps:
        raw = value.as_buffer()
        yield None if raw is None else np.cumsum(np.frombuffer(raw, STEP), dtype=np.int64)


@F.arrow_udf(T.LongType())
def tokens_in_prefix(steps: pa.Array, chars: pa.Array) -> pa.Array:
    """Tokens of the first `chars` characters; a larger number means the whole text."""
    found = []
    for sums, n in zip(_sums(steps), chars.to_pylist()):
        known = sums is not None and n is not None
        found.append(int(sums[min(n, len(sums)) - 1]) if known and n > 0 and len(sums) else 0 if known else None)
    return pa.array(found, pa.int64())


@F.arrow_udf(T.LongType())
def longest_prefix(steps: pa.Array, budget: pa.Array) -> pa.Array:
    """Characters of the longest prefix of at most `budget` tokens."""
    found = []
    for sums, most in zip(_sums(steps), budget.to_pylist()):
        if sums is None or most is None:
            found.append(None)
            continue
        fits = np.flatnonzero(sums <= most)
        found.append(int(fits[-1]) + 1 if len(fits) else 0)
    return pa.array(found, pa.int64())


SUMMARY = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("fitting_chars", T.LongType())])


def prefix_summary(budget: int):
    """Arrow function of the steps alone: tokens of the whole text, and the characters of
    its longest prefix of at most `budget` tokens. Applied to `prefix_steps` directly, both
    run in the same Python worker and the steps never leave it."""

    @F.arrow_udf(SUMMARY)
    def run(steps: pa.Array) -> pa.Array:
        found = []
        for sums in _sums(steps):
            fits = np.flatnonzero(sums <= budget) if sums is not None else ()
            total = int(sums[-1]) if sums is not None and len(sums) else 0
            found.append({"n_tokens": total, "fitting_chars": int(fits[-1]) + 1 if len(fits) else 0})
        return pa.array(found, pa.struct([("n_tokens", pa.int64()), ("fitting_chars", pa.int64())]))

    return run


def with_prefix_steps(df: DataFrame, path: str, text: str = "text", into: str = "prefix_steps") -> DataFrame:
    """Add the steps of the column `text`; all other columns and rows stay.

    A null or empty text has no steps and no tokens. A column that has the name `into`
    already is replaced. Texts of any length are taken whole.
    """
    bound_batches(df.sparkSession)
    return df.withColumn(into, prefix_steps(path)(F.col(text)))
