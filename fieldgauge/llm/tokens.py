"""Token ids of whole texts, word by word with a memory of words seen.

The vocabulary's pre-tokenizer never joins what white space separates, so the ids of a
text are the ids of its words in order. Words made of Latin-1 characters are cut by the
same pattern that the vocabulary file states and each piece goes to the library's model;
all other words go through the whole library. Both ways give the library's ids.
"""

from __future__ import annotations

import re
from functools import lru_cache
from operator import attrgetter
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import release_memory

# The pre-tokenizer's pattern, with its Unicode classes written out for
# Latin-1, and the strings of special tokens' first characters.
PIECE = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^a-z0-9ªµºß-öø-ÿ²³¹¼½¾]+"
)
PLAIN = re.compile(r"[!-~¡-ÿ]*")
SPECIAL_START = "<|"
END_ID = 1
# Pieces of which one worker remembers the values: so many of late, and as many before.
MEMORY = 120_000
# Text encoded at once: what goes along with it in memory is many times larger.
SLICE_BYTES = 2 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


LETTERS = byte_letters()


_LETTER_OF = dict(enumerate(LETTERS))


def as_letters(piece: str) -> str:
    return piece if piece.isascii() else piece.encode().decode("latin-1").translate(_LETTER_OF)


_id_of = attrgetter("id")


def as_bytes(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


class Memory(dict):
    """A dictionary that computes missing values and forgets all when it is full."""

    def __init__(self, make, limit: int = MEMORY):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Encoder:
    """Ids of texts under one vocabulary file of the tokenizers library."""

    kind = np.dtype("<u4")
    memory = MEMORY

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.late: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def make_piece(self, piece: str) -> bytes:
        return as_bytes(list(map(_id_of, self.model.tokenize(as_letters(piece)))))

    def make_other(self, word: str) -> bytes:
        return as_bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def piece(self, piece: str) -> bytes:
        value = self.late.get(piece)
        if value is None:
            value = self.late[piece] = self.before.get(piece) or self.make_piece(piece)
        return value

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.piece(word.lower())
        if PLAIN.fullmatch(word) and SPECIAL_START not in word:
            own = PIECE.findall(word.lower())
            return self.piece(own[0]) if len(own) == 1 else b"".join(map(self.piece, own))
        # Never equal to a piece of a plain word, so both can share the memory.
        if word not in self.late:
            self.late[word] = self.before.get(word) or self.make_other(word)
        return self.late[word]

    def values(self, words: list[str]) -> list[bytes]:
        """What is known of each word."""
        if len(self.late) > self.memory:
            self.late, self.before = {}, self.late
        # A word that is a piece has the values of that piece, so most are one look-up.
        late, before, found = self.late, self.before, list(map(self.late.get, words))
        for n, value in enumerate(found):
            if value is None:
                word = words[n]
                value = before.get(word)
                if value is None:
                    found[n] = self.word(word)
                else:
                    found[n] = late[word] = value
        return found

    def forget(self) -> None:
        """Give the memory back; called when a task ends."""
        self.late, self.before = {}, {}
        release_memory()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All values of the texts in a row, and where each text's values begin and end."""
        words, places, bounds = distinct_words(texts)
        return spread(self.values(words), places, bounds, self.kind)


def distinct_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the number of the word at each place, and the places of each text.

    So that there are fewer, letters are lowered, which the library does anyway, and a
    comma or full stop between a letter and a blank becomes a word, as it is a piece of
    its own there. Texts with what could begin a special token stay as they are.
    """
    if not pc.any(pc.match_substring(texts, SPECIAL_START)).as_py():
        texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([,.])(\s)", r"\1 \2\3")
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    bounds = lists.offsets.to_numpy()
    # Several times faster than to_pylist(), which makes a scalar of each.
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    return words, coded.indices.to_numpy(), bounds - bounds[0]


def spread(
    blobs: list[bytes], places: np.ndarray, bounds: np.ndarray, kind: np.dtype
) -> tuple[np.ndarray, np.ndarray]:
    """Put the values of each word at the word's places; also return each text's bounds."""
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // kind.itemsize
    pool = np.frombuffer(b"".join(blobs), kind)
    first = np.cumsum(sizes) - sizes
    counts = sizes[places]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    values = pool[np.repeat(first[places] - (ends - counts), counts) + np.arange(total)]
    return values, np.concatenate([[0], ends])[bounds]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary, kept between tasks."""
    return Encoder(path)


def with_end(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with an end id after each text, and the new bounds."""
    return np.insert(ids, bounds[1:], END_ID), bounds + np.arange(len(bounds))


def vocabulary(name: str) -> str:
    """Where the installed public vocabulary files lie; the package is on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
