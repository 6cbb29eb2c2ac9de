"""Token counts and ids under fixed vocabularies.

``count_tokens`` counts byte-level BPE tokens by rank-synchronous merging: the distinct pre-tokens of a batch lie in one
ragged numpy array of symbols, and in each round every pre-token's lowest-rank pair is merged at all its places at
once, for all pre-tokens together; what survives is counted.  Merging all places of the lowest pair at once gives the
same symbols as merging them one by one from the left, since a merge can only make pairs of a higher rank; overlapping
places (as in "aaa") are taken alternately from the left.  A pre-token of over ``LONG`` bytes (base64, one letter
without end) would be scanned once for each of its many ranks; its places are kept by rank instead, so each round looks
at the places of the lowest rank and their neighbours only.

Counts of pre-tokens are kept between batches in a dictionary of at most ``CACHE`` entries a worker; beyond that they
are merged again, so the bound changes no result.  Pre-tokens of over ``LONG`` bytes are not kept.

The vocabulary file is opened by its path on every executor: install it there, or send it with ``addFile`` and pass that
path.

Defined results: null text counts as empty (0 tokens); strings of special tokens inside a text are one token each, as
the library takes them by default; rows that repeat get equal rows; ids keep their type, nulls included.
"""

from __future__ import annotations

import array
import heapq
import json
import os
import re
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

LIMIT = 1024
CACHE = 100_000
#: Bytes of distinct pre-tokens that one merging step holds, and bytes from which a pre-token is merged by itself.
STEP, LONG = 1_500_000, 1000
#: Pieces of text whose ids are kept by a tokenizer of words, and their greatest length in bytes.
PIECES, SHORT = 400_000, 100
#: The pre-token patterns of the two vocabularies (fixed values).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(extra))
        extra += b not in plain
    return out


class RankMerger:
    """Merging of ragged symbol arrays under a vocabulary file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.key, self.rank = key[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.first = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pattern = regex.compile(BYTE_LEVEL)
        self.cache: dict[str, int] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; len(made) where there is no merge."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
        return np.where(self.key[at] == pair, self.rank[at], len(self.made))

    def merge_long(self, token: bytes) -> int:
        """How many symbols survive in one long token; symbols are a linked list, places are kept by rank."""
        n, none = len(token), len(self.made)
        sym = np.append(self.first[np.frombuffer(token, np.uint8)], -1)
        nxt, prv = np.minimum(np.arange(1, n + 2), n), np.maximum(np.arange(-1, n), 0)
        rank = np.full(n + 1, none)
        places: dict[int, list[np.ndarray]] = defaultdict(list)
        waiting: list[int] = []

        def note(at: np.ndarray) -> None:
            after = nxt[at]
            rank[at] = np.where(after < n, self.ranks(sym[at], sym[after]), none)
            at = at[rank[at] < none]
            if not len(at):
                return
            at = at[np.argsort(rank[at], kind="stable")]
            values, begin = np.unique(rank[at], return_index=True)
            for r, part in zip(values.tolist(), np.split(at, begin[1:]), strict=True):
                if r not in places:
                    heapq.heappush(waiting, r)
                places[r].append(part)

        note(np.arange(n))
        count = n
        while waiting:
            r = heapq.heappop(waiting)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            at = every_second(nxt[at[:-1]] == at[1:], at)
            gone = nxt[at]
            sym[at] = self.made[r]
            rank[gone] = none
            nxt[at] = nxt[gone]
            prv[nxt[at]] = at
            count -= len(at)
            note(np.unique(np.concatenate([at, prv[at]])))
        return count

    def merge(self, tokens: list[bytes]) -> np.ndarray:
        """How many symbols survive in each (non-empty) token."""
        size = np.array([len(t) for t in tokens])
        sym = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        seq = np.repeat(np.arange(len(tokens)), size)
        none = len(self.made)
        out = np.zeros(len(tokens), np.int64)
        while len(sym):
            rank = np.full(len(sym), none, np.int32)  # of the pair that begins at each symbol
            rank[:-1] = np.where(seq[:-1] == seq[1:], self.ranks(sym[:-1], sym[1:]), none)
            begin = np.flatnonzero(np.diff(seq, prepend=-1))
            low = np.minimum.reduceat(rank, begin)
            count = np.diff(begin, append=len(sym))
            done = low == none
            out[seq[begin[done]]] = count[done]
            low, live = np.repeat(low, count), np.repeat(~done, count)
            hit = live & (rank == low)
            places = np.flatnonzero(hit)
            places = every_second(np.diff(places) == 1, places)
            sym[places] = self.made[rank[places]]
            live[places + 1] = False
            sym, seq = sym[live], seq[live]
        return out

    def count(self, texts: list[str | None]) -> list[int]:
        words: list[list[str]] = []
        extra = []
        for t in texts:
            if t and self.split and any(s in t for s in self.special):
                parts = self.split.split(t)
                extra.append(len(parts) - 1)
                words.append(list(chain.from_iterable(map(self.pattern.findall, parts))))
            else:
                extra.append(0)
                words.append(self.pattern.findall(t) if t else [])
        known = self.cache
        new = [w for w in {w for ws in words for w in ws} if w not in known]
        data = [w.encode("utf-8") for w in new]
        huge = [w for w, d in zip(new, data, strict=True) if len(d) > LONG]
        known.update((w, self.merge_long(w.encode("utf-8"))) for w in huge)
        short = [(w, d) for w, d in zip(new, data, strict=True) if len(d) <= LONG]
        for a, b in C.sized([d for _, d in short], STEP):
            known.update(zip([w for w, _ in short[a:b]], self.merge([d for _, d in short[a:b]]).tolist(), strict=True))
        out = [sum(map(known.__getitem__, ws)) + x for ws, x in zip(words, extra, strict=True)]
        for w in huge:
            del known[w]
        if len(known) > CACHE:
            known.clear()
        return out


def every_second(linked: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Of each run of places that overlap (``linked``: with the next one) the first, third and so on."""
    if not len(places):
        return places
    fresh = np.concatenate(([True], ~linked))
    i = np.arange(len(places))
    return places[(i - np.maximum.accumulate(np.where(fresh, i, 0))) % 2 == 0]


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; one row per row of ``docs``."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def make():
        merger = RankMerger(path)

        def judge(texts: list[str | None]) -> list:
            return [merger.count(texts), [len(t) for t in C.utf8(texts)]]

        return judge

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = C.per_text(src, "n_tokens long, n_bytes long", make)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


class Generations(dict):
    """Values of a function, kept in a dictionary of bounded size: when it is full it becomes the older one, from which
    entries in use come back.  Keys longer than ``longest`` are not kept."""

    def __init__(self, make: Callable, most: int = CACHE, longest: int = LONG):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


class WordTokenizer:
    """The library's ids, little-endian unsigned 32-bit.

    No pre-token holds white space, so a normalised text is cut at its ASCII white space first, and each distinct piece
    is cut into pre-tokens, and each distinct pre-token goes through the library's model, once while it is kept.
    """

    #: Lower-casing by Python equals the library's normaliser for texts of these characters.
    plain = regex.compile(r"[\x00-\x1b\x20-\x7e\xa1-\xac\xae-\u024f\u2010-\u2027\u2030-\u205e]*\Z")
    #: WORD_LEVEL for ASCII texts, which the standard library splits faster; its cases exclude each other but for the last.
    ascii_words = re.compile(r"[a-z]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\sa-z0-9]+", re.ASCII)

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model.tokenize
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.find: Callable = regex.compile(WORD_LEVEL).findall
        self.find_ascii: Callable = self.ascii_words.findall
        self.symbol = dict(enumerate(byte_symbols()))
        self.cache = Generations(self.ids, PIECES, SHORT)

    def ids(self, piece: bytes) -> bytes:
        """Ids of a piece of normalised text without ASCII white space, often a single pre-token."""
        word = piece.decode("utf-8")
        if not word.isalpha():
            words = self.find_ascii(word) if word.isascii() else self.find(word) if self.plain.match(word) else self.library_words(word)
            if len(words) != 1:
                return b"".join([self.cache[w.encode("utf-8")] for w in words])
            word = words[0]
        got = self.model(word if word.isascii() and word.isprintable() else word.encode("utf-8").decode("latin-1").translate(self.symbol))
        return array.array("I", [t.id for t in got]).tobytes()

    def library_words(self, text: str) -> list[str]:
        """Pre-tokens by the library itself, whose Unicode tables know fewer letters than those of ``regex``."""
        return [text[a:b] for _, (a, b) in self.lib.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[bytes] | None:
        if any(s in text for s in self.special):
            return None
        text = text.lower() if text.isascii() or self.plain.match(text) else self.lib.normalizer.normalize_str(text)
        return text.encode("utf-8").split()

    def encode(self, texts: list[str]) -> list[bytes]:
        known, out = self.cache.__getitem__, []
        for text in texts:
            pieces = self.pieces(text)
            out.append(array.array("I", self.lib.encode(text, add_special_tokens=False).ids).tobytes() if pieces is None else b"".join(map(known, pieces)))
            self.cache.trim()
        return out


@lru_cache(maxsize=1)
def _tokenizer(path: str, changed: int, size: int) -> WordTokenizer:
    return WordTokenizer(path)


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this file, one a process: the next task of a worker finds what the last one has kept."""
    at = os.stat(path)
    return _tokenizer(path, at.st_mtime_ns, at.st_size)
