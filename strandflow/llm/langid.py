"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased and everything but letters becomes a space (runs collapse); its 1- to ``ORDER``-grams of characters
are hashed into ``BUCKETS`` buckets.  Training sums bucket counts by language: partitions emit their sums in blocks,
which are added by (language, block), so neither a language nor a partition ever gathers in one row or task.  The
log-probability matrix (languages x BUCKETS x 4 bytes, 256 kB a language) is broadcast; scoring gathers it at the
n-grams that occur.  The languages are counted first: the ``MAX_LANGS`` most frequent ones have rows in the matrix (64 MB
at most); any others are kept sparse, as the buckets that their training rows fill, and add what these differ from an
empty bucket.  The training sample bounds both.

``MAX_TRAIN`` bounds the training rows: with more labelled rows, a sample of about that many is taken by a hash of the
id, at every size in the same way.  All documents are scored, whole.

Defined results: ``und`` with score 0 if the text is null or has no letters, or if nothing could be learned; else score
is the posterior probability of the predicted language.  Ties go to the language first in order.  Rows that repeat get
equal rows; ids keep their type, nulls included (a null id is not held out and may be learned from).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

ORDER = 3
BUCKETS = 1 << 16
MAX_TRAIN = 40_000
MAX_LANGS = 256
ALPHA = 0.3
_BLOCK = 4096
_LETTER = np.array([chr(c).isalpha() for c in range(0x3000)])
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def letters(text: str) -> np.ndarray:
    """Lower-cased letters, with one space between runs and at both ends; empty if there are no letters."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    ok = _LETTER[np.minimum(cp, 0x2FFF)] & (cp < 0x3000)
    high = np.flatnonzero(cp >= 0x3000)
    if len(high):
        values, inv = np.unique(cp[high], return_inverse=True)
        ok[high] = np.array([chr(v).isalpha() for v in values])[inv]
    if not ok.any():
        return np.zeros(0, np.uint32)
    out = np.full(len(cp) + 2, 32, np.uint32)
    out[1:-1][ok] = cp[ok]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
    return out[keep]


def grams(chars: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams of one text."""
    h = chars * _MULT[0]
    parts = []
    for n in range(1, ORDER + 1):
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _MULT[n - 1] + chars[n - 1 :] * _MULT[0]
            if not len(h):
                break
        parts.append((h ^ (h >> np.uint32(13))) * np.uint32(0x27D4EB2F) >> np.uint32(16))
    return np.concatenate(parts).astype(np.int64)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for pdf in C.batches(batches):
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            docs[lang] = docs.get(lang, 0) + 1
            chars = letters(text)
            if lang not in total:
                total[lang] = np.zeros(BUCKETS, np.int64)
            if len(chars):
                total[lang] += np.bincount(grams(chars), minlength=BUCKETS)
    rows = [(k, b, docs[k] if b == 0 else 0, v[b * _BLOCK : (b + 1) * _BLOCK].tobytes()) for k, v in total.items() for b in range(BUCKETS // _BLOCK)]
    yield pd.DataFrame(rows, columns=["lang", "block", "docs", "counts"], dtype=object)


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(x, np.int64) for x in pdf["counts"]], axis=0)
    return pd.DataFrame({"lang": pdf["lang"][:1].astype(object), "block": pdf["block"][:1], "docs": [pdf["docs"].sum()], "counts": [total.tobytes()]})


def sample_share(rows: int, most: int) -> int:
    """Of 2**20 hash values, how many are taken so that about ``most`` rows remain."""
    return 1 << 20 if rows <= most else max(1, (most << 20) // rows)


class Model:
    """``rare``: languages beside those of the matrix, their numbers of documents, and (language, bucket, count) of the
    buckets that they fill, as three arrays."""

    def __init__(self, langs: list[str], docs: np.ndarray, counts: np.ndarray, rare: tuple[list[str], np.ndarray, tuple[np.ndarray, ...]] | None = None):
        p = (counts + ALPHA) / (counts.sum(1, keepdims=True) + ALPHA * BUCKETS)
        others, other_docs, (lang, bucket, count) = rare or ([], np.zeros(0), (np.zeros(0, np.int64),) * 3)
        self.logp, every = np.log(p).astype(np.float32), np.concatenate([docs, other_docs])
        self.langs = [*langs, *others]
        prior = np.log((every + 1) / (every.sum() + len(every)))
        self.prior, self.rare_prior = prior[: len(langs)], prior[len(langs) :]
        # by bucket: the languages that fill it, and by how much more than an empty one it counts
        order = np.argsort(bucket, kind="stable")
        self.who, self.at = lang[order], np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        self.more = np.log((count[order] + ALPHA) / ALPHA)
        self.empty = np.log(ALPHA / (np.bincount(lang, count, len(others)) + ALPHA * BUCKETS))

    def _rare(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Texts x rare languages."""
        n = self.at[flat + 1] - self.at[flat]
        entry = np.repeat(self.at[flat] - np.cumsum(n) + n, n) + np.arange(n.sum())
        cell = np.repeat(np.repeat(np.arange(len(sizes)), sizes), n) * len(self.empty) + self.who[entry]
        found = np.bincount(cell, self.more[entry], len(sizes) * len(self.empty)).reshape(len(sizes), -1)
        return found + sizes[:, None] * self.empty + self.rare_prior

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if not self.langs:
            return out
        made = [(i, grams(c)) for i, c in ((i, letters(t)) for i, t in enumerate(texts)) if len(c)]
        if not made:
            return out
        flat, sizes = np.concatenate([g for _, g in made]), np.array([len(g) for _, g in made])
        at = np.cumsum(sizes) - sizes
        score = np.zeros((len(made), len(self.logp))) + self.prior
        for k, row in enumerate(self.logp):
            score[:, k] += np.add.reduceat(row[flat], at, dtype=np.float64)
        if len(self.empty):
            score = np.concatenate([score, self._rare(flat, sizes)], 1)
        score -= score.max(1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(1, keepdims=True)
        # of equal ones the language first in order
        names = np.argsort(np.argsort(np.array(self.langs, object)))
        best = np.where(p == p.max(1, keepdims=True), names, len(names)).argmin(1)
        for (i, _), k, row in zip(made, best, p, strict=True):
            out[i] = (self.langs[k], float(row[k]))
        return out


def _filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, bucket, n) of each text; bucket -1: a text of the language."""
    for pdf in C.batches(batches):
        out: list[tuple[str, int, int]] = []
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            chars = letters(text)
            b, n = np.unique(grams(chars), return_counts=True) if len(chars) else (np.zeros(0, int),) * 2
            out += [(lang, -1, 1), *((lang, int(x), int(y)) for x, y in zip(b, n, strict=True))]
        yield pd.DataFrame(out, columns=["lang", "bucket", "n"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = MAX_TRAIN) -> Model:
    """Learn from rows that are not held out and have text and language."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(~C.held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    by_lang = rows.groupBy("lang").count()
    top = by_lang.orderBy(F.desc("count"), "lang").limit(MAX_LANGS + 1).collect()
    total = sum(r["count"] for r in top) if len(top) <= MAX_LANGS else by_lang.agg(F.sum("count")).first()[0]
    rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < sample_share(total, most))
    rare = None
    if len(top) > MAX_LANGS:
        frequent = F.col("lang").isin([r["lang"] for r in top[:MAX_LANGS]])
        got = rows.where(~frequent).mapInPandas(_filled, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        rows = rows.where(frequent)
        names = sorted(got["lang"].unique())
        number = got["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(np.int64)
        bucket, n = got["bucket"].to_numpy(np.int64), got["n"].to_numpy(np.int64)
        text, full = bucket < 0, bucket >= 0
        rare = (names, np.bincount(number[text], n[text], len(names)), (number[full], bucket[full], n[full]))
    schema = "lang string, block int, docs long, counts binary"
    got = rows.mapInPandas(_sums, schema).groupBy("lang", "block").applyInPandas(_add, schema).collect()
    langs = sorted({r["lang"] for r in got})
    counts, n = np.zeros((len(langs), BUCKETS), np.int64), np.zeros(len(langs))
    for r in got:
        k = langs.index(r["lang"])
        counts[k, r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] = np.frombuffer(r["counts"], np.int64)
        n[k] += r["docs"]
    return Model(langs, n, counts, rare)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score; one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, id_col, text_col, lang_col))

    def judge(texts: list[str | None]) -> list:
        return list(zip(*shared.value.predict([t or "" for t in texts]), strict=True))

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = C.per_text(src, "lang_pred string, score double", lambda: judge, 500_000)
    return out.select("doc_id", C.held_out().alias("held_out"), "lang_pred", "score")
