"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a fixed lexicon and of terms learned from the labelled rows (words and word
beginnings that are much more frequent in toxic documents), closeness of such words to second-person pronouns, rates of
capitals, punctuation and symbols, and of obfuscated spellings (digits and symbols for letters, stretched letters).

Learning: ``MAX_TRAIN`` bounds the labelled rows, taken by a hash of the id; they are written once and give, first, term
statistics (summed by term, with a map-side count), then the feature matrix, at most MAX_TRAIN x 17 numbers, on which
the trees are grown on the driver.  Rows with crc32(id) mod 5 = 1 are kept out of the trees and calibrate their output
by pooling adjacent violators.  A learned term is in 2 % of the toxic rows at least, so what is broadcast is bounded by
50 times the mean number of different terms of such a row, whatever the corpus.

Defined results: null or empty text is scored by its (all zero) features; without labels of both kinds the score is the
share of toxic labels, or 0; labels other than 0 and 1 and repeated labels with the same value count once each row; ids keep their type, nulls
included.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .langid import sample_share

MAX_TRAIN = 20_000
TREES, DEPTH, BINS, RATE = 80, 3, 32, 0.15
NEAR = 4
#: Insults in several languages and second-person words.
LEXICON = frozenset("idiot idiots moron morons loser losers stupid dumb scum trash clown pathetic worthless disgusting imbecile fool jerk creep bastard bitch crap damn hate kill ugly vermin filth dummkopf trottel arschloch idiota imbécil estúpido basura asqueroso connard crétin débile salaud ordure".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes tus vosotros".split())
_WORD = re.compile(r"[^\W_]+")
_MASK = re.compile(r"[@$!|*.0134578]{1,3}(?=[^\W\d_])")
_TOKEN = re.compile(r"[^\W_]*(?:[@$!|*.]{1,3}[^\W_]+)*")
_PLAIN = str.maketrans("@$!|013457", "asiioieast")
_STRETCH = re.compile(r"([^\W\d_])\1\1")
_CLASS = np.zeros((256, 6))
_CLASS[65:91, 0] = 1
_CLASS[97:123, 1] = 1
_CLASS[[*b".,;:?!'\"-()"], 2] = 1
_CLASS[[*b"!"], 3] = 1
_CLASS[[*b"#$%&*@^~+=<>|\\/_"], 4] = 1
_CLASS[48:58, 5] = 1
N_FEATURES = 17
FIXED, WORD, START, YOU = 1, 2, 4, 8


class Features:
    def __init__(self, words: frozenset[str] = frozenset(), starts: frozenset[str] = frozenset()):
        self.words, self.starts = words, starts
        self.cache: dict[str, int] = {}

    def code(self, w: str) -> int:
        return FIXED * (w in LEXICON) | WORD * (w in self.words) | START * (w[:4] in self.starts or w[:5] in self.starts) | YOU * (w in SECOND_PERSON)

    def row(self, text: str) -> list[float]:
        low = text.lower()
        words = _WORD.findall(low)
        cache = self.cache
        for w in set(words):
            if w not in cache:
                cache[w] = self.code(w)
        codes = np.frombuffer(bytes(map(cache.__getitem__, words)), np.uint8)
        if len(cache) > 50_000:
            cache.clear()
        n = max(len(words), 1)
        bad = np.flatnonzero(codes & (FIXED | WORD | START))
        fixed, word, start = (int(np.count_nonzero(codes[bad] & k)) for k in (FIXED, WORD, START))
        you = np.flatnonzero(codes & YOU)
        close = 0
        if len(bad) and len(you):
            at = np.searchsorted(you, bad)
            gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - bad), np.abs(you[np.maximum(at - 1, 0)] - bad))
            close = int((gap <= NEAR).sum())
        kinds = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256) @ _CLASS
        size = max(len(text), 1)
        masked = 0
        if kinds[4] or kinds[5] or kinds[3] or "." in text:
            seen = -1
            for m in _MASK.finditer(low):
                at = m.start()
                if at <= seen or not at or not low[at - 1].isalpha():
                    continue
                while at and (low[at - 1].isalnum() or low[at - 1] in "@$!|*."):
                    at -= 1
                whole = _TOKEN.match(low, at)
                seen = whole.end()
                plain = "".join(c for c in whole[0].translate(_PLAIN) if c.isalpha())
                masked += bool(self.code(plain) & (FIXED | WORD)) and not self.code(whole[0])
        stretched = len(_STRETCH.findall(low))
        return [np.log1p(len(words)), fixed / n, word / n, start / n, np.log1p(fixed), np.log1p(word), np.log1p(start), len(you) / n, close / n, kinds[0] / max(kinds[0] + kinds[1], 1), kinds[2] / size, kinds[3] / size, kinds[4] / size, kinds[5] / size, masked / n, np.log1p(masked), stretched / n]

    def matrix(self, texts: list[str]) -> np.ndarray:
        return np.array([self.row(t) for t in texts], np.float64).reshape(len(texts), N_FEATURES)


def terms(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words | {f"{w[:k]}*" for w in words for k in (4, 5) if len(w) > k}


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in C.batches(batches):
        bad, good = Counter(), Counter()
        for text, y in zip(pdf["text"], pdf["y"], strict=True):
            (bad if y else good).update(terms(text))
        keys = list(bad.keys() | good.keys())
        yield pd.DataFrame({"term": pd.Series(keys, dtype=object), "bad": [bad[k] for k in keys], "good": [good[k] for k in keys]})


class Trees:
    """Boosted regression trees on logistic loss, over histograms of binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        # rare positive values of a mostly-zero feature need a bin of their own
        self.edges = [np.unique(np.concatenate([e, np.quantile(c[c > 0], [0, 0.1, 0.5]) * (1 - 1e-9)])) if (c > 0).any() else e for e, c in zip(self.edges, x.T, strict=True)]
        b, width = self.bin(x), max(len(e) for e in self.edges) + 1
        p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(p / (1 - p)))
        self.trees: list[list[tuple]] = []
        f = np.full(len(y), self.base)
        for _ in range(TREES):
            prob = 1 / (1 + np.exp(-f))
            g, h = prob - y, prob * (1 - prob)
            node, splits = np.zeros(len(y), np.int64), []
            for depth in range(DEPTH):
                k = 1 << depth
                gain, choice = np.zeros(k), np.full((k, 2), -1)
                for c in range(b.shape[1]):
                    key = node * width + b[:, c]
                    sg, sh = (np.bincount(key, v, k * width).reshape(k, width).cumsum(1) for v in (g, h))
                    tg, th = sg[:, -1:], sh[:, -1:]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        v = sg**2 / (sh + 1) + (tg - sg) ** 2 / (th - sh + 1) - tg**2 / (th + 1)
                    v[(sh < 0.5) | (th - sh < 0.5)] = 0
                    at = v.argmax(1)
                    top = v[np.arange(k), at]
                    better = top > gain + 1e-12
                    gain[better], choice[better, 0], choice[better, 1] = top[better], c, at[better]
                splits.append(choice)
                go = choice[node]
                right = (go[:, 0] >= 0) & (b[np.arange(len(b)), np.maximum(go[:, 0], 0)] > go[:, 1])
                node = node * 2 + right
            n = 1 << DEPTH
            leaf = -RATE * np.bincount(node, g, n) / (np.bincount(node, h, n) + 1)
            f += leaf[node]
            self.trees.append((splits, leaf))

    def bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, f, i = self.bin(x), np.full(len(x), self.base), np.arange(len(x))
        for splits, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for choice in splits:
                go = choice[node]
                node = node * 2 + ((go[:, 0] >= 0) & (b[i, np.maximum(go[:, 0], 0)] > go[:, 1]))
            f += leaf[node]
        return f


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step function nearest to ``y``: pool adjacent violators; each value is pulled a little inwards."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum, weight, first, last score
    for s, v in zip(score[order], y[order], strict=True):
        if blocks and blocks[-1][3] == s:
            blocks[-1][0] += v
            blocks[-1][1] += 1
        else:
            blocks.append([v, 1, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a[0], blocks[-1][1] + a[1], blocks[-1][2], a[3]]
    at = np.array([x for b in blocks for x in (b[2], b[3])])
    value = np.array([(b[0] + 0.02) / (b[1] + 0.04) for b in blocks for _ in (0, 1)])
    return at, value


class Model:
    def __init__(self, features: Features, trees: Trees | None, at: np.ndarray, value: np.ndarray):
        self.features, self.trees, self.at, self.value = features, trees, at, value

    def score(self, texts: list[str]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.value[0])
        raw = self.trees.raw(self.features.matrix(texts))
        # between knots the curve is linear; a small share of the uncalibrated score orders equal values
        return np.clip(0.98 * np.interp(raw, self.at, self.value) + 0.02 / (1 + np.exp(-raw)), 0, 1)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MAX_TRAIN) -> Model:
    """Learn from labelled rows that are not held out."""
    scratch = C.Scratch(docs.sparkSession, "toxicity")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(~C.held_out() & F.col("y").isin(0, 1)).distinct()
    share = sample_share(known.count(), most)
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)  # about MAX_TRAIN rows of two numbers
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = scratch.write(texts.join(F.broadcast(known), "doc_id").withColumn("kept_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1))
    total = rows.groupBy("y").agg(F.count("*").alias("n"), F.count_if(~F.col("kept_out")).alias("fit")).collect()
    fitted, total = {r["y"]: r["fit"] for r in total}, {r["y"]: r["n"] for r in total}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    if not n1 or not n0:
        return Model(Features(), None, np.zeros(1), np.array([n1 / max(n1 + n0, 1)]))
    fit1, fit0 = (fitted.get(k, 0) for k in (1, 0))
    counts = rows.where("NOT kept_out").mapInPandas(_count_terms, "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = (F.col("bad") + 0.5) / (fit1 + 1) / ((F.col("good") + 0.5) / (fit0 + 1))
    # each is in a fiftieth of the toxic rows at least: at most 50 times the mean number of terms of such a row
    found = counts.where((F.col("bad") >= max(3, int(0.02 * fit1))) & (odds >= 8)).collect()
    features = Features(frozenset(r["term"] for r in found if not r["term"].endswith("*")), frozenset(r["term"][:-1] for r in found if r["term"].endswith("*")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in C.batches(batches):
            x = features.matrix(pdf["text"].tolist())
            yield pd.DataFrame({"y": pdf["y"], "kept_out": pdf["kept_out"], "x": list(x)})

    got = rows.mapInPandas(run, "y int, kept_out boolean, x array<double>").toPandas()
    x, y, out = np.stack(got["x"]), got["y"].to_numpy(float), got["kept_out"].to_numpy(bool)
    order = np.lexsort((*x.T, y, out))  # the same trees whatever order the rows came in
    x, y, out = x[order], y[order], out[order]
    if len(set(y[~out])) < 2 or len(set(y[out])) < 2:
        out = np.zeros(len(y), bool)
    trees = Trees(x[~out], y[~out])
    cal = out if out.any() else np.ones(len(y), bool)
    return Model(features, trees, *isotonic(trees.raw(x[cal]), y[cal]))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels, id_col, text_col))

    def judge(texts: list[str | None]) -> list:
        return [shared.value.score([t or "" for t in texts])]

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = C.per_text(src, "score double", lambda: judge)
    return out.select("doc_id", C.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``limit``, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col))
    return C.filter_rows(docs, text_col, lambda: lambda texts: shared.value.score([t.decode("utf-8") for t in texts]) < limit)
