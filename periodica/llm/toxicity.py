"""Operator 9: toxic spans by a linear-chain conditional random field.

Documents are labelled, tokens are not. From a bounded sample of labelled
documents, tokens of toxic documents that are much more frequent there than in
others get label 1, all other tokens 0. A two-state chain learns from them: a
token's state weight sums hashed features (the word, its first and last letters),
transitions couple neighbours. Forward-backward gives each token's probability of
being toxic; the document score is a logistic function of the expected number of
toxic tokens, the highest probability and the length, and runs of tokens of
probability 1/2 or more are the offending spans.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.llm.common import put_back, read, set_aside, ship


@dataclass(frozen=True)
class CrfRules:
    sample: int = 3000        # labelled documents that the model is fitted on
    bits: int = 18            # hashed features
    folds: int = 5            # documents whose fold is 0 are never learnt from
    more: float = 4.0         # times as frequent in toxic documents: label 1
    least: int = 3            # toxic documents that hold such a token
    steps: int = 25           # of the fit
    rate: float = 0.5
    l2: float = 1e-6
    limit: float = 0.5        # scores from here on are toxic
    texts: int = 256          # texts scored together
    known_words: int = 100_000     # cached by a Python worker, which lives on through later stages


EDGES = ".,;:!?\"'()[]{}*#$%&-_"


def features(word: bytes, bits: int) -> tuple[int, int, int]:
    w = word.decode().lower().strip(EDGES).encode()
    mask = (1 << bits) - 1
    return zlib.crc32(b"w" + w) & mask, zlib.crc32(b"p" + w[:4]) & mask, zlib.crc32(b"s" + w[-4:]) & mask


LENGTH = 64  # steps of one piece of the chain


def marginals(odds: np.ndarray, opens: np.ndarray, start: np.ndarray, trans: np.ndarray,
              pairs: bool = False) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """Probability of state 1 at each token of many documents laid end to end.

    With ``pairs`` also, as rows 00, 01, 10, 11, those of the states of the token
    before and of the token; they mean nothing at first tokens.

    ``odds`` is exp(state weight) of state 1 against 0, ``opens`` marks first
    tokens, ``start`` and ``trans`` are positive weights. The chain is cut into
    pieces of equal length that are run side by side: products over the pieces,
    then the messages between pieces, then the messages within each.
    """
    n = len(odds)
    if not n:
        return (np.zeros(0), np.zeros((4, 0))) if pairs else np.zeros(0)
    rows = -(-n // LENGTH)
    m = np.zeros((4, rows * LENGTH))
    m[0], m[3] = 1.0, 1.0                                     # identity beyond the end
    m[0, :n], m[1, :n] = trans[0, 0], trans[0, 1] * odds
    m[2, :n], m[3, :n] = trans[1, 0], trans[1, 1] * odds
    m[0, :n][opens] = m[2, :n][opens] = start[0]              # a first token forgets what was before
    m[1, :n][opens] = m[3, :n][opens] = start[1] * odds[opens]
    m = np.ascontiguousarray(m.reshape(4, rows, LENGTH).transpose(0, 2, 1))
    a, b, c, d = (x.copy() for x in m[:, 0])
    for t in range(1, LENGTH):
        e, f, g, h = m[:, t]
        a, b, c, d = a * e + b * g, a * f + b * h, c * e + d * g, c * f + d * h
        top = np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a / top, b / top, c / top, d / top
    ahead, behind = np.empty((2, rows)), np.empty((2, rows))
    x, y = 0.5, 0.5
    for i, (p, q, r, s) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist())):
        ahead[0, i], ahead[1, i] = x, y
        x, y = x * p + y * r, x * q + y * s
        x, y = x / (x + y), y / (x + y)
    x, y = 0.5, 0.5
    for i, (p, q, r, s) in zip(range(rows - 1, -1, -1), zip(a[::-1].tolist(), b[::-1].tolist(), c[::-1].tolist(), d[::-1].tolist())):
        behind[0, i], behind[1, i] = x, y
        x, y = p * x + q * y, r * x + s * y
        x, y = x / (x + y), y / (x + y)
    fore = np.empty((2, LENGTH, rows))
    x, y = ahead
    for t in range(LENGTH):
        e, f, g, h = m[:, t]
        x, y = x * e + y * g, x * f + y * h
        z = x + y
        x, y = x / z, y / z
        fore[0, t], fore[1, t] = x, y
    out = np.empty((LENGTH, rows))
    both = np.empty((4, LENGTH, rows) if pairs else 0)
    x, y = behind
    for t in range(LENGTH - 1, -1, -1):
        one = fore[1, t] * y
        out[t] = one / (fore[0, t] * x + one)
        e, f, g, h = m[:, t]
        if pairs:
            u, v = fore[:, t - 1] if t else ahead
            both[:, t] = u * e * x, u * f * y, v * g * x, v * h * y
            both[:, t] /= both[:, t].sum(0)
        x, y = e * x + f * y, g * x + h * y
        z = x + y
        x, y = x / z, y / z
    p = out.T.reshape(-1)[:n]
    return (p, both.transpose(0, 2, 1).reshape(4, -1)[:, :n]) if pairs else p


@dataclass
class Model:
    weights: np.ndarray      # of the hashed features
    start: np.ndarray
    trans: np.ndarray
    scale: np.ndarray        # of the document's features

    def odds(self, words: list[bytes], bits: int) -> np.ndarray:
        f = np.array([features(w, bits) for w in words], np.int64).reshape(-1, 3)
        return np.exp(np.clip(self.weights[f].sum(1) + self.weights[-1], -30, 30))


def _opens(n: np.ndarray) -> np.ndarray:
    """Marks the first words of documents of these lengths."""
    opens = np.zeros(int(n.sum()), bool)
    opens[(np.cumsum(n) - n)[n > 0]] = True
    return opens


def document_features(p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """1, log of the expected toxic tokens, the highest probability, log of the length."""
    ends = np.cumsum(n)
    total = np.concatenate([np.zeros(1), np.cumsum(p)])
    expected = np.maximum(total[ends] - total[ends - n], 0)
    most = np.zeros(len(n))
    if (n > 0).any():
        most[n > 0] = np.maximum.reduceat(p, (ends - n)[n > 0])
    return np.column_stack([np.ones(len(n)), np.log(expected + 0.01), most, np.log1p(n)])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge * w)
    return w


class Sample:
    """Labelled documents as numbers of their distinct words, in parts of bounded length."""

    def __init__(self, texts: list[str], tokens: int = 150_000):
        number: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []     # word, first of its document, counts
        held: list[np.ndarray] = []
        for i, t in enumerate(texts):
            words = (t or "").encode().split()
            held.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
            if sum(map(len, held)) >= tokens or i == len(texts) - 1:
                n = np.array([len(x) for x in held], np.int64)
                self.parts.append((np.concatenate(held), _opens(n), n))
                held = []
        self.kinds = list(number)
        self.tokens = sum(len(p[0]) for p in self.parts)


def fit(texts: list[str], toxic: list[int], rules: CrfRules) -> Model:
    """The model of a sample of labelled documents; without any, all scores are 1/2."""
    size = (1 << rules.bits) + 1
    w, t, s = np.zeros(size), np.zeros((2, 2)), np.zeros(2)
    if not texts:
        return Model(w, np.exp(s), np.exp(t), np.zeros(4))
    data, y = Sample(texts), np.array(toxic, dtype=float)
    stems: dict[str, int] = {}
    stem = np.array([stems.setdefault(x.decode().lower().strip(EDGES), len(stems)) for x in data.kinds], np.int64)
    telling, seen, at = np.zeros(len(stems), bool), np.zeros((2, len(stems))), 0
    label = []
    for kind, _, n in data.parts:
        for words, one in zip(np.split(kind, np.cumsum(n)[:-1]), y[at:at + len(n)]):
            seen[int(one), np.unique(stem[words])] += 1
        label.append(np.repeat(y[at:at + len(n)], n) > 0)
        at += len(n)
    n1, n0 = max(1.0, y.sum()), max(1.0, len(y) - y.sum())
    telling = (seen[1] >= rules.least) & (seen[1] / n1 > rules.more * (seen[0] + 1) / n0)
    telling[[i for x, i in stems.items() if not x]] = False
    hot = telling[stem] if len(stem) else np.zeros(0, bool)
    feats = np.array([features(x, rules.bits) for x in data.kinds], np.int64).reshape(-1, 3)
    w[-1] = -5.0
    gw, gt, gs = np.full(size, 1e-8), np.full((2, 2), 1e-8), np.full(2, 1e-8)
    for _ in range(rules.steps if data.tokens else 0):
        odds = np.exp(np.clip(w[feats].sum(1) + w[-1], -30, 30))
        err, dt, ds = np.zeros(len(feats)), np.zeros((2, 2)), np.zeros(2)
        for (kind, opens, _), toxic_here in zip(data.parts, label):
            (p, both), target = marginals(odds[kind], opens, np.exp(s), np.exp(t), True), hot[kind] & toxic_here
            err += np.bincount(kind, target - p, len(feats))
            # transitions seen, less those expected by the pairwise marginals
            seen_here = np.bincount((2 * target[:-1] + target[1:])[~opens[1:]], minlength=4)
            dt += (seen_here - both[:, ~opens].sum(1)).reshape(2, 2)
            one = (target - p)[opens].sum()
            ds += np.array([-one, one])
        d = np.bincount(feats.ravel(), np.repeat(err, 3), size)
        d[-1] = err.sum()
        d, dt, ds = d / data.tokens - rules.l2 * w, dt / data.tokens, ds / data.tokens
        gw, gt, gs = gw + d * d, gt + dt * dt, gs + ds * ds
        w, t, s = (w + rules.rate * d / np.sqrt(gw), t + rules.rate * dt / np.sqrt(gt), s + rules.rate * ds / np.sqrt(gs))
    model = Model(w, np.exp(s), np.exp(t), np.zeros(4))
    odds = model.odds(data.kinds, rules.bits)
    x = [document_features(marginals(odds[kind], opens, model.start, model.trans), n) for kind, opens, n in data.parts]
    model.scale = _logistic(np.concatenate(x), y)
    return model


def fold(doc_id: Column, rules: CrfRules) -> Column:
    return F.crc32(doc_id.cast("string")) % rules.folds


def labelled_sample(docs: DataFrame, labels: DataFrame, rules: CrfRules) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents outside fold 0, chosen by hash."""
    some = (labels.filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), rules) != 0))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.sample)
            .withColumnRenamed("doc_id", "_l"))
    return (docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_l"))
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")).select("text", "toxic"))


class Scorer:
    """Scores batches of texts; the cache of word odds is bounded."""

    def __init__(self, model: Model, rules: CrfRules):
        self.model, self.rules, self.known = model, rules, {}

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        split = [(t or "").encode().split() for t in texts]
        new = list(set().union(*split).difference(self.known))
        self.known.update(zip(new, self.model.odds(new, self.rules.bits).tolist()))
        n = np.array([len(x) for x in split], np.int64)
        odds = np.fromiter((o for s in split for o in map(self.known.__getitem__, s)), float, int(n.sum()))
        if len(self.known) > self.rules.known_words:
            for w in new:
                del self.known[w]
        p = marginals(odds, _opens(n), self.model.start, self.model.trans)
        score = 1 / (1 + np.exp(-np.clip(document_features(p, n) @ self.model.scale, -30, 30)))
        spans, first = [], np.cumsum(n) - n
        for text, a, k in zip(texts, first.tolist(), n.tolist()):
            on = p[a:a + k] >= 0.5
            spans.append(_spans(text, on) if on.any() else [])
        return score, spans


def _spans(text: str, on: np.ndarray) -> list[tuple[int, int]]:
    """Code point offsets of the runs of marked words."""
    out: list[list[int]] = []
    before = False
    for mark, w in zip(on.tolist(), re.finditer(r"[^\x20\x09-\x0D]+", text)):
        if mark and before:
            out[-1][1] = w.end()
        elif mark:
            out.append([w.start(), w.end()])
        before = mark
    return [(a, b) for a, b in out]


_scorers: dict[int, Scorer] = {}


SCORED = T.StructType([T.StructField("_score", T.DoubleType()), T.StructField("_spans", T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])


def scored(docs: DataFrame, labels: DataFrame, rules: CrfRules, doc_id: str, text: str) -> DataFrame:
    """The columns of ``docs`` with ``_score`` and ``_spans``."""
    spark = docs.sparkSession
    ship(spark)
    pair = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = sorted(tuple(r) for r in labelled_sample(pair.filter("text IS NOT NULL"), labels, rules).collect())
    model = spark.sparkContext.broadcast(fit([r[0] for r in rows], [int(r[1] > 0) for r in rows], rules))
    key, at = hash(model.value.weights.tobytes()), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(model.value, rules)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for b in (x.slice(a, rules.texts) for x in batches for a in range(0, x.num_rows, rules.texts)):
            score, spans = _scorers[key].score(b.column(at).to_pylist())
            found = pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], span)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score), found],
                                             names=[*b.schema.names, "_score", "_spans"])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *SCORED.fields]))


def toxic_documents(docs: DataFrame, labels: DataFrame, rules: CrfRules = CrfRules(), doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, spans (code point offsets): one row per input row.

    A null or empty text has no tokens and no spans and a score from that alone;
    a null doc_id is in no fold; equal rows get equal scores; doc_id only joins
    labels and names folds, it is no input of a score. Whole texts are scored.
    Further columns are ignored; an empty table gives no rows, and without labels
    every score is 1/2.
    """
    pair = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return scored(pair, labels, rules, "doc_id", "text").select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), rules) == 0, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"), (F.col("_score") >= rules.limit).cast("int").alias("predicted"),
        F.col("_spans").alias("spans"))


def clean_documents(docs: DataFrame, labels: DataFrame, rules: CrfRules = CrfRules()) -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    keep = ["doc_id", "text"]
    rows = scored(set_aside(docs, keep), labels, rules, *keep).filter(F.col("_score") < rules.limit)
    return put_back(rows, docs.columns, keep)


def op9_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a chain learnt from labels outside fold 0."""
    found = toxic_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))
