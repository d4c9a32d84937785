"""Operator 10: a quality classifier from weak labels.

Eight heuristic labellers vote good, bad or abstain on every document. The votes
of the whole corpus are counted by pattern (at most 3**8 patterns), and
expectation-maximisation over these counts estimates the share of good documents
and each labeller's accuracies, taking votes as independent given the class.
Posterior labels of a bounded sample train a linear scorer on hashed features of
the words and their shapes, which then scores all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import hashed_share, read, ship

# fixed values: frequent function words of the four languages
STOP = frozenset("""the of and to in a is that it for on with as was at by an be this from or are
der die das und in zu den von mit ist des im für auf dem nicht ein eine als auch
el la de que y en los se del las un por con no una su para es al lo
le la les de des et un une du en que est pour qui dans ce il au sur""".split())


@dataclass(frozen=True)
class WeakRules:
    sample: int = 4000        # distinct texts, about, that the scorer is trained on
    bits: int = 16            # hashed features
    em_steps: int = 100
    steps: int = 60           # of the fit
    rate: float = 0.5
    keep: float = 0.5
    texts: int = 256
    known_words: int = 300_000


def _vote(bad: bool, good: bool) -> int:
    return -1 if bad else 1 if good else 0


def votes(text: str | None) -> list[int]:
    """The labellers' votes: 1 good, -1 bad, 0 abstain."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0, 0, 0, -1, 0, 0, 0, 0]
    letters = max(1, sum(map(len, words)))
    symbols = sum(map(text.count, "#*$%&|<>{}=")) / n
    upper = sum(1 for w in words if w.isupper() and len(w) > 1) / n
    stops = sum(1 for w in words if w.lower().strip(".,!?") in STOP) / n
    variety = len(set(words)) / n ** 0.9
    lines = [x for x in text.split("\n") if x.strip()]
    again = 1 - len(set(lines)) / len(lines)
    ended = sum(1 for x in lines if x.rstrip()[-1] in ".!?\"'…") / len(lines)
    mean = letters / n
    return [_vote(symbols > 0.1, symbols < 0.02),
            _vote(upper > 0.3, upper < 0.1),
            _vote(stops < 0.05 and n >= 20, stops > 0.12),
            _vote(n < 6, n >= 50),
            _vote(variety < 0.35, variety > 0.6),
            _vote(again > 0.3, again == 0 and len(lines) > 1),
            _vote(ended < 0.2, ended > 0.6),
            _vote(mean < 2.5 or mean > 12, 3.5 <= mean <= 9)]


def pattern(v: list[int]) -> int:
    return int(sum((x + 1) * 3 ** i for i, x in enumerate(v)))


def _table(k: int) -> np.ndarray:
    """The votes (0 bad, 1 abstain, 2 good) of every pattern."""
    return (np.arange(3 ** k)[:, None] // 3 ** np.arange(k)[None]) % 3


def label_model(counts: np.ndarray, k: int, steps: int) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good documents, P(vote | class) as [class, labeller, vote], posterior of good by pattern).

    Labellers look for different faults, so one bad vote may be all that a bad
    document gets: EM starts from doubt about any document with a bad vote, and
    class 1 means good."""
    v = _table(k)
    weight = counts.astype(float)
    post = 1 / (1 + np.exp(3.0 * (v == 0).sum(1) - 2.0))
    share, p = 0.5, np.full((2, k, 3), 1 / 3)
    for _ in range(steps):
        both = np.stack([(1 - post) * weight, post * weight])
        share = float((both[1].sum() + 1) / (both.sum() + 2))
        for c in (0, 1):
            for i in range(k):
                p[c, i] = np.bincount(v[:, i], both[c], 3) + 1
                p[c, i] /= p[c, i].sum()
        ll = np.stack([np.log(p[c])[np.arange(k)[None], v].sum(1) for c in (0, 1)])
        post = 1 / (1 + np.exp(np.clip(np.log(1 - share) - np.log(share) + ll[0] - ll[1], -50, 50)))
    return share, p, post


def shape(word: bytes) -> bytes:
    """Letter classes of a word, runs shortened: ``Hello.`` is ``Xx.``, ``IT!!`` is ``X!``."""
    out = bytearray()
    for ch in word.decode():
        c = b"X" if ch.isupper() else b"x" if ch.isalpha() else b"9" if ch.isdigit() else ch.encode()
        if not out.endswith(c):
            out += c
    return bytes(out[:12])


def features(word: bytes, bits: int) -> tuple[int, int]:
    mask = (1 << bits) - 1
    return zlib.crc32(b"w" + word.lower()) & mask, zlib.crc32(b"s" + shape(word)) & mask


class Scorer:
    """Linear scores of texts: the mean weight of the features, of distinct words, and a length weight."""

    def __init__(self, weights: np.ndarray, rules: WeakRules):
        self.w, self.rules, self.known = weights, rules, {}

    def score(self, texts: list[str | None]) -> np.ndarray:
        split = [(t or "").encode().split() for t in texts]
        new = list(set().union(*split).difference(self.known))
        f = np.array([features(x, self.rules.bits) for x in new], np.int64).reshape(-1, 2)
        self.known.update(zip(new, self.w[f].sum(1).tolist()))
        get = self.known.__getitem__
        z = np.array([sum(map(get, s)) / len(s) if s else 0.0 for s in split])
        size = 1 << self.rules.bits
        z += self.w[[size + length_bin(len(s)) for s in split]]
        z += self.w[[size + 32 + variety_bin(s) for s in split]]
        if len(self.known) > self.rules.known_words:
            for x in new:
                del self.known[x]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def length_bin(n: int) -> int:
    return min(31, n.bit_length())


def variety_bin(words: list[bytes]) -> int:
    return min(31, int(16 * len(set(words)) / len(words) ** 0.9)) if words else 0


def train(texts: list[str], target: np.ndarray, rules: WeakRules) -> np.ndarray:
    """Weights of a logistic scorer for soft targets, by full-batch adaptive gradient steps."""
    size = (1 << rules.bits) + 64
    number: dict[bytes, int] = {}
    kind_of, n, more = [], np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        kind_of.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
        n[i], more[i] = len(words), (1 << rules.bits) + 32 + variety_bin(words)
    kinds = list(number)
    kind = np.concatenate(kind_of) if kind_of else np.zeros(0, np.int32)
    owner = np.repeat(np.arange(len(texts)), n)
    share = 1.0 / np.maximum(n, 1)
    f = np.array([features(w, rules.bits) for w in kinds], np.int64).reshape(-1, 2)
    bins = (1 << rules.bits) + np.array([length_bin(int(x)) for x in n], np.int64)
    w, g2 = np.zeros(size), np.full(size, 1e-8)
    for _ in range(rules.steps if len(texts) else 0):
        by_kind = w[f].sum(1) if len(kinds) else np.zeros(0)
        z = np.bincount(owner, by_kind[kind], len(texts)) * share + w[bins] + w[more]
        err = target - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        per = np.bincount(kind, (err * share)[owner], len(kinds))
        d = np.bincount(f.ravel(), np.repeat(per, 2), size) + np.bincount(bins, err, size) + np.bincount(more, err, size)
        d = d / len(texts) - 1e-7 * w
        g2 += d * d
        w = w + rules.rate * d / np.sqrt(g2)
    return w


def training_texts(docs: DataFrame, rules: WeakRules) -> DataFrame:
    """``text``: about ``sample`` distinct texts, all of them where there are no more; copies count once."""
    h = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    kinds = docs.select(h.alias("h")).distinct().count()
    some = docs.select("text", h.alias("h")).filter(hashed_share(F.col("h"), rules.sample, kinds))
    return some.groupBy("h").agg(F.min("text").alias("text")).select("text")


_scorers: dict[int, Scorer] = {}


def weak_quality(docs: DataFrame, rules: WeakRules = WeakRules(), doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id, votes, posterior, score, predicted, kept: one row per input row.

    A null or empty text gets one vote, bad. Equal rows get equal scores; a null
    doc_id is kept; whole texts are read; further columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    k = len(votes(None))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pattern(votes(t)) for t in b.column(0).to_pylist()], pa.int32())],
                                             names=["pattern"])
    counted = docs.select("text").mapInArrow(vote, "pattern int").groupBy("pattern").agg(F.count("*").alias("n"))
    counts = np.zeros(3 ** k)
    for r in counted.collect():                      # at most 3 ** 8 rows
        counts[r["pattern"]] = r["n"]
    _, _, post = label_model(counts, k, rules.em_steps)
    sample = sorted(r["text"] or "" for r in training_texts(docs, rules).collect())
    target = np.array([post[pattern(votes(t))] for t in sample])
    model = spark.sparkContext.broadcast((train(sample, target, rules), post))
    key = hash(model.value[0].tobytes())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, by_pattern = model.value
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(weights, rules)
        for b in (x.slice(a, rules.texts) for x in batches for a in range(0, x.num_rows, rules.texts)):
            texts = b.column(1).to_pylist()
            v = [votes(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(v, pa.list_(pa.int32())), pa.array([float(by_pattern[pattern(x)]) for x in v]),
                 pa.array(_scorers[key].score(texts))], names=["doc_id", "votes", "posterior", "score"])
    out = docs.mapInArrow(score, "doc_id long, votes array<int>, posterior double, score double")
    return out.select("*", (F.col("score") >= rules.keep).cast("int").alias("predicted"),
                      (F.col("score") >= rules.keep).alias("kept"))


def op10_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: weak votes, their posterior and the trained scorer's verdict."""
    return weak_quality(read(spark, sf_dir, "documents")).select(
        "doc_id", F.array_join(F.col("votes").cast("array<string>"), ",").alias("votes"), "posterior", "score",
        "predicted", "kept")
