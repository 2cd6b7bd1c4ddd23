"""Toxicity by a classifier chain.

Categories are predicted one after the other, each by a linear model over the
words of a text and the probabilities of the categories before it.  Those
probabilities are out-of-fold predictions while the later models are trained,
so that a later model sees them as unsure as they will be on new texts.  Labels
tell only whether a text is toxic; the categories are groups of toxic texts
that share the words which set toxic texts apart, then toxicity itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import slices, small_batches, utf8
from kinolytics.llm.quality import in_training

#: Labelled rows to learn from, at most: those of the smallest hashes of the id.
SAMPLE = 8_000
SLOTS = 1 << 18
#: Groups of toxic texts that become categories, and the texts that a group needs.
CATEGORIES = 3
LEAST_GROUP = 12
#: Standard errors by which a word's shares must differ to be worth a weight.
LEAST_Z = 7.0
FOLDS = 4
ROUNDS = 60
WORDS = re.compile(rb"[a-z\x80-\xff]+")


def slots(data: bytes) -> np.ndarray:
    """Hashed distinct words, runs of letters in lower case, and their first five bytes."""
    words = set(WORDS.findall(data.lower()))
    words |= {w[:5] + b"*" for w in words}
    return np.unique(np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % SLOTS).astype(np.int32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Bags:
    """Rows of set slots, held end to end: a sparse matrix of ones."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.n, self.width = len(rows), width
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
        self.owner = np.repeat(np.arange(self.n), self.lengths)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=w[self.flat], minlength=self.n)

    def summed(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.flat, weights=r[self.owner], minlength=self.width)


def logistic(bags: Bags, dense: np.ndarray, y: np.ndarray, used: np.ndarray, penalty: float = 0.3) -> np.ndarray:
    """Weights of a logistic model over slots, dense columns and (last) the intercept, from the ``used`` rows, by accelerated gradient steps scaled by column."""
    m = bags.width
    w = np.zeros(m + dense.shape[1] + 1)
    use = used.astype(np.float64)
    rate = min(max(float((y * use).sum() / max(use.sum(), 1)), 1e-4), 1 - 1e-4)
    w[-1] = np.log(rate / (1 - rate))
    if not (y * use).any() or (y * use).sum() == use.sum():
        return w
    # bounds of the curvature by column: columns that are rarely set take large steps
    width = float(((bags.lengths + np.abs(dense).sum(axis=1)) * use).sum() / use.sum()) + 1
    step = 1.0 / (0.25 * width * np.r_[bags.summed(use), use @ np.square(dense), use.sum()] + penalty)
    ahead, last = w.copy(), w.copy()
    for k in range(1, ROUNDS + 1):
        r = (sigmoid(bags.times(ahead[:m]) + dense @ ahead[m:-1] + ahead[-1]) - y) * use
        g = np.r_[bags.summed(r) + penalty * ahead[:m], r @ dense + penalty * ahead[m:-1], r.sum()]
        w = ahead - step * g
        momentum = (k - 1) / (k + 2) if (w - last) @ g <= 0 else 0.0  # overshot: anew
        ahead, last = w + momentum * (w - last), w
    return w


@dataclass
class Chain:
    categories: list[str]
    chosen: np.ndarray  # slot -> column of the weights, or -1
    weights: list[np.ndarray]  # per category: slots, probabilities before it, intercept
    threshold: float = 0.5

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        """A row for each text, a column for each category, one category after the other for all texts at once."""
        lengths = [len(r) for r in rows]
        owner = np.repeat(np.arange(len(rows)), lengths)
        at = self.chosen[np.concatenate(rows)] if rows else np.zeros(0, dtype=np.int64)
        owner, at = owner[at >= 0], at[at >= 0]
        out = np.zeros((len(rows), len(self.categories)))
        for c, w in enumerate(self.weights):
            d = len(w) - 1 - c
            out[:, c] = sigmoid(np.bincount(owner, weights=w[at], minlength=len(rows)) + out[:, :c] @ w[d : d + c] + w[-1])
        return out


def toxic_groups(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """The group (0, 1, ...) of each toxic row, -1 for others and for rows in groups of fewer than ``LEAST_GROUP``; groups by size.

    Spherical k-means over the slots that are more frequent in toxic than in other texts, weighted by that difference's
    logarithm; the first centre is the mean, each further one the row least like the centres before it (ties: the first).
    """
    out = np.full(len(rows), -1)
    at = np.flatnonzero(toxic)
    if len(at) < 2 * LEAST_GROUP:
        return out
    n1, n0 = len(at), len(rows) - len(at)
    c1, c0 = np.zeros(SLOTS), np.zeros(SLOTS)
    for k, r in enumerate(rows):
        (c1 if toxic[k] else c0)[r] += 1
    weight = np.maximum(np.log((c1 + 0.5) / (n1 + 1)) - np.log((c0 + 0.5) / (n0 + 1)), 0) * (c1 >= 3)
    own = Bags([rows[k] for k in at], SLOTS)
    value = weight[own.flat]
    norm = np.sqrt(np.bincount(own.owner, weights=value * value, minlength=own.n))
    value = value / np.maximum(norm[own.owner], 1e-12)

    def likeness(centre: np.ndarray) -> np.ndarray:
        return np.bincount(own.owner, weights=value * centre[own.flat], minlength=own.n)

    def centred(members: np.ndarray) -> np.ndarray:
        c = np.bincount(own.flat, weights=value * members[own.owner], minlength=SLOTS)
        return c / max(np.sqrt(c @ c), 1e-12)

    like = likeness(centred(np.ones(own.n)))[:, None]
    centres = []
    for _ in range(CATEGORIES):
        far = int(np.argmin(like.max(axis=1)))
        centres.append(centred((np.arange(own.n) == far).astype(float)))
        like = np.column_stack([like, likeness(centres[-1])])
    label = np.full(own.n, -1)
    for _ in range(20):
        now = np.argmax(np.column_stack([likeness(c) for c in centres]), axis=1)
        if (now == label).all():
            break
        label = now
        centres = [centred((label == k).astype(float)) for k in range(CATEGORIES)]
    size = np.bincount(label, minlength=CATEGORIES)
    for new, k in enumerate(k for k in np.argsort(-size, kind="stable") if size[k] >= LEAST_GROUP):
        out[at[label == k]] = new
    return out


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where the out-of-fold probabilities separate best (F1); in the middle of the gap, between 0.2 (or half as much again as the share of positives: what is like any text is not positive) and 0.5."""
    order = np.argsort(-p, kind="stable")
    p, hit = p[order], np.cumsum(y[order])
    if not len(y) or not hit[-1]:
        return 0.5
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + hit[-1])
    at = int(np.argmax(f1))
    low = p[at + 1] if at + 1 < len(p) else 0.0
    return float(np.clip((p[at] + low) / 2, min(0.5, max(0.2, 1.5 * float(y.mean()))), 0.5))


def fit_chain(rows: list[np.ndarray], targets: np.ndarray, categories: list[str]) -> Chain:
    """targets: a column for each category, the last being toxicity as such.

    Each word whose share among a category's texts differs from that among the others by ``LEAST_Z`` standard errors has a weight, however many these are."""
    n = len(rows)
    chosen = np.full(SLOTS, -1, dtype=np.int32)
    if not n:  # nothing to learn from: nothing is toxic
        return Chain(categories, chosen, [np.r_[np.zeros(c), -10.0] for c in range(len(categories))])
    everything = Bags(rows, SLOTS)
    total = everything.summed(np.ones(n))
    apart = np.zeros(SLOTS)
    for y in targets.T:
        if y.any() and not y.all():
            with_it, p = everything.summed(y), total / n
            error = np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / y.sum() + 1 / (n - y.sum())))
            apart = np.maximum(apart, np.where(total > 1, np.abs(with_it / y.sum() - (total - with_it) / (n - y.sum())) / error, 0))
    words = np.flatnonzero(apart >= LEAST_Z)
    chosen[words] = np.arange(len(words))
    bags = Bags([at[at >= 0] for at in (chosen[r] for r in rows)], len(words))
    fold = np.arange(n) % FOLDS
    before = np.zeros((n, 0))
    weights = []
    for y in targets.T:
        weights.append(logistic(bags, before, y, np.ones(n, dtype=bool)))
        guess = np.zeros(n)
        for f in range(FOLDS):
            out = fold == f
            w = logistic(bags, before, y, ~out) if (~out).any() else weights[-1]
            guess[out] = sigmoid(bags.times(w[: bags.width]) + before @ w[bags.width : -1] + w[-1])[out]
        before = np.column_stack([before, guess])
    return Chain(categories, chosen, weights, best_threshold(before[:, -1], targets[:, -1]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Chain:
    """Learn from at most ``SAMPLE`` labelled rows outside the held-out fold (crc32 of the id is no multiple of 5); their word slots come to the driver.

    Null ids and labels are skipped; an id with several labels counts once for each, one with several texts by one of them (that of the smallest hash).
    Empty tables, or labels of one kind, give a chain that finds all texts alike.  Other columns are not read.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(in_training(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().distinct()
    known = known.orderBy(F.xxhash64("id"), "id", "label").limit(SAMPLE)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), b.column("digest"), pa.array([slots(t) for t in utf8(b.column("text"))], pa.list_(pa.int32()))], names=["id", "label", "digest", "slots"])

    kind = docs.schema[id_col].dataType.simpleString()
    # one text for each id before anything is gathered: at most SAMPLE rows reach the driver
    found = texts.join(F.broadcast(known), "id").select("id", "label", F.xxhash64("text").alias("digest"), "text").mapInArrow(work, f"id {kind}, label int, digest long, slots array<int>")
    got = found.groupBy("id", "label").agg(F.min_by("slots", "digest").alias("slots")).toArrow().sort_by([("id", "ascending"), ("label", "ascending")])
    y = np.array([int(v > 0) for v in got.column("label").to_pylist()], dtype=np.float64)
    held = got.column("slots").combine_chunks()
    rows = np.split(held.flatten().to_numpy(), held.offsets.to_numpy()[1:-1] - held.offsets[0].as_py()) if len(held) else []
    group = toxic_groups(rows, y > 0)
    groups = int(group.max(initial=-1)) + 1
    return fit_chain(rows, np.stack([*(group == k for k in range(groups)), y], axis=1).astype(np.float64), [*(f"toxic_{k}" for k in range(groups)), "toxic"])


def toxicity_scores(chain: Chain, text: F.Column) -> F.Column:
    """array<double>: a probability for each of ``chain.categories``; the last is toxicity.  Null and empty texts have no words and get the intercepts' probability."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("array<double>")
    def score(column: pa.Array) -> pa.Array:
        p = chain.probabilities([slots(t) for t in utf8(column)])
        return pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), p.shape[1]).cast(pa.list_(pa.float64()))

    return score(text)


def toxicity(docs: DataFrame, chain: Chain, threshold: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, a probability column for each earlier category, score (toxicity), predicted (1 from ``threshold``; by default the one that separates the out-of-fold predictions best)."""
    threshold = chain.threshold if threshold is None else threshold
    p = docs.select(F.col(id_col), toxicity_scores(chain, F.col(text_col)).alias("p"))
    own = [F.col("p")[k].alias(f"p_{c}") for k, c in enumerate(chain.categories[:-1])]
    score = F.col("p")[len(chain.categories) - 1]
    return p.select(F.col(id_col), *own, score.alias("score"), (score >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, chain: Chain, threshold: float | None = None, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, with their own columns; repeated rows are judged alike, an empty table stays empty."""
    threshold = chain.threshold if threshold is None else threshold
    return docs.filter(toxicity_scores(chain, F.col(text_col))[len(chain.categories) - 1] < threshold)
