"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text's terms are its character n-grams: hashed triples of bytes, pairs of kinds
of characters, and how much of it is repeated words and lines.  Weighted as in
text retrieval and reduced by a singular value decomposition of a bounded
labelled sample, each text becomes a short unit vector.  The sample's vectors
and labels go to every task; each document's cosines with all of them are
computed exactly, block by block, and the nearest vote with their similarity.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import slices, small_batches, utf8

#: Labelled rows that vote, at most: those of the smallest hashes of the id.
SAMPLE = 4000
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 16.0

#: Kinds of bytes: lower-case and other letters, upper case, digits, blanks, line ends, and every punctuation mark.
KINDS = 5 + len(string.punctuation)
_kind = np.zeros(256, dtype=np.int32)
_kind[65:91] = 1
_kind[48:58] = 2
_kind[[0, 9, 11, 12, 32]] = 3
_kind[[10, 13]] = 4
for _k, _c in enumerate(string.punctuation):
    _kind[ord(_c)] = 5 + _k
EXTRA = 4
#: Slots of hashed triples of bytes (A-Z in lower case, digits alike), and their weight beside the other terms.
GRAMS = 1024
GRAM_WEIGHT = 0.5
FORM = KINDS * KINDS + EXTRA
TERMS = FORM + GRAMS
_folded = np.arange(256, dtype=np.uint32)
_folded[65:91] += 32
_folded[48:58] = 48


def terms(data: bytes) -> np.ndarray:
    """Relative frequencies (per thousand) of pairs of kinds, of repetitions, and of hashed triples."""
    out = np.zeros(TERMS, dtype=np.float32)
    if not data:
        return out
    raw = np.frombuffer(data, dtype=np.uint8)
    kinds = _kind[raw]
    if len(kinds) > 1:
        out[: KINDS * KINDS] = np.bincount(kinds[:-1] * KINDS + kinds[1:], minlength=KINDS * KINDS) * (1000.0 / (len(kinds) - 1))
    words, lines = data.split(), data.split(b"\n")
    if words:
        out[FORM - 4] = 1000.0 * sum(map(eq, words, words[1:])) / len(words)
        out[FORM - 3] = 1000.0 * max(0, len(words) - 2 * len(set(words))) / len(words)
        out[FORM - 2] = 20_000.0 / (19 + len(words))  # shortness
    out[FORM - 1] = 1000.0 * (len(lines) - len(set(lines))) / len(lines)
    if len(raw) > 2:
        x = _folded[raw]
        slot = (x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA77) ^ x[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(22)
        out[FORM:] = np.bincount(slot, minlength=GRAMS) * (1000.0 / len(slot))
    return out


def leading_axes(x: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` right singular vectors, by subspace iteration from a fixed start."""
    n = min(n, x.shape[1])
    q = np.random.default_rng(7).normal(size=(x.shape[1], min(n + 16, x.shape[1]))).astype(np.float32)
    for _ in range(8):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, turn = np.linalg.svd(x @ q, full_matrices=False) if len(x) else (None, None, np.eye(q.shape[1]))
    return (q @ turn[:n].T).astype(np.float32)


class Voters:
    """Latent vectors of the labelled sample, and the way there."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray):
        seen = (counts > 0).sum(axis=0)
        self.idf = np.log1p(len(counts) / np.maximum(seen, 1)).astype(np.float32)
        self.axes = leading_axes(self.weighted(counts), DIMENSIONS)
        # a slice at a time: the driver holds no second copy of the sample in double precision
        self.exact = np.concatenate([self.latent(counts[a : a + 256]) for a in range(0, max(len(counts), 1), 256)])
        self.labels = labels.astype(np.float64)
        self.prior = float(labels.mean()) if len(labels) else 0.5

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return self.unit(np.hstack([self.unit(x[:, :FORM]), GRAM_WEIGHT * self.unit(x[:, FORM:])]))

    def latent(self, counts: np.ndarray) -> np.ndarray:
        """Latent unit vectors in double precision."""
        return self.unit(self.weighted(counts.astype(np.float64)) @ self.axes.astype(np.float64))

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-12)[:, None]

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        v = self.latent(counts)
        out = np.empty(len(v))
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(v), 256):
            # products of blocks differ in their last digits with the block's shape: rounded, they are the same for a row alone
            cosine = np.round(v[a : a + 256] @ self.exact.T, 9)
            last = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
            sure, edge = cosine > last, cosine == last
            votes = sure | (edge & (np.cumsum(edge, axis=1) <= k - sure.sum(axis=1, keepdims=True)))
            near = np.nonzero(votes)[1].reshape(-1, k)
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** SHARPNESS + 1e-9
            out[a : a + 256] = np.round((weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1), 9)
        return np.clip(out, 0.0, 1.0)


def in_training(id_col: str) -> F.Column:
    """Rows that labels are learnt from: crc32 of the id as text is not a multiple of 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Voters:
    """Learn from at most ``SAMPLE`` labelled rows outside the held-out fold; only their term vectors come to the driver.

    Null ids and labels are skipped; an id with several labels counts once for each, one with several texts by one of them (that of the smallest hash).
    Without labelled rows every score is 0.5.  Other columns are not read.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(in_training(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().distinct()
    known = known.orderBy(F.xxhash64("id"), "id", "label").limit(SAMPLE)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            x = np.array([terms(t) for t in utf8(b.column("text"))], dtype=np.float32).reshape(b.num_rows, TERMS)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), b.column("digest"), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "label", "digest", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    # one text for each id before anything is gathered: at most SAMPLE rows reach the driver
    found = texts.join(F.broadcast(known), "id").select("id", "label", F.xxhash64("text").alias("digest"), "text").mapInArrow(work, f"id {kind}, label int, digest long, x binary")
    got = found.groupBy("id", "label").agg(F.min_by("x", "digest").alias("x")).toArrow().sort_by([("id", "ascending"), ("label", "ascending")])
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), dtype=np.float32).reshape(got.num_rows, TERMS)
    return Voters(x, (got.column("label").to_numpy() > 0).astype(np.float64))


def quality_score(voters: Voters, text: F.Column) -> F.Column:
    """Chance of label 1, between 0 and 1; null and empty texts have no terms and are scored like any other.  Of voters at the same cosine as the last
    of the nearest, those first in the sample's order vote.  Cosines are compared to nine decimals, so that a row's score does not depend on the rows of its batch.  Very long texts are read whole."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        data = utf8(column)
        out = [voters.scores(np.array([terms(t) for t in data[k : k + 1024]], dtype=np.float32).reshape(-1, TERMS)) for k in range(0, len(data), 1024)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return score(text)


def keep_good(docs: DataFrame, voters: Voters, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows whose score is at least ``threshold``, with their own columns; repeated rows are judged alike, an empty table stays empty."""
    return docs.filter(quality_score(voters, F.col(text_col)) >= threshold)
