"""Language-model scoring with a log-bilinear model.

The two symbols before a token, each through its own matrix, add up to a
predicted vector; its product with every symbol's vector, plus that symbol's
bias, is the symbol's score.  Symbols are the most frequent tokens, more of them the
larger the vocabulary is; all other tokens belong to classes, and a token's probability
within its class follows from its count.  The model is trained by noise-contrastive estimation:
every training token is drawn once with the two symbols before it (tokens of small corpora several times),
and scores with the normalised probabilities.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import slices, small_batches, stored, utf8

#: Own symbols for each doubling of the vocabulary; all other words belong to classes.
FREQUENT = 40
CLASSES = 256
SIZE = 24
NOISE = 64
RATE = 0.2
BATCH = 1024
#: Rounds after which the trainers' models are averaged; each draws its share of a trainer's tokens.
ROUNDS = 3
#: Draws of a trainer in all rounds, at least: tokens of a smaller corpus are drawn several times.
LEAST_DRAWS = 768_000
#: Bytes of training text of one trainer, on average; each draws all of its tokens, so that effort grows with the corpus.
TRAINER_BYTES = 32 << 20
#: Bytes of text of one group of documents, on average.
GROUP_BYTES = 8 << 20
END = b"\n"  # no word has white space


def in_class(word: bytes) -> int:
    return zlib.crc32(word[:2]) % CLASSES


@dataclass
class Model:
    """r: context vectors, c: a matrix for each context place, q and b: vectors and biases of predicted symbols."""

    r: np.ndarray
    c: np.ndarray
    q: np.ndarray
    b: np.ndarray

    @staticmethod
    def start(counts: np.ndarray) -> Model:
        rng = np.random.default_rng(5)
        n = len(counts)
        p = (counts + 1.0) / (counts.sum() + n)
        return Model(rng.normal(0, 0.1, (n + 1, SIZE)).astype("f4"), np.stack([np.eye(SIZE)] * 2).astype("f4"), rng.normal(0, 0.1, (n, SIZE)).astype("f4"), np.log(p).astype("f4"))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.c, self.q, self.b)])

    def filled(self, flat: np.ndarray) -> Model:
        cuts = np.cumsum([x.size for x in (self.r, self.c, self.q, self.b)])[:-1]
        return Model(*(p.reshape(x.shape).astype("f4") for p, x in zip(np.split(flat, cuts), (self.r, self.c, self.q, self.b), strict=True)))

    def predicted(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.r[before] @ self.c[0] + self.r[last] @ self.c[1]

    def log_probabilities(self, before: np.ndarray, last: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Natural logarithms of normalised probabilities, by blocks of distinct contexts times all symbols."""
        wide = len(self.b) + 1
        context, at = np.unique(before.astype(np.int64) * wide + last, return_inverse=True)
        total = np.empty(len(context), dtype="f4")
        vectors = self.predicted(context // wide, context % wide)
        vectors_1, symbols_b, one = np.c_[vectors, np.ones(len(vectors), dtype="f4")], np.c_[self.q, self.b].T.copy(), np.ones(len(self.b), dtype="f4")
        for k in range(0, len(context), 512):
            s = vectors_1[k : k + 512] @ symbols_b
            top = s.max(axis=1, keepdims=True)
            s -= top
            np.exp(s, out=s)
            total[k : k + 512] = top[:, 0] + np.log(s @ one)
        triple, back = np.unique(at.astype(np.int64) * wide + symbol, return_inverse=True)
        own, target = triple // wide, triple % wide
        value = np.einsum("ij,ij->i", vectors[own], self.q[target]) + self.b[target] - total[own]
        return value[back]

    def trained(self, triples: np.ndarray, noise: np.ndarray, seed: int | list[int]) -> Model:
        """Noise-contrastive steps with per-parameter rates, each over the next ``BATCH`` triples."""
        rng = np.random.default_rng(seed)
        wide = len(self.b) + 1
        r, c, q, b = (x.copy() for x in (self.r, self.c, self.q, self.b))
        past = [np.full(x.shape, 0.1, dtype="f4") for x in (r, c, q, b)]
        noise_edge, log_noise = np.cumsum(noise), np.log(noise * NOISE).astype("f4")

        def summed(at: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
            return np.stack([np.bincount(at, column, n) for column in np.ascontiguousarray(g.T)], axis=1).astype("f4")

        for k in range(0, len(triples), BATCH):
            t = triples[k : k + BATCH]
            pair, symbol = t // wide, t % wide
            before, last = pair // wide, pair % wide
            fake = np.searchsorted(noise_edge, rng.random(NOISE) * noise_edge[-1], side="right").clip(max=len(noise) - 1)
            v, q_own, q_fake = r[before] @ c[0] + r[last] @ c[1], q[symbol], q[fake]
            d_good = (1 / (1 + np.exp(log_noise[symbol] - b[symbol] - np.einsum("ij,ij->i", v, q_own))) - 1) / np.float32(BATCH)
            d_bad = v @ q_fake.T
            d_bad += b[fake] - log_noise[fake]
            np.negative(d_bad, out=d_bad)
            np.exp(d_bad, out=d_bad)
            d_bad += 1
            d_bad *= BATCH
            np.reciprocal(d_bad, out=d_bad)
            d_v = d_good[:, None] * q_own + d_bad @ q_fake
            target = np.r_[symbol, fake]
            g_q = summed(target, np.concatenate([d_good[:, None] * v, d_bad.T @ v]), len(b))
            g_b = np.bincount(target, np.r_[d_good, d_bad.sum(axis=0)], len(b)).astype("f4")
            g_r = summed(np.r_[before, last], np.concatenate([d_v @ c[0].T, d_v @ c[1].T]), len(r))
            g_c = np.stack([r[before].T @ d_v, r[last].T @ d_v])
            for x, h, g in zip((r, c, q, b), past, (g_r, g_c, g_q, g_b), strict=True):
                h += g * g
                g /= np.sqrt(h)
                g *= np.float32(RATE)
                x -= g
        return Model(r, c, q, b)


def packed(symbols: np.ndarray, start: int) -> np.ndarray:
    """A document's symbols after two start symbols, two bytes each."""
    return np.r_[start, start, symbols].astype("<u2")


def triples_of(stream: np.ndarray, start: int) -> np.ndarray:
    """The codes of all (before, last, symbol) of packed documents, one after the other, in ascending order: one for each token."""
    s = stream.astype(np.int64)
    code = (s[:-2] * (start + 1) + s[1:-1]) * (start + 1) + s[2:]
    return np.sort(code[s[2:] != start])


def draws(triples: np.ndarray, part: int, k: int) -> np.ndarray:
    """What round ``k`` draws of a trainer's sorted triples: over all rounds each comes up equally often, once if there are ``LEAST_DRAWS``."""
    passes = max(1, -(-LEAST_DRAWS // max(len(triples), 1)))
    return np.random.default_rng([1, part]).permutation(np.tile(triples, passes))[k::ROUNDS]


def held_out(id_col: str) -> Column:
    """Documents that the model does not learn from: crc32 of the id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


@dataclass
class Scorer:
    """A fitted model with what turns words into symbols: ``symbols`` of frequent words, and tokens and types of each class of the others."""

    model: Model
    symbols: dict[bytes, int]
    class_n: np.ndarray
    class_v: np.ndarray
    tokens: int
    types: int

    def symbol_of(self, word: bytes) -> int:
        known = self.symbols.get(word)
        return len(self.symbols) + in_class(word) if known is None else known

    def base(self, c: np.ndarray) -> np.ndarray:
        """Smoothed unigram log10 probabilities of words with these counts."""
        return np.log10((c + 1) / (self.tokens + (self.types + 1)))

    def within(self, symbol: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 probabilities of words inside their symbols: 0 for own symbols, by count in classes."""
        cls = np.maximum(symbol - len(self.symbols), 0)
        return np.where(symbol < len(self.symbols), 0.0, np.log10((c + 1) / (self.class_n[cls] + self.class_v[cls] + 1)))


def dealt_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, out, group): groups of about ``GROUP_BYTES`` of text, by a hash of id and text, so that null and repeated ids are spread."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out(id_col).alias("out"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()["size"]
    return rows.withColumn("group", F.pmod(F.xxhash64("id", "text", F.lit(11)), F.lit(max(1, -(-size // GROUP_BYTES)))))


def fit_lm(rows: DataFrame) -> tuple[Scorer, DataFrame, DataFrame]:
    """Fit on the rows of ``dealt_rows`` that are not held out; also (group, word, n) of each group's words and (word, c) over all.

    Each group's distinct words are counted and summed over all groups, so that the vocabulary is never whole in one place.
    Documents are dealt to trainers by a hash; a trainer has one row, its documents' symbols, two bytes for each token.
    The result does not depend on how rows or tasks are arranged: triples are sorted, shuffled
    with a seed of the part's own, and means are sums of whole numbers.
    """

    def local_words(table: pa.Table) -> pa.Table:
        from collections import Counter

        train: Counter[bytes] = Counter({END: 0})
        seen: set[bytes] = set()
        for batch in table.to_batches(max_chunksize=256):
            for data, out in zip(utf8(batch.column("text")), batch.column("out").to_pylist(), strict=True):
                if out:
                    seen.update(data.lower().split())
                else:
                    train.update(data.lower().split())
                    train[END] += 1
        words = [*train, *(w for w in seen if w not in train)]
        group = table.column("group")[0].as_py()
        return pa.table({"group": pa.array([group] * len(words), pa.int64()), "word": pa.array(words, pa.binary()), "n": pa.array([train.get(w, 0) for w in words], pa.int64())})

    local = stored(rows.groupBy("group").applyInArrow(local_words, "group long, word binary, n long"))
    counts = stored(local.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0"))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    own_symbols = int(FREQUENT * np.log2(total["v"] + 2))
    frequent = {bytes(r["word"]): r["c"] for r in counts.orderBy(F.desc("c"), "word").limit(own_symbols).collect()}  # grows with a logarithm
    if (own := counts.filter(F.col("word") == F.lit(END)).first()) is not None:
        frequent[END] = own["c"]  # always a symbol of its own
    symbols = {w: k for k, w in enumerate(frequent)}
    rare = counts.join(F.broadcast(rows.sparkSession.createDataFrame([(bytearray(w),) for w in frequent], "word binary")), "word", "left_anti")
    by_class = {r["k"]: (r["n"], r["v"]) for r in rare.groupBy((F.crc32(F.substring("word", 1, 2)) % CLASSES).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, (n, v) in by_class.items():
        class_n[k], class_v[k] = n, v
    weights = np.array([*frequent.values(), *class_n], dtype=np.float64)
    scorer = Scorer(Model.start(weights), symbols, class_n, class_v, total["n"], total["v"])

    start = len(weights)  # the symbol before a document's first
    if start >= 1 << 16:
        raise ValueError("symbols need two bytes")

    def symbol_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, int] = {}
        for b in slices(batches, "text", 8 << 20):
            streams: dict[int, list[bytes]] = {}
            for part, data in zip(b.column("part").to_pylist(), utf8(b.column("text")), strict=True):
                words = data.lower().split()
                words.append(END)
                if len(kept) > 300_000:
                    kept.clear()
                for w in set(words).difference(kept):
                    kept[w] = scorer.symbol_of(w)
                streams.setdefault(part, []).append(packed(np.fromiter(map(kept.__getitem__, words), dtype=np.int64, count=len(words)), start).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([*streams], pa.int64()), pa.array([b"".join(x) for x in streams.values()], pa.binary())], names=["part", "stream"])

    training = rows.filter("not out")
    size = training.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()["size"]
    parts = max(1, -(-size // TRAINER_BYTES))
    # whole documents are dealt, so that each trainer meets every kind of triple
    dealt = training.select("text", F.pmod(F.xxhash64("id", "text", F.lit(13)), F.lit(parts)).alias("part"))

    def joined(table: pa.Table) -> pa.Table:
        return pa.table({"part": table.column("part").slice(0, 1), "stream": pa.array([b"".join(table.column("stream").to_pylist())], pa.binary())})

    # one row for each trainer, so that no round shuffles the tokens again
    streams = stored(dealt.mapInArrow(symbol_streams, "part long, stream binary").groupBy("part").applyInArrow(joined, "part long, stream binary"))
    noise = (weights + 1) / (weights + 1).sum()

    def trainer(model: Model, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for part, stream in zip(b.column("part").to_pylist(), b.column("stream"), strict=True):
                    triples = triples_of(np.frombuffer(stream.as_buffer(), dtype="<u2"), start)
                    flat = model.trained(draws(triples, part, k), noise, seed=[k, part]).flat()
                    share = len(triples) / tokens  # every training token ends one triple
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(np.round(flat.astype(np.float64) * share * 2.0**40).astype(np.int64))], names=["at", "x"])

        return train

    tokens = total["n"]
    for k in range(ROUNDS if tokens else 0):
        mean = streams.mapInArrow(trainer(scorer.model, k), "at long, x long").groupBy("at").agg(F.sum("x").alias("x")).toArrow()  # the size of the model
        flat = np.empty(mean.num_rows)
        flat[mean.column("at").to_numpy()] = mean.column("x").to_numpy() / 2.0**40
        scorer.model = scorer.model.filled(flat)
    return scorer, local, counts


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words are stretches without ASCII white space, A-Z in lower case; an end token
    closes each document (null and empty texts are that alone).  Counts cover all
    training rows; repeated rows count again; null ids are training rows.  base_score is the smoothed unigram
    log10 probability, score the model's; without any training token both
    are those of an unknown token.  An empty table gives no rows; other columns are not read, whatever their names.

    Documents are dealt to groups; the sums of their words' counts are brought back to the group.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = dealt_rows(docs, id_col, text_col)
    scorer, local, counts = fit_lm(rows)

    def score(docs_of: pa.Table, words_of: pa.Table) -> pa.Table:
        words = utf8(words_of.column("word"))
        index = {w: k for k, w in enumerate(words)}
        c = words_of.column("c").to_numpy(zero_copy_only=False).astype(np.float64)
        symbol = np.fromiter(map(scorer.symbol_of, words), dtype=np.int64, count=len(words))
        base, within = scorer.base(c), scorer.within(symbol, c)
        wide = len(scorer.model.b) + 1
        out = []
        for b in slices(docs_of.select(["id", "text", "out"]).to_batches(), "text", 4 << 20):  # the more tokens, the more share a context
            at, cuts, start = [], [0], []
            for data in utf8(b.column("text")):
                own = data.lower().split()
                own.append(END)
                at.append(np.fromiter(map(index.__getitem__, own), dtype=np.int64, count=len(own)))
                s = symbol[at[-1]]
                start.append(np.r_[wide - 1, wide - 1, s])
                cuts.append(cuts[-1] + len(own))
            flat = np.concatenate(at)
            before, last = np.concatenate([s[:-2] for s in start]), np.concatenate([s[1:-1] for s in start])
            value = scorer.model.log_probabilities(before, last, symbol[flat]) / np.log(10) + within[flat]
            sums = [np.add.reduceat(x, cuts[:-1]) for x in (base[flat], value.astype(np.float64), (c[flat] > 0).astype(np.int64))]
            out.append(pa.table({id_col: b.column("id"), "held_out": b.column("out"), "n_tokens": pa.array(np.diff(cuts)), "n_known": pa.array(sums[2]), "train_tokens": pa.array([scorer.tokens] * b.num_rows, pa.int64()), "base_score": pa.array(sums[0]), "score": pa.array(sums[1])}))
        return pa.concat_tables(out)

    known = local.select("group", "word").join(counts, "word", "left").select("group", "word", F.coalesce("c", F.lit(0)).alias("c"))
    return rows.groupBy("group").cogroup(known.groupBy("group")).applyInArrow(score, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
