"""Near copies by the exact similarity of their shingles.

Candidates come first from the Golay code: texts whose fingerprints differ in at
most three bits (``simhash``).  Fingerprints of texts of a similarity of 0.8
differ in about ten bits, which no code of three bits can promise to find; so
an exact way takes the rest: in any one order of all shingles, two similar sets
have one of their first ones in common (prefix filter), and rare shingles are
first.  Every link is verified on the sets themselves, so that none is missed
and none is wrong.

Sets are never stored whole: a pass over the texts describes each (digest,
size, fingerprint, parities), a second one names its rarest shingles, and only
texts of candidate pairs are read once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinolytics.llm.common import connected_components, free_name, local_heads, slices, small_batches, smallest_of, stored, utf8
from kinolytics.llm.simhash import SEED, linked_prints

#: Counters of how often shingles occur, by their digests' low bits: one for so many bytes of text, within these bounds (one byte each when broadcast).
BYTES_FOR_A_COUNTER = 256
FEWEST_COUNTERS, MOST_COUNTERS = 1 << 16, 1 << 24
#: Rows of one key that one task counts; keys of more frequent shingles are dealt to several.
HOT = 1 << 16
#: Pairs to compare, as a multiple of the sets they come from, up to which all are compared at once.
FEW = 8
#: Sets of one key that a task compares with the others of the key, when all pairs are compared.
BLOCK = 4096
#: Similarities are quotients of whole numbers; this is less than what two that differ can be apart.
TINY = 1e-9
#: Words of 64 parities: bit b tells whether the set has an odd number of shingles in the b-th of 512 classes.
PARITIES = [f"p{k}" for k in range(8)]
#: Digests of copies that a task remembers, so that it names their keys once.
COPIES = 300_000
#: Links whose components one group of a task works out (16 bytes each).
LINKS = 1 << 18
#: Rows that may be broadcast once they were counted (eight bytes each).
MOST_ROWS = 1_000_000


def shingle_set(data: bytes, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted digests; a text of fewer words is one shingle, one without words has none.  A-Z are lower-cased, ASCII white space separates words."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: max(0, len(words) - width)].tolist()]
    stops = (ends[width - 1 :] - 1).tolist() or [len(line)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter([digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64, len(starts)))


def set_digest(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes(), SEED)


def majority(own: np.ndarray) -> int:
    """SimHash of a set: a bit is set if it is in over half of the digests."""
    over = np.zeros(64, dtype=np.int64)
    for k in range(0, len(own), 1 << 14):
        over += np.unpackbits(own[k : k + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * over > len(own), bitorder="little").view("<u8")[0]) if len(own) else 0


def parities(own: np.ndarray) -> np.ndarray:
    return np.packbits(np.bincount((own >> np.uint64(55)).astype(np.int64), minlength=512) & 1, bitorder="little").view("<i8")


def described(docs: DataFrame, width: int, counters: int, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, n, print, p0, ...) of each row; and, from each task, rows (part, counts) with how often each counter's shingles occurred, 255 at most."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "digest", "n", "print", *PARITIES, "part", "counts"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, dtype=np.int32)
        id_type = None
        for b in slices(batches, "text"):
            id_type = b.schema.field(0).type
            sets = [shingle_set(x, width) for x in utf8(b.column(1))]
            np.add.at(total, (np.concatenate(sets) & np.uint64(counters - 1)).astype(np.int64), 1)
            p = np.array([parities(x) for x in sets], dtype=np.int64).reshape(-1, len(PARITIES))
            digest, prints = (np.array([f(x) for x in sets], dtype=np.uint64).view(np.int64) for f in (set_digest, majority))
            columns = [b.column(0), pa.array(digest), pa.array([len(x) for x in sets], pa.int64()), pa.array(prints), *(pa.array(np.ascontiguousarray(p[:, k])) for k in range(len(PARITIES)))]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names=names)
        if id_type is not None:
            counts = np.minimum(total, 255).astype(np.uint8).reshape(16, -1)
            nothing = [pa.nulls(16, t) for t in (id_type, *[pa.int64()] * (3 + len(PARITIES)))]
            yield pa.RecordBatch.from_arrays([*nothing, pa.array(range(16), pa.int32()), pa.array([x.tobytes() for x in counts], pa.binary())], names=names)

    schema = f"id {kind}, digest long, n long, print long, " + ", ".join(f"{p} long" for p in PARITIES) + ", part int, counts binary"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(work, schema)


def shingle_ranks(rows: DataFrame, counters: int) -> np.ndarray:
    """For each counter one byte that grows with the logarithm of its count; 0: once, or never."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(x, np.uint8).astype(np.int64)
        for k, x in total.items():
            rank = np.minimum(8 * np.log2(np.maximum(x, 1)), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([rank.tobytes()], pa.binary())], names=["part", "rank"])

    out = np.zeros((16, counters // 16), dtype=np.uint8)
    for k, x in rows.filter("counts is not null").select("part", "counts").repartition(16, "part").mapInArrow(add, "part int, rank binary").collect():  # 16 rows
        out[k] = np.frombuffer(bytes(x), np.uint8)
    return out.ravel()


def rare_shingles(docs: DataFrame, width: int, ranks: np.ndarray, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(key, digest): each distinct set under so many of its rarest shingles that two sets of at least that similarity share one.

    A set of n shingles shares at least ``similarity * n`` of them with a similar one, so in any one order of all
    shingles the first ``n - similarity * n + 1`` of both have one in common.  Keys with one set are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        mask = np.uint64(len(ranks) - 1)
        seen: set[int] = set()
        for b in slices(batches, "text"):
            keys, digests, salts = [], [], []
            if len(seen) > COPIES:
                seen.clear()
            for x in utf8(b.column(1)):
                own = shingle_set(x, width)
                digest = set_digest(own)
                if digest in seen or not len(own):
                    continue
                seen.add(digest)
                rank = ranks[(own & mask).astype(np.int64)]
                take = min(len(own), len(own) - int(np.ceil(similarity * len(own) - TINY)) + 1)
                at = np.argsort(rank, kind="stable")[:take]  # equal ranks by digest
                at = at[rank[at] > 0]
                often = 2.0 ** (rank[at] / 8)
                keys.append(own[at]), digests.append(np.full(len(at), digest, dtype=np.uint64)), salts.append(np.uint64(digest) % np.maximum(1, often / HOT).astype(np.uint64) + (often >= 2 * HOT))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(digests).view(np.int64)), pa.array(np.concatenate(salts).astype(np.int32))], names=["key", "digest", "salt"])

    # the salt is 0 for keys that are not hot; hot ones are dealt to tasks by it, and stay without being counted
    keyed = docs.select(F.col(id_col).isNotNull().alias("known"), F.col(text_col).alias("text")).filter("known").select("known", "text").mapInArrow(first, "key long, digest long, salt int")
    keyed = keyed.repartition("key", "salt").groupBy("key", "salt", "digest").agg(F.lit(1).alias("one"))
    return keyed.withColumn("sets", F.count("*").over(Window.partitionBy("key", "salt"))).filter("sets > 1 or salt > 0").select("key", "digest")


def can_link(similarity: float, a: str = "", b: str = "m_") -> Column:
    """A condition that every link meets: sizes within the similarity, and no more differing parities than differing shingles allowed."""
    sizes = F.least(f"{a}n", f"{b}n") >= similarity * F.greatest(f"{a}n", f"{b}n") - TINY
    apart = sum((F.bit_count(F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}"))) for p in PARITIES), F.lit(0))
    return sizes & (apart <= (1 - similarity) / (1 + similarity) * (F.col(f"{a}n") + F.col(f"{b}n")) + TINY)


def renamed(rows: DataFrame, prefix: str = "m_", keep: tuple[str, ...] = ("key",)) -> DataFrame:
    return rows.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in rows.columns])


def similar_pairs(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """Those of the pairs of set digests (src, dst) whose sets have the similarity, by the sets themselves: one text of each is read again."""
    wanted = stored(pairs.select(F.explode(F.array("src", "dst")).alias("digest")).distinct().join(classes.select("digest", "id"), "digest"))
    few = wanted.count() <= MOST_ROWS
    ids = wanted.select(F.col("id").alias("_id")).distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            own = [shingle_set(x, width) for x in utf8(b.column(1))]
            digest = np.array([set_digest(x) for x in own], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(digest), pa.array([x.tobytes() for x in own], pa.binary())], names=["digest", "shingles"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= similarity * (len(x) + len(y) - both) - TINY)
            yield pa.RecordBatch.from_arrays([batch.column("src"), batch.column("dst")], names=["src", "dst"]).filter(pa.array(near, pa.bool_()))

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(ids) if few else ids, F.col("id") == F.col("_id"), "left_semi")
    known = texts.mapInArrow(sets, "digest long, shingles binary").dropDuplicates(["digest"])  # an id may have several texts
    known = stored(known.join(F.broadcast(wanted.select("digest")) if few else wanted.select("digest"), "digest", "left_semi"))
    joined = pairs.join(known.select(F.col("digest").alias("src"), F.col("shingles").alias("x")), "src").join(known.select(F.col("digest").alias("dst"), F.col("shingles").alias("y")), "dst")
    return joined.select("src", "dst", "x", "y").mapInArrow(verify, "src long, dst long")


def golay_pairs(classes: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs (src, dst) of set digests from the fingerprints: equal ones with the first of them, and those that the code finds within three bits."""
    heads = stored(classes.groupBy("print").agg(F.min("digest").alias("id")).withColumnRenamed("print", "f0"))
    same = classes.join(heads.select(F.col("f0").alias("print"), F.col("id").alias("dst")), "print").select(F.col("digest").alias("src"), "dst")
    pairs = same.union(linked_prints(heads, 3)).filter("src != dst")
    pairs = pairs.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    facts = classes.select("digest", "n", *PARITIES)
    both = pairs.join(renamed(facts, "a_", ()), F.col("src") == F.col("a_digest")).join(renamed(facts, "b_", ()), F.col("dst") == F.col("b_digest"))
    return both.filter(can_link(similarity, "a_", "b_")).select("src", "dst")


def heads_of(links: DataFrame) -> DataFrame:
    """(component, head): for each node of the links (src, dst) the smallest that they lead to.

    Links are dealt to groups of about ``LINKS``, each of which becomes its nodes' links with their head there: what few links connect is known after one pass,
    without rounds and their plans.  Only the heads of several groups are connected further in rounds, as nodes of a smaller graph.
    """

    def stars(part: pa.Table) -> pa.Table:
        src, dst = (part.column(x).to_numpy() for x in ("src", "dst"))
        ids, node = np.unique(np.concatenate([src, dst]), return_inverse=True)
        head = local_heads([(node[: len(src)], node[len(src) :])], len(ids))
        return pa.table({"component": ids, "head": ids[head]})

    groups = max(1, -(-links.count() // LINKS))
    near = links.withColumn("part", F.pmod(F.xxhash64("src"), F.lit(groups)))
    near = near.groupBy("part").applyInArrow(stars, "component long, head long")
    if groups == 1:
        return near
    near = stored(near)
    edges = near.select(F.col("component").alias("src"), F.col("head").alias("dst"))
    nodes = near.select(F.col("component").alias("id")).distinct()
    return connected_components(links.sparkSession, nodes, edges).select(F.col("id").alias("component"), F.col("component").alias("head"))


def merged(label: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels (digest, component) after new edges (src, dst) between digests: only the components that these join are worked on, as nodes of a smaller graph."""
    side = lambda x: label.select(F.col("digest").alias(x), F.col("component").alias(f"{x}_component"))
    links = edges.join(side("src"), "src").join(side("dst"), "dst").select(F.col("src_component").alias("src"), F.col("dst_component").alias("dst"))
    links = stored(links.filter("src != dst").distinct())
    return stored(label.join(heads_of(links), "component", "left").select("digest", F.coalesce("head", "component").alias("component")))


def linked_sets(docs: DataFrame, classes: DataFrame, keyed: DataFrame, width: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """(digest, component) of set digests that pairs of at least that Jaccard similarity connect; sets without such a pair may be left out.

    The Golay code's candidates are verified first.  Then pairs that share a rare shingle and are not yet connected are
    compared.  While these are many, each set is compared with one other only, of those that stand for its keys the one
    of most common keys, so that a large group of near copies is connected before its pairs are written out.  A round goes on with
    the labels and with the keys that the one before it left open.  When all pairs are compared, the sets of a hot key
    are dealt to blocks, each of which meets all others in a task of its own.
    """

    def verified(pairs: DataFrame) -> DataFrame:
        return stored(similar_pairs(stored(pairs), classes, docs, width, similarity, id_col, text_col))

    edges = verified(golay_pairs(classes, similarity))
    known = keyed.select("digest").union(edges.select(F.explode(F.array("src", "dst")))).distinct()
    label = stored(known.select("digest", F.col("digest").alias("component")))
    facts = classes.select("digest", "n", *PARITIES)
    last, stalled, k = float("inf"), 0, 0
    while True:
        label = merged(label, edges)
        rows = keyed.join(label, "digest")
        groups = rows.groupBy("key", "component").count().groupBy("key").agg(F.sum("count").alias("rows"), F.sum(F.col("count") * F.col("count")).alias("within"))
        groups = stored(groups.filter("rows * rows > within"))
        left = groups.agg(F.coalesce(F.sum((F.col("rows") * F.col("rows") - F.col("within")) / 2), F.lit(0))).first()[0]
        if not left:
            return label
        rows = stored(rows.join(groups.select("key", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")), "key").join(facts, "digest"))
        keyed = rows.select("key", "digest")  # keys within one component stay so
        stalled = stalled + 1 if left > last / 2 else 0
        every = left <= FEW * rows.select("digest").distinct().count() or stalled > 2
        last, k = left, k + 1
        if every:
            own = rows.withColumn("part", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
            mate = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            pairs = own.join(renamed(mate, keep=("key", "part")), ["key", "part"])
        else:
            mate = rows.groupBy("key").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "key"]), F.xxhash64("digest", F.lit(k))).alias("m")).select("key", "m.*")
            pairs = rows.join(renamed(mate), "key")
        pairs = pairs.filter((F.col("component") != F.col("m_component")) & can_link(similarity))
        if not every:
            pairs = pairs.groupBy("digest", "m_digest").count()
            pairs = pairs.groupBy("digest").agg(F.max_by("m_digest", F.struct("count", "m_digest")).alias("m_digest"))
        edges = verified(pairs.select(F.least("digest", "m_digest").alias("src"), F.greatest("digest", "m_digest").alias("dst")).distinct())
        if every:
            return merged(label, edges)


def similar_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and component_id, for near copies by their shingles of ``width`` words.

    Texts link when the Jaccard similarity of their distinct shingles is ``similarity`` or more; every such link is found, and no other.
    component_id is the smallest id reachable by links.  Texts without words (also null) are copies of each other.
    Rows with a null id get component_id null and take no part; repeated rows stay; an empty table gives no rows.  Ids
    are integers; other columns are not read, whatever their names.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]
    counters = min(MOST_COUNTERS, max(FEWEST_COUNTERS, 1 << (size // BYTES_FOR_A_COUNTER).bit_length()))
    rows = stored(described(docs, width, counters, id_col, text_col))
    facts = rows.filter("counts is null")
    shape = [F.first(c).alias(c) for c in ("n", "print", *PARITIES)]
    classes = stored(facts.filter("id is not null").groupBy("digest").agg(F.min("id").alias("id"), *shape))
    keyed = stored(rare_shingles(docs, width, shingle_ranks(rows, counters), similarity, id_col, text_col))
    named = smallest_of(classes, linked_sets(docs, classes, keyed, width, similarity, id_col, text_col), "digest")
    out = facts.select("id", "digest").join(named, "digest", "left")
    return out.select(F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.col("head")).alias("component_id"))


def keep_first(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, with their own columns, without those whose group of near copies (``similar_groups``) has a smaller id.  Rows of a null id stay; repeated rows of a kept id all stay."""
    groups = similar_groups(docs.select(id_col, text_col), width, similarity, id_col, text_col)
    name = free_name(docs, "_later")
    later = groups.filter(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias(name)).distinct()
    return docs.join(stored(later), docs[id_col] == F.col(name), "left_anti")
