"""URL filter over a sorted array of digests.

The rules' keys (host and path start) are hashed with XXH64; the sorted
digests, offsets and full strings lie in plain files.  A worker maps the files
into memory, so all workers of a machine share one copy and only the pages that
are probed are read.  Each URL gives its candidate keys (every domain above its
host, times the path lengths that rules have); one vectorised binary search
probes all of them, and a hit counts only if the stored string is the same.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes of rule strings that are sent to every machine as files; larger lists are joined by digest.
MOST_BYTES = 256 << 20
ALLOW, BLOCK = "allow", "block"


def key_digests(keys: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)


class DigestArray:
    """Sorted digests with the strings behind them."""

    def __init__(self, folder: str):
        load = lambda name: np.load(os.path.join(folder, name), mmap_mode="r")
        self.digests, self.offsets, self.strings, self.verdicts, self.lengths, self.hosts = (load(f"{n}.npy") for n in ("digests", "offsets", "strings", "verdicts", "lengths", "hosts"))

    @staticmethod
    def write(folder: str, rules: dict[bytes, bool]) -> None:
        """rules: key, and whether it blocks."""
        keys = list(rules)
        digests = key_digests(keys)
        order = np.argsort(digests, kind="stable")
        keys = [keys[k] for k in order]
        os.makedirs(folder)
        np.save(f"{folder}/digests.npy", digests[order])
        np.save(f"{folder}/offsets.npy", np.cumsum([0, *map(len, keys)], dtype=np.int64))
        np.save(f"{folder}/strings.npy", np.frombuffer(b"".join(keys), dtype=np.uint8))
        np.save(f"{folder}/verdicts.npy", np.array([rules[k] for k in keys], dtype=bool))
        np.save(f"{folder}/lengths.npy", np.unique(np.array([len(k) - k.index(b"/") for k in keys], dtype=np.int64)))
        hosts = [k[: k.index(b"/")] for k in keys]
        #: The most labels and the most bytes of a rule's host.
        np.save(f"{folder}/hosts.npy", np.array([max((h.count(b".") + 1 for h in hosts), default=0), max(map(len, hosts), default=0)], dtype=np.int64))

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The place of each key, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        if not len(self.digests) or not keys:
            return out
        probe = key_digests(keys)
        low = np.searchsorted(self.digests, probe)
        seen = np.flatnonzero((low < len(self.digests)) & (self.digests[np.minimum(low, len(self.digests) - 1)] == probe))
        for k in seen:  # equal digests stand side by side; the strings decide
            at = int(low[k])
            while at < len(self.digests) and self.digests[at] == probe[k]:
                if self.strings[self.offsets[at] : self.offsets[at + 1]].tobytes() == keys[k]:
                    out[k] = at
                    break
                at += 1
        return out


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    stop = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    host, path = rest[:stop], rest[stop:]
    path = path[: min((k for k in map(path.find, "?#") if k >= 0), default=len(path))]
    return host.translate(LOWER), path


LOWER = {k: k + 32 for k in range(65, 91)}


def candidates(host: str, path: str, lengths: list[int], most_labels: int, most_bytes: int) -> list[bytes]:
    """All keys that a rule for this URL can have: domains above the host of no more labels and bytes than a rule's, times path starts of the lengths in use.  Longest first, ties: longer host."""
    labels = host.rsplit(".", most_labels)[-most_labels:] if most_labels else []
    path_b = path.encode()
    ends = [".".join(labels[k:]).encode() for k in range(len(labels))]
    keys = [(h, path_b[:n]) for h in ends if len(h) <= most_bytes for n in lengths if n <= len(path_b)]
    return [h + p for h, p in sorted(keys, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))]


def checked_rules(rules: list[tuple[str, str]]) -> dict[bytes, bool]:
    out: dict[bytes, bool] = {}
    for verdict, rule in rules:
        if verdict not in (ALLOW, BLOCK) or "/" not in rule:
            raise ValueError(f"not a rule: {verdict} {rule}")
        out[rule.encode()] = out.get(rule.encode(), False) or verdict == BLOCK  # the same rule twice: block holds
    return out


def url_verdicts(urls: DataFrame, rules: list[tuple[str, str]] | DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: the id, host, path, rule, verdict.

    ``rules``: (verdict, "host/path") pairs, or a table of columns verdict and
    rule.  A rule fits its host and subdomains if the path starts with the
    rule's; the longest rule wins (equal lengths: the longer host).  Without a
    rule: null and ``allow``.  Null urls and urls without ``://`` have an empty
    host and path and are allowed.  Lengths are those of UTF-8 bytes.  A verdict other than allow or block, or a rule without ``/``,
    is an error; of equal rules, block holds.  Repeated rows, null ids and urls of any length stay (of a long host only as many labels as the longest rule's are looked up), an empty table gives no rows; other columns are not read.
    Rules up to ``MOST_BYTES`` go to the machines as mapped files; a larger
    table of rules is joined by digest instead, with the same result.
    """
    spark = urls.sparkSession
    if isinstance(rules, DataFrame):
        size = rules.select(F.sum(F.octet_length("rule")).alias("n")).first()["n"] or 0
        if size > MOST_BYTES:
            return joined_verdicts(urls, rules, id_col, url_col)
        rules = [(r["verdict"], r["rule"]) for r in rules.select("verdict", "rule").toLocalIterator()]
    name = f"rules-{uuid.uuid4().hex}"
    with tempfile.TemporaryDirectory() as top:
        DigestArray.write(f"{top}/{name}", checked_rules(rules))
        shipped = ship(spark, f"{top}/{name}")
    kind = urls.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, host string, path string, rule string, verdict string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = shipped.open()
        lengths, hosts = sorted(array.lengths.tolist(), reverse=True), array.hosts.tolist()
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            keys, owner = [], []
            for k, (host, path) in enumerate(parts):
                own = candidates(host, path, lengths, *hosts)
                keys += own
                owner += [k] * len(own)
            at = array.find(keys)
            rule: list[str | None] = [None] * len(parts)
            verdict = [ALLOW] * len(parts)
            for j in np.flatnonzero(at >= 0):
                k = owner[j]
                if rule[k] is None:  # candidates come longest first
                    rule[k] = keys[j].decode()
                    verdict[k] = BLOCK if array.verdicts[at[j]] else ALLOW
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.string()), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=[id_col, "host", "path", "rule", "verdict"])

    return urls.select(F.col(id_col), F.col(url_col).alias("url")).mapInArrow(work, schema)


class Shipped:
    """A folder of index files that Spark brings to each executor."""

    def __init__(self, name: str):
        self.name = name

    def open(self) -> DigestArray:
        return DigestArray(SparkFiles.get(self.name))


def ship(spark: SparkSession, folder: str) -> Shipped:
    """Send the folder's files as an archive, which Spark unpacks once for each executor."""
    import shutil

    name = os.path.basename(folder)
    keep = tempfile.mkdtemp(prefix="spark-")  # stays until the driver ends: executors that start later fetch it too
    spark.sparkContext.addArchive(shutil.make_archive(f"{keep}/{name}", "zip", folder) + f"#{name}")
    return Shipped(name)


def joined_verdicts(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The same result for rule lists of any size, by a join on the key's digest; strings are compared too."""
    spark_id, url = F.col(id_col), F.col(url_col)
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)"))
    host = F.translate(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    rows = urls.select(spark_id.alias("id"), host.alias("host"), path.alias("path"))
    fine = F.coalesce((F.instr("rule", "/") > 0) & F.col("verdict").isin(ALLOW, BLOCK), F.lit(False))
    if (bad := rules.filter(~fine).first()) is not None:
        raise ValueError(f"not a rule: {bad['verdict']} {bad['rule']}")
    rules = rules.groupBy("rule").agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
    lengths = [r[0] for r in rules.select((F.length("rule") - F.instr("rule", "/") + 1).alias("n")).distinct().collect()]  # path lengths: a few dozen
    most = rules.agg(F.max(F.size(F.split(F.substring_index("rule", "/", 1), "[.]"))).alias("n")).first()["n"] or 1  # labels of a rule's host
    labels = F.split("host", "[.]")
    keys = (
        rows.select("host", "path").distinct().withColumn("k", F.explode(F.sequence(F.greatest(F.lit(1), F.size(labels) - most + 1), F.size(labels))))
        .withColumn("h", F.array_join(F.slice(labels, F.col("k"), F.size(labels)), "."))
        .withColumn("n", F.explode(F.array(*map(F.lit, lengths)).cast("array<int>")))
        .filter(F.col("n") <= F.length("path"))
        .select("host", "path", F.concat("h", F.expr("substring(path, 1, n)")).alias("key"), F.octet_length("h").alias("h"))
        .withColumn("digest", F.xxhash64("key"))
    )
    hits = keys.join(rules.withColumn("digest", F.xxhash64("rule")), "digest").filter("key = rule")
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.octet_length("rule"), "h")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"))
