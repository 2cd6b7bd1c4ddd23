"""WARC archives with a two-level capture index.

Writing: each task packs its pages into one archive in which every record is a
gzip member of its own, and returns a manifest row for each record.  An archive that
a lost or repeated task has left is in no manifest and is never read.
Index: entries sorted by the reversed host of the URL are cut into compressed
blocks; a sparse directory keeps the first and last key and the place of each block.
Reading: URL keys are sorted and dealt to tasks by range; a task reads the directory's rows of its range,
finds each key's blocks by binary search, and blocks and records are then read by range.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import dataset, fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolytics.llm.common import shared_dir, slices, small_batches, stored, utf8

#: Payloads shorter than this are always written out.
LEAST_REVISIT = 100
BLOCK_ENTRIES = 1000
DATE = "2024-01-01T00:00:00Z"  # the tables have no capture time


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def url_key(url: Column) -> Column:
    """Host with its labels reversed, then the rest: ``com,example,www)/path``.  Null: empty."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), "^[^:/?#]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), F.lit(")"), F.regexp_extract(rest, "^[^/?#]*(.*)$", 1))


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest}')}>"


def record(page: int | None, url: str | None, kind: str, digest: str, size: int, payload: bytes, refers: int | None) -> bytes:
    """One gzip member: a response holds an HTTP message, a revisit its header alone and the response's record id."""
    http = "\r\n".join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size}", "", ""]).encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page, digest)}",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + (url or "").translate({13: "%0D", 10: "%0A"}),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"X-Page-Id: {'' if page is None else page}",
        f"X-Payload-Length: {size}",
    ]
    if refers is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers, digest)}", f"X-Refers-To-Page-Id: {refers}"]
    block = http + payload
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    return gzip.compress(head + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    data = zlib.decompress(member, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all rows as records under ``folder``; the manifest (page, key, file, offset, length) is stored at ``folder/manifest``.

    Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, the one with the
    smallest id is a response and the others revisit it; all others are
    responses.  Null html is an empty payload.  Repeated rows with one id are all responses if theirs is the smallest (copies of one record, with one record id).
    """
    spark = pages.sparkSession
    small_batches(spark)
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("page", "url", "payload", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("size"))
    heads = rows.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page").alias("head"), F.count("*").alias("n")).filter("n > 1").select("digest", "head")
    heads = stored(heads)
    named = rows.select("page", "url", "payload", "digest", "size").join(heads, "digest", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(folder)
        name = f"pages-{uuid.uuid4().hex}.warc.gz"
        at, sink = 0, None
        for b in slices(batches, "payload", 4 << 20):
            if sink is None:
                system.create_dir(f"{top}/archives", recursive=True)
                sink = system.open_output_stream(f"{top}/archives/{name}", compression=None)
            offsets, lengths = [], []
            columns = [b.column(n).to_pylist() for n in ("page", "url", "digest", "size", "head")]
            for payload, page, url, digest, size, head in zip(utf8(b.column("payload")), *columns, strict=True):
                revisit = head is not None and page != head
                member = record(page, url, "revisit" if revisit else "response", digest, size, b"" if revisit else payload, head if revisit else None)
                sink.write(member)
                offsets.append(at), lengths.append(len(member))
                at += len(member)
            yield pa.RecordBatch.from_arrays([b.column("page"), b.column("url"), pa.array([name] * b.num_rows), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["page", "url", "file", "offset", "length"])
        if sink is not None:
            sink.close()

    manifest = named.mapInArrow(write, f"page {kind}, url string, file string, offset long, length long")
    manifest = manifest.select("page", url_key(F.col("url")).alias("key"), "file", "offset", "length")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def build_index(manifest: DataFrame, folder: str) -> DataFrame:
    """Sort the entries by key into compressed blocks; the directory (first, last, file, offset, length, entries) is stored at ``folder/directory``.
    Entries of one host, even of one URL, may fill many blocks and many files."""
    spark = manifest.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(folder)
        name = f"index-{uuid.uuid4().hex}.gz"
        sink, at, waiting = None, 0, []

        def block(rows: list[tuple]) -> tuple:
            nonlocal sink, at
            if sink is None:
                system.create_dir(f"{top}/index", recursive=True)
                sink = system.open_output_stream(f"{top}/index/{name}", compression=None)
            data = gzip.compress("\n".join(json.dumps(r) for r in rows).encode(), compresslevel=1, mtime=0)
            sink.write(data)
            at += len(data)
            return rows[0][0], rows[-1][0], name, at - len(data), len(data), len(rows)

        def directory(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["first", "last", "file", "offset", "length", "entries"])

        for b in batches:
            waiting += zip(*(b.column(n).to_pylist() for n in ("key", "page", "file", "offset", "length")), strict=True)
            full = len(waiting) // BLOCK_ENTRIES * BLOCK_ENTRIES
            if full:
                yield directory([block(waiting[k : k + BLOCK_ENTRIES]) for k in range(0, full, BLOCK_ENTRIES)])
                waiting = waiting[full:]
        if waiting:
            yield directory([block(waiting)])
        if sink is not None:
            sink.close()

    order = [F.col(c) for c in ("key", "page", "file", "offset")]
    parts = manifest.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    parts.mapInArrow(write, "first string, last string, file string, offset long, length long, entries long").write.parquet(f"{folder}/directory")
    return spark.read.parquet(f"{folder}/directory")


def directory_rows(folder: str, low: str, high: str) -> list[tuple[str, str, str, int, int]]:
    """(first, last, file, offset, length) of the blocks that may hold keys from ``low`` to ``high``, in order; other parts of the directory are skipped by their statistics."""
    system, top = opened(folder)
    held = dataset.dataset(f"{top}/directory", filesystem=system, format="parquet")
    found = held.to_table(columns=["first", "last", "file", "offset", "length"], filter=(dataset.field("last") >= low) & (dataset.field("first") <= high))
    found = found.sort_by([("first", "ascending"), ("last", "ascending"), ("file", "ascending"), ("offset", "ascending")])
    return list(zip(*(found.column(n).to_pylist() for n in ("first", "last", "file", "offset", "length")), strict=True))


def blocks_of(keys: list[str], blocks: list[tuple[str, str, str, int, int]]) -> list[tuple[str, int, int, list[str]]]:
    """(file, offset, length, keys) of each block where some of the sorted ``keys`` may lie, by binary search in the sorted directory rows."""
    last = [b[1] for b in blocks]
    wanted: dict[int, list[str]] = {}
    for key in keys:
        at = bisect.bisect_left(last, key)
        while at < len(blocks) and blocks[at][0] <= key:
            wanted.setdefault(at, []).append(key)
            at += 1
    return [(*blocks[at][2:], found) for at, found in wanted.items()]


def captures(folder: str, key: str) -> list[tuple[dict[str, str], bytes]]:
    """All records under one key, as (header fields, payload), read by one process."""
    system, top = opened(folder)
    out = []
    for file, offset, length, _ in blocks_of([key], directory_rows(folder, key, key)):
        for entry in block_entries(system, f"{top}/index/{file}", offset, length):
            if entry[0] == key:
                with system.open_input_file(f"{top}/archives/{entry[2]}") as f:
                    out.append(parsed(f.read_at(entry[4], entry[3])))
    return out


def block_entries(system: fs.FileSystem, path: str, offset: int, length: int) -> list[list]:
    with system.open_input_file(path) as f:
        return [json.loads(x) for x in zlib.decompress(f.read_at(length, offset), wbits=31).decode().split("\n")]


def looked_up(keys: DataFrame, folder: str, page_type: str = "bigint") -> DataFrame:
    """(page, uri, record_type, payload_digest, payload_bytes, refers_to, payload) of every capture under the table's ``key`` values, read back from the archives.

    Keys are sorted and dealt to tasks by range, where a binary search in the directory finds their blocks.  Blocks
    are dealt anew, so that the many blocks of one key are read by many tasks; entries then go
    to the archives' tasks in the order of their offsets, so that ranges are read
    forwards.  The digest and length of a response are computed from its payload;
    a revisit has those of its header, and no payload (null).  Keys without captures, null keys and repeated ones give nothing more.
    """
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_pylist()
            if not own:
                continue
            found = blocks_of(own, directory_rows(folder, own[0], own[-1]))
            columns = zip(*found, strict=True) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string())), strict=True)], names=["file", "offset", "length", "keys"])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(folder)
        for b in batches:
            for file, offset, length, wanted in zip(*(b.column(n).to_pylist() for n in ("file", "offset", "length", "keys")), strict=True):
                wanted = set(wanted)
                rows = [r for r in block_entries(system, f"{top}/index/{file}", offset, length) if r[0] in wanted]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in ((2, pa.string()), (3, pa.int64()), (4, pa.int64()))], names=["file", "offset", "length"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(folder)
        name, source = None, None
        for b in batches:
            out = []
            for file, offset, length in zip(*(b.column(n).to_pylist() for n in ("file", "offset", "length")), strict=True):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, system.open_input_file(f"{top}/archives/{file}")
                f, payload = parsed(source.read_at(length, offset))
                kind, page, refers = f["WARC-Type"], f["X-Page-Id"], f.get("X-Refers-To-Page-Id", "")
                if kind == "response":
                    digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
                    if f["WARC-Payload-Digest"] != f"sha256:{digest}":
                        raise ValueError(f"damaged record: {file} at {offset}")
                else:
                    digest, size, payload = f["WARC-Payload-Digest"].removeprefix("sha256:"), int(f["X-Payload-Length"]), None
                out.append((int(page) if page else None, f["WARC-Target-URI"], kind, digest, size, int(refers) if refers else None, payload))
                if len(out) == 500:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)
        if source is not None:
            source.close()

    page = {"bigint": pa.int64(), "int": pa.int32()}[page_type]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (page, pa.string(), pa.string(), pa.string(), pa.int64(), page, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["page", "uri", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"])

    sorted_keys = keys.select("key").dropna().distinct().repartitionByRange(parts, "key").sortWithinPartitions("key")
    blocks = sorted_keys.mapInArrow(search, "file string, offset long, length long, keys array<string>")
    found = blocks.repartition(parts, "file", "offset").mapInArrow(entries, "file string, offset long, length long")
    # an archive's records may go to several tasks, by stretches of 64 MB
    found = found.repartition(parts, "file", F.floor(F.col("offset") / (64 << 20))).sortWithinPartitions("file", "offset")
    return found.mapInArrow(records, f"page {page_type}, uri string, record_type string, payload_digest string, payload_bytes long, refers_to {page_type}, payload binary")


def read_all(spark: SparkSession, folder: str, page_type: str = "bigint") -> DataFrame:
    """``looked_up`` for every key of the manifest."""
    return looked_up(spark.read.parquet(f"{folder}/manifest").select("key"), folder, page_type)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the rows as archives with an index into the shared folder, and look all their URLs up again (``looked_up``): each row comes back once.

    An empty table gives no rows; repeated rows come back as often as they are; null ids stay null; other columns are not read.
    """
    folder = shared_dir(pages.sparkSession)
    build_index(write_archives(pages, folder, id_col, url_col, html_col), folder)
    return looked_up(pages.select(url_key(F.col(url_col)).alias("key")), folder, pages.schema[id_col].dataType.simpleString())
