"""Packing documents into token sequences, first-fit decreasing.

Each document becomes its token ids and an end id, cut into full pieces and one
remainder.  Documents are dealt to groups by a hash of id and text; within a group
remainders are placed in order of falling length into the first sequence with
room.  A tournament tree over the sequences' free room finds that sequence in
logarithmic time.  Groups are independent tasks.
"""

from __future__ import annotations

import base64
import os
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import slices, small_batches

#: Documents of a group on average, and bytes of text: a group is one task's work.
GROUP_DOCS = 1500
GROUP_BYTES = 16 << 20
NATIVE = sys.byteorder == "little" and array("I").itemsize == 4
#: Texts of these characters alone are split alike by both libraries, whatever version of Unicode they follow.
OTHER = re.compile(r"[^ \n!-~¡-ɏ]")
#: The faster library's pattern needs stack for each blank of a run: longer runs go to the file itself.
BLANKS = re.compile(r"(?<![ \n])[ \n]{10000}")


class ByteIds:
    """Ids of a byte-level tokenizer file, as little-endian unsigned 32-bit numbers.

    ``ranks`` names the same vocabulary as ranks: texts of plain characters without special strings
    and runs of ten thousand blanks are then encoded by the faster library, with the same result; all others by the file itself.
    """

    def __init__(self, path: str, ranks: str | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = None
        if ranks:
            with open(ranks, "rb") as f:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.plain = tiktoken.Encoding(os.path.basename(ranks), pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.plain is not None and not OTHER.search(text) and not any(s in text for s in self.special) and not BLANKS.search(text):
            return array("I", self.plain.encode_ordinary(text)).tobytes() if NATIVE else np.array(self.plain.encode_ordinary(text), dtype="<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@lru_cache(maxsize=1)
def coder_of(path: str, ranks: str | None) -> ByteIds:
    """One coder for each worker process: the vocabulary is read once, not for each task."""
    return ByteIds(path, ranks)


class Room:
    """A tournament tree: each node holds the largest free room of the sequences below it."""

    def __init__(self, sequences: int, capacity: int):
        self.leaves = 1 << max(0, (sequences - 1).bit_length())
        self.best = [capacity] * (2 * self.leaves)

    def first_with(self, need: int) -> int:
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < need:
                node += 1
        return node - self.leaves

    def take(self, sequence: int, need: int) -> int:
        """Fill ``need`` and return the offset where it starts, counted back from the free room."""
        best, node = self.best, sequence + self.leaves
        left = best[node] = best[node] - need
        node //= 2
        while node:
            top = max(best[2 * node], best[2 * node + 1])
            if best[node] == top:
                break
            best[node] = top
            node //= 2
        return left


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; ties in length go by position."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = np.flatnonzero(lengths == capacity)
    sequence[full] = np.arange(len(full))
    rest = np.flatnonzero(lengths < capacity)
    room = Room(len(rest), capacity)
    for k in rest[np.argsort(-lengths[rest], kind="stable")].tolist():
        need = int(lengths[k])
        at = room.first_with(need)
        offset[k] = capacity - room.take(at, need) - need
        sequence[k] = at + len(full)
    return sequence, offset


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, capacity: int = 1024, end_id: int = 0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, of the ids of ``vocabulary`` (``ranks``: see ``ByteIds``): the id, start, length, ids (little-endian uint32, binary), doc_tokens, sequence_id, offset.

    Every row of the input is a document of its own (repeated rows too); null and
    empty texts are the end id alone.  Each id lies in exactly one piece; pieces of
    a sequence lie gapless from offset 0.  sequence_id is unique over all groups.
    An empty table gives no rows; other columns are not read.  Equal lengths are placed by id and start.
    Null and repeated ids are spread by their texts.  Runs of blanks of any length are encoded (``BLANKS``).
    Memory: one group (about ``GROUP_DOCS`` documents), or one very long document.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()
    groups = max(1, -(-total["n"] // GROUP_DOCS), -(-total["size"] // GROUP_BYTES))
    rows = rows.select("id", "text", F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(groups)).alias("group"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(vocabulary, ranks)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text", 1 << 20):
            row, start, ids, doc = [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                data = coder.ids(text or "") + end
                for a in range(0, len(data), 4 * capacity):
                    row.append(k), start.append(a // 4), ids.append(data[a : a + 4 * capacity]), doc.append(len(data) // 4)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(2).take(at), batch.column(0).take(at), pa.array(start, pa.int64()), pa.array(ids, pa.binary()), pa.array(doc, pa.int64())], names=["group", "id", "start", "ids", "doc_tokens"])

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("start", "ascending"), ("doc_tokens", "ascending")])
        lengths = np.array([len(x) // 4 for x in table.column("ids").to_pylist()], dtype=np.int64)
        sequence, offset = first_fit_decreasing(lengths, capacity)
        number = (int(table.column("group")[0].as_py()) << 32) + sequence
        columns = [table.column("id"), table.column("start"), pa.array(lengths), table.column("ids"), table.column("doc_tokens"), pa.array(number), pa.array(offset)]
        return pa.Table.from_arrays(columns, names=[id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    pieces = rows.mapInArrow(cut, f"group long, id {kind}, start long, ids binary, doc_tokens long")
    return pieces.groupBy("group").applyInArrow(place, f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids binary, n_tokens): the packed sequences themselves, before padding; at most ``capacity`` ids each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))
