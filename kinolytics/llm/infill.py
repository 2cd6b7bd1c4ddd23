"""Fill-in-the-middle: a text's prefix, middle and suffix in the order that infilling is trained with.

Cuts lie between units (a word with the white space before it, or white space that ends the text).  A Fenwick
tree over blocks of the text's bytes holds how many units end in each block and how many code points begin in it;
the k-th unit's block is found by binary lifting, its end by looking at that block alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import slices, small_batches, utf8

#: Bytes of a text block.
BLOCK = 1024
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


class Units:
    """A text's units: how many there are, and where the k-th one ends in bytes and code points."""

    def __init__(self, text: bytes):
        self.data = np.frombuffer(text, np.uint8)
        edges = np.arange(0, max(len(text), 1), BLOCK)
        ends, points = self.unit_ends(0, len(text)), (self.data & 0xC0) != 0x80
        counts = np.stack([np.add.reduceat(x, edges, dtype=np.int64) for x in (ends, points)]) if len(text) else np.zeros((2, 1), np.int64)
        prefix = np.concatenate([np.zeros((2, 1), np.int64), counts.cumsum(axis=1)], axis=1)
        node = np.arange(1, counts.shape[1] + 1)
        #: Node i of the tree holds the blocks (i - lowest bit of i, i].
        self.tree = np.concatenate([np.zeros((2, 1), np.int64), prefix[:, node] - prefix[:, node - (node & -node)]], axis=1).tolist()
        self.count = int(prefix[0, -1])

    def unit_ends(self, start: int, stop: int) -> np.ndarray:
        """Whether a unit ends at each byte: at the last byte of a word, and at the text's last byte."""
        gap = blank(self.data[start : stop + 1])
        if stop >= len(self.data):
            gap = np.append(gap, True)
        ends = ~gap[:-1] & gap[1:]
        if stop >= len(self.data) and len(ends):
            ends[-1] = True
        return ends

    def end(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``k`` units."""
        if k <= 0:
            return 0, 0
        units, points = self.tree
        block, seen, left = 0, 0, k
        step = 1 << ((len(units) - 1).bit_length() - 1)
        while step:
            if block + step < len(units) and units[block + step] < left:
                block += step
                left -= units[block]
                seen += points[block]
            step >>= 1
        start = block * BLOCK
        stop = start + int(np.flatnonzero(self.unit_ends(start, min(start + BLOCK, len(self.data))))[left - 1]) + 1
        return stop, seen + int(np.count_nonzero((self.data[start:stop] & 0xC0) != 0x80))


def draws(id_col: str, seed: int) -> list[Column]:
    """Four numbers below 2**32 for each id, from the SHA-256 of ``seed:id`` (a null id counts as empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def infilled(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(the id, n, form, prefix_chars, middle_chars, output) for each row.

    n units; form is plain (the text as it is), psm (prefix, suffix, middle) or spm (suffix, prefix, middle), each part after its mark;
    the middle is last, as it is what a model learns to fill in.  Draws depend on the seed and the id only.  Plain are empty texts, those that hold a mark
    themselves, and those that ``percent`` does not choose; prefix_chars and middle_chars (code points) are null for them.  Null texts count as empty,
    null ids as the empty string; rows with equal ids draw alike; an empty table gives no rows; other columns are not read, whatever their names.
    Texts of any length are cut whole: memory is a few times the longest text, and a cut looks at one block.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[h.alias(f"h{k}") for k, h in enumerate(draws(id_col, seed))])
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            drawn = [batch.column(k).to_pylist() for k in range(2, 6)]
            out: list[tuple] = []
            for text, h1, h2, h3, h4 in zip(utf8(batch.column(1)), *drawn, strict=True):
                units = Units(text)
                if not text or h3 % 100 >= percent or any(m in text for m in marks):
                    out.append((units.count, "plain", None, None, text))
                    continue
                low, high = sorted((h1 % (units.count + 1), h2 % (units.count + 1)))
                (a, before), (b, until) = units.end(low), units.end(high)
                head, middle, tail = text[:a], text[a:b], text[b:]
                p, s, m = marks
                form = "spm" if h4 % 100 < spm_percent else "psm"
                out.append((units.count, form, before, until - before, s + tail + p + head + m + middle if form == "spm" else p + head + s + tail + m + middle))
            n, form, before, inside, output = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(inside, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())], names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    made = rows.mapInArrow(cut, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.  Marks cannot occur in its parts nor across their borders, so each is found by its first place."""
    def between(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(one) + F.lit(len(second) + 1))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.length(two) + F.lit(len(MIDDLE) + 1))

    head, tail, middle = between(PREFIX, SUFFIX)
    psm = F.concat(head, middle, tail)
    tail, head, middle = between(SUFFIX, PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(head, middle, tail)).otherwise(output)
