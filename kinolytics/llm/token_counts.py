"""Token counts by prefix dynamic programming.

For a merge-based (BPE) vocabulary, the encoding of a prefix ends in exactly
one token ``t`` whose neighbour to the left is the last token of the shorter
prefix before ``t``, and the two stand side by side exactly if encoding both
together gives them back.  So the count at each prefix follows from the counts
at shorter ones.  One pass per word gives the count for every prefix, which is
kept: truncation ("how much of this text fits in 2048 tokens?") and budgets
("how many tokens has the first half?") are then answered without encoding again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinolytics.llm.common import slices, small_batches, utf8

#: What a worker keeps, by number of entries; beyond that it starts anew. A matter of speed only.
KEPT_WORDS = 400_000
KEPT_PIECES = 200_000
KEPT_PAIRS = 400_000
#: Words of more bytes are not kept.
KEPT_BYTES = 200
#: Characters of one combining sequence at whose prefixes counts are exact; inside a longer one, later prefixes have the count at its end.
SEQUENCE = 64

# The word pattern and the normaliser that the vocabulary file itself declares, and its end-of-word mark.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SHORTENED = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}
WORD_END = "</w>"
PIECES = regex.compile(PATTERN)
LETTERS, SIGNS = regex.compile(r"\p{L}+"), regex.compile(r"[^\s\p{L}\p{N}]+")
#: What most words look like once in lower case: letters, then signs, with nothing that is special or changes when normalised.
SIMPLE = re.compile(r"([a-zà-öø-ÿ]{0,48})([!-&(-/:;=-@\[-`{-~]{0,16})")
START, NONE = -1, -2


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: printable Latin-1 is itself, others follow from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=1)
def joining() -> frozenset[str]:
    """Starters that may still melt into the character before them when normalised: second parts of canonical pairs, and Hangul vowels and finals."""
    second = {chr(c) for r in (range(0x1161, 0x1176), range(0x11A8, 0x11C3)) for c in r}
    for c in range(0x30000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            second.add(chr(int(parts[1], 16)))
    return frozenset(x for x in second if not unicodedata.combining(x))


def lowered(text: str) -> str:
    """Character by character, as the file's normaliser does (no final sigma)."""
    return "".join([c.lower() for c in text])


class PrefixCounter:
    """Exact token counts of every prefix, for a word-level BPE file with end-of-word marks.

    A state belongs to each position of a piece: the last token of the encoded prefix and the number
    of tokens; an automaton over the vocabulary names the tokens that end at a position.
    """

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        split = spec["pre_tokenizer"]["pretokenizers"] if spec.get("pre_tokenizer", {}).get("type") == "Sequence" else []
        if (
            (spec["normalizer"] or {}).get("normalizers") != NORMALIZERS or [p["type"] for p in split] != ["Split", "ByteLevel"] or split[0]["pattern"] != {"Regex": PATTERN}
            or model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"{path}: not the normaliser, pattern or kind of model that prefixes are counted for")
        ids = {t: k for k, t in enumerate(model["vocab"])}
        self.size = len(ids)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank: dict[int, int] = {}
        self.parts: list[tuple[int, int, int] | None] = [None] * self.size
        for k, (a, b) in enumerate(merges):
            whole = ids[a + b]
            self.rank[ids[a] * self.size + ids[b]] = k
            if self.parts[whole] is None:
                self.parts[whole] = (k, ids[a], ids[b])
        self.find = ahocorasick.Automaton()
        for t in {t.removesuffix(WORD_END) for t in ids} - {""}:
            self.find.add_word(t, (len(t), ids.get(t, NONE), ids.get(t + WORD_END, NONE)))
        self.find.make_automaton()
        self.longest = max(map(len, ids))
        self.letters = byte_letters()
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None
        self.beside: dict[int, bool] = {}
        self.kept: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, list[int]] = {}
        self.spelled: dict[str, str] = {}

    def adjacent(self, left: int, right: int) -> bool:
        """Do the two tokens stay as they are when their letters are encoded together?

        Merges run by rank.  A merge across the border would have to come before those merges that
        give the tokens the shape in which they meet it; so the tokens are taken apart again, the later
        merge first, and each pair at the border is looked up.  Of equal ranks the left one runs first.
        """
        rank, parts, size = self.rank, self.parts, self.size
        a, b, before = left, right, len(rank) + 1
        while True:
            if rank.get(a * size + b, before) < before:
                return False
            at_a, at_b = parts[a], parts[b]
            if at_a and (not at_b or at_a[0] > at_b[0]):
                before, a = at_a[0], at_a[2]
            elif at_b:
                before, b = at_b[0] + 1, at_b[1]
            else:
                return True

    def grow(self, letters: str, last: list[int], count: list[int]) -> list[int]:
        """Extend the states (last token, count) over the rest of ``letters``, whose beginning they cover; return the counts as whole words, by position."""
        done, size, beside = len(last) - 1, self.size, self.beside
        more = len(letters) - done
        last += [NONE] * more
        count += [0] * more
        words = [0] * (len(letters) + 1)
        if len(beside) > KEPT_PAIRS:
            beside.clear()
        for end, (n, token, word) in self.find.iter(letters, max(0, done - self.longest)):
            j = end + 1
            i = j - n
            if j <= done or i < 0:
                continue
            before = last[i]
            if before == NONE:
                continue
            if token != NONE and last[j] == NONE:
                fits = before == START
                if not fits:
                    pair = before * size + token
                    fits = beside.get(pair)
                    if fits is None:
                        fits = beside[pair] = self.adjacent(before, token)
                if fits:
                    last[j] = token
                    count[j] = count[i] + 1
            if word != NONE and not words[j]:
                fits = before == START
                if not fits:
                    pair = before * size + word
                    fits = beside.get(pair)
                    if fits is None:
                        fits = beside[pair] = self.adjacent(before, word)
                if fits:
                    words[j] = count[i] + 1
        return words

    def spelling(self, text: str) -> list[str]:
        """Each character in the vocabulary's letters."""
        spelled = self.spelled
        out = []
        for c in text:
            s = spelled.get(c)
            if s is None:
                s = spelled[c] = "".join([self.letters[b] for b in c.encode()])
            out.append(s)
        return out

    def piece(self, text: str) -> list[int]:
        """Counts at the prefixes of one piece, by characters."""
        out = self.pieces.get(text)
        if out is None:
            out = self.states(text)[0]
            if len(text) <= 64:
                if len(self.pieces) > KEPT_PIECES:
                    self.pieces.clear()
                self.pieces[text] = out
        return out

    def states(self, text: str) -> tuple[list[int], str, list[int], list[int], list[int]]:
        """(counts at the prefixes of one piece, its letters, where in them each character ends, last token and count at each letter)."""
        last, count = [START], [0]
        if text.isascii() and text.isprintable():  # these characters are their own letters
            words = self.grow(text, last, count)
            return words[1:], text, list(range(1, len(text) + 1)), last, count
        spelled = self.spelling(text)
        letters = "".join(spelled)
        ends = list(accumulate(map(len, spelled)))
        words = self.grow(letters, last, count)
        return [words[e] for e in ends], letters, ends, last, count

    def pieced(self, text: str) -> list[int]:
        """Counts at the prefixes of a normalised text without special strings: its pieces, one after the other."""
        out: list[int] = []
        for p in PIECES.finditer(text):
            base = out[-1] if out else 0
            out += [base] * (p.start() - len(out))  # white space
            if p[0] in SHORTENED:  # cut short, it is other pieces
                out += [base + sum(self.piece(q)[-1] for q in PIECES.findall(p[0][:j])) for j in range(1, len(p[0]) + 1)]
            else:
                out += [base + x for x in self.piece(p[0])]
        return out + [out[-1] if out else 0] * (len(text) - len(out))

    def plain(self, text: str) -> list[int]:
        """Counts at the prefixes of a text without special strings.

        The normalised text is built from sequences of characters that can melt into each other.  A prefix
        that ends inside a sequence is normalised otherwise than the whole: it is what stands before the sequence,
        and its own tail, from which the states of the piece before go on.
        """
        lower = [c.lower() for c in text]
        if all(len(c) == 1 for c in lower) and unicodedata.is_normalized("NFC", text):
            return self.pieced("".join(lower))
        join = joining()
        cuts = [k for k, c in enumerate(text) if not unicodedata.combining(c) and c not in join]
        if not cuts or cuts[0]:
            cuts = [0, *cuts]
        parts: list[str] = []
        at, places, tails = 0, [], []
        for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True):
            whole = lowered(unicodedata.normalize("NFC", text[a:b]))
            for j in range(a + 1, b):
                part = lowered(unicodedata.normalize("NFC", text[a:j])) if j - a <= SEQUENCE else whole
                if not whole.startswith(part):
                    tails.append((len(places), at, part))
                places.append(at + len(part))
            parts.append(whole)
            at += len(whole)
            places.append(at)
        normal = "".join(parts)
        counts = [0, *self.pieced(normal)]
        out = [counts[k] if k < len(counts) else 0 for k in places]
        pieces = [p.span() for p in PIECES.finditer(normal)] if tails else []
        k, known = -1, None
        for where, at, tail in tails:
            while k + 1 < len(pieces) and pieces[k + 1][0] < at:
                k, known = k + 1, None
            start = pieces[k][0] if k >= 0 and at <= pieces[k][1] else at
            if at - start <= 64:
                if k > 0 and start == pieces[k][0] and normal[slice(*pieces[k - 1])] == "'" and pieces[k - 1][1] == start:
                    start -= 1  # the tail may complete a shortened word
                out[where] = counts[start] + (self.pieced(normal[start:at] + tail) or [0])[-1]
                continue
            known = known or self.states(normal[start : pieces[k][1]])
            _, letters, ends, last, count = known
            own = (LETTERS if LETTERS.match(normal[start]) else SIGNS).match(tail)
            here = ends[at - start - 1]
            low = max(0, here - self.longest)
            window = letters[low:here] + "".join(self.spelling(own[0] if own else ""))
            grown = self.grow(window, last[low : here + 1], count[low : here + 1])[-1] if own else counts[at] - counts[start]
            out[where] = counts[start] + grown + (self.pieced(tail[own.end() if own else 0 :]) or [0])[-1]
        return out

    def word(self, data: bytes) -> bytes:
        """For a stretch without white space: by how much the count rises at each character, one signed byte each.
        (A character has at most four letters and a token at most a few dozen; only what is not kept may rise by more, see ``prefixes``.)"""
        text = data.decode()
        if m := SIMPLE.fullmatch(text.lower()):
            counts = self.piece(m[1]) if m[1] else []
            if m[2]:
                base = counts[-1] if counts else 0
                counts = counts + [base + x for x in self.piece(m[2])]
        else:
            counts = self.marked(text)
        return array("b", map(sub, counts, [0, *counts])).tobytes()

    def marked(self, text: str) -> list[int]:
        """Counts at the prefixes of any text: special strings are one token each, but plain text while they are not complete."""
        out: list[int] = []
        start = 0
        for m in self.special.finditer(text) if self.special else ():
            base = out[-1] if out else 0
            got = self.plain(text[start : m.end() - 1])
            out += [base + x for x in got]
            out.append(base + (got[m.start() - start - 1] if m.start() > start else 0) + 1)
            start = m.end()
        base = out[-1] if out else 0
        return out + [base + x for x in self.plain(text[start:])]

    def known(self, words: set[bytes]) -> dict[bytes, bytes]:
        """A table that has all these words.  Two generations: a full one becomes the old one, and what is used again moves up."""
        if len(self.kept) > KEPT_WORDS:
            self.old, self.kept = self.kept, {}
        table = self.kept
        for w in words.difference(table):
            table[w] = self.old.get(w) or self.word(w)
        return table

    def prefixes(self, data: bytes) -> np.ndarray:
        """Token counts of the text's first 1, 2, ... characters.  Long stretches are counted by themselves and not kept."""
        parts = data.split()
        if len(data) > KEPT_BYTES and max(map(len, parts), default=0) > KEPT_BYTES:
            return self.long_prefixes(data)
        table = self.known(set(parts))
        if parts and len(b" ".join(parts)) == len(data):
            raised = b"\0".join(map(table.__getitem__, parts))
        else:
            raised = b"".join([bytes(len(x)) if x.isspace() else table[x] for x in re.findall(rb"[ \t-\r]+|[^ \t-\r]+", data)])
        return np.cumsum(np.frombuffer(raised, dtype=np.int8), dtype=np.int32)

    def long_prefixes(self, data: bytes) -> np.ndarray:
        out, base = [], 0
        for m in re.finditer(rb"[ \t-\r]+|[^ \t-\r]+", data):
            x = m[0]
            if x.isspace():
                counts = np.full(len(x), base, dtype=np.int32)
            elif len(x) <= KEPT_BYTES:
                counts = np.cumsum(np.frombuffer(self.known({x})[x], dtype=np.int8), dtype=np.int32) + base
            else:
                counts = np.array(self.marked(x.decode()), dtype=np.int32) + base
            out.append(counts)
            base = int(counts[-1])
        return np.concatenate(out).astype(np.int32)


@lru_cache(maxsize=1)
def counter_of(path: str) -> PrefixCounter:
    """One counter for each worker process: what it has learnt serves the next task too."""
    return PrefixCounter(path)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per input row: the id, n_bytes, n_tokens, fit_chars, prefix_tokens.

    ``prefix_tokens[i]`` is the exact count of the text's first ``i + 1``
    characters (see ``SEQUENCE`` for prefixes that end inside very long combining
    sequences); ``fit_chars`` the length of the longest prefix of at most
    ``limit`` tokens.  ``tokens_before`` and ``fits`` answer further questions from
    the stored counts.  ``vocabulary`` is a path that every worker can open (an
    installed package's file); a file of another pattern, normaliser or kind of
    model is refused.  Null and empty texts have 0 tokens and an empty
    array.  Repeated rows give repeated rows, null ids stay, an empty table gives no
    rows; other columns are not read, whatever their names.  Time and memory grow in proportion to a text's length:
    a task holds one slice of about 1 MB of text, or one text, and its counts.
    """
    small_batches(docs.sparkSession)
    field = docs.schema[id_col]
    schema = f"`{id_col}` {field.dataType.simpleString()}, n_bytes long, n_tokens long, fit_chars long, prefix_tokens array<int>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for batch in slices(batches, "text", 1 << 20):
            texts = utf8(batch.column(1))
            counts = [counter.prefixes(x) for x in texts]
            fit = []
            for c in counts:
                if not len(c) or c[-1] <= limit:
                    fit.append(len(c))
                else:
                    fits = np.flatnonzero(c <= limit)
                    fit.append(int(fits[-1]) + 1 if len(fits) else 0)
            offsets = np.cumsum([0, *map(len, counts)], dtype=np.int32)
            values = np.concatenate(counts) if counts else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([int(c[-1]) if len(c) else 0 for c in counts], pa.int64()),
                    pa.array(fit, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                names=[id_col, "n_bytes", "n_tokens", "fit_chars", "prefix_tokens"],
            )

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(work, schema)


def tokens_before(prefix_tokens: Column, chars: Column | int) -> Column:
    """Tokens of the text's first ``chars`` characters, from the stored counts; beyond its end, those of the whole text."""
    chars = F.lit(chars) if isinstance(chars, int) else chars
    at = F.least(chars, F.size(prefix_tokens))
    return F.when(at <= 0, F.lit(0)).otherwise(F.try_element_at(prefix_tokens, F.greatest(at, F.lit(1)).cast("int")))


def fits(prefix_tokens: Column, limit: Column | int) -> Column:
    """Characters of the longest prefix of at most ``limit`` tokens, from the stored counts (a count may fall when a character completes a token)."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    return F.coalesce(F.array_max(F.transform(prefix_tokens, lambda n, k: F.when(n <= limit, k + 1))), F.lit(0))
