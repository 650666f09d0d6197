"""Token counts of texts at every prefix, by dynamic programming over a byte-level BPE.

The encoding of a prefix of a piece is the encoding of a shorter prefix plus one last token, and
that token is the only one that stays whole beside the last token of the shorter prefix. So one
pass over the end positions gives the exact count at each of them. A text's prefix counts are
those of its pieces laid end to end; only white space at the end of a prefix and a contraction
cut in two are split otherwise than in the whole text, and are counted as split there.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The pieces that a byte-level tokenizer of this kind cuts a text into.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Pieces remembered by a worker before it starts afresh.
REMEMBERED = 1_000_000

#: Bytes of a piece up to which its prefixes are remembered.
LONG = 48

#: Counts handed on in one Arrow batch.
BATCH_COUNTS = 4_000_000


def byte_letters() -> dict[str, int]:
    """The printable letter that a vocabulary file writes for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Token counts at every prefix, for a tokenizer file of kind byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec["pre_tokenizer"]
        if (spec["model"]["type"], cut["type"]) != ("BPE", "ByteLevel") or cut["add_prefix_space"] \
                or not cut.get("use_regex", True) or spec.get("normalizer"):
            raise ValueError("not a plain byte-level BPE tokenizer")
        letters = byte_letters()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        added = [t["content"] for t in spec["added_tokens"]]
        self.tokens = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items()
                       if t not in added}
        self.ranks = {tuple(bytes(letters[c] for c in part) for part in m): i
                      for i, m in enumerate(merges)}
        #: How each longer token is made: rank of the merge, left part, right part.
        self.made = {a + b: (i, a, b) for (a, b), i in self.ranks.items()}
        if len(self.made) < len(self.ranks) or any(
                len(t) > 1 and t not in self.made for t in self.tokens):
            raise ValueError("a token is made by several merges, or by none")
        self.longest = max(map(len, self.tokens))
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pieces = regex.compile(PIECES)
        self.whole: dict[tuple[bytes, bytes], bool] = {}
        self.runs = regex.compile(r"\s\s+")
        self.ends: dict[bytes, tuple[int, bytes]] = {}
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def stays(self, last: bytes, token: bytes) -> bool:
        """Whether ``token`` follows ``last`` in the encoding of the two joined.

        It does if no merge across the seam ranks before the merge that closes the seam's side:
        the two tokens are taken apart along the seam, latest merge first, and at each step the
        two parts that touch must not have been due to merge earlier.
        """
        if not last:
            return True
        if (known := self.whole.get((last, token))) is None:
            known = self.whole[last, token] = self._stays(last, token)
        return known

    def _stays(self, left: bytes, right: bytes) -> bool:
        never = len(self.ranks)
        ranks, made = self.ranks, self.made
        made_left, made_right = made.get(left), made.get(right)
        due = never  # rank of the merge that hid the parts now looked at
        strict = True
        while True:
            rank = ranks.get((left, right), never)
            if rank < due or rank == due < never and not strict:
                return False
            if made_left is None and made_right is None:
                return True
            # take apart the side that merged later
            if made_right is None or made_left is not None and made_left[0] > made_right[0]:
                due, left, strict = made_left[0], made_left[2], True
                made_left = made.get(left)
            else:
                due, right, strict = made_right[0], made_right[1], False
                made_right = made.get(right)

    def counts_by_byte(self, piece: bytes) -> list[int]:
        """Tokens of piece[:i] for every i, none left out.

        ``ends`` remembers (count, last token) of prefixes, which pieces have in common.
        """
        out, ends = [0], self.ends
        if len(ends) >= REMEMBERED:
            ends.clear()
        for end in range(1, len(piece) + 1):
            prefix = piece[:end]
            found = ends.get(prefix)
            if found is None:
                found = ends[prefix] = self.extend(prefix)
            out.append(found[0])
        return out

    def extend(self, prefix: bytes) -> tuple[int, bytes]:
        """(count, last token) of a prefix from those of the shorter ones."""
        tokens, whole, ends = self.tokens, self.whole, self.ends
        if prefix in tokens:
            return 1, prefix
        for begin in range(1, len(prefix)):
            token = prefix[begin:]
            if token in tokens:
                before = ends.get(prefix[:begin]) or self.extend(prefix[:begin])
                fits = whole.get((before[1], token))
                if fits or fits is None and self.stays(before[1], token):
                    return before[0] + 1, token
        raise ValueError("the vocabulary lacks a byte")

    def counts_of_long(self, piece: bytes) -> list[int]:
        """The same without a memory of prefixes, for pieces of any length."""
        count, last = [0], [b""]
        for end in range(1, len(piece) + 1):
            for begin in range(max(0, end - self.longest), end):
                token = piece[begin:end]
                if token in self.tokens and self.stays(last[begin], token):
                    last.append(token)
                    count.append(count[begin] + 1)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
        return count

    def steps(self, piece: str) -> bytes:
        """Changes of the count from one code point of a piece to the next, as 16-bit numbers."""
        data = piece.encode()
        counts = (self.counts_by_byte if len(data) <= LONG else self.counts_of_long)(data)
        if not piece.isascii():
            ends = [i for i, b in enumerate(data) if b & 0xC0 != 0x80] + [len(data)]
            counts = [counts[i] for i in ends]
        if piece in ("'re", "'ve", "'ll"):  # "'r" is two pieces
            counts[2] = counts[1] + 1
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.known[piece] = array("h", map(sub, counts[1:], counts)).tobytes()
        return found

    def stretch(self, text: str) -> bytes:
        """Changes of the count through a stretch, its pieces laid end to end."""
        known, steps = self.known, self.steps
        return b"".join([known.get(p) or steps(p) for p in self.pieces.findall(text)])

    def words(self, text: str) -> bytes:
        """The same for text in which white space stands singly: every space begins a piece."""
        first, *rest = text.split(" ")
        known = self.spaced
        if len(known) >= REMEMBERED:
            known.clear()
        out = [self.stretch(first)]
        for word in rest:
            found = known.get(word)
            if found is None:
                found = known[word] = self.stretch(" " + word)
            out.append(found)
        return b"".join(out)

    def plain(self, text: str) -> np.ndarray:
        """Counts at the prefixes of 1, 2, ... code points of a text without special strings."""
        out, begin, ends = [], 0, []
        for run in self.runs.finditer(text):
            a, b = run.span()
            # The last character of a run stands apart or leads the next piece.
            cut = b if b == len(text) else b - 1
            if a > begin:
                out.append(self.words(text[begin:a]))
            out.append(self.known.get(text[a:cut]) or self.steps(text[a:cut]))
            if b < len(text):
                ends.append((a, b, text[a:b]))
            begin = cut
        if begin < len(text):
            out.append(self.words(text[begin:]))
        counts = np.cumsum(np.frombuffer(b"".join(out), "=i2"), dtype=np.int32)
        for a, b, run in ends:  # a prefix that ends with the run has it as one piece
            change = self.known.get(run) or self.steps(run)
            counts[b - 1] = (counts[a - 1] if a else 0) + int(np.frombuffer(change, "=i2").sum())
        return counts

    def counts(self, text: str) -> np.ndarray:
        """Token counts of text[:1], text[:2], ..., the whole text.

        A special string is one token once it is complete, and ordinary text before.
        """
        if not self.special or not (marks := list(self.special.finditer(text))):
            return self.plain(text)
        out, total, begin = [], 0, 0
        for mark in [*marks, None]:
            stretch = text[begin:mark.start()] if mark else text[begin:]
            if mark:
                own = self.plain(stretch + mark.group()[:-1]) + total
                alone = self.plain(stretch)
                total += (int(alone[-1]) if len(alone) else 0) + 1
                out += [own, np.array([total], np.int32)]
                begin = mark.end()
            else:
                out.append(self.plain(stretch) + total)
        return np.concatenate(out)


def prefix_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes long, counts array<int>)``; ``counts[i]`` is for i + 1 code points.

    ``tokenizer`` is the place of a byte-level BPE file that every executor can read. No begin,
    end or added special tokens; special strings inside texts are one token each. Null and
    empty texts have no bytes and an empty array. Rows come back one for one, whatever their
    ids; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(tokenizer)
        for batch in batches:
            begin, held, sizes, total = 0, [], [], 0
            for i, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                held.append(counter.counts(text))
                sizes.append(len(text.encode()))
                total += len(text)
                if total >= BATCH_COUNTS or i + 1 == batch.num_rows:
                    ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
                    counts = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(held)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(begin, i + 1 - begin), pa.array(sizes, pa.int64()),
                         counts], ["id", "n_bytes", "counts"])
                    begin, held, sizes, total = i + 1, [], [], 0

    return (source.mapInArrow(run, f"id {kind}, n_bytes long, counts array<int>")
            .withColumnRenamed("id", id_col))


def n_tokens(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.coalesce(F.element_at(counts, F.when(F.size(counts) > 0, F.lit(-1))), F.lit(0))


def tokens_before(counts: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` code points."""
    return F.when(chars <= 0, 0).otherwise(F.get(counts, F.least(chars, F.size(counts)) - 1))


def chars_within(counts: Column, budget: int) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    good = F.filter(F.sequence(F.lit(0), F.size(counts)),
                    lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(counts, i - 1)) <= budget)
    return F.element_at(good, -1)
