"""Byte-level BPE by dynamic programming over prefixes, and decoding.

For every prefix of a byte string exactly one token can be the last one of the prefix's encoding: the token ``t`` that ends
there, whose remaining prefix ends in ``u``, and for which merging by rank would leave the pair ``(u, t)`` apart. The table
of these last tokens is the state. Encoding walks it from the end; appended bytes only add entries; an edit in the middle
keeps the entries before it and redoes those behind it.

A pair stays apart if no merge across its border comes before the merges that build both sides: the border is followed down
the right edge of the left token and the left edge of the right token, in falling order of rank. A token that merging never
makes (only whole pieces can be such tokens) takes no part in the table.

Texts are cut into pieces by the vocabulary's pattern first; a piece that is itself a token is that token.
Defined cases: a null text counts as empty, an empty text has no ids; ids of unknown tokens can't be decoded (KeyError).
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame

from topicweave.llm.common import whole
from topicweave.llm.pieces import Remembered, parts


#: Bytes at the beginning of a piece whose tables are remembered.
START = 8


class PrefixEncoder:
    """Encodes single byte strings with the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pairs: int = 150_000, starts: int = 100_000):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}  # the last merge that makes a token
        self.joined: dict[tuple[int, int], int] = {}
        self.usable: dict[bytes, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.usable[token] = rank
                continue
            # all shorter tokens that merging makes, with a lower rank, are known by now
            halves = self._halves(token, rank)
            if halves:
                self.halves[rank], self.joined[halves], self.usable[token] = halves, rank, rank
        self.known_pair = Remembered(self._apart, pairs).__getitem__
        self.ends = self._lengths()
        self.known_start = Remembered(lambda start: self.extend(start, []), starts).__getitem__

    def _lengths(self) -> Remembered:
        """Lengths of the tokens that end in three given bytes, longest first."""
        lengths: dict[bytes, set[int]] = {}
        for token in self.usable:
            if len(token) > 2:
                lengths.setdefault(token[-3:], set()).add(len(token))
        return Remembered(
            lambda tail: (*sorted(lengths.get(tail, ()), reverse=True), *self._short(tail)), 100_000)

    def _short(self, tail: bytes) -> tuple[int, ...]:
        return tuple(n for n in (2, 1) if n <= len(tail) and tail[-n:] in self.usable)

    def _halves(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose encodings are single tokens below ``rank`` and which stay side by side until ``rank``."""
        for cut in range(1, len(token)):
            left, right = self.usable.get(token[:cut]), self.usable.get(token[cut:])
            if left is not None and right is not None and left < rank > right and self._apart((left, right)):
                return left, right
        return None

    def apart(self, left: int, right: int) -> bool:
        return self.known_pair((left, right))

    def _apart(self, pair: tuple[int, int]) -> bool:
        """Whether merging by rank leaves ``left`` and ``right`` as they are when they stand side by side."""
        left, right = pair
        before = 1 << 62
        while True:
            made = self.joined.get((left, right))
            if made is not None and made < before:
                return False
            # undo the later of the merges on either side of the border; of equal ranks the right one was done later
            if left > right:
                halves, before = self.halves.get(left), left
                if halves is None:
                    halves, before = self.halves.get(right), right + 1
                    if halves is None:
                        return True
                    right = halves[0]
                else:
                    left = halves[1]
            else:
                halves, before = self.halves.get(right), right + 1
                if halves is None:
                    halves, before = self.halves.get(left), left
                    if halves is None:
                        return True
                    left = halves[1]
                else:
                    right = halves[0]

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """``last[i]``: the last token of the encoding of ``data[:i + 1]``; adds what is missing to the list."""
        find, ends, apart = self.usable.get, self.ends, self.known_pair
        for end in range(len(last) + 1, len(data) + 1):
            tail = data[max(0, end - 3):end]
            for n in ends[tail]:
                token = find(data[end - n:end]) if n <= end else None
                if token is not None and (n == end or apart((last[end - n - 1], token))):
                    last.append(token)
                    break
        return last

    def walk(self, last: list[int]) -> list[int]:
        """The encoding that a table of last tokens holds."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.bytes_of[last[at - 1]])
        return out[::-1]

    def encode(self, data: bytes) -> list[int]:
        whole_token = self.ranks.get(data)
        if whole_token is not None:
            return [whole_token]
        # words share their beginnings, and so the tables of these
        return self.walk(self.extend(data, list(self.known_start(data[:START]))))


class Piece:
    """A byte string under change, with its table of last tokens."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data = encoder, data
        self.last = encoder.extend(data, [])

    def append(self, more: bytes) -> None:
        self.data += more
        self.encoder.extend(self.data, self.last)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Entries before the edit stay; the others are computed again."""
        self.data = self.data[:start] + new + self.data[end:]
        del self.last[start:]
        self.encoder.extend(self.data, self.last)

    def ids(self) -> list[int]:
        direct = self.encoder.ranks.get(self.data)
        return [direct] if direct is not None else self.encoder.walk(self.last)


class Vocabulary:
    """Ranks and a splitting pattern: text to ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = 300_000):
        self.pieces, self.encoder = regex.compile(pattern), PrefixEncoder(ranks)
        self.known_piece = Remembered(self._piece, cached).__getitem__
        self.known_part = Remembered(lambda part: self._ids(" " + part), cached).__getitem__

    def _piece(self, piece: str) -> bytes:
        return array("I", self.encoder.encode(piece.encode())).tobytes()

    def _ids(self, text: str) -> bytes:
        return b"".join(map(self.known_piece, self.pieces.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit integers of this machine (little-endian on all that Spark runs on)."""
        first, rest = parts(text)
        return self._ids(first) + b"".join(map(self.known_part, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.encoder.bytes_of.__getitem__, memoryview(ids).cast("I")))

    def append(self, text: str, ids: bytes, more: str) -> bytes:
        """Ids of ``text + more`` from those of ``text``: only the last pieces are encoded again.

        A piece depends on at most two characters behind it, or, as white space, on where the run ends.
        """
        start = 0
        for found in self.pieces.finditer(text):
            if found.end() > len(text) - 3:
                break
            start = found.end()
        kept = text[:start].encode()
        size, keep = 0, 0
        for i in memoryview(ids).cast("I"):
            if size == len(kept):
                break
            size, keep = size + len(self.encoder.bytes_of[i]), keep + 1
        return ids[: 4 * keep] + self._ids(text[start:] + more)


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of the file: base64 of the token, rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read once per Python worker."""
    return Vocabulary(read_ranks(path), pattern)


def encode_table(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, with ``ids`` (little-endian, 32 bits) if wanted.

    No row leaves its partition; the cache of a worker is bounded.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = v.encode(text)
                rows.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(v.decode(ids)).hexdigest(), ids))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])[columns]

    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return docs.select("doc_id", whole().alias("text")).mapInPandas(run, kinds)
