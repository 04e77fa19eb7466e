"""Token counts of the sections of a text, from one encoding of the whole text.

A text is encoded once. Each token covers a span of characters; the spans are joined with the sections' intervals, and a
token that crosses a border goes to the section that holds most of its bytes, the earlier one of equals. So the counts of
a text's sections add up to its tokens, which separate encodings of the sections would not.

Sections are the lines of a text, each with its line feed, unless another function gives the starts. Defined cases: a null
or empty text has one empty section without tokens; offsets count characters (code points); a character that is spread
over several tokens belongs to each of their spans, borders are compared by bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicweave.llm.bpe import read_ranks
from topicweave.llm.common import whole


def line_starts(text: bytes) -> np.ndarray:
    """Byte offsets at which lines begin."""
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.concatenate([[0], breaks[breaks < len(text)]])


class Encoder:
    """Ids and token lengths by a rank file."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = read_ranks(path)
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Byte offsets at which the tokens end."""
        return np.cumsum(self.lengths[self.encoding.encode_ordinary(text)])


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def attribute(ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's section by the rule above, and whether it crosses a border. All offsets are bytes."""
    begins = np.concatenate([[0], ends])[:-1].astype(np.int64)
    first = np.searchsorted(starts, begins, "right") - 1
    last = np.searchsorted(starts, ends - 1, "right") - 1
    owner, crossing = first.copy(), first != last
    for k in np.flatnonzero(crossing):
        edges = np.concatenate([[begins[k]], starts[first[k] + 1: last[k] + 1], [ends[k]]])
        owner[k] = first[k] + int(np.argmax(np.diff(edges)))
    return owner, crossing


def section_counts(docs: DataFrame, path: str, pattern: str, starts_of: Callable[[bytes], np.ndarray] = line_starts) -> DataFrame:
    """One row per document and section: ``doc_id, section, start, end, n_tokens, n_crossing``; start and end in characters.

    ``n_crossing`` counts the section's tokens that also cover a part of another one.
    """
    columns = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path, pattern)
        for batch in batches:
            for doc_ids, starts, ends, counts, crossings in _by_document(batch, e, starts_of, rows=2_000):
                sizes = [len(x) for x in starts]
                yield pd.DataFrame({
                    "doc_id": pd.Series(np.repeat(np.array(doc_ids, object), sizes), dtype="Int64"),
                    "section": np.concatenate([np.arange(n) for n in sizes]),
                    "start": np.concatenate(starts), "end": np.concatenate(ends),
                    "n_tokens": np.concatenate(counts), "n_crossing": np.concatenate(crossings),
                })[columns]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    return rows.mapInPandas(run, "doc_id long, section long, start long, end long, n_tokens long, n_crossing long")


def _by_document(batch: pd.DataFrame, e: Encoder, starts_of, rows: int):
    """Columns of up to ``rows`` documents at a time."""
    for at in range(0, len(batch), rows):
        out: tuple[list, ...] = ([], [], [], [], [])
        for doc_id, text in zip(batch["doc_id"][at:at + rows], batch["text"][at:at + rows]):
            data = text.encode()
            starts = starts_of(data)
            owner, crossing = attribute(e.ends(text), starts)
            characters = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
            edges = characters[np.append(starts, len(data))]
            for column, value in zip(out, (
                None if pd.isna(doc_id) else int(doc_id), edges[:-1], edges[1:],
                np.bincount(owner, minlength=len(starts)), np.bincount(owner[crossing], minlength=len(starts)),
            )):
                column.append(value)
        yield out


def document_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: tokens, sections, tokens across borders, the first and the largest section's tokens, and a
    checksum of the counts in order. Sections of a document are made in its own task, so nothing is shuffled."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path, pattern)
        for batch in batches:
            for doc_ids, _, _, counts, crossings in _by_document(batch, e, line_starts, rows=2_000):
                yield pd.DataFrame({
                    "doc_id": pd.Series(doc_ids, dtype="Int64"), "n_tokens": [int(c.sum()) for c in counts],
                    "n_sections": [len(c) for c in counts], "n_crossing": [int(c.sum()) for c in crossings],
                    "first_tokens": [int(c[0]) for c in counts], "largest_tokens": [int(c.max()) for c in counts],
                    "counts_crc32": [zlib.crc32(c.astype("<i8").tobytes()) for c in counts],
                })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    return rows.mapInPandas(
        run, "doc_id long, n_tokens long, n_sections long, n_crossing long, first_tokens long, largest_tokens long, counts_crc32 long"
    )
