"""Fill-in-the-middle: a text is cut into prefix, middle and suffix, and the middle moves to the end.

Units are runs of ASCII letters, and every other code point by itself. Each Arrow batch is one pipeline of array functions: the
texts become lists of units, the lists are flattened beside the number of their text, every unit gets its ordinal in the text, the
ordinal gives its role, the units of a role are filtered and put into lists again, and the lists are joined to pieces. Cuts and forms
are hashes of the document's id, so reruns agree.

A row never leaves its partition. A batch is worked through in slices of ``slice_bytes`` of text, so memory is bounded by that or by
the longest text.

Defined cases: a null text counts as empty; an empty text and a text that holds a marker stay plain; a null id is hashed as the empty
string; rows with equal ids get equal cuts of their own texts; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.common import slices, whole

#: What stands before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: A unit in UTF-8: letters, one other ASCII character, or the bytes of one other code point.
UNIT = rb"([A-Za-z]+|[\x00-\x40\x5B-\x60\x7B-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
#: A byte that UTF-8 never holds.
END = b"\xff"
COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def hashes(seed: int, count: int = 4) -> list[Column]:
    """The first 8-digit groups of the hex SHA-256 of ``seed:id``, as whole numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def units(texts: pa.Array) -> pa.ListArray:
    """The units of every text, as lists of bytes."""
    ended = pc.replace_substring_regex(texts.cast(pa.large_binary()), pattern=UNIT, replacement=rb"\1" + END)
    lists = pc.split_pattern(ended, pattern=END)  # the last part of each list is what follows the last unit: nothing
    offsets = lists.offsets.to_numpy()
    last = np.zeros(len(lists.values), bool)
    last[offsets[1:] - 1] = True
    return rebuilt(lists.values.filter(pa.array(~last)), np.diff(offsets) - 1)


def rebuilt(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), values)


def cut(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """``n, [prefix, middle, suffix]`` of every text; the cuts are the two hashes modulo one more than the number of units."""
    lists = units(texts)
    n = pc.list_value_length(lists).to_numpy()
    a, b = np.minimum(first % (n + 1), second % (n + 1)), np.maximum(first % (n + 1), second % (n + 1))
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    ordinal = np.arange(len(flat)) - lists.offsets.to_numpy()[:-1][parent]
    role = (ordinal >= a[parent]).astype(np.int8) + (ordinal >= b[parent])
    pieces = []
    for number, lengths in enumerate((a, b - a, n - b)):
        mine = rebuilt(flat.filter(pa.array(role == number)), lengths)
        pieces.append(pc.binary_join(mine, pa.scalar(b"", pa.large_binary())).cast(pa.large_string()))
    return n, pieces


def arranged(batch: pa.RecordBatch, markers: tuple[str, str, str], plain: int, spm: int) -> pa.RecordBatch:
    """The rows of ``COLUMNS`` for rows ``doc_id, text, h1, h2, h3, h4``."""
    text = batch.column("text").cast(pa.large_string())
    h = [batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)]
    n, (prefix, middle, suffix) = cut(text, h[0], h[1])
    marked = np.zeros(len(text), bool)
    for mark in markers:
        marked |= pc.match_substring(text, mark).to_numpy(zero_copy_only=False)
    stays = pa.array((n == 0) | marked | (h[2] % 100 >= 100 - plain))
    swapped = pa.array(h[3] % 100 < spm)
    p, s, m = (pa.scalar(x, pa.large_string()) for x in markers)
    none = pa.scalar("", pa.large_string())
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm_ = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    form = pc.if_else(stays, "plain", pc.if_else(swapped, "spm", "psm"))
    chars = [pc.if_else(stays, pa.scalar(None, pa.int64()), pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    output = pc.if_else(stays, text, pc.if_else(swapped, spm_, psm))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(n.astype(np.int64)), form, *chars, output.cast(pa.string())],
        names=[c.split()[0] for c in COLUMNS.split(", ")])


def _check(markers: tuple[str, str, str]) -> None:
    """Markers must be found again without doubt: none may lie in another or begin with the end of one."""
    for a in markers:
        for b in markers:
            if not a or (a != b and a in b) or any(a.startswith(b[-i:]) for i in range(1, len(b))):
                raise ValueError(f"markers {a!r} and {b!r} could be taken for each other")


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain: int = 10, spm: int = 20, markers: tuple[str, str, str] = MARKERS, slice_bytes: int = 4 << 20,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of ``docs (doc_id, text)``.

    ``plain`` percent of the documents stay as they are; of the others ``spm`` percent begin with the suffix. The two counts are
    null for plain texts.
    """
    _check(markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, slice_bytes):
                yield arranged(part, markers, plain, spm)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"),
                        *[h.alias(f"h{i}") for i, h in enumerate(hashes(seed), 1)])
    return keyed.mapInArrow(run, COLUMNS)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output was made from. A text with a marker stayed plain, so each marker stands once and nowhere else."""
    pattern = "|".join(rf"\Q{m}\E" for m in markers)
    parts = F.split(output, pattern, -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
    )
