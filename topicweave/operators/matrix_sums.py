"""Sums of matrices over a table: every task adds up its Arrow batches and sends one row, the cells are merged by a shuffle.

Plans stay the same size whatever the number of topics and classes, and the corpus is read once for all sums of a step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summed(rows: DataFrame, cells_of: Callable[[pa.RecordBatch], np.ndarray], cells: int) -> DataFrame:
    """``cell, value``: the sums over all batches of what ``cells_of`` makes of one, an array of ``cells`` numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            total += cells_of(batch)
        yield pa.RecordBatch.from_pydict({"cells": pa.array([total], pa.list_(pa.float64()))})

    partial = rows.mapInArrow(run, "cells array<double>").select(F.posexplode("cells").alias("cell", "value"))
    return partial.groupBy("cell").agg(F.sum("value").alias("value"))


def collected(sums: DataFrame, cells: int) -> np.ndarray:
    """The cells on the driver: as many numbers as the matrices have."""
    out = np.zeros(cells)
    for row in sums.collect():
        out[row["cell"]] = row["value"]
    return out


def summed_by(rows: DataFrame, keys: tuple[str, ...], cells_of: Callable[[pa.Table], np.ndarray], cells: int, name: str = "cells") -> DataFrame:
    """``keys`` and the array ``name``: the same sums for each group. A task holds one array for each group that it meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, np.ndarray] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            groups = table.select(list(keys)).append_column("_row", pa.array(np.arange(len(table)))).group_by(list(keys)).aggregate([("_row", "list")])
            for *key, members in zip(*(groups[k].to_pylist() for k in keys), groups["_row_list"].to_pylist()):
                total = totals.setdefault(tuple(key), np.zeros(cells))
                total += cells_of(table.take(pa.array(members)))
        columns = [pa.array([key[i] for key in totals], batch_types[i]) for i in range(len(keys))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(totals.values()), pa.list_(pa.float64()))], names=[*keys, "cells"])

    from pyspark.sql.pandas.types import to_arrow_type

    batch_types = [to_arrow_type(rows.schema[k].dataType) for k in keys]
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    partial = rows.mapInArrow(run, f"{kinds}, cells array<double>").select(*keys, F.posexplode("cells").alias("cell", "value"))
    merged = partial.groupBy(*keys, "cell").agg(F.sum("value").alias("value"))
    in_order = F.sort_array(F.collect_list(F.struct("cell", "value")))
    return merged.groupBy(*keys).agg(F.transform(in_order, lambda x: x["value"]).alias(name))


def vectors_of(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of arrays of ``width`` numbers as a matrix."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in chunks]
    return (np.concatenate(flat) if flat else np.zeros(0)).reshape(-1, width)


# -- supervised topic likelihood ---------------------------------------------------------------------------------------

def packed_blocks(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """``y, n, p`` of every labelled document: copies and probabilities of its blocks, the latter one block after the other."""
    own = blocks.join(labels.select("doc_id", F.col("y").cast("int").alias("y")), "doc_id")
    per_doc = own.groupBy("doc_id", "y").agg(F.collect_list(F.struct("n", "p")).alias("x"))
    return per_doc.select("y", F.transform("x", lambda b: b["n"].cast("double")).alias("n"), F.flatten(F.transform("x", lambda b: b["p"])).alias("p"))


#: Reads class, copies and block probabilities of each document off a batch.
Documents = Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def packed_documents(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The documents of rows :func:`packed_blocks`."""
    ends = np.cumsum(pc.list_value_length(batch.column("n")).to_numpy())
    all_n = batch.column("n").flatten().to_numpy()
    all_p = vectors_of(batch.column("p"), len(batch.column("p").flatten()) // max(1, len(all_n)) or 1)
    for y, start, end in zip(batch.column("y").to_pylist(), np.concatenate([[0], ends[:-1]]), ends):
        yield y, all_n[start:end], all_p[start:end]


def likelihood_cells(
    etas: np.ndarray, slopes: bool = True, documents: Documents = packed_documents,
) -> Callable[[pa.RecordBatch], np.ndarray]:
    """For each of several coefficient matrices ``etas[s]`` (topic, class): the sum of log-likelihoods and, if asked, its gradient; the
    number of documents comes last."""
    tries, k, classes = etas.shape

    def of(batch: pa.RecordBatch) -> np.ndarray:
        loglik, gradient, found = np.zeros(tries), np.zeros((tries, k, classes)), 0
        for y, n, p in documents(batch):
            found, length = found + 1, n.sum()
            g = n @ p / length
            raised = np.exp(etas / length)
            inside = p @ raised  # tries x blocks x classes
            logs = np.einsum("m,smc->sc", n, np.log(inside))
            norm = np.logaddexp.reduce(logs, axis=1)
            loglik += g @ etas[:, :, y].T - norm
            if slopes:
                gradient[:, :, y] += g
                pulled = np.swapaxes(p * n[:, None], 0, 1) @ (1.0 / inside)  # tries x topics x classes
                gradient -= np.exp(logs - norm[:, None])[:, None, :] * raised * pulled / length
        return np.concatenate([loglik, gradient.ravel(), [found]])

    return of


def likelihood(
    packed: DataFrame, etas: np.ndarray, slopes: bool = True, documents: Documents = packed_documents,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Log-likelihoods and gradients at several coefficient matrices, and the number of documents, by one scan."""
    tries, k, classes = etas.shape
    cells = tries + tries * k * classes + 1
    got = collected(summed(packed, likelihood_cells(etas, slopes, documents), cells), cells)
    return got[:tries], got[tries:-1].reshape(tries, k, classes), int(got[-1])


def ascend(
    packed: DataFrame, k: int, classes: int, steps: int = 20, rate: float = 1.0, tries: int = 4, start: np.ndarray | None = None,
    documents: Documents = packed_documents,
) -> tuple[np.ndarray, list[float]]:
    """Gradient ascent on the likelihood per document. Returns the coefficients and the likelihoods on the way.

    A step tries ``tries`` lengths, each half the one before, and takes the first that doesn't lower the likelihood; shorter ones are
    tried if none does. The first length mostly does, so a scan looks at it alone, and another one at the rest if it doesn't. Each scan
    brings the gradients too.
    """
    eta = np.zeros((k, classes)) if start is None else np.array(start, float)
    values, gradients, docs = likelihood(packed, eta[None], documents=documents)
    history, gradient = [float(values[0])], gradients[0]
    for _ in range(steps):
        good: np.ndarray = np.zeros(0, int)
        while not len(good) and rate > 1e-9:
            for lengths in filter(len, (range(1), range(1, tries))):
                etas = np.stack([eta + rate / 2**t * gradient / docs for t in lengths])
                values, gradients, _ = likelihood(packed, etas, documents=documents)
                good = np.flatnonzero(values >= history[-1])
                if len(good):
                    break
            rate = rate / 2 ** (lengths[good[0]] if len(good) else tries)
        if not len(good):
            break
        eta, gradient = etas[good[0]], gradients[good[0]]
        history.append(float(values[good[0]]))
    return eta, history


def pairs_of(matrix_sums: DataFrame, k: int, classes: int, name: str = "gradient") -> DataFrame:
    """``topic, class`` and the value of cells that are numbered row by row."""
    at = F.col("cell")
    return matrix_sums.where(at < k * classes).select(
        F.floor(at / classes).cast("int").alias("topic"), (at % classes).cast("int").alias("class"), F.col("value").alias(name))
