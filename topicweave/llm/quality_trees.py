"""A quality score for every text from gradient-boosted trees over text statistics.

Statistics are column expressions over whole texts. Labelled rows that aren't held out train the trees on the driver, at most
``sample`` of them; the forest, a few arrays, goes to the tasks and scores Arrow batches.

Defined cases: an empty or null text has zero statistics and gets a score like any other; a document with several labels
counts by the lowest; without labels of both classes every score is the base rate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.common import bounded_sample
from topicweave.llm.histogram_trees import Forest, Training, fit
from topicweave.llm.text_stats import SHARES, one_row_each, with_statistics
from topicweave.session import materialize

FEATURES = ("n_words", "n_dup_lines", *SHARES)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds == 0, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, sample: int = 30_000, how: Training = Training()) -> Forest:
    """Trees from ``labels (doc_id, quality)`` joined to the statistics, held-out rows left out."""
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("y"))
    rows = one_row_each(stats.join(known.where(~held_out(F.col("doc_id"))), "doc_id"))
    table = bounded_sample(rows, "doc_id", sample).select("doc_id", "y", *FEATURES).toPandas().sort_values("doc_id")
    return fit(table[list(FEATURES)].to_numpy(float), table["y"].to_numpy(float), how)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = 30_000, how: Training = Training()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    stats = materialize(with_statistics(docs, repeats=False), "statistics")
    forest = train(stats, labels, sample, how)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[list(FEATURES)].to_numpy(np.float64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": forest.score(x)})

    return stats.mapInPandas(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
