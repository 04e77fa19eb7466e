"""Supervised heads on topic features.

``eta[i][j]`` weighs topic i for class j. Losses and gradients are sums over documents, so each is one aggregation;
the squared-error head needs only the class statistics of :func:`class_statistics`. Sums of matrices are those of
:mod:`topicweave.operators.matrix_sums`, so no plan grows with the number of topics.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicweave.functions import draws, vectors
from topicweave.operators import matrix_sums
from topicweave.session import materialize

Matrix = list[list[float]]


def mean_probabilities(blocks: DataFrame, k: int, weights: str = "count") -> DataFrame:
    """Mean block probability per document, weighted by the copies (``count``) or not (``binary``)."""
    n = F.col("n") if weights == "count" else F.lit(1)
    sums = [F.sum(n * F.col("p")[i]).alias(f"_p{i}") for i in range(k)]
    return blocks.groupBy("doc_id").agg(*sums, F.sum(n).alias("_n")).select(
        "doc_id", F.array(*[F.col(f"_p{i}") / F.col("_n") for i in range(k)]).alias("g")
    )


# -- splits ------------------------------------------------------------------------------------------------------------

def split_rows(features: DataFrame, test_share: float = 0.2, seed: str = "split") -> DataFrame:
    return features.withColumn("is_test", draws.hash_share(F.col("doc_id"), test_share, seed))


def fold_rows(features: DataFrame, folds: int = 5, seed: str = "fold") -> DataFrame:
    return features.withColumn("fold", F.pmod(draws.hash_uint32(F.col("doc_id"), seed), F.lit(folds)).cast("int"))


# -- squared error -----------------------------------------------------------------------------------------------------

def class_statistics(features: DataFrame, k: int, *keys: str) -> DataFrame:
    """Per group: row count ``n``, sum ``s`` of the vectors and sum ``gram`` of their outer products (row by row)."""
    def cells_of(rows: pa.Table) -> np.ndarray:
        g = matrix_sums.vectors_of(rows["g"], k)
        return np.concatenate([[len(g)], g.sum(axis=0), (g.T @ g).ravel()])

    sums = matrix_sums.summed_by(features.select(*keys, "g"), keys, cells_of, 1 + k + k * k)
    return sums.select(
        *keys, F.col("cells")[0].cast("long").alias("n"), F.slice("cells", 2, k).alias("s"), F.slice("cells", k + 2, k * k).alias("gram"))


def l2_loss(features: DataFrame, eta: Matrix, k: int) -> DataFrame:
    scores = vectors.times_matrix(F.col("g"), eta)
    miss = vectors.total([
        F.pow(scores[j] - F.when(F.col("y") == j, F.lit(1.0)).otherwise(F.lit(0.0)), F.lit(2.0)) for j in range(k)
    ])
    return features.agg((F.sum(miss) / 2).alias("loss"))


def l2_gradient(statistics: DataFrame, eta: Matrix, k: int, mode: str = "exact") -> DataFrame:
    """``(topic, class, gradient)`` from the class statistics.

    ``exact`` is the derivative of the loss. ``reference`` is the published variant, which scales the own feature
    instead of the residual.
    """
    weights = np.array(eta, float)

    def cells_of(batch: pa.RecordBatch) -> np.ndarray:
        out = np.zeros((k, k))
        sums = matrix_sums.vectors_of(batch.column("s"), k)
        for y, s, gram in zip(batch.column("y").to_pylist(), sums, matrix_sums.vectors_of(batch.column("gram"), k * k).reshape(-1, k, k)):
            if mode == "exact":
                out += gram @ weights
                out[:, y] -= s
            else:
                away = np.diag(gram) * weights
                away[:, y] = gram[y] @ weights[:, y] - s[y]
                out += away
        return out.ravel()

    return matrix_sums.pairs_of(matrix_sums.summed(statistics.select("y", "s", "gram"), cells_of, k * k), k, k)


def _stack(pdf: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Gram matrix, feature-label sums and row count of a few statistics rows."""
    gram, cross, rows = np.zeros((k, k)), np.zeros((k, k)), 0.0
    for y, n, s, g in zip(pdf["y"], pdf["n"], pdf["s"], pdf["gram"]):
        gram += np.asarray(g, dtype=float).reshape(k, k)
        cross[:, int(y)] += np.asarray(s, dtype=float)
        rows += float(n)
    return gram, cross, rows


def _loss(gram: np.ndarray, cross: np.ndarray, rows: float, eta: np.ndarray) -> float:
    return float(0.5 * (np.sum(eta * (gram @ eta)) - 2.0 * np.sum(eta * cross) + rows))


def solve_l2(statistics: DataFrame, k: int, key: str) -> DataFrame:
    """Least-squares ``eta`` (row by row) and loss per group of statistics rows; a group has one row per class."""
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        gram, cross, rows = _stack(pdf, k)
        eta = np.linalg.lstsq(gram, cross, rcond=None)[0]
        return pd.DataFrame({key: [pdf[key].iloc[0]], "eta": [eta.ravel()], "loss": [_loss(gram, cross, rows, eta)]})

    kind = statistics.schema[key].dataType.simpleString()
    return statistics.groupBy(key).applyInPandas(solve, f"{key} {kind}, eta array<double>, loss double")


def start_values(spark, restarts: int, k: int, seed: str = "80") -> DataFrame:
    """``(run, start)``: uniform starting matrices between -1 and 1, one row per restart."""
    cells = F.transform(
        F.sequence(F.lit(0), F.lit(k * k - 1)),
        lambda i: draws.uniform(F.col("run"), i, seed) * 2 - 1,
    )
    return spark.range(restarts).select(F.col("id").cast("int").alias("run"), cells.alias("start"))


def restart_grid(spark, restarts: int, folds: int, k: int, seed: str = "80") -> DataFrame:
    """Every restart once per fold."""
    return start_values(spark, restarts, k, seed).withColumn(
        "fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))
    )


def descend_l2(grid: DataFrame, statistics: DataFrame, k: int, steps: int, rate: float = 1.0) -> DataFrame:
    """Gradient steps from each start of the grid on its fold's training statistics.

    The gradient is divided by the number of rows. Returns the trace ``(run, fold, step, eta, loss)``.
    ``statistics`` has the columns ``fold, y, n, s, gram``; a (run, fold) group has one row per class.
    """
    def descend(pdf: pd.DataFrame) -> pd.DataFrame:
        gram, cross, rows = _stack(pdf, k)
        eta = np.asarray(pdf["start"].iloc[0], dtype=float).reshape(k, k)
        out = []
        for step in range(steps + 1):
            out.append((int(pdf["run"].iloc[0]), int(pdf["fold"].iloc[0]), step, eta.ravel(),
                        _loss(gram, cross, rows, eta)))
            eta = eta - rate * (gram @ eta - cross) / rows
        return pd.DataFrame(out, columns=["run", "fold", "step", "eta", "loss"])

    return grid.join(statistics, "fold").groupBy("run", "fold").applyInPandas(
        descend, "run int, fold int, step int, eta array<double>, loss double"
    )


def training_statistics(by_fold: DataFrame, folds: int) -> DataFrame:
    """Statistics of all rows outside each fold, per class: totals of the other folds' rows."""
    others = by_fold.withColumnRenamed("fold", "_own").withColumn(
        "fold", F.explode(F.array_except(F.sequence(F.lit(0), F.lit(folds - 1)), F.array("_own")))
    )
    return others.groupBy("fold", "y").agg(
        F.sum("n").alias("n"), _sum_vectors("s"), _sum_vectors("gram")
    )


def _sum_vectors(name: str) -> Column:
    """Entry-wise sum of short vectors; the groups here have one row per fold."""
    rows = F.collect_list(name)
    zero = F.transform(F.element_at(rows, 1), lambda x: x * 0.0)
    return F.aggregate(rows, zero, lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b)).alias(name)


def score_models(features: DataFrame, models: DataFrame, k: int, runs: int) -> DataFrame:
    """Accuracy per run on the features' fold: ``(run, fold, hits, docs)``.

    ``models`` holds ``(run, fold, eta)`` with runs 0, 1, ..., ``runs`` - 1: restarts x folds rows, set by parameters and not by
    the data, so they go to the tasks as arrays. Each row is scored by its fold's models at once, and hits are summed run by run.
    """
    etas: dict[int, np.ndarray] = {}
    for row in models.collect():
        etas.setdefault(row["fold"], np.zeros((runs, k, k)))[row["run"]] = np.reshape(row["eta"], (k, k))

    def cells_of(rows: pa.Table) -> np.ndarray:
        hits, fold = np.zeros(runs), etas[rows["fold"][0].as_py()]
        for at in range(0, len(rows), 256):
            part = rows.slice(at, 256)
            scores = np.einsum("ni,rij->nrj", matrix_sums.vectors_of(part["g"], k), fold)
            hits += (scores.argmax(axis=2) == part["y"].to_numpy()[:, None]).sum(axis=0)
        return np.append(hits, len(rows))

    sums = matrix_sums.summed_by(features.select("fold", "y", "g"), ("fold",), cells_of, runs + 1)
    return sums.select(
        "fold", F.col("cells")[runs].cast("long").alias("docs"), F.posexplode(F.slice("cells", 1, runs)).alias("run", "hits")
    ).select("run", "fold", F.col("hits").cast("long").alias("hits"), "docs")


def mean_over_folds(models: DataFrame, k: int) -> DataFrame:
    """Average ``eta`` of each run's folds."""
    return models.groupBy("run").agg(
        F.array(*[F.avg(F.col("eta")[c]) for c in range(k * k)]).alias("eta")
    )


def cross_validate(
    features: DataFrame, k: int, restarts: int = 100, folds: int = 5, steps: int = 200, rate: float = 1.0,
    test_share: float = 0.2, seed: str = "80",
) -> DataFrame:
    """``(run, cv_score, test_accuracy, eta)`` for every restart.

    The corpus is read for the fold statistics and for the two scorings; fitting works on folds x classes rows.
    """
    spark = features.sparkSession
    rows = split_rows(fold_rows(features, folds), test_share)
    train = rows.where(~F.col("is_test"))
    statistics = training_statistics(class_statistics(train, k, "fold", "y"), folds)
    fitted = descend_l2(restart_grid(spark, restarts, folds, k, seed), statistics, k, steps, rate)
    models = materialize(fitted.where(F.col("step") == steps).select("run", "fold", "eta"), "models")
    by_fold = score_models(train, models, k, restarts)
    cv = by_fold.groupBy("run").agg(F.avg(F.col("hits") / F.col("docs")).alias("cv_score"))
    averaged = mean_over_folds(models, k)
    test = rows.where("is_test").withColumn("fold", F.lit(-1))
    on_test = score_models(test, averaged.withColumn("fold", F.lit(-1)), k, restarts).select(
        "run", (F.col("hits") / F.col("docs")).alias("test_accuracy")
    )
    return cv.join(on_test, "run").join(averaged, "run")


def best_run(scores: DataFrame, score: str = "cv_score") -> DataFrame:
    return scores.orderBy(F.desc(score), "run").limit(1)


# -- softmax -----------------------------------------------------------------------------------------------------------

def _with_scores(features: DataFrame, eta: Matrix, k: int) -> DataFrame:
    """Class scores ``_s`` and their log normaliser ``_norm``."""
    scored = vectors.times_matrix(F.col("g"), eta)
    rows = features.withColumn("_s", vectors.stored([scored[j] for j in range(k)]))
    return rows.withColumn("_norm", vectors.log_sum_exp(vectors.items(F.col("_s"), k)))


def softmax_loss(features: DataFrame, eta: Matrix, k: int, ridge: float = 0.5) -> DataFrame:
    """Mean negative log probability of the own class plus the ridge term."""
    own = F.element_at("_s", F.col("y") + 1)
    penalty = ridge * sum(e * e for row in eta for e in row) / 2
    return _with_scores(features, eta, k).agg((F.avg(F.col("_norm") - own) + F.lit(float(penalty))).alias("loss"))


def minibatch(features: DataFrame, size: int, seed) -> DataFrame:
    """``size`` documents without replacement, in the order of a seeded hash."""
    return features.withColumn("_h", draws.hash_uint32(F.col("doc_id"), seed)).orderBy("_h", "doc_id").limit(size).drop("_h")


def minibatches(features: DataFrame, size: int, steps: int, seed) -> DataFrame:
    """``size`` documents for each step, without replacement, in the order of a seeded hash: rows with their ``step``.

    One pass: a task keeps the rows with the ``size`` smallest hashes of each step, a sketch that merges with those of other tasks, so
    only ``steps * size`` rows leave it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table | None] = [None] * steps
        for batch in batches:
            table = pa.Table.from_batches([batch])
            ids = table["doc_id"].to_pylist()
            for step in range(steps):
                drawn = [int.from_bytes(md5(f"{i}|{seed}.{step}".encode()).digest()[:4], "big") for i in ids]
                both = table.append_column("step", pa.array(np.full(len(ids), step, np.int32))).append_column("_h", pa.array(drawn, pa.int64()))
                both = both if kept[step] is None else pa.concat_tables([kept[step], both])
                kept[step] = both.take(pc.select_k_unstable(both, size, [("_h", "ascending"), ("doc_id", "ascending")]))
        for table in kept:
            yield from table.to_batches() if table is not None else ()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in features.schema)
    hashed = features.mapInArrow(run, f"{kinds}, step int, _h long")
    first = Window.partitionBy("step").orderBy("_h", "doc_id")
    return hashed.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= size).drop("_h", "_at")


def softmax_gradient(features: DataFrame, eta: Matrix, k: int, ridge: float = 0.5) -> DataFrame:
    """``(topic, class, gradient)`` of the mean loss with the ridge term."""
    weights = np.array(eta, float)
    classes = weights.shape[1]
    sums = matrix_sums.summed(features.select("y", "g"), softmax_cells(weights), k * classes + 1)
    docs = sums.where(F.col("cell") == k * classes).select("value").scalar()
    ridges = F.element_at(F.lit((ridge * weights).ravel().tolist()), F.col("topic") * classes + F.col("class") + 1)
    pairs = matrix_sums.pairs_of(sums, k, classes, "total")
    return pairs.select("topic", "class", (F.col("total") / docs + ridges).alias("gradient"))


def softmax_cells(eta: np.ndarray):
    """The sum of ``g (P - Y)`` by (topic, class) over rows ``y, g``, and behind it their number."""
    k, classes = eta.shape

    def of(batch: pa.RecordBatch) -> np.ndarray:
        g, y = matrix_sums.vectors_of(batch.column("g"), k), batch.column("y").to_numpy()
        scores = g @ eta
        chance = np.exp(scores - np.logaddexp.reduce(scores, axis=1)[:, None]) if len(g) else scores
        chance[np.arange(len(g)), y] -= 1.0
        return np.concatenate([(g.T @ chance).ravel(), [len(g)]])

    return of


def as_matrix(gradient: DataFrame, k: int, classes: int | None = None) -> Matrix:
    """A number for each topic and class to the driver."""
    out = [[0.0] * (classes or k) for _ in range(k)]
    for row in gradient.collect():
        out[row["topic"]][row["class"]] = float(row["gradient"])
    return out


def fit_softmax_sgd(
    features: DataFrame, k: int, steps: int = 20, batch: int = 10, ridge: float = 0.5, rate: float = 1.0,
    seed: str = "1111",
) -> Matrix:
    """Mini-batch descent; ``rate / (1 + step)`` keeps the steps from oscillating. The batches are drawn once and written."""
    eta = [[1.0 / k] * k for _ in range(k)]
    batches = materialize(minibatches(features, batch, steps, seed), "batches")
    for step in range(steps):
        grad = as_matrix(softmax_gradient(batches.where(F.col("step") == step), eta, k, ridge), k)
        eta = [[e - rate / (1 + step) * g for e, g in zip(er, gr)] for er, gr in zip(eta, grad)]
    return eta


def fit_softmax(features: DataFrame, ridge: float = 0.5, iterations: int = 50):
    """The same head by the library's multinomial regression, without intercept."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rows = features.select(array_to_vector("g").alias("features"), F.col("y").cast("double").alias("label"))
    return LogisticRegression(
        family="multinomial", regParam=ridge, fitIntercept=False, standardization=False, maxIter=iterations
    ).fit(rows)


# -- supervised topic likelihood ---------------------------------------------------------------------------------------

def _documents(blocks, labels: DataFrame) -> tuple[DataFrame, matrix_sums.Documents]:
    """Rows that hold labelled documents whole, and how to read them; ``blocks`` are rows of block probabilities or a chain, whose
    probabilities follow from its present state."""
    if isinstance(blocks, DataFrame):
        return matrix_sums.packed_blocks(blocks, labels), matrix_sums.packed_documents
    return blocks.bound(labels)


def slda_loglik(blocks, labels: DataFrame, eta: Matrix, k: int) -> DataFrame:
    """``loglik, docs``: variational log-likelihood of the labels, by log-sum-exp over the classes; documents without a label don't
    count."""
    rows, documents = _documents(blocks, labels)
    cells = matrix_sums.likelihood_cells(np.array(eta, float)[None], slopes=False, documents=documents)
    last = 1 + k * len(eta[0])
    sums = matrix_sums.summed(rows, cells, last + 1)
    return sums.agg(
        F.max(F.when(F.col("cell") == 0, F.col("value"))).alias("loglik"), F.max(F.when(F.col("cell") == last, F.col("value"))).cast("long").alias("docs"))


def slda_gradient(blocks, labels: DataFrame, eta: Matrix, k: int) -> DataFrame:
    """``(topic, class, gradient)`` of :func:`slda_loglik`."""
    classes = len(eta[0])
    rows, documents = _documents(blocks, labels)
    sums = matrix_sums.summed(rows, matrix_sums.likelihood_cells(np.array(eta, float)[None], documents=documents), 2 + k * classes)
    return matrix_sums.pairs_of(sums.withColumn("cell", F.col("cell") - 1).where("cell >= 0"), k, classes)


def fit_slda(blocks, labels: DataFrame, k: int, classes: int | None = None, steps: int = 20, rate: float = 1.0, start: Matrix | None = None):
    """Gradient ascent on the likelihood per document, see :func:`matrix_sums.ascend`. The packed documents are written once; each step
    reads them once, and only a few K x K matrices reach the driver. Returns ``(eta, [loglik, ...])``."""
    rows, documents = _documents(blocks, labels)
    packed = materialize(rows, "packed-blocks")
    eta, history = matrix_sums.ascend(packed, k, classes or k, steps, rate, start=start, documents=documents)
    return eta.tolist(), history
