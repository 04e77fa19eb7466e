"""Synchronous collapsed Gibbs sweeps over documents that stay where they are.

Every sweep draws all topics from the counts at its start, with the row's own contribution removed. Chains keep documents packed by
bucket (:mod:`topicweave.operators.packed`), so document counts need no shuffle. One sweep is

* a sum over the words of all buckets: one row for each bucket and shard of words, shuffled by shard;
* topic totals, K numbers a chain;
* the sums sent back to the buckets, where all topics of a bucket are drawn at once.

A frequent word is part of each bucket, so buckets grow with the corpus up to a size that suits a task: more of them than tasks need
would only repeat words.

Several chains, with models of their own, advance in the same jobs: the chain is part of every key.

:func:`weigh` gives the same weights row by row as column expressions, for models that need the weights themselves. There hot documents
and hot words are cut into pieces, and the piece numbers travel with the state.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicweave.functions import vectors
from topicweave.operators import heads, packed, skew, topic_counts
from topicweave.operators.packed import Head
from topicweave.session import remove_table, scratch_path, write_table


@dataclass(frozen=True)
class Model:
    """Settings of a sampler. ``grain`` is ``block`` (all copies of a pair at once) or ``token``; a ``head`` weighs the draws."""

    k: int
    alpha: float = 0.1
    beta: float = 0.1
    seed: int = 7
    grain: str = "block"
    head: Head | None = None


def with_pieces(rows: DataFrame) -> DataFrame:
    """Attach piece numbers for hot documents (``ds``) and hot words (``ws``)."""
    by_doc = skew.hot_keys(skew.key_sizes(rows, "doc_id"), "doc_id")
    by_word = skew.hot_keys(skew.key_sizes(rows, "word"), "word")
    return skew.with_pieces(skew.with_pieces(rows, by_doc, "doc_id", "ds"), by_word, "word", "ws")


def initial_state(counts: DataFrame, model: Model) -> DataFrame:
    start = topic_counts.random_blocks if model.grain == "block" else topic_counts.random_tokens
    return with_pieces(start(counts, model.k, model.seed))


def count_tables(state: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    by_doc = topic_counts.counts_by(state, "doc_id", k, F.max("ds").alias("ds"))
    by_word = topic_counts.counts_by(state, "word", k, F.max("ws").alias("ws"))
    return by_doc, by_word


def weigh(state: DataFrame, model: Model, boost=None, doc_extra: DataFrame | None = None) -> DataFrame:
    """State with unnormalised topic weights ``p`` and the document length ``doc_n``.

    ``boost(rows, own)`` may add a column ``f`` of K factors for the weights; it sees the document counts ``d`` and
    ``doc_n``. ``doc_extra`` adds per-document columns for it.
    """
    k = model.k
    state = state if "ds" in state.columns else with_pieces(state)
    by_doc, by_word = count_tables(state, k)
    totals = topic_counts.topic_totals(by_word, k).select(F.struct("nk", "terms")).scalar()
    rows = with_counts(state, by_doc, by_word, k, doc_extra).withColumn("_t", totals)
    own = topic_counts.own_counts(state, k)
    d, w, t = F.col("d"), F.col("w"), F.col("_t")
    weights = [
        (d[i] - own[i] + F.lit(model.alpha)) * (w[i] - own[i] + F.lit(model.beta))
        / (t["nk"][i] - own[i] + F.lit(model.beta) * t["terms"])
        for i in range(k)
    ]
    if boost is not None:
        rows = boost(rows, own)
        weights = [p * F.col("f")[i] for i, p in enumerate(weights)]
    return rows.select(*state.columns, "doc_n", vectors.stored(weights).alias("p"))


def with_counts(state: DataFrame, by_doc: DataFrame, by_word: DataFrame, k: int, doc_extra: DataFrame | None = None) -> DataFrame:
    """State rows with their document's counts ``d``, its length ``doc_n`` and their word's counts ``w``."""
    docs = by_doc.select("doc_id", "ds", F.col("cnt").alias("d"), vectors.total(vectors.items(F.col("cnt"), k)).alias("doc_n"))
    if doc_extra is not None:
        docs = docs.join(doc_extra, "doc_id", "left")  # documents without a row keep their tokens
    docs = skew.repeat_rows(docs, "ds", "_dp")
    terms = skew.repeat_rows(by_word.withColumnRenamed("cnt", "w"), "ws", "_wp")
    return (
        state.withColumn("_dp", skew.piece_of(F.col("ds"), F.col("word")))
        .withColumn("_wp", skew.piece_of(F.col("ws"), F.col("doc_id")))
        .join(docs, ["doc_id", "_dp"])
        .join(terms, ["word", "_wp"])
    )


def block_probabilities(weighted: DataFrame, k: int) -> DataFrame:
    """Normalised topic probabilities ``(doc_id, word, n, doc_n, p)`` of each block."""
    return weighted.select("doc_id", "word", "n", "doc_n", vectors.scaled(F.col("p"), k).alias("p"))


# -- weights that also look at a softmax head --------------------------------------------------------------------------

def ratio_boost(eta: list[list[float]], k: int):
    """Factor for topic i: softmax entry i with the block in its document over the entry without it.

    ``eta[c]`` holds the coefficients of class c. An empty remainder counts as the zero vector.
    """
    def boost(rows: DataFrame, own: list[Column]) -> DataFrame:
        d, doc_n = F.col("d"), F.col("doc_n")
        left_n = doc_n - vectors.total(own)
        with_block = [vectors.total([F.lit(float(eta[c][i])) * d[i] / doc_n for i in range(k)]) for c in range(k)]
        without = [
            F.when(
                left_n > 0, vectors.total([F.lit(float(eta[c][i])) * (d[i] - own[i]) / left_n for i in range(k)])
            ).otherwise(F.lit(0.0))
            for c in range(k)
        ]
        rows = rows.withColumn("_s1", vectors.stored(with_block)).withColumn("_s0", vectors.stored(without))
        first, second = vectors.items(F.col("_s1"), k), vectors.items(F.col("_s0"), k)
        rows = rows.withColumn("_shift", vectors.log_sum_exp(second) - vectors.log_sum_exp(first))
        return rows.withColumn(
            "f", vectors.stored([F.exp(a - b + F.col("_shift")) for a, b in zip(first, second)])
        )

    return boost


def label_boost(eta: list[list[float]], k: int):
    """Factor for topic i: probability of the document's own class ``y`` if the whole block moved to topic i.

    Documents without a class have factor 1. Scores are weighted means of ``eta``, so their exponentials need no rescaling.
    """
    def boost(rows: DataFrame, own: list[Column]) -> DataFrame:
        d, doc_n, classes = F.col("d"), F.col("doc_n"), range(len(eta))
        size = vectors.total(own) / doc_n
        rest = [
            F.exp(vectors.total([F.lit(float(eta[c][i])) * (d[i] - own[i]) / doc_n for i in range(k)])) for c in classes
        ]
        rows = rows.withColumn("_rest", vectors.stored(rest)).withColumn("_size", size)
        factors = []
        for i in range(k):
            moved = [F.col("_rest")[c] * F.exp(F.lit(float(eta[c][i])) * F.col("_size")) for c in classes]
            own_class = F.element_at(F.array(*moved), F.col("y") + 1) / vectors.total(moved)
            factors.append(F.coalesce(own_class, F.lit(1.0)))
        return rows.withColumn("f", vectors.stored(factors))

    return boost


# -- chains ------------------------------------------------------------------------------------------------------------

#: Pairs of document and word that a bucket holds on average: at least while there are fewer buckets than ``BUCKETS_A_TASK`` for each
#: task slot, and at most.
BUCKET_PAIRS, MOST_PAIRS = 65_536, 1 << 20
BUCKETS_A_TASK = 4
#: Pairs for each shard of words, at least while there are fewer shards than task slots, and at most. Buckets share frequent words, so
#: a shard holds fewer words of buckets than pairs.
SHARD_PAIRS, MOST_SHARD_PAIRS = 1 << 17, 1 << 23


def bucket_number(pairs: int, chains: int, slots: int) -> int:
    """Buckets of each chain for ``pairs`` of all ``chains``."""
    def needed(held: int) -> int:
        return -(-pairs // (held * chains))

    return max(1, needed(MOST_PAIRS), min(needed(BUCKET_PAIRS), -(-BUCKETS_A_TASK * slots // chains)))


def shard_number(pairs: int, slots: int) -> int:
    """Shards of words for ``pairs`` of all chains."""
    return max(1, -(-pairs // MOST_SHARD_PAIRS), min(-(-pairs // SHARD_PAIRS), 2 * slots))


def _sweep_of(models: Sequence[Model], totals: dict[int, tuple[np.ndarray, int]], sweep: int):
    def step(docs: pa.Table, words: pa.Table) -> pa.Table:
        return packed.swept(docs, words, models, totals, sweep)

    return step


def _features_of(models: Sequence[Model], totals: dict[int, tuple[np.ndarray, int]]):
    def step(docs: pa.Table, words: pa.Table) -> pa.Table:
        return packed.featured(docs, words, models, totals)

    return step


class Chains:
    """Samplers side by side. Their state is a written table, so that a run can stop, resume and lose executors.

    State and sums of words alternate between two folders each; samples go to ``samples/beta`` and ``samples/gamma`` by ``iter``. A
    chain is known by the place of its model; tables have a column ``chain``.
    """

    def __init__(self, spark: SparkSession, models: Sequence[Model], path: str | None = None):
        self.spark, self.models = spark, list(models)
        self.path = path or scratch_path(spark, "chain")
        self.sweep, self.buckets, self.shards, self._summed = 0, 0, 0, None

    def _slot(self, name: str) -> str:
        return f"{self.path}/{name}-{self.sweep % 2}"

    def _note(self) -> str:
        return repr([(m.k, m.alpha, m.beta, m.seed, m.grain) for m in self.models])

    def _write(self, rows: DataFrame, sweep: int) -> None:
        self.sweep, self._summed = sweep, None
        write_table(rows.withColumn("sweep", F.lit(sweep)).withColumn("models", F.lit(self._note())), self._slot("state"))

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(packed.SCHEMA).parquet(self._slot("state"))

    def _word_rows(self) -> DataFrame:
        return self._rows().where("word is not null").select("chain", "bucket", "shard", "word")

    def documents(self) -> DataFrame:
        """``chain, bucket, doc_id, y, number, n, z, counts`` of the present state."""
        return self._rows().where("doc_id is not null").drop("shard", "word")

    def start(self, counts: DataFrame, labels: DataFrame | None = None, written: bool = False) -> "Chains":
        """Hashed first topics for ``counts (chain, doc_id, word, n)``; without the column ``chain`` all chains share the counts.

        ``labels (doc_id, y)`` gives classes to some or all documents. ``written`` counts are read from where they are, others are
        stored until the buckets hold them.
        """
        if "chain" not in counts.columns:
            counts = counts.withColumn("chain", F.explode(F.sequence(F.lit(0), F.lit(len(self.models) - 1))))
        if not written:
            write_table(counts, f"{self.path}/counts")
            counts = self.spark.read.parquet(f"{self.path}/counts")
        found, slots = counts.count(), self.spark.sparkContext.defaultParallelism
        self.buckets, self.shards = bucket_number(found, len(self.models), slots), shard_number(found, slots)
        models, shards, keys = self.models, self.shards, ["chain", "bucket"]
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(self.buckets)).cast("int").alias("bucket")
        pairs = counts.select(F.col("chain").cast("int").alias("chain"), bucket, "doc_id", "word", F.col("n").cast("int").alias("n"))
        if labels is None:
            # rows are sorted by one number, without comparing them
            cell = (F.col("chain") * self.buckets + F.col("bucket")).alias("cell")
            dealt = pairs.select("*", cell).repartition(self._groups(), "cell").groupBy("cell")
            rows = dealt.applyInArrow(lambda group: packed.started(group, models, shards), packed.SCHEMA)
        else:
            chain = F.explode(F.sequence(F.lit(0), F.lit(len(models) - 1))).alias("chain")
            own = labels.where("doc_id is not null").select(chain, bucket, F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"))
            dealt, own = (side.repartition(self._groups(), *keys).groupBy(*keys) for side in (pairs, own))
            rows = dealt.cogroup(own).applyInArrow(lambda group, classes: packed.started(group, models, shards, classes), packed.SCHEMA)
        self._write(rows, 0)
        if not written:
            remove_table(self.spark, f"{self.path}/counts")
        return self

    def _groups(self) -> int:
        """Partitions of a shuffle by bucket: twice the buckets, so that few hash to the same."""
        return 2 * self.buckets * len(self.models)

    def resume(self, sweep: int) -> "Chains":
        """Continue after ``sweep``, if its folder holds that sweep's state of the same models."""
        self.sweep, self._summed = sweep, None
        found = self.spark.read.parquet(self._slot("state"))
        note = found.select("sweep", "models").first()
        if tuple(note) != (sweep, self._note()):
            raise ValueError(f"{self._slot('state')} holds sweep {note['sweep']} of {note['models']}")
        self.buckets, self.shards = (most + 1 for most in found.agg(F.max("bucket"), F.max("shard")).first())
        return self

    def _sums(self) -> DataFrame:
        """The corpus counts of the words of each bucket and shard. Computed once for a state, and written."""
        if self._summed is None:
            dealt = self._word_rows().repartition(2 * self.shards * len(self.models), "chain", "shard")
            write_table(dealt.groupBy("chain", "shard").applyInArrow(packed.summed, packed.SUMS), self._slot("words"))
            self._summed = self.spark.read.schema(packed.SUMS).parquet(self._slot("words"))
        return self._summed

    def word_sums(self, only_first: bool = False) -> DataFrame:
        """``chain, bucket, word, at, counts, first``: the corpus counts of each word, for each bucket that holds it; ``first`` marks one
        row of each word. ``only_first`` leaves out the others."""
        return self._sums().mapInArrow(packed.sum_rows(only_first), packed.SUM_ROWS)

    def totals(self) -> dict[int, tuple[np.ndarray, int]]:
        """Topic totals and the number of terms by chain; these few numbers reach the driver."""
        k = max(m.k for m in self.models)
        sums = [F.sum(F.get("totals", F.lit(i))).alias(f"_{i}") for i in range(k)]
        rows = self._sums().groupBy("chain").agg(F.sum("terms").alias("terms"), *sums).collect()
        return {r["chain"]: (np.array([r[f"_{i}"] for i in range(self.models[r["chain"]].k)], np.float64), r["terms"]) for r in rows}

    def _by_bucket(self, step, schema: str, docs: DataFrame | None = None, words: DataFrame | None = None) -> DataFrame:
        """``step`` of the documents of each bucket and the corpus counts of its words."""
        keys = ["chain", "bucket"]
        docs = self.documents().drop("counts") if docs is None else docs
        words = self._sums().select(*keys, "shard", "word") if words is None else words
        left, right = (side.repartition(self._groups(), *keys).groupBy(*keys) for side in (docs, words))
        return left.cogroup(right).applyInArrow(step, schema)

    def run(self, sweeps: int, keep_from: int | None = None, keep_every: int = 1) -> "Chains":
        for _ in range(sweeps):
            sweep = self.sweep + 1
            self._write(self._by_bucket(_sweep_of(self.models, self.totals(), sweep), packed.SCHEMA), sweep)
            if keep_from is not None and sweep >= keep_from and (sweep - keep_from) % keep_every == 0:
                self.store_sample()
        return self

    def block_features(self) -> DataFrame:
        """``chain, doc_id, g``: each document's mean block probability, weighted by copies, under the present state."""
        return self._by_bucket(_features_of(self.models, self.totals()), packed.FEATURES)

    def weights(self) -> DataFrame:
        """``chain, doc_id, word, n, doc_n, p``: unnormalised topic weights of all blocks under the present state, those of :func:`weigh`,
        and the documents' lengths. A head of the model weighs them."""
        models, totals = self.models, self.totals()
        return self._by_bucket(lambda docs, words: packed.weighed(docs, words, models, totals), packed.WEIGHTS)

    def bound(self, labels: DataFrame):
        """Rows that hold the documents with a class in ``labels (doc_id, y)``, and a function that reads class, copies and block
        probabilities of each document off a batch of them.

        Rows hold topics and counts, from which probabilities follow; so what looks at them many times stores neither these nor shuffles
        them.
        """
        models, (totals, terms) = self.models[:1], self.totals()[0]
        own = labels.where("y is not null").groupBy("doc_id", F.col("y").cast("int").alias("y")).agg(F.count("*").cast("int").alias("times"))
        docs = self.documents().drop("y", "counts").join(own, "doc_id")
        rows = self._by_bucket(lambda docs, words: packed.bound(docs, words, models), packed.BOUND, docs)
        return rows, packed.bound_documents(self.models[0], totals, terms)

    def state(self) -> DataFrame:
        """The state by pairs ``chain, doc_id, word, n, c`` of the block chains, or tokens ``chain, doc_id, word, rep, z``."""
        models = self.models
        schema = packed.BLOCKS if models[0].grain == "block" else packed.TOKENS
        return self._by_bucket(lambda docs, words: packed.unpacked(docs, words, models), schema, words=self._word_rows())

    def _of_chain(self, values: Sequence[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("chain") + 1)

    def gamma(self) -> DataFrame:
        """P(topic | document) as ``chain, doc_id, g``, straight from the documents' rows."""
        prior, length = self._of_chain([m.alpha for m in self.models]), F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
        whole = length + self._of_chain([m.k * m.alpha for m in self.models])
        return self.documents().withColumn("_whole", whole).select(
            "chain", "doc_id", F.transform("counts", lambda c: (c + prior) / F.col("_whole")).alias("g"))

    def beta(self) -> DataFrame:
        """P(term | topic) as ``chain, word, b``, from the sums that the next sweep uses too."""
        totals = self.totals()
        below = F.create_map(*[x for c, (t, terms) in totals.items() for x in (
            F.lit(c), F.array(*[F.lit(float(v) + self.models[c].beta * terms) for v in t]))])
        prior = self._of_chain([m.beta for m in self.models])
        counts = F.slice("counts", F.lit(1), F.size(below[F.col("chain")]))
        return self.word_sums(only_first=True).select(
            "chain", "word", F.zip_with(counts, below[F.col("chain")], lambda c, t: (c + prior) / t).alias("b"))

    def store_sample(self) -> None:
        for name, df in (("gamma", self.gamma()), ("beta", self.beta())):
            write_table(df, f"{self.path}/samples/{name}/iter={self.sweep}")

    def samples(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/samples/{name}")


class Chain(Chains):
    """One sampler; its tables have no column ``chain``."""

    def __init__(self, spark: SparkSession, model: Model, path: str | None = None):
        super().__init__(spark, [model], path)

    @property
    def model(self) -> Model:
        return self.models[0]

    def state(self) -> DataFrame:
        return super().state().drop("chain")

    def gamma(self) -> DataFrame:
        return super().gamma().drop("chain")

    def beta(self) -> DataFrame:
        return super().beta().drop("chain")

    def weights(self) -> DataFrame:
        return super().weights().drop("chain")

    def features(self) -> DataFrame:
        """``doc_id, y, g`` of the documents that have a class: their shares of topics, from counts that the sweep put out."""
        share = F.transform("counts", lambda c: c / F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b))
        return self.documents().where("y is not null").select("doc_id", "y", share.alias("g"))

    def learn_head(
        self, classes: int, sweeps: int, kind: str = "label", ridge: float = 0.5, rate: float = 1.0, keep_from: int | None = None,
    ) -> "Chain":
        """Sweeps with a head that learns between them: after each sweep but the last, one step down the softmax loss of the documents
        that have a class, on their present topics. Documents without a class are drawn without the head.

        All coefficients begin equal, so the head takes no part in the first sweep. ``models[0].head`` holds them afterwards.
        """
        k, eta = self.model.k, np.full((self.model.k, classes), 1.0 / self.model.k)
        for sweep in range(sweeps):
            self.models = [replace(self.model, head=Head(kind, tuple(map(tuple, eta.T.tolist()))))]
            self.run(1, keep_from)
            if sweep < sweeps - 1:
                eta = eta - rate * np.array(heads.as_matrix(heads.softmax_gradient(self.features(), eta.tolist(), k, ridge), k, classes))
        return self
