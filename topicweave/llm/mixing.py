"""Mixing sources to target weights by fitting exact word budgets.

Documents are counted by source and exact length. A source's target is split into full copies of the source and a remaining
budget below one copy. All but the end of the budget (``KNAPSACK_WORDS``, or the longest document if that is more) takes the same
share of the documents of every length, and the rest is fitted by a bounded knapsack over the numbers of documents left per length, to
the nearest sum. That yields how many more documents of each length to take; which ones is settled by a hash of seed and id, so reruns
agree. The words that a source takes differ from its target by half its longest document at most, since documents taken one after
the other pass the target by a step of one document, and the knapsack knows all that are left.

Only counts by (source, length) meet in one task: at most as many rows as there are text lengths. The same rows, one for each source and
length, are joined to the documents; they grow with the variety of lengths, not with the documents, so Spark may broadcast them. Selection ranks documents
within slices of a length's documents, so a length that a third of all rows share is spread over many tasks.

Defined cases: an empty or null text has length 0 and is never taken; the null source is a source of its own, the last one;
rows with equal ids are told apart by a hash of their other columns, and full duplicates may be taken for each other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicweave.llm.common import temporary_names, whole, word_count
from topicweave.session import materialize

#: Rows that a slice of one length holds on average at most.
SLICE_ROWS = 20_000
#: What the knapsack fits at the end, at least.
KNAPSACK_WORDS = 1 << 16


def targets(totals: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row per source.

    ``share`` of all words is given out by weight (in code-point order, null last); a target stops at ``most`` times its
    source's size and the excess goes to the others by weight. Sources in order of size over weight reach their stop one after
    the other, so prefix sums give the level at which the rest share.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    ranked = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    ranked = ranked.withColumn("stop", F.col("source_size") * float(most))
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    every = by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, rest = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(0, Window.unboundedFollowing)
    given = F.sum("source_size").over(every) * float(share)
    level = (given - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    stopped = F.col("stop") <= level * F.col("weight")
    leveled = ranked.withColumn("level", level).withColumn("stopped", stopped)
    # the level of the first source that doesn't stop holds for it and all behind it
    common = F.min(F.when(~F.col("stopped"), F.struct(F.col("stop") / F.col("weight"), "level"))).over(every)["level"]
    return leveled.select(
        "source", "source_size", F.least("stop", F.coalesce(common * F.col("weight"), F.col("stop"))).alias("target")
    )


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, at most ``counts``, so that the words come nearest to ``budget``.

    What the knapsack doesn't reach is taken in proportion first and not given back, so a still nearer sum may exist where few
    documents are long: lengths 1,000 x 5 and 300,000 x 3 give 605,000 for 500,000. All three are whole numbers, lengths positive and
    distinct.
    """
    lengths, counts = [int(x) for x in lengths], [int(x) for x in counts]
    total = sum(a * b for a, b in zip(lengths, counts))
    if budget >= total:
        return np.array(counts, np.int64)
    longest = max(lengths)
    reach = max(KNAPSACK_WORDS, longest)
    taken = [c * max(0, budget - reach) // total for c in counts]
    left = budget - sum(a * b for a, b in zip(lengths, taken))
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        step = max(0, min(counts[k] - taken[k], (left - reach) // lengths[k]))
        taken[k], left = taken[k] + step, left - step * lengths[k]
    room = left + longest
    items = [(lengths[k] * m, k, m) for k in range(len(lengths)) for m in _powers(min(counts[k] - taken[k], room // lengths[k]))]
    items.sort(key=lambda x: (x[0] * 2654435761 % (1 << 32), x))  # lengths in a mixed order, the same every time
    chosen = _knapsack(items, left, room)
    for k, m in chosen:
        taken[k] += m
    return np.array(taken, np.int64)


def _powers(count: int) -> list[int]:
    """Step sizes whose subsets give every number up to ``count``."""
    out, step = [], 1
    while count > 0:
        out.append(min(step, count))
        count, step = count - out[-1], 2 * step
    return out


def _knapsack(items: list[tuple[int, int, int]], budget: int, room: int) -> list[tuple[int, int]]:
    """Items whose sizes add up nearest to ``budget``, within ``room``; the lower of two equally near sums. Sums are bits of
    an integer; the table remembers which item reached a sum first."""
    mask, reached = (1 << (room + 1)) - 1, 1
    first = np.full(room + 1, -1, np.int64)
    for i, (size, _, _) in enumerate(items):
        if reached >> budget & 1:
            break
        fresh = (reached << size) & mask & ~reached
        if fresh:
            bits = np.unpackbits(np.frombuffer(fresh.to_bytes(room // 8 + 1, "little"), np.uint8), bitorder="little")
            first[np.flatnonzero(bits[: room + 1])] = i
            reached |= fresh
    below = (reached & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reached >> (budget + 1)
    step = (above & -above).bit_length()
    at, out = budget + step if above and step < budget - below else below, []
    while at:
        size, k, m = items[first[at]]
        out.append((k, m))
        at -= size
    return out


def quotas(histogram: DataFrame, goals: DataFrame) -> DataFrame:
    """``source, size, copies, extra, documents``: every document of a length is taken ``copies`` times, ``extra`` of them once more."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        target, whole_size = int(round(group["target"].iloc[0])), int((group["size"] * group["documents"]).sum())
        copies, budget = divmod(target, whole_size) if whole_size else (0, 0)
        some = (group["size"] > 0).to_numpy()
        extra = np.zeros(len(group), np.int64)
        extra[some] = fit(group["size"].to_numpy()[some], group["documents"].to_numpy()[some], budget)
        group["copies"], group["extra"] = np.where(some, copies, 0), extra
        return group[["source_key", "size", "copies", "extra", "documents"]].sort_values("size")

    keyed = histogram.join(goals.select("source_key", "target"), "source_key")
    return keyed.groupBy("source_key").applyInPandas(run, "source_key string, size long, copies long, extra long, documents long")


def plan(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 5) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and ``row_key`` for every row; ``taken`` counts words, repeats included."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("row_key"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("source_key"), word_count(whole()).alias("size"),
    )
    rows = materialize(rows.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "row_key")), "sizes")
    histogram = rows.groupBy("source_key", "size").agg(F.count("*").alias("documents"))
    totals = histogram.groupBy("source_key").agg(F.sum(F.col("size") * F.col("documents")).alias("source_size"))
    named = totals.withColumn("source", F.when(F.col("source_key") != "", F.expr("substr(source_key, 2)")))
    goals = targets(named.select("source", "source_size"), weights, share, most)
    goals = goals.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))).drop("source")
    goals = materialize(goals, "targets")
    per_length = materialize(quotas(histogram, goals), "quotas")

    # slices of a length's documents by their draw; each slice knows how many come before it
    slices = F.greatest(F.lit(1), F.ceil(F.col("documents") / SLICE_ROWS)).cast("long")
    sliced = rows.join(per_length, ["source_key", "size"]).withColumn("slice", F.pmod("draw", slices))
    key = ["source_key", "size", "slice"]
    before = Window.partitionBy("source_key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy(*key).agg(F.count("*").alias("n")).select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranked = sliced.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("draw", "doc_id", "row_key")))
    chosen = ranked.join(starts, key).withColumn(
        "times", F.col("copies") + (F.col("start") + F.col("rank") <= F.col("extra")).cast("long")
    )
    return chosen.join(goals, "source_key").select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times", "row_key"
    )


def row_key(docs: DataFrame):
    """Tells rows with the same id apart."""
    return F.xxhash64(*[F.col(c) for c in docs.columns])


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix: each row as often as it is taken, with the columns of ``docs``."""
    key, place, id_, key_, times_, times = temporary_names(docs.columns, "key", "place", "id_", "key_", "times_", "times")
    times_of = plan(docs, **how).where("times > 0").groupBy(F.col("doc_id").alias(id_), F.col("row_key").alias(key_)).agg(
        F.sort_array(F.collect_list("times"), asc=False).alias(times_))
    named = docs.withColumn(key, row_key(docs))
    named = named.withColumn(place, F.row_number().over(Window.partitionBy("doc_id", key).orderBy(key)))
    found = named.join(times_of, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(key_)))
    return found.withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), F.get(times_, F.col(place) - 1)))).select(*docs.columns)
