"""Shards of near-equal bytes by sampled splitters.

Records are ordered by ``(hash of the text, id)``. Groups of equal texts are summed first; a sample of them, drawn in
proportion to their bytes, gives quantile boundaries of many more ranges than shards. The true bytes and rows of all ranges
are then counted; an overfull range is divided at further sampled boundaries or, where one text fills it, by id. Consecutive
ranges form a shard, cut where the running sum is nearest to an even share. Prefix sums of the ranges' rows give every
range the first slot in its shard, so slots are numbered by ranking within ranges only.

Equal texts share a shard, unless their bytes are over half a shard; then such a group may be cut by id. The sample and the
list of ranges are the only things that reach the driver: their size follows the number of ranges, never the rows.

Defined cases: null is told apart from the empty text only by the caller's eyes, it has no bytes and forms one group with
it; rows without id come first in their group; rows with equal id and text get different slots of one shard. An empty table
has no shards.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicweave.llm.common import uniform, whole
from topicweave.session import materialize

LOW = -(1 << 63)


@dataclass(frozen=True)
class Splitting:
    """``ranges_per_shard`` sets how even shards get; ``range_rows`` bounds what one task ranks, by adding ranges."""

    ranges_per_shard: int = 48
    range_rows: int = 500_000
    sample_per_range: int = 12
    overfull: float = 3.0
    rounds: int = 4
    seed: int = 3


def assign(docs: DataFrame, shards: int, how: Splitting = Splitting(), overhead: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs (doc_id, text)``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(whole()) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(whole(), "UTF-8")).alias("text_crc32"), F.xxhash64(whole()).alias("h"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOW)).alias("i"),
    )
    rows = materialize(rows, "records")
    total = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()[0]
    if not total["n"]:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = max(how.ranges_per_shard * shards, math.ceil(total["n"] / how.range_rows))
    share = total["bytes"] / ranges
    bounds = _splitters(rows, ranges, share, total["bytes"] / shards, how)
    ranged = materialize(rows.withColumn("range", _range_of(bounds)("h", "i")), "ranges")
    table = _cut(ranged, bounds, shards, total["bytes"])
    placed = ranged.join(F.broadcast(docs.sparkSession.createDataFrame(table)), "range")
    rank = F.row_number().over(Window.partitionBy("range").orderBy("h", "i", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("first") + rank - 1).alias("slot"))


def _range_of(bounds: list[tuple[int, int]]):
    """The number of boundaries at or below ``(h, i)``."""
    h, i = (np.array(x, np.int64) for x in zip(*bounds)) if bounds else (np.array([], np.int64),) * 2

    @F.pandas_udf("long")
    def number(hash_: pd.Series, id_: pd.Series) -> pd.Series:
        hs, ids = hash_.to_numpy(np.int64), id_.to_numpy(np.int64)
        low, high = np.searchsorted(h, hs, "left"), np.searchsorted(h, hs, "right")
        out = high.copy()
        for k in np.flatnonzero(high > low):  # only texts that a boundary falls into
            out[k] = low[k] + np.searchsorted(i[low[k]:high[k]], ids[k], "right")
        return pd.Series(out)

    return number


def _splitters(rows: DataFrame, ranges: int, share: float, shard_bytes: float, how: Splitting) -> list[tuple[int, int]]:
    """Sorted boundaries ``(h, i)``; each starts a range. ``i`` is LOW where a text starts."""
    groups = materialize(rows.groupBy("h").agg(F.sum("size").alias("size")), "groups")
    bounds = _quantiles(_sample(groups, share / how.sample_per_range, how.seed), share)
    for turn in range(how.rounds):
        counted = groups.withColumn("range", _range_of(bounds)("h", F.lit(LOW))).groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("texts"))
        full = [r["range"] for r in counted.where((F.col("bytes") > how.overfull * share) & (F.col("texts") > 1)).collect()]
        if not full:
            break
        inside = groups.withColumn("range", _range_of(bounds)("h", F.lit(LOW))).where(F.col("range").isin(full))
        # a sample that is denser each time also finds the borders of a text that fills a range alone
        more = _quantiles(_sample(inside, share / how.sample_per_range / 4 ** (turn + 1), how.seed + turn + 1), share / 2)
        bounds = sorted(set(bounds) | set(more))
    # what one text alone fills is divided by id
    heavy = groups.where(F.col("size") > how.overfull * share).select("h", F.col("size").alias("bytes"))
    members = rows.join(heavy, "h").where(uniform(F.col("i"), F.col("h"), seed=how.seed + 99) < how.sample_per_range * F.col("size") / share)
    for r in members.groupBy("h").agg(F.sort_array(F.collect_list("i")).alias("ids"), F.first("bytes").alias("bytes")).collect():
        parts = max(1, round(r["bytes"] / share))
        bounds += [(r["h"], r["ids"][len(r["ids"]) * k // parts]) for k in range(1, parts)] + [(r["h"], LOW)]
    return sorted(set(bounds))


def _sample(groups: DataFrame, step: float, seed: int) -> list[tuple[int, float]]:
    """Keys and weights of texts drawn in proportion to their bytes, about one for each ``step`` bytes."""
    drawn = groups.where(uniform(F.col("h"), seed=seed) < F.col("size") / step)
    return sorted((r["h"], max(r["size"], step)) for r in drawn.select("h", "size").collect())


def _quantiles(sample: list[tuple[int, float]], share: float) -> list[tuple[int, int]]:
    """A boundary wherever the sampled weight before a key has passed another ``share``."""
    out, before, passed = [], 0.0, 0
    for h, weight in sample:
        if int(before / share) > passed:
            passed = int(before / share)
            out.append((h, LOW))
        before += weight
    return out


def _cut(ranged: DataFrame, bounds: list[tuple[int, int]], shards: int, total: int) -> pd.DataFrame:
    """``range, shard, first``: the shard of each range and the slot of its first row."""
    counts = {r["range"]: (r["bytes"], r["n"]) for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
    texts: dict[int, int] = {}
    for (h, i), k in zip(bounds, range(1, len(bounds) + 1)):
        if h in texts or i != LOW:
            texts.setdefault(h, 0)
            texts[h] += counts.get(k, (0, 0))[0]
        else:
            texts[h] = counts.get(k, (0, 0))[0]
    out, done, shard, slot, room = [], 0, 0, 0, total / shards
    for k in range(len(bounds) + 1):
        size, n = counts.get(k, (0, 0))
        h, i = bounds[k - 1] if k else (None, LOW)
        # a shard ends where the sum is nearest to its share, not inside a text unless that is over half a shard
        whole_size = texts[h] if k and i == LOW and texts[h] <= room / 2 and k < len(bounds) and bounds[k][0] == h else size
        may = i == LOW or texts[h] > room / 2
        if may and shard < shards - 1 and done and done + whole_size / 2 > room * (shard + 1):
            shard, slot = shard + 1, 0
        out.append((k, shard, slot))
        done, slot = done + size, slot + n
    return pd.DataFrame(out, columns=["range", "shard", "first"])


def sharded(docs: DataFrame, shards: int = 24, how: Splitting = Splitting()) -> DataFrame:
    """The assignment with its law: near-equal bytes; a shard more would move rows between all of them."""
    none: Column = F.lit(None).cast("int")
    return assign(docs, shards, how).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none.alias("grown_shard"))
