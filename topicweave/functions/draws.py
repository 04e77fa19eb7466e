"""Reproducible draws: every random number is a hash of the row's own key.

A draw does not depend on partitioning, task retries or the number of executors, so a lost executor never changes
a result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UINT32 = 4294967296.0


def hash_uint32(*parts) -> Column:
    """32-bit whole number from the parts joined by ``|``."""
    joined = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def uniform(*parts) -> Column:
    """Number strictly between 0 and 1."""
    return (hash_uint32(*parts).cast("double") + F.lit(0.5)) / F.lit(UINT32)


def running_totals(weights: list[Column]) -> list[Column]:
    out = [weights[0]]
    for w in weights[1:]:
        out.append(out[-1] + w)
    return out


def pick(u: Column, bounds: list[Column]) -> Column:
    """Index of the first bound above ``u * bounds[-1]`` (inverse CDF)."""
    target = u * bounds[-1]
    hit = F.lit(0)
    for bound in bounds[:-1]:
        hit = hit + (target >= bound).cast("int")
    return hit


def hash_share(key: Column, share: float, seed) -> Column:
    """True for a stable ``share`` of the keys."""
    return uniform(key, seed) < F.lit(share)
