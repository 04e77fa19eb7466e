"""Column expressions on short numeric arrays (one entry per topic or class)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def items(vector: Column, size: int) -> list[Column]:
    return [vector[i] for i in range(size)]


def total(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def stored(parts: list[Column]) -> Column:
    """The parts as an array that later columns read instead of repeating its expressions.

    A plain array would be taken apart by the optimiser and every part pasted into each of its readers, which multiplies
    the size of long expressions. An element-wise pass keeps it whole, and keeps long arrays out of generated methods that
    would be too large to compile.
    """
    return F.transform(F.array(*parts), lambda x: x)


def scaled(vector: Column, size: int) -> Column:
    """Vector divided by its own sum."""
    entries = items(vector, size)
    whole = total(entries)
    return F.array(*[e / whole for e in entries])


def permute(vector: Column, order: list[int]) -> Column:
    return F.array(*[vector[i] for i in order])


def one_hot(index: Column, size: int) -> Column:
    return F.array(*[(index == i).cast("double") for i in range(size)])


def times_matrix(vector: Column, matrix: list[list[float]]) -> Column:
    """Row vector times a small literal matrix."""
    width = len(matrix[0])
    return F.array(*[
        total([vector[i] * F.lit(float(row[j])) for i, row in enumerate(matrix)]) for j in range(width)
    ])


def first_argmax(vector: Column) -> Column:
    """0-based position of the largest entry, the first one on ties."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def log_sum_exp(parts: list[Column]) -> Column:
    top = F.greatest(*parts) if len(parts) > 1 else parts[0]
    return top + F.log(total([F.exp(p - top) for p in parts]))


def softmax(parts: list[Column]) -> list[Column]:
    top = F.greatest(*parts) if len(parts) > 1 else parts[0]
    raised = [F.exp(p - top) for p in parts]
    whole = total(raised)
    return [r / whole for r in raised]


def norm2(parts: list[Column]) -> Column:
    return F.sqrt(total([p * p for p in parts]))


def digamma(x: Column) -> Column:
    """Derivative of the log gamma function for positive ``x``: six steps up, then the asymptotic series."""
    shift = total([F.lit(1.0) / (x + F.lit(float(i))) for i in range(6)])
    y = x + F.lit(6.0)
    inv2 = F.lit(1.0) / (y * y)
    series = inv2 * (F.lit(1 / 12) - inv2 * (F.lit(1 / 120) - inv2 * F.lit(1 / 252)))
    return F.log(y) - F.lit(0.5) / y - series - shift
