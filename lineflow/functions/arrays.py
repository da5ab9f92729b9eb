"""Shapes of nested arrays: dimensions, regularity, flattening, sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def depth(kind: T.DataType) -> int:
    """How many array levels a type has."""
    return 1 + depth(kind.elementType) if isinstance(kind, T.ArrayType) else 0


def leaf(kind: T.DataType) -> T.DataType:
    return leaf(kind.elementType) if isinstance(kind, T.ArrayType) else kind


def dims(c: Column, levels: int) -> Column:
    """Lengths along the first elements; a level below an empty one is left out: [] is [0], [[],[]] is [2, 0]."""
    sizes, at = [], c
    for _ in range(levels):
        sizes.append(F.size(at))
        at = F.get(at, F.lit(0))
    return F.filter(F.array(*(F.when(s >= 0, s) for s in sizes)), lambda x: x.isNotNull())


def regular(c: Column, levels: int) -> Column:
    """Whether all arrays of each level have one length, and none is null."""

    def alike(level: Column) -> Column:
        first = F.size(F.get(level, F.lit(0)))
        return F.forall(level, lambda x: F.coalesce(F.size(x) == first, F.lit(False)))

    ok, level = F.lit(True), c
    for _ in range(levels - 1):
        ok, level = ok & alike(level), F.flatten(level)
    return F.coalesce(ok, F.lit(False))


def flatten_all(c: Column, levels: int) -> Column:
    """All leaves in row-major order."""
    for _ in range(levels - 1):
        c = F.flatten(c)
    return c


def payload_size(c: Column, levels: int) -> Column:
    """Bytes of the leaves as doubles."""
    return F.aggregate(dims(c, levels), F.lit(8).cast("bigint"), lambda a, n: a * n)


def reshape(c: Column, rows: int, columns: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(c, i * columns + 1, columns))
