"""Running counts over an order without sorting all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Values per range that are looked at to cut an order that has no quantiles.
SAMPLE = 100


def borders(rows: DataFrame, order: str, parts: int) -> list:
    """Values that cut an order into about `parts` ranges of about equal size: quantiles of a number, or those of at most
    SAMPLE values per range, the ones of least hash, of anything else."""
    if isinstance(rows.schema[order].dataType, NumericType):
        return sorted(set(rows.approxQuantile(order, [i / parts for i in range(1, parts)], 0.1 / parts)))
    found = rows.select(order).filter(F.col(order).isNotNull()).orderBy(F.xxhash64(order)).limit(SAMPLE * parts).collect()
    values = sorted(r[0] for r in found)
    return sorted({values[len(values) * i // parts] for i in range(1, parts)}) if values else []


def running_sums(rows: DataFrame, order: str, sums: dict[str, str], by: list[str] = [], parts: int | None = None) -> DataFrame:  # noqa: B006
    """Rows with, for each (new name, column) of `sums`, the sum of the column up to and with the row, in an order.

    Borders cut the order into ranges of about equal size. A row's sum is that within its range, plus those of the ranges
    before it, of which there are `parts` per group of `by`.
    """
    parts = parts or max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = borders(rows, order, parts)
    cuts = F.array(*[F.lit(b) for b in found]) if found else F.array().cast(f"array<{rows.schema[order].dataType.simpleString()}>")
    ranged = rows.withColumn("__p", F.size(F.filter(cuts, lambda b: b < F.col(order))))
    totals = ranged.groupBy(*by, "__p").agg(*[F.sum(c).alias(f"__sum_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    base = totals.select(*by, "__p", *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__base_{n}") for n in sums])
    within = Window.partitionBy(*by, "__p").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # without groups these are `parts` rows
    out = ranged.withColumns({n: F.sum(c).over(within) for n, c in sums.items()}).join(base if by else F.broadcast(base), [*by, "__p"])
    return out.withColumns({n: F.col(n) + F.col(f"__base_{n}") for n in sums}).drop("__p", *[f"__base_{n}" for n in sums])
