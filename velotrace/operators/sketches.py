"""Mergeable sketches per slice: distinct counts and quantiles over any days without reading rows.

A slice keeps one binary column per counted or measured column. Sketches of any slices are united
when a question is asked, by days, by device or over everything, and a new day only adds its own.

* Distinct counts are HyperLogLog sketches of 2^14 registers. The standard error is 0.8 percent;
  counts up to a few thousand are exact.
* Quantiles are KLL sketches with k = 800. The rank of an answer is within 0.5 percent of the asked
  one in 99 of 100 cases; of up to 800 values it is exact.

Null and NaN values are not counted. A group without values has the count 0 and null quantiles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_REGISTERS = 14
KLL_K = 800
RANK_ERROR = 0.005
#: Quantiles that stand for all values where distances from the median are asked for.
STEPS = 999


def distinct_name(column: str) -> str:
    return f"{column}_distinct"


def values_name(column: str) -> str:
    return f"{column}_values"


def slice_sketches(
    rows: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), values: Sequence[str] = ()
) -> DataFrame:
    """One row per group with ``rows`` and a sketch per column; tasks sketch before the shuffle."""

    def number(c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(x), x)

    return rows.groupBy(*by).agg(
        F.count("*").alias("rows"),
        *[F.hll_sketch_agg(F.col(f"`{c}`"), LOG_REGISTERS).alias(distinct_name(c)) for c in distinct],
        *[F.kll_sketch_agg_double(number(c), KLL_K).alias(values_name(c)) for c in values],
    )


def united(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of slices as sketches of the groups ``by``, or of everything."""
    merged = []
    for c in sketches.columns:
        if c.endswith("_distinct"):
            merged.append(F.hll_union_agg(F.col(f"`{c}`")).alias(c))
        elif c.endswith("_values"):
            merged.append(F.kll_merge_agg_double(F.col(f"`{c}`")).alias(c))
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), *merged)


def distinct_counts(sketches: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Expressions of the estimated distinct counts, by column."""
    return {c: F.coalesce(F.hll_sketch_estimate(F.col(f"`{distinct_name(c)}`")), F.lit(0)) for c in columns}


def quantile(column: str, prob: float) -> Column:
    """A value whose rank in the column is about ``prob``; null without values."""
    sketch = F.col(f"`{values_name(column)}`")
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(prob))))


def deviation(column: str, middle: Column) -> Column:
    """About the median distance of the column's values from ``middle``, by ``STEPS`` quantiles that
    stand for the values. Its rank is within twice the stated error, plus half a step."""
    sketch = F.col(f"`{values_name(column)}`")
    asked = F.array(*[F.lit((i + 0.5) / STEPS) for i in range(STEPS)])
    # An expression inside a lambda is computed for each element, so the middle is repeated outside.
    middles = F.array_repeat(middle, STEPS)
    steps = F.kll_sketch_get_quantile_double(sketch, asked)
    away = F.array_sort(F.zip_with(steps, middles, lambda x, m: F.abs(x - m)))
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.get(away, F.lit(STEPS // 2)))


def sketched_statistics(
    sketches: DataFrame, by: Sequence[str], columns: Sequence[str], probs: Mapping[str, float]
) -> DataFrame:
    """Per group ``n``, and for each column the named quantiles and its highest value, from sketches."""
    merged = united(sketches, by)
    return merged.select(
        *by,
        F.col("rows").alias("n"),
        *[quantile(c, p).alias(f"{c}_{name}") for c in columns for name, p in probs.items()],
        *[quantile(c, 1.0).alias(f"{c}_max") for c in columns],
    )
