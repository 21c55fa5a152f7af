"""Exact quantiles, interpolated between neighbours, for groups of any size.

Groups of at most ``group_rows`` rows use Spark's exact ``percentile``, which holds the distinct
values of a group in one task. Larger groups are narrowed instead: a sketch proposes two values
around the wanted rank, one counting pass says exactly on which side of them the rank lies, and
the search goes on between them until what is left fits a task. The passes aggregate before the
shuffle; the sketch only steers, so the result is exact whatever its error. Rows are read several
times, so costly ones should be written first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotrace.operators.joins import joined, restrict, small_side
from velotrace.session import written
from velotrace.settings import Settings

CUTS = 500
ACCURACY = 5000


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    settings: Settings = Settings(),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row per group with ``<column>_<label>`` for each label of ``probs``; nulls skipped.

    ``extra`` are aggregates to return with them.
    """
    by, extra = list(by), list(extra)
    if not by:
        if df.count() <= settings.group_rows:
            return _small(df, columns, probs, by, extra)
        return _large(df, columns, probs, by, extra, settings)

    sizes = df.groupBy(*by).count().filter(F.col("count") > settings.group_rows)
    if sizes.isEmpty():
        return _small(df, columns, probs, by, extra)
    large = small_side(written(sizes.select(*by), "large-groups"), settings)
    return _small(
        restrict(df, large, by, "left_anti"), columns, probs, by, extra
    ).unionByName(_large(restrict(df, large, by, "left_semi"), columns, probs, by, extra, settings))


def approximate_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Values whose rank is within a share 1/accuracy of the wanted one, from one pass."""
    return df.groupBy(*by).agg(
        *[
            F.percentile_approx(c, float(p), accuracy).alias(f"{c}_{label}")
            for c in columns
            for label, p in probs.items()
        ],
        *extra,
    )


def _small(df, columns, probs, by, extra) -> DataFrame:
    return df.groupBy(*by).agg(
        *[
            F.percentile(F.col(c), F.lit(p)).alias(f"{c}_{label}")
            for c in columns
            for label, p in probs.items()
        ],
        *extra,
    )


def _large(df, columns, probs, by, extra, settings=Settings()) -> DataFrame:
    """``quantiles`` of groups of any size, in four passes over the rows and a search in few of them.

    The passes hold one row per input row; only values near a wanted rank get rows of their own.
    """
    value = {c: f"_v{i}" for i, c in enumerate(columns)}
    targets = [(c, n, f"_{i}_{j}") for i, c in enumerate(columns) for j, n in enumerate(probs)]
    rows = df.withColumns({v: F.col(c).cast("double") for c, v in value.items()})
    ranks = [k / CUTS for k in range(CUTS + 1)]
    counted = rows.groupBy(*by).agg(
        *[F.count(v).alias(f"_n{v}") for v in value.values()],
        *[F.percentile_approx(v, ranks, ACCURACY).alias(f"_cuts{v}") for v in value.values()],
        *extra,
    )
    counted = written(counted, "quantile-cuts")
    more = [c for c in counted.columns[len(by) + 2 * len(value):]]
    rows = rows.select(*by, *value.values())

    def rank(c, n):
        """The wanted rank, from 0, and the whole rank at or below it."""
        at = F.lit(float(probs[n])) * (F.col(f"_n{value[c]}") - 1)
        return at, F.floor(at)

    def cut(c, n, step):
        spot = rank(c, n)[1] / F.greatest(F.col(f"_n{value[c]}") - 1, F.lit(1)) * CUTS
        place = F.ceil(spot).cast("int") + 1 if step > 0 else F.floor(spot).cast("int") - 1
        return F.get(f"_cuts{value[c]}", F.least(F.greatest(place, F.lit(0)), F.lit(CUTS)))

    bounds = counted.select(
        *by, *[x for c, n, t in targets for x in (cut(c, n, -1).alias(f"_a{t}"), cut(c, n, 1).alias(f"_b{t}"))]
    )
    sides = _met(rows, bounds, by).groupBy(*by).agg(
        *[x for c, n, t in targets for x in _sides(F.col(value[c]), F.col(f"_a{t}"), F.col(f"_b{t}"), t)]
    )
    sides = written(_met(_met(counted.drop(*more), bounds, by), sides, by), "quantile-counts")
    parts = ["_a", "_b", "_below", "_at_a", "_between", "_at_b"]
    state = sides.select(
        *by,
        F.inline(F.array(*[
            F.struct(
                F.lit(t).alias("_target"), F.col(f"_n{value[c]}").alias("_n"),
                rank(c, n)[0].alias("_at"), rank(c, n)[1].alias("_rank"),
                *[F.col(f"{p}{t}").alias(p) for p in parts],
            )
            for c, n, t in targets
        ])),
    ).filter("_n > 0")
    state = state.withColumns(
        {"_before": F.lit(0).cast("long")} | {c: F.lit(None).cast("double") for c in ("_low", "_high", "_found")}
    )
    key = [*by, "_target"]
    state = _kept(_step(state, [*key, "_at", "_rank", "_before", "_low", "_high", "_found"]))

    def wide(*names):
        """The searches of a group in one row; a target without values has no ``_at``."""
        return state.groupBy(*by).agg(
            *[F.max(F.when(F.col("_target") == t, F.col(x))).alias(f"{x}{t}") for _, _, t in targets for x in names]
        )

    if not state.filter(F.col("_found").isNull()).isEmpty():
        # About a hundredth of the rows can still matter; each is kept under its target.
        near = [
            F.when(
                F.col(f"_at{t}").isNotNull() & F.col(f"_found{t}").isNull() & _is_inside(F.col(value[c]), t),
                F.struct(F.lit(t).alias("_target"), F.col(value[c]).alias("_v")),
            )
            for c, _, t in targets
        ]
        met = _met(rows, wide("_at", "_found", "_low", "_high"), by)
        rest = met.filter(F.coalesce(*near).isNotNull()).select(*by, F.inline(F.array(*near)))
        rest = rest.filter(F.col("_target").isNotNull())
        state = _searched(written(rest, "quantile-rest"), state, key, settings)

    sought = wide("_at", "_rank", "_found")
    after = _met(rows, sought, by).groupBy(*by).agg(
        *[
            x
            for c, _, t in targets
            for x in (
                F.count_if(F.col(value[c]) <= F.col(f"_found{t}")).alias(f"_upto{t}"),
                F.min(F.when(F.col(value[c]) > F.col(f"_found{t}"), F.col(value[c]))).alias(f"_next{t}"),
            )
        ]
    )
    results = []
    for c, n, t in targets:
        at, below, found = F.col(f"_at{t}"), F.col(f"_rank{t}"), F.col(f"_found{t}")
        upper = F.when(below + 1 < F.col(f"_upto{t}"), found).otherwise(F.col(f"_next{t}"))
        weight = at - below
        results.append(
            F.when(weight == 0, found).otherwise((below + 1 - at) * found + weight * upper).alias(f"{c}_{n}")
        )
    # A group without any value has no search, but its extras.
    both = _met(_met(counted.select(*by, *more), sought, by, "left"), after, by, "left")
    return written(both.select(*by, *results, *more), "quantiles")


def _met(rows: DataFrame, table: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows with the columns of their group. Large groups are far fewer than rows."""
    if not by:
        return rows.crossJoin(F.broadcast(table))
    return joined(rows, small_side(table, Settings()), by, how)


def _sides(v: Column, a: Column, b: Column, suffix: str = "") -> list[Column]:
    """Values on each side of two cuts, and on them."""
    return [
        F.count_if(v < a).alias(f"_below{suffix}"),
        F.count_if(v == a).alias(f"_at_a{suffix}"),
        F.count_if((v > a) & (v < b)).alias(f"_between{suffix}"),
        F.count_if((v == b) & (a < b)).alias(f"_at_b{suffix}"),
    ]


def _is_inside(v: Column, suffix: str = "") -> Column:
    low, high = F.col(f"_low{suffix}"), F.col(f"_high{suffix}")
    return v.isNotNull() & (low.isNull() | (v > low)) & (high.isNull() | (v < high))


def _searched(rest: DataFrame, state: DataFrame, key: Sequence[str], settings: Settings) -> DataFrame:
    """The searches with their values, which ``rest`` holds under each target that is open.

    Rows are narrowed until those of each target fit a task, which then counts off the rank.
    """
    small = small_side(state, settings)
    v, is_open = F.col("_v"), F.col("_found").isNull()
    while not state.filter(is_open).isEmpty():
        inside = joined(rest, small.filter(is_open), key, "inner").filter(_is_inside(v))
        sizes = inside.groupBy(*key).agg(F.count("*").alias("_in"))
        if sizes.filter(F.col("_in") > settings.group_rows).isEmpty():
            place = F.row_number().over(Window.partitionBy(*key).orderBy("_v")) - 1
            last = inside.withColumn("_place", place).filter(F.col("_place") == F.col("_rank") - F.col("_before"))
            hits = last.select(*key, F.col("_v").alias("_hit"))
            both = joined(state, hits, key, "left")
            return _kept(both.withColumn("_found", F.coalesce("_found", "_hit")).drop("_hit"))
        cuts = inside.groupBy(*key).agg(
            F.count("*").alias("_in"),
            F.percentile_approx(v, [i / CUTS for i in range(CUTS + 1)], ACCURACY).alias("_cuts"),
        )
        spot = (F.col("_rank") - F.col("_before")) / F.greatest(F.col("_in") - 1, F.lit(1)) * CUTS
        bounds = _kept(
            joined(state.filter(is_open), cuts, key, "inner").select(
                *key,
                F.get("_cuts", F.greatest(F.floor(spot).cast("int") - 1, F.lit(0))).alias("_a"),
                F.get("_cuts", F.least(F.ceil(spot).cast("int") + 1, F.lit(CUTS))).alias("_b"),
            )
        )
        counts = joined(inside, small_side(bounds, settings), key, "inner").groupBy(*key).agg(
            F.first("_a").alias("_a"), F.first("_b").alias("_b"), *_sides(v, F.col("_a"), F.col("_b"))
        )
        state = _kept(_step(joined(state, counts, key, "left"), state.columns))
        small = small_side(state, settings)
    return state


def _kept(state: DataFrame) -> DataFrame:
    """Search state has one row per large group, column and label."""
    return written(state, "quantile-state")


def _step(state: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Move each open search to the side of its two cuts on which its rank lies."""
    a, b = F.col("_a"), F.col("_b")
    rest = F.col("_rank") - F.col("_before")
    to_a = F.col("_below")
    past_a = to_a + F.col("_at_a")
    to_b = past_a + F.col("_between")
    past_b = to_b + F.col("_at_b")
    searched, under, over = a.isNotNull(), rest < to_a, rest >= past_b
    changed = {
        "_found": F.when(searched & (rest >= to_a) & (rest < past_a), a)
        .when(searched & (rest >= to_b) & (rest < past_b), b)
        .otherwise(F.col("_found")),
        "_low": F.when(~searched | under, F.col("_low")).when(over, b).otherwise(a),
        "_high": F.when(~searched | over, F.col("_high")).when(under, a).otherwise(b),
        "_before": F.col("_before")
        + F.when(~searched | under, 0).when(over, past_b).otherwise(past_a),
    }
    return state.select(*[changed.get(c, F.col(c)).alias(c) for c in columns])
