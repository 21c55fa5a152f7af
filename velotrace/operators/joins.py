"""Equi-joins to a table that has one row per key, safe for hot keys and any table size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrace.session import written
from velotrace.settings import Settings


def same_keys(keys: Sequence[str], left: str = "l", right: str = "r"):
    """Null-safe equality of the key columns of two aliased tables."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys],
    )


def fits(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """With a broadcast hint if the counted rows are few enough, else as it is.

    The rows are counted, so a table that is costly to compute should be written first.
    """
    return F.broadcast(df) if fits(df, settings.broadcast_rows) else df


def one_per_key(table: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The table, or an error if a key has several rows, which would multiply what is joined."""
    repeated = table.groupBy(*keys).count().filter("count > 1").first()
    if repeated is not None:
        raise ValueError(f"{what} has several rows for {repeated.asDict()}")
    return table


def restrict(df: DataFrame, keys_table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join with null-safe keys; ``keys_table`` keeps its broadcast hint, if any."""
    return df.alias("l").join(keys_table.alias("r"), same_keys(keys), how)


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    settings: Settings = Settings(),
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Join ``rows`` to ``table``, which has one row per key; null keys match null keys.

    A table of at most ``broadcast_rows`` rows is broadcast. For a larger one, the rows of each
    hot key, null included, are spread over several tasks, and its single table row is repeated
    for them. The table is counted first, so one that is costly to compute should be written;
    ``small`` tells the answer where it is known.
    """
    keys = list(keys)
    if fits(table, settings.broadcast_rows) if small is None else small:
        return joined(rows, F.broadcast(table), keys, how)

    hot = (
        rows.groupBy(*keys)
        .count()
        .filter(F.col("count") > settings.group_rows)
        .select(*keys, F.ceil(F.col("count") / settings.group_rows).cast("int").alias("_spread"))
    )
    hot = written(hot, "hot-join-keys")
    if hot.isEmpty():
        return joined(rows, table, keys, how)
    hot = small_side(hot, settings)
    # After a shuffle by the key all its rows share a partition, so the number of the partition
    # alone would not part them. Exact copies of a row in one partition stay together.
    spot = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.spark_partition_id())
    spread_rows = joined(rows.withColumn("_spot", spot), hot, keys, "left").withColumn(
        "_salt", F.coalesce(F.expr("pmod(_spot, _spread)").cast("int"), F.lit(0))
    ).drop("_spot")
    spread_table = joined(table, hot, keys, "left").withColumn(
        "_salt", F.explode(F.expr("sequence(0, coalesce(_spread, 1) - 1)"))
    )
    return joined(
        spread_rows.drop("_spread"), spread_table.drop("_spread"), keys + ["_salt"], how
    ).drop("_salt")


def joined(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Null-safe equi-join that keeps the key columns once."""
    added = [c for c in table.columns if c not in on]
    both = rows.alias("l").join(table.alias("r"), same_keys(on), how)
    return both.select(
        *[F.col(f"l.`{c}`") for c in rows.columns], *[F.col(f"r.`{c}`") for c in added]
    )
