"""Regions of devices, from the prefixes of their names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.operators.joins import lookup
from velotrace.session import written
from velotrace.settings import REGION_INFO, REGION_PREFIXES, Settings

NAME = "device_name"
_BLANKS = " \t\n\r\f\x0b"


def region_of(
    name: Column,
    prefixes: Mapping[str, Sequence[str]] = REGION_PREFIXES,
    exact: Mapping[str, Sequence[str]] | None = None,
) -> Column:
    """The first region, in configured order, with a prefix that starts the trimmed name.

    Case does not matter for prefixes. ``exact`` lists whole names per region and is used only
    where no prefix fits. The lists are configuration, so this is an expression and not a join:
    no row moves, however many rows one device has.
    """
    trimmed = F.btrim(name, F.lit(_BLANKS))
    owner = {}
    for candidate, starts in prefixes.items():
        for prefix in starts:
            owner.setdefault(prefix.upper(), candidate)
    if owner:
        # Alternatives are tried in order, so the first prefix that fits is the one found.
        pattern = "^(" + "|".join(f"\\Q{p}\\E" for p in owner) + ")"
        found = F.regexp_extract(F.upper(trimmed), pattern, 1)
        table = F.create_map(*[F.lit(x) for pair in owner.items() for x in pair])
        region = F.try_element_at(table, found)
    else:
        region = F.lit(None).cast("string")
    if exact:
        named = F.lit(None).cast("string")
        for candidate, names in reversed(exact.items()):
            named = F.when(trimmed.isin(list(names)), F.lit(candidate)).otherwise(named)
        region = F.coalesce(region, named)
    return region


def region_by_table(df: DataFrame, prefixes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows with the ``region`` of the prefix with the lowest ``ord`` that starts their name.

    ``prefixes(ord, region, prefix)`` may be as large as it likes: every name meets it once by
    equality for each length that prefixes have, and not prefix by prefix. Each distinct name is
    matched once. Case and blanks around a name do not matter; of equal orders the first region by
    name is taken; a row without a prefix fits nothing, an empty prefix every name but null.
    """
    if NAME not in df.columns:
        raise ValueError(f"no column {NAME}")
    stated = prefixes.filter("prefix is not null").groupBy(F.upper("prefix").alias("_start")).agg(
        F.min(F.struct("ord", "region")).alias("_owner")
    )
    stated = written(stated, "prefixes")
    # As many lengths as the longest prefix has characters, at most.
    lengths = stated.agg(F.array_sort(F.collect_set(F.length("_start")))).first()[0]
    name = F.upper(F.btrim(F.col(NAME), F.lit(_BLANKS)))
    starts = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(name)),
        lambda n: F.substring(name, F.lit(1), n),
    )
    names = df.select(NAME).filter(F.col(NAME).isNotNull()).distinct()
    met = lookup(names.withColumn("_start", F.explode(starts)), stated, ["_start"], settings)
    found = met.groupBy(NAME).agg(F.min("_owner")["region"].alias("region"))
    return lookup(df.drop("region"), written(found, "named-regions"), [NAME], settings)


def add_region(df: DataFrame, **config) -> DataFrame:
    if NAME not in df.columns:
        raise ValueError(f"no column {NAME}")
    return df.withColumn("region", region_of(F.col(NAME), **config))


def region_rows(df: DataFrame, **config) -> DataFrame:
    """Rows of devices that belong to a region."""
    return add_region(df, **config).filter(F.col("region").isNotNull())


def region_counts(df: DataFrame, **config) -> DataFrame:
    return region_rows(df, **config).groupBy("region").agg(F.count("*").alias("rows"))


def unmatched_devices(df: DataFrame, **config) -> DataFrame:
    """Distinct names without a region; a missing name is listed as ``nan``."""
    return (
        add_region(df, **config)
        .filter(F.col("region").isNull())
        .select(F.coalesce(F.col(NAME), F.lit("nan")).alias(NAME))
        .distinct()
    )


def processed_and_total(df: DataFrame, **config) -> DataFrame:
    return add_region(df, **config).agg(
        F.count("region").alias("processed_rows"), F.count("*").alias("total_rows")
    )


def probe(df: DataFrame, order: Sequence[str] = (), rows: int = 100) -> DataFrame:
    """The first rows of a table, for a look at its structure."""
    return (df.orderBy(*order) if order else df).limit(rows)


def sample_devices(df: DataFrame, order: Sequence[str], names: int = 10) -> DataFrame:
    """The first distinct names, by first appearance."""
    return (
        df.filter(F.col(NAME).isNotNull())
        .groupBy(NAME)
        .agg(F.min(F.struct(*order)).alias("_at"))
        .orderBy("_at")
        .limit(names)
        .select(NAME)
    )


def sample_regions(df: DataFrame, **config) -> DataFrame:
    """Distinct device names per region; those without one under ``unknown``."""
    names = df.filter(F.col(NAME).isNotNull()).select(NAME).distinct()
    return (
        add_region(names, **config)
        .groupBy(F.coalesce("region", F.lit("unknown")).alias("region"))
        .agg(F.count("*").alias("devices"))
    )


def region_table(spark: SparkSession, info: Mapping[str, tuple[str, str]] = REGION_INFO) -> DataFrame:
    rows = [(region, country, zone) for region, (country, zone) in info.items()]
    return spark.createDataFrame(rows, "region string, country string, timezone string")


def prefix_table(
    spark: SparkSession, prefixes: Mapping[str, Sequence[str]] = REGION_PREFIXES
) -> DataFrame:
    """Prefixes with their place in the lookup order."""
    pairs = [(region, p) for region, starts in prefixes.items() for p in starts]
    rows = [(i, region, prefix) for i, (region, prefix) in enumerate(pairs)]
    return spark.createDataFrame(rows, "ord int, region string, prefix string")


def all_regions(
    spark: SparkSession,
    prefixes: Mapping[str, Sequence[str]] = REGION_PREFIXES,
    exact: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Region names from both lists, without repeats."""
    names = [(r,) for r in prefixes] + [(r,) for r in (exact or {})]
    return spark.createDataFrame(names, "region string").distinct()


def add_region_info(df: DataFrame, info: Mapping[str, tuple[str, str]] = REGION_INFO) -> DataFrame:
    """Country and time zone of each row's region; null for an unknown one."""
    # The table has one row per configured region.
    return df.join(F.broadcast(region_table(df.sparkSession, info)), "region", "left")
