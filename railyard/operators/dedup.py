"""Latest version per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# As many hashes of repeated keys are sent to every task at most: 8 MB of them.
MOST_REPEATED = 1_000_000

# Of a row of ``latest_at``: whether it is its key's latest, and whether it is the latest of the key's early rows.
LATEST, EARLY = "is_latest", "is_latest_early"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    prefer: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the greatest by ``order``; NULL ranks lowest; NULL keys form one group.

    ``prefer`` names columns whose presence outranks the order: a version with them filled beats any
    without. Remaining columns break ties, so the result does not depend on row order or on retries.

    ``row_number() = 1`` is planned with a group limit before the shuffle: each map task ships at most one
    row per key, so a key that holds a third of all rows costs no more than any other. (A ``max`` over a
    struct plans the same way but sorts a boxed row; it measured slower.)
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    ranking = [F.col(c).isNull().asc() for c in prefer]
    ranking += [F.col(c).desc_nulls_last() for c in [*order, *rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_read_again(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    prefer: Sequence[str] = (),
    *,
    kept: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """``latest_per_key`` of rows that are cheap to read again: only rows of repeated keys are shuffled whole.

    The hashes of the keys are counted first; ``kept`` writes those that occur more than once and reads them back. A
    row whose hash occurs once is its key's latest as it is. The others, keys of one hash by chance included, are
    ranked as always; so are all rows where more than ``MOST_REPEATED`` hashes are repeated, or where a key is a
    floating-point number (0.0 and -0.0 are one key).
    """
    if any(isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType)) for k in keys):
        return latest_per_key(df, keys, order, prefer)
    hashed = df.withColumn("_key", F.xxhash64(*keys))
    repeated = kept(hashed.groupBy("_key").count().filter("count > 1").select("_key"), "repeated")
    if repeated.count() > MOST_REPEATED:
        return latest_per_key(df, keys, order, prefer)
    once = hashed.join(F.broadcast(repeated), "_key", "left_anti").drop("_key")
    several = hashed.join(F.broadcast(repeated), "_key", "left_semi").drop("_key")
    return once.unionByName(latest_per_key(several, keys, order, prefer))


def latest_at(df: DataFrame, keys: Sequence[str], order: Sequence[str], prefer: Sequence[str] = (), *, early: Column) -> DataFrame:
    """``latest_per_key`` of all rows and of those that are ``early`` in one shuffle, told apart by ``LATEST`` and ``EARLY``.

    A key has one row where both are the same, else one of each. As there, a map task ships at most one early and one
    later row per key. A row where ``early`` is NULL is a later one.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    ranked = F.struct(*(F.col(c).isNotNull().alias(f"_has_{c}") for c in prefer), *order, *rest)
    is_early = F.coalesce(early, F.lit(False))
    # the greatest struct is the first by the ranking there: NULL is the least of a field's values
    best = df.groupBy(*keys).agg(F.max(F.when(is_early, ranked)).alias("_early"), F.max(F.when(~is_early, ranked)).alias("_later"))
    first, later = F.col("_early"), F.col("_later")

    def row(of: Column, latest: bool, earliest: bool) -> Column:
        return F.struct(of.alias("row"), F.lit(latest).alias(LATEST), F.lit(earliest).alias(EARLY))

    rows = (
        F.when(first.isNull(), F.array(row(later, True, False)))
        .when(later.isNull(), F.array(row(first, True, True)))
        .when(first > later, F.array(row(first, True, True)))
        .otherwise(F.array(row(later, True, False), row(first, False, True)))
    )
    found = best.select(*keys, F.explode(rows).alias("_found"))
    return found.select(*(c if c in keys else F.col(f"_found.row.{c}").alias(c) for c in df.columns), f"_found.{LATEST}", f"_found.{EARLY}")


def not_null_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise when a key occurs twice. NULL keys count as equal."""
    duplicate = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if duplicate:
        raise ValueError(f"{what}: key {tuple(keys)} is not unique, e.g. {duplicate[0].asDict()}")
