"""Type-2 history: versions of a keyed row with validity intervals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALIDITY = ("valid_from", "valid_to", "is_current")


def first_versions(source: DataFrame, moment: str) -> DataFrame:
    """History after the first run: every row open from its own ``moment``."""
    return source.withColumns(
        {
            "valid_from": F.col(moment),
            "valid_to": F.lit(None).cast(source.schema[moment].dataType),
            "is_current": F.lit(True),
        }
    )


class RepeatedKey(ValueError):
    """A source row's key is there more than once, so its versions can't be told apart."""


def require_unique(source: DataFrame, key: str) -> None:
    """Refuse a source in which a key is repeated; NULL keys are always new rows."""
    again = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    found = [row[0] for row in again.select(key).limit(5).collect()]
    if found:
        raise RepeatedKey(f"{key} is repeated, for example {found}")


def _spread(key: str, columns: Sequence[str]) -> Column:
    """The key, or for a NULL key a number that spreads such rows over tasks."""
    return F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(*columns)).alias("__spread")


def next_versions(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    moment: str,
    strategy: str = "timestamp",
    attributes: Sequence[str] | None = None,
) -> DataFrame:
    """History after one more run.

    ``timestamp``: a row whose ``moment`` is newer than the stored one becomes a
    new version, whether or not anything else changed. ``check``: only when an
    attribute differs. The replaced version closes at the new ``moment``. A key
    that vanished from the source stays open; a NULL key is always new.

    One full outer join of the open versions with the source yields the old row,
    the new row, or both; closed versions pass by untouched.
    """
    if history is None:
        return first_versions(source, moment)
    columns = source.columns
    attributes = [c for c in (attributes or columns) if c not in (key, moment)]
    stored = history.where("is_current").select(F.struct(*columns, *VALIDITY).alias("o"), _spread(key, columns))
    incoming = source.select(F.struct(*columns).alias("n"), _spread(key, columns).alias("__incoming"))
    same_key = (F.col("__spread") == F.col("__incoming")) & (F.col(f"o.{key}") == F.col(f"n.{key}"))
    joined = stored.join(incoming, same_key, "full_outer")

    both = F.col("o").isNotNull() & F.col("n").isNotNull()
    if strategy == "timestamp":
        differs = F.col(f"n.{moment}") > F.col(f"o.{moment}")
    elif strategy == "check":
        differs = F.lit(False)
        for c in attributes:
            differs = differs | ~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    changed = F.coalesce(both & differs, F.lit(False))
    moment_type = source.schema[moment].dataType
    kept = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in columns],
        F.col("o.valid_from").alias("valid_from"),
        F.when(changed, F.col(f"n.{moment}")).cast(moment_type).alias("valid_to"),
        (~changed).alias("is_current"),
    )
    added = F.struct(
        *[F.col(f"n.{c}").alias(c) for c in columns],
        F.col(f"n.{moment}").alias("valid_from"),
        F.lit(None).cast(moment_type).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    rows = F.when(F.col("o").isNull(), F.array(added)).when(changed, F.array(kept, added)).otherwise(F.array(kept))
    renewed = joined.select(F.inline(rows))
    return history.where("NOT is_current").select(*renewed.columns).unionByName(renewed)


def as_of(history: DataFrame, moment: datetime) -> DataFrame:
    """The versions that were valid at ``moment``."""
    at = F.lit(moment).cast("timestamp_ntz")
    return history.where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    )


def as_of_join(
    facts: DataFrame, history: DataFrame, key: str, moment: str, columns: Sequence[str], spread_by: str, parts: int = 16
) -> DataFrame:
    """``facts`` with ``columns`` of the version of ``key`` that was valid at the fact's ``moment``.

    A sorted merge: versions and facts of a key stand in one order of time, and the last version
    is carried forward to the facts after it. No pair of a fact and a version is made, so many
    versions cost no more than their rows. The facts of a key are dealt to ``parts`` parts by
    ``spread_by``, each with all of the key's versions, so that a key of very many facts is shared
    among tasks. A fact before the first version, in a gap, or without a key or moment has NULLs;
    of versions that begin together the one that ends last counts.
    """
    part = F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int")
    version = F.struct(*columns, "valid_to")
    none = F.lit(None).cast(history.select(version.alias("v")).schema["v"].dataType)
    names = facts.columns
    given = facts.select(
        F.col(key).alias("__key"), part.alias("__part"), F.col(moment).alias("__at"), F.lit(1).alias("__fact"),
        none.alias("__version"), F.struct(*names).alias("__row"),
    )
    known = history.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("__part"),
        F.col("valid_from").alias("__at"), F.lit(0).alias("__fact"), version.alias("__version"),
        F.lit(None).cast(given.schema["__row"].dataType).alias("__row"),
    )
    ends = F.coalesce(F.col("__version.valid_to"), F.lit(datetime.max).cast("timestamp_ntz"))
    order = Window.partitionBy("__key", "__part").orderBy("__at", "__fact", ends)
    carried = F.last("__version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = known.unionByName(given).withColumn("__version", carried).where("__fact = 1")
    valid = F.col("__version.valid_to").isNull() | (F.col("__at") < F.col("__version.valid_to"))
    return merged.select("__row.*", *[F.when(valid & F.col("__at").isNotNull(), F.col(f"__version.{c}")).alias(c) for c in columns])
