"""Data checks: failing-row queries, and a fused run of a whole check list."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopgrain.session import partitions_for, shuffle_partitions, small_splits, written

NOT_NULL, UNIQUE, ACCEPTED, RELATIONSHIP, RULE = (
    "not_null",
    "unique",
    "accepted_values",
    "relationships",
    "rule",
)
KEY_TESTS = (UNIQUE, RELATIONSHIP)


@dataclass(frozen=True)
class Check:
    """One declared check. ``parent`` is (layer, table, column) of a referential check.

    A rule's ``column`` is its name. It has a ``predicate`` that a failing row meets, or, with
    ``key`` and ``parent``, fails rows whose key is NULL or absent from the parent."""

    layer: str
    table: str
    column: str
    test: str
    values: tuple[str, ...] = ()
    parent: tuple[str, str, str] | None = None
    predicate: Callable[[], Column] | None = None
    key: str | None = None

    @property
    def source(self) -> tuple[str, str]:
        return self.layer, self.table


# -- failing rows of one check ------------------------------------------


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return counts.where("n_records > 1")


def _unaccepted(column: str, values: Sequence[str]) -> Column:
    return ~F.col(column).isin(*values)


def unaccepted_rows(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is outside the list; NULL passes."""
    return df.where(_unaccepted(column, values))


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows with a non-NULL reference the parent lacks; a NULL reference passes."""
    keys = parent.select(F.col(parent_column).alias("__parent"))
    return child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__parent"), "left_anti")


# -- fused run -----------------------------------------------------------


def run_checks(
    spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame], checks: Sequence[Check]
) -> DataFrame:
    """One row per check: layer, table_name, column_name, test, failures, status.

    Every table is scanned once, for its row checks, its rules and its keys, and all
    tables share one shuffle."""
    numbered = list(enumerate(checks))
    counts = _check_counts(spark, tables, numbered)
    # One row per declared check: the list is part of the program, so it cannot grow with the data.
    names = spark.createDataFrame(
        [(i, c.layer, c.table, c.column, c.test) for i, c in numbered],
        "check_no int, layer string, table_name string, column_name string, test string",
    )
    failures = F.coalesce("failures", F.lit(0).cast("bigint"))
    return names.join(counts, "check_no", "left").select(
        "layer",
        "table_name",
        "column_name",
        "test",
        failures.alias("failures"),
        F.when(failures == 0, "pass").otherwise("fail").alias("status"),
    )


def kept_report(report: DataFrame, rows: int) -> DataFrame:
    """A report worked out now and kept: a row a check. The partitions of its shuffle grow with
    ``rows``, about how many rows all its tables hold, so that the values a task counts fit its
    memory."""
    spark = report.sparkSession
    with shuffle_partitions(spark, partitions_for(spark, rows)), small_splits(spark):
        return written(report, "check-report")


def select_layer(report: DataFrame, layer: str) -> DataFrame:
    return report.where(F.col("layer") == layer)


def _failing(check: Check) -> str | None:
    """What a row fails a check by, in SQL, for checks that look at a row alone; a predicate is
    looked up in a column of its own."""
    if check.test == NOT_NULL:
        return f"`{check.column}` IS NULL"
    if check.test == ACCEPTED:
        return f"`{check.column}` NOT IN ({_literals(check.values)})"
    if check.predicate is not None:
        return f"`__rule {check.column}`"
    return f"`{check.key}` IS NULL" if check.key else None


def _entry(domain: int, slot: int, value: str) -> str:
    return f"named_struct('domain', {domain}, 'slot', {slot}, 'value', {value})"


def _literals(values: Sequence[str]) -> str:
    return ", ".join("'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" for value in values)


def _check_counts(
    spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame], checks: Sequence[tuple[int, Check]]
) -> DataFrame:
    """Failures of every check in one aggregation; each table is scanned once.

    A key domain is an owning (layer, table, column). Slot 0 holds the owner's
    values, the other slots the columns that refer to it. Counting per
    (domain, value, slot) answers uniqueness and references: an owner count
    above one is a repeat, a referring count without an owner is a set of
    orphans. Counts combine before the shuffle, so a frequent value costs one row per task.

    A row that fails row checks counts once, under domain -1, with the numbers of these checks
    as value; a row that passes adds nothing. Metrics observed beside the scan would cost no
    more, but count rows again when a lost executor's tasks are repeated.
    """
    domains: dict[tuple[str, str, str], int] = {}
    slots: dict[tuple, int] = {}  # (domain, source, column) -> slot; 0 is the owner's
    emitted: dict[tuple[str, str], list[str]] = {}  # table -> domain, slot, value
    row_checks: dict[tuple[str, str], list[tuple[str, int]]] = {}
    rules: dict[tuple[str, str], dict[str, Column]] = {}
    answers = []

    def emit(source: tuple[str, str], column: str, domain: int, slot: int) -> None:
        emitted.setdefault(source, []).append(_entry(domain, slot, f"CAST(`{column}` AS STRING)"))

    for number, check in checks:
        failing = _failing(check)
        if failing is not None:
            row_checks.setdefault(check.source, []).append((failing, number))
        if check.predicate is not None:
            rules.setdefault(check.source, {})[f"__rule {check.column}"] = check.predicate()
        if check.test in KEY_TESTS or check.key:
            owner = check.parent or (*check.source, check.column)
            if owner not in domains:
                domains[owner] = len(domains)
                emit(owner[:2], owner[2], domains[owner], 0)
            domain, slot = domains[owner], 0
            if check.parent:
                column = check.key or check.column
                place = (domain, check.source, column)
                if place not in slots:
                    slots[place] = 1 + sum(known[0] == domain for known in slots)
                    emit(check.source, column, domain, slots[place])
                slot = slots[place]
            answers.append((domain, slot, number))
    for source, found in row_checks.items():
        some = " OR ".join(failing for failing, _ in found)
        listed = ", ".join(f"IF({failing}, '{number}', NULL)" for failing, number in found)
        emitted.setdefault(source, []).append(_entry(-1, 0, f"IF({some}, concat_ws(',', {listed}), NULL)"))

    counted = range(1 + max((slot for _, slot, _ in answers), default=0))
    parts = [
        tables[source].withColumns(rules.get(source, {})).selectExpr(f"inline(array({', '.join(entries)}))")
        for source, entries in emitted.items()
    ]
    per_value = (
        reduce(DataFrame.unionAll, parts)
        .where("value IS NOT NULL")
        .groupBy("domain", "value")
        .agg(*[F.expr(f"count_if(slot = {s}) AS n{s}") for s in counted])
    )
    per_domain = per_value.groupBy("domain", F.expr("IF(domain = -1, value, NULL) AS failed")).agg(
        F.expr("IF(domain = -1, sum(n0), count_if(n0 > 1)) AS s0"),
        *[F.expr(f"sum(IF(n0 = 0, n{s}, 0)) AS s{s}") for s in counted[1:]],
    )
    # From here on, rows are declared key checks and sets of row checks that failed together.
    per_slot = ", ".join(f"{s}, s{s}" for s in counted)
    tall = per_domain.selectExpr("domain", "failed", f"stack({len(counted)}, {per_slot}) AS (slot, failures)")
    known: dict[str, list[int]] = {}
    for domain, slot, number in answers:
        known.setdefault(f"{domain} {slot}", []).append(number)
    places = ", ".join(f"'{place}', array({', '.join(map(str, numbers))})" for place, numbers in known.items())
    asked = f"try_element_at(map({places}), concat_ws(' ', domain, slot))" if known else "CAST(NULL AS array<int>)"
    failed = "IF(slot = 0, CAST(split(failed, ',') AS array<int>), NULL)"
    numbered = tall.selectExpr(f"explode(IF(domain = -1, {failed}, {asked})) AS check_no", "failures")
    return numbered.groupBy("check_no").agg(F.sum("failures").alias("failures"))
