"""Data-quality checks: each is a one-row DataFrame (check, table, failures)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.schemas import CONTRACTS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, UNIQUE
from mediamart.sources.tables import check_contract


def _report(failures: DataFrame, check: str, table: str) -> DataFrame:
    return failures.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.coalesce(F.col("failures"), F.lit(0)).cast("long").alias("failures"),
    )


def not_null(df: DataFrame, columns: list[str], table: str = "") -> DataFrame:
    """Number of NULLs, one row per column, all counted in a single scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.explode(
        F.array(*[F.struct(F.lit(f"not_null({c})").alias("c"), F.col(c).alias("n")) for c in columns])
    )
    return counts.select(rows.alias("r")).select(
        F.col("r.c").alias("check"), F.lit(table).alias("table"), F.col("r.n").alias("failures")
    )


def unique(df: DataFrame, columns: list[str], table: str = "") -> DataFrame:
    """Number of value combinations that occur more than once.  Counts are combined before
    the shuffle, so a combination with very many copies costs no more than a rare one."""
    repeated = df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")
    return _report(
        repeated.agg(F.count("*").alias("failures")), f"unique({', '.join(columns)})", table
    )


def equal_rowcount(a: DataFrame, b: DataFrame, table: str = "", other: str = "") -> DataFrame:
    """Difference of the two row counts."""
    stacked = a.agg(F.count("*").alias("n")).unionAll(b.agg((-F.count("*")).alias("n")))
    return _report(
        stacked.agg(F.abs(F.sum("n")).alias("failures")), f"equal_rowcount({other})", table
    )


def primary_key(df: DataFrame, columns: list[str], table: str = "") -> DataFrame:
    """Repeated combinations, plus rows with a NULL in the key."""
    groups = df.groupBy(*columns).agg(F.count("*").alias("n"))
    has_null = F.lit(False)
    for c in columns:
        has_null = has_null | F.col(c).isNull()
    failures = F.coalesce(F.sum(F.when(has_null, F.col("n")).when(F.col("n") > 1, 1).otherwise(0)), F.lit(0))
    return _report(groups.agg(failures.alias("failures")), f"primary_key({', '.join(columns)})", table)


def foreign_key(
    child: DataFrame,
    columns: list[str],
    parent: DataFrame,
    parent_columns: list[str],
    table: str = "",
    other: str = "",
) -> DataFrame:
    """Child rows whose key has no parent; a key with a NULL is not checked.

    Child rows are counted per key first, so the join sees each key once.
    """
    keys = child.dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias("n"))
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns)])
    orphans = keys.join(parents, columns, "left_anti")
    return _report(
        orphans.agg(F.sum("n").alias("failures")), f"foreign_key({', '.join(columns)} -> {other})", table
    )


def contract(df: DataFrame, name: str) -> DataFrame:
    """Number of differences between the columns of ``df`` and the declared ones."""
    differences = len(check_contract(df, CONTRACTS[name]))
    return df.sparkSession.range(1).select(
        F.lit("contract").alias("check"), F.lit(name).alias("table"), F.lit(differences).cast("long").alias("failures")
    )


def declared_checks(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """All declared checks that concern the given tables."""
    checks = []
    for name, df in tables.items():
        if name in CONTRACTS:
            checks.append(contract(df, name))
        if name in PRIMARY_KEYS:
            checks.append(primary_key(df, PRIMARY_KEYS[name], name))
        if name in UNIQUE:
            checks.append(unique(df, UNIQUE[name], name))
        if name in NOT_NULL:
            checks.append(not_null(df, NOT_NULL[name], name))
        for columns, parent, parent_columns in FOREIGN_KEYS.get(name, []):
            if parent in tables:
                checks.append(foreign_key(df, columns, tables[parent], parent_columns, name, parent))
    if {"core_chapters", "stg_chapters"} <= tables.keys():
        checks.append(
            equal_rowcount(tables["core_chapters"], tables["stg_chapters"], "core_chapters", "stg_chapters")
        )
    return checks


class ChecksFailed(Exception):
    """At least one check found failures; the message lists them."""


def run_checks(checks: list[DataFrame], fail: bool = True) -> DataFrame:
    """One report of all checks.  With ``fail`` the report is evaluated, and any failure raises."""
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    if fail:
        failed = report.filter("failures > 0").collect()  # at most one row per check
        if failed:
            raise ChecksFailed("; ".join(f"{r.table}: {r.check}: {r.failures}" for r in failed))
    return report
