"""Table rules as counts of offending rows: keys, references, lengths, number ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import schemas


def _labelled(df: DataFrame, table: str, rule: str, column: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), "n_bad"
    )


def _repeated_keys(df: DataFrame, spec: schemas.TableSpec, stored: DataFrame | None) -> DataFrame:
    """Rows too many for their key, among themselves and against the stored rows.

    The comparison with a long table is an inner join on the new keys, which the optimizer
    can run without moving the stored ones when few rows are new.
    """
    keys = list(spec.primary_key)
    copies = df.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("copies"))
    found = copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_bad"))
    if stored is not None:
        taken = copies.select(*keys).join(stored.select(*keys), keys).distinct()
        found = found.unionByName(taken.agg(F.count("*").alias("n_bad"))).agg(F.sum("n_bad").alias("n_bad"))
    return _labelled(found, spec.name, "primary_key_unique", ",".join(keys))


def _dangling(df: DataFrame, spec: schemas.TableSpec, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows whose reference has no target.

    Equal values are collapsed on both sides first, so a key shared by a third of all rows
    takes part in the anti join as one row.
    """
    used = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("copies"))
    lost = used.join(target.select(F.col(target_column).alias(column)).distinct(), column, "left_anti")
    found = lost.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n_bad"))
    return _labelled(found, spec.name, "foreign_key_exists", column)


def table_violations(
    df: DataFrame,
    spec: schemas.TableSpec,
    referenced: dict[str, DataFrame],
    stored: DataFrame | None = None,
) -> DataFrame:
    """(table_name, rule, column_name, n_bad) with one row per rule of the table.

    Rules of a single row share one pass.  ``stored`` holds rows already in the table;
    they only count for key uniqueness.
    """
    checks = [("primary_key_not_null", c, F.col(c).isNull()) for c in spec.primary_key]
    checks += [
        (f"length_at_most_{n}", c, F.length(F.col(c).cast("string")) > n) for c, n in spec.max_length.items()
    ]
    checks += [("below_10_digits", c, F.abs(F.col(c)) >= F.lit(100_000_000)) for c in spec.money_columns]
    parts = []
    if checks:
        counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
        rows = [
            F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), F.col(f"c{i}").alias("n_bad"))
            for i, (rule, column, _) in enumerate(checks)
        ]
        parts.append(
            counts.select(F.inline(F.array(*rows))).select(
                F.lit(spec.name).alias("table_name"), "rule", "column_name", "n_bad"
            )
        )
    if spec.primary_key:
        parts.append(_repeated_keys(df, spec, stored))
    for column, (table, target_column) in spec.foreign_keys.items():
        parts.append(_dangling(df, spec, column, referenced[table], target_column))
    return reduce(DataFrame.unionByName, parts)


def constraint_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Every rule of every table."""
    return reduce(
        DataFrame.unionByName,
        [table_violations(tables[name], spec, tables) for name, spec in schemas.TABLES.items()],
    )
