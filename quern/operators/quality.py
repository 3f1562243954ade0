"""Data-quality checks: every expectation of a suite in one aggregation pass, and table tests that return what fails."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """kind: not_null, unique, in_set, between, unique_share. mostly: the least share of non-null values that must hold."""

    kind: str
    column: str
    values: tuple = ()
    low: object = None
    high: object = None
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return f"expect_{self.kind}"


def run_suite(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row an expectation: expectation, column_name, evaluated_rows, unexpected_count, success. Nulls only count for not_null.

    All simple counts are one aggregation, whose single row is then laid out as rows. Uniqueness needs its values grouped; that happens once for each
    such column, with partial counts. So the table is read once, and once more (that column alone) for each unique column. An empty frame passes everything.
    """
    spark = df.sparkSession
    if not suite:
        return spark.createDataFrame([], "expectation string, column_name string, evaluated_rows long, unexpected_count long, success boolean")
    row = lambda e, n, bad, ok: F.struct(F.lit(suite.index(e)).alias("__at"), F.lit(e.name).alias("expectation"), F.lit(e.column).alias("column_name"), n.cast("long").alias("evaluated_rows"), bad.cast("long").alias("unexpected_count"), ok.alias("success"))
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    simple, grouped = [], {}
    for i, e in enumerate(suite):
        c = F.col(e.column)
        if e.kind in ("unique", "unique_share"):
            grouped.setdefault(e.column, []).append(e)
            continue
        bad = {"not_null": c.isNull(), "in_set": ~c.isin(*e.values) if e.values else F.lit(False)}.get(e.kind, F.lit(False))
        if e.kind == "between":
            if e.low is not None:
                bad = bad | (c < F.lit(e.low))
            if e.high is not None:
                bad = bad | (c > F.lit(e.high))
        aggs += [F.count(F.when(bad, 1)).alias(f"bad{i}"), F.count(c).alias(f"n{i}")]
        n = F.col("rows") if e.kind == "not_null" else F.col(f"n{i}")
        simple.append(row(e, n, F.col(f"bad{i}"), (F.col(f"bad{i}") == 0) if e.mostly >= 1 else (F.col(f"bad{i}") <= n * (1 - e.mostly))))
    parts = [df.agg(*aggs).select(F.inline(F.array(*simple)))] if simple else []
    for column, asked in grouped.items():
        groups = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        one = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("d"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("twice"))
        share = F.when(F.col("n") == 0, 1.0).otherwise(F.col("d") / F.col("n"))
        rows = [row(e, F.col("n"), F.col("twice") if e.kind == "unique" else F.col("n") - F.col("d"), F.col("twice") == 0 if e.kind == "unique" else share.between(float(e.low if e.low is not None else 0.0), float(e.high if e.high is not None else 1.0))) for e in asked]
        parts.append(one.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts).orderBy("__at").drop("__at")  # one row an expectation


class GateFailed(RuntimeError):
    pass


def gate(df: DataFrame, suite: list[Expectation], path: str | None = None) -> DataFrame:
    """Run the suite, append the results to path if given, then raise GateFailed if an expectation failed."""
    results = run_suite(df, suite)
    if path:
        results.withColumn("checked_at", F.current_timestamp()).write.mode("append").parquet(path)
    failed = [f"{r.expectation}({r.column_name}): {r.unexpected_count}" for r in results.filter(~F.col("success")).collect()]
    if failed:
        raise GateFailed("; ".join(failed))
    return results


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Combinations of keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of child whose non-null key isn't in parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key or key).alias(key)).distinct(), key, "left_anti")


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter(~F.col(column).between(low, high))


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, values) of the columns with fewer than two different values."""
    one = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "n_values").filter("n_values < 2")


def label_mismatches(df: DataFrame, score: str, label: str, band: float) -> DataFrame:
    """Rows whose label isn't the one its score stands for."""
    want = F.when(F.col(score) > band, "positive").when(F.col(score) < -band, "negative").otherwise("neutral")
    return df.filter(F.col(label).isNotNull() & F.col(score).isNotNull() & (F.col(label) != want))


def freshness(df: DataFrame, column: str, as_of, warn_hours: float = 12, error_hours: float = 48) -> DataFrame:
    """(last, age_hours, state): state ok, warn, error, or error on an empty table."""
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.max(column))) / 3.6e9
    out = df.agg(F.max(column).alias("last"), age.alias("age_hours"))
    return out.withColumn("state", F.when(F.col("last").isNull() | (F.col("age_hours") > error_hours), "error").when(F.col("age_hours") > warn_hours, "warn").otherwise("ok"))
