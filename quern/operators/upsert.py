"""Upserts on plain Parquet, and the CSV export."""

from __future__ import annotations

import csv
import datetime as dt
import io
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(target: DataFrame, source: DataFrame, key: list[str], update: list[str]) -> DataFrame:
    """target after an upsert: new keys are added whole, of known keys only the columns in `update` are taken from source.

    Source rows of one key collapse to one first (the greatest by all its columns), so the join can't fan out. Columns that source lacks
    stay as they are, or null in new rows. The result has target's columns.
    """
    cols = [c for c in source.columns if c in target.columns]
    one = source.groupBy(*key).agg(F.max(F.struct(*[F.col(c) for c in cols if c not in key])).alias("__new")) if len(cols) > len(key) else source.select(*key).distinct().withColumn("__new", F.struct())
    both = target.withColumn("__old", F.lit(True)).join(one.withColumn("__hit", F.lit(True)), key, "full_outer")
    known = F.col("__old").isNotNull()
    out = []
    for c in target.columns:
        if c in key:
            out.append(F.col(c))
        elif c not in cols:
            out.append(F.col(c))
        elif c in update:
            out.append(F.when(F.col("__hit").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(known, F.col(c)).otherwise(F.col(f"__new.{c}")).alias(c))
    return both.select(*out)


def new_keys(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    return source.select(*key).distinct().join(target.select(*key), key, "left_anti")


def write_merged(target_path: str, source: DataFrame, key: list[str], update: list[str]) -> int:
    """Upsert into a Parquet table: the merged rows are written beside it and swapped in. Returns the number of new keys."""
    spark = source.sparkSession
    target = spark.read.parquet(target_path)
    added = new_keys(target, source, key).count()
    jvm = spark._jvm
    path, new, old = (jvm.org.apache.hadoop.fs.Path(target_path + x) for x in ("", ".new", ".old"))
    merge_rows(target, source, key, update).write.mode("overwrite").parquet(new.toString())
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    fs.rename(path, old)
    fs.rename(new, path)
    fs.delete(old, True)
    return added


def retained(df: DataFrame, column: str, as_of: dt.date, days: int = 90) -> DataFrame:
    """Rows of the last `days` days; rows without a time are kept."""
    return df.filter(F.col(column).isNull() | (F.col(column) >= F.lit(as_of - dt.timedelta(days=days))))


def format_cell(value: object, labels: dict[str, str] | None = None, yes: str = "yes", no: str = "no", most: int = 32_000) -> str:
    """A value as a spreadsheet cell: null empty, lists joined, texts trimmed, labels translated, long texts cut with a mark."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return yes if value else no
    if isinstance(value, (list, tuple)):
        return "; ".join(str(v) for v in value if v is not None)
    if isinstance(value, (float, Decimal)):
        return format(value, "f") if isinstance(value, Decimal) else repr(value)
    text = str(value).strip()
    text = (labels or {}).get(text, text)
    return text if len(text) <= most else text[:most] + " …[cut]"


def write_csv(df: DataFrame, path: str, headers: dict[str, str], delimiter: str = ",", labels: dict[str, str] | None = None) -> int:
    """One CSV file with a byte-order mark and the given headers, streamed partition by partition to the driver's disk."""
    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f, delimiter=delimiter, quoting=csv.QUOTE_MINIMAL)
        out.writerow(headers.values())
        for row in df.select(*headers).toLocalIterator():
            out.writerow([format_cell(v, labels) for v in row])
            n += 1
    return n


def csv_text(rows: list[dict], headers: dict[str, str], delimiter: str = ",") -> str:
    buffer = io.StringIO()
    out = csv.writer(buffer, delimiter=delimiter, quoting=csv.QUOTE_MINIMAL)
    out.writerow(headers.values())
    out.writerows([[format_cell(r.get(k)) for k in headers] for r in rows])
    return buffer.getvalue()
