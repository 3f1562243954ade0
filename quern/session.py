"""Session helpers: a session for local runs, table loading, and tables shared by all executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL_SHARED: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "quern") -> SparkSession:
    """A local session with the settings the library assumes (UTC, adaptive execution)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUERN_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table; zone-less timestamps become UTC instants (the session zone must be UTC)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ntz = {f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    return df.withColumns(ntz) if ntz else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a temporary one where that is unset (local runs)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SHARED:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _LOCAL_SHARED[app] = tempfile.mkdtemp(prefix="quern-shared-")
    return _LOCAL_SHARED[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quern-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int, limit_bytes: int = 32 << 20) -> DataFrame:
    """A broadcast hint where rows * row_bytes is within limit_bytes; else df as it is, for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= limit_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """A scan over at least as many partitions as there are cores, for work that costs far more than moving its rows.

    Nothing moves where the scan is already split that far, as any large table's is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: Python workers need not have it installed or on their path."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="quern-code-"), "quern-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*")):
            if f.suffix in (".py", ".json"):
                z.write(f, Path("quern") / f.relative_to(root))
    spark.sparkContext.addPyFile(archive)  # Spark's own file server carries it to every node
    _SHIPPED.add(app)


def clear_shared(spark: SparkSession) -> int:
    """Remove the tables that this package wrote to the shared folder; frames that read them can't be used afterwards. Returns their number."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "quern-*")) or []]
    for path in found:
        fs.delete(path, True)
    return len(found)
