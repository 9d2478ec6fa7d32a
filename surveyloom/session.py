"""Session settings, staged tables and size-checked lookup joins."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A lookup is broadcast only when its counted rows fit this bound (about 40 MB of names) and, where it
# was written for the join, its file bytes fit theirs.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 8 << 20
# Beyond it the lookup is shuffled, with every key cut into this many slices.
LOOKUP_SLICES = 16

_FOLDERS: set[str] = set()
SPLITS = "spark.sql.files.minPartitionNum"

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when a later aggregate then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are planned for.

    Files are split alike for the whole session, also after executors are lost, so that row numbers
    drawn from one table in several jobs agree.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(SPLITS, None) is None:
        spark.conf.set(SPLITS, str(max(1, spark.sparkContext.defaultParallelism)))
    return spark


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's checkpoint folder.

    Only a local session without one gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="surveyloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def staged_folder(spark: SparkSession) -> str:
    """Folder of this application's staged tables; it goes when the driver's program ends."""
    folder = f"{staging_root(spark).rstrip('/')}/surveyloom/{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = f"{staged_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(table: DataFrame) -> None:
    """Delete the files of a table that ``stage`` wrote and that nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        _remove(table.sparkSession, folder)


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """A written table and its row count, which the write itself observes; retries may count rows twice."""
    seen = Observation()
    table = stage(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return table, seen.get["n"]


def file_bytes(table: DataFrame) -> int:
    """Size of the files of a written table."""
    return int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def sliced(df: DataFrame, slices: int, column: str = "_slice") -> DataFrame:
    """Number every row with a slice that depends on its content only, so retries agree."""
    hashable = [F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind]
    return df.withColumn(column, F.pmod(F.xxhash64(*hashable), F.lit(slices)))


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    keys: Iterable[str],
    how: str = "left",
    null_safe: Iterable[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Join a lookup table: broadcast within the row bound, sliced shuffle beyond it.

    ``rows`` is a known upper bound of the lookup's row count; without it the lookup is written
    once and counted as it is written, so it is not derived twice. Keys in ``null_safe``
    match NULL to NULL.
    """
    if rows is None:
        lookup, rows = stage_counted(lookup, "lookup")
        if file_bytes(lookup) > BROADCAST_BYTES:
            rows = max(rows, BROADCAST_ROWS + 1)
    keys, null_safe = list(keys), set(null_safe)
    right = lookup.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    condition = [
        F.col(k).eqNullSafe(F.col(f"_k_{k}")) if k in null_safe else F.col(k) == F.col(f"_k_{k}")
        for k in keys
    ]
    if rows <= BROADCAST_ROWS:
        left, right = df, F.broadcast(right)
    else:
        left = sliced(df, LOOKUP_SLICES)
        right = right.withColumn(
            "_k_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(LOOKUP_SLICES - 1).cast("long")))
        )
        condition.append(F.col("_slice") == F.col("_k_slice"))
    joined = left.join(right, condition, how)
    return joined.drop("_slice", "_k_slice", *[f"_k_{k}" for k in keys])
