"""Session helpers: the shared work folder and a local session for tests."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (also under Spark Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect sessions expose no SparkContext
        return spark.conf.get("spark.app.id", None) or f"session-{id(spark)}"


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the configuration is visible
        return spark.conf.get("spark.checkpoint.dir", None) or None
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    return None


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:
        return (spark.conf.get("spark.master", "") or "").startswith("local")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for row logs, replay files and stream checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir``.  Only
    when the session has none (local runs, tests) do we make one.
    """
    d = _configured_checkpoint_dir(spark)
    if d is None:
        if not _is_local(spark):
            # A machine-local folder would not survive a lost executor or be
            # visible to other nodes: refuse instead of guessing.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="pulse-work-")
        try:
            spark.sparkContext.setCheckpointDir(d)
            d = spark.sparkContext.getCheckpointDir()
        except Exception:
            pass
    return d


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Compute ``df`` once into a parquet table in the shared work folder.

    For an expensive input that a plan reads twice (e.g. a rank needs the
    input for its histogram and again to join the ranks back).  The written
    table cuts the lineage and survives lost executors; it is never a
    machine-local copy.  One job writes it; readers scan the files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, f"mat-{name}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the work folder (never reused, never cleared)."""
    base = work_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path: any store that Spark writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, p = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Renames a written folder to a name that readers look for; fails if that is taken."""
    fs, src = _file_system(spark, staged)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise RuntimeError(f"{target} is there already or cannot be written")


def local_session(cores: int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench: local mode, UTC, AQE on, no UI."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pulse")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
