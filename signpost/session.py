"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
# what right results hang on, in any session: zone-less stamps are UTC, the last of equal JSON members counts
REQUIRED = {"spark.sql.session.timeZone": "UTC", "spark.sql.variant.allowDuplicateKeys": "true"}
# folders a task writes at a time before it sorts the rest of its rows by folder
OPEN_FILES = ("spark.sql.maxConcurrentOutputFileWriters", "32")
# call sites in error messages cost more than half of the time in which plans of thousands of expressions are built; a session has to be started with this
QUICK = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results hang on and send the package to the workers. The readers and plans call it."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("signpost")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in (DEFAULTS | REQUIRED | QUICK).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """`folder` if given, else the one `spark.checkpoint.dir` names, else the checkpoint folder already set.

    Where nothing is set, a session of a single machine (tests, the bench) gets a folder of its own;
    any other master is an error, as its executors could not read a local folder.
    """
    sc = spark.sparkContext
    configured = folder or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="signpost-"))
    return os.path.dirname(sc.getCheckpointDir().rstrip("/"))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, so Python steps run whatever folder the driver was started from."""
    sc = spark.sparkContext
    if getattr(sc, "_signpost_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="signpost-"), "signpost_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._signpost_shipped = True


def file_system(spark: SparkSession, path: str) -> tuple[object, object]:
    """(file system, path) of Hadoop for a folder in any store Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    system, place = file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/signpost-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str, partitions: list[str] | None = None) -> DataFrame:
    """`df` written to the shared folder as Parquet and read back: pruned by column and by `partitions`."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if partitions:
        # a few open files per task; else a task sorts all of its rows, bodies included, by folder
        before = spark.conf.get(OPEN_FILES[0], None)
        spark.conf.set(*OPEN_FILES)
        try:
            df.write.partitionBy(*partitions).parquet(path)
        finally:
            spark.conf.unset(OPEN_FILES[0]) if before is None else spark.conf.set(OPEN_FILES[0], before)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder so later jobs see the same rows in the same partitions."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
