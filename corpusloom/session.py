"""Session construction, the shared working folder and the skew-safe join."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How many ways a possibly hot join key is split.
DEFAULT_SALTS = 8


def build_session(master: str | None = None, app: str = "corpusloom", **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` entries win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one disk, may fall back to a
    temporary folder of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="corpusloom-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_dir(spark)}/corpusloom-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other job uses."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths in any file system that Spark reads, by one listing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def claim_path(spark: SparkSession, pattern: str, content: str) -> bool:
    """Create a file with a short text; whether it is this call that created it.

    Of several callers exactly one succeeds: a store creates the file only if it is absent.
    """
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(sc._jsc.hadoopConfiguration())
    system.mkdirs(path.getParent())
    local = system.getScheme() == "file"  # whose create() looks first and creates then
    if local and not jvm.java.io.File(path.toUri().getPath()).createNewFile():
        return False
    try:
        out = system.create(path, local)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(content, "utf-8"))
    out.close()
    return True


def clear_scratch(spark: SparkSession) -> bool:
    """Delete all that this application has stored in between; whether there was any.

    The owner of a job calls it once its results are written: frames that read stored tables
    are lazy, so no operator can know when the last reader is done.
    """
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    folder = jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    return folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``codec`` is for tables whose size on disk counts.

    Later readers prune columns, a lost executor costs a re-read instead of a recompute, and
    a frame used several times is computed once.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``materialize`` for tables that nothing reads after the block: they are deleted at its end.

    What leaves the block has to be stored on its own.
    """
    folder = fresh_path(spark, "working")

    def store(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    try:
        yield store
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: list[str],
    how: str = "left",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Equi-join where one ``on`` value may hold a large share of the left rows.

    Left rows of one key are spread over ``salts`` partitions by the hash of their ``spread``
    columns; the right side, the smaller one, is repeated once per salt. Spark may still
    broadcast the right side when its measured size allows.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError("only the left side may be hot, so its rows decide the result")
    salt = "_salt"
    salted_left = left.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    salted_right = right.withColumn(
        salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted_left.join(salted_right, on + [salt], how).drop(salt)
