"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Where a local session without ``spark.checkpoint.dir`` keeps its intermediate tables.
LOCAL_SHARED_DIR = "/tmp/checkpoints"


def build_session(app: str = "tallyframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots.

    Partition counts are left to the cluster (``spark.sql.shuffle.partitions``) and
    coalesced or split at run time by adaptive execution.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it uses ``LOCAL_SHARED_DIR``.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = LOCAL_SHARED_DIR
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/tallyframe/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


_scratch = threading.local()


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Delete at the end what ``staged`` writes inside, in this thread, but for tables taken off the list."""
    outer, _scratch.tables = getattr(_scratch, "tables", None), []
    tables = _scratch.tables
    try:
        yield tables
    finally:
        _scratch.tables = outer
        for table in tables:
            discard(table)


def keep(tables: list[DataFrame], table: DataFrame) -> DataFrame:
    """Take a staged table off the list of ``scratch``."""
    tables[:] = [t for t in tables if t is not table]
    return table


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query made inside as soon as it has ended, not when the driver collects garbage.

    For work in many steps, each written by ``staged``: what is executed twice inside must be a stored table.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def staged(df: DataFrame, name: str, by: str | None = None, buckets: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    For results that several later passes scan: the passes prune columns, and a lost
    executor costs a re-read and not a recomputation. The files go when the session's
    JVM ends, or earlier through ``discard``. With ``by``, the table is in that many buckets by this
    column, so that grouping or joining by it later moves no row of the table.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if by:
        # only a table of the catalog can be bucketed; what was read of an external one outlives its name
        table = re.sub(r"\W", "_", path.rsplit("/", 1)[1])
        df.write.format("parquet").bucketBy(buckets, by).option("path", path).saveAsTable(table)
        out = spark.table(table)
        spark.sql(f"DROP TABLE {table}")
    else:
        df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    files, where = _file_system(spark, path)
    files.deleteOnExit(where)
    out.staged_path = path
    if getattr(_scratch, "tables", None) is not None:
        _scratch.tables.append(out)
    return out


#: Rows of a file that can have numbers of their own in ``numbered``.
FILE_ROWS = 1 << 40


def numbered(df: DataFrame, name: str, stored: bool = False) -> DataFrame:
    """row, whole: every row with a number that is the same in each later scan.

    With ``stored``, which says that ``df`` has each row of some Parquet files at most once, a row is numbered by its file and its place
    there, and none is written. Other rows are numbered and written, as each scan would number them its own way.
    """
    whole = F.struct(*df.columns).alias("whole")
    if stored:
        try:
            placed = df.select(whole, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
        except AnalysisException:  # no rows of files
            stored = False
    if not stored:
        return staged(df.select(whole, F.monotonically_increasing_id().alias("row")), name)
    # one row per file
    files = placed.select("file").distinct().select("file", (F.row_number().over(Window.orderBy("file")) * F.lit(FILE_ROWS)).alias("from"))
    return placed.join(F.broadcast(staged(files, f"{name}-files")), "file").select("whole", (F.col("from") + F.col("at")).alias("row"))


def discard(df: DataFrame) -> None:
    """Delete the files of a ``staged`` table that nothing will read again."""
    files, where = _file_system(df.sparkSession, df.staged_path)
    files.delete(where, True)
