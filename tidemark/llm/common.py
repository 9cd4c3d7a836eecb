"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the corpus contracts: runs of anything but the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: Rows of an Arrow batch of texts; a few MB.
BATCH_ROWS = 1000
#: Most rows of keys and decisions that are handed to every executor, so that texts need no shuffle; some 50 bytes each.
BROADCAST_ROWS = 1_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a session in local mode names none (tests, notebooks) a temporary one is
    set on the context, once.  On a cluster the setting is needed: a folder of one
    machine would be missed by the others.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
    return sc.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with a table that survives lost executors, and lets later
    steps read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the table of a ``materialise`` that nothing reads any more; ``df`` is what that returned."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of each query go when it has ended, not when the driver's memory is next cleared."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a table of narrow rows, marked for broadcast if it has at most ``most`` rows; else joined as Spark sees fit."""
    return F.broadcast(df) if df.count() <= most else df


def spread(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """``df`` dealt out to all cores if the scan of ``source`` (by itself: of ``df``) has rows in fewer tasks than there are cores.

    A file of one row group is one task, whatever is done with its texts.  Where there are as
    many files as cores nothing is asked or shuffled; else one pass over footers tells.
    """
    source = df if source is None else source
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(source.inputFiles()) >= cores or source.select(F.spark_partition_id().alias("p")).distinct().count() >= cores:
        return df
    return df.repartition(cores)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``, or an empty one where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def pick(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator reads, under its own names; null text counts as empty.

    Any further column of ``df``, whatever its name, is left behind.  The session's Arrow
    batches are cut to ``BATCH_ROWS``: rows of whole texts are long, and a batch is held
    by the JVM and by the Python worker at once.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *(F.col(c).alias(c) for c in more),
    )


def blocks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of consecutive rows whose sizes add up to about ``most``."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def text_blocks(column: pa.Array, most: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(i, j, UTF-8 texts of rows i to j) of an Arrow column of strings, about ``most`` bytes at a time.

    Only one block's texts are Python objects at once, whatever the batch holds.
    """
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for i, j in blocks(sizes, most):
        yield i, j, [x or b"" for x in column.slice(i, j - i).cast(pa.binary()).to_pylist()]
    pa.default_memory_pool().release_unused()


def decoded(texts: list[bytes]) -> list[str]:
    """Python strings; broken UTF-8 becomes U+FFFD."""
    return [t.decode("utf-8", "replace") for t in texts]
