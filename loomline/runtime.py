"""What operators share: staging through the cluster's shared folder, partition counts, size checks."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Input (as stored) per partition of an explicit repartition, and the number of partitions from which on they grow instead.
PARTITION_BYTES, MOST_PARTITIONS = 64 << 20, 100_000

_made: dict[str, tuple] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir`` if the session names one; a local one only where the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="loomline-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _remove(jvm, conf, path: str) -> None:
    try:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may be gone; the folder belongs to the cluster then
        pass


@atexit.register
def drop_staged() -> None:
    """Removes every staged table of this process."""
    for path, (jvm, conf) in list(_made.items()):
        _remove(jvm, conf, path)
        _made.pop(path, None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that is removed when the application ends."""
    path = f"{shared_folder(spark).rstrip('/')}/loomline-{name}-{uuid.uuid4().hex}"
    _made[path] = (spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration())
    return path


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Executions inside drop their shuffle files when they end; nothing that is written as a table needs them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    if before is None:
        yield
        return
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a compressed table into the shared folder and reads it back.

    This cuts the lineage and survives the loss of executors. The table lives until the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scope:
    """Tables staged inside a ``staging`` block; those kept outlive it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.before, self.kept = spark, set(_made), set()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        inside = set(_made)
        out = stage_table(df, name)
        self.kept |= set(_made) - inside
        return out


@contextmanager
def staging(spark: SparkSession) -> Iterator[Scope]:
    """Removes what is staged inside when the block ends."""
    scope = Scope(spark)
    try:
        yield scope
    finally:
        for path in set(_made) - scope.before - scope.kept:
            _remove(*_made.pop(path), path)


@contextmanager
def plain_unions(spark: SparkSession) -> Iterator[None]:
    """Plans made inside take no partitioning from unions.

    Spark 4.1 derives one from children that look alike; once adaptive execution has coalesced them differently, a join above fails
    ("PartitioningCollection requires all of its partitionings have the same numPartitions").
    """
    name = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(name, None)
    if before is None:
        yield
        return
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, as the optimiser knows them; 0 where it cannot tell."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    known = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in known if n < 1 << 60)


def shuffle_width(spark: SparkSession, *inputs: DataFrame) -> int:
    """Partitions that an explicit repartition of data made from ``inputs`` should have: the session's number, more where a partition would stand for over ``PARTITION_BYTES`` of input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")), min(MOST_PARTITIONS, -(-sum(map(input_bytes, inputs)) // PARTITION_BYTES)))
