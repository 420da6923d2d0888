"""Spark session construction and cluster-aware helpers.

Everything in the library takes a ``SparkSession`` from the caller; this module
only offers a sensible builder for tests / bench and the checkpoint-directory
helper used by jobs that cut lineage.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: UTC so date/epoch maths is engine-independent,
# AQE for runtime coalescing, skew-join splitting and broadcast conversion
# (the size-checked broadcast: AQE only converts a join to broadcast when the
# materialised side is below the threshold, otherwise the sort-merge plan runs).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tradelens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/test session builder; on a cluster pass ``master=None``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the setting is absent in a local session (tests) a scratch folder is
    created and registered; on a cluster a folder of the driver's own would be
    invisible to the executors, so an absent setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="tradelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table location under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours in whatever store it is, through Spark's Hadoop client."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Actions begun inside remove their shuffle files when they end. Meant for actions whose rows
    are on disk afterwards: otherwise the files of every action stay until the driver happens to
    collect garbage, and a job of several writes holds the shuffles of all of them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    if not eager:
        return df.checkpoint(eager=False)
    with shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint()      # planned inside


def stored(df: DataFrame | Iterable[DataFrame], name: str = "stored") -> DataFrame:
    """Lineage cut by a compressed Parquet table in the shared folder: a fraction of what a
    checkpoint of the same rows writes, and its readers open only the columns they use. Of
    several frames (see ``in_part``) one is written after the other."""
    parts = [df] if isinstance(df, DataFrame) else list(df)
    spark = parts[0].sparkSession
    return write_parts(parts, scratch_path(spark, f"{name}-{uuid.uuid4().hex}"))


def write_parts(parts: Iterable[DataFrame], path: str) -> DataFrame:
    """Frames of one schema written to one new folder, one after the other, so that only one
    part's shuffles are on disk at a time; the folder read."""
    schema = spark = None
    for part in parts:
        spark, schema = part.sparkSession, schema or part.schema
        with shuffles_removed(spark):
            part.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


# Rows whose shuffles a job of several parts holds on disk at a time.
ROWS_PER_PART = 32_000_000


def number_of_parts(rows: int) -> int:
    """Parts for a job that reads so many rows."""
    return max(1, -(-rows // ROWS_PER_PART))


def in_part(key: Column, part: int, parts: int) -> Column:
    """Whether a row belongs to a part, by the hash of what must stay together. The seed is not
    that of a shuffle, whose partitions would otherwise stay empty in a part."""
    return F.lit(True) if parts == 1 else F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts)) == part


# Rows that a shuffle partition of a sort or an aggregate should get at most.
ROWS_PER_PARTITION = 200_000


@contextmanager
def partitions_for(spark: SparkSession, rows: int, most: int = ROWS_PER_PARTITION):
    """Shuffles of the actions inside start from as many partitions as ``rows`` ask for (``most`` rows
    each), if that is more than the session's; adaptive execution joins those that turn out small. A
    fixed number lets a partition, and what its sort spills, grow with the table."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    least = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(key, str(max(least, -(-rows // most))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none for a folder that does not exist."""
    p, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_small(spark: SparkSession, path: str) -> str:
    """A small file of ours (a manifest, a pointer) as text."""
    p, fs = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is seen whole or not at all: written aside, then renamed. A name
    that is taken raises ``FileExistsError``."""
    aside = os.path.join(os.path.dirname(path), f"_aside-{uuid.uuid4().hex}")
    p, fs = _file_system(spark, aside)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs.exists(to) or not fs.rename(p, to):
        fs.delete(p, False)
        raise FileExistsError(path)
