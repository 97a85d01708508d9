"""Session settings shared by every plan.

All plans are plain DataFrame code, so the settings below are the only
place where execution behaviour is tuned:

* ANSI mode on: a bad strict cast fails the job the way the source data
  contract expects; every lenient parse in this package uses ``try_*``.
* Session time zone UTC: instants are stored in UTC; New York wall-clock
  times are built with ``make_timestamp(..., 'America/New_York')``.
* AQE on, with skew-join splitting and runtime broadcast conversion. Joins
  whose small side is derived from data carry no static hint: AQE measures
  the materialised side and broadcasts it only below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it the join stays
  a sort-merge join. Static hints are used only for tables whose size is
  fixed by construction (embedded constants, code tables).
* Dynamic partition overwrite, so writing a subset of dates replaces only
  those date partitions.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with the package defaults.

    On a cluster, pass ``master=None`` and let the launcher decide; the
    shuffle partition count then defaults to Spark's own setting and AQE
    coalesces small partitions at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if not k.startswith(("spark.driver.", "spark.ui.")):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Lineage is cut by writing there (``checkpoint()`` or a parquet table). Where
    the setting is missing, a session inside one process gets a folder of its own, as in
    tests; on a cluster that is an error, as executors share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A path in the shared folder for what is only needed inside."""
    place = f"{checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    try:
        yield place
    finally:
        discard(spark, place)


def discard(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """The settings, written with ``__`` for a dot, hold inside; then those of before again."""
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """What is made and run inside leaves no shuffle files: they go when their job ends, not when the driver collects its garbage."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def joins_by_hash(spark: SparkSession) -> AbstractContextManager[None]:
    """Joins inside need no sort where the partitions of one side are as small as Spark makes them, by their measured sizes.

    Partitions that one key makes large are split, also where a second join on the same key follows.
    """
    return settings(spark, spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold=spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"),
                    spark__sql__adaptive__forceOptimizeSkewedJoin="true")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder; later reads do not compute it again."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
