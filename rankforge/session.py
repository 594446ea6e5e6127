"""Session helpers: a local builder for tests and the bench, and lineage cutting.

On a cluster the session comes from the caller; nothing here overrides its
settings.  ``materialize`` cuts lineage with a table written to the folder the
cluster names in ``spark.checkpoint.dir``.  Where that is unset, a local master
(tests, bench) gets a folder of its own; on any other master it is an error,
because executors could not read it.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "16g", app: str = "rankforge") -> SparkSession:
    """Builder used by tests and bench.py (never by library code)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in _LOCAL_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        return d
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rankforge-"))
    return sc.getCheckpointDir()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession):
    """Actions inside delete their shuffle files when they end, instead of when the driver next collects garbage.

    The caller's setting is put back.  A plan run again makes its shuffles again.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` once as a table in the shared folder and read it back.

    The rows survive lost executors and every reader gets the same ones.  A
    written table is preferred to ``checkpoint()``: the planner knows its size,
    while a checkpoint keeps the estimate of the plan it cuts, which in a loop
    grows with every join.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` has written and nothing reads any more."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if re.fullmatch(r"table-[0-9a-f]{32}", path.rsplit("/", 1)[-1]):
                where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
