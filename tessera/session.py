"""Session construction, table access and lineage cuts.

Every operator in the library is a pure function of DataFrames; this module
only holds the few things that touch the session itself.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  AQE re-plans joins with runtime sizes: a
# join side whose *measured* shuffle output is under the adaptive threshold is
# broadcast, anything larger stays a shuffle join, and skewed partitions of a
# shuffle join are split.  That is the size check behind every join-back in
# the library; explicit broadcast hints are only used for frames whose row
# count is bounded by construction (1-row statistics, k-row class tables).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let the launcher decide; the
    shuffle partition count should then be sized to the input (roughly
    input bytes / 128 MB), not left at a local default.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # reliable checkpoint files are removed once their RDD is unreferenced
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_scale_conf(spark)
    return spark


def apply_scale_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SCALE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings: keep the session's value
            pass


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver's file system client delete ``path`` when the
    application ends (a normal end; a killed driver leaves it behind)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to storage every executor can reach.
    Where it is unset, a folder below the home directory of the session's
    default file system is used; a default file system that is local to each
    machine is refused unless the master is ``local``.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        sc = spark.sparkContext
        fs = sc._jvm.org.apache.hadoop.fs.FileSystem.get(sc._jsc.hadoopConfiguration())
        home = fs.getHomeDirectory().toString()
        if home.startswith("file:"):
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share: "
                                 "the default file system is local to each machine")
            home = "file:" + os.path.abspath(spark.conf.get("spark.local.dir", "/tmp"))
        d = f"{home}/tessera-scratch-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", d)
        delete_at_exit(spark, d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, name: str | None = None, file_rows: int = 0) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    A written table survives executor loss (unlike cached blocks) and turns a
    long lineage into a plain scan with its own statistics.  It is deleted
    when the application ends.  With ``file_rows`` a file has at most so many
    rows, so that later scans can deal a table that few tasks wrote over all
    cores (a file of one row group is read by one task).
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{name or 'table'}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 256 * 1024 ** 2,
                  lo: int = 200, hi: int = 200_000) -> int:
    """Set ``spark.sql.shuffle.partitions`` for an input of ``input_bytes``
    (about one ``target_bytes`` partition per input slice) and let AQE
    coalesce small ones; scan splits use the same target.  Returns the
    partition count."""
    n = max(lo, min(hi, -(-int(input_bytes) // int(target_bytes))))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(int(target_bytes)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(int(target_bytes) // 2))
    return n
