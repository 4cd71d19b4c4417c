"""Materialised feature tables and model persistence."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tessera.session import checkpoint_dir, cut_lineage


def plan_fingerprint(df: DataFrame) -> str | None:
    """A hash of what ``df`` computes: its optimized plan without generated
    ids, and path, size and time of every input file.  ``None`` where a plan's
    text does not tell all: other leaves than files, and user-defined code."""
    spark = df.sparkSession
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    if any(leaves.apply(i).getClass().getSimpleName() != "LogicalRelation" for i in range(leaves.size())):
        return None
    limit = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(2 ** 31 - 1))  # else long lists are cut off
    try:
        text = plan.canonicalized().toString()
    finally:
        spark.conf.set(limit, before)
    if re.search("UDF|Python|Pandas|Arrow|MapPartitions|MapElements", text):
        return None
    h = hashlib.sha256(text.encode())
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    for f in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(f)
        status = path.getFileSystem(conf).getFileStatus(path)
        h.update(f"\n{f} {status.getLen()} {status.getModificationTime()}".encode())
    return h.hexdigest()


def materialize(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write a feature table once and continue from the written copy.

    Without ``root`` the copy is a scratch table of this application.  With it
    the table is kept as ``root/name/<fingerprint>``: a later call of the same
    name whose plan and inputs have the same :func:`plan_fingerprint` reads it
    and runs no write, a changed one writes anew.  The committer's marker says
    that a table is whole, so what a lost run left behind is written again.  A
    plan without a fingerprint is written at every call."""
    if root is None:
        return cut_lineage(df, name)
    spark = df.sparkSession
    known = plan_fingerprint(df)
    path = os.path.join(root, name, known or f"run-{uuid.uuid4().hex}")
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))
    if not marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_models(models: Sequence, root: str | None = None, spark=None) -> list[str]:
    """Save each fold model under ``root/fold_<i>``; returns the paths."""
    if root is None:
        root = os.path.join(checkpoint_dir(spark), f"models-{uuid.uuid4().hex}")
    paths = []
    for i, m in enumerate(models):
        p = os.path.join(root, f"fold_{i}")
        m.write().overwrite().save(p)
        paths.append(p)
    return paths


def load_models(model_class, paths: Sequence[str]) -> list:
    return [model_class.load(p) for p in paths]
