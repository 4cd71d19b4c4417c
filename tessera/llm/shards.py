"""Sharding by fixed virtual slots.

Every record is hashed into one of thousands of slots.  A slot-to-shard map
says which shard holds a slot; it is a table with a version, and rebalancing
writes a new version in which some slots are moved.  Balancing needs only the
bytes and rows per slot, an aggregate of as many rows as there are slots.
The sizes of the shards are made near equal (law ``bytes``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096


def with_slot(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, vslot)`` of every row.  The size is the
    UTF-8 bytes of the text (none if null) and 1.  The slot hashes the id and
    the text's checksum, so that rows of one id (or none) are spread."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    d = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + 1).cast("bigint").alias("size"),
                    F.crc32(raw).alias("text_crc32"))
    return d.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_loads(rows: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows of each slot (``slots`` rows come to the driver)."""
    size, count = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        size[r["vslot"]], count[r["vslot"]] = r["b"], r["n"]
    return size, count


def rebalanced(shard_of: np.ndarray, size: np.ndarray, shards: int) -> np.ndarray:
    """An edited map: between the heaviest shard and each lighter one, the
    move or swap of slots that comes nearest to evening them out, until none
    makes the heavier one of the two lighter."""
    out = shard_of.copy()
    load = np.bincount(out, weights=size, minlength=shards).astype(np.int64)
    while True:
        heavy = int(load.argmax())
        mine = np.flatnonzero((out == heavy) & (size > 0))
        done = True
        for light in np.argsort(load, kind="stable"):
            gap = int(load[heavy] - load[light])
            if gap <= 1:
                break
            theirs = np.flatnonzero((out == light) & (size > 0))
            # give a slot for one of theirs, or for nothing
            back = np.r_[0, np.sort(size[theirs])]
            names = np.r_[-1, theirs[np.argsort(size[theirs], kind="stable")]]
            want = size[mine] - gap / 2
            at = np.searchsorted(back, want)
            options = np.stack([np.clip(at - 1, 0, len(back) - 1), np.clip(at, 0, len(back) - 1)])
            moved = size[mine] - back[options]
            ok = (moved > 0) & (moved < gap)
            if not ok.any():
                continue
            off = np.where(ok, np.abs(moved - gap / 2), np.inf)
            side, k = np.unravel_index(off.argmin(), off.shape)
            amount, other = int(moved[side, k]), int(names[options[side, k]])
            out[mine[k]] = light
            if other >= 0:
                out[other] = heavy
            load[heavy] -= amount
            load[light] += amount
            done = False
            break
        if done:
            return out


def grown(shard_of: np.ndarray, size: np.ndarray, shards: int) -> np.ndarray:
    """An edited map for ``shards`` shards, one more than before, that moves
    slots into the new shard only: from the heaviest shard that can, the
    largest slot that still leaves the new one the lighter, until none can."""
    out, new = shard_of.copy(), shards - 1
    load = np.bincount(out, weights=size, minlength=shards).astype(np.int64)
    while True:
        for heavy in np.argsort(-load[:new], kind="stable"):
            fit = np.flatnonzero((out == heavy) & (size > 0) & (load[new] + size <= load[heavy] - size))
            if len(fit):
                break
        else:
            return out
        k = fit[size[fit].argmax()]
        out[k] = new
        load[heavy] -= size[k]
        load[new] += size[k]


def store_map(spark: SparkSession, path: str, version: int, shard_of: np.ndarray) -> None:
    """Write a version of the map; versions are never changed."""
    rows = [(i, int(s)) for i, s in enumerate(shard_of)]
    spark.createDataFrame(rows, "vslot int, shard int").coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """A version of the map: ``(vslot, shard)``, as many rows as slots."""
    return spark.read.schema("vslot int, shard int").parquet(f"{path}/version={version}")


def assign(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
           slots: int = SLOTS) -> DataFrame:
    """Every row's shard: ``doc_id``, ``size``, ``text_crc32``, ``law``,
    ``shard`` (0 to shards - 1), ``slot`` (its place in the shard, gapless
    from 0), ``grown_shard`` (null: the law is ``bytes``) and ``vslot``.

    Version 1 of the map in ``path`` deals the slots out in turn, version 2
    is rebalanced to the bytes found; the result follows version 2 as stored.
    A null text has size 1; null ids and repeated rows are rows like others
    (equal rows share a slot); an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = with_slot(docs, id_col, text_col, slots)
    size, count = slot_loads(rows, slots)
    first = np.arange(slots) % shards
    store_map(spark, path, 1, first)
    store_map(spark, path, 2, rebalanced(first, size, shards))
    chosen = load_map(spark, path, 2)
    shard_of = np.zeros(slots, np.int64)
    for r in chosen.collect():
        shard_of[r["vslot"]] = r["shard"]
    # first place of each slot in its shard
    place = np.zeros(slots, np.int64)
    for s in range(shards):
        mine = np.flatnonzero(shard_of == s)
        place[mine] = np.cumsum(count[mine]) - count[mine]
    table = spark.createDataFrame([(i, int(shard_of[i]), int(place[i])) for i in range(slots)],
                                  "vslot int, shard int, place long")
    in_slot = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32")
    return (rows.withColumn("__n", F.row_number().over(in_slot) - 1).join(F.broadcast(table), "vslot")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("place") + F.col("__n")).cast("bigint").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "vslot"))
