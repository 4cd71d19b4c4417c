"""Exact dedup by progressive refinement (DataFrame functions only).

Documents are told apart by byte length, then by a hash of their first
characters, and only those that still share both with another one are read
in full and hashed with SHA-256.  Each refinement narrows the next by a slot
table: the distinct ``hash mod slots`` of the keys that occur more than
once.  It has at most ``slots`` rows, whatever the input, so it is broadcast
and no text is shuffled; two keys in one slot only mean some more full
hashes.  Equality is decided by length and SHA-256 alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import LOWER, UPPER, if_small, spread_key
from tessera.operators.keys import tmp_names
from tessera.session import cut_lineage

SLOTS = 1 << 18
PREFIX_CHARS = 64


def normalised(text):
    """The text with A-Z lower-cased; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _slots(df: DataFrame, key, slots: int) -> DataFrame:
    """Slots of the keys that occur more than once (at most ``slots`` rows)."""
    key = [F.col(k) for k in key]
    many = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return F.broadcast(many.select(F.pmod(F.xxhash64(*key), F.lit(slots)).alias("slot")).distinct())


def _with_digest(docs: DataFrame, text_col: str, prefix_chars: int, slots: int, report_all: bool) -> DataFrame:
    """``docs`` with ``len``, ``digest`` (null unless the text shares length
    and prefix hash with another) and, with ``report_all``, ``sha``."""
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0))
    sized = docs.withColumn("__len", size)
    by_len = _slots(sized.select("__len"), ["__len"], slots)
    head = F.xxhash64(normalised(F.substring(text, 1, prefix_chars)))
    near = (sized.join(by_len, F.pmod(F.xxhash64("__len"), F.lit(slots)) == by_len["slot"], "left_semi")
            .select("__len", head.alias("__head")))
    by_head = _slots(near, ["__len", "__head"], slots)
    full = F.sha2(normalised(text), 256)
    out = sized.withColumn("__head", head)
    out = out.join(by_head, F.pmod(F.xxhash64("__len", "__head"), F.lit(slots)) == by_head["slot"], "left")
    if report_all:
        out = out.withColumn("__sha", full)
        full = F.col("__sha")
    return out.withColumn("__digest", F.when(F.col("slot").isNotNull(), full)).drop("slot", "__head")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_of_all: bool = False,
                 prefix_chars: int = PREFIX_CHARS, slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id`` (largest id of the equal
    texts), ``group_size``, ``kept``, ``digest`` (hex SHA-256 of the
    normalised text; null where the refinement did not need it unless
    ``digest_of_all``) and ``n_bytes``.

    A null text is an empty text; equal empty texts form a group like any
    other.  A null id counts as the smallest; a group of null ids only has a
    null ``keep_id`` and all its rows are marked kept, as are repeated rows
    with the largest id (:func:`drop_copies` leaves one of them).  An empty
    table gives an empty result.  Other columns are not read.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keep = ["id", "__len", "__digest"] + (["__sha"] if digest_of_all else [])
    rows = cut_lineage(_with_digest(d, "text", prefix_chars, slots, digest_of_all).select(*keep), "digests")
    shared = rows.filter("__digest is not null")
    groups = (shared.groupBy("__digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .withColumn("__s", spread_key("__digest")))
    grouped = shared.withColumn("__s", spread_key("__digest")).join(groups, ["__digest", "__s"]).drop("__s")
    alone = (rows.filter("__digest is null").withColumn("keep_id", F.col("id"))
             .withColumn("group_size", F.lit(1).cast("bigint")))
    digest = F.col("__sha") if digest_of_all else F.col("__digest")
    return grouped.unionByName(alone).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        digest.alias("digest"), F.col("__len").cast("bigint").alias("n_bytes"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS, slots: int = SLOTS) -> DataFrame:
    """The rows of ``docs``, all columns, with one row left of each group of
    equal texts: that of the largest id (one of them where it is repeated).
    Nulls and empty tables as in :func:`exact_groups`.

    The rows to drop, and repeated kept rows, are joined back by id and full
    hash; that table is broadcast if it is small when written.
    """
    cols = docs.columns
    i, s, k, n, own = tmp_names(docs, "id", "sha", "kept", "n", "own")
    g = exact_groups(docs, id_col, text_col, False, prefix_chars, slots)
    touched = (g.filter("group_size > 1").groupBy(F.col(id_col).alias(i), F.col("digest").alias(s))
               .agg(F.first("kept").alias(k), F.count(F.lit(1)).alias(n)).filter(~F.col(k) | (F.col(n) > 1)))
    touched = if_small(cut_lineage(touched, "touched"), 250_000)
    d = docs.withColumn(own, F.sha2(normalised(F.col(text_col)), 256))
    j = d.join(touched, (d[own] == touched[s]) & d[id_col].eqNullSafe(touched[i]), "left")
    single = j.filter(F.col(k).isNull()).select(*[docs[c] for c in cols])
    repeated = j.filter(F.col(k)).dropDuplicates([id_col, own]).select(*[docs[c] for c in cols])
    return single.unionByName(repeated)
