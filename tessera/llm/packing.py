"""Conflict-constrained best-fit packing of documents into sequences.

Documents are cut into whole sequences of ``capacity`` words (each a bin of
its own) and a rest.  Rests are dealt by hash into packing groups of about
``GROUP`` documents, which are packed independently, largest first: a rest
goes to the bin with the smallest residual that holds it, if that bin has no
document of its source and none of its duplicate cluster, else the search
goes on to the next bin in the order of residuals, and a new bin is opened
only when no open bin is compatible.  A bin carries its sources and clusters
as bitmaps; bins of one residual are kept by source bitmap, so that a hot
source is passed over in one step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import ASCII_LOWER, per_batch
from tessera.session import cut_lineage

CAPACITY = 1024
GROUP = 4096


def best_fit(sizes, sources, clusters, capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, in the order given (sizes from 1 to
    ``capacity``); equal residuals: the bin opened first.  Sources and
    clusters are bitmaps (0: none)."""
    fill, cluster_bits = [], []
    by_residual: dict[int, dict[int, list[int]]] = {}  # residual -> source bitmap -> bins
    present = 0  # bit r: there is an open bin of residual r
    where, offset = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        found, r = -1, size - 1
        above = present >> size
        while above:
            step = (above & -above).bit_length()
            r += step
            above >>= step
            found = min((next((b for b in bins if not cluster_bits[b] & cluster), 1 << 60)
                         for held, bins in by_residual[r].items() if not held & source), default=1 << 60)
            if found < 1 << 60:
                break
        else:
            found = -1
        if found < 0 or found == 1 << 60:
            found, r, held = len(fill), capacity, 0
            fill.append(0)
            cluster_bits.append(0)
        else:
            shelf = by_residual[r]
            held = next(h for h, bins in shelf.items() if not h & source and found in bins)
            shelf[held].remove(found)
            if not shelf[held]:
                del shelf[held]
                if not shelf:
                    present &= ~(1 << r)
        where.append(found)
        offset.append(fill[found])
        fill[found] += size
        cluster_bits[found] |= cluster
        left = r - size
        if left:
            shelf = by_residual.setdefault(left, {})
            bins = shelf.setdefault(held | source, [])
            # opened first comes first
            bins.insert(int(np.searchsorted(bins, found)) if bins else 0, found)
            present |= 1 << left
    return where, offset


def _bitmaps(values, only_repeated: bool) -> list[int]:
    """One bit per distinct value; none for null (or, if so asked, for values
    that occur once)."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    bit, out = {}, []
    for v in values:
        if v is None or v != v or only_repeated and seen[v] < 2:
            out.append(0)
        else:
            out.append(1 << bit.setdefault(v, len(bit)))
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", group_rows: int = GROUP) -> DataFrame:
    """One row per piece of a document: id, ``piece`` (from 0), ``start``
    (its first word in the document), ``n_tokens`` (white-space separated
    words), ``bin`` and ``bin_offset``.

    A document's duplicate cluster is that of equal texts (A-Z lower-cased).
    Null and empty texts, which have no words, give one row without a bin.  A
    null source is in conflict with none.  Null ids and repeated rows are
    packed like others.  Other columns are not read.
    """
    def measure(b):
        n, c = [], []
        for t in b["text"].to_pylist():
            n.append(len((t or "").split()))
            c.append(xxhash.xxh3_64_intdigest((t or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER)))
        return {"id": b["id"], "source": b["source"], "n": pa.array(n, pa.int64()),
                "cluster": pa.array(np.array(c, np.uint64).view(np.int64))}

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                    F.col(text_col).alias("text"))
    rows = cut_lineage(d.mapInArrow(per_batch(measure), "id long, source string, n long, cluster long"), "sizes")
    groups = max(1, -(-rows.count() // group_rows))
    g = F.pmod(F.xxhash64("id", "cluster", F.lit(17)), F.lit(groups)).cast("long")
    rows = rows.withColumns({"g": g, "whole": F.floor(F.col("n") / capacity).cast("long"), "rest": F.col("n") % capacity})

    def pack_group(t):
        t = t.sort_values(["rest", "id", "cluster"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        part = t[t["rest"] > 0]
        sources = [None if isinstance(s, float) else s for s in part["source"]]
        where, offset = best_fit(part["rest"].tolist(), _bitmaps(sources, False),
                                 _bitmaps(part["cluster"].tolist(), True), capacity)
        base, out = int(t["g"].iloc[0]) << 32, []
        used = max(where, default=-1) + 1
        for i, whole in zip(t["id"], t["whole"]):
            for k in range(int(whole)):
                out.append((i, k, k * capacity, capacity, base + used, 0))
                used += 1
        for i, whole, rest, b, o in zip(part["id"], part["whole"], part["rest"], where, offset):
            out.append((i, int(whole), int(whole) * capacity, int(rest), base + b, o))
        out += [(i, 0, 0, 0, None, None) for i in t.loc[t["n"] == 0, "id"]]
        import pandas as pd
        frame = pd.DataFrame(out, columns=["id", "piece", "start", "n_tokens", "bin", "bin_offset"])
        return frame.astype({c: "Int64" for c in frame.columns})

    packed = rows.groupBy("g").applyInPandas(
        pack_group, "id long, piece long, start long, n_tokens long, bin long, bin_offset long")
    return packed.withColumnRenamed("id", id_col)
