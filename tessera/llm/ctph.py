"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last WINDOW bytes ends a chunk wherever its low bits
are all zero; ``level`` zero bits mean chunks of about ``2 ** level`` bytes.
Where a chunk ends depends on the bytes around it alone, so an edit changes
the chunks it touches and no others.  A signature has SYMBOL bits of each
chunk's hash as two characters.  The level of a text is the smallest with at
most CHUNKS ends, counted, so that a signature is short for every text and
never cut off; the ends of a level are among those of the level below.

A fingerprint, ``size:signature:signature``, has the signatures of its block
size and of twice that size.  Two fingerprints are compared by the edit
distance of their chunk sequences at the smallest block size that both have;
if there is none, the texts are of different orders of length and have
nothing in common that the fingerprints can tell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import SLICE

WINDOW = 7
CHUNKS = 64
SYMBOL = 12
#: Bytes whose rolling hashes are computed at a time.
BLOCK = 1 << 20
DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-"
_PAIR = [a + b for a in DIGITS for b in DIGITS]
_VALUE = {c: i for i, c in enumerate(DIGITS)}
_STEP = np.uint32(0x9E3779B1)
#: Deals out the ids of at most so many ranges (a list of numbers on the driver).
MAX_RANGES = 10_000


def zero_bits(data: bytes) -> np.ndarray:
    """For each byte the number of low zero bits of the rolling hash of the
    WINDOW bytes that end with it (fewer at the start)."""
    x = np.frombuffer(data, np.uint8)
    out = np.empty(len(x), np.uint8)
    for s in range(0, len(x), BLOCK):
        lead = min(s, WINDOW - 1)
        part = x[s - lead:s + BLOCK].astype(np.uint32) + np.uint32(1)
        h, factor = part.copy(), _STEP
        for back in range(1, WINDOW):
            h[back:] += part[:-back] * factor if back < len(part) else 0
            factor = np.uint32(int(factor) * int(_STEP) & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h = h[lead:]
        low = h & (~h + np.uint32(1))
        out[s:s + BLOCK] = np.bitwise_count(low - np.uint32(1))
    return out


def _signature(data: bytes, ends: np.ndarray) -> str:
    """The symbols of the chunks that end behind the given bytes, and of what
    follows the last one."""
    at = ends.tolist()
    if not at or at[-1] != len(data) - 1:
        at.append(len(data) - 1)
    view, start, out, mask = memoryview(data), 0, [], (1 << SYMBOL) - 1
    for e in at:
        out.append(_PAIR[xxhash.xxh3_64_intdigest(view[start:e + 1]) & mask])
        start = e + 1
    return "".join(out)


def fingerprint(text: str | None) -> str:
    """The fingerprint of a text; null counts as empty, which has size 0 and
    empty signatures."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return "0::"
    zeros = zero_bits(data)
    # ends per level: those with that many zero bits or more
    ends = np.bincount(zeros, minlength=34)[::-1].cumsum()[::-1]
    level = int(np.argmax(ends <= CHUNKS))
    fine = np.flatnonzero(zeros >= level)
    return f"{1 << level}:{_signature(data, fine)}:{_signature(data, fine[zeros[fine] > level])}"


def _parsed(print_: str) -> tuple[int, str, str]:
    size, fine, coarse = print_.split(":")
    return int(size), fine, coarse


def _symbols(signature: str) -> list[int]:
    v = [_VALUE[c] for c in signature]
    return [64 * a + b for a, b in zip(v[::2], v[1::2])]


def _comparable(a: str, b: str) -> tuple[list[int], list[int]] | None:
    (n, fa, ca), (m, fb, cb) = _parsed(a), _parsed(b)
    if n == m:
        return _symbols(fa), _symbols(fb)
    if n and 2 * n == m:
        return _symbols(ca), _symbols(fb)
    if m and 2 * m == n:
        return _symbols(fa), _symbols(cb)
    return None


def edit_distances(pairs: list[tuple[list[int], list[int]]]) -> np.ndarray:
    """Levenshtein distances of pairs of sequences, all pairs a step at a time."""
    if not pairs:
        return np.zeros(0, np.int64)
    la, lb = (np.array([len(p[i]) for p in pairs]) for i in (0, 1))
    a = np.full((len(pairs), la.max() + 1), -1, np.int32)
    b = np.full((len(pairs), lb.max()), -2, np.int32)
    for i, (x, y) in enumerate(pairs):
        a[i, :len(x)], b[i, :len(y)] = x, y
    steps = np.arange(b.shape[1] + 1, dtype=np.int32)
    row = np.broadcast_to(steps, (len(pairs), len(steps))).copy()
    out = row[np.arange(len(pairs)), lb].copy()
    for i in range(la.max()):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        np.minimum(row[:, 1:] + 1, row[:, :-1] + (a[:, i:i + 1] != b), out=new[:, 1:])
        # an insertion costs one more than the cell to the left, all along the row
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        ended = la == i + 1
        out[ended] = row[ended, lb[ended]]
    return out


def likenesses(pairs: list[tuple[str, str]]) -> list[float]:
    """Likeness (0 to 1) of pairs of fingerprints: one less the edit distance
    of their comparable signatures over the longer one's length."""
    sides = [None if a == b else _comparable(a, b) for a, b in pairs]
    found = iter(edit_distances([s for s in sides if s]).tolist())
    return [(float(a == b) if s is None else 1 - next(found) / max(len(s[0]), len(s[1]), 1))
            for (a, b), s in zip(pairs, sides)]


def likeness(a: str, b: str) -> float:
    return likenesses([(a, b)])[0]


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text as column ``name``."""
    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype=object)

    return docs.withColumn(name, of(F.col(f"`{text_col}`")))


def _ranges(docs: DataFrame) -> tuple[list[float], DataFrame]:
    """Bounds that cut ``docs`` (``id``, ``text``) into ranges of ids, and the
    table ``(head, to)`` of the id with which each range begins in
    descending order and the id range before it (the first one's is the last)."""
    spark = docs.sparkSession
    n = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.approxQuantile("id", [i / n for i in range(1, n)], 0.25 / n)
    bounds = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    # one row per range, MAX_RANGES of them at most
    heads = [(r.part, r.id) for r in _parted(docs.select("id"), bounds).groupBy("part").agg(F.max("id").alias("id"))
             .orderBy(F.desc("part")).collect()]
    into = [(i, heads[k - 1][0]) for k, (_, i) in enumerate(heads)]
    return bounds, spark.createDataFrame(into, "head long, to int")


def _parted(docs: DataFrame, bounds: list[float]) -> DataFrame:
    """``docs`` with ``part``: the range of the id, 0 for null."""
    cut = Bucketizer(splits=bounds, inputCol="x", outputCol="part", handleInvalid="keep")
    out = cut.transform(docs.withColumn("x", F.coalesce(F.col("id").cast("double"), F.lit(float("-inf"))))).drop("x")
    return out.withColumn("part", F.when(F.col("id").isNull(), 0).otherwise(F.col("part").cast("int") + 1))


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(part, carry, id, text)``, dealt out by ``part`` and sorted so that
    each row is followed by the one of the next document in descending order
    of ids (nulls last; rows of one id by a hash of the text): the first row
    of the next range comes along at the end with ``carry`` 1.  After the last
    document the first one follows.

    Texts are shuffled once, and a range is read as a stream: no group of rows
    has to fit into memory."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    bounds, into = _ranges(docs)
    # one row per range, so MAX_RANGES at most
    rows = _parted(docs, bounds).join(F.broadcast(into), F.col("id").eqNullSafe(F.col("head")), "left")
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("carry"))
    more = F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("part"), F.lit(1).alias("carry")))
    rows = rows.select("id", "text", F.inline(F.array_compact(F.array(own, more))))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select("part", "carry", "id", "text").repartitionById(n, F.col("part") % n)
            .sortWithinPartitions("part", "carry", F.desc_nulls_last("id"), F.xxhash64("text")))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, ``n_chars`` (code points), the
    fingerprints of its text and of its edited text, whose last
    ``floor(n_chars / share)`` code points are replaced by the first as many
    (or all) of the next document, the edited text's SHA-256, and the likeness
    of the text's fingerprint to the edited text's (``near_edited``) and the
    next document's (``near_next``).

    The next document is that of the next smaller id; null is the smallest,
    rows of one id come in the order of a hash of their texts, and after the
    last row comes the first (in a table of one row, that row itself).  Null
    texts are empty; two empty texts are alike (1), an empty one and another
    are not (0).  An empty table gives an empty result; other columns are not
    read.
    """
    schema = (f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for i in range(0, b.num_rows, SLICE):
                s = b.slice(i, SLICE)
                yield from zip(s["part"].to_pylist(), s["carry"].to_pylist(), s["id"].to_pylist(), s["text"].to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, done = None, []
        for part, carry, i, text in rows(batches):
            text = text or ""
            print_ = fingerprint(text)
            if before is not None and before[0] == part:
                _, j, own, own_print = before
                n, m = len(own), len(own) // share
                edited = own[:n - m] + text[:m]
                done.append((j, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own_print,
                             fingerprint(edited) if m else own_print, print_))
            before = None if carry else (part, i, text, print_)
            if len(done) == SLICE:
                yield finished(done)
                done = []
        if done:
            yield finished(done)

    def finished(done: list[tuple]) -> pa.RecordBatch:
        ids, n, sha, own, edited, after = zip(*done)
        near = likenesses([*zip(own, edited), *zip(own, after)])
        return pa.RecordBatch.from_pydict(
            {id_col: pa.array(ids, pa.int64()), "n_chars": pa.array(n, pa.int64()), "edited_sha256": pa.array(sha),
             "fingerprint": pa.array(own), "edited_fingerprint": pa.array(edited),
             "near_edited": pa.array(near[:len(done)], pa.float64()), "near_next": pa.array(near[len(done):], pa.float64())})

    return followed(docs, id_col, text_col).mapInArrow(run, schema)
