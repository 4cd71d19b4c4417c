"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import tmp_names
from tessera.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())

#: A written table of at most this many narrow rows may be broadcast (an
#: 8-byte key takes some 32 bytes in a hashed relation: about 32 MB).
BROADCAST_ROWS = 1_000_000


def if_small(written: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``written`` (a table on disk, so that counting reads only its footers)
    with a broadcast hint if it holds at most ``rows`` rows; beyond that it is
    left to a shuffle join."""
    return F.broadcast(written) if written.count() <= rows else written


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose id is (``left_anti``: is not) in the one-column
    table ``ids``, which must be written.  A null id is in no table."""
    (tmp,) = tmp_names(docs, "id")
    ids = if_small(ids.toDF(tmp))
    return docs.join(ids, docs[id_col] == ids[tmp], how)


def spread_key(*cols: str) -> Column:
    """A join key besides ``cols``.  An aggregate by ``cols`` is already
    partitioned by them and would be joined as it lies, so that a hot key's
    rows meet in one task; with one more key both sides are shuffled for the
    join, and adaptive execution can split the hot partition."""
    return F.xxhash64(*cols)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``most`` words."""

    most = 150_000

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.most:
            self[word] = h
        return h


_WORDS = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of bytes other than the six ASCII white-space characters,
    A-Z lower-cased."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words in order."""
    m = len(hashes) - n + 1
    out = np.full(max(m, 0), n, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + m]) if m > 0 else out
    return out


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a text; a text of
    fewer words has its whole sequence as its one shingle, one without words
    has none."""
    w = word_hashes(words_of(text))
    return np.unique(windows(w, min(n, len(w)))) if len(w) else w


#: Rows that are worked on at a time; bounds the memory of a step over texts.
SLICE = 256


def per_batch(fn):
    """``mapInArrow`` function from ``fn(record batch) -> dict of columns``,
    applied to slices of the record batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, SLICE):
                yield pa.RecordBatch.from_pydict(fn(b.slice(i, SLICE)))
    return run


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the pairs ``(a, b)`` (two columns of ids):
    ``(v, c)``, the smallest id ``c`` that ``v`` reaches.

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label; both are joins of narrow tables, written once a
    round, and a hub's neighbours are reduced before the shuffle.
    """
    both = cut_lineage(edges.toDF("a", "b").union(edges.select(F.col(edges.columns[1]), F.col(edges.columns[0])))
                       .distinct(), "edges")
    label = cut_lineage(both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("c")), "label")
    while True:
        seen = both.join(label.toDF("b", "l"), "b").groupBy(F.col("a").alias("v")).agg(F.min("l").alias("l"))
        new = (label.join(seen, "v").select("v", F.col("c").alias("was"), F.least("c", "l").alias("c")))
        up = label.toDF("c", "cc")
        new = cut_lineage(new.join(up, "c", "left").select("v", "was", F.least("c", "cc").alias("c")), "label")
        moved = new.filter("c <> was").limit(1).count()
        label = new.drop("was")
        if not moved:
            return label
