"""Repeated-passage removal with a sparse, distributed suffix array.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
earlier.  Sorting every suffix of the corpus would shuffle each text a
hundredfold, so only suffixes at anchors are sorted: of each window of
LENGTH bytes, the start of its smallest K-gram (by a hash, the leftmost if
equal).  Equal windows have their anchor at the same place, so windows can
only be equal if their anchors' suffixes begin with the same K-gram.
Neighbouring windows of one anchor form a segment, some 30 windows long.

1.  Count the anchors' K-grams; those that occur once cannot repeat.  What
    occurs more often is marked in a bitmap of fixed size (a false mark only
    means a row more in the next steps).
2.  Segments of marked anchors, as references (document, positions, hashes).
    Of segments with equal bytes only the earliest is new; all windows of
    the others are repeats.
3.  The earliest segments whose K-gram has another segment get their bytes
    and are range-partitioned by their anchor's suffix (sampled splitters;
    behind the suffix, the bytes before the anchor, so that a K-gram that
    very many segments share is split, too).  Each bucket sorts its suffixes
    by multikey quicksort on 8-byte characters.  Within a run of one K-gram,
    windows are compared by what they hold; all but the earliest repeat.
4.  Only a run of more than a quarter of a bucket may cross buckets.  The
    windows that such a run, first or last in a bucket, holds for the first
    time are compared across the buckets by an aggregate.

Windows and segments are told apart by the K-gram and a 64-bit hash of all
their bytes, 128 bits in all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import mix, per_batch, spread_key
from tessera.session import cut_lineage

LENGTH = 100
K = 32
#: Windows worked on at a time; a longer text is cut, which only cuts segments.
CHUNK = 200_000
MARK_BITS = 1 << 26
#: Rows per bucket: some 150 bytes and 30 windows each.
BUCKET_ROWS = 60_000

_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out, m = np.ones(n, np.uint64), 1
    with np.errstate(over="ignore"):
        while m < n:
            t = min(m, n - m)
            out[m:m + t] = out[:t] * (out[m - 1] * np.uint64(base))
            m += t
    return out


class _Rolling:
    """Hashes of substrings: sums of byte values times powers of an odd base,
    made independent of the position by the base's inverse."""

    value = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
    up = down = np.zeros(0, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if n > len(_Rolling.up):
            size = max(n, CHUNK + LENGTH + 1)
            _Rolling.up, _Rolling.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 2 ** 64), size)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(self.value[data] * self.up[:n - 1], out=self.sums[1:])

    def between(self, start, end) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x)
    y = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    y[:n] = x
    y = y.reshape(-1, w)
    ahead = np.minimum.accumulate(y, axis=1).ravel()
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def segments(data: np.ndarray, length: int = LENGTH, k: int = K):
    """Anchor K-gram hash, segment hash, first window, last window and anchor
    of all segments of a byte string, in order of position."""
    parts = [[] for _ in range(5)]
    for c in range(0, len(data) - length + 1, CHUNK):
        d = data[c:c + CHUNK + length - 1]
        r = _Rolling(d)
        n = len(d) - k + 1
        at = np.arange(n)
        gram = mix(r.between(at, at + k))
        # hash in the upper bits, position in the lower 20
        least = _sliding_min(gram >> np.uint64(20) << np.uint64(20) | at.astype(np.uint64), length - k + 1)
        anchor = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:], len(anchor)] - 1
        a = anchor[first]
        shape = mix(((last - first) << 20 | (a - first)).astype(np.uint64) + np.uint64(1))
        for p, x in zip(parts, (gram[a], mix(r.between(first, last + length) + shape), first + c, last + c, a + c)):
            p.append(x)
    return [np.concatenate(p) if p else np.zeros(0, np.int64 if i > 1 else np.uint64) for i, p in enumerate(parts)]


def multikey_sort(words: np.ndarray) -> np.ndarray:
    """Order of rows of 8-byte characters: sorted by the first character, and
    only rows that are still equal by the next, and so on."""
    order = np.argsort(words[:, 0], kind="stable")
    group = np.zeros(len(words), np.int64)  # of the rows in order: equal so far
    todo = np.arange(len(words))
    for j in range(words.shape[1]):
        rows = order[todo]
        if j:
            by = np.lexsort((words[rows, j], group[todo]))
            order[todo] = rows = rows[by]
        # split groups where this character differs
        v = words[rows, j]
        new = np.r_[True, (v[1:] != v[:-1]) | (group[todo][1:] != group[todo][:-1])]
        group[todo] = todo[np.flatnonzero(new)][np.cumsum(new) - 1]
        size = np.bincount(group, minlength=len(words))
        todo = np.flatnonzero(size[group] > 1)
        if not len(todo):
            break
    return order


def _characters(suffixes: list[bytes], width: int) -> np.ndarray:
    """First ``width`` bytes of each, as big-endian 8-byte characters."""
    flat = b"".join(s[:width].ljust(width, b"\0") for s in suffixes)
    return np.frombuffer(flat, ">u8").reshape(len(suffixes), -1).astype(np.uint64)


def repeats_in_bucket(doc, th, first, last, anchor, suffix, left, large, length: int = LENGTH, k: int = K):
    """Of a bucket's segments (lists; ``left``: the bytes before the anchor,
    backwards; ``large``: its run may cross buckets): repeated stretches ``(segment, start, end)`` and the windows
    of the bucket's outer large runs that are new to it, ``(segment, start, K-gram
    hash, offset, window hash)``, as arrays."""
    none = np.zeros(0, np.int64)
    if not len(doc):
        return (none, none, none), (none, none, none.astype(np.uint64), none, none.astype(np.uint64))
    chars = _characters(suffix, -(-length // 8) * 8)
    order = multikey_sort(chars)
    grams = chars[order][:, :k // 8]
    start = np.r_[True, (grams[1:] != grams[:-1]).any(axis=1)]
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(start) - 1
    outer = large & ((run == 0) | (run == run.max()))
    # segments by place, one of those given twice
    place = np.lexsort((first, th, doc))
    same = np.r_[False, (doc[place][1:] == doc[place][:-1]) & (th[place][1:] == th[place][:-1])
                 & (first[place][1:] == first[place][:-1])]
    place = place[~same]
    found, fresh = [], []
    runs_of = run[place]
    by_run = place[np.argsort(runs_of, kind="stable")]  # place order within each run
    edges = np.r_[np.flatnonzero(np.r_[True, run[by_run][1:] != run[by_run][:-1]]), len(by_run)]
    i = 0
    while i < len(edges) - 1:  # whole runs, some 4000 segments at a time
        j = i + 1
        while j < len(edges) - 1 and edges[j + 1] - edges[i] <= 4000:
            j += 1
        seg = by_run[edges[i]:edges[j]]
        i = j
        n = last[seg] - first[seg] + 1
        body = [left[s][::-1] + suffix[s] for s in seg]
        base = np.cumsum([0] + [len(b) for b in body[:-1]])
        r = _Rolling(np.frombuffer(b"".join(body), np.uint8))
        own = np.repeat(np.arange(len(seg)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = base[own] + step
        offset = (anchor[seg] - first[seg])[own] - step
        window = r.between(at, at + length)
        key = mix(mix(window) + (run[seg][own] << 8 | offset).astype(np.uint64))
        o = np.argsort(key, kind="stable")
        head = np.r_[True, key[o][1:] != key[o][:-1]]
        new = np.zeros(len(o), bool)
        new[o[head]] = True
        start_of = first[seg][own] + step
        for mask, out in ((~new, found), (new & outer[seg][own], fresh)):
            out.append((seg[own[mask]], start_of[mask], window[mask], offset[mask]))
    seg, at, _, _ = (np.concatenate(x) for x in zip(*found))
    # neighbouring windows of a segment to one stretch
    cut = np.flatnonzero(np.r_[True, (seg[1:] != seg[:-1]) | (at[1:] != at[:-1] + 1)]) if len(seg) else none
    end = at[np.r_[cut[1:] - 1, len(at) - 1]] + length if len(seg) else none
    fseg, fat, fwin, foff = (np.concatenate(x) for x in zip(*fresh))
    gram = np.zeros(len(doc), np.uint64)
    some = np.unique(fseg)
    if len(some):
        heads = np.frombuffer(b"".join(suffix[s][:k] for s in some), np.uint8)
        gram[some] = mix(_Rolling(heads).between(np.arange(len(some)) * k, np.arange(1, len(some) + 1) * k))
    return (seg[cut], at[cut], end), (fseg, fat, gram[fseg], foff, fwin)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(d, th, raw)``: the id (null: below all others), a hash of the text
    that tells rows of one id apart, and the text's bytes."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("d"),
                       F.xxhash64(raw).alias("th"), raw.alias("raw"))


def _marks(docs: DataFrame, length: int, k: int) -> np.ndarray:
    """Bitmap of the K-grams of anchors that occur more than once."""
    def grams(b):
        g = [segments(np.frombuffer(t, np.uint8), length, k)[0] for t in b["raw"].to_pylist()]
        g, n = np.unique(np.concatenate(g), return_counts=True)
        return {"g": g.view(np.int64), "n": n}

    counts = docs.select("raw").mapInArrow(per_batch(grams), "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    slot = F.pmod("g", F.lit(MARK_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(32)).cast("int"))
    words = (counts.filter("n > 1").groupBy(F.shiftright(slot, 5).alias("at")).agg(F.bit_or(bit).alias("m"))
             .toPandas())  # at most MARK_BITS / 32 rows
    out = np.zeros(MARK_BITS // 32, np.uint32)
    out[words["at"].to_numpy()] = words["m"].to_numpy()
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   k: int = K) -> DataFrame:
    """``(d, th, spans)`` of the documents that have repeats (keys as of
    :func:`_keyed`): stretches of bytes ``(s, e)`` covered by a string of
    ``length`` bytes that starts earlier, unmerged."""
    spark = docs.sparkSession
    texts = _keyed(docs, id_col, text_col)
    marks = spark.sparkContext.broadcast(_marks(texts, length, k))

    def refer(b):
        out = [[] for _ in range(7)]
        m = marks.value
        for d, th, t in zip(b["d"].to_pylist(), b["th"].to_pylist(), b["raw"].to_pylist()):
            s = segments(np.frombuffer(t, np.uint8), length, k)
            slot = (s[0] & np.uint64(MARK_BITS - 1)).astype(np.int64)
            keep = (m[slot >> 5] >> (slot & 31).astype(np.uint32) & np.uint32(1)).astype(bool)
            n = int(keep.sum())
            if n:
                cols = [x[keep] for x in s]
                for o, x in zip(out, (cols[0].view(np.int64), cols[1].view(np.int64), np.full(n, d), np.full(n, th), *cols[2:])):
                    o.append(x)
        return {c: pa.array(np.concatenate(o) if o else np.zeros(0, np.int64), pa.int64())
                for c, o in zip(("g", "u", "d", "th", "f", "l", "a"), out)}

    names = "g long, u long, d long, th long, f long, l long, a long"
    refs = cut_lineage(texts.mapInArrow(per_batch(refer), names), "segments")
    # of equal segments the earliest is new
    firsts = cut_lineage(refs.groupBy("g", "u").agg(F.min(F.struct("d", "th", "f", "l", "a")).alias("r")), "first-segments")
    known = firsts.select("g", "u", *[F.col(f"r.{c}").alias("r_" + c) for c in ("d", "th", "f")])
    copies = (refs.join(known, ["g", "u"]).filter("d <> r_d or th <> r_th or f <> r_f")
              .select("d", "th", F.col("f").alias("s"), (F.col("l") + length).alias("e")))
    # those whose K-gram has other segments, with their bytes
    several = (firsts.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
               .select("g", spread_key("g").alias("x"), (F.col("n") > BUCKET_ROWS // 4).alias("large")))
    open_ = (firsts.withColumn("x", spread_key("g")).join(several, ["g", "x"]).select("r.*", "large")
             .groupBy("d", "th").agg(F.collect_list(F.struct("f", "l", "a", "large")).alias("refs")))

    def fetch(b):
        out = {c: [] for c in ("d", "th", "f", "l", "a", "large", "suffix", "left")}
        for d, th, t, refs_ in zip(*(b[c].to_pylist() for c in ("d", "th", "raw", "refs"))):
            for r in refs_:
                f, l, a = r["f"], r["l"], r["a"]
                for c, x in zip(out, (d, th, f, l, a, r["large"], t[a:l + length], t[f:a][::-1])):
                    out[c].append(x)
        kinds = {"suffix": pa.binary(), "left": pa.binary(), "large": pa.bool_()}
        return {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()}

    rows = "d long, th long, f long, l long, a long, large boolean, suffix binary, left binary"
    suffixes = cut_lineage(texts.join(open_, ["d", "th"]).select("d", "th", "raw", "refs").mapInArrow(per_batch(fetch), rows), "suffixes")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-suffixes.count() // BUCKET_ROWS))

    def sort_bucket(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        d, th, f, l, a = (t[c].to_numpy() for c in ("d", "th", "f", "l", "a"))
        (seg, s, e), (fseg, fs, g, off, win) = repeats_in_bucket(
            d, th, f, l, a, t["suffix"].to_pylist(), t["left"].to_pylist(),
            t["large"].to_numpy(), length, k)
        seg_ = np.r_[seg, fseg]
        fresh = np.r_[np.zeros(len(seg), bool), np.ones(len(fseg), bool)]
        long = lambda x, y: pa.array(np.r_[x, y].astype(np.int64), pa.int64())
        cols = {"d": d[seg_], "th": th[seg_], "s": long(s, fs), "e": long(e, fs + length), "fresh": fresh,
                "g": long(np.zeros(len(seg)), g.view(np.int64)), "o": long(np.zeros(len(seg)), off),
                "w": long(np.zeros(len(seg)), win.view(np.int64))}
        yield pa.RecordBatch.from_pydict(cols)

    # equal keys stay together: those of a run that is not large are its K-gram
    gram, rest = F.substring("suffix", 1, k), [F.when(F.col("large"), F.col(c)) for c in ("suffix", "left")]
    sorted_ = (suffixes.repartitionByRange(buckets, gram, *rest)
               .mapInArrow(sort_bucket, "d long, th long, s long, e long, fresh boolean, g long, o long, w long"))
    sorted_ = cut_lineage(sorted_, "buckets")
    edge = sorted_.filter("fresh")
    before = (edge.groupBy("g", "o", "w").agg(F.min(F.struct("d", "th", "s")).alias("r"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("g", "o", "w", "r", spread_key("g", "o", "w").alias("x")))
    crossing = (edge.withColumn("x", spread_key("g", "o", "w")).join(before, ["g", "o", "w", "x"])
                .filter(F.struct("d", "th", "s") != F.col("r")).select("d", "th", "s", "e"))
    spans = copies.union(sorted_.filter("not fresh").select("d", "th", "s", "e")).union(crossing)
    return spans.groupBy("d", "th").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of the stretches' union; runs that touch are one."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    k: int = K, keep_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` (hex, of the bytes
    that are left) and, with ``keep_bytes``, these bytes as ``kept``.

    A null text is empty; a text of under ``length`` bytes loses nothing.  A
    null id comes before all others.  Rows of one id are in the order of a
    hash of their texts; repeated rows (id and text equal) are one document,
    each with its result.  An empty table gives an empty result.
    """
    d = _keyed(docs, id_col, text_col).withColumn("id", F.lit(None).cast("long"))
    d = d.withColumn("id", F.when(F.col("d") != -(1 << 63), F.col("d")))
    spans = repeated_spans(docs, id_col, text_col, length, k).withColumn("x", spread_key("d", "th"))
    j = d.withColumn("x", spread_key("d", "th")).join(spans, ["d", "th", "x"], "left").select("id", "raw", "spans")

    def cut(b):
        out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for raw, spans_ in zip(b["raw"].to_pylist(), b["spans"].to_pylist()):
            runs, at, kept = merged((x["s"], x["e"]) for x in spans_ or ()), 0, []
            for s, e in runs:
                kept.append(raw[at:s])
                at = e
            kept = b"".join([*kept, raw[at:]])
            for c, x in zip(out, (len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept)):
                out[c].append(x)
        if not keep_bytes:
            del out["kept"]
        return {id_col: b["id"], **out}

    schema = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return j.mapInArrow(per_batch(cut), schema)
