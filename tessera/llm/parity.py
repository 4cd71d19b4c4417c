"""N-gram Jaccard join with parity sketches.

Two sets of sizes a and b have Jaccard similarity num/den or more only if
their symmetric difference has at most (a + b)(den - num)/(den + num)
elements.  A set's elements are hashed into blocks and each block keeps the
XOR of its elements' hashes.  One differing element changes one block at
most, so the number of differing blocks is a lower bound of the symmetric
difference, and by the pigeonhole principle two sets within a difference of
d agree on at least one of d + 1 blocks.  The blocks (with their number and
size band) are therefore join keys that lose no pair.

Size bands grow by den/num: a partner of a set in band j that is not smaller
lies in band j or j + 1.  "Scheme" j serves these pairs, with its own number
of blocks, so a set writes keys for the schemes of its band and of the band
below.  A block without elements says nothing; each scheme has a few blocks
more than the pigeonhole needs, and only a set with more empty blocks than
that writes keys for empty ones.

A second sketch, one parity bit per slot of 2048, bounds the symmetric
difference of a candidate pair from below by its Hamming distance before the
sets themselves are compared.  The bound is the difference itself unless
elements share slots, and then it decides the pair, as the sizes are known.

What is wanted is the connected components of the links.  Sets that are
equal are one node from the start.  The rows of a join key are then not
paired with each other but with the smallest node of the key; pairs already
known to be connected are never compared.  What is left are rows that share
a key but not a component.  Their sketches are compared in tiles of at most
2 TILE rows, a key of more rows being dealt out over tiles.  A tile joins its
components as it finds pairs that the sketches allow and gives out only these
joins, fewer than it has rows, however many of its pairs are close.  They are
verified; where one fails, the tile took components as joined that may not be,
so the rows that it joined with that pair are compared again, with sketches four
times as wide, until none fails.  The tile's other rows are apart from these by
their sketches.  What was joined through several keys is then one new key.  Of
keys that have the same rows one is compared.  No link is lost and no task holds
more than a tile.
"""

from __future__ import annotations

from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import components, if_small, keep_ids, mix, per_batch, shingle_set, spread_key
from tessera.session import cut_lineage

BITS = 2048
TILE = 1500


@cache
def _schemes(num: int, den: int, upto: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Band starts and, per scheme, (blocks, spare blocks), for sizes to ``upto``."""
    starts = [1, 2]
    while starts[-3:][0] <= upto or len(starts) < 4:
        starts.append(max(starts[-1] + 1, (starts[-1] - 1) * den // num + 1))
    schemes = []
    for low, a, b in zip(starts, starts[1:], starts[2:]):
        a, b = a - 1, b - 1
        apart = (a + min(b, a * den // num)) * (den - num) // (den + num)
        spare = int(np.ceil(2 * (apart + 1) * np.exp(-low / (apart + 1)))) + (apart > 8) if apart else 0
        schemes.append((apart + 1 + spare, spare))
    return starts, schemes


def block_keys(elements: np.ndarray, num: int, den: int) -> np.ndarray:
    """The join keys of a set (distinct 64-bit hashes)."""
    n = len(elements)
    if not n:
        return elements
    size = 1 << max(8, (2 * n).bit_length())
    starts, schemes = _schemes(num, den, size)
    band = int(np.searchsorted(starts, n, "right")) - 1
    other = mix(elements ^ np.uint64(0x5851F42D4C957F2D))
    out = []
    for j in (band, band - 1):
        if j < 0:
            continue
        blocks, spare = schemes[j]
        at = (elements >> np.uint64(11)) % np.uint64(blocks)
        order = np.argsort(at, kind="stable")
        at, values = at[order], other[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        xor, at = np.bitwise_xor.reduceat(values, first), at[first]
        if blocks - len(first) > spare:
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), at)
            at, xor = np.r_[at, empty], np.r_[xor, np.zeros(len(empty), np.uint64)]
        out.append(mix(mix(xor) + at * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j * 7919 + 1)))
    return np.concatenate(out)


def parity_bits(elements: np.ndarray, bits: int = BITS) -> np.ndarray:
    """So many parity bits (a multiple of 64) as signed 64-bit integers."""
    odd = np.bincount((elements >> np.uint64(24)).astype(np.int64) % bits, minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _sketches(docs: DataFrame, words: int, num: int, den: int, width: int) -> DataFrame:
    def sketch(b):
        n, x, s, keys, bits = [], [], [], [], []
        for t in b["text"]:
            e = shingle_set(t.as_py(), words)
            n.append(len(e))
            x.append(np.bitwise_xor.reduce(e) if len(e) else 0)
            s.append(mix(e).sum() if len(e) else 0)
            keys.append(block_keys(e, num, den).view(np.int64))
            bits.append(parity_bits(e, width))
        signed = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
        return {"id": b["id"], "n": pa.array(n, pa.int64()), "f1": signed(x), "f2": signed(s),
                "bits": pa.array(bits, pa.list_(pa.int64())), "keys": pa.array(keys, pa.list_(pa.int64()))}

    return docs.mapInArrow(per_batch(sketch), "id long, n long, f1 long, f2 long, bits array<long>, keys array<long>")


def _near(a: str, b: str, num: int, den: int):
    """Whether sizes and parity bits (columns ``n``, ``bits`` with suffixes)
    allow the pair to be similar enough."""
    na, nb = F.col("n_" + a), F.col("n_" + b)
    apart = F.aggregate(F.zip_with("bits_" + a, "bits_" + b, lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                        F.lit(0), lambda s, v: s + v)
    return ((F.least(na, nb) * den >= F.greatest(na, nb) * num)
            & (apart * (den + num) <= (na + nb) * (den - num)))


def _tiles(rows: DataFrame, num: int, den: int, tile: int) -> DataFrame:
    """Pairs ``(k, a, b)`` that sizes and sketches allow of rows ``(k, v, c,
    n, bits)`` with one key ``k``; taken as links, they join the components
    ``c`` of each tile that any of its allowed pairs joins.  Pairs of a tile
    that are joined with each other have one number ``g``; every component of
    the tile that is joined with others has a row in one of these pairs.

    The rows of a key with g rows are dealt into m = ceil(g / tile) parts and
    each row goes to the m tiles that its part forms with every part."""
    m = F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int")
    sizes = cut_lineage(rows.groupBy("k").agg(m.alias("m")), "tile-sizes")
    large = if_small(sizes.filter("m > 1"))
    part = F.pmod(F.xxhash64("v", F.lit(5)), F.col("m")).cast("int")
    many = (rows.join(large, "k").withColumn("p", part)
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
            .select("k", F.least("p", "o").alias("p"), F.greatest("p", "o").alias("q"), "p", "v", "c", "n", "bits")
            .toDF("k", "p", "q", "own", "v", "c", "n", "bits"))
    few = (rows.join(large, "k", "left_anti")
           .select("k", *[F.lit(0).alias(x) for x in ("p", "q", "own")], "v", "c", "n", "bits"))
    dealt = few.union(many).repartition("k", "p", "q").sortWithinPartitions("k", "p", "q", "v")

    def joins(v, c, n, bits, own, p, q):
        """The joins of a tile: across its two parts, or within the one."""
        c, found = c.copy(), []
        left = np.flatnonzero(own == p)
        right = left if p == q else np.flatnonzero(own == q)
        for i in left:
            with_ = right[c[right] != c[i]]
            with_ = with_[np.minimum(n[with_], n[i]) * den >= np.maximum(n[with_], n[i]) * num]
            apart = np.bitwise_count(bits[with_] ^ bits[i]).sum(axis=1, dtype=np.int64)
            with_ = with_[apart * (den + num) <= (n[with_] + n[i]) * (den - num)]
            others, first = np.unique(c[with_], return_index=True)
            found += [(i, j) for j in with_[first]]
            if len(others):
                c[np.isin(c, others)] = c[i]
        return [(min(v[i], v[j]), max(v[i], v[j]), c[i]) for i, j in found]

    def run(batches):
        rest = None
        for batch in chain(_chunks(batches), [None]):  # one at a time: a task's rows may be many
            if batch is not None:
                rest = batch if rest is None else [np.concatenate([x, y]) for x, y in zip(rest, batch)]
            if rest is None or not len(rest[0]):
                continue
            k, p, q, own, v, c, n, bits = rest
            at = np.r_[0, 1 + np.flatnonzero((k[1:] != k[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])), len(k)]
            # the last tile may go on in the next batch
            stop = len(at) - 1 if batch is None else len(at) - 2
            found = [(k[i], *x) for i, j in zip(at[:stop], at[1:]) for x in
                     joins(v[i:j], c[i:j], n[i:j], bits[i:j], own[i:j], p[i], q[i])]
            rest = [x[at[stop]:] for x in rest]
            if found:
                kabg = np.array(found, np.int64)
                yield pa.RecordBatch.from_pydict({x: kabg[:, i] for i, x in enumerate("kabg")})

    return dealt.mapInArrow(run, "k long, a long, b long, g long")


def _chunks(batches):
    for b in batches:
        if b.num_rows:
            cols = [b.column(i).to_numpy() for i in range(7)]
            # unsigned: numpy counts the bits of the absolute value
            yield [*cols, b.column(7).flatten().to_numpy().reshape(b.num_rows, -1).view(np.uint64)]


def _verified(pairs: DataFrame, docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs whose texts' sets have the similarity, from the whole texts."""
    ids = cut_lineage(pairs.select(F.col("a").alias("v")).union(pairs.select("b")).distinct(), "ids")
    texts = cut_lineage(keep_ids(docs, ids, "id"), "texts")
    both = (pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b"))

    def check(b):
        keep, last = [], (None, None)
        for x, y in zip(b["ta"], b["tb"]):
            x, y = x.as_py(), y.as_py()
            if last[0] != x:
                last = (x, shingle_set(x, words))
            p, q = last[1], shingle_set(y, words)
            common = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(common * den >= (len(p) + len(q) - common) * num and common > 0)
        keep = pa.array(keep)
        return {"a": b["a"].filter(keep), "b": b["b"].filter(keep)}

    return both.select("a", "b", "ta", "tb").mapInArrow(per_batch(check), "a long, b long")


def _spread(rows: DataFrame) -> DataFrame:
    """``rows`` with the second join key ``s`` (see :func:`spread_key`) to ``k``."""
    return rows.withColumn("s", spread_key("k"))


def _apart(members: DataFrame, label: DataFrame) -> DataFrame:
    """The written rows ``(k, v, c)`` of keys that have rows of more than one
    component, of keys with the same rows those of one."""
    named = cut_lineage(members.join(label.toDF("v", "c"), "v", "left").select("k", "v", F.coalesce("c", "v").alias("c")), "named")
    # sums, as a row may be there twice; of 32 bits each, as they must not overflow
    halves = [f(F.xxhash64("v", F.lit(i))) for i in (1, 2) for f in
              (lambda h: h.bitwiseAND(0xFFFFFFFF), lambda h: F.shiftrightunsigned(h, 32))]
    split = (named.groupBy("k").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count(F.lit(1)).alias("rows"),
                                    *[F.sum(h).alias(f"h{i}") for i, h in enumerate(halves)])
             .filter("x < y").groupBy("x", "y", "rows", "h0", "h1", "h2", "h3").agg(F.min("k").alias("k")).select("k"))
    return cut_lineage(_spread(named).join(_spread(split), ["k", "s"], "left_semi").drop("s"), "apart")


def _torn(apart: DataFrame, found: DataFrame, failed: DataFrame) -> DataFrame:
    """The rows ``v`` of the written ``apart`` that tiles joined, in ``found``,
    with a pair ``(a, b)`` of ``failed``.  They get a new key ``k``, one for
    all rows that were joined, so that a row is there once, however many keys
    it shared with them."""
    groups = cut_lineage(found.join(failed, ["a", "b"], "left_semi").select("k", "g").distinct(), "failed")
    pairs = found.join(groups, ["k", "g"], "left_semi")
    ends = pairs.select("k", "g", F.col("a").alias("v")).union(pairs.select("k", "g", "b")).distinct()
    joined = cut_lineage(apart.join(ends, ["k", "v"]).select("k", "g", "c").distinct(), "torn")
    hubs = joined.groupBy("k", "g").agg(F.min("c").alias("hub"))
    whole = components(joined.join(hubs, ["k", "g"]).select("hub", "c").distinct())
    rows = apart.join(joined.select("k", "c").distinct(), ["k", "c"], "left_semi").select("v", "c").distinct()
    return rows.join(whole.toDF("c", "k"), "c").select("k", "v")


def _wider(docs: DataFrame, ids: DataFrame, words: int, width: int) -> DataFrame:
    """``(v, n, bits)`` with ``width`` parity bits of the rows of some ids
    (a written table), from the whole texts."""
    def sketch(b):
        sets = [shingle_set(t.as_py(), words) for t in b["text"]]
        return {"v": b["id"], "n": pa.array(map(len, sets), pa.int64()),
                "bits": pa.array([parity_bits(e, width) for e in sets], pa.list_(pa.int64()))}

    return cut_lineage(keep_ids(docs, ids, "id").mapInArrow(per_batch(sketch), "v long, n long, bits array<long>")
                       .distinct(), "wider")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                   num: int = 9, den: int = 10) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` (distinct shingles of
    ``words`` words) and ``component_id``, the smallest id reachable by links
    (Jaccard similarity of the shingle sets num/den or more), itself included.

    A text with fewer words has its whole sequence as its one shingle; null
    and empty texts have none and link with nothing, not even each other.
    Rows with one id are one node.  A row without an id takes part in no link
    and has a null component.  Empty tables give empty results; other columns
    are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    all_rows = cut_lineage(_sketches(docs, words, num, den, BITS), "sketches")
    sets = all_rows.filter("n > 0 and id is not null")
    same = ["n", "f1", "f2"]
    # nodes: the smallest id of each group of equal sets
    nodes = cut_lineage(sets.groupBy(*same).agg(F.min("id").alias("node")), "nodes")
    node_rows = (keep_ids(sets, nodes.select("node"), "id")
                 .select(F.col("id").alias("v"), "n", "bits", "keys"))
    # the keys are shuffled once: the aggregate and the join read the same exchange
    keys = node_rows.select("v", F.explode("keys").alias("k")).repartition("k")
    shared = (keys.groupBy("k").agg(F.min("v").alias("a"), F.max("v").alias("z"), F.count(F.lit(1)).alias("c"))
              .filter("a < z").select("k", "a", (F.col("c") > 2).alias("many")))
    sharing = cut_lineage(keys.join(shared, "k").select("k", "a", "v", "many"), "sharing")
    members = sharing.filter("many").select("k", "a", "v")
    stars = sharing.filter("a <> v").select("a", F.col("v").alias("b")).distinct()
    size_bits = node_rows.select("v", "n", "bits")

    def near(pairs: DataFrame) -> DataFrame:
        side = lambda x: size_bits.toDF(x, "n_" + x, "bits_" + x)
        return pairs.join(side("a"), "a").join(side("b"), "b").filter(_near("a", "b", num, den)).select("a", "b")

    def across(pairs: DataFrame, label: DataFrame) -> DataFrame:
        """Pairs whose ends are not known to be connected."""
        l = lambda x: label.toDF(x, "c_" + x)
        return (pairs.join(l("a"), "a", "left").join(l("b"), "b", "left")
                .filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b"))

    stars = cut_lineage(near(stars), "stars")
    # each node with its smallest neighbour, then the neighbours that did not connect it
    tried = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = cut_lineage(_verified(tried, docs, words, num, den), "links")
    label = components(links)
    rest = cut_lineage(across(stars, label).exceptAll(tried), "rest")
    if rest.limit(1).count():
        links = cut_lineage(links.union(_verified(rest, docs, words, num, den)), "links")
        label = components(links)
    # rows that share a key and are still apart
    width, tile = BITS, TILE
    apart = _apart(members, label)
    bits = size_bits
    while apart.limit(1).count():
        found = cut_lineage(_tiles(apart.join(bits, "v").select("k", "v", "c", "n", "bits"), num, den, tile), "joins")
        pairs = cut_lineage(found.select("a", "b").distinct(), "pairs")
        if not pairs.limit(1).count():
            break
        new = cut_lineage(_verified(pairs, docs, words, num, den), "verified")
        links = cut_lineage(links.union(new), "links")
        label = components(links)
        failed = cut_lineage(pairs.exceptAll(new.distinct()), "failed")
        if not failed.limit(1).count():
            break
        apart = _apart(_torn(apart, found, failed), label)
        width, tile = 4 * width, max(tile // 2, 2)
        bits = _wider(docs, cut_lineage(apart.select("v").distinct(), "wider"), words, width)
    group = (nodes.join(label.toDF("node", "c"), "node", "left")
             .select(*same, F.coalesce("c", "node").alias("c"), spread_key(*same).alias("s")))
    linked = (sets.select("id", *same, spread_key(*same).alias("s")).join(group, [*same, "s"])
              .select("id", "n", "c"))
    alone = all_rows.filter("n = 0 or id is null").select("id", "n", F.col("id").alias("c"))
    return linked.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                      F.col("c").alias("component_id"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                 num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, without those whose component (see
    :func:`similar_groups`) has a row of a smaller id: one document of each
    group stays.  Texts without words and rows without id all stay."""
    g = similar_groups(docs, id_col, text_col, words, num, den)
    out = cut_lineage(g.filter(f"component_id < `{id_col}`").select(id_col).distinct(), "similar")
    return keep_ids(docs, out, id_col, "left_anti")
