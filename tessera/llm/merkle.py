"""Merkle manifest of a table.

Every row is a leaf.  The leaves of a group (a language, a source) form a
tree in the order of their ids, and the groups' subroots form the tree of the
table's root.  A node is ``(g, i, n, h)``: group number, index in its level,
leaves of the group, digest.

A level is one equijoin of its nodes with themselves: a node asks for its
siblings by their computed indices (``i XOR 1`` in a binary tree, else the
other slots of its run), gets the digests left and right of its own, and the
nodes in slot zero emit the parents.  ``(g, i)`` is unique, so no join key is
hot whatever the size of a group.  Each level is written once; all levels
together have at most twice the leaves.

Proofs go down the same tables: a node's path to the root is its own siblings
and its parent's path, so that the joins on the way down also have twice the
leaves in all, not leaves times levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import if_small
from tessera.operators.keys import global_position
from tessera.session import cut_lineage

_PATH = "array<struct<l:binary,r:binary>>"


def field(c: Column) -> Column:
    """A value as hashed text: ``-`` if null, else byte count, ``:``, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    """SHA-256 (binary) of the concatenated texts."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def text(h: Column) -> Column:
    """A digest, or several in a row, as lowercase hex."""
    return F.lower(F.hex(h))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and its path give."""
    return F.aggregate(path, leaf, lambda h, s: digest(text(s["l"]), text(h), text(s["r"])))


def _siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with ``l`` and ``r``: the digests of the other nodes of the
    run, concatenated, before and after the node's own slot."""
    k, none = fanout, F.lit(b"")
    slot = F.pmod("i", F.lit(k))
    if k == 2:
        other = nodes.select("g", F.col("i").alias("o"), F.col("h").alias("s"))
        mine = nodes.withColumn("o", F.col("i").bitwiseXOR(F.lit(1)))
        got = mine.join(other, ["g", "o"], "left").drop("o")
        s = F.coalesce("s", none)
        return got.withColumns({"l": F.when(slot == 1, s).otherwise(none),
                                "r": F.when(slot == 0, s).otherwise(none)}).drop("s")
    # each node tells the others of its run, by their slot offsets, what it is
    told = (nodes.select("g", "i", "h", F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("off"))
            .select("g", (F.col("i") - slot + F.pmod(F.col("i") + F.col("off"), F.lit(k))).alias("o"),
                    F.struct("i", "h").alias("s")))
    runs = told.groupBy("g", "o").agg(F.array_sort(F.collect_list("s")).alias("s")).withColumnRenamed("o", "i")
    side = lambda keep: F.aggregate(F.filter("s", keep), none, lambda a, x: F.concat(a, x["h"]))
    return (nodes.join(runs, ["g", "i"], "left")
            .withColumns({"l": F.coalesce(side(lambda x: x["i"] < F.col("i")), none),
                          "r": F.coalesce(side(lambda x: x["i"] > F.col("i")), none)}).drop("s"))


def levels(nodes: DataFrame, fanout: int = 2) -> tuple[list[DataFrame], DataFrame]:
    """The trees over written leaf nodes ``(g, i, n, h, ...)``: per level the
    nodes that have a parent, with their siblings ``l`` and ``r``, and the
    subroots ``(g, h)``.  Further columns stay with the leaves."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out, done, width = [], [nodes.filter("n = 1").select("g", "h")], 1
    while width < most:
        level = cut_lineage(_siblings(nodes.filter(F.col("n") > width), fanout), f"level-{len(out)}")
        out.append(level)
        width *= fanout
        parents = level.filter(F.pmod("i", F.lit(fanout)) == 0)
        nodes = parents.select("g", F.floor(F.col("i") / fanout).cast("long").alias("i"), "n",
                               digest(text(F.col("h")), text(F.col("r"))).alias("h"))
        done.append(nodes.filter(F.col("n") <= width).select("g", "h"))
    roots = done[0]
    for d in done[1:]:
        roots = roots.union(d)
    return out, cut_lineage(roots, "subroots")


def paths(tree: list[DataFrame], above: DataFrame, fanout: int = 2) -> DataFrame:
    """Per leaf ``(g, i, path)``, its siblings from the leaf's level to the
    root; ``above`` has each group's path ``(g, n, path)`` from its subroot on."""
    width = fanout ** len(tree)
    got = None
    for depth, level in reversed(list(enumerate(tree))):
        low = width // fanout
        # parents that are subroots, then parents that have parents
        parent = above.filter((F.col("n") > low) & (F.col("n") <= width)).select("g", F.lit(0).cast("long").alias("o"), "path")
        parent = parent if got is None else parent.union(got.withColumnRenamed("i", "o"))
        own = F.array(F.struct(F.col("l").alias("l"), F.col("r").alias("r")))
        got = cut_lineage(level.select("g", "i", "l", "r", F.floor(F.col("i") / fanout).cast("long").alias("o"))
                          .join(parent, ["g", "o"]).select("g", "i", F.concat(own, "path").alias("path")), f"paths-{depth}")
        width = low
    lone = above.filter("n = 1").select("g", F.lit(0).cast("long").alias("i"), "path")
    return lone if got is None else got.union(lone)


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
             fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             changed: dict[str, str] | None = None, fanout: int = 2) -> DataFrame:
    """One row per row of ``docs``: its id, ``leaf``, ``subroot`` of its group
    and ``root`` as lowercase hex, its ``path`` (an array of left and right
    siblings, for :func:`fold`), and ``seen``, the leaf digest with the SQL
    expressions of ``changed`` in place of the columns of these names (what a
    reader finds who gets the table later).

    Null ids come first and null is a group of its own, before the others;
    rows of one id are ordered by their digests, equal rows are leaves each.
    An empty table has no rows and no root.  Columns other than ``fields`` are
    not read, and may have any name.
    """
    if fanout < 2:
        raise ValueError("a run has at least two nodes")
    of = lambda over: digest(*[field(F.expr(over[c]) if c in over else F.col(f"`{c}`")) for c in fields])
    leaves = cut_lineage(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").alias("grp"),
                                     of({}).alias("h"), of(changed or {}).alias("seen")), "leaves")
    placed = global_position(leaves, ["grp", "id", "h", "seen"], "pos")
    placed = cut_lineage(placed, "placed")
    groups = global_position(placed.groupBy("grp").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")),
                             ["first"], "g")
    groups = cut_lineage(groups.withColumn("g", F.col("g").cast("long")), "groups")
    small = if_small(groups)
    nodes = cut_lineage(placed.join(small, placed["grp"].eqNullSafe(small["grp"]))
                        .select("g", (F.col("pos") - F.col("first")).cast("long").alias("i"), "n", "h", "id", "seen"), "nodes")
    tree, subroots = levels(nodes, fanout)
    count = groups.count()
    upper = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(count).cast("long").alias("n"), "h")
    up_tree, top = levels(cut_lineage(upper, "upper"), fanout)
    root = top.first()
    trunk = paths(up_tree, _one_path(top, count), fanout)
    above = cut_lineage(trunk.select(F.col("i").alias("g"), "path").join(groups.select("g", "n"), "g"), "above")
    found = nodes.join(paths(tree, above, fanout), ["g", "i"])
    sub = if_small(subroots.withColumnRenamed("h", "subroot"))
    return (found.join(sub, "g")
            .select(F.col("id").alias(id_col), text(F.col("h")).alias("leaf"), text(F.col("subroot")).alias("subroot"),
                    F.lit(root and root["h"].hex()).cast("string").alias("root"), "path", "seen"))


def _one_path(top: DataFrame, count: int) -> DataFrame:
    """The root's own path: it has no siblings."""
    return top.select("g", F.lit(count).cast("long").alias("n"), F.array().cast(_PATH).alias("path"))


def proof(path: Column) -> Column:
    """Lowercase hex digest of all siblings of a path, from the leaf's level
    to the root, left to right."""
    all_ = F.aggregate(path, F.lit(""), lambda a, s: F.concat(a, text(s["l"]), text(s["r"])))
    return F.sha2(all_.cast("binary"), 256)


def audit(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
          fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
          changed: dict[str, str] | None = None, fanout: int = 2) -> DataFrame:
    """:func:`manifest` with each row's proof (``proof_sha256``), the root that
    the row as seen gives with the original siblings (``folded_root``), and
    whether this is the root (``verified``)."""
    folded = text(fold(F.col("seen"), F.col("path")))
    return (manifest(docs, id_col, group_col, fields, changed, fanout)
            .select(id_col, "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                    folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
