"""Merkle manifest of a table: one digest for all of it, one for each group, and a proof for each row.

A row's leaf is the hash of its columns, each with its size before it, ``-`` for null. The leaves of a group, in
order, are hashed ``FANOUT`` at a time, level by level, down to one node, the group's root; the roots of the groups in
order of their names (null first, bytewise) are hashed likewise to the root of the table. A group of one row has
its leaf as root, a table of one group that group's root.

``build`` writes the levels as rows that name their parent. ``proofs`` climbs them by a recursive query: each leaf
goes from node to parent, appends the siblings it meets there and folds its hash with them. The leaves of one run share every
sibling above it, so they travel as one row with a hash for each. Nodes above few leaves are met by a
shuffle; nodes above many, of which there are at most ``HEAVY_NODES`` by construction, by a broadcast, so that no
task gets all leaves below a node near the root.

Rows are ordered by group, then by id (nulls first), then by leaf, so repeated rows stand side by side and the tree
does not depend on the layout; each gets its own proof. A null id is a value like any other. Null and empty texts
have different leaves. An empty table has no root and an empty result. Columns that are not named are no part of the
leaf, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.operators.number import number_rows
from folio.session import materialize, scratch

FANOUT = 16
HEAVY_NODES = 1 << 15  # about 1.2 kB each
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_BITS = 33
_TOP_TREE = -1  # the tree over the groups' roots
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(columns: list[Column]) -> Column:
    """The hash of a row: each value as text after its size in bytes and a colon, ``-`` for null."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


def lowered_text(docs: DataFrame) -> dict[str, Column]:
    """The tampering of the contract: A-Z of ``text`` in lower case where 5 divides crc32 of the id."""
    hit = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0
    return {"text": F.when(hit, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))}


@dataclass(frozen=True)
class Manifest:
    """``root``; ``runs`` of leaves, the nodes of the first level; ``nodes`` of the levels above, with their children."""

    root: str | None
    runs: DataFrame
    nodes: DataFrame


def _placed_leaves(docs: DataFrame, group: str, order: str, columns: tuple[str, ...], tampered: dict[str, Column]) -> DataFrame:
    """``tree, n, at, doc_id, leaf, changed``: each leaf's group number, the group's size and the place in it."""
    leaves = docs.select(
        F.col(group).cast("string").alias("source"),
        F.col(order).alias("doc_id"),
        leaf_hash([F.col(x) for x in columns]).alias("leaf"),
        leaf_hash([tampered.get(x, F.col(x)) for x in columns]).alias("changed"),
        F.monotonically_increasing_id().alias("_row"),  # spreads a row that repeats very often
    )
    keys = ["source", "doc_id", "leaf", "_row"]
    ranged = materialize(leaves, "leaves").repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(ranged.drop("_row").withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", _ROW_BITS).alias("_part")
    pieces = placed.groupBy(part, "source").agg(F.min("_place").alias("_first"), F.count("*").alias("_size"))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    sizes = materialize(pieces.groupBy("source").agg(F.sum("_size").alias("n")), "groups")
    trees = number_rows(sizes.repartitionByRange("source").sortWithinPartitions("source"), "tree")
    # One row a group and range; the group's number comes by way of it, so that no large group is joined as one key.
    pieces = pieces.alias("p").join(trees.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select("p.*", "t.tree", "t.n")
    same = (F.shiftright("r._place", _ROW_BITS) == F.col("p._part")) & F.col("r.source").eqNullSafe(F.col("p.source"))
    at = F.col("_place") - F.col("_first") + F.col("_before")
    return placed.alias("r").join(pieces.alias("p"), same).select("tree", "n", at.alias("at"), "doc_id", "leaf", "changed")


def _parents(rows: DataFrame, level: int, groups: int) -> DataFrame:
    """``rows`` of a level with the node above: in the same tree, or for its last node in the tree of the groups."""
    c = F.col
    last, over = c("m") == 1, (c("tree") != _TOP_TREE) & F.lit(groups > 1)
    index = F.when(last, c("tree")).otherwise(c("at"))

    def above(inside: Column, top: Column) -> Column:
        return F.when(~last, inside).when(over, top)

    return rows.select(
        "*",
        F.lit(level).alias("level"),
        above(c("tree"), F.lit(_TOP_TREE).cast("long")).alias("up_tree"),
        above(F.lit(level + 1), F.lit(1)).alias("up_level"),
        above(F.floor(index / FANOUT), F.floor(index / FANOUT)).alias("up_at"),
        above(index % FANOUT, index % FANOUT).cast("int").alias("place"),
        (last & (c("tree") != _TOP_TREE)).alias("top"),
    )


def _next_level(rows: DataFrame, size: str) -> DataFrame:
    """``tree, at, m, weight, children, digest`` of the nodes above ``rows``; ``size`` tells how many rows a tree has."""
    found = rows.groupBy("tree", F.floor(F.col("at") / FANOUT).alias("up"), F.ceil(F.col(size) / FANOUT).alias("m")).agg(
        F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("_in"), F.sum("weight").alias("weight")
    )
    return found.select("tree", F.col("up").alias("at"), "m", "weight", F.col("_in.digest").alias("children")).withColumn(
        "digest", F.sha2(F.concat_ws("", "children"), 256)
    )


_NODE = ["tree", "level", "at", "digest", "up_tree", "up_level", "up_at", "place", "top", "weight", "children"]


def _climb_tree(rows: DataFrame, size: str, most: int, level: int, groups: int) -> list[DataFrame]:
    """The levels above ``rows`` until each tree, of ``most`` rows at most, has one node."""
    out = []
    while most > 1:
        rows = materialize(_parents(_next_level(rows.filter(F.col(size) > 1), size), level, groups), "level")
        out.append(rows)
        size, most, level = "m", -(-most // FANOUT), level + 1
    return out


def build(docs: DataFrame, group: str = "source", order: str = "doc_id", columns: tuple[str, ...] = COLUMNS, tampered: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``tampered`` gives other values of some columns, whose leaves the runs hold too."""
    c = F.col
    leaves = _placed_leaves(docs, group, order, columns, tampered or {})
    held = F.sort_array(F.collect_list(F.struct("at", "doc_id", "leaf", "changed")))
    runs = leaves.groupBy("tree", "n", F.floor(c("at") / FANOUT).alias("run")).agg(held.alias("leaves"))
    own = F.when(c("n") == 1, c("leaves")[0]["leaf"]).otherwise(F.sha2(F.concat_ws("", "leaves.leaf"), 256))
    runs = runs.select("tree", c("run").alias("at"), F.ceil(c("n") / FANOUT).alias("m"), "leaves", own.alias("digest"), F.size("leaves").cast("long").alias("weight"))
    runs = materialize(runs, "runs")
    size = runs.filter("at = 0").agg(F.max("m"), F.count("*")).first()
    most, groups = size[0] or 0, size[1]
    runs = _parents(runs, 1, groups)
    levels = _climb_tree(runs, "m", most, 2, groups)
    tops = [x.filter("top").select("tree", "digest", "weight") for x in [runs, *levels]]
    roots = reduce(DataFrame.union, tops).select(F.lit(_TOP_TREE).cast("long").alias("tree"), c("tree").alias("at"), F.lit(groups).cast("long").alias("m"), "weight", "digest")
    upper = _climb_tree(roots, "m", groups, 1, groups)
    last = upper[-1] if upper else roots
    root = last.first()["digest"] if groups else None
    none = F.array().cast("array<string>")
    nodes = [x.select(_NODE) for x in levels + upper] or [runs.withColumn("children", none).select(_NODE).limit(0)]
    return Manifest(root, runs, materialize(reduce(DataFrame.union, nodes), "nodes"))


def _fold(children: str, at: str, own: str) -> str:
    """SQL for the hash of a node when the child at a place is ``own``."""
    return f"sha2(concat_ws('', slice({children}, 1, {at}), array({own}), slice({children}, {at} + 2, {FANOUT})), 256)"


_CLIMB = f"""
WITH RECURSIVE climb MAX RECURSION LEVEL 100 AS (
    SELECT up_tree, up_level, up_at, up_heavy, place, leaves, folded, siblings, subroot FROM {{starts}}
    UNION ALL
    SELECT n.up_tree, n.up_level, n.up_at, n.up_heavy, n.place, c.leaves,
           transform(c.folded, h -> {_fold("n.children", "c.place", "h")}),
           concat(c.siblings, concat_ws('', slice(n.children, 1, c.place), slice(n.children, c.place + 2, {FANOUT}))),
           coalesce(c.subroot, CASE WHEN n.top THEN n.digest END)
    FROM climb c JOIN {{nodes}} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_at = n.at
)
SELECT * FROM climb LIMIT ALL
"""


def proofs(manifest: Manifest, heavy_nodes: int = HEAVY_NODES) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for each leaf of the manifest.

    A node is heavy when the leaves below it are at least the ``heavy_nodes``-th part of all leaves, counted once on
    each level; heaviness goes up the tree, so a leaf first climbs by shuffles, then by broadcasts.
    """
    c, spark = F.col, manifest.runs.sparkSession
    facts = manifest.runs.agg(F.sum("weight")).first()[0] or 0
    depth = manifest.nodes.select("level", (c("tree") == _TOP_TREE).alias("over")).distinct().count() + 1
    heavy = c("weight") * heavy_nodes >= facts * depth
    weights = manifest.nodes.select(c("tree").alias("up_tree"), c("level").alias("up_level"), c("at").alias("up_at"), heavy.alias("up_heavy"))
    up = ["up_tree", "up_level", "up_at"]
    nodes = materialize(manifest.nodes.join(weights, up, "left"), "weighed")
    first = F.expr(
        "CASE WHEN size(leaves) = 1 AND top AND digest = leaves[0].leaf THEN array(leaves[0].changed) "
        f"ELSE transform(leaves, (x, i) -> {_fold('leaves.leaf', 'i', 'x.changed')}) END"
    )
    starts = manifest.runs.join(weights, up, "left").select(
        *up, "up_heavy", "place", "leaves", first.alias("folded"), F.lit("").alias("siblings"), F.when(c("top"), c("digest")).alias("subroot")
    )
    light = spark.sql(_CLIMB, starts=starts, nodes=nodes.filter(~heavy))
    light = materialize(light.filter("up_heavy OR up_tree IS NULL"), "climbed")
    # At most ``heavy_nodes`` rows: on each level the leaves below such nodes add up to no more than all leaves.
    ended = spark.sql(_CLIMB, starts=light, nodes=F.broadcast(nodes.filter(heavy))).filter("up_tree IS NULL")
    each = ended.select("subroot", "siblings", c("leaves.leaf").alias("all"), F.posexplode(F.arrays_zip("leaves", "folded")).alias("i", "x"))
    own = F.concat_ws("", F.expr("slice(all, 1, i)"), F.expr(f"slice(all, i + 2, {FANOUT})"))
    root = F.lit(manifest.root)
    return each.select(
        c("x.leaves.doc_id").alias("doc_id"),
        c("x.leaves.leaf").alias("leaf"),
        "subroot",
        root.alias("root"),
        F.sha2(F.concat(own, c("siblings")), 256).alias("proof_sha256"),
        c("x.folded").alias("folded_root"),
        (c("x.folded") == root).alias("verified"),
    )


def merkle_report(docs: DataFrame) -> DataFrame:
    """The contract's rows: the manifest of ``docs`` and every row's proof, folded from the tampered leaf."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "n_chars", "text")
    with scratch(docs.sparkSession) as keep:
        return keep(proofs(build(docs, tampered=lowered_text(docs))), "proofs")
