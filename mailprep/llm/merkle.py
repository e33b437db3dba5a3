"""A Merkle manifest of a table: a tree per source, a tree over the sources, and versions of both for changed rows.

Sixteen consecutive nodes have one parent. Aligned blocks of 4,096 nodes of a source are one stored row each: the digests
of its leaves and of all nodes above them in the block. What the blocks end in are the leaves of the next, far smaller
level of blocks, until a source has one node left. A changed row makes a version of its tree that copies only the row's
ancestors and shares every other node: in the block the ancestors are copied beside the block's own nodes, and further up
every version goes on by itself with the siblings on its path, which are read once per block. No task sees all versions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailprep.session import broadcast_if_small, saved

FAN = 16
LEVELS = 3                 # of a block: FAN ** LEVELS leaves
MAX_BROADCAST = 200_000
PATH = "array<struct<left: string, right: string>>"


# --- one block ----------------------------------------------------------------------------------------------

def rounds(n: int) -> int:
    """How often n nodes are put together until one is left."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def parent(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


class Block:
    """The nodes of an aligned block by level, from its leaves up. ``n`` is the number of all nodes of that level in the
    tree, which tells how many levels there are still to come."""

    def __init__(self, leaves: list[str], n: int):
        self.levels = [leaves]
        for _ in range(min(LEVELS, rounds(n))):
            below = self.levels[-1]
            self.levels.append([parent(below[i:i + FAN]) for i in range(0, len(below), FAN)])
        self.root = self.levels[-1][0]

    def siblings(self, level: int, i: int) -> tuple[str, str]:
        """The nodes beside node i of a level in its run, put together: those before it and those after it."""
        start = i - i % FAN
        nodes = self.levels[level]
        return "".join(nodes[start:i]), "".join(nodes[i + 1:start + FAN])

    def path(self, i: int) -> list[tuple[str, str]]:
        """The siblings of leaf i and of its ancestors below the root of the block."""
        return [self.siblings(level, i // FAN ** level) for level in range(len(self.levels) - 1)]

    def version(self, i: int, leaf: str) -> list[str]:
        """The copies that a changed leaf i makes: the leaf and its ancestors. All other nodes are those of the block."""
        copies = [leaf]
        for left, right in self.path(i):
            copies.append(folded(copies[-1], left, right))
        return copies


def folded(node: str, left: str, right: str) -> str:
    return sha256(f"{left}{node}{right}".encode()).hexdigest()


# --- places -------------------------------------------------------------------------------------------------

def _placed(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows (grp, ...) with their place ``pos`` in their group, and groups (grp, gid, n): their own place and size.

    Rows are sorted by ranges of (group, order) and written; a row's place is its place in the written part and what
    stands before the part. Only parts and groups are counted, so a group of any size lies in many parts.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["grp", *order, "tie"]
    rows = saved(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle_rows")  # equal rows may go anywhere
    ranged = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    ranged = saved(ranged.drop("tie"), "merkle_sorted")
    part = F.shiftright("at", 33).alias("part")
    stretch = saved(ranged.groupBy(part, "grp").agg(F.min("at").alias("low"), F.count("*").alias("k")), "merkle_parts")
    sizes = stretch.groupBy("grp").agg(F.sum("k").alias("n"), F.min("part").alias("part"))
    before = sizes.groupBy("part").agg(F.count("*").alias("k"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    before = before.select("part", F.coalesce(F.sum("k").over(so_far), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("grp"))
    groups = saved(sizes.join(before, "part").select("grp", "n", (own - 1 + F.col("before")).cast("long").alias("gid")), "merkle_groups")
    of_group = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offset = stretch.select("part", "grp", (F.coalesce(F.sum("k").over(of_group), F.lit(0)) - F.col("low")).alias("shift"))
    offset = offset.join(groups, offset["grp"].eqNullSafe(groups["grp"])).select("part", "gid", "n", "shift", offset["grp"].alias("of"))
    offset = broadcast_if_small(saved(offset, "merkle_offsets"), MAX_BROADCAST)
    placed = ranged.withColumn("in", part).join(offset, (F.col("in") == offset["part"]) & F.col("grp").eqNullSafe(offset["of"]))
    return placed.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "in", "part", "shift", "of", "grp"), groups


# --- trees --------------------------------------------------------------------------------------------------

def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (gid, n, pos, leaf, changed, key) as one row per aligned block: (gid, n, block, keys, leaves, changed, root).

    ``n`` is the number of nodes in the whole group; ``changed`` is another digest of the leaf or null.
    """
    kind = nodes.schema["key"].dataType.simpleString()

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n, leaves = table["n"][0].as_py(), table["leaf"].to_pylist()
        return pa.table({"gid": table["gid"][:1], "n": table["n"][:1], "block": table["block"][:1],
                         "keys": pa.array([table["key"].combine_chunks()], pa.list_(table["key"].type)),
                         "leaves": ["".join(leaves)],
                         "changed": pa.array([table["changed"].to_pylist()], pa.list_(pa.string())),
                         "root": [Block(leaves, n).root]})

    rows = nodes.select("gid", "n", F.expr(f"pos div {FAN ** LEVELS}").alias("block"), "pos", "leaf", "changed", "key")
    return rows.groupBy("gid", "block").applyInArrow(
        build, f"gid long, n long, block long, keys array<{kind}>, leaves string, changed array<string>, root string")


def _split(leaves: str) -> list[str]:
    return [leaves[i:i + 64] for i in range(0, len(leaves), 64)]


def _forest(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The block tables of the trees over nodes (gid, n, pos, leaf, changed, key), from the leaves to where each group has
    one block."""
    tables = [saved(_blocks(nodes), name)]
    while tables[-1].filter("block > 0").count():
        last = tables[-1]
        up = last.select("gid", F.expr(f"(n + {FAN ** LEVELS - 1}) div {FAN ** LEVELS}").alias("n"), F.col("block").alias("pos"),
                         F.col("root").alias("leaf"), F.lit(None).cast("string").alias("changed"), F.lit(0).alias("key"))
        tables.append(saved(_blocks(up), name))
    return tables


def _paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(gid, block, path) for the blocks below: the siblings on the way from each leaf of ``blocks`` to the very top."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Block(_split(row["leaves"]), row["n"])
                out = [{"gid": row["gid"], "block": row["block"] * FAN ** LEVELS + i,
                        "path": [{"left": a, "right": b} for a, b in own.path(i)] + row["path"]} for i in range(len(own.levels[0]))]
                yield pa.RecordBatch.from_pylist(out, schema=paths)

    paths = pa.schema([("gid", pa.int64()), ("block", pa.int64()),
                       ("path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))])
    joined = blocks.join(above, ["gid", "block"]).select("gid", "n", "block", "leaves", "path")
    return joined.mapInArrow(run, f"gid long, block long, path {PATH}")


@dataclass
class Manifest:
    """``root``: the digest of the whole table, None for an empty one. ``groups``: (grp, gid, n, subroot).
    ``blocks``: the stored blocks of leaves with the ``path`` from the block's root to the top."""
    root: str | None
    groups: DataFrame
    blocks: DataFrame


def build(rows: DataFrame) -> Manifest:
    """The manifest of rows (grp, key, leaf, changed): digests as hexadecimal text, ``changed`` that of a row's changed
    form, or null.

    Leaves of a group ascend by key, nulls first, equal keys by leaf; groups ascend bytewise, null first. Rows that are
    equal in all of it may stand in any order.
    """
    spark = rows.sparkSession
    nodes, groups = _placed(rows, ["key", "leaf", "changed"])
    trees = _forest(nodes, "merkle_blocks")
    last = trees[-1].select("gid", F.col("root").alias("subroot"))
    groups = saved(groups.join(last, "gid"), "merkle_roots")
    count = groups.count()
    tops = groups.select(F.lit(0).cast("long").alias("gid"), F.lit(count).cast("long").alias("n"), F.col("gid").alias("pos"),
                         F.col("subroot").alias("leaf"), F.lit(None).cast("string").alias("changed"), F.lit(0).alias("key"))
    over = _forest(tops, "merkle_top")
    found = over[-1].select("root").first()
    none = F.lit(None).cast(PATH)
    path = spark.range(1).select(F.col("id").alias("gid"), F.lit(0).cast("long").alias("block"), F.coalesce(none, F.array().cast(PATH)).alias("path"))
    for table in reversed(over):
        path = saved(_paths(table, path), "merkle_paths")
    path = path.select(F.col("block").alias("gid"), F.lit(0).cast("long").alias("block"), "path")
    for table in reversed(trees[1:]):
        path = saved(_paths(table, path), "merkle_paths")
    return Manifest(found["root"] if found else None, groups, trees[0].join(path, ["gid", "block"]))


def proofs(manifest: Manifest) -> DataFrame:
    """Per row: (key, gid, leaf, path, copies). ``path`` has the siblings of the leaf and of each ancestor, from the leaf to the
    root, as those before and those after; ``copies`` the nodes that the row's version copies, from the changed leaf to the
    version's root, null for a row without a changed form."""
    def whole(own: Block, i: int, changed: str | None, upper: list[tuple[str, str]]) -> dict:
        copies = None
        if changed is not None:
            copies = own.version(i, changed)
            for left, right in upper:  # the version goes on above its block
                copies.append(folded(copies[-1], left, right))
        return {"path": [{"left": a, "right": b} for a, b in own.path(i) + upper], "copies": copies}

    return _expanded(manifest, f"path {PATH}, copies array<string>", [
        ("path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))), ("copies", pa.list_(pa.string()))], whole)


def proof_digests(manifest: Manifest) -> DataFrame:
    """Per row: (key, gid, leaf, proof_sha256, folded_root): the digest of all siblings on the row's path, from left to
    right and from the leaf up, and the root that they make with the row's changed leaf, or with its leaf where it has no
    changed form. Every row is folded, so a block whose stored digests do not lead to the root shows up in each of its rows."""
    def digests(leaf: str, changed: str | None, path: list[tuple[str, str]]) -> dict:
        root = leaf if changed is None else changed
        for left, right in path:
            root = folded(root, left, right)
        return {"proof_sha256": sha256("".join(a + b for a, b in path).encode()).hexdigest(), "folded_root": root}

    return _expanded(manifest, "proof_sha256 string, folded_root string",
                     [("proof_sha256", pa.string()), ("folded_root", pa.string())],
                     lambda own, i, changed, upper: digests(own.levels[0][i], changed, own.path(i) + upper))


def _expanded(manifest: Manifest, columns: str, fields: list, make) -> DataFrame:
    key = manifest.blocks.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                keys = batch["keys"][at].values
                row = batch.select(["gid", "n", "leaves", "changed", "path"]).slice(at, 1).to_pylist()[0]
                own = Block(_split(row["leaves"]), row["n"])
                upper = [(x["left"], x["right"]) for x in row["path"]]
                out = []
                for i, changed in enumerate(row["changed"]):
                    out.append({"gid": row["gid"], "leaf": own.levels[0][i]} | make(own, i, changed, upper))
                made = pa.RecordBatch.from_pylist(out, schema=pa.schema([("gid", pa.int64()), ("leaf", pa.string()), *fields]))
                yield pa.RecordBatch.from_arrays([keys, *made.columns], ["key", *made.schema.names])

    return manifest.blocks.select("gid", "n", "keys", "leaves", "changed", "path").mapInArrow(
        run, f"key {key}, gid long, leaf string, {columns}")


# --- documents ----------------------------------------------------------------------------------------------

def digest(columns: list[Column]) -> Column:
    """The digest of a row: each column as ``-`` if null, else its length in bytes, a colon and itself."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]).cast("binary"), 256)


def tampering(docs: DataFrame, columns: list[str], key: str, group: str, changed: dict[str, Column], which: Column) -> DataFrame:
    """Per row of ``docs``: (key, leaf, subroot, root, proof_sha256, folded_root, verified).

    Rows for which ``which`` holds are held against the manifest with the columns ``changed`` as given, all others as they
    are: ``folded_root`` is the root that the changed or own leaf makes with the siblings of the manifest. Null, empty and equal rows are leaves like all
    others; a null key is the first of its group. An empty table gives an empty result.
    """
    plain = digest([F.col(f"`{c}`") for c in columns])
    other = digest([changed.get(c, F.col(f"`{c}`")) for c in columns])
    rows = docs.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"), plain.alias("leaf"),
                       F.when(which, other).alias("changed"))
    made = build(rows)
    subroots = broadcast_if_small(made.groups.select("gid", "subroot"), MAX_BROADCAST)
    root = F.lit(made.root).cast("string")
    out = proof_digests(made).join(subroots, "gid")
    return out.select(F.col("key").alias(key), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == root).alias("verified"))
