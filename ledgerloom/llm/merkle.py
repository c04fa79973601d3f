"""Merkle manifest of a table, kept as a persistent tree that versions share.

A leaf is the digest of one row. Per group (a language), leaves in key order are folded eight at a time until one node,
the group's subroot, remains; subroots are folded alike to the root. Nodes are dealt into aligned blocks of
`8 ** levels` consecutive ones, each folded by one task; the blocks' roots are the nodes of the next, eight-to-the-levels
times smaller stage. A group of any size is spread over its blocks.

A changed leaf makes a new version by path copying: its ancestors within its block are copied, all other nodes are those
of the old tree. Above the block, the version goes on along the runs of siblings that the upper stages hand down once per
block, so no upper task ever holds the versions below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.staging import staged

ARITY = 8

_PATH = "path array<struct<slot: int, run: array<string>>>"
_RUN = pa.struct([("slot", pa.int32()), ("run", pa.list_(pa.string()))])


@dataclass(frozen=True)
class ManifestSettings:
    """`levels` folded by one task: a block has `ARITY ** levels` nodes."""

    levels: int = 3

    @property
    def block(self) -> int:
        return ARITY**self.levels


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Tree:
    """Levels of nodes above some leaves: `levels` of them, or as many as leave a single node."""

    def __init__(self, leaves: list[str], levels: int | None):
        self.nodes = [leaves]
        while len(self.nodes[-1]) > 1 if levels is None else len(self.nodes) <= levels:
            last = self.nodes[-1]
            self.nodes.append([digest(last[i : i + ARITY]) for i in range(0, len(last), ARITY)])

    @property
    def top(self) -> str:
        return self.nodes[-1][0]

    def path(self, place: int) -> list[tuple[int, list[str]]]:
        """Per level: the node's slot in its run, and the run."""
        out = []
        for level in self.nodes[:-1]:
            start = place // ARITY * ARITY
            out.append((place - start, level[start : start + ARITY]))
            place //= ARITY
        return out


def siblings(path: list[tuple[int, list[str]]]) -> str:
    return "".join("".join(run[:slot]) + "".join(run[slot + 1 :]) for slot, run in path)


def copied(path: list[tuple[int, list[str]]], leaf: str) -> list[str]:
    """The nodes that a version with another leaf copies, leaf first."""
    out = [leaf]
    for slot, run in path:
        out.append(digest([*run[:slot], out[-1], *run[slot + 1 :]]))
    return out


def row_digest(columns: Sequence[Column]) -> Column:
    """Digest of a row: each value as `-` if null, else its UTF-8 length in bytes, a colon and the value."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """`rows` with `pos`, their place within `grp` in the given order, and `total`, the rows of the group.

    One range sort; rows are then counted per group and partition, and only these counts are added up. Equal rows are told
    apart by where they were read, so that they can't crowd one partition.
    """
    keys = ["grp", *order, "__read"]
    spread = rows.withColumn("__read", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__read")
    ordered = staged(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("place", 33)
    counts = ordered.groupBy(F.col("grp").alias("__grp"), part.alias("part")).agg(F.min("place").alias("low"), F.count("*").alias("n"))
    group = Window.partitionBy("__grp")
    before = F.coalesce(F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("__grp", "part", "low", before.alias("before"), F.sum("n").over(group).alias("total"))
    joined = ordered.join(counts, (F.col("grp") == F.col("__grp")) & (part == F.col("part")))
    kept = [c for c in ordered.columns if c != "place"]
    return joined.select(*kept, (F.col("before") + F.col("place") - F.col("low")).alias("pos"), "total")


def _blocked(nodes: DataFrame, s: ManifestSettings) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / s.block).cast("long"))


def _tree(table: pa.Table, s: ManifestSettings) -> Tree:
    """The tree over one block's nodes, which are sorted by pos."""
    whole = table.column("total")[0].as_py() > s.block
    return Tree(table.column("node").to_pylist(), s.levels if whole else None)


def _block_roots(nodes: DataFrame, s: ManifestSettings) -> DataFrame:
    """(grp, pos, total, node) of the next stage."""

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total = -(-table.column("total")[0].as_py() // s.block)
        row = {"grp": table.column("grp")[0].as_py(), "pos": table.column("block")[0].as_py(), "total": total, "node": _tree(table, s).top}
        return pa.Table.from_pylist([row], pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("total", pa.int64()), ("node", pa.string())]))

    grouped = _blocked(nodes.select("grp", "pos", "total", "node"), s).groupBy("grp", "block")
    return grouped.applyInArrow(fold, "grp string, pos long, total long, node string")


def _paths(nodes: DataFrame, s: ManifestSettings) -> DataFrame:
    """(grp, pos, path, top): from each node the runs that lead to its group's top. `nodes` must be a written table."""
    if (nodes.agg(F.max("total").alias("n")).first()["n"] or 0) <= 1:
        return nodes.select("grp", "pos", F.expr(f"CAST(array() AS {_PATH.split(' ', 1)[1]})").alias("path"), F.col("node").alias("top"))
    above = _paths(staged(_block_roots(nodes, s), "nodes"), s).withColumnRenamed("pos", "block")

    def lead(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        tree, up = _tree(left, s), right.to_pylist()[0]
        rows = []
        for i, (grp, pos) in enumerate(zip(left.column("grp").to_pylist(), left.column("pos").to_pylist(), strict=True)):
            path = [{"slot": slot, "run": run} for slot, run in tree.path(i)]
            rows.append({"grp": grp, "pos": pos, "path": path + up["path"], "top": up["top"]})
        return pa.Table.from_pylist(rows, pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("path", pa.list_(_RUN)), ("top", pa.string())]))

    pairs = _blocked(nodes, s).groupBy("grp", "block").cogroup(above.groupBy("grp", "block"))
    return pairs.applyInArrow(lead, f"grp string, pos long, {_PATH}, top string")


def manifest(
    rows: DataFrame,
    columns: Sequence[str],
    group: str,
    key: str,
    tampered: Mapping[str, Column] | None = None,
    where: Column | None = None,
    settings: ManifestSettings = ManifestSettings(),
) -> DataFrame:
    """One row per row of `rows`: key, leaf, subroot, root, proof_sha256, folded_root, verified, copied.

    `columns` make up the leaf. Leaves are ordered by `key`, null first, within `group`; groups in the byte order of their
    text, null first. `tampered` gives other values of some columns for the rows that satisfy `where`; every such row is a
    version of its own. `folded_root` is the root of its version, else the root folded from the leaf and its siblings;
    `verified` tells whether that is the root; `proof_sha256` is the digest of all siblings, from leaf to root and left to
    right. `copied` lists the nodes that a version copies, from the leaf up to the root; it is empty for rows left alone.

    Rows with equal keys are ordered by their leaves, and equal rows are interchangeable. A null key, null values, empty
    and very long texts are digested like any other. Other columns are ignored. An empty table gives an empty result.
    """
    s = settings
    leaf = row_digest([F.col(c) for c in columns])
    changed = F.lit(None).cast("string")
    if tampered:
        other = row_digest([tampered.get(c, F.col(c)) for c in columns])
        changed = F.when(F.lit(True) if where is None else where, other)
    name = F.col(group).cast("string")
    grp = F.when(name.isNull(), "-").otherwise(F.concat(F.lit("="), name))
    leaves = rows.select(grp.alias("grp"), F.col(key).alias("key"), leaf.alias("node"), changed.alias("changed"))
    leaves = staged(_placed(leaves, ["key", "node"]), "leaves")

    below = _paths(staged(_block_roots(leaves, s), "nodes"), s)
    below = staged(below.withColumnRenamed("pos", "block"), "paths")
    groups = below.where("block = 0").select(F.lit("root").alias("grp"), F.col("grp").alias("name"), F.col("top").alias("node"))
    groups = staged(_placed(groups, ["name"]), "groups")
    names = groups.select("pos", "name").withColumnRenamed("pos", "at")
    roots = _paths(groups.select("grp", "pos", "total", "node"), s).join(names, F.col("pos") == F.col("at"))
    roots = roots.select(F.col("name").alias("grp"), F.col("path").alias("root_path"), F.col("top").alias("root"))
    upper = below.join(roots, "grp").select("grp", "block", F.concat("path", "root_path").alias("path"), F.col("top").alias("subroot"), "root")

    key_type = leaves.schema["key"].dataType

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        tree, up = _tree(left, s), right.to_pylist()[0]
        above = [(p["slot"], p["run"]) for p in up["path"]]
        rest = siblings(above)
        proofs, folded, copies = [], [], []
        for i, (own, other) in enumerate(zip(left.column("node").to_pylist(), left.column("changed").to_pylist(), strict=True)):
            path = tree.path(i)
            proofs.append(digest([siblings(path), rest]))
            version = copied(path + above, own if other is None else other)
            folded.append(version[-1])
            copies.append([] if other is None else version)
        n = left.num_rows
        return pa.table({
            "key": left.column("key"), "leaf": left.column("node"), "subroot": pa.array([up["subroot"]] * n, pa.string()),
            "root": pa.array([up["root"]] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()), "copied": pa.array(copies, pa.list_(pa.string())),
        })

    pairs = _blocked(leaves, s).groupBy("grp", "block").cogroup(upper.groupBy("grp", "block"))
    schema = f"key {key_type.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, copied array<string>"
    done = pairs.applyInArrow(finish, schema)
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return done.select(F.col("key").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root", verified, "copied")
