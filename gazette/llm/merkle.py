"""Merkle manifest of a dataset as a tree of SHA-256 midstates.

Every row is a leaf.  Per source, every ``FAN`` consecutive nodes become the
hash of their hexadecimal digests, until one is left, the subroot; subroots
in source order form a tree of the same kind, whose last node is the root.

A parent keeps a copy of its hash state before each child slot (``Parent``).
Folding a replaced child resumes the copy at its slot with the replacement and
the siblings on its right; what stands on its left is never hashed again.

Spark sorts, numbers and groups: node tables per level (native hash of at most
``FAN`` collected digests) are written once; each group of ``FAN * FAN`` leaves
then meets the path above it (its ancestors' digests, one row a group) in one
Python call, which keeps the states of the parents it goes through.  No step
holds a source or a level as a whole.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import batch, bounded_batches, partitions, staged, table

FAN = 16
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


class Parent:
    """A node over some digests: its digest and the hash state before each slot."""

    def __init__(self, kids: list[str]):
        self.kids, self.states = kids, []
        state = hashlib.sha256()
        for kid in kids:
            self.states.append(state.copy())
            state.update(kid.encode())
        self.digest = state.hexdigest()

    def fold(self, slot: int, replacement: str) -> str:
        """The digest with another child in ``slot``."""
        state = self.states[slot].copy()
        state.update((replacement + "".join(self.kids[slot + 1:])).encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> str:
        return "".join(self.kids[:slot] + self.kids[slot + 1:])


def leaf_hash(*columns: Column) -> Column:
    """SHA-256 of the columns in a row: ``-`` for null, else byte count, ``:``, value."""
    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with a text column ``_g``, never null) with each row's place
    ``_i`` within its ``_g`` in the given order and the group's size ``_n``.

    One range sort over all groups, written once; places come from the rows'
    numbers inside the written parts and from each part's count per group,
    so a group of any size is spread over parts.  Rows that tie in the order
    keep the order they are read in."""
    n = partitions(rows.sparkSession)
    tie = F.monotonically_increasing_id()
    keyed = rows.withColumn("_tie", tie)
    dealt = keyed.repartitionByRange(n, "_g", *order, "_tie").sortWithinPartitions("_g", *order, "_tie").drop("_tie")
    at = F.monotonically_increasing_id()      # part number above 33 bits, row number below
    laid = staged(dealt.withColumns({"_part": F.shiftright(at, 33), "_at": at.bitwiseAND((1 << 33) - 1)}), name)
    runs = laid.groupBy("_g", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_count"))
    group = Window.partitionBy("_g")          # one row for each part that holds the group
    before = F.sum("_count").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_g", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_count").over(group).alias("_n"))
    return laid.join(runs, ["_g", "_part"]).withColumn("_i", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def depth(n: Column, fan: int = FAN) -> Column:
    """Levels above the leaves until one node is left."""
    out, power = F.lit(0), 1
    while power < 1 << 62:
        out, power = out + F.when(n > power, 1).otherwise(0), power * fan
    return out.cast("int")


def levels_above(nodes: DataFrame, top: int, name: str) -> list[DataFrame]:
    """Node tables of levels 1 to ``top``: ``_g, _n, _i, digest, kids``.
    Groups whose last node lies lower are left out of the levels above it."""
    out = []
    below = nodes.select("_g", "_n", "_i", "digest")
    for level in range(1, top + 1):
        kids = F.transform(F.array_sort(F.collect_list(F.struct("_k", "digest"))), lambda k: k["digest"])
        grouped = (below.filter(depth(F.col("_n")) >= level).withColumns({"_k": F.col("_i"), "_i": F.expr(f"_i div {FAN}")})
                   .groupBy("_g", "_n", "_i").agg(kids.alias("kids")))
        made = staged(grouped.withColumn("digest", F.sha2(F.array_join("kids", ""), 256)), f"{name}-{level}")
        out.append(made)
        below = made.select("_g", "_n", "_i", "digest")
    return out


def last_nodes(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``_g, digest`` of each group's only node at its last level."""
    out = nodes.filter(F.col("_n") == 1).select("_g", "digest")
    for level, made in enumerate(levels, 1):
        out = out.unionByName(made.filter(depth(F.col("_n")) == level).select("_g", "digest"))
    return out


def paths(levels: list[DataFrame], down_to: int, ends: DataFrame) -> DataFrame:
    """``_g, _i, path`` and the other columns of ``ends`` for the nodes at level
    ``down_to`` (and for the last nodes of groups that end lower, as ``_i`` 0):
    the ancestors above each, nearest first, as (slot, kids).  ``ends`` holds one
    row for each group: ``_g, _n, path`` above its last node, and more.  Children
    meet their parents, at most FAN to one."""
    extra = [c for c in ends.columns if c not in ("_g", "_n", "path")]
    level_of = depth(F.col("_n"))

    def top(which: Column) -> DataFrame:
        return ends.filter(which).select("_g", "_n", F.lit(0).cast("long").alias("_i"), "path", *extra)

    at = top(level_of >= max(len(levels), down_to))
    for level in range(len(levels), down_to, -1):
        parents = at.join(levels[level - 1].select("_g", "_i", "kids"), ["_g", "_i"])
        step = F.array(F.struct(F.col("_k").cast("int").alias("slot"), F.col("kids").alias("kids")))
        at = (parents.select("_g", "_n", "path", *extra, "kids", F.col("_i").alias("_up"), F.explode(F.sequence(F.lit(0), F.size("kids") - 1)).alias("_k"))
              .select("_g", "_n", (F.col("_up") * FAN + F.col("_k")).alias("_i"), F.concat(step, F.col("path")).alias("path"), *extra))
        at = at.unionByName(top(level_of == level - 1))
    return at.unionByName(top(level_of < down_to))


def fold_group(rows: list[dict], n: int, path: list[dict], subroot: str, root: str) -> list[tuple]:
    """Results of the rows of one group of FAN * FAN leaves, in row order.
    ``n``: leaves of the whole source; ``path``: what lies above the group."""
    rows = sorted(rows, key=lambda r: r["at"])
    first = [Parent([r["leaf"] for r in rows[k:k + FAN]]) for k in range(0, len(rows), FAN)] if n > 1 else []
    second = Parent([p.digest for p in first]) if n > FAN else None
    above = [Parent(list(step["kids"])) for step in path]
    beyond = "".join(p.siblings(step["slot"]) for p, step in zip(above, path))
    out = []
    for k, r in enumerate(rows):
        digest, proof = r["given"], ""
        if first:
            digest, proof = first[k // FAN].fold(k % FAN, digest), first[k // FAN].siblings(k % FAN)
        if second:
            digest, proof = second.fold(k // FAN, digest), proof + second.siblings(k // FAN)
        for p, step in zip(above, path):
            digest = p.fold(step["slot"], digest)
        out.append((r["id"], r["leaf"], subroot, root, hashlib.sha256((proof + beyond).encode()).hexdigest(), digest, digest == root))
    return out


def manifest(leaves: DataFrame, group_col: str = "source", id_col: str = "doc_id", leaf_col: str = "leaf",
             given_col: str = "given") -> DataFrame:
    """One row per leaf: ``id_col``, leaf, subroot, root, proof_sha256 (of all
    siblings on the way up), folded_root (recomputed from ``given_col`` with the
    original siblings) and whether it equals the root.

    ``leaves`` holds digests as hexadecimal text.  Within a group leaves ascend by
    id, a null id first, ties by digest; groups ascend by their text's bytes,
    the null group first.  Repeated rows are leaves of their own (which of two
    equal ones stands first changes no digest); an empty table gives an empty
    result; other columns are ignored.  A group of any size is spread over
    tasks; a task holds FAN * FAN leaves of one group and the path above them.
    """
    spark = leaves.sparkSession
    bounded_batches(spark)
    text = F.col(group_col).cast("string")
    own = staged(leaves.select(F.col(id_col).alias("_id"), F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), text)).alias("_g"),
                               F.col(leaf_col).alias("digest"), F.col(given_col).alias("_given")), "merkle-leaves")
    nodes = staged(numbered(own, ["_id", "digest"], "merkle-sorted"), "merkle-numbered")
    most = nodes.agg(F.max(depth(F.col("_n")))).first()[0] or 0
    levels = levels_above(nodes, most, "merkle-level")
    sizes = nodes.groupBy("_g").agg(F.max("_n").alias("_n"))

    # the tree of subroots: one group of its own, ordered by the sources' keys
    tops = staged(last_nodes(nodes, levels).withColumnsRenamed({"_g": "_source"}).withColumn("_g", F.lit("")), "merkle-tops")
    tops = staged(numbered(tops, ["_source"], "merkle-tops-sorted"), "merkle-tops-numbered")
    high = levels_above(tops, tops.agg(F.max(depth(F.col("_n")))).first()[0] or 0, "merkle-top-level")
    steps = F.array().cast("array<struct<slot:int,kids:array<string>>>")
    end = last_nodes(tops, high).select("_g", F.col("digest").alias("root"), steps.alias("path"))
    end = tops.select("_g", "_n").distinct().join(end, "_g")
    ends = (tops.select("_i", F.col("_source").alias("_key"), F.col("digest").alias("subroot"))
            .join(paths(high, 0, end), "_i").select(F.col("_key").alias("_g"), "path", "subroot", "root").join(sizes, "_g"))

    over = paths(levels, 2, ends).select("_g", F.col("_i").alias("_c"), "_n", "path", "subroot", "root")
    member = F.struct(F.col("_i").alias("at"), F.col("_id").alias("id"), F.col("digest").alias("leaf"), F.col("_given").alias("given"))
    groups = nodes.groupBy("_g", F.expr(f"_i div {FAN * FAN}").alias("_c")).agg(F.collect_list(member).alias("rows"))
    met = groups.join(over, ["_g", "_c"]).select("rows", "_n", "path", "subroot", "root")
    id_type = leaves.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            ids = b.column(0).type.value_type.field("id").type
            schema = pa.schema([("_id", ids), *((x.split()[0], pa.bool_() if x.endswith("boolean") else pa.string()) for x in RESULT.split(", "))])
            for r in b.to_pylist():
                yield batch(schema, *zip(*fold_group(r["rows"], r["_n"], r["path"], r["subroot"], r["root"])))

    return met.mapInArrow(run, f"_id {id_type}, {RESULT}").withColumnRenamed("_id", id_col)


def document_leaves(docs: DataFrame, columns=LEAF_COLUMNS, group_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
                    every: int = 5) -> DataFrame:
    """(id, source, leaf, given): the rows' leaves, and as ``given`` those of the
    same rows with A-Z of the text in lower case where ``every`` divides the
    unsigned crc32 of the decimal id (never for a null id)."""
    hit = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0, F.lit(False))
    low = [F.translate(F.col(c), UPPER, LOWER) if c == text_col else F.col(c) for c in columns]
    leaf = leaf_hash(*[F.col(c) for c in columns])
    return docs.select(id_col, group_col, leaf.alias("leaf"), F.when(hit, leaf_hash(*low)).otherwise(leaf).alias("given"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(document_leaves(table(spark, sf_dir, "documents")))
