"""Merkle manifests of datasets by sibling-shift self-joins.

Every row is a leaf, every group of rows (a source) a tree, and the roots of the groups are the leaves of one more tree.
On each level a node computes the places of its siblings (its own place with the last bit flipped in a binary tree, its slot
moved by 1, 2, ... within the run otherwise) and an equi join brings their hashes; the node in slot zero then emits the parent.
So keys of all joins are single nodes, however large a group is. The siblings found on the way are the proofs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenvox.llm.common import cut

#: Rows of the table of places that are joined by broadcast; with more of them it is joined by a shuffle.
BROADCAST_PLACES = 20_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(fields: list[Column]) -> Column:
    """Lower-case sha256 of ``fields``: "-" for null, else the bytes of the value's UTF-8 text, ":" and the text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds idx, the place of a row in its group by ``order`` (from 0, nulls first), and size, the rows of the group.

    Rows are sorted by ranges of (group, order), so that a large group is spread over many tasks; what
    the ranges before it hold of a group is added to a row's place in its own range.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut(parts.select(group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size")))
    side = F.broadcast(parts) if parts.count() <= BROADCAST_PLACES else parts
    return placed.join(side, [group, "_part"]).withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _level(nodes: DataFrame, fan: int) -> DataFrame:
    """One level: grp, idx, size, hash, carried, left, right (the siblings' hashes before and after, as hex text).

    ``nodes`` has grp, idx, size, hash (binary) and carried; groups with one node have no level.
    """
    several = nodes.filter("size > 1")
    if fan == 2:
        places = F.array(F.col("idx").bitwiseXOR(F.lit(1).cast("long")))
    else:
        slot = F.pmod("idx", F.lit(fan))
        places = F.transform(F.sequence(F.lit(1), F.lit(fan - 1)), lambda d: F.col("idx") - slot + F.pmod(slot + d, F.lit(fan)))
    wanted = several.select("grp", "idx", F.explode(F.filter(places, lambda p: p < F.col("size"))).alias("sibling"))
    known = several.select("grp", F.col("idx").alias("sibling"), "hash")
    kind = nodes.schema["carried"].dataType
    found = wanted.join(known, ["grp", "sibling"]).select("grp", "idx", "sibling", "hash", F.lit(None).cast("long").alias("size"), F.lit(None).cast(kind).alias("carried"))
    own = several.select("grp", "idx", F.col("idx").alias("sibling"), "hash", "size", "carried")
    run = found.unionByName(own).groupBy("grp", "idx").agg(
        F.array_sort(F.collect_list(F.struct("sibling", "hash"))).alias("run"),  # a run: ``fan`` nodes at most
        F.max("size").alias("size"),
        F.first("carried", ignorenulls=True).alias("carried"),
    )
    joined = lambda keep: F.array_join(F.transform(F.filter("run", lambda x: keep(x["sibling"])), lambda x: _hex(x["hash"])), "")
    mine = F.get(F.filter("run", lambda x: x["sibling"] == F.col("idx")), F.lit(0))["hash"]
    return run.select("grp", "idx", "size", mine.alias("hash"), "carried", joined(lambda s: s < F.col("idx")).alias("left"), joined(lambda s: s > F.col("idx")).alias("right"))


def _tree(leaves: DataFrame, largest: int, fan: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels from the leaves up, each a table, and the roots (grp, level, hash) with the level that each group ends on."""
    levels, nodes, k = [], leaves, 0
    root = lambda nodes, k: nodes.filter("size = 1").select("grp", F.lit(k).alias("level"), "hash")
    roots = root(nodes, 0)
    while largest > 1:
        levels.append(cut(_level(nodes, fan)))
        first = levels[-1].filter(F.pmod("idx", F.lit(fan)) == 0)
        parent = F.unhex(F.sha2(F.concat(_hex(F.col("hash")), F.col("right")), 256))
        nodes = first.select("grp", (F.col("idx") / fan).cast("long").alias("idx"), F.ceil(F.col("size") / fan).cast("long").alias("size"), parent.alias("hash"), F.lit(None).cast("boolean").alias("carried"))
        largest, k = -(-largest // fan), k + 1
        roots = roots.unionByName(root(nodes, k))
    return levels, roots


def _paths(levels: list[DataFrame], tops: DataFrame, fan: int) -> DataFrame:
    """Leaves that have siblings or cousins: grp, idx, hash, carried, subroot and steps, from the leaf up.

    ``tops`` has of each group the level of its root, the steps from there on and the subroot. Paths are put together
    from the top down, so that what the nodes of a run have in common is put together once.
    """
    above = None
    for k in range(len(levels) - 1, -1, -1):
        ends = tops.filter(F.col("level") == k + 1).select("grp", F.lit(0).cast("long").alias("up"), "steps", "subroot")
        above = ends if above is None else ends.unionByName(above)
        here = levels[k].withColumn("up", F.floor(F.col("idx") / fan).cast("long"))
        step = F.array(F.struct("left", "right"))
        here = here.join(above, ["grp", "up"]).select("grp", "idx", "hash", "carried", F.concat(step, F.col("steps")).alias("steps"), "subroot")
        above = here.select("grp", F.col("idx").alias("up"), "steps", "subroot")
    return here


def merkle_manifest(docs: DataFrame, fan: int = 16, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, carried: Column | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, carried, leaf, subroot, root (hex text) and steps.

    The leaves of a group ascend by id, and every ``fan`` consecutive nodes of a level (the last of them may
    be fewer, even one) make the one above, down to a single node, the subroot; subroots in code point order of their groups make
    the root in the same way. ``steps`` are the (left, right) siblings of each level that the row's way up has, from the leaf on, each as
    joined hex text. ``carried`` is an expression over ``docs`` that is handed on.

    Null values hash as "-", a null group is a group of its own and comes first, null ids come first in it. Repeated ids are ordered
    by their leaves; equal rows are leaves of their own, next to each other. A single leaf is its group's subroot, a single subroot the root, with
    no step. Empty and very long texts are values like any other, an empty table gives no rows, and columns not in ``fields`` are not read.
    """
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"),
        F.col(id_col).alias("id"),
        F.unhex(leaf_hash([F.col(c) for c in fields])).alias("hash"),
        (F.lit(None).cast("string") if carried is None else carried).alias("what"),
    )
    leaves = numbered(rows, "grp", ["id", "hash"]).select("grp", "idx", "size", "hash", F.struct("id", "what").alias("carried"))
    levels, roots = _tree(leaves, leaves.agg(F.max("size")).first()[0] or 0, fan)
    subroots = numbered(cut(roots).withColumn("all", F.lit("")), "all", ["grp"])
    subroots = subroots.select(F.lit("").alias("grp"), "idx", "size", "hash", F.struct(F.col("grp").alias("of"), "level").alias("carried"))
    top_levels, top = _tree(subroots, subroots.agg(F.max("size")).first()[0] or 0, fan)
    root = top.first()
    none = F.array().cast("array<struct<left:string,right:string>>")
    if top_levels:
        ends = _paths(top_levels, top.select("grp", "level", none.alias("steps"), F.lit(None).cast("string").alias("subroot")), fan)
    else:
        ends = subroots.withColumn("steps", none)
    tops = cut(ends.select(F.col("carried.of").alias("grp"), F.col("carried.level").alias("level"), "steps", _hex(F.col("hash")).alias("subroot")))
    alone = leaves.filter("size = 1").join(tops.drop("level"), "grp").select("carried", "hash", "steps", "subroot")
    found = _paths(levels, tops, fan).select("carried", "hash", "steps", "subroot").unionByName(alone) if levels else alone
    whole = None if root is None else bytes(root["hash"]).hex()
    return found.select(F.col("carried.id").alias("doc_id"), F.col("carried.what").alias("carried"), _hex(F.col("hash")).alias("leaf"), "subroot", F.lit(whole).cast("string").alias("root"), "steps")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that ``leaf`` and the siblings of its ``steps`` make."""
    return F.aggregate(steps, leaf, lambda found, s: F.sha2(F.concat(s["left"], found, s["right"]), 256))


def proof_hash(steps: Column) -> Column:
    """sha256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest_digests(docs: DataFrame, fan: int = 16, every: int = 5) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified; see ``merkle_manifest``.

    Documents with a doc_id whose crc32 ``every`` divides are verified with A-Z of their text in lower case, the
    others (a null doc_id, too) as they are. A null text, or one without A-Z, is not changed by it and is verified.
    """
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(every)) == 0
    other = [F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in FIELDS]
    found = merkle_manifest(docs, fan, carried=F.when(chosen, leaf_hash(other)))
    found = found.withColumn("folded_root", folded(F.coalesce("carried", "leaf"), F.col("steps")))
    return found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("steps")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
