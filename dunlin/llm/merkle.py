"""Merkle manifest of a table: checkpoint and recompute.

Rows are leaves of one binary tree per value of a tree column; the subroots are leaves of a
tree of their own, whose root names the table. Only every ``STRIDE`` levels are stored. A proof
needs the levels between as well: they are regenerated for one aligned subtree at a time from
its 2**STRIDE stored descendants, the siblings are emitted, and the rest is dropped. No step
holds more than one aligned subtree of a tree, however large the tree or the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from dunlin.llm.common import drop_stage, sized, stage

STRIDE = 8
FANOUT = 1 << STRIDE

_STEPS = "array<struct<left: string, right: string>>"


def hashed(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return hashed(*(field(v) for v in values))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(steps, leaf, lambda h, s: hashed(s["left"], h, s["right"]))


def siblings_digest(steps: Column) -> Column:
    """Hash of the siblings of a proof, from the leaf up."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``pos``, the place of each row among those of its ``tree`` from 0 on, and
    ``n``, their number. Rows are dealt into sorted ranges of (tree, order), so that a tree of
    any size spreads over many; places are counted within a range and shifted by the rows of
    the ranges before it (one number per range and tree)."""
    by = [F.col("tree"), *order]
    cut = stage(
        df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("__at", 33).alias("__part")
    runs = cut.groupBy("tree", part).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy("tree")
    runs = stage(runs.select(
        F.col("tree").alias("__tree"), "__part",
        (F.sum("__rows").over(whole.orderBy("__part")) - F.col("__rows") - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(whole).alias("n")), "ranges")
    where = (F.col("tree") == F.col("__tree")) & (F.shiftright("__at", 33) == F.col("__part"))
    return cut.join(sized(runs), where).withColumn("pos", F.col("__at") + F.col("__shift")).drop(
        "__at", "__tree", "__part", "__shift")


def _subtrees(level: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row per aligned subtree of a stored level: its nodes by place, in ``items``, and the
    levels regenerated above them, ``l0`` to ``l8``. A subtree that is the top of its tree ends
    where one node remains; the levels above that are NULL."""
    nodes = level.groupBy("tree", F.shiftright("pos", STRIDE).alias("pos")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "h", *carried))).alias("items"))
    out = nodes.withColumn("l0", F.transform("items", lambda x: F.lower(F.hex(x["h"]))))
    for i in range(STRIDE):
        pairs = F.expr(f"transform(sequence(0, size(l{i}) - 1, 2), "
                       f"i -> sha2(concat(get(l{i}, i), coalesce(get(l{i}, i + 1), '')), 256))")
        out = out.withColumn(f"l{i + 1}", F.when((F.col("n") > FANOUT) | (F.size(f"l{i}") > 1), pairs))
    return out


def _above(level: DataFrame) -> DataFrame:
    """The next stored level: the tops of the subtrees. ``top``: its tree ends here."""
    tops = F.coalesce(*(F.col(f"l{i}") for i in range(STRIDE, -1, -1)))
    return _subtrees(level).select(
        "tree", "pos", F.ceil(F.col("n") / FANOUT).alias("n"), (F.col("n") <= FANOUT).alias("top"),
        F.unhex(F.element_at(tops, 1)).alias("h"))


def _climb(leaves: DataFrame) -> list[DataFrame]:
    """The stored levels above ``leaves`` (tree, pos, n, h), lowest first."""
    levels, now = [], leaves
    while True:
        levels.append(stage(_above(now), "level"))
        now = levels[-1].where(~F.col("top"))
        if now.isEmpty():
            return levels


def _descend(level: DataFrame, above: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Each node of a stored level with its ``steps`` to the root: those inside its subtree,
    then those of the subtree's top, which ``above`` has by (tree, pos)."""
    ended = F.array(*(F.when(F.col(f"l{i + 1}").isNotNull(), F.col(f"l{i}")) for i in range(STRIDE)))
    whole = _subtrees(level, carried).withColumn("inner", F.filter(ended, lambda x: x.isNotNull()))
    steps = F.expr("""transform(inner, (row, i) -> named_struct(
        'left', if(shiftright(k, i) % 2 = 1, get(row, shiftright(k, i) - 1), ''),
        'right', if(shiftright(k, i) % 2 = 0, coalesce(get(row, shiftright(k, i) + 1), ''), '')))""")
    found = whole.select("tree", "pos", "items", "inner").join(above, ["tree", "pos"])
    return (
        found.select("tree", "subroot", "inner", F.col("steps").alias("outer"), F.posexplode("items").alias("k", "node"))
        .select("tree", "subroot", "node.*", F.concat(steps, "outer").alias("steps"))
    )


def _proofs(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Proofs of all leaves, level by level from the top; ``tops`` (tree, subroot, steps) has
    what lies above each tree."""
    above = None
    for k in reversed(range(len(levels))):
        ended = levels[k].where("top").select("tree", "pos").join(sized(tops), "tree")
        here = ended if above is None else ended.unionByName(above.select("tree", "pos", "subroot", "steps"))
        here = stage(here, "steps")
        below = leaves if k == 0 else levels[k - 1].where(~F.col("top"))
        above = _descend(below, sized(here), carried if k == 0 else ())
    return above


@dataclass
class Manifest:
    """``leaves`` (tree, pos, n, h and the carried columns), the stored ``levels`` above them,
    the tree over the subroots in the same form, and the ``root`` (NULL for an empty table)."""

    leaves: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame
    top_levels: list[DataFrame]
    root: str | None
    carried: list[str]

    def proofs(self) -> DataFrame:
        """One row per leaf: the carried columns, ``leaf``, ``subroot`` and ``steps``, the
        siblings (left, right; empty where there is none) from the leaf's level to the root."""
        none = self.subroots.sparkSession.range(1).select(
            F.lit("").alias("tree"), F.lit(self.root).alias("subroot"), F.array().cast(_STEPS).alias("steps"))
        tops = _proofs(self.subroots, self.top_levels, stage(none, "apex"), ["name"])
        tops = stage(tops.select(
            F.col("name").alias("tree"), F.lower(F.hex("h")).alias("subroot"), "steps"), "tops")
        out = _proofs(self.leaves, self.levels, tops, self.carried)
        return out.select(*self.carried, F.lower(F.hex("h")).alias("leaf"), "subroot", "steps")


def build(rows: DataFrame, leaf: Column, tree: str, order: str, carried: dict[str, Column] | None = None) -> Manifest:
    """Manifest of ``rows``: a tree per value of ``tree``, leaves by ``order`` (NULL first; ties
    by leaf, so equal tables give equal roots), subroots by ``tree`` (NULL first, then by UTF-8
    bytes). ``carried`` names further values to keep with each leaf.

    NULLs anywhere are values like others, repeated rows are leaves of their own, an empty table
    has no root and no proofs; other columns are ignored. Texts are read once.
    """
    carried = carried or {}
    key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    taken = stage(rows.select(
        key.alias("tree"), F.col(order).alias("__order"), F.unhex(leaf).alias("h"), *(c.alias(k) for k, c in carried.items()),
    ).withColumn("__row", F.monotonically_increasing_id()), "leaves")
    leaves = _placed(taken, [F.col("__order").asc_nulls_first(), F.col("h"), F.col("__row")]).drop("__order", "__row")
    leaves = stage(leaves, "placed")
    drop_stage(taken)
    levels = _climb(leaves.select("tree", "pos", "n", "h"))
    ended = levels[0].where("top")
    for level in levels[1:]:
        ended = ended.unionByName(level.where("top"))
    subroots = _placed(ended.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "h"), [F.col("name")])
    subroots = stage(subroots, "subroots")
    top_levels = _climb(subroots.select("tree", "pos", "n", "h"))
    last = top_levels[-1].where("top").select(F.lower(F.hex("h"))).first()
    return Manifest(leaves, levels, subroots, top_levels, last and last[0], list(carried))
