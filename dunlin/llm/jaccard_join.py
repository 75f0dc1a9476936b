"""Exact Jaccard self-join of documents on word n-grams, as a grouped prefix join.

A document's set is its distinct 5-word shingles (64-bit hashes of the words). With s the
threshold and n the size of a set, two sets of similarity s or more share a shingle among the
first n - ceil(s * n) + 1 of each, in any one order of all shingles: the prefix. The order
here is by hash, with shingles of very many groups last.

1. ``signatures``: per document n, a digest of the set, the first shingles of the order (48
   bits of the hash: that can only add candidates) and a parity sketch: bit k tells whether an
   odd number of shingles hash to k. Sketches differ in at most as many bits as the sets have
   shingles apart, so two sketches can rule a pair out, never a link.
2. Groups: documents of one set are one node. Nodes with the same prefix and size, and nodes
   that share one of their first shingles, form stars around four of them; members are
   verified against the centres only. Stars that hold make up groups (``components``).
3. Group pairs: shingles of several groups are joined per group, not per document, so a large
   group meets another in one row per shingle. Shingles of more than ``COMMON_GROUPS`` groups
   move to the end of the order; prefixes then reach further to the next ones (documents of
   which too few are known are read again: ``_short_prefixes``). The members of a group are
   split by classes of size, and the join is on shingle and size class: a part looks only for
   classes whose sets it can still reach with what stands after the shingle, and only parts
   in which the shingle stands early enough for the smaller set can be found.
4. Group pairs that stay are expanded to pairs of members, which pass the same bounds one by
   one. Pairs that are left are verified on the whole texts, and links join the groups.

Nothing emits all pairs within a group, and no link between groups is lost.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from dunlin.llm.common import (
    drop_stage, mix, piece_hash, prefix_sums, sized, stage, text_blocks,
)
from dunlin.llm.components import components
from dunlin.operators.percentiles import global_row_number

WORDS = 5
PERCENT = 75
COMMON_GROUPS = 8
STAR_KEYS = 3
SHORT_ROUNDS = 3  # of nodes read whole; any number finds every link
SIZE_CLASSES = 8  # of the members of a group, from a size to its four thirds
SLACK = 24  # shingles kept beyond the prefix, to stand in for common ones
SKETCH = tuple(f"k{i}" for i in range(8))
SKETCH_BITS = 64 * len(SKETCH)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTORS = mix(np.arange(11, 11 + WORDS, dtype=np.uint64))


def _word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after another, and where each text's begin."""
    data = _LOWER[data]
    space = _SPACE[data]
    word = ~space
    starts, ends = word.copy(), word.copy()
    starts[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    starts[inner] |= word[inner]
    ends[inner - 1] |= word[inner - 1]
    a, b = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return piece_hash(prefix_sums(data), a, b), np.searchsorted(a, cuts)


def _long_word_hashes(data: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """The same for one long text, in parts that end at white space."""
    parts, at = [], 0
    while at < len(data):
        end = min(at + step, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            more = np.flatnonzero(_SPACE[data[end:end + 65536]])
            end = end + int(more[0]) if len(more) else min(end + 65536, len(data))
        parts.append(_word_hashes(data[at:end], np.array([0]))[0])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_sets(batch: pa.RecordBatch, column: str = "text"):
    """Sorted distinct shingle hashes (uint64) of each text of a batch."""
    for _, data, offsets in text_blocks(batch, column):
        if len(offsets) == 2 and len(data) > 1 << 20:
            words = _long_word_hashes(data)
            begin = np.array([0, len(words)])
        else:
            words, begin = _word_hashes(data, offsets)
        grams = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
        for k in range(WORDS):
            grams += words[k:k + len(grams)] * _FACTORS[k]
        grams = mix(grams)
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
            if b - a >= WORDS:
                yield np.unique(grams[a:b - WORDS + 1])
            elif b > a:
                whole = (words[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield mix(np.array([whole], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def _prefix(n):
    """Prefix length of a set of size n (a number or a column)."""
    return n - -(-n * PERCENT // 100) + 1


def _sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles by the last bits of their hash."""
    odd = np.bincount((s & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signer(slack: int, keep_text: bool = False):
    def run(batches):
        for batch in batches:
            sizes, high, low, firsts, sketches = [], [], [], [], []
            for s in shingle_sets(batch):
                n = len(s)
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                sizes.append(n)
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                sketches.append(_sketch(s))
                firsts.append((s[:_prefix(n) + n // 50 + slack] >> np.uint64(16)).astype(np.int64))
            offsets = np.cumsum([0, *map(len, firsts)]).astype(np.int32)
            values = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
            last = [("text", batch.column("text"))] if keep_text else [
                *zip(SKETCH, np.array(sketches, np.int64).reshape(-1, len(SKETCH)).T.copy()),
                ("firsts", pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64())))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(low, pa.int64()), *(c if isinstance(c, pa.Array) else pa.array(c) for _, c in last)],
                names=["doc_id", "n", "d1", "d2", *(name for name, _ in last)])

    return run


_SIGNED = f"doc_id bigint, n bigint, d1 bigint, d2 bigint, {' bigint, '.join(SKETCH)} bigint, firsts array<bigint>"


def signatures(texts: DataFrame, slack: int = SLACK) -> DataFrame:
    """Per row of ``texts`` (doc_id, text): doc_id, n, d1 and d2 (digest), the sketch, firsts."""
    return texts.mapInArrow(_signer(slack), _SIGNED)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    if not len(a) or not len(b) or min(len(a), len(b)) * 100 < max(len(a), len(b)) * PERCENT:
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return both * 100 >= (len(a) + len(b) - both) * PERCENT


def _verifier(batches):
    """Rows of a star, its centre first; stars may run over several batches."""
    centre, key = None, None
    for batch in batches:
        out = ([], [])
        cols = [batch.column(c).to_pylist() for c in ("centre", "part", "is_centre", "doc_id")]
        for c, part, is_centre, doc_id, own in zip(*cols, shingle_sets(batch)):
            if is_centre:
                centre, key = own, (c, part)
            elif key == (c, part) and similar(centre, own):
                out[0].append(doc_id)
                out[1].append(c)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["u", "v"])


def verify(texts: DataFrame, pairs: DataFrame, name: str, per_part: int = 256) -> DataFrame:
    """Staged pairs (u, v) of a staged table, which is deleted, whose texts reach the threshold,
    read from whole texts. All partners of one v meet it in parts of about ``per_part``, so a text is sent
    once for each of its pairs and no part is large."""
    parts = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / per_part).cast("bigint").alias("parts"))
    members = pairs.join(parts, "v").select(
        F.col("u").alias("doc_id"), F.col("v").alias("centre"),
        F.pmod(F.xxhash64("u", "v"), F.col("parts")).alias("part"), F.lit(False).alias("is_centre"))
    centres = parts.select(
        F.col("v").alias("doc_id"), F.col("v").alias("centre"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), F.lit(True).alias("is_centre"))
    roles = stage(members.unionByName(centres), "roles")
    links = stage(
        texts.join(sized(roles), "doc_id")
        .repartition("centre", "part").sortWithinPartitions("centre", "part", F.desc("is_centre"))
        .select("centre", "part", "is_centre", "doc_id", "text")
        .mapInArrow(_verifier, "u bigint, v bigint"), name)
    drop_stage(roles, pairs)
    return links


def _fits(a, b):
    """Sizes that allow the threshold."""
    return (F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT)


def _star_pairs(nodes: DataFrame, keys: int) -> DataFrame:
    """(member, centre) pairs: nodes of one size and prefix, and nodes that share one of their
    ``keys`` first shingles, with four of them: the smallest id, and the least of three hashes.
    A member that is too far from one centre of a large group is near another."""
    prefix = F.slice("firsts", 1, _prefix_column("n").cast("int"))
    own = F.concat(
        F.array(F.struct(F.lit(0).alias("kind"), F.xxhash64("n", prefix).alias("key"))),
        F.transform(F.slice("firsts", 1, keys), lambda x: F.struct(F.lit(1).alias("kind"), x.alias("key"))))
    rows = nodes.select("doc_id", "n", F.inline(own))
    choice = [F.min_by(F.struct("doc_id", "n"), by) for by in (
        F.col("doc_id"), *(F.struct(F.xxhash64("doc_id", F.lit(k)), "doc_id") for k in range(3)))]
    centres = rows.groupBy("kind", "key").agg(F.array(*choice).alias("c"), F.count(F.lit(1)).alias("size")).where(
        "size > 1").select("kind", "key", F.explode(F.array_distinct("c")).alias("c")).select(
        "kind", "key", F.col("c.doc_id").alias("centre"), F.col("c.n").alias("centre_n"))
    return (
        rows.join(centres, ["kind", "key"])
        .where((F.col("doc_id") != F.col("centre")) & _fits(F.col("n"), F.col("centre_n")))
        .select(F.greatest("doc_id", "centre").alias("u"), F.least("doc_id", "centre").alias("v")).distinct()
    )


def _prefix_column(n: str):
    c = F.col(n)
    return c - F.expr(f"(({n} * {PERCENT} + 99) div 100)") + 1


def _as(staged: DataFrame, *columns) -> DataFrame:
    """Columns of a staged table, broadcast if it is small."""
    out = staged.select(*columns)
    out._staged_at = staged._staged_at
    return sized(out)


def _with_root(df: DataFrame, id_column: str, roots: DataFrame, name: str) -> DataFrame:
    """``df`` with the component of a node; one without links is its own."""
    found = _as(roots, F.col("id").alias(id_column), F.col("root").alias("_root"))
    return df.join(found, id_column, "left").withColumn(name, F.coalesce("_root", id_column)).drop("_root")


def _candidates(nodes: DataFrame, read: DataFrame, roots: DataFrame, common: int) -> DataFrame:
    """Staged pairs (u, v) of nodes of different groups whose prefixes and sketches leave the
    threshold possible."""
    rows = nodes.select("doc_id", "n", F.size("firsts").alias("known"), F.posexplode("firsts").alias("pos", "gram"))
    shared = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("gram")
    postings = stage(
        _with_root(rows.join(shared.hint("shuffle_hash"), "gram"), "doc_id", roots, "grp"), "postings")
    several = postings.groupBy("gram").agg(F.min("grp").alias("a"), F.max("grp").alias("b")).where("a <> b").select("gram")
    between = stage(postings.join(several, "gram"), "between-groups")
    drop_stage(postings)
    frequent = stage(_frequent(between, common), "common")
    is_common = sized(frequent).withColumn("common", F.lit(1))
    one = Window.partitionBy("doc_id")
    before = one.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = stage(
        between.join(is_common, "gram", "left").fillna(0, ["common"])
        .withColumn("seen", F.sum("common").over(before)).withColumn("all", F.sum("common").over(one))
        # place in the order with common shingles last
        .withColumn("place", F.when(F.col("common") == 0, F.col("pos") - F.col("seen"))
                    .otherwise(F.col("known") - F.col("all") + F.col("seen") - 1))
        .withColumn("p", _prefix_column("n")).where("place < p or (known - all < p and known < n)"), "placed")
    drop_stage(between)
    kept = placed.where("place < p").select(
        "gram", "doc_id", "n", "grp", (F.col("n") - F.col("place")).alias("rest"))
    # nodes whose known shingles, less the common ones, do not fill the prefix
    short = stage(placed.where("known - all < p and known < n").select("doc_id", "grp").distinct(), "short")
    more = []
    if not short.isEmpty():
        extra, more = _short_prefixes(nodes, read, roots, short, frequent, common)
        kept = kept.unionByName(extra).groupBy("gram", "doc_id", "n", "grp").agg(F.max("rest").alias("rest"))
    kept = stage(kept.withColumn("cls", _size_class(F.col("n"))), "prefixes")
    drop_stage(placed, frequent, short, *more)
    sketches = stage(nodes.select("doc_id", *SKETCH), "sketches")
    # shingles of many groups, by what has become of the prefixes
    many = stage(_frequent(kept, common), "many-groups")
    meet = stage(_group_pairs(
        kept.join(sized(many).withColumn("common", F.lit(1)), "gram", "left").fillna(0, ["common"]), sketches), "group-pairs")
    pairs = stage(_member_pairs(meet, kept, sketches), "pairs")
    drop_stage(kept, meet, sketches, many)
    return pairs


def _frequent(rows: DataFrame, common: int) -> DataFrame:
    """Shingles that stand in rows (gram, grp) of more than ``common`` groups."""
    return rows.groupBy("gram", "grp").agg(F.lit(1).alias("one")).groupBy("gram").agg(
        F.count(F.lit(1)).alias("groups")).where(f"groups > {common}").select("gram")


def _size_class(n):
    return F.floor(F.ln(n) * (SIZE_CLASSES / math.log(100 / PERCENT))).cast("int")


def _group_pairs(kept: DataFrame, sketches: DataFrame) -> DataFrame:
    """A row for each prefix shingle that parts (classes cla, clb, cla not below clb) of two
    groups (ga, gb) share, if it can be the first that two members share. ``rest`` is the number
    of a set's shingles from this one on, or more; ``ra``, ``rb`` the most of the part; the
    overlap needed is percent / (100 + percent) of both sizes. ``da``, ``db``: the only member
    of a part, else NULL. Where many groups share a shingle, parts of one member bring its
    sketch along, so that those that are too far apart make no row."""
    sides = kept.groupBy("gram", "common", "grp", "cls").agg(
        F.min("n").alias("l"), F.max("n").alias("m"), F.max("rest").alias("r"),
        F.when(F.min("doc_id") == F.max("doc_id"), F.min("doc_id")).alias("d"))
    # the larger set is not below the class of the smaller one, which bounds the overlap needed
    least = F.floor(F.exp(F.col("cls") / (SIZE_CLASSES / math.log(100 / PERCENT)))) - 1
    smaller = sides.where(F.col("r") * (100 + PERCENT) >= (F.col("l") + least) * PERCENT)
    names = {"grp": "g", "cls": "c", **{k: k for k in "lmrd"}}
    fits = ["ga <> gb and (ca > cb or ca = cb and ga < gb)", f"mb * 100 >= la * {PERCENT}", f"ma * 100 >= lb * {PERCENT}",
            f"least(ra, rb) * {100 + PERCENT} >= (la + lb) * {PERCENT}"]

    def side(df, x, common):
        out = df.where(F.col("common") == common).select("gram", *(F.col(c).alias(f"{k}{x}") for c, k in names.items()))
        return _sketched(out, sketches, f"d{x}", "left") if common else out

    rare = side(sides, "a", 0).join(side(smaller, "b", 0), "gram").where(" and ".join(fits))
    near = f"(da is null or db is null or {_near('da', 'db', 'ma + mb')})"
    frequent = side(sides, "a", 1).join(side(smaller, "b", 1), "gram").where(" and ".join([*fits, near]))
    return rare.unionByName(frequent.select(rare.columns))


def _near(a: str, b: str, sizes: str) -> str:
    """Whether two sketches leave the threshold possible for sets of ``sizes`` together: at
    most (100 - percent) / (100 + percent) of that are in one set only."""
    apart = " + ".join(f"bit_count({a}{k} ^ {b}{k})" for k in SKETCH)
    return f"({apart}) * {100 + PERCENT} <= ({sizes}) * {100 - PERCENT}"


def _sketched(df: DataFrame, sketches: DataFrame, column: str, how: str = "inner") -> DataFrame:
    """``df`` with the sketch of the node in ``column``, in columns led by its name."""
    found = _as(sketches, F.col("doc_id").alias("_id"), *(F.col(k).alias(f"{column}{k}") for k in SKETCH))
    return df.join(found, F.col(column) == F.col("_id"), how).drop("_id")


def _near_members(alone: DataFrame, kept: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (u, v) of a node (db, of size lb) and the members u of a part (ga, ca) that it shares
    a prefix shingle with, for which the bounds and those of the sketches hold. ``alone``: staged
    (ga, ca, db, lb, rb), rb the most that is left of the node's shingles from a shared one on."""
    parts = _as(stage(alone.select("ga", "ca").distinct(), "several-parts"), "ga", "ca")
    members = kept.selectExpr("grp as ga", "cls as ca", "doc_id as u", "n as nu", "rest as ru").join(
        parts, ["ga", "ca"], "left_semi").groupBy("ga", "ca", "u", "nu").agg(F.max("ru").alias("ru"))
    nodes = stage(_sketched(alone, sketches, "db"), "sketched-nodes")
    return _sketched(members, sketches, "u").join(sized(nodes), ["ga", "ca"]).where(" and ".join([
        f"least(ru, rb) * {100 + PERCENT} >= (nu + lb) * {PERCENT}", f"lb * 100 >= nu * {PERCENT}", f"nu * 100 >= lb * {PERCENT}",
        _near("u", "db", "nu + lb")])).selectExpr("u", "db as v")


def _member_pairs(meet: DataFrame, kept: DataFrame, sketches: DataFrame) -> DataFrame:
    """Distinct pairs (u, v) of members of parts that meet, for which the bounds of the parts
    and those of their sketches hold one by one."""
    single = meet.where("da is not null and db is not null").selectExpr("da as u", "db as v", "la + lb as sizes").distinct()
    found = _sketched(_sketched(single, sketches, "u"), sketches, "v").where(_near("u", "v", "sizes")).select("u", "v")
    # part a has several members; part b may be a single node, which is then known
    columns = [f"{k}{x}" for x in "ab" for k in "gclmrd"]
    swapped = ["gram", *(f"{c[0]}{'ab'[c[1] == 'a']} as {c}" for c in columns)]
    several = stage(meet.where("da is null").select("gram", *columns).unionByName(
        meet.where("da is not null and db is null").selectExpr(*swapped)), "several-members")
    # a node meets a part once, however many shingles they share
    alone = stage(several.where("db is not null").groupBy("ga", "ca", "db", "lb").agg(F.max("rb").alias("rb")), "parts-and-nodes")
    found = found.unionByName(_near_members(alone, kept, sketches))
    keys = ["gram", "ga", "ca"]
    members = kept.selectExpr("gram", "grp as ga", "cls as ca", "doc_id as u", "n as nu", "rest as ru")
    first = several.where("db is null").join(members, keys).where(" and ".join([
        f"least(ru, rb) * {100 + PERCENT} >= (nu + lb) * {PERCENT}", f"mb * 100 >= nu * {PERCENT}", f"nu * 100 >= lb * {PERCENT}"]))
    other = kept.selectExpr("gram", "grp as gb", "cls as cb", "doc_id as v", "n as nv", "rest as rv")
    both = first.select("gram", "gb", "cb", "u", "nu", "ru").join(other, ["gram", "gb", "cb"]).where(" and ".join([
        f"nv * 100 >= nu * {PERCENT}", f"nu * 100 >= nv * {PERCENT}",
        f"least(ru, rv) * {100 + PERCENT} >= (nu + nv) * {PERCENT}"])).selectExpr("u", "v", "nu + nv as sizes").distinct()
    both = _sketched(_sketched(both, sketches, "u"), sketches, "v").where(_near("u", "v", "sizes")).select("u", "v")
    return found.unionByName(both).selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct()


def _short_prefixes(nodes: DataFrame, read: DataFrame, roots: DataFrame, short: DataFrame, frequent: DataFrame, common: int
                    ) -> tuple[DataFrame, list[DataFrame]]:
    """Prefix rows of the nodes in ``short``, from their whole texts, and the rows of other
    nodes' known shingles that can meet them there (more than their prefixes, which can only
    add candidates); the staged tables they are read from.

    Nodes that share most of their text reach shingles here that stand in many of them, but
    among the first of none, and so are not in ``frequent`` yet. They are common too, and the
    nodes whose known shingles then leave the prefix open are read whole as well. The order
    with all of these last holds for every pair with a node that is read whole."""
    known = nodes.select("doc_id", "n", F.size("firsts").alias("known"), F.explode("firsts").alias("gram"))
    tables, whole = [], None
    for again in range(SHORT_ROUNDS, 0, -1):
        found = stage(
            signatures(read.join(_as(short, "doc_id"), "doc_id", "left_semi"), slack=1 << 62)
            .select("doc_id", "n", F.posexplode("firsts").alias("pos", "gram")).join(_as(short, "doc_id", "grp"), "doc_id"), "whole-sets")
        tables.append(found)
        whole = found if whole is None else whole.unionByName(found)
        if again == 1:
            break
        new = stage(_frequent(whole.join(sized(frequent), "gram", "left_anti"), common), "more-common")
        tables.append(new)
        if new.isEmpty():
            break
        frequent = stage(frequent.unionByName(new), "all-common")
        tables.append(frequent)
        unfilled = (
            known.join(sized(frequent), "gram", "left_semi").groupBy("doc_id", "n", "known").agg(F.count(F.lit(1)).alias("all"))
            .where(F.col("known") - F.col("all") < _prefix_column("n")).select("doc_id")
            .join(whole.select("doc_id").distinct(), "doc_id", "left_anti"))
        short = stage(_with_root(unfilled, "doc_id", roots, "grp"), "short")
        tables.append(short)
        if short.isEmpty():
            break
    order = Window.partitionBy("doc_id").orderBy("common", "pos")
    prefix = stage(
        whole.join(sized(frequent).withColumn("common", F.lit(1)), "gram", "left").fillna(0, ["common"])
        .withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < _prefix_column("n"))
        .select("gram", "doc_id", "n", "grp", (F.col("n") - F.col("place")).alias("rest"), "common"), "short-prefixes")
    grams = stage(prefix.where("common = 0").select("gram").distinct(), "short-grams")
    others = known.join(sized(grams), "gram", "left_semi").select("doc_id", "n", "gram")
    return prefix.drop("common").unionByName(_with_root(others, "doc_id", roots, "grp").select(
        "gram", "doc_id", "n", "grp", F.col("n").alias("rest"))), [*tables, prefix, grams]


def _own_nodes(linked: DataFrame, read: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """``linked`` and ``read`` with a doc_id of its own for each set of an id that has several,
    and the staged (node, doc_id) of the new ones: None if no id has several. The least set of
    an id keeps it; the new ids lie beyond all given ones."""
    digest = F.struct("d1", "d2", "n")
    several = stage(linked.groupBy("doc_id").agg(F.min(digest).alias("a"), F.max(digest).alias("b")).where("a <> b")
                    .select("doc_id", "a"), "several-sets")
    if several.isEmpty():
        return linked, read, None
    more = stage(linked.select("doc_id", "d1", "d2", "n").join(several, "doc_id").where(digest != F.col("a"))
                 .drop("a").distinct(), "more-sets")
    low, high = linked.agg(F.min("doc_id"), F.max("doc_id")).first()
    base = high if high + more.count() < 1 << 63 else low - more.count() - 1
    numbered = global_row_number(more.withColumn("tie", digest), "doc_id", "tie", "nth")
    nodes = stage(numbered.withColumn("node", F.col("nth") + F.lit(base).cast("bigint")).drop("nth", "tie"), "more-nodes")
    key = ["doc_id", "d1", "d2", "n"]

    def renamed(df, column):
        return df.join(nodes, key, "left").select(
            F.coalesce("node", "doc_id").alias("doc_id"), *[c for c in (*key[1:], *SKETCH) if column != "text"], column)

    ids = _as(several, "doc_id")
    signed = read.join(ids, "doc_id", "left_semi").mapInArrow(
        _signer(0, keep_text=True), "doc_id bigint, n bigint, d1 bigint, d2 bigint, text string")
    whole = stage(renamed(signed.where("n > 0"), "text"), "several-texts", compression="zstd")
    return renamed(linked, "firsts"), read.join(ids, "doc_id", "left_anti").unionByName(whole), nodes.select("node", "doc_id")


def near_duplicates(docs: DataFrame, common: int = COMMON_GROUPS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Two documents link if their 5-word shingle sets (words: runs of characters other than
    ASCII white space, A-Z lower-cased; fewer words: the whole sequence) have a Jaccard
    similarity of 75 % or more. component_id is the smallest doc_id reachable by links,
    itself included. NULL texts and texts without words have an empty set and no links. Rows
    without a doc_id get no component and take no part. Rows that repeat a doc_id are one
    document that links if any of its texts does. Extra columns are ignored; an empty table
    gives no rows.
    """
    texts = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    signed = stage(signatures(texts), "signatures", compression="zstd")
    linked, read, more = _own_nodes(
        signed.where("n > 0 and doc_id is not null"), texts.where("text is not null and doc_id is not null"))
    first = linked.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"))
    copies = stage(
        linked.select("doc_id", "d1", "d2", "n").join(first, ["d1", "d2", "n"]).where("doc_id <> rep")
        .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).distinct(), "copies")
    away = _as(copies, F.col("u").alias("doc_id"))
    nodes = linked.select("doc_id", "n", *SKETCH, "firsts").join(away, "doc_id", "left_anti")
    edges = copies
    if more is not None:
        edges = edges.unionByName(more.select(F.col("node").alias("u"), F.col("doc_id").alias("v")))
    edges = edges.unionByName(verify(read, stage(_star_pairs(nodes, STAR_KEYS), "star-pairs"), "star-links"))
    roots = _components(edges)
    links = verify(read, _candidates(nodes, read, roots, common), "links")
    drop_stage(roots)
    final = _components(edges.unionByName(links))
    if more is not None:  # the smallest of the given ids
        given = final.join(more, final.id == more.node, "left_anti")
        least = given.unionByName(given.selectExpr("root as id", "root").join(more, F.col("root") == more.node, "left_anti")).groupBy(
            "root").agg(F.min("id").alias("least"))
        final = stage(given.join(least, "root").select("id", F.col("least").alias("root")), "given-roots")
    out = signed.select("doc_id", F.col("n").alias("n_shingles"))
    return _with_root(out, "doc_id", final, "component_id").select("doc_id", "n_shingles", "component_id")


def _components(edges: DataFrame) -> DataFrame:
    return stage(components(edges), "roots")

