"""The manifest against a plain tree: odd rows, ties, every size around the stored levels."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from dunlin.llm import merkle

SCHEMA = "doc_id bigint, lang string, text string, tree string, pos int, n int, h string, steps int, items int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves):
    """The root and the siblings of each leaf, from the leaf up."""
    proofs, level, places = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, at in enumerate(places):
            other = at ^ 1
            if other < len(level):
                proofs[k].append(level[other])
        level = [sha(*level[i:i + 2]) for i in range(0, len(level), 2)]
        places = [p // 2 for p in places]
    return level[0], proofs


def plain_manifest(rows):
    trees = {}
    for doc_id, lang, text in rows:
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, sha(field(doc_id), field(lang), field(text)), doc_id))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    subs = {t: plain_tree([x[2] for x in sorted(trees[t], key=lambda x: x[:3])]) for t in names}
    root, tops = plain_tree([subs[t][0] for t in names])
    return root, sorted(
        (repr(x[3]), x[2], subs[t][0], sha(*proof, *tops[names.index(t)]))
        for t in names for x, proof in zip(sorted(trees[t], key=lambda x: x[:3]), subs[t][1]))


def built(spark, rows):
    df = spark.createDataFrame([(i, lang, text, "x", 7, 8, "h", 9, 1) for i, lang, text in rows], SCHEMA)
    return merkle.build(df, merkle.leaf_of(F.col("doc_id"), F.col("lang"), F.col("text")), "lang", "doc_id",
                        {"doc_id": F.col("doc_id")})


@pytest.mark.parametrize("seed", [1, 2])
def test_manifest_equals_plain_trees(spark, seed):
    rng = random.Random(seed)
    sizes = {None: 3, "": 1, "en": 700 if seed == 1 else 257, "é": 256, "zz": 255, "Z": 2}
    rows = [(rng.randrange(600), lang, f"text {k % 9}") for lang, n in sizes.items() for k in range(n)]
    rows += [(None, "en", None), (None, "en", None), (None, None, ""), (5, "en", "x" * 5_000), (5, "en", "x" * 5_000)]
    root, want = plain_manifest(rows)
    manifest = built(spark, rows)
    assert manifest.root == root and manifest.levels[0].count() < len(rows) / 100 + len(sizes)
    proofs = manifest.proofs()
    assert merkle.FANOUT == 256 and proofs.columns == ["doc_id", "leaf", "subroot", "steps"]
    got = proofs.select("doc_id", "leaf", "subroot", merkle.siblings_digest(F.col("steps")).alias("proof"),
                        merkle.fold(F.col("leaf"), F.col("steps")).alias("root"))
    got = got.collect()
    assert sorted((repr(r.doc_id), r.leaf, r.subroot, r.proof) for r in got) == want
    assert {r.root for r in got} == {root}


def test_small_manifests(spark):
    root, want = plain_manifest([(1, "en", "a")])
    one = built(spark, [(1, "en", "a")])
    row = one.proofs().first()
    assert one.root == root == row.leaf == row.subroot and row.steps == []
    none = built(spark, [])
    assert none.root is None and none.proofs().collect() == []


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    manifest = built(spark, [(k, "en" if k % 3 else "de", "t") for k in range(40)])
    other = F.concat(F.substring("leaf", 2, 63), F.lit("0"))
    folded = manifest.proofs().select(merkle.fold(other, F.col("steps")).alias("r"))
    assert folded.where(F.col("r") == manifest.root).count() == 0
