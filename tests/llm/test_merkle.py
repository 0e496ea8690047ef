"""Merkle manifests against trees built in memory."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from onomast.llm import merkle, queries


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def path(levels, i):
    steps = []
    for level in levels[:-1]:
        s = i // 16 * 16
        steps.append((level[s:i], level[i + 1 : s + 16]))
        i //= 16
    return steps


def plain_manifest(rows):
    """``rows``: id, group, leaf, other."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, r[2], r[3], r[0]))
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[k])]) for k in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for n, k in enumerate(names):
        for i, (_, _, leaf, other, doc_id) in enumerate(sorted(groups[k])):
            steps, x = path(trees[n], i) + path(top, n), other
            for left, right in steps:
                x = digest(*left, x, *right)
            out.append((doc_id, leaf, trees[n][-1][0], top[-1][0], digest(*(d for left, right in steps for d in (*left, *right))), x))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")


def held(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("depth", [1, 3])
def test_trees(spark, depth):
    """With one level a block the largest group takes three rounds, and so do the groups."""
    rng = random.Random(depth)
    sizes = [1, 2, 15, 16, 17, 256, 257, 600] + [1] * 280
    rows = [(rng.randrange(10**9), None if g == 3 else "" if g == 4 else f"é{g}" if g % 2 else f"z{g}", rng.random()) for g, n in enumerate(sizes) for _ in range(n)]
    rows = [(i, g, digest(str(x)), digest("other", str(x)) if i % 3 == 0 else digest(str(x))) for i, g, x in rows]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, source string, leaf string, other string, grp string, place int").repartition(5)
    assert held(merkle.manifest(frame, "doc_id", "source", F.col("leaf"), F.col("other"), depth=depth)) == plain_manifest(rows)


def test_ties_nulls_and_small_tables(spark):
    kind = "doc_id bigint, source string, leaf string"
    make = lambda rows: merkle.manifest(spark.createDataFrame(rows, kind), "doc_id", "source", F.col("leaf"))
    same = [(1, "a", digest("x")), (1, "a", digest("x")), (None, "a", digest("y")), (1, "a", digest("w")), (None, None, digest("x"))]
    assert held(make(same)) == plain_manifest([(*r, r[2]) for r in same])
    one = make([(7, "s", digest("q"))]).first()
    assert one.leaf == one.subroot == one.root == one.folded_root == digest("q") and one.proof_sha256 == digest("")
    assert make([]).count() == 0


def test_one_group_over_many_tasks(spark):
    """A group of more than one block: 5,000 leaves, two rounds."""
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    rows = [(i, "hot", digest(str(i)), digest(str(i))) for i in range(5000)]
    assert held(merkle.manifest(frame, "doc_id", "source", F.col("leaf"))) == plain_manifest(rows)


def test_query(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.choice(["Aé", "plain", "", None]), rng.choice([None, "fr"]), rng.choice([None, "s1", "s2", ""]), rng.choice([None, i])) for i in range(90)] + [(None, "T", "x", "s1", 3)] * 2
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    low = lambda t: t if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    changed = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    leaf = lambda i, t, lang, s, n: digest(*map(field, (i, s, lang, n, t)))
    wanted = plain_manifest([(r[0], r[3], leaf(*r), leaf(r[0], low(r[1]), *r[2:]) if changed(r[0]) else leaf(*r)) for r in rows])
    found = queries.op12_merkle(spark, str(tmp_path))
    assert held(found) == wanted
    assert all(r.verified == (r.folded_root == r.root) for r in found.collect())
