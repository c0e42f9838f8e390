"""The Merkle manifest against a plain-Python tree."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from railyard.llm import op11_manifest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int, grp string, place long, hash string, _llm_id string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return h(*(field(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def tree(nodes, fan):
    """(root, per node its siblings as (left, right) from the lowest level up)."""
    sides = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for begin in range(0, len(nodes), fan):
            run = nodes[begin : begin + fan]
            for k in range(len(run)):
                for i in owners[begin + k]:
                    sides[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h(*run))
            up_owners.append(sum(owners[begin : begin + fan], []))
        nodes, owners = up, up_owners
    return nodes[0], sides


def manifest(rows, fan):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    found, subroots = [], []
    for name in names:
        ordered = sorted(by_source[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        root, sides = tree([leaf(r) for r in ordered], fan)
        subroots.append(root)
        found.append((ordered, root, sides))
    root, over = tree(subroots, fan)
    return [
        (r["doc_id"], leaf(r), sub, root, h(*(a + b for a, b in side + above)))
        for (ordered, sub, sides), above in zip(found, over)
        for r, side in zip(ordered, sides)
    ]


@pytest.mark.parametrize("fan", [2, 16])
def test_proofs_equal_a_plain_tree(spark, fan):
    rng = random.Random(fan)
    rows = []
    for source, n in ((None, 3), ("", 1), ("hot", 290), ("é", 17), ("z", 16), ("Z", 33), ("one", 1)):
        for _ in range(n):
            text = rng.choice([None, "", "Abc", "ÄÖ text " * rng.randint(0, 50), "x" * 70_000])
            rows.append({"doc_id": rng.choice([None, rng.randint(-40, 400)]), "text": text, "lang": rng.choice(["en", None]), "source": source, "n_chars": rng.choice([None, 5])})
    rows += [dict(rows[5])] * 30  # repeated rows
    made = spark.createDataFrame([(*(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")), "g", 1, "x", "y") for r in rows], COLUMNS).repartition(5)
    changed = F.when(F.col("text") == "Abc", op11_manifest.leaf_of([F.lower("text") if c == "text" else F.col(c) for c in op11_manifest.COLUMNS]))
    found = op11_manifest.audit(made, changed, fan=fan).collect()
    wanted = manifest(rows, fan)
    assert sorted(((r.key, r.hash, r.subroot, r.root, r.proof_sha256) for r in found), key=str) == sorted(wanted, key=str)
    assert all(r.verified == (r.changed is None) for r in found) and any(r.changed for r in found)
    assert all(r.folded_root == r.root for r in found if r.verified)


def test_nodes_of_a_manifest(spark):
    rows = [(i, "t", "en", "a", 1, "", 0, "", "") for i in range(20)]
    made = op11_manifest.build(spark.createDataFrame(rows, COLUMNS))
    counts = {(r.tree, r.level): r.n for r in made.nodes().groupBy("tree", "level").agg(F.count("*").alias("n")).collect()}
    assert counts == {("documents", 0): 20, ("documents", 1): 2, ("documents", 2): 1, ("sources", 0): 1}
    assert made.nodes().filter("tree = 'sources'").first().hash == made.root


def test_no_documents(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert op11_manifest.build(empty).root is None
    assert op11_manifest.audit(empty, F.lit(None).cast("string")).count() == 0
