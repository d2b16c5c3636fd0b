"""Merkle trees and proofs against plain recursion."""

import hashlib
import random

import pytest

from slugline.llm import manifest as M

SCHEMA = "lang string, doc_id long, leaf string, altered string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_way(leaves, at):
    way = []
    while len(leaves) > 1:
        way.append(leaves[at ^ 1] if at ^ 1 < len(leaves) else "")
        leaves, at = [h(*leaves[k : k + 2]) for k in range(0, len(leaves), 2)], at // 2
    return leaves[0], way


def plain(rows):
    """{(name, rank): (doc_id, leaf, subroot, root, siblings)}"""
    first = lambda x: (x is not None, x if isinstance(x, int) else (x or "").encode())
    trees = {name: sorted((r for r in rows if r[0] == name), key=lambda r: (first(r[1]), r[2], r[3])) for name in {r[0] for r in rows}}
    names = sorted(trees, key=first)
    tops = [plain_way([r[2] for r in trees[name]], 0)[0] for name in names]
    found = {}
    for k, name in enumerate(names):
        root, over = plain_way(tops, k)
        for rank, row in enumerate(trees[name]):
            found[name, rank] = (row[1], row[2], tops[k], root, plain_way([r[2] for r in trees[name]], rank)[1] + over)
    return found


@pytest.mark.parametrize("levels", [8, 2])
def test_trees_of_all_sizes(spark, monkeypatch, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "COPIES_AT_ONCE", 100)
    monkeypatch.setattr(M, "USES_AT_ONCE", 2)
    source = random.Random(3)
    rows = [(source.choice(["en", "en", "fr", None, "É"]), k, h(str(k)), h(f"{k % 9}")) for k in range(700)]
    rows += [("copies", 7, h("x"), h("x"))] * 450 + [("lone", 1, h("y"), h("y")), ("z", None, h("q"), h("r"))]
    rows += [("z", 3, h("b"), h("b")), ("z", 3, h("a"), h("a"))]
    made = M.build(spark.createDataFrame(rows, SCHEMA).repartition(5), "lang", "doc_id", "leaf")
    want = plain(rows)
    subroots = {r.tree: r.subroot for r in made.trees.collect()}
    proofs = M.prove(made, made.leaves, "altered").collect()
    assert {(r.lang, r.rank): (r.doc_id, r.leaf, subroots[r.tree], made.root, r.siblings) for r in proofs} == want
    assert len(proofs) == len(rows)
    assert all((r.folded_root == made.root) == (r.altered == r.leaf) for r in proofs)
    some = M.prove(made, made.leaves.where("rank % 40 = 3"), "leaf").collect()
    assert some and all(r.siblings == want[r.lang, r.rank][4] and r.folded_root == made.root for r in some)
    # Children give the digest they are stored under.
    for record in made.records.collect():
        assert M.tree_levels(record.children, record.depth)[-1] == [record.digest]
    # Equal stretches of the copies share records.
    assert (made.records.agg({"uses": "max"}).head()[0] > 2) == (levels == 2)


def test_single_and_no_leaves(spark):
    one = spark.createDataFrame([("en", 1, "ab", "cd")], SCHEMA)
    made = M.build(one, "lang", "doc_id", "leaf")
    (row,) = M.prove(made, made.leaves, "altered").collect()
    assert (made.root, row.siblings, row.folded_root) == ("ab", [], "cd")
    none = M.build(one.limit(0), "lang", "doc_id", "leaf")
    assert none.root is None and none.leaves.count() == none.records.count() == 0
    assert M.prove(none, none.leaves, "altered").count() == 0


def test_leaves_tell_values_apart(spark):
    rows = spark.createDataFrame(
        [(1, "a", None), (1, None, "a"), (1, "a1:b", ""), (1, "a", "1:b"), (None, "-", None), (1, "é", "x" * 100_000)], "a long, b string, c string"
    )
    leaves = [r[0] for r in rows.select(M.leaf_of(*[rows[c] for c in "abc"])).collect()]
    sized = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    assert leaves == [h(*map(sized, row)) for row in rows.collect()] and len(set(leaves)) == 6


def test_clashing_columns(spark):
    """`digest`, `path` and `children` are names that the records use."""
    rows = spark.createDataFrame([("a", k, h(str(k)), "x", k) for k in range(9)], "lang string, doc_id long, digest string, path string, children int")
    made = M.build(rows, "lang", "doc_id", "digest")
    proofs = M.prove(made, made.leaves, "digest")
    assert set(rows.columns) < set(proofs.columns)
    assert all(r.folded_root == made.root and r.path == "x" and r.children == r.doc_id for r in proofs.collect())


def test_numbers_within_groups(spark):
    source = random.Random(5)
    rows = [(source.choice("aab"), k, source.randrange(4)) for k in range(3000)]
    frame = spark.createDataFrame(rows, "g string, k int, n int").repartition(7)
    for r in M.numbered(frame, ["g"], ["k"], "n").where("k % 100 = 7").collect():
        assert r.before == sum(n for g, k, n in rows if g == r.g and k < r.k)
    assert [r.before for r in M.numbered(frame.where("k < 9"), [], ["k"], "n").orderBy("k").collect()] == [
        sum(n for _, j, n in rows[:k]) for k in range(9)
    ]
