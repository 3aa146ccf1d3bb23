"""Merkle manifest against trees built level by level."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from odd import FOLDER, duck_rows, no_documents, odd_documents, odd_rows
from pyspark.sql import functions as F

from tabstudy.llm import merkle
from tabstudy.llm.oracles import ORACLES
from tabstudy.llm.queries import QUERIES


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves: list[str], fanout: int = 3) -> tuple[str, list[str], list[str]]:
    """Root, and per leaf its siblings and places, each level built as a whole."""
    siblings, places = [""] * len(leaves), [""] * len(leaves)
    at, level = list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for leaf, place in enumerate(at):
            run = level[place // fanout * fanout :][:fanout]
            i = place % fanout
            siblings[leaf] += "".join(run[:i] + run[i + 1 :])
            places[leaf] += f"{i}{len(run) - 1 - i}"
        level = [h(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
        at = [place // fanout for place in at]
    return level[0], siblings, places


def expected(rows: list[tuple]) -> Counter:
    """(doc_id, source, leaf, subroot, root, siblings, places) with their counts."""
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = h(*map(told, (doc_id, source, lang, n_chars, text)))
        groups[source].append((doc_id is not None, doc_id or 0, leaf, doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda g: g[:3])
        trees[name] = plain_tree([g[2] for g in groups[name]])
    root, over, over_places = plain_tree([trees[name][0] for name in names])
    out = Counter()
    for name, beside, place in zip(names, over, over_places):
        subroot, siblings, places = trees[name]
        for (*_, leaf, doc_id), own, own_places in zip(groups[name], siblings, places):
            out[doc_id, name, leaf, subroot, root, own + beside, own_places + place] += 1
    return out


@pytest.mark.parametrize("fanout", [2, 3, 5])
@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 10, 27, 28, 60])
def test_appended_tree(fanout, n):
    leaves = [h(str(i)) for i in range(n)]
    tree = merkle.WitnessedTree(fanout)
    for leaf in leaves:
        tree.append(leaf)
    root = tree.finish()
    assert (root, ["".join(s) for s in tree.siblings], ["".join(p) for p in tree.places]) == plain_tree(leaves, fanout)
    for leaf, siblings, places in zip(leaves, tree.siblings, tree.places):
        assert merkle.fold_witness(leaf, "".join(siblings), "".join(places)) == root


def test_witness_grows_only_when_a_run_is_complete():
    tree = merkle.WitnessedTree(3)
    sizes = []
    for i in range(9):
        tree.append(h(str(i)))
        sizes.append(len(tree.siblings[0]))
    assert sizes == [0, 0, 1, 1, 1, 1, 1, 1, 2]


def test_block_of_known_height():
    tree = merkle.WitnessedTree(3)
    tree.append("x")
    assert tree.finish(2) == h(h("x")) and tree.places == [["00", "00"]]


@pytest.mark.parametrize("block_levels", [1, 2, 6])
def test_odd_documents(spark, block_levels):
    made = odd_documents(spark)
    for name in ("gid", "pos", "total", "digest", "siblings", "top", "leaf", "grp", "ord"):
        made = made.withColumn(name, F.lit("x"))
    rows = merkle.build_manifest(made, block_levels=block_levels).collect()
    columns = ("doc_id", "source", "leaf", "subroot", "root", "siblings", "places")
    assert Counter(tuple(r[c] for c in columns) for r in rows) == expected(odd_rows())


def test_one_group_of_many_blocks_and_copies(spark):
    rows = [(i % 700 if i % 3 else None, "same text", "en", "hot", 1) for i in range(2500)]
    made = spark.createDataFrame(rows, odd_documents(spark, extra=False).schema)
    got = merkle.build_manifest(made, block_levels=3).collect()
    columns = ("doc_id", "source", "leaf", "subroot", "root", "siblings", "places")
    assert Counter(tuple(r[c] for c in columns) for r in got) == expected(rows)


def test_any_change_is_found(spark):
    made = odd_documents(spark, extra=False)
    changed = merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], F.concat("text", F.lit(" ")))
    manifest = merkle.build_manifest(made, carried={"found": changed})
    checked = manifest.select("doc_id", (merkle.folded("found", "siblings", "places") == F.col("root")).alias("ok")).collect()
    untouched = [r for r in odd_rows() if r[1] is None]  # a null stays null
    assert sum(r["ok"] for r in checked) == len(untouched)


def test_empty_table(spark):
    assert merkle.build_manifest(no_documents(spark)).collect() == []


def test_query_against_sql(spark):
    got = QUERIES["op11_merkle"](spark, FOLDER)
    assert {tuple(r) for r in got.collect()} == set(duck_rows(ORACLES["op11_merkle"]))
    assert got.where("verified").count() < got.count()
