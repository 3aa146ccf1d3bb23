"""Darts, components and classes against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from odd import no_documents, odd_documents, odd_rows
from pyspark.sql import functions as F

from tabstudy.llm import darts, neardup
from tabstudy.llm.components import component_roots


def shingles(text: str | None, n: int = 5) -> Counter:
    words = (text or "").lower().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def classes(texts: list[str | None], similarity: float = 0.8) -> list[int]:
    """Smallest member of each text's component, by comparing all pairs."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            most = sum((sets[i] | sets[j]).values())
            if not most or sum((sets[i] & sets[j]).values()) / most >= similarity:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))]


def partition(pairs) -> set[frozenset]:
    groups = defaultdict(set)
    for member, name in pairs:
        groups[name].add(member)
    return {frozenset(g) for g in groups.values()}


def test_signatures_estimate_weighted_jaccard():
    draw = np.random.default_rng(3)
    a, b = draw.uniform(0, 6, 300), draw.uniform(0, 6, 300)
    b[:200] = a[:200]
    elements = np.arange(300, dtype=np.uint64) * np.uint64(77) + np.uint64(5)
    got = darts.signatures(np.tile(elements, 2), np.concatenate([a, b]), np.array([0, 300, 600]), 2000)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((got[0] == got[1]).mean() - truth) < 4 * np.sqrt(truth * (1 - truth) / 2000)


def test_darts_do_not_depend_on_the_rest_of_the_batch():
    elements, weights = np.array([9, 4, 7], dtype=np.uint64), np.array([0.3, 1.0, 5.5])
    alone = darts.signatures(elements, weights, np.array([0, 3]), 32)
    both = darts.signatures(np.tile(elements, 2), np.tile(weights, 2), np.array([0, 3, 3, 6]), 32)
    assert (both[0] == alone[0]).all() and (both[2] == alone[0]).all() and (both[1] == 0).all()


def test_dart_count_is_the_area():
    n = 4000
    row, owner, rank, dart = darts.throw(
        np.arange(n, dtype=np.uint64), np.full(n, 2.5), np.zeros(n, dtype=int), np.array([0.7])
    )
    assert abs(len(dart) - n * 2.5 * 0.7) < 5 * np.sqrt(n * 2.5 * 0.7)
    assert rank.max() <= 0.7 and len(set(dart.tolist())) == len(dart)


def test_components(spark):
    random.seed(4)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)]
    links += [(700, i) for i in range(701, 760)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    got = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {n: got.get(n, n) for n in parent} == {n: find(n) for n in parent}


def test_no_links(spark):
    assert component_roots(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_planted_copies(spark):
    """Chains, copies with edits around the threshold, and many near copies of one text."""
    random.seed(5)
    word = lambda: f"w{random.randrange(5000)}"
    texts = []
    for _ in range(12):
        base = [word() for _ in range(random.randrange(20, 300))]
        texts.append(" ".join(base))
        for _ in range(5):
            base = list(base)
            for _ in range(random.randrange(1, 1 + len(base) // 30 + 1)):
                base[random.randrange(len(base))] = word()
            texts.append(" ".join(base))
    hot = [word() for _ in range(400)]
    for _ in range(60):
        copy = list(hot)
        copy[random.randrange(400)] = word()
        texts.append(" ".join(copy))
    order = list(range(len(texts)))
    random.shuffle(order)
    rows = [(i, texts[i]) for i in order]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(frame).collect()}
    assert partition(got.items()) == partition(enumerate(classes(texts)))
    assert all(c <= d for d, c in got.items())


def test_shared_units_are_exact():
    """Similarities of members read off their descriptions relative to a third text."""
    random.seed(12)
    texts = [" ".join(random.choice("ab c d e f g h".split()) + str(random.randrange(3)) for _ in range(n)) for n in (60, 50, 40, 70)]
    texts += [texts[0] + " x y z x y z", texts[0] + " x y z u", "", "a b"]
    for hub in texts:
        held = neardup.weighted_shingles([hub])[:2]
        rows = [neardup.against_hub(held, neardup.weighted_shingles([t])[:2]) for t in texts]
        frame = pd.DataFrame(rows, columns=["similarity", "bits", "extra"])
        shared, left, right = neardup.shared_units(frame, frame)
        for i, a in enumerate(texts):
            for j, b in enumerate(texts):
                assert shared[i, j] == sum((shingles(a) & shingles(b)).values())
            assert left[i] == right[i] == sum(shingles(a).values())


@pytest.mark.parametrize("rows", [64, 1024])
def test_bucket_with_several_components(spark, monkeypatch, rows):
    """One bucket holds everything: what its hub does not link must be found among the members."""
    texts = [" ".join(f"t{k}x{i}" for i in range(40)) + f" tail{j}" for k in range(40) for j in range(4)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def one_bucket(documents, id_column, text_column, *rest):
        return documents.select(
            F.col(id_column).alias("id"), F.unhex(F.md5(text_column)).alias("node"), F.array(F.lit(1)).alias("bands")
        )

    monkeypatch.setattr(neardup, "sign_documents", one_bucket)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", rows)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(frame).collect()}
    assert got == {i: i // 4 * 4 for i in range(160)}


def test_odd_documents(spark):
    rows = odd_rows()
    frame = odd_documents(spark)
    got = neardup.near_duplicate_classes(frame).collect()
    assert len(got) == len(rows)
    by_text = classes([r[1] for r in rows])
    want = Counter()
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if by_text[j] == by_text[i] and rows[j][0] is not None]
        want[rows[i][0], min(ids, default=None), sum(c == by_text[i] for c in by_text)] += 1
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == want
    kept = neardup.keep_one_per_class(frame)
    assert kept.columns == frame.columns
    assert kept.count() == len(set(by_text))


def test_rows_without_any_id(spark):
    frame = spark.createDataFrame([(None, "a b c d e f g")] * 3 + [(None, "z")], "doc_id long, text string")
    assert {(r["class_id"], r["class_size"]) for r in neardup.near_duplicate_classes(frame).collect()} == {(None, 3), (None, 1)}
    assert neardup.keep_one_per_class(frame).count() == 2


def test_empty_table(spark):
    assert neardup.near_duplicate_classes(no_documents(spark)).collect() == []
    assert neardup.keep_one_per_class(no_documents(spark)).collect() == []
