"""Order MinHash against the definition, and the dealing of successors."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from odd import no_documents, odd_documents, odd_rows

from tabstudy.llm import ordermin
from tabstudy.llm.queries import op7_ordermin, table


def expected(rows: list[tuple]) -> list[tuple]:
    order = sorted(((r[0] is not None, r[0] or 0, r[1] or "", r[0]) for r in rows), key=lambda r: r[:3])
    texts = [r[2] for r in order]
    out = []
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        edited = ordermin.edited_text(text, following)
        a, b, c = ordermin.fingerprints([text]), ordermin.fingerprints([edited]), ordermin.fingerprints([following])
        out.append(
            (
                order[i][3], len(text), hashlib.sha256(edited.encode()).hexdigest(), ordermin.fingerprint_text(a[0]),
                ordermin.fingerprint_text(b[0]), ordermin.likeness(a, b)[0], ordermin.likeness(a, c)[0],
            )
        )
    return out


def plain(frame) -> list[tuple]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return [tuple(r[n] for n in names) for r in frame.collect()]


def test_edited_text():
    assert ordermin.edited_text("abcde", "XY") == "abcXY"
    assert ordermin.edited_text("abcde", "X") == "abcX"
    assert ordermin.edited_text("a", "XY") == "a"
    assert ordermin.edited_text("", "XY") == ""


def test_occurrences_are_numbered():
    element, gram, place = ordermin.numbered_kmers("abababab", 2)
    assert len(set(element.tolist())) == 7 and len(set(gram.tolist())) == 2
    assert sorted(place.tolist()) == list(range(7))


@pytest.mark.parametrize("text", ["q", "abcabc", "the quick brown fox jumps over the lazy dog " * 3])
def test_fingerprint_follows_the_definition(text):
    """Per coordinate: the two elements of least rank, in text order."""
    from tabstudy.llm.darts import coordinate, throw
    from tabstudy.llm.hashing import GRAM_BASE, WORD_BASE, mix

    element, gram, place = ordermin.numbered_kmers(text)
    n = len(element)
    row, owner, rank, dart = throw(element, np.ones(n), np.zeros(n, dtype=int), np.array([4000.0 / n]))
    slot = coordinate(dart, ordermin.COORDINATES)
    want = []
    for c in range(ordermin.COORDINATES):
        best: dict[int, float] = {}
        for o, r in zip(owner[slot == c], rank[slot == c], strict=True):
            best[o] = min(r, best.get(o, np.inf))
        first = sorted(sorted(best, key=best.get)[: ordermin.TUPLE], key=lambda o: place[o])
        value = np.zeros(1, dtype=np.uint64)
        for j in range(ordermin.TUPLE):
            g = gram[first[j]] if j < len(first) else np.uint64(0)
            value = mix(value * GRAM_BASE + g + WORD_BASE)
        want.append(int(value[0] >> np.uint64(32)))
    assert ordermin.fingerprints([text])[0].tolist() == want


def test_order_matters():
    """Two halves swapped keep all k-mers but one boundary; the likeness falls well below theirs."""
    random.seed(8)
    a = "".join(random.choice("abcdefghij ") for _ in range(4000))
    b = a[2000:] + a[:2000]
    got = ordermin.fingerprints([a, b, a])
    assert ordermin.likeness(got[:1], got[2:])[0] == 1
    assert 0.2 < ordermin.likeness(got[:1], got[1:2])[0] < 0.8


def test_batch_does_not_matter():
    texts = ["", "a", "abcdefgh", "abcdefghi" * 50, "zz" * 900, "a"]
    together = ordermin.fingerprints(texts)
    assert all((ordermin.fingerprints([t])[0] == together[i]).all() for i, t in enumerate(texts))
    assert (together[0] == 0).all()


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    got = plain(op7_ordermin(spark, "/root/testdata/sf0.001"))
    assert sorted(got) == sorted(expected(rows))
    assert np.mean([g[5] > g[6] for g in got if g[1] > 200]) > 0.95


def test_buckets_join_up(spark, monkeypatch):
    monkeypatch.setattr(ordermin, "BUCKET_ROWS", 3)
    got = plain(ordermin.compare_successors(odd_documents(spark)))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(expected(odd_rows()), key=key)


def test_small_tables(spark):
    assert ordermin.compare_successors(no_documents(spark)).collect() == []
    one = spark.createDataFrame([(5, "hello world, hello")], "doc_id long, text string")
    row = ordermin.compare_successors(one).first()
    assert row["near_next"] == 1 and row["n_chars"] == 18
    marks = ordermin.fingerprint_documents(one).first()
    assert marks["fingerprint"] == row["fingerprint"]
