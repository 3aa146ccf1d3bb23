"""Repeat removal against brute force over all strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from odd import no_documents, odd_documents, odd_rows
from pyspark.sql import functions as F

from tabstudy.llm import anchors, suffixlevels
from tabstudy.llm.queries import op3_suffixes, table


def expected(texts: list[str | None], length: int = 200) -> list[tuple]:
    raws = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for raw in raws:
        for i in range(len(raw) - length + 1):
            seen[raw[i : i + length]] = seen.get(raw[i : i + length], 0) + 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, dtype=int)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        mask = np.cumsum(gone)[:-1] > 0 if len(raw) else np.zeros(0, dtype=bool)
        spans = int(mask[:1].sum()) + int((mask[1:] & ~mask[:-1]).sum())
        kept = np.frombuffer(raw, dtype=np.uint8)[~mask].tobytes()
        out.append((len(raw), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def plain(frame) -> list[tuple]:
    out = []
    for r in frame.collect():
        spans = [(s["begin"], s["end"]) for s in r["spans"]]
        assert len(spans) == r["n_spans"] and sum(e - b for b, e in spans) == r["n_removed"]
        out.append((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()))
    return sorted(out)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=60), st.binary(min_size=40, max_size=80), st.integers(0, 3))
def test_equal_windows_share_their_sampled_place(before, after, middle, alphabet):
    """Any window of a text is in an entry, and copies of a window have the same place and offset."""
    fold = lambda b: bytes(x % (2 + alphabet) for x in b)
    length, gram = 32, 8
    texts = [fold(before + middle + after), fold(after + middle + before)]
    seen: dict[bytes, set] = {}
    for t in texts:
        data = np.frombuffer(t, dtype=np.uint8)
        found = anchors.entries(data, length, gram)
        assert found["windows"].sum() == max(0, len(t) - length + 1)
        for s, n, p, g in zip(*(found[k].tolist() for k in ("start", "windows", "place", "gram")), strict=True):
            for i in range(s, s + n):
                assert i <= p <= i + length - gram
                seen.setdefault(t[i : i + length], set()).add((p - i, g))
    assert all(len(v) == 1 for v in seen.values())


def test_window_hashes_follow_the_bytes():
    random.seed(9)
    data = np.frombuffer(bytes(random.choice(b"ab") for _ in range(600)) * 2, dtype=np.uint8)
    first, second = anchors.window_hashes(data, 50)
    words = [data[i : i + 50].tobytes() for i in range(len(data) - 49)]
    assert len(set(first.tolist())) == len(set(second.tolist())) == len(set(words))
    assert (first[:500] == first[600:1100]).all()


def test_long_text_is_cut_without_a_seam(monkeypatch):
    random.seed(10)
    data = np.frombuffer(bytes(random.choice(b"abcd ") for _ in range(9000)), dtype=np.uint8)
    whole = anchors.entries(data)
    monkeypatch.setattr(anchors, "BATCH_BYTES", 700)
    cut = anchors.entries(data)
    assert all((whole[k] == cut[k]).all() for k in whole)


def planted() -> list[str]:
    random.seed(11)
    text = lambda n: "".join(random.choice("abcdefgh é") for _ in range(n))
    passage, other = text(260), text(199)
    texts = [text(random.randrange(0, 900)) for _ in range(10)]
    texts += [text(random.randrange(300)) + passage + text(random.randrange(300)) for _ in range(9)]
    texts += [other + text(50), text(50) + other]  # bytes beyond 200 through multi-byte characters
    texts += [texts[0], texts[12][:400] + "#" + texts[12][400:], texts[3] + texts[3], passage[:215], "ab" * 400, "xy" * 90]
    return texts


@pytest.mark.parametrize(("batches", "crowd"), [(1, 4096), (5, 4096), (4, 1)])
def test_planted_passages(spark, batches, crowd):
    """Any number of batches, and both ways to compare the runs of a gram, give the exact result."""
    texts = planted()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = plain(suffixlevels.remove_repeats(frame, batches=batches, group_entries=crowd))
    assert got == sorted((str(i), *e) for i, e in enumerate(expected(texts)))


def test_copies_give_one_piece(spark, monkeypatch):
    """A text held by many rows is compared once per gram, and the result stays exact."""
    base = planted()[12]
    edited = base[:150] + "#" + base[150:]
    texts = [base] * 40 + [edited]
    crowds = []
    compare = suffixlevels._compare_groups

    def watched(pieces, length):
        crowds.extend(pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.max("crowd").alias("crowd")).collect())
        return compare(pieces, length)

    monkeypatch.setattr(suffixlevels, "_compare_groups", watched)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = plain(suffixlevels.remove_repeats(frame))
    assert crowds and all(r["n"] <= r["crowd"] for r in crowds)
    assert got == sorted((str(i), *e) for i, e in enumerate(expected(texts)))


def test_levels_merge_geometrically(spark):
    family = suffixlevels.SuffixLevels(spark)
    sizes = []
    for batch in range(7):
        rows = [(batch * 10 + i, i, i) for i in range(10)] + [(1000, 5, 5)]
        family.add(spark.createDataFrame(rows, "head int, gram long, run long"))
        sizes.append([n for n, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]
    level = spark.read.parquet(family.levels[0][1])
    assert level.where("head = 1000").first()["n"] == 4
    family.close()


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = sorted(tuple(r[n] for n in names) for r in op3_suffixes(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted((i, *e) for (i, _), e in zip(rows, expected([t for _, t in rows]), strict=True))


def test_odd_documents(spark):
    rows = [r for r in odd_rows() if r[0] != 10]  # the longest text is left to the next test
    frame = odd_documents(spark).where("doc_id IS NULL OR doc_id != 10")
    want = sorted((str(r[0]), *e) for r, e in zip(rows, expected([r[1] for r in rows]), strict=True))
    assert plain(suffixlevels.remove_repeats(frame)) == want


def test_very_long_text(spark):
    text = next(r[1] for r in odd_rows() if r[0] == 10)
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = suffixlevels.remove_repeats(frame).first()
    assert row["n_bytes"] == len(text) and row["n_removed"] == len(text) - expected_tail(text)


def expected_tail(text: str) -> int:
    """Bytes that no repeated 200-byte string covers."""
    return len(text) - expected([text])[0][1]


def test_empty_table(spark):
    assert suffixlevels.remove_repeats(no_documents(spark)).collect() == []
