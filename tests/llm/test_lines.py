"""Line dedup against a plain loop."""

from __future__ import annotations

from collections import Counter, defaultdict

from odd import SHARED, no_documents, odd_documents, odd_rows

from tabstudy.llm.lines import BLANKS, dedup_lines


def key_of(line: str) -> str:
    stripped = line.strip(BLANKS)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)


def expected(rows: list[tuple]) -> Counter:
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key_of(line)) >= 40:
                holders[key_of(line)].add(doc_id)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= 5}
    out = Counter()
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(key_of(x), doc_id) == doc_id]
        out[doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


def got(frame) -> Counter:
    return Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in frame.collect())


def test_odd_documents(spark):
    result = dedup_lines(odd_documents(spark))
    assert got(result) == expected(odd_rows())
    assert result.columns.count("n_lines") == 1 and "label" in result.columns


def test_shared_line_stays_in_the_largest_id(spark):
    rows = {r["doc_id"]: r["text"] for r in dedup_lines(odd_documents(spark)).collect()}
    assert SHARED not in rows[103].lower()
    assert rows[106].lower().count(SHARED) == 2


def test_no_id_loses_shared_lines_and_counts_for_none(spark):
    rows = [(i, SHARED) for i in range(4)] + [(None, SHARED)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["n_dropped"] for r in dedup_lines(frame).collect()} == {0}
    frame = spark.createDataFrame([*rows, (4, SHARED)], "doc_id long, text string")
    dropped = {r["doc_id"]: r["n_dropped"] for r in dedup_lines(frame).collect()}
    assert dropped == {0: 1, 1: 1, 2: 1, 3: 1, 4: 0, None: 1}


def test_empty_table(spark):
    assert dedup_lines(no_documents(spark)).collect() == []
