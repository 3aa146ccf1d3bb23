"""Periodic runs against a scan of every period."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from odd import FOLDER, duck_rows, no_documents, odd_documents, odd_rows
from pyspark.sql import functions as F

from tabstudy.llm import repetitions
from tabstudy.llm.oracles import ORACLES
from tabstudy.llm.queries import QUERIES


def every_period(words: list, least_words: int = 6, least_exponent: int = 4) -> list[tuple[int, int, int]]:
    found = {}
    for q in range(1, len(words) // least_exponent + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(least_words, least_exponent * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words(rng: random.Random) -> list[str]:
    letters = "abcde"[: rng.choice([1, 2, 2, 3, 5])]
    words = [rng.choice(letters) for _ in range(rng.randrange(70))]
    for _ in range(rng.randrange(3)):
        unit = [rng.choice("abcde") for _ in range(rng.randrange(1, 6))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = unit * rng.randrange(2, 8)
    return words


LIMITS = [(6, 4), (2, 2), (5, 3), (3, 5), (9, 2)]


@pytest.mark.parametrize("limits", LIMITS)
def test_automaton_finds_every_run(limits):
    rng = random.Random(str(limits))
    for _ in range(400):
        words = some_words(rng)
        assert repetitions.runs_of(words, *limits) == every_period(words, *limits)


@pytest.mark.parametrize("limits", LIMITS)
def test_stretches_lose_no_run(limits):
    rng = random.Random(str(limits))
    for _ in range(60):
        texts = [some_words(rng) for _ in range(9)]
        got = [runs for runs, _ in repetitions.text_runs([" ".join(w) for w in texts], *limits)]
        assert got == [every_period(w, *limits) for w in texts]


def test_run_of_a_run():
    words = (["a", "b"] * 5 + ["c"]) * 6
    assert (0, 66, 11) in repetitions.runs_of(words) and (0, 10, 2) in repetitions.runs_of(words)
    fibonacci = ["b", "a"]
    while len(fibonacci) < 12:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for limits in ((2, 2), (2, 3)):
        assert repetitions.runs_of(list(fibonacci[-1]), *limits) == every_period(list(fibonacci[-1]), *limits)


def test_one_word_many_times():
    assert repetitions.runs_of(["x"] * 20_000) == [(0, 20_000, 1)]
    assert repetitions.runs_of(["x"] * 5) == [] and repetitions.runs_of(["x"] * 6) == [(0, 6, 1)]


def test_words_are_split_at_ascii_white_space():
    texts = ["", " \t\n\x0b\x0c\r ", "a b c d  e", "é𝄞 \x1c\x1d x", "end "]
    hashes, starts = repetitions.blank_split_hashes([t.encode() for t in texts])
    assert np.diff(starts).tolist() == [0, 0, 3, 3, 1]
    assert len(set(hashes.tolist())) == 7
    assert [len(w) for _, w in repetitions.text_runs(texts)] == [0, 0, 3, 3, 1]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows: list[tuple]) -> Counter:
    out = Counter()
    for doc_id, text, *_ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = every_period(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id, tuple(runs), sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), kept, sha(kept)] += 1
    return out


def test_odd_documents(spark):
    rows = [r for r in odd_rows() if r[0] != 10]  # too long for the scan of every period
    rows += [(200 + i, "say it again " * (2 + i) + "and stop", "en", "a", 1) for i in range(5)]
    rows += [(300, "x " * 3000, "en", "a", 1), (300, "x " * 3000, "en", "a", 1)]
    made = spark.createDataFrame(rows, odd_documents(spark, extra=False).schema).repartition(3)
    for name in ("runs", "collapsed", "start", "length", "period"):
        made = made.withColumn(name, F.lit("x"))
    got = repetitions.find_runs(made).collect()
    assert expected(rows) == Counter(
        (r["doc_id"], tuple(map(tuple, r["runs"])), r["runs_sha256"], r["collapsed"], r["collapsed_sha256"]) for r in got
    )


def test_very_long_document_and_empty_table(spark):
    text = next(r[1] for r in odd_rows() if r[0] == 10)
    made = spark.createDataFrame([(1, text + " tail" * 9)], "doc_id long, text string")
    (row,) = repetitions.find_runs(made, with_text=False).collect()
    assert tuple(row["runs"][-1]) == (30_000, 9, 1) and "collapsed" not in row.asDict()
    assert repetitions.find_runs(no_documents(spark)).collect() == []


def test_square_at_least():
    with pytest.raises(ValueError):
        repetitions.find_runs(None, least_exponent=1)


def test_query_against_sql(spark):
    got = {tuple(r) for r in QUERIES["op12_runs"](spark, FOLDER).collect()}
    assert got == set(duck_rows(ORACLES["op12_runs"]))
    assert sum(r[1] for r in got) > 10
