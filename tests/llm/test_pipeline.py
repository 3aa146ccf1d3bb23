"""The pipeline's stages, each against its own rule on the stage's input."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from odd import odd_documents
from test_lines import expected as expected_lines
from test_neardup import classes

import __spark_entry__ as driver
import corpus_pipeline
from tabstudy.llm import bpe, quality
from tabstudy.llm.queries import table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What every stage was given and what it returned."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = table(spark, FOLDER, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def rows(frame) -> list[tuple]:
    return [tuple(r) for r in frame.select(*COLUMNS).collect()]


def test_registered():
    assert driver.queries()["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in driver.queries() if n.startswith("op")) == list(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "encoding"]


def test_columns(steps):
    for name in ("quality", "line_dedup", "near_dedup", "mixing"):
        assert steps[name][1].dtypes == steps[name][0].dtypes


def test_quality_stage(spark, steps):
    given, kept = steps["quality"]
    model = quality.fit_quality(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    scored = quality.score_quality(given, model).collect()
    assert Counter(rows(kept)) == Counter(tuple(r[c] for c in COLUMNS) for r in scored if r["score"] >= 0.3)
    good = table(spark, FOLDER, "labels").where("quality = 1").select("doc_id")
    assert kept.join(good, "doc_id").count() == given.join(good, "doc_id").count()


def test_line_stage(steps):
    given, kept = steps["line_dedup"]
    want = Counter()
    for (doc_id, text, _, _), n in expected_lines(rows(given)).items():
        want[doc_id, text, len(text)] += n
    assert Counter((r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect()) == want


def test_near_duplicate_stage(steps):
    given, kept = (rows(f) for f in steps["near_dedup"])
    given.sort()
    names = classes([r[1] for r in given])
    assert sorted(kept) == [r for i, r in enumerate(given) if names[i] == i]


def test_mixing_stage(steps):
    given, kept = (Counter(rows(f)) for f in steps["mixing"])
    assert not kept - given and sum(kept.values()) > 0.3 * sum(given.values())


def test_encoding_stage(steps):
    given, coded = steps["encoding"]
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={},
    )
    texts = {r[0]: r[1] for r in rows(given)}
    got = {r["doc_id"]: r["n_tokens"] for r in coded.collect()}
    assert got == {i: len(library.encode_ordinary(t)) for i, t in texts.items()}


def test_run_gives_the_last_stage(spark, steps):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(got) == Counter(steps["encoding"][1].collect())


def test_stages_take_odd_documents(spark):
    docs = odd_documents(spark, extra=False)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.collect()
        if out.columns == docs.columns:
            docs = spark.createDataFrame(out.collect(), docs.schema)
