"""The operators bound to the given tables with production parameters, one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabstudy.llm import (
    bpe,
    hashforest,
    htmltext,
    lines,
    merkle,
    mixing,
    neardup,
    ordermin,
    quality,
    repetitions,
    secretscan,
    suffixlevels,
    warc,
)
from tabstudy.session import cut_lineage, scratch_path

RANKS_FILE = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to packages as a WARC record, and read back by ranges."""
    pages = table(spark, folder, "pages")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    planned = warc.plan_revisits(pages.select("page_id", "url", payload.alias("payload")), "page_id")
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    records = planned.select(
        name("page_id").alias("record_id"),
        F.col("url").alias("uri"),
        "record_type",
        F.when(F.col("record_type") == "revisit", name("refers_key")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        "payload",
    )
    store = scratch_path(spark, "warc")
    packages = cut_lineage(warc.write_packages(records, store))
    tasks = warc.reading_tasks(packages)
    locations = warc.list_records(packages, store, tasks)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1)
    to_long = lambda c: F.when(number(c) != "", number(c).cast("bigint"))
    own = F.col("record_type") == "response"
    return warc.read_records(locations, store, tasks).select(
        to_long("record_id").alias("page_id"),
        F.when(own, F.octet_length("payload")).otherwise(F.col("declared_bytes")).cast("bigint").alias("payload_bytes"),
        F.when(own, F.sha1("payload")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        to_long("refers_to").alias("refers_to"),
    )


def op2_dartminhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return neardup.near_duplicate_classes(table(spark, folder, "documents"))


def op3_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixlevels.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Raked probability and draw of every document."""
    return mixing.mix_sources(table(spark, folder, "documents")).select(
        "doc_id",
        F.col("mix_source").alias("source"),
        F.col("mix_lang").alias("lang"),
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("n_tokens"),
        F.round("mix_probability", 6).alias("probability"),
        F.col("mix_kept").alias("kept"),
    )


def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    return htmltext.extract_text(table(spark, folder, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )


def op6_forest(spark: SparkSession, folder: str) -> DataFrame:
    return hashforest.nearest_vectors(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_ordermin(spark: SparkSession, folder: str) -> DataFrame:
    return ordermin.compare_successors(table(spark, folder, "documents"))


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(
        table(spark, folder, "documents"),
        public_tokenizers.path(RANKS_FILE),
        public_tokenizers.PATTERN,
        with_ids=False,
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = quality.fit_quality(documents, table(spark, folder, "labels"))
    return quality.score_quality(documents, model).select(
        "doc_id",
        (~quality.learnable()).alias("held_out"),
        "score",
        (F.col("score") >= quality.REJECT_BELOW).cast("int").alias("predicted"),
    )


def op10_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.dedup_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of the documents, and every row's check against it after line ends were deleted from half of them."""
    documents = table(spark, folder, "documents")
    told = ["doc_id", "source", "lang", "n_chars"]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.leaf_digest(*[F.col(c) for c in told], text)
    manifest = merkle.build_manifest(documents, [*told, "text"], carried={"found": found})
    return manifest.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("siblings", 256).alias("proof_sha256"),
        merkle.folded("found", "siblings", "places").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def with_planted_tail(text: str, mark: str) -> Column:
    """The words from the ``a``-th on made to repeat the first ``p`` of them, as the query's contract words it for ``mark``."""

    @F.arrow_udf("string")
    def plant(texts: pa.Array, marks: pa.Array) -> pa.Array:
        out = []
        for t, h in zip(texts.to_pylist(), marks.to_pylist(), strict=True):
            words = (t or "").encode("utf-8", "surrogatepass").split()
            if not words or h is None or h % 10:
                out.append(t)
                continue
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            out.append(b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode("utf-8", "surrogatepass"))
        return pa.array(out, pa.string())

    # only the texts that change go to the function
    changed = F.pmod(mark, F.lit(10)) == 0
    return F.coalesce(plant(F.when(changed, F.col(text)), mark), F.col(text))


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, the longest of them, and digests of all runs and of the text without repeats."""
    documents = table(spark, folder, "documents")
    marked = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("mark"))
    planted = marked.select("doc_id", with_planted_tail("text", "mark").alias("text"))
    found = repetitions.find_runs(planted, with_text=False)
    ranked = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    return found.withColumn("most", F.array_max(ranked)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("most.col2")).alias("start"),
        F.col("most.length").alias("length"),
        (-F.col("most.col3")).alias("period"),
        F.expr("1000 * most.length div -most.col3").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op13_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document, by patterns and by randomness."""

    def many(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return secretscan.find_secrets(table(spark, folder, "documents")).select(
        "doc_id",
        many(0).alias("n_assign"),
        many(1).alias("n_access"),
        many(2).alias("n_hex"),
        "base_sha256",
        "spans",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_dartminhash": op2_dartminhash,
    "op3_suffixes": op3_suffixes,
    "op4_mixing": op4_mixing,
    "op5_html": op5_html,
    "op6_forest": op6_forest,
    "op7_ordermin": op7_ordermin,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_lines": op10_lines,
    "op11_merkle": op11_merkle,
    "op12_runs": op12_runs,
    "op13_secrets": op13_secrets,
}
