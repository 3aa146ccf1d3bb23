"""Line dedup: lines that many documents share stay only in the last document that holds them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 40
MIN_DOCUMENTS = 5


def line_hash(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128 bits of the line's key, or None if the key is shorter than ``min_chars`` code points.

    The key is the line without ASCII white space at its ends, with A-Z lower-cased (``bytes.lower`` touches ASCII
    alone). Two different keys among n meet with a probability below n²/2¹²⁸.
    """
    key = line.strip(BLANKS)
    if len(key) < min_chars:
        return None
    return hashlib.blake2b(key.encode().lower(), digest_size=16).digest()


def dedup_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Drop lines whose key is found in at least ``min_documents`` documents.

    Returns the columns of ``documents`` with ``text_column`` replaced by the lines that stay, in
    their order, plus ``n_lines`` (before dropping) and ``n_dropped``. Keys shorter than
    ``min_chars`` code points never count. Of a shared key, the document with the largest id
    keeps all of its lines.

    Only hashes of lines are shuffled for counting: (hash, id) pairs are made distinct before they
    are counted per hash, both with a map-side combine, so a line that a third of all documents
    share meets as one row per task. Documents are shuffled once, to meet their list of dropped
    hashes, which is no longer than the document.

    Defined cases: a null text is one empty line and becomes the empty text; an empty table
    gives an empty table; rows that repeat an id count as one document and are cut alike; rows without
    an id count towards no key and lose the lines that others share; extra columns pass through, but for
    the two counts, which are replaced.
    """
    documents = documents.drop("n_lines", "n_dropped")
    own = documents.columns
    id_type = documents.schema[id_column].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                found, rows = [], []
                for i, text in enumerate(batch.column(1)):
                    own_hashes = {line_hash(line, min_chars) for line in (text.as_py() or "").split("\n")}
                    own_hashes.discard(None)
                    found.extend(own_hashes)
                    rows.extend([i] * len(own_hashes))
                ids = batch.column(0).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], names=["id", "hash"])

    pairs = documents.select(id_column, text_column).mapInArrow(hashed, f"id {id_type}, hash binary").distinct()
    shared = (
        pairs.where(F.col("id").isNotNull())
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
        .where(F.col("n") >= min_documents)
        .select("hash", "last")
    )
    drops = (
        pairs.join(shared, "hash")
        .where(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy(F.col("id").alias("__id"))
        .agg(F.collect_list("hash").alias("__dropped"))
    )
    met = documents.join(drops, documents[id_column].eqNullSafe(drops["__id"]), "left").drop("__id")
    place = own.index(text_column)
    schema = documents.select(
        *[F.col(c).cast("string") if c == text_column else F.col(c) for c in own],
        F.lit(0).cast("bigint").alias("n_lines"),
        F.lit(0).cast("bigint").alias("n_dropped"),
    ).schema

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                texts, before, dropped = [], [], []
                for text, gone in zip(batch.column(place), batch.column(len(own)), strict=True):
                    lines = (text.as_py() or "").split("\n")
                    kept = lines
                    if gone.is_valid:
                        hashes = set(gone.as_py())
                        kept = [line for line in lines if line_hash(line, min_chars) not in hashes]
                    texts.append("\n".join(kept))
                    before.append(len(lines))
                    dropped.append(len(lines) - len(kept))
                columns = batch.columns[: len(own)]
                columns[place] = pa.array(texts, pa.string())
                columns += [pa.array(before, pa.int64()), pa.array(dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return met.mapInArrow(rebuilt, schema)
