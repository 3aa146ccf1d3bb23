"""Order MinHash fingerprints, which follow edit distance rather than shared vocabulary.

The elements of a text are its k-mers of code points, numbered by occurrence. Every coordinate of the
fingerprint takes the few elements that its hash order puts first, lists them in text
order and hashes the tuple. Two texts agree in a coordinate when they share these k-mers in the same order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabstudy.llm.darts import coordinate, throw
from tabstudy.llm.hashing import GOLDEN, GRAM_BASE, WORD_BASE, mix

KMER = 8
TUPLE = 2
COORDINATES = 64
PLACE_BITS = 20
BUCKET_ROWS = 1000
MOST_BUCKETS = 10_000
BATCH_CHARS = 400_000


def kmer_hashes(text: str, k: int = KMER) -> np.ndarray:
    """Hashes of all k-mers in text order, cut to 64 - PLACE_BITS bits; a shorter text is one k-mer."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if not len(points):
        return points
    size = min(k, len(points))
    rolled = np.zeros(len(points) - size + 1, dtype=np.uint64)
    for j in range(size):
        rolled *= GRAM_BASE
        rolled += points[j : j + len(rolled)]
    if size < k:
        rolled += np.uint64(size) * WORD_BASE
    return mix(rolled) >> np.uint64(PLACE_BITS)


def numbered_kmers(text: str, k: int = KMER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element, k-mer, place): elements are hashes of a k-mer and the number of its occurrence."""
    grams = kmer_hashes(text, k)
    n = len(grams)
    if n <= 1 << PLACE_BITS:
        both = np.sort((grams << np.uint64(PLACE_BITS)) | np.arange(n, dtype=np.uint64))
        grams, place = both >> np.uint64(PLACE_BITS), (both & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    else:
        place = np.argsort(grams, kind="stable")
        grams = grams[place]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = grams[1:] != grams[:-1]
    at = np.arange(n)
    number = at - np.maximum.accumulate(np.where(fresh, at, 0)) if n else at
    return mix(grams + number.astype(np.uint64) * GOLDEN), grams, place


def fingerprints(
    texts: list[str], k: int = KMER, length: int = TUPLE, size: int = COORDINATES
) -> np.ndarray:
    """One row of ``size`` 32-bit tuple hashes per text; the empty text is all zeros."""
    parts = [numbered_kmers(t, k) for t in texts]
    counts = np.array([len(p[0]) for p in parts], dtype=np.int64)
    out = np.zeros((len(texts), size), dtype=np.uint32)
    if not counts.sum():
        return out
    elements, grams, places = (np.concatenate([p[i] for p in parts]) for i in range(3))
    rows = np.repeat(np.arange(len(texts)), counts)
    weights = np.ones(len(elements))
    need = np.minimum(counts, length)
    wanted = size * (np.log(size) / 2 + 3.0 * length)
    open_rows = np.flatnonzero(counts)
    while len(open_rows):
        pick = np.zeros(len(texts), dtype=bool)
        pick[open_rows] = True
        use = slice(None) if pick[counts > 0].all() else np.flatnonzero(pick[rows])
        reach = wanted / np.maximum(counts, 1)
        row, owner, rank, dart = throw(elements[use], weights[use], rows[use], reach)
        owner = np.arange(len(elements))[use][owner]
        slot = row * size + coordinate(dart, size)
        order = np.argsort((slot.astype(np.uint64) << np.uint64(36)) | (rank / reach[row] * 2.0**35).astype(np.uint64))
        slot, owner = slot[order], owner[order]
        chosen = np.full((len(texts) * size, length), -1, dtype=np.int64)
        for j in range(length):
            first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else slot
            chosen[slot[first], j] = owner[first]
            rest = owner != chosen[slot, j]
            slot, owner = slot[rest], owner[rest]
        found = (chosen >= 0).sum(axis=1).reshape(len(texts), size)
        done = (found >= need[:, None]).all(axis=1) & pick
        filled = chosen.reshape(len(texts), size, length)[done]
        place = np.where(filled >= 0, places[filled], np.iinfo(np.int64).max)
        filled = np.take_along_axis(filled, np.argsort(place, axis=2, kind="stable"), axis=2)
        value = np.zeros(filled.shape[:2], dtype=np.uint64)
        for j in range(length):
            value = mix(value * GRAM_BASE + np.where(filled[:, :, j] >= 0, grams[filled[:, :, j]], 0) + WORD_BASE)
        out[done] = (value >> np.uint64(32)).astype(np.uint32)
        open_rows = open_rows[~done[open_rows]]
        wanted *= 2
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal coordinates, row by row."""
    return (a == b).mean(axis=1)


def fingerprint_text(row: np.ndarray) -> str:
    return row.astype(">u4").tobytes().hex()


def fingerprint_documents(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, fingerprint) of every row; a map without a shuffle. Null texts count as empty."""
    id_type = documents.schema[id_column].dataType.simpleString()

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            got = [fingerprint_text(r) for part in _parts(texts) for r in fingerprints(texts[part])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.string())], names=[id_column, "fingerprint"])

    return documents.select(id_column, text_column).mapInArrow(marked, f"`{id_column}` {id_type}, fingerprint string")


def _parts(texts: list[str]) -> Iterator[slice]:
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > BATCH_CHARS:
            yield slice(begin, i)
            begin, held = i, 0
        held += len(t) + 1000
    if begin < len(texts):
        yield slice(begin, len(texts))


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_successors(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows dealt to buckets of neighbouring ids, sorted, each bucket closed by the row that follows it.

    Returns (bucket, tail, id, text) partitioned by bucket and sorted by (bucket, tail, id, text). Ids alone decide the
    buckets' bounds (quantiles); the row with a bucket's smallest id is copied to the end of the bucket before,
    that of the first bucket to the last. At most ``MOST_BUCKETS`` bounds are held by the driver.
    """
    rows = documents.select(
        F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    count = rows.count()
    n = max(1, min(MOST_BUCKETS, count // BUCKET_ROWS))
    bounds = rows.approxQuantile("id", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    bounds = np.unique(np.array(bounds, dtype=np.int64))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), dtype=np.int32)
        out[known] = np.searchsorted(bounds, ids[known].astype("int64").to_numpy(), side="right")
        return pd.Series(out)

    firsts = (
        rows.select("id")
        .withColumn("bucket", bucket_of("id"))
        .groupBy("bucket")
        .agg(F.min(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("first"))
        .collect()  # one row per bucket
    )
    order = sorted((r["bucket"], r["first"]["id"]) for r in firsts)
    before = {first: order[i - 1][0] for i, (_, first) in enumerate(order)}

    @F.pandas_udf("int")
    def closed_by(ids: pd.Series) -> pd.Series:
        """The bucket that a row of this id closes, if it is a bucket's first; -1 otherwise."""
        return pd.Series(
            [before.get(None if pd.isna(i) else int(i), -1) for i in ids], dtype="int32"
        )

    own = F.struct(bucket_of("id").alias("bucket"), F.lit(False).alias("tail"))
    copy = F.struct(closed_by("id").alias("bucket"), F.lit(True).alias("tail"))
    return (
        rows.select("id", "text", F.explode(F.array(own, copy)).alias("at"))
        .where(F.col("at.bucket") >= 0)
        .select("at.bucket", "at.tail", "id", "text")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "tail", "id", "text")
    )


def compare_successors(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, compared; see ``edited_text``.

    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next document is the
    next in ascending id; after the last comes the first. One shuffle moves each text once; buckets are streamed in
    order, so that memory holds a batch.

    Defined cases: a null text is empty and has the fingerprint of zeros; rows without an id come first; rows that
    repeat an id follow each other by text; a single row follows itself; an empty table gives an empty table; other
    columns are not read.
    """

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last of them still waits for its successor

        def rows():
            for batch in batches:
                for begin in range(0, batch.num_rows, 64):
                    part = batch.slice(begin, 64)
                    yield from zip(*(part.column(i).to_pylist() for i in range(4)), strict=True)

        def flush(chunk):
            """All rows of ``chunk`` but the last are answered; each is followed by the next."""
            texts = [r[3] for r in chunk]
            answer = [
                i for i in range(len(chunk) - 1) if not chunk[i][1] and chunk[i][0] == chunk[i + 1][0]
            ]
            edited = [edited_text(texts[i], texts[i + 1]) for i in answer]
            prints = np.concatenate([fingerprints(texts[p]) for p in _parts(texts)])
            marks = [fingerprints(edited[p]) for p in _parts(edited)]
            marks = np.concatenate(marks) if marks else np.zeros((0, COORDINATES), dtype=np.uint32)
            at = np.array(answer, dtype=np.int64)
            return pa.RecordBatch.from_pydict(
                {
                    id_column: pa.array([chunk[i][2] for i in answer], pa.int64()),
                    "n_chars": pa.array([len(texts[i]) for i in answer], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                    "fingerprint": pa.array([fingerprint_text(prints[i]) for i in answer], pa.string()),
                    "edited_fingerprint": pa.array([fingerprint_text(m) for m in marks], pa.string()),
                    "near_edited": pa.array(likeness(prints[at], marks), pa.float64()),
                    "near_next": pa.array(likeness(prints[at], prints[at + 1]), pa.float64()),
                }
            )

        size = 0
        for row in rows():
            held.append(row)
            size += len(row[3])
            if len(held) > 1 and size > BATCH_CHARS:
                yield flush(held)
                held = held[-1:]
                size = len(held[0][3])
        if len(held) > 1:
            yield flush(held)

    schema = (
        f"`{id_column}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return with_successors(documents, id_column, text_column).mapInArrow(compared, schema)
