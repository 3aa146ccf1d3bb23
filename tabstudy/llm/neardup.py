"""Near-duplicate classes by DartMinHash signatures, banded joining and exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabstudy.llm.components import component_roots, relabelled, written
from tabstudy.llm.darts import signatures
from tabstudy.llm.hashing import (
    GOLDEN,
    GRAM_BASE,
    distinct_counts,
    mix,
    offsets,
    ramp,
    shingle_hashes,
    text_batches,
    word_hashes,
)
from tabstudy.session import scratch_path

WORDS = 5
SIMILARITY = 0.8
BANDS = 20
BAND_ROWS = 4
BLOCK_ROWS = 1024  # members of a hub in one block
BLOCK_UNITS = 8_000_000  # cells of a block's matrix
BLOCK_COLUMNS = 4096


def weighted_shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word shingles of every text, weighted by how often they occur."""
    return distinct_counts(*shingle_hashes(*word_hashes(texts), words))


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Σ min / Σ max over two sorted weighted sets; two empty sets are equal."""
    if not len(a) and not len(b):
        return 1.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = float(np.minimum(wa[i], wb[j]).sum())
    return shared / (float(wa.sum()) + float(wb.sum()) - shared)


def band_keys(texts: list[str], words: int, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per text and band; texts without words have keys of their own kind."""
    elements, times, starts = weighted_shingles(texts, words)
    signed = signatures(elements, times.astype(np.float64), starts, bands * rows).reshape(len(texts), bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.ones((len(texts), 1), dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys * GRAM_BASE + signed[:, :, r])
    return keys


def sign_documents(
    documents: DataFrame, id_column: str, text_column: str, words: int, bands: int, rows: int
) -> DataFrame:
    """(id, node, bands): ``node`` is the md5 of the text, ``bands`` its banded signature."""
    id_type = documents.schema[id_column].dataType.simpleString()
    plain = F.coalesce(F.col(text_column), F.lit(""))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, part in text_batches(batch.column(2).to_pylist()):
                keys = band_keys(part, words, bands, rows).astype(np.int64)
                flat = pa.array(keys.reshape(-1), pa.int64())
                starts = pa.array(np.arange(len(part) + 1, dtype=np.int32) * bands)
                own = batch.slice(begin, len(part))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.ListArray.from_arrays(starts, flat)],
                    names=["id", "node", "bands"],
                )

    return documents.select(
        F.col(id_column).alias("id"), F.unhex(F.md5(plain)).alias("node"), plain.alias("text")
    ).mapInArrow(signed, f"id {id_type}, node binary, bands array<bigint>")


def against_hub(hub: tuple, other: tuple) -> tuple[float, bytes, bytes]:
    """Similarity of two weighted sets, and what decides the other's similarity to further sets.

    An element of weight w counts as w units. Returned are a bitmap of the hub's units that the other has too, and sorted
    hashes of the other's units beyond them. Two sets x and y so described share as many units as their
    bitmaps have in common plus as many as their hashes have in common.
    """
    elements, weights = hub
    own, times = other
    _, i, j = np.intersect1d(elements, own, assume_unique=True, return_indices=True)
    shared = np.minimum(weights[i], times[j])
    bits = np.zeros(int(weights.sum()), dtype=np.uint8)
    bits[np.repeat(offsets(weights)[i], shared) + ramp(shared)] = 1
    have = np.zeros(len(own), dtype=np.int64)
    have[j] = weights[i]
    beyond = np.maximum(times - have, 0)
    unit_no = np.repeat(have, beyond) + ramp(beyond)
    extra = np.sort(mix(np.repeat(own, beyond) + unit_no.astype(np.uint64) * GOLDEN))
    common, total = float(shared.sum()), float(weights.sum() + times.sum())
    similarity = common / (total - common) if total else 1.0
    return similarity, np.packbits(bits).tobytes(), extra.tobytes()


def check_hubs(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """``pairs`` (hub, node) plus ``linked``, measured exactly, and the node's ``bits`` and ``extra`` (``against_hub``)."""
    left = texts.select(F.col("node").alias("hub"), F.col("text").alias("hub_text"))

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                batch = whole.slice(begin, 500)
                linked, bits, extra = [], [], []
                for name, hub_text, text in zip(*(batch.column(i) for i in (0, 2, 3)), strict=True):
                    if name.as_py() != last:
                        last, held = name.as_py(), weighted_shingles([hub_text.as_py()], words)[:2]
                    found = against_hub(held, weighted_shingles([text.as_py()], words)[:2])
                    linked.append(found[0] >= similarity)
                    bits.append(found[1])
                    extra.append(found[2])
                columns = [pa.array(linked, pa.bool_()), pa.array(bits, pa.binary()), pa.array(extra, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], *columns], names=["hub", "node", "linked", "bits", "extra"]
                )

    met = pairs.join(texts, "node").join(left, "hub").select("hub", "node", "hub_text", "text")
    return met.mapInArrow(checked, "hub binary, node binary, linked boolean, bits binary, extra binary")


def shared_units(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units shared by every row of ``a`` with every row of ``b``, and the units of each; products of 0/1 matrices."""

    def unpacked(rows: pd.DataFrame) -> np.ndarray:
        return np.unpackbits(np.stack([np.frombuffer(x, dtype=np.uint8) for x in rows["bits"]]), axis=1).astype(np.float32)

    bits_a, bits_b = unpacked(a), unpacked(b)
    shared = bits_a @ bits_b.T
    extra_a, extra_b = ([np.frombuffer(x, dtype=np.uint64) for x in rows["extra"]] for rows in (a, b))
    sizes_a, sizes_b = (np.array([len(x) for x in extra]) for extra in (extra_a, extra_b))
    flat_a, flat_b = np.concatenate(extra_a), np.concatenate(extra_b)
    both = np.intersect1d(flat_a, flat_b)
    at_a, at_b = np.searchsorted(both, flat_a), np.searchsorted(both, flat_b)
    row_a, row_b = np.repeat(np.arange(len(a)), sizes_a), np.repeat(np.arange(len(b)), sizes_b)
    if len(both):
        hit_a = both[np.minimum(at_a, len(both) - 1)] == flat_a
        hit_b = both[np.minimum(at_b, len(both) - 1)] == flat_b
        for begin in range(0, len(both), BLOCK_COLUMNS):
            parts = []
            for n, at, row, hit in ((len(a), at_a, row_a, hit_a), (len(b), at_b, row_b, hit_b)):
                here = hit & (at >= begin) & (at < begin + BLOCK_COLUMNS)
                part = np.zeros((n, min(BLOCK_COLUMNS, len(both) - begin)), dtype=np.float32)
                part[row[here], at[here] - begin] = 1
                parts.append(part)
            shared += parts[0] @ parts[1].T
    return shared.astype(np.float64), bits_a.sum(axis=1) + sizes_a, bits_b.sum(axis=1) + sizes_b


def link_block(a: pd.DataFrame, b: pd.DataFrame, similarity: float) -> list[tuple[bytes, bytes]]:
    """Links between the roots of two blocks of one hub's members, at most one per row: a forest of what is linked."""
    shared, size_a, size_b = shared_units(a, b)
    total = size_a[:, None] + size_b[None, :] - shared
    linked = np.where(total > 0, shared / np.maximum(total, 1), 1.0) >= similarity
    names, codes = np.unique(np.array([*a["root"], *b["root"]], dtype=object), return_inverse=True)
    own_a, own_b = codes[: len(a)], codes[len(a) :]
    label_a, label_b = own_a.copy(), own_b.copy()
    above = len(names)
    while True:
        new_a = np.minimum(label_a, np.where(linked, label_b[None, :], above).min(axis=1))
        new_b = np.minimum(label_b, np.where(linked, new_a[:, None], above).min(axis=0))
        if (new_a == label_a).all() and (new_b == label_b).all():
            break
        label_a, label_b = new_a, new_b
    pairs = {(o, n) for o, n in zip([*own_a, *own_b], [*label_a, *label_b], strict=True) if o != n}
    return [(names[o], names[n]) for o, n in pairs]


def link_members(stars: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between roots that are found among the members of each hub.

    ``stars`` are the checked pairs. Members outside the largest component of a hub's members are compared with all of them, in
    blocks: a task holds two blocks, and a hub with very many members is many tasks. Only links between
    components leave a task, at most one per row.
    """
    members = relabelled(stars.withColumn("root", F.col("node")), roots, "root")
    sizes = members.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("bits")).alias("bytes"))
    groups = (
        sizes.groupBy("hub")
        .agg(
            F.max(F.struct("n", "root")).alias("main"),
            F.sum("n").alias("members"),
            F.max("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("roots"),
        )
        .where("roots > 1")
    )
    rows = F.greatest(F.lit(64), F.least(F.lit(BLOCK_ROWS), F.lit(BLOCK_UNITS) / (F.col("bytes") * 8 + 1)))
    groups = written(
        groups.select(
            "hub",
            F.col("main.root").alias("main"),
            F.ceil((F.col("members") - F.col("main.n")) / rows).cast("bigint").alias("outer"),
            F.ceil(F.col("members") / rows).cast("bigint").alias("inner"),
        ),
        "groups",
    )
    zero = F.lit(0).cast("bigint")
    met = members.join(groups, "hub")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(zero, F.col(n) - 1))
    left = met.where(F.col("root") != F.col("main")).select(
        "hub", own("outer").alias("i"), every("inner").alias("j"), "root", "bits", "extra"
    )
    right = met.select(
        F.col("hub").alias("hub2"),
        every("outer").alias("i2"),
        own("inner").alias("j2"),
        F.col("root").alias("root2"),
        F.col("bits").alias("bits2"),
        F.col("extra").alias("extra2"),
    )

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.rename(columns={"root2": "root", "bits2": "bits", "extra2": "extra"})
        links = link_block(a, b, similarity) if len(a) and len(b) else []
        return pd.DataFrame(links, columns=["a", "b"])

    return left.groupBy("hub", "i", "j").cogroup(right.groupBy("hub2", "i2", "j2")).applyInPandas(search, "a binary, b binary")


def rooted_documents(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    words: int,
    similarity: float,
    bands: int,
    band_rows: int,
) -> DataFrame:
    """(id, node, root) of every row: ``root`` is the smallest node of its class."""
    spark = documents.sparkSession
    signed_path = scratch_path(spark, "signed")
    sign_documents(documents, id_column, text_column, words, bands, band_rows).write.parquet(signed_path)
    signed = spark.read.parquet(signed_path)

    entries = signed.groupBy("node").agg(F.first("bands").alias("bands")).select(
        "node", F.explode("bands").alias("bucket")
    )
    crowded = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(entries.join(crowded, "bucket"), "met")
    pulls = met.groupBy("node").agg(F.sum("n").alias("pull"))
    active = written(met.join(pulls, "node").select("bucket", "node", "pull"), "buckets")
    text_path = scratch_path(spark, "texts")
    plain = F.coalesce(F.col(text_column), F.lit(""))
    documents.select(F.unhex(F.md5(plain)).alias("node"), plain.alias("text")).join(
        active.select("node").distinct(), "node", "left_semi"
    ).dropDuplicates(["node"]).write.parquet(text_path)
    texts = spark.read.parquet(text_path)

    most = active.groupBy("bucket").agg(F.max(F.struct("pull", "node")).alias("h"))
    hubs = most.select("bucket", F.col("h.node").alias("hub"))
    pairs = active.join(hubs, "bucket").where(F.col("node") != F.col("hub")).select("hub", "node").distinct()
    stars = written(check_hubs(pairs, texts, words, similarity), "stars")
    roots = component_roots(stars.where("linked").select(F.col("hub").alias("a"), F.col("node").alias("b")))
    more = component_roots(written(link_members(stars, roots, similarity), "more"))
    roots = written(relabelled(roots, more, "root").unionByName(more), "roots")
    return signed.select("id", "node").join(roots, "node", "left").select(
        "id", "node", F.coalesce("root", "node").alias("root")
    )


def near_duplicate_classes(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """Each row's id with ``class_id`` (smallest id of its class) and ``class_size`` (rows).

    Texts are weighted sets of ``words``-word shingles (lower-cased, white-space separated words, weighted by
    count). Two texts are linked if their weighted Jaccard similarity is at least ``similarity``;
    classes are the connected components. A pair at similarity s shares no band with
    probability (1 - s^band_rows)^bands: 2.6e-5 at 0.8 by default.

    Equal texts fold into one node first. Within a bucket of a band not all pairs are made. Its hub, the member that shares most
    buckets with other texts (an original shares more with its edited copies than they do among themselves), is checked
    against the others. That check leaves a short exact description of each member relative to the hub, with which the
    members that the hub does not link are compared with all members in blocks (``link_members``). So every pair of a
    bucket is checked or lies in one component, and a bucket of n near copies costs n checks of texts.

    Defined cases: a null text is an empty one; texts without words are copies of each other; a text of fewer than ``words``
    words is one shingle; rows without an id belong to a class but never name it (``class_id`` is null if
    no member has an id); repeated rows are copies; other columns are not read.
    """
    rooted = rooted_documents(documents, id_column, text_column, words, similarity, bands, band_rows)
    classes = rooted.groupBy("root").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rooted.select("id", "root").join(classes, "root").select(
        F.col("id").alias(id_column), "class_id", "class_size"
    )


def keep_one_per_class(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """``documents`` with one row of each near-duplicate class: that of the smallest id.

    Rows without an id come last; rows that repeat id and text count once. Columns are those of
    ``documents``. Classes are those of ``near_duplicate_classes``.
    """
    rooted = rooted_documents(documents, id_column, text_column, words, similarity, bands, band_rows)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("w")
    winners = rooted.groupBy("root").agg(first).select(F.col("w.id").alias("__id"), F.col("w.node").alias("__node"))
    own = documents.columns
    node = F.unhex(F.md5(F.coalesce(F.col(text_column), F.lit(""))))
    met = documents.withColumn("__own", node).join(
        winners, (F.col("__own") == F.col("__node")) & F.col(id_column).eqNullSafe(F.col("__id"))
    )
    return met.dropDuplicates(["__own", id_column]).select(*own)
