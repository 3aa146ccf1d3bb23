"""Exact removal of repeated byte strings with a logarithmic family of sampled suffix arrays.

Suffixes are sampled by content (``anchors``), so a repeat of ``LENGTH`` bytes holds a sampled suffix at the same
offset in all its copies. No true suffix array is built: what stands for it here is a hash index of distinct entries
(head, gram, run) with ``gram`` the hash of the suffix's first 64 bytes and ``run`` that of all bytes the entry's windows
cover, as equal hashes are all that exact repeats need. Each new batch gets its index, is joined with every level by
these hashes, and becomes a level; levels of equal size are merged by grouping, so that m batches leave at most log2(m) + 1 levels
and each entry is rewritten as many times at most.

A scan finds runs that occur twice, whose windows are all repeats, and grams that begin different runs. For
these few the bytes are fetched and compared window by window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabstudy.llm import anchors
from tabstudy.llm.hashing import ramp
from tabstudy.session import cut_lineage, scratch_path

BATCHES = 4
GROUP_ENTRIES = 4096  # different runs of one gram compared within a task; more are compared by a shuffle of windows
SALTS = 16  # parts of the entries of one gram when they meet the grams found
ENTRY = "node binary, start int, windows int, head int, gram bigint, run bigint, batch int"


def text_node(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sampled_entries(documents: DataFrame, text_column: str, batches: int, length: int) -> DataFrame:
    """Entries of every text. ``node`` is the text's md5; equal texts give equal entries."""
    plain = F.coalesce(F.col(text_column), F.lit(""))

    def sampled(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in frames:
            for begin in range(0, whole.num_rows, 200):
                frame = whole.slice(begin, 200)
                rows, parts = [], []
                for i, text in enumerate(frame.column(2)):
                    raw = text.as_py().encode()
                    data = np.frombuffer(raw, dtype=np.uint8)
                    found = anchors.entries(data, length)
                    if not len(found["start"]):
                        continue
                    digests = anchors.entry_digests(raw, found["start"], found["windows"], length)
                    run = np.frombuffer(b"".join(d[:8] for d in digests), dtype=np.int64)
                    rows.append(np.full(len(run), i))
                    head = anchors.heads(data, found["place"])
                    parts.append((found["start"], found["windows"], head, found["gram"].view(np.int64), run))
                if not rows:
                    continue
                take = pa.array(np.concatenate(rows))
                start, windows, head, gram, run = (np.concatenate([p[j] for p in parts]) for j in range(5))
                yield pa.RecordBatch.from_arrays(
                    [
                        frame.column(0).take(take),
                        pa.array(start.astype(np.int32)),
                        pa.array(windows.astype(np.int32)),
                        pa.array(head),
                        pa.array(gram),
                        pa.array(run),
                        frame.column(1).take(take),
                    ],
                    names=["node", "start", "windows", "head", "gram", "run", "batch"],
                )

    return documents.select(
        text_node(F.col(text_column)).alias("node"),
        F.pmod(F.xxhash64(plain), F.lit(batches)).cast("int").alias("batch"),
        plain.alias("text"),
    ).mapInArrow(sampled, ENTRY)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that this module wrote and has replaced."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class SuffixLevels:
    """The levels of the family and what their scans have found.

    ``add`` takes the entries of one batch. ``matches`` returns the runs that occur at least twice and the
    grams that begin more than one run, over all batches added so far.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, str]] = []  # (number of batches, path), larger ones first
        self.found_runs: list[str] = []
        self.found_grams: list[str] = []

    def _write(self, table: DataFrame, name: str) -> str:
        path = scratch_path(self.spark, name)
        table.write.parquet(path)
        return path

    def _array(self, rows: DataFrame) -> str:
        """Write distinct entries with their counts in suffix order."""
        counted = rows.groupBy("head", "gram", "run").agg(F.sum("n").alias("n"))
        return self._write(counted.sortWithinPartitions("head", "gram", "run"), "suffixes")

    @staticmethod
    def _grams(array: DataFrame, prefix: str) -> DataFrame:
        return array.groupBy(F.col("gram").alias(f"{prefix}gram")).agg(
            F.min("run").alias(f"{prefix}lo"), F.max("run").alias(f"{prefix}hi")
        )

    def add(self, entries: DataFrame) -> None:
        read = self.spark.read.parquet
        path = self._array(entries.select("head", "gram", "run", F.lit(1).cast("bigint").alias("n")))
        batch = read(path)
        grams = self._grams(batch, "")
        self.found_runs.append(self._write(batch.where("n > 1").select("gram", "run"), "runs"))
        self.found_grams.append(self._write(grams.where("lo != hi").select("gram"), "grams"))
        for _, level_path in self.levels:
            level = read(level_path)
            both = batch.select("gram", "run").join(level.select("gram", "run"), ["gram", "run"])
            self.found_runs.append(self._write(both, "runs"))
            met = grams.join(self._grams(level, "l"), F.col("gram") == F.col("lgram"))
            differ = F.least("lo", "llo") != F.greatest("hi", "lhi")
            self.found_grams.append(self._write(met.where(differ).select("gram"), "grams"))
        self.levels.append((1, path))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (a, newer), (b, older) = self.levels.pop(), self.levels.pop()
            merged = self._array(read(newer).unionByName(read(older)))
            drop_table(self.spark, newer)
            drop_table(self.spark, older)
            self.levels.append((a + b, merged))

    def matches(self) -> tuple[DataFrame, DataFrame]:
        runs = self.spark.read.schema("gram bigint, run bigint").parquet(*self.found_runs)
        grams = self.spark.read.schema("gram bigint").parquet(*self.found_grams)
        return runs.distinct(), grams.distinct()

    def close(self) -> None:
        """Drop the levels; what the scans found stays."""
        for _, path in self.levels:
            drop_table(self.spark, path)
        self.levels = []


def _repeated_windows(groups: np.ndarray, pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, window) of every window whose bytes occur in another piece of the same group."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    windows = sizes - length + 1
    first, second = anchors.window_hashes(np.frombuffer(b"".join(pieces), dtype=np.uint8), length)
    begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    piece, place = np.repeat(np.arange(len(pieces)), windows), ramp(windows)
    at = begins[piece] + place
    keys = (groups[piece], first[at], second[at])
    order = np.lexsort(keys[::-1])
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for key in keys:
        same &= key[order][1:] == key[order][:-1]
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.sort(order[twice])
    return piece[hit], place[hit]


def _runs_of(piece: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows of a piece as (piece, first window, last window)."""
    if not len(piece):
        return piece, place, place
    fresh = np.concatenate([[True], (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:] - 1, [len(piece) - 1]])
    return piece[first], place[first], place[last]


def _compare_groups(pieces: DataFrame, length: int) -> DataFrame:
    """Spans of repeated windows among the pieces of each gram; groups are streamed whole, many at a time."""

    def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        raw = table.column("bytes").to_pylist()
        piece, place = _repeated_windows(table.column("gram").to_numpy(), raw, length)
        piece, first, last = _runs_of(piece, place)
        alone = ~table.column("covered").to_numpy()[piece]
        piece, first, last = piece[alone], first[alone], last[alone]
        start = table.column("start").to_numpy()[piece]
        return pa.RecordBatch.from_arrays(
            [
                table.column("node").combine_chunks().take(pa.array(piece)),
                pa.array((start + first).astype(np.int32)),
                pa.array((start + last + length).astype(np.int32)),
            ],
            names=["node", "begin", "end"],
        )

    def compared(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for whole in frames:
            for begin in range(0, whole.num_rows, 2000):
                frame = whole.slice(begin, 2000)
                held.append(frame)
                size += frame.num_rows
                if size < 4000:
                    continue
                gram = np.concatenate([h.column(0).to_numpy() for h in held])
                cut = np.flatnonzero(gram != gram[-1])
                if not len(cut):
                    continue  # one group goes on; it has at most GROUP_ENTRIES pieces
                done = int(cut[-1]) + 1
                table = pa.Table.from_batches(held)
                yield answer(table.slice(0, done).combine_chunks().to_batches())
                held = table.slice(done).combine_chunks().to_batches()
                size = table.num_rows - done
        if size:
            yield answer(held)

    ordered = pieces.select("gram", "node", "start", "covered", "bytes").repartition("gram").sortWithinPartitions("gram")
    return ordered.mapInArrow(compared, "node binary, begin int, end int")


def _compare_by_shuffle(pieces: DataFrame, length: int) -> DataFrame:
    """The same for grams that begin very many runs: windows meet by their hash, combined map-side."""

    def opened(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in frames:
            for begin in range(0, whole.num_rows, 500):
                frame = whole.slice(begin, 500)
                raw = frame.column(4).to_pylist()
                sizes = np.array([len(p) for p in raw], dtype=np.int64)
                windows = sizes - length + 1
                first, second = anchors.window_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), length)
                begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
                piece, place = np.repeat(np.arange(len(raw)), windows), ramp(windows)
                at = begins[piece] + place
                yield pa.RecordBatch.from_arrays(
                    [
                        frame.column(0).take(pa.array(piece)),
                        pa.array(first[at].view(np.int64)),
                        pa.array(second[at].view(np.int64)),
                        frame.column(1).take(pa.array(piece)),
                        pa.array((frame.column(2).to_numpy()[piece] + place).astype(np.int32)),
                        frame.column(3).take(pa.array(piece)),
                    ],
                    names=["gram", "first", "second", "node", "begin", "covered"],
                )

    rows = pieces.select("gram", "node", "start", "covered", "bytes").mapInArrow(
        opened, "gram bigint, first bigint, second bigint, node binary, begin int, covered boolean"
    )
    key = ["gram", "first", "second"]
    twice = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    return (
        rows.where("NOT covered")
        .join(twice, key)
        .select("node", "begin", (F.col("begin") + length).cast("int").alias("end"))
    )


def repeated_spans(
    documents: DataFrame,
    text_column: str = "text",
    length: int = anchors.LENGTH,
    batches: int = BATCHES,
    group_entries: int = GROUP_ENTRIES,
) -> DataFrame:
    """(node, spans): per distinct text the byte spans whose ``length``-byte strings also start elsewhere.

    Spans may overlap and touch; ``node`` is the md5 of the text. Texts without a repeat are absent.
    """
    spark = documents.sparkSession
    entry_path = scratch_path(spark, "entries")
    sampled_entries(documents, text_column, batches, length).write.partitionBy("batch").parquet(entry_path)
    entries = spark.read.schema(ENTRY).parquet(entry_path)
    family = SuffixLevels(spark)
    for batch in range(batches):
        family.add(entries.where(F.col("batch") == batch))
    runs, grams = family.matches()
    runs, grams = cut_lineage(runs), cut_lineage(grams)
    family.close()

    whole = (
        entries.join(runs, ["gram", "run"])
        .select("node", F.col("start").alias("begin"), (F.col("start") + F.col("windows") + (length - 1)).cast("int").alias("end"))
        .distinct()
    )
    one = F.min(F.struct("node", "start", "windows")).alias("e")
    # a gram inside a very common passage holds many entries: each salt of it meets its own copy of the gram
    parts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    salted = entries.withColumn("salt", F.pmod(F.xxhash64("node", "start"), F.lit(SALTS)))
    unlike = (
        salted.join(grams.withColumn("salt", F.explode(parts)), ["gram", "salt"])
        .groupBy("gram", "run")
        .agg(one)
        .select("gram", "run", "e.*")
    )
    covered = runs.withColumn("covered", F.lit(True))
    unlike = unlike.join(covered, ["gram", "run"], "left").withColumn("covered", F.coalesce("covered", F.lit(False)))
    crowds = unlike.groupBy("gram").agg(F.count(F.lit(1)).alias("crowd"))
    wanted = (
        unlike.join(crowds, "gram")
        .groupBy(F.col("node").alias("__node"))
        .agg(F.collect_list(F.struct("gram", "start", "windows", "covered", "crowd")).alias("wanted"))
    )

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_frame in frames:
            for at in range(0, whole_frame.num_rows, 100):
                frame = whole_frame.slice(at, 100)
                out = {"gram": [], "node": [], "start": [], "covered": [], "crowd": [], "bytes": []}
                for node, text, asked in zip(*(frame.column(i) for i in range(3)), strict=True):
                    raw, name = text.as_py().encode(), node.as_py()
                    for w in asked.as_py():
                        out["gram"].append(w["gram"])
                        out["node"].append(name)
                        out["start"].append(w["start"])
                        out["covered"].append(w["covered"])
                        out["crowd"].append(w["crowd"])
                        out["bytes"].append(raw[w["start"] : w["start"] + w["windows"] + length - 1])
                yield pa.RecordBatch.from_pydict(
                    {
                        "gram": pa.array(out["gram"], pa.int64()),
                        "node": pa.array(out["node"], pa.binary()),
                        "start": pa.array(out["start"], pa.int32()),
                        "covered": pa.array(out["covered"], pa.bool_()),
                        "crowd": pa.array(out["crowd"], pa.int64()),
                        "bytes": pa.array(out["bytes"], pa.binary()),
                    }
                )

    piece_path = scratch_path(spark, "pieces")
    # one row of each text, so that a gram has at most ``crowd`` pieces; that a text has copies is known from ``runs``
    texts = documents.select(
        text_node(F.col(text_column)).alias("node"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).dropDuplicates(["node"])
    texts.join(wanted, F.col("node") == F.col("__node")).select("node", "text", "wanted").mapInArrow(
        cut, "gram bigint, node binary, start int, covered boolean, crowd bigint, bytes binary"
    ).write.parquet(piece_path)
    pieces = spark.read.parquet(piece_path)
    partly = _compare_groups(pieces.where(F.col("crowd") <= group_entries), length).unionByName(
        _compare_by_shuffle(pieces.where(F.col("crowd") > group_entries), length)
    )
    return whole.unionByName(partly).groupBy("node").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def remove_repeats(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = anchors.LENGTH,
    batches: int = BATCHES,
    group_entries: int = GROUP_ENTRIES,
) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts anywhere else.

    Texts are UTF-8 bytes; matches never cross documents, may overlap and may lie in one document; strings are judged
    on the input. Returns id, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (array of begin and end) and ``kept`` (binary: what
    is left may cut a character).

    Equality is that of hashes: windows compared by 128 bits within one 64-bit gram, runs by 64 bits within one gram.

    Defined cases: a null text is empty; a text shorter than ``length`` loses nothing; equal texts of at least ``length`` bytes
    lose all, whatever their ids; ids may be null or repeat; an empty table gives an empty table; other columns are not read.
    """
    id_type = documents.schema[id_column].dataType.simpleString()
    spans = repeated_spans(documents, text_column, length, batches, group_entries)
    rows = documents.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        text_node(F.col(text_column)).alias("own"),
    )
    met = rows.join(spans, F.col("own") == F.col("node"), "left").select("id", "text", "spans")

    def removed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in frames:
            for at in range(0, whole.num_rows, 200):
                frame = whole.slice(at, 200)
                sizes, gone, counts, runs, kept = [], [], [], [], []
                for text, found in zip(frame.column(1), frame.column(2), strict=True):
                    raw = text.as_py().encode()
                    begin = end = np.zeros(0, dtype=np.int64)
                    if found.is_valid and len(found):
                        values = found.values
                        begin, end = anchors.merged_length(
                            values.field(0).to_numpy().astype(np.int64), values.field(1).to_numpy().astype(np.int64)
                        )
                    edges = [0, *np.stack([begin, end], 1).reshape(-1).tolist(), len(raw)]
                    sizes.append(len(raw))
                    gone.append(int((end - begin).sum()))
                    counts.append(len(begin))
                    runs.append([{"begin": b, "end": e} for b, e in zip(begin.tolist(), end.tolist(), strict=True)])
                    kept.append(b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
                yield pa.RecordBatch.from_arrays(
                    [
                        frame.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(gone, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(runs, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                        pa.array(kept, pa.binary()),
                    ],
                    names=[id_column, "n_bytes", "n_removed", "n_spans", "spans", "kept"],
                )

    return met.mapInArrow(
        removed,
        f"`{id_column}` {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, "
        "spans array<struct<begin:bigint,end:bigint>>, kept binary",
    )
