"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

    score = sigmoid(b + Σ wᵢxᵢ + ½ Σ_f [(Σ vᵢf xᵢ)² − Σ vᵢf² xᵢ²])

The pairwise term costs one pass over a document's features. Word features are counted and
scaled to unit length; structure features are shares of the text. The model is fitted
on a bounded sample of labelled rows and has a fixed size, so it travels with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabstudy.llm.hashing import distinct_counts, mix, ramp, text_batches, word_hashes

WORD_BITS = 16
RANK = 8
TRAIN_ROWS = 6_000
EPOCHS = 6
BATCH = 64
RATE = 0.1
SEED = 7
REJECT_BELOW = 0.3

#: Shares of characters of a kind, and of words and lines of a shape, in a text.
STRUCTURE = (
    "letters", "upper", "digits", "punctuation", "symbols", "bars", "spaces", "breaks",
    "non_ascii", "log_chars", "log_words", "word_length", "distinct_words", "distinct_lines", "meta_log_chars", "echoes",
)
SLOTS = (1 << WORD_BITS) + len(STRUCTURE)


def _byte_kinds() -> np.ndarray:
    """One row per kind of character, over ASCII code points (others are class 127's row)."""
    table = np.zeros((9, 128), dtype=bool)
    for code in range(127):
        c = chr(code)
        table[0, code] = c.isalpha()
        table[1, code] = c.isupper()
        table[2, code] = c.isdigit()
        table[3, code] = c in ".,;:?'\"()-"
        table[4, code] = c in "!#$%&*+/<=>@[\\]^_`{}~"
        table[5, code] = c == "|"
        table[6, code] = c == " "
        table[7, code] = c == "\n"
    table[8, 127] = True
    return table


_KINDS = _byte_kinds()


def structure(text: str, metadata_chars: float | None, words: int, distinct: int) -> list[float]:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = max(1, len(points))
    counts = np.bincount(np.minimum(points, 127).astype(np.int64), minlength=128)
    lines = text.split("\n")
    # powers below 1 spread small shares, where the difference between kinds of text lies
    shares = np.sqrt(_KINDS @ counts / n)
    chars = metadata_chars if metadata_chars is not None and metadata_chars >= 0 else 0.0
    return [
        *shares,
        np.log1p(len(points)) / 10,
        np.log1p(words) / 10,
        min(1.0, len(points) / max(1, words) / 20),
        distinct / max(1, words),
        len(set(lines)) / len(lines),
        np.log1p(chars) / 10,
    ]


def features(texts: list[str], metadata_chars: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: slot, value, offsets. Words are hashed to slots, the rest has fixed slots."""
    words, starts = word_hashes(texts)
    slots = words & np.uint64((1 << WORD_BITS) - 1)
    distinct, times, rows = distinct_counts(slots, starts)
    values = np.log1p(times).astype(np.float64)
    counts = np.diff(rows)
    row_of = np.repeat(np.arange(len(texts)), counts)
    norm = np.sqrt(np.bincount(row_of, values**2, minlength=len(texts)))
    values /= np.maximum(norm, 1e-12)[row_of]
    extra = len(STRUCTURE)
    out_starts = rows + np.arange(len(rows)) * extra
    slot = np.empty(out_starts[-1], dtype=np.int64)
    value = np.empty(out_starts[-1], dtype=np.float64)
    place = np.repeat(out_starts[:-1], counts) + ramp(counts)
    slot[place], value[place] = distinct.astype(np.int64), values
    tail = (out_starts[1:] - extra)[:, None] + np.arange(extra)
    slot[tail] = (1 << WORD_BITS) + np.arange(extra)
    echoes = np.concatenate([[0], np.cumsum(words[1:] == words[:-1])]) if len(words) else np.zeros(1)
    for i, text in enumerate(texts):
        first, last = starts[i], max(starts[i], starts[i + 1] - 1)
        repeated = (echoes[last] - echoes[first]) / max(1, last - first) if last > first else 0.0
        value[tail[i]] = structure(text, metadata_chars[i], int(starts[i + 1] - starts[i]), int(counts[i])) + [repeated]
    return slot, value, out_starts


def _row_sums(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums over each row's run; no run is empty, as every row has structure features."""
    return np.add.reduceat(x, starts[:-1], axis=0)


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, slot: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        mixed = self.factors[slot] * value[:, None]
        sums = _row_sums(mixed, starts)
        squares = _row_sums(mixed**2, starts)
        return self.bias + _row_sums(self.linear[slot] * value, starts) + 0.5 * (sums**2 - squares).sum(1)

    def score(self, slot: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(slot, value, starts), -40, 40)))


def fit_machine(
    slot: np.ndarray,
    value: np.ndarray,
    starts: np.ndarray,
    labels: np.ndarray,
    epochs: int = EPOCHS,
    rate: float = RATE,
    penalty: float = 1e-5,
    seed: int = SEED,
) -> FactorisationMachine:
    """Log loss by AdaGrad over mini-batches; deterministic for a given row order."""
    draw = np.random.default_rng(seed)
    share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    model = FactorisationMachine(
        float(np.log(share / (1 - share))), np.zeros(SLOTS), draw.normal(0, 0.02, (SLOTS, RANK))
    )
    if not len(labels) or labels.min() == labels.max():
        return model
    seen_linear, seen_factors, seen_bias = np.full(SLOTS, 1e-4), np.full((SLOTS, RANK), 1e-4), 1e-4
    sizes = np.diff(starts)
    for _ in range(epochs):
        order = draw.permutation(len(labels))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            n = sizes[rows]
            take = np.repeat(starts[rows], n) + ramp(n)
            s, v = slot[take], value[take]
            local = np.concatenate([[0], np.cumsum(n)])
            row_of = np.repeat(np.arange(len(rows)), n)
            mixed = model.factors[s] * v[:, None]
            sums = _row_sums(mixed, local)
            raw = model.bias + _row_sums(model.linear[s] * v, local)
            raw += 0.5 * (sums**2 - _row_sums(mixed**2, local)).sum(1)
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[rows]) / len(rows)
            used, where = np.unique(s, return_inverse=True)
            push = error[row_of] * v
            linear = np.bincount(where, push, minlength=len(used)) + penalty * model.linear[used]
            pull = push[:, None] * (sums[row_of] - mixed)
            factors = np.stack([np.bincount(where, pull[:, f], minlength=len(used)) for f in range(RANK)], 1)
            factors += penalty * model.factors[used]
            seen_linear[used] += linear**2
            model.linear[used] -= rate * linear / np.sqrt(seen_linear[used])
            seen_factors[used] += factors**2
            model.factors[used] -= 0.5 * rate * factors / np.sqrt(seen_factors[used])
            seen_bias += float(error.sum()) ** 2
            model.bias -= rate * float(error.sum()) / np.sqrt(seen_bias)
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(order, text, chars, label) to (order, label, slots, values)."""
    for batch in batches:
        texts, chars = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for begin, part in text_batches(texts):
            slot, value, starts = features(part, chars[begin : begin + len(part)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(begin, len(part)),
                    batch.column(3).slice(begin, len(part)),
                    pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(slot.astype(np.int32))),
                    pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(value.astype(np.float32))),
                ],
                names=["place", "label", "slots", "vals"],
            )


def learnable(id_column: str = "doc_id"):
    """Rows whose label may be learned: crc32(id as text) mod 5 is not 0."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 != 0


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    chars_column: str = "n_chars",
    label_column: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> FactorisationMachine:
    """Fit on at most ``train_rows`` labelled rows, those with the smallest md5(id) among the learnable.

    The smallest keys are taken as a top-n of ids, so only they meet the texts. Rows without an id or label, and
    rows held out, teach nothing. Without any row of both labels every score is the label's share.
    """
    known = labels.select(F.col(id_column).alias("__id"), F.col(label_column).cast("double").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("__id").isNotNull() & learnable("__id"))
    known = known.groupBy("__id").agg(F.max("label").alias("label"))
    known = known.withColumn("place", F.md5(F.col("__id").cast("string"))).orderBy("place").limit(train_rows)
    # the broadcast side is bounded by train_rows; a repeated id counts once, by its smallest text
    given = documents.select(
        F.col(id_column).alias("__doc"),
        F.col(text_column).alias("text"),
        F.col(chars_column).cast("double").alias("chars"),
    )
    row = F.struct("text", "chars", "label")
    chosen = (
        given.join(F.broadcast(known), F.col("__doc") == F.col("__id"))
        .groupBy("place")
        .agg(F.min(row).alias("row"))
        .select("place", "row.text", "row.chars", "row.label")
    )
    rows = chosen.mapInArrow(_feature_rows, "place string, label double, slots array<int>, vals array<float>")
    table = rows.toArrow().sort_by("place")
    slots = table.column("slots").combine_chunks()
    sizes = np.diff(slots.offsets.to_numpy())
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    slot = slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    value = table.column("vals").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return fit_machine(slot, value, starts, table.column("label").to_numpy())


def score_quality(
    documents: DataFrame,
    model: FactorisationMachine,
    text_column: str = "text",
    chars_column: str = "n_chars",
    output: str = "score",
) -> DataFrame:
    """``documents`` with a score in [0, 1], higher where a good label is likelier.

    A map over the rows: nothing is shuffled. The score depends on text and length alone.

    Defined cases: null texts are scored as empty ones, a null length as 0; equal texts of equal given length
    have equal scores; an empty table gives an empty table; other columns pass through, one named ``output`` is replaced.
    """
    held = documents.sparkSession.sparkContext.broadcast(
        FactorisationMachine(model.bias, model.linear.astype(np.float32), model.factors.astype(np.float32))
    )
    kept = documents.drop(output)
    names = kept.columns
    chars = F.col(chars_column).cast("double") if chars_column in names else F.lit(None).cast("double")
    schema = kept.withColumn(output, F.lit(0.0)).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = held.value
        for batch in batches:
            texts, lengths = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            for begin, part in text_batches(texts):
                got = machine.score(*features(part, lengths[begin : begin + len(part)]))
                own = batch.slice(begin, len(part)).columns[: len(names)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(got, pa.float64())], names=[*names, output])

    return kept.select(
        *[F.col(c) for c in names], F.col(text_column).alias("__text"), chars.alias("__chars")
    ).mapInArrow(scored, schema)
