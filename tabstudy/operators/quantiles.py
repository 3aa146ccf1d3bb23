"""Exact linear-interpolated quantiles that never gather a column in one task.

The first scan builds a mergeable sketch per group and column; its rank error says between which two values a wanted
rank lies almost certainly. The second scan proves it: it counts the values in bins of those brackets and in the gaps
beside them, so the cell that holds a rank is known whatever the sketch said. A rank alone in its cell, or in one whose
values are equal, is found; else the cell is the next bracket, at most 1/``BINS`` as wide, for another scan. So two scans do
for most data, and any data is exact. A value is one row in a scan however many ranks are wanted, and all shuffles carry
sketches or counts per cell, combined map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabstudy.session import hold_small

BINS = 32_768
SKETCH = 4096  # values kept per level of a sketch
SKETCH_ERROR = 0.0025  # twice the error in rank of such a sketch that 99 % of them keep to
ACCURACY = 10_000


def long_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by…, column, value) with nulls and NaN left out."""
    groups = [F.col(g) for g in by]
    values = [F.col(c).cast("double").alias(c) for c in columns]
    tall = df.select(*groups, *values).unpivot(list(by), list(columns), "column", "value")
    return tall.where(F.col("value").isNotNull() & ~F.isnan("value"))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    bins: int = BINS,
    also: Mapping[str, Column] | None = None,
    error: float = SKETCH_ERROR,
) -> DataFrame:
    """Long result (by…, column, prob, value), one row per group, column and distinct probability.

    ``also`` names aggregates of the column ``value``, which are taken in the first scan and repeated per row.
    ``bins`` and ``error`` (the half width of the first brackets, in rank) do not change the result.
    """
    keys = [*by, "column"]
    wanted = sorted({float(p) for p in probs})
    also = dict(also or {})
    tall = long_numeric(df, columns, by)
    state = hold_small(_sketched(tall, keys, wanted, also, error))
    while not state.where("__open").isEmpty():
        state = hold_small(_narrower(tall, keys, wanted, state, bins))
    rows = []
    for j, p in enumerate(wanted):
        position = _position(p)
        part = f"({position} - floor({position}))"
        rows.append(f"struct({p!r}D AS prob, (1 - {part}) * __lo{j} + {part} * __hi{j} AS value)")
    return state.select(*keys, *also, F.expr(f"inline(array({', '.join(rows)}))"))


def _position(prob: float) -> str:
    return f"((__n - 1) * {prob!r}D)"


def _sketched(
    tall: DataFrame, keys: list[str], probs: list[float], also: Mapping[str, Column], error: float
) -> DataFrame:
    """One row per group: size, ``also`` and the bracket [lo, hi] of every probability, not yet proven."""
    ends = [min(1.0, max(0.0, p + e)) for p in probs for e in (-error, error)]
    sketch = tall.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.kll_sketch_agg_double("value", SKETCH).alias("__sketch"),
        *[c.alias(name) for name, c in also.items()],
    )
    found = F.expr(f"kll_sketch_get_quantile_double(__sketch, array({', '.join(f'{e!r}D' for e in ends)}))")
    brackets = [f"__ends[{2 * j + i}] AS __{e}{j}" for j in range(len(probs)) for i, e in enumerate(("lo", "hi"))]
    named = [f"`{name}`" for name in (*keys, *also)]
    return sketch.withColumn("__ends", found).selectExpr(*named, "__n", *brackets, "true AS __open")


def _same_keys(keys: Sequence[str], left: str = "t", right: str = "s") -> Column:
    """Null-safe key match: a null group is a group here."""
    return F.expr(" AND ".join(f"{left}.`{key}` <=> {right}.`{key}`" for key in keys))


def _log_scale(value: str) -> str:
    """Increasing in ``value``; equal steps are equal factors, with 0 between the signs."""
    return f"if({value} = 0, 0D, signum({value}) * (ln(abs({value})) + 750))"


def _place(value: str, lo: str, hi: str, bins: int) -> str:
    """Bin 0 for the lower end, 1 to ``bins`` inside, the last one for the upper end of a bracket.

    Brackets that span more than a factor of 16 are cut on a logarithmic scale, so that a value among very unlike
    ones is found as fast.
    """
    narrow = f"signum({lo}) = signum({hi}) AND greatest(abs({lo}), abs({hi})) / 16 <= least(abs({lo}), abs({hi}))"
    even = f"({value} - {lo}) / ({hi} - {lo})"
    low = _log_scale(lo)
    steps = f"({_log_scale(value)} - {low}) / greatest({_log_scale(hi)} - {low}, 1e-300D)"
    inside = f"cast(least(floor(if({narrow}, {even}, {steps}) * {bins}), {bins - 1}) AS int) + 1"
    return f"CASE WHEN {value} <= {lo} THEN 0 WHEN {value} >= {hi} THEN {bins + 1} ELSE {inside} END"


def _narrower(tall: DataFrame, keys: list[str], probs: list[float], state: DataFrame, bins: int) -> DataFrame:
    """One scan: count the values of open groups in cells, and find the cell that holds each wanted rank.

    Cells ascend with the values: the gap below a bracket, its bins, the next gap. Two neighbouring ranks in different
    cells are the largest value of one and the smallest of the other; in one cell, its extremes are the next bracket.
    """
    width = bins + 2
    cells = []
    for j in range(len(probs)):
        lo, hi = f"s.__lo{j}", f"s.__hi{j}"
        cells.append(f"WHEN t.value < {lo} THEN {2 * j * width}")
        cells.append(f"WHEN t.value <= {hi} THEN {(2 * j + 1) * width} + {_place('t.value', lo, hi, bins)}")
    cell = F.expr(f"CASE {' '.join(cells)} ELSE {2 * len(probs) * width} END")
    counted = (
        tall.alias("t")
        .join(state.where("__open").alias("s"), _same_keys(keys))
        .groupBy(*[F.col(f"t.{k}").alias(k) for k in keys], cell.alias("__cell"))
        .agg(F.expr("count(1) AS __c"), F.expr("min(t.value) AS __lo"), F.expr("max(t.value) AS __hi"))
    )
    by = ", ".join(f"`{k}`" for k in keys)
    # windows and groups hold one row per cell met
    running = counted.selectExpr(
        "*", f"sum(__c) OVER (PARTITION BY {by} ORDER BY __cell) AS __upto", f"sum(__c) OVER (PARTITION BY {by}) AS __n"
    )
    ends = []
    for j, p in enumerate(probs):
        for name, step in (("f", "floor"), ("c", "ceil")):
            rank = f"{step}({_position(p)})"
            holds = f"__upto - __c <= {rank} AND {rank} < __upto"
            ends += [F.expr(f"max(if({holds}, {e}, NULL)) AS {e}_{name}{j}") for e in ("__lo", "__hi")]
    found = running.groupBy(*keys).agg(*ends)
    brackets, unsure = [], []
    for j in range(len(probs)):
        together = f"__lo_f{j} = __lo_c{j}"
        brackets.append(f"if({together}, __lo_f{j}, __hi_f{j}) AS __lo{j}")
        brackets.append(f"if({together}, __hi_f{j}, __lo_c{j}) AS __hi{j}")
        unsure.append(f"({together} AND __lo_f{j} < __hi_f{j})")
    now = found.selectExpr(*[f"`{k}`" for k in keys], *brackets, f"{' OR '.join(unsure)} AS __open")
    kept = [c for c in state.columns if c not in now.columns]
    narrowed = state.where("__open").alias("t").join(now.alias("s"), _same_keys(keys)).selectExpr(
        *[f"{'t' if c in (*keys, *kept) else 's'}.`{c}` AS `{c}`" for c in state.columns]
    )
    return narrowed.unionByName(state.where("NOT __open"))


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    named: dict[str, float],
    by: Sequence[str] = (),
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Wide form (by…, column, one column per name in ``also`` and ``named``)."""
    keys = [*by, "column", *(also or {})]
    tall = exact_quantiles(df, columns, list(named.values()), by, also=also)
    cells = [
        F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(name)
        for name, p in named.items()
    ]
    return tall.groupBy(*keys).agg(*cells)


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """One-scan alternative with rank error up to 1/``accuracy``."""
    tall = long_numeric(df, columns)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("q").alias("value"))
    return (
        tall.groupBy("column")
        .agg(F.percentile_approx("value", [float(p) for p in probs], accuracy).alias("q"))
        .select("column", F.inline(pairs).alias("prob", "value"))
    )


