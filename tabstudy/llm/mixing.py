"""Mixing sources to target weights: raking of token weights, then calibrated sampling. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabstudy.session import cut_lineage

SWEEPS = 10
TEMPER = 0.85
SEED = "mix"
DIGITS = 13


def token_count(text: Column) -> Column:
    """White-space separated words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def text_topic(text: Column) -> Column:
    """A coarse topic read off the text: how dense its digits are, else the shape of its lines."""
    plain = F.coalesce(text, F.lit(""))
    n = F.char_length(plain)
    digits = n - F.char_length(F.translate(plain, "0123456789", ""))
    breaks = n - F.char_length(F.translate(plain, "\n", ""))
    return (
        F.when(n == 0, "empty")
        .when(digits * 500 >= n, "figures")
        .when(breaks * 300 >= n, "short-lined")
        .when(n >= 8000, "long-form")
        .otherwise("prose")
    )


def sample_unit(columns: Sequence[str], seed: str = SEED) -> Column:
    """A uniform number in [0, 1) that depends on the named columns and the seed alone."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.substring(F.md5(F.concat_ws("|", F.lit(seed), *parts)), 1, DIGITS)
    return F.conv(digest, 16, 10).cast("bigint").cast("double") / F.lit(float(16**DIGITS))


def cell_totals(documents: DataFrame, margins: Sequence[str], tokens: str) -> DataFrame:
    return documents.groupBy(*margins).agg(F.sum(tokens).cast("double").alias("cell_tokens"))


def margin_targets(cells: DataFrame, margin: str, temper: float) -> DataFrame:
    """Target weight of every value of one margin: its tokens to the power ``temper``."""
    totals = cells.groupBy(margin).agg(F.sum("cell_tokens").alias("have"))
    return totals.select(
        F.col(margin).alias("__value"),
        F.when(F.col("have") > 0, F.pow("have", F.lit(temper))).otherwise(0.0).alias("__target"),
    )


def rake(
    cells: DataFrame, margins: Sequence[str], targets: dict[str, DataFrame], sweeps: int = SWEEPS
) -> DataFrame:
    """Iterative proportional fitting of ``cell_tokens`` to the targets of every margin.

    ``cells`` has one row per combination of margin values. Each step scales the cells of a value
    so that they sum to its target; a sweep does so for every margin. Only the targets' shares
    matter, a common factor cancels. Returns the cells plus ``weight``. Values whose cells sum to zero stay zero. Cells are a table of statistics, no
    larger than the product of the margins' values, whatever the number of documents.
    """
    fitted = cells.withColumn("weight", F.col("cell_tokens"))
    for margin in margins:
        target = targets[margin].withColumnRenamed("__target", f"__t_{margin}")
        fitted = fitted.join(
            target, F.col(margin).eqNullSafe(F.col("__value")), "left"
        ).drop("__value")
    fitted = cut_lineage(fitted)
    for _ in range(sweeps):
        for margin in margins:
            total = F.sum("weight").over(Window.partitionBy(margin))
            scaled = F.col("weight") * F.col(f"__t_{margin}") / total
            fitted = fitted.withColumn("weight", F.when(total > 0, scaled).otherwise(F.col("weight")))
    return fitted.drop(*[f"__t_{m}" for m in margins])


def scaled_within(cells: DataFrame, group: Sequence[str], target: Column, order: Sequence[str]) -> DataFrame:
    """Scale ``weight`` by one factor per group so that min(weight, cell_tokens) sums to ``target``.

    Cells are taken in the order of the factor that fills them: those filled by less than the factor
    sought are full, the others share what is left. A group that holds less than its target is filled.
    Groups without a target or without weight keep their weights.
    """
    weight, within = F.col("weight"), Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    room = F.when(weight > 0, F.col("cell_tokens")).otherwise(0.0)
    cells = cells.withColumn("__need", F.when(weight > 0, F.col("cell_tokens") / weight))
    key = ["__need", *order]
    before = within.orderBy(*key).rowsBetween(Window.unboundedPreceding, 0)
    after = within.orderBy(*[F.desc(k) for k in key]).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.sum(room).over(before) + F.col("__need") * F.coalesce(F.sum(weight).over(after), F.lit(0.0))
    cells = cells.withColumn("__full", F.coalesce(reached <= target, F.lit(False)))
    taken = F.sum(F.when(F.col("__full"), room).otherwise(0.0)).over(within)
    rest = F.sum(F.when(F.col("__full"), 0.0).otherwise(weight)).over(within)
    factor = F.when(rest > 0, (target - taken) / rest).otherwise(F.max("__need").over(within))
    return cells.withColumn("weight", weight * F.coalesce(factor, F.lit(1.0))).drop("__need", "__full")


def rake_within(
    cells: DataFrame, margins: Sequence[str], targets: dict[str, DataFrame], budget: float, sweeps: int = SWEEPS
) -> DataFrame:
    """Raking to ``budget`` times all tokens where no cell's weight passes its tokens.

    A value whose target is more than it has is taken whole and the others share the difference by their
    targets. Factors act on unbounded weights, so a cell that was full can leave its bound again. At the
    end all weights get one factor that meets the budget, also if the bounded margins contradict each other.
    """
    fitted = cells.withColumn("weight", F.col("cell_tokens"))
    aim = cells.agg((F.sum("cell_tokens") * budget).alias("__aim"))  # one row
    for margin in margins:
        have = cells.groupBy(F.col(margin).alias("__have")).agg(F.sum("cell_tokens").alias("cell_tokens"))
        wished = have.join(targets[margin], F.col("__have").eqNullSafe(F.col("__value"))).crossJoin(aim)
        wished = wished.select("__have", "cell_tokens", F.col("__target").cast("double").alias("weight"), "__aim")
        reached = scaled_within(wished, [], F.col("__aim"), ["__have"]).select(
            "__have", F.least("weight", "cell_tokens").alias(f"__t_{margin}")
        )
        fitted = fitted.join(reached, F.col(margin).eqNullSafe(F.col("__have")), "left").drop("__have")
    fitted = cut_lineage(fitted.crossJoin(aim))
    for _ in range(sweeps):
        for margin in margins:
            fitted = scaled_within(fitted, [margin], F.col(f"__t_{margin}"), margins)
        fitted = cut_lineage(fitted)
    fitted = scaled_within(fitted, [], F.col("__aim"), margins)
    return fitted.withColumn("weight", F.least("weight", "cell_tokens")).drop("__aim", *[f"__t_{m}" for m in margins])


def mix_sources(
    documents: DataFrame,
    margins: dict[str, Column] | None = None,
    temper: float = TEMPER,
    sweeps: int = SWEEPS,
    seed: str = SEED,
    targets: dict[str, DataFrame] | None = None,
    tokens: Column | None = None,
    key: Sequence[str] = ("doc_id",),
    budget: float | None = None,
) -> DataFrame:
    """Sample documents so that tokens follow the target margins of source, language and topic.

    Returns the columns of ``documents`` plus ``mix_<margin>``, ``mix_tokens``, ``mix_probability``
    and ``mix_kept``. ``targets`` maps a margin to a table (``__value``, ``__target`` weight);
    without it shares are tempered. A document's probability is its cell's raked weight over its
    tokens, divided by the largest such ratio, so no probability is capped and expected token
    shares are the raked ones; the rarest cell alone then sets how much is kept. With ``budget``, the share of all
    tokens that is kept in expectation, probabilities are bounded by 1 instead: a scarce value is taken
    whole and the rest is raked to the targets. Each document is drawn by a hash of its ``key`` columns.

    A third of all rows in one source is one row per task after the first aggregation. The join of the cells
    is a join on statistics that Spark broadcasts below its threshold and splits above it.

    Defined cases: null margins are a value of their own; documents without tokens have a ratio of
    0/0 and are kept with probability 1; an empty table gives an empty table; repeated keys share their draw;
    extra columns pass through, those named like an output are replaced.
    """
    if budget is not None and not 0 < budget <= 1:
        raise ValueError("budget is a share of the tokens, above 0 and at most 1")
    if margins is None:
        margins = {"source": F.col("source"), "lang": F.col("lang"), "topic": text_topic(F.col("text"))}
    names = [f"mix_{m}" for m in margins]
    documents = documents.drop(*names, "mix_tokens", "mix_probability", "mix_kept")
    own = documents.columns
    counted = token_count(F.col("text")) if tokens is None else tokens
    described = documents.select(
        "*", *[c.alias(n) for n, c in zip(names, margins.values(), strict=True)], counted.alias("mix_tokens")
    )
    cells = cut_lineage(cell_totals(described, names, "mix_tokens"))
    wanted = {
        n: (targets[m] if targets and m in targets else margin_targets(cells, n, temper))
        for n, m in zip(names, margins, strict=True)
    }
    fitted = rake(cells, names, wanted, sweeps) if budget is None else rake_within(cells, names, wanted, budget, sweeps)
    raked = fitted.withColumn(
        "__ratio", F.when(F.col("cell_tokens") > 0, F.col("weight") / F.col("cell_tokens"))
    )
    raked = cut_lineage(raked)
    most = raked.agg(F.max("__ratio")).first()[0] if budget is None else 1.0  # one number
    odds = raked.select(
        *[F.col(n).alias(f"__{n}") for n in names],
        F.coalesce(F.col("__ratio") / F.lit(most), F.lit(1.0)).alias("mix_probability"),
    )
    match = F.lit(True)
    for n in names:
        match = match & F.col(n).eqNullSafe(F.col(f"__{n}"))
    return described.join(odds, match, "left").select(
        *own,
        *names,
        "mix_tokens",
        "mix_probability",
        (sample_unit(key, seed) < F.col("mix_probability")).alias("mix_kept"),
    )
