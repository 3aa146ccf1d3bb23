"""Row keys that are uniform hashes, exact cuts by hash rank, and dense row numbers.

The order of md5 keys is a random order of the rows that does not depend on how they are
partitioned. Taking the first k rows of it needs no sort: the k-th smallest of n uniform
keys lies close to k/n, so a narrow bracket around it is counted, and only the keys inside
the bracket, some thousands at any table size, are looked at one by one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabstudy.session import SMALL_ROWS, collect_bounded, cut_lineage, small_table

DIGITS = 13  # hex digits of the key used for brackets: exact in a double
SPACE = 16**DIGITS
BRACKET_ROWS = 20_000  # keys of one bracket fetched to find the cut
DRIVER_KEYS = 2_000_000  # keys fetched over all cuts together
PREFIX_ROWS = 500_000  # rows per prefix bucket when numbering
STRETCH = 4096  # buckets summed together when running over buckets
COPY_CHUNK = 100_000
ABOVE_ALL = "g"  # greater than any hex key


def hash_key(columns: Sequence[str | Column], seed: int | str) -> Column:
    """md5 of ``seed|c1|c2…``; the columns together must identify a row."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))


def hash_number(text: Column) -> Column:
    """The first 15 hex digits of md5(text) as a BIGINT in [0, 16**15)."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def hash_unit(text: Column) -> Column:
    """md5(text) as a double in [0, 1)."""
    return hash_number(text).cast("double") / F.lit(float(16**15))


def number_copies(df: DataFrame, output: str = "copy_no") -> DataFrame:
    """Give equal rows the numbers 1, 2, …, so that all columns together become a key.

    Copies are interchangeable: they are counted and unfolded again, in chunks, so that
    one row repeated any number of times neither meets in a task nor unfolds in one.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    one = F.lit(1).cast("bigint")
    few = counted.where(F.col("__n") <= COPY_CHUNK).select(
        *columns, F.explode(F.sequence(one, F.col("__n"))).alias(output)
    )
    starts = F.explode(F.sequence(one, F.col("__n"), F.lit(COPY_CHUNK).cast("bigint")))
    chunks = counted.where(F.col("__n") > COPY_CHUNK).withColumn("__from", starts)
    last = F.least(F.col("__n"), F.col("__from") + (COPY_CHUNK - 1))
    many = chunks.repartition(F.xxhash64(*columns, "__from")).select(
        *columns, F.explode(F.sequence("__from", last)).alias(output)
    )
    return few.unionByName(many)


def class_sizes(df: DataFrame, by: str | None) -> dict:
    """Rows per class (the single class ``None`` without ``by``)."""
    if by is None:
        return {None: df.count()}
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return {r[0]: r[1] for r in collect_bounded(counts, SMALL_ROWS, f"classes of {by}")}


def rank_thresholds(
    df: DataFrame,
    key: str,
    ranks: Mapping[object, Sequence[int]],
    by: str | None = None,
    sizes: Mapping[object, int] | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> dict[object, list[str]]:
    """For every class and rank k the text t for which exactly k keys are below t."""
    sizes = dict(sizes or class_sizes(df, by))
    keyed = df.select(*([F.col(by).alias("cls")] if by else []), F.col(key).alias("h"))
    found: dict[tuple, str] = {}
    open_cuts: dict[tuple, dict] = {}
    for cls, ks in ranks.items():
        n = sizes.get(cls, 0)
        for k in ks:
            if k <= 0:
                found[cls, k] = ""
            elif k >= n:
                found[cls, k] = ABOVE_ALL
            else:
                open_cuts[cls, k] = {"lo": 0, "hi": SPACE, "below": 0, "inside": n}
    if open_cuts:
        bracket_rows = max(50, min(bracket_rows, DRIVER_KEYS // len(open_cuts)))
    while any(c["inside"] > bracket_rows for c in open_cuts.values()):
        _narrow(keyed, open_cuts, by, bracket_rows)
    if open_cuts:
        found.update(_read_cuts(keyed, open_cuts, by))
    return {cls: [found[cls, k] for k in ks] for cls, ks in ranks.items()}


def _bracket_table(keyed: DataFrame, rows: list[tuple], by: str | None) -> DataFrame:
    """Brackets as a local relation (one row per open cut) with the class type of the data."""
    fields = [T.StructField("cls", keyed.schema["cls"].dataType)] if by else []
    fields += [
        T.StructField("k", T.LongType()),
        T.StructField("lo", T.StringType()),
        T.StructField("hi", T.StringType()),
    ]
    data = rows if by else [r[1:] for r in rows]
    return small_table(keyed.sparkSession, data, T.StructType(fields))


def _hex(x: int) -> str:
    return ABOVE_ALL if x >= SPACE else f"{x:0{DIGITS}x}"


def _with_brackets(keyed: DataFrame, cuts: dict[tuple, dict], by: str | None) -> DataFrame:
    rows = [(cls, k, _hex(c["lo"]), _hex(c["hi"])) for (cls, k), c in cuts.items()]
    if by is None:
        triples = F.array(
            *[F.struct(F.lit(k).alias("k"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for _, k, lo, hi in rows]
        )
        return keyed.select(F.lit(None).alias("cls"), "h", F.inline(triples))
    table = _bracket_table(keyed, rows, by).withColumnRenamed("cls", "__cls")
    return keyed.join(table, F.col("cls").eqNullSafe(F.col("__cls"))).drop("__cls")


def _narrow(keyed: DataFrame, cuts: dict[tuple, dict], by: str | None, bracket_rows: int) -> None:
    """One scan: count around the expected place of every cut that is still too wide."""
    probes = {}
    for cut, c in cuts.items():
        if c["inside"] <= bracket_rows:
            continue
        if c["hi"] - c["lo"] <= 1:
            raise ValueError("rows share one key: the key columns do not identify a row")
        p = (cut[1] - c["below"]) / c["inside"]
        slack = 8 * math.sqrt(p * (1 - p) / c["inside"]) + 8 / c["inside"]
        width = c["hi"] - c["lo"]
        lo = c["lo"] + max(0, int((p - slack) * width))
        hi = c["lo"] + min(width, int((p + slack) * width) + 1)
        if (lo, hi) == (c["lo"], c["hi"]):
            lo, hi = c["lo"], c["lo"] + width // 2
        probes[cut] = {"lo": lo, "hi": hi}
    counted = (
        _with_brackets(keyed, probes, by)
        .where(F.col("h") < F.col("hi"))
        .groupBy("cls", "k")
        .agg(
            F.count_if(F.col("h") < F.col("lo")).alias("below"),
            F.count_if(F.col("h") >= F.col("lo")).alias("inside"),
        )
        .collect()  # one row per cut
    )
    seen = {(r["cls"], r["k"]): r for r in counted}
    for cut, probe in probes.items():
        c, k = cuts[cut], cut[1]
        below = seen[cut]["below"] if cut in seen else 0
        inside = seen[cut]["inside"] if cut in seen else 0
        total = c["below"] + c["inside"]
        if k < below:
            c.update(hi=probe["lo"], inside=below - c["below"])
        elif k < below + inside:
            c.update(lo=probe["lo"], hi=probe["hi"], below=below, inside=inside)
        else:
            c.update(lo=probe["hi"], below=below + inside, inside=total - below - inside)


def _read_cuts(keyed: DataFrame, cuts: dict[tuple, dict], by: str | None) -> dict[tuple, str]:
    """Fetch the few keys inside each bracket and take the wanted one."""
    rows = (
        _with_brackets(keyed, cuts, by)
        .where((F.col("h") >= F.col("lo")) & (F.col("h") < F.col("hi")))
        .select("cls", "k", "h")
        .collect()  # at most bracket_rows per cut
    )
    found = {}
    lists: dict[tuple, list[str]] = {}
    for cls, k, h in rows:
        lists.setdefault((cls, k), []).append(h)
    for cut, c in cuts.items():
        keys = sorted(lists[cut])
        place = cut[1] - c["below"]
        if place > 0 and keys[place] == keys[place - 1]:
            raise ValueError("rows share one key: the key columns do not identify a row")
        found[cut] = keys[place]
    return found


def lowest_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest keys, by a filter instead of a sort."""
    threshold = rank_thresholds(df, key, {None: [n]})[None][0]
    return df.where(F.col(key) < F.lit(threshold))


def dense_index(df: DataFrame, key: str, n: int, output: str = "idx", by: str | None = None) -> DataFrame:
    """Number rows 0…n-1 in key order (within ``by``): rank inside key-prefix buckets plus offsets.

    The prefix grows with ``n`` so that a bucket stays sortable by one task, and buckets
    are equally full whatever the data looks like, because keys are uniform.
    """
    digits = 1
    while n / 16**digits > PREFIX_ROWS:
        digits += 1
    groups = [by] if by else []
    place = F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")
    bucketed = df.withColumn("__p", place)
    counts = bucketed.groupBy(*groups, "__p").agg(F.count(F.lit(1)).alias("__c"))
    offsets = totals_before(counts, "__p", ["__c"], groups).select(
        *[F.col(g).alias("__by") for g in groups], F.col("__p").alias("__prefix"), F.col("__before_c").alias("__offset")
    )
    match = F.col("__p") == F.col("__prefix")
    if by:
        match = match & F.col(by).eqNullSafe(F.col("__by"))
    inside = Window.partitionBy(*groups, "__p").orderBy(key)
    return (
        bucketed.withColumn("__r", F.row_number().over(inside))
        .join(offsets, match)
        .select(*df.columns, (F.col("__offset") + F.col("__r") - 1).cast("bigint").alias(output))
    )


def totals_before(
    totals: DataFrame, bucket: str, values: Sequence[str], by: Sequence[str] = (), stretch: int = STRETCH
) -> DataFrame:
    """``totals`` (one row per bucket number) with the sum of each value over all smaller buckets.

    A value ``__c`` gets the column ``__before_c``. Buckets are summed within stretches of ``stretch`` numbers, and
    only one row per stretch meets in the window that runs over all of them.
    """
    rows = totals.withColumn("__stretch", F.floor(F.col(bucket) / F.lit(stretch)))
    names = {v: f"__before_{v.lstrip('_')}" for v in values}
    near = Window.partitionBy(*by, "__stretch").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy(*by).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    coarse = rows.groupBy(*by, "__stretch").agg(*[F.sum(v).alias(f"__all_{n}") for v, n in names.items()])
    coarse = coarse.select(
        *[F.col(b).alias(f"__by_{b}") for b in by],
        F.col("__stretch").alias("__s"),
        *[F.coalesce(F.sum(f"__all_{n}").over(far), zero).alias(f"__far_{n}") for n in names.values()],
    )
    match = F.col("__stretch") == F.col("__s")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"__by_{b}"))
    local = rows.withColumns({n: F.coalesce(F.sum(v).over(near), zero) for v, n in names.items()})
    return local.join(coarse, match).select(
        *totals.columns, *[(F.col(n) + F.col(f"__far_{n}")).alias(n) for n in names.values()]
    )


def rank_rows(df: DataFrame, order: Sequence[Column], output: str = "position") -> DataFrame:
    """Rows with their place 1, 2, … in ``order``, which must not tie, without a window over all of them.

    Rows are sorted into ranges once and numbered inside; only a count per range is summed over ranges.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbers = [F.monotonically_increasing_id().alias("__seq"), F.spark_partition_id().cast("bigint").alias("__part")]
    held = cut_lineage(sorted_rows.select("*", *numbers))
    ranges = held.groupBy("__part").agg(F.min("__seq").alias("__first"), F.count(F.lit(1)).alias("__n"))
    starts = totals_before(ranges, "__part", ["__n"]).select(
        F.col("__part").alias("__p"), (F.col("__before_n") - F.col("__first")).alias("__shift")
    )
    place = (F.col("__seq") + F.col("__shift") + 1).alias(output)
    return held.join(starts, F.col("__part") == F.col("__p")).select(*df.columns, place)
