"""Secrets in texts: fixed patterns, and tokens that a battery of randomness tests cannot tell from random.

A token is a long unbroken string; its encoding is the smallest alphabet that holds it. The battery asks whether it
could be drawn uniformly from that alphabet: a chi-squared test of the symbols' counts, a runs test of lower against upper
half, the serial correlation of neighbouring symbols. Fisher's combination is kept as ``strain``, the fourth root of its
log, which for ordinary text of one length is spread evenly around its mean.

Passing says little for a short token, as ordinary text of that length may pass, too. So every document also gives a
decoy: characters of its ordinary text that belong to an encoding, as if they were a token. Their strain rises with length;
a line per encoding and the spread around it are what ordinary text is like. A token's distance below that line is its
p-value against being ordinary, and Benjamini and Hochberg's procedure over all distinct tokens bounds the share of
ordinary ones among those reported.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabstudy.session import collect_bounded, scratch_path

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ASSIGN_CHARS = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 20
HEX_CHARS = 24
HEX = re.compile(rf"[0-9a-f]{{{HEX_CHARS},}}")  # runs of the class are whole either way, so short ones need no match
KINDS = ("assign", "access", "hex", "random")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    DIGITS + LOWER[:6],
    DIGITS + UPPER[:6],
    UPPER + DIGITS[2:8],  # base32
    DIGITS + LOWER,
    DIGITS + UPPER,
    DIGITS + UPPER + LOWER,
    UPPER + LOWER + DIGITS + "+/",  # base64
    UPPER + LOWER + DIGITS + "-_",  # base64 for addresses
)
PLACES = [{c: i for i, c in enumerate(alphabet)} for alphabet in ENCODINGS]
LEAST_CHARS = 16
TOKEN = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_CHARS},}}")
DECOY_CHARS = 64  # decoys have LEAST_CHARS to this many characters
LEVEL = 0.001  # a token that the battery rejects at this level is not random
FALSE_SHARE = 0.05
BINS_PER_SD = 100
MOST_SD = 12


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted; kinds by their place in ``KINDS``."""
    spans = []
    lowered = text.lower()  # the pattern's words are in here if the pattern matches
    if any(word in lowered for word in ("passw", "secret", "token", "api")):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def encoding_of(token: str) -> int | None:
    """The smallest alphabet that holds the token; none for numbers and for what mixes alphabets."""
    symbols = set(token)
    if symbols <= set(DIGITS):
        return None
    return next((i for i, places in enumerate(PLACES) if symbols <= places.keys()), None)


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared_p(places: Sequence[int], size: int) -> float:
    """Chance that uniform symbols are spread as unevenly; by the statistic's exact mean and variance."""
    n = len(places)
    counts = [0] * size
    for x in places:
        counts[x] += 1
    statistic = size * sum(c * c for c in counts) / n - n
    z = (statistic - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    return 0.5 * math.erfc(z / math.sqrt(2))


def runs_p(places: Sequence[int], size: int) -> float:
    """Chance that uniform symbols change between the halves of the alphabet as rarely or as often."""
    n = len(places)
    upper = [x * 2 >= size for x in places]
    high = sum(upper)
    both = 2 * high * (n - high)
    if both == 0:
        return 2.0 ** (1 - n)
    runs = 1 + sum(a != b for a, b in zip(upper, upper[1:]))
    variance = both * (both - n) / (n * n * (n - 1))
    return two_sided((runs - both / n - 1) / math.sqrt(variance)) if variance > 0 else 1.0


def serial_p(places: Sequence[int]) -> float:
    """Chance that uniform symbols are correlated as much with the next one."""
    n = len(places)
    mean = sum(places) / n
    off = [x - mean for x in places]
    spread = sum(x * x for x in off)
    if spread == 0:
        return 2.0 ** (1 - n)
    return two_sided((sum(a * b for a, b in zip(off, off[1:])) / spread + 1 / n) * math.sqrt(n))


def strain(token: str, encoding: int) -> float:
    """Fourth root of minus the log of the battery's p-value: 0 for nothing unusual, large for what is not random."""
    places = list(map(PLACES[encoding].__getitem__, token))
    size = len(ENCODINGS[encoding])
    tests = (chi_squared_p(places, size), runs_p(places, size), serial_p(places))
    x = -sum(math.log(max(p, 1e-300)) for p in tests)
    return max(0.0, x - math.log(1 + x + x * x / 2)) ** 0.25  # Fisher: chi-squared with 6 degrees of freedom


def decoy(text: str) -> tuple[int, int, float] | None:
    """(encoding, length, strain) of ordinary characters, from a place that follows from the text alone."""
    mark = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    encoding = mark % len(ENCODINGS)
    n = LEAST_CHARS + mark // 8 % (DECOY_CHARS - LEAST_CHARS + 1)
    alphabet = PLACES[encoding]
    start = mark // 512 % max(1, len(text))
    some = TOKEN.sub(" ", text[start : start + 24 * n])
    if not any(c in alphabet for c in LOWER):
        some = some.upper()
    elif not any(c in alphabet for c in UPPER):
        some = some.lower()
    taken = [c for c in some if c in alphabet][:n]
    return (encoding, n, strain("".join(taken), encoding)) if len(taken) == n else None


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float, bytes]]]:
    """Base spans, and (start, end, encoding, strain, digest) of every token that touches none of them."""
    base = base_spans(text)
    tokens = []
    for m in TOKEN.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for s, _, e in base):
            continue
        encoding = encoding_of(m[0])
        if encoding is not None:
            tokens.append((start, end, encoding, strain(m[0], encoding), hashlib.md5(m[0].encode()).digest()))
    return base, tokens


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_SPAN = T.StructType([T.StructField(name, T.IntegerType()) for name in ("start", "kind", "end")])
_TOKEN = T.StructType(
    [T.StructField(name, T.IntegerType()) for name in ("start", "end", "encoding")]
    + [T.StructField("strain", T.DoubleType()), T.StructField("digest", T.BinaryType())]
)
_DECOY = T.StructType(
    [T.StructField("encoding", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("strain", T.DoubleType())]
)
SCANNED = T.StructType(
    [
        T.StructField("base", T.ArrayType(_SPAN)),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("tokens", T.ArrayType(_TOKEN)),
        T.StructField("decoy", _DECOY),
    ]
)


def scan_documents(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row: id, base spans and their digest, tokens with their strain, and one decoy."""
    schema = T.StructType([T.StructField("id", documents.schema[id_column].dataType), *SCANNED.fields])
    span_names, token_names = _SPAN.names, _TOKEN.names

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type = pa.struct([(name, pa.int32()) for name in span_names])
        token_type = pa.struct([(n, pa.int32()) for n in token_names[:3]] + [("strain", pa.float64()), ("digest", pa.binary())])
        decoy_type = pa.struct([("encoding", pa.int32()), ("n", pa.int32()), ("strain", pa.float64())])
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                bases, digests, found, decoys = [], [], [], []
                for scalar in batch.column(1):
                    text = scalar.as_py() or ""
                    base, tokens = scan_text(text)
                    bases.append([dict(zip(span_names, s)) for s in base])
                    digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    found.append([dict(zip(token_names, t)) for t in tokens])
                    drawn = decoy(text)
                    decoys.append(drawn and dict(zip(("encoding", "n", "strain"), drawn)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(bases, pa.list_(span_type)),
                        pa.array(digests, pa.string()),
                        pa.array(found, pa.list_(token_type)),
                        pa.array(decoys, decoy_type),
                    ],
                    names=schema.names,
                )

    return documents.select(id_column, text_column).mapInArrow(scan, schema)


def ordinary_lines(decoys: DataFrame) -> dict[int, tuple[float, float, float]]:
    """Per encoding (intercept, slope, spread) of the strain of ordinary text against its length.

    ``decoys`` (encoding, n, strain) become one row of sums per encoding.
    """
    sums = decoys.groupBy("encoding").agg(
        F.count(F.lit(1)).alias("k"),
        F.avg("n").alias("n"),
        F.avg("strain").alias("y"),
        F.var_pop("n").alias("nn"),
        F.covar_pop("n", "strain").alias("ny"),
        F.var_pop("strain").alias("yy"),
    )
    lines = {}
    for r in collect_bounded(sums, len(ENCODINGS), "encodings"):
        if r["k"] > 2 and r["nn"] > 0:
            slope = r["ny"] / r["nn"]
            rest = max(0.0, r["yy"] - slope * r["ny"]) * r["k"] / (r["k"] - 2)
            if rest > 0:
                lines[r["encoding"]] = (r["y"] - slope * r["n"], slope, math.sqrt(rest))
    return lines


def distance(token: Column, lines: dict[int, tuple[float, float, float]]) -> Column:
    """How many spreads a token's strain lies above the line of ordinary text; null without a line."""
    out = F.lit(None).cast("double")
    for encoding, (at, slope, spread) in sorted(lines.items()):
        expected = F.lit(at) + F.lit(slope) * (token["end"] - token["start"])
        out = F.when(token["encoding"] == encoding, (token["strain"] - expected) / F.lit(spread)).otherwise(out)
    return out


def furthest_false_share(bins: dict[int, int], share: float = FALSE_SHARE) -> int | None:
    """Benjamini and Hochberg: the last bin of distances up to which at most ``share`` are expected to be ordinary.

    Bin ``b`` holds distances below ``(b + 1) / BINS_PER_SD``, and every token counts at that upper end.
    """
    total, upto, last = sum(bins.values()), 0, None
    for b in sorted(bins):
        upto += bins[b]
        p = 0.5 * math.erfc(-(b + 1) / BINS_PER_SD / math.sqrt(2))
        if total * p <= share * upto:
            last = b
    return last


def find_secrets(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    false_share: float = FALSE_SHARE,
    level: float = LEVEL,
) -> DataFrame:
    """Spans of secrets in every whole text.

    Returns id, ``base`` (array of start, kind, end: the fixed patterns; code points, end exclusive; kinds by their
    place in ``KINDS``), ``base_sha256`` (over ``kind:start:end`` joined by commas), ``random`` (the same for tokens of
    ``LEAST_CHARS`` characters at least that touch no base span, pass the battery at ``level``, and are told from ordinary
    text at a share ``false_share`` of false ones among all distinct tokens), and ``spans`` (all, joined).

    Texts are read once, no row is shuffled; what is aggregated are decoys and distinct tokens, down to one row per
    encoding and at most ``2 * MOST_SD * BINS_PER_SD`` counts, which is all that the driver sees.

    Defined cases: a null or empty text has no span, which is the empty string; rows that repeat an id are handled one by
    one, and copies of a text or token count once in the statistics; a null id is passed on; without decoys of an encoding
    no token of it is reported; an empty table gives an empty table; only the two named columns are read.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "secrets")
    scanned = scan_documents(documents, id_column, text_column)
    scanned.write.parquet(path)
    scanned = spark.read.schema(scanned.schema).parquet(path)

    lines = ordinary_lines(scanned.where(F.col("decoy").isNotNull()).select("decoy.*").distinct())
    each = scanned.select(F.explode("tokens").alias("t")).where(distance(F.col("t"), lines).isNotNull())
    away = F.least(F.greatest(distance(F.col("t"), lines), F.lit(-float(MOST_SD))), F.lit(MOST_SD - 1 / BINS_PER_SD))
    place = F.floor(away * BINS_PER_SD).cast("int").alias("bin")
    counted = each.groupBy("t.digest").agg(F.min(place).alias("bin")).groupBy("bin").count()
    bins = {r["bin"]: r["count"] for r in collect_bounded(counted, 2 * MOST_SD * BINS_PER_SD + 1, "bins")}
    last = furthest_false_share(bins, false_share)

    most = (-math.log(level)) ** 0.25
    if last is None:
        added = F.array().cast(T.ArrayType(_SPAN))
    else:
        limit = (last + 1) / BINS_PER_SD
        random = F.filter("tokens", lambda t: (t["strain"] <= most) & (distance(t, lines) < limit))
        added = F.transform(
            random, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end"))
        )
    names = F.array(*[F.lit(k) for k in KINDS])
    told = F.transform(
        F.array_sort(F.concat("base", "random")),
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return scanned.select("id", "base", "base_sha256", added.alias("random")).select(
        F.col("id").alias(id_column), "base", "base_sha256", "random", F.array_join(told, ",").alias("spans")
    )
