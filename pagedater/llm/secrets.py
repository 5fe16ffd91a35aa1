"""Secrets in texts, found with column functions only.

Three patterns give the base spans. To them come strings of 20 or more characters that look
drawn at random. The encoding of a string is the smallest alphabet that holds it, so every
string has one. A battery of three tests asks whether it may be uniform in that alphabet:
chi-squared over the characters (pooled, so that a cell expects five or more), runs above and
below the middle, and the correlation of neighbours; Fisher's method joins the three. What
the battery calls structured is no secret. The others are tested against ordinary words and
numbers: letters and digits of all texts, those strings left out, tell how surprising as many
letters and digits are on average and how far that varies, and a string's own surprise gives
its p-value, as does the chance that its letters, if all are hex digits, would be so. Published shares of English letters give another such value, and the larger one
counts, so that a table of few words can't make ordinary letters rare. Within each band of lengths (a power of two) the procedure of Benjamini and
Hochberg keeps the share of ordinary strings among those reported below a rate.

Null and empty texts have no spans. Digits are alike in the published shares, so a string of
digits alone, which might be any number, is not reported.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagedater.llm.common import picked
from pagedater.session import stage

# The patterns of the base kinds, in the order that breaks ties.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
#: Runs are maximal, so a least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

CANDIDATE = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Share of the strings reported as random that may be ordinary ones.
FALSE_DISCOVERY = 0.01
#: Strings whose joint p-value under "uniform" lies below this are structured.
STRUCTURED = 0.001
#: Letters of a word depend on each other: variance of a string's surprise over that of letters drawn one by one.
SPREAD = 1.5
#: Weight of the chance of hex letters beside that of the surprise (a weighted Bonferroni bound).
HEX_SHARE = 0.2
#: Characters of a pooled cell of the chi-squared test, on average.
CELL = 5
#: Joint p-values fall into bins of this many to a factor of ten; the last bin holds all below.
BINS_PER_TEN = 20
LAST_BIN = 20 * 300

ALPHABETS = {
    "digits": "0123456789",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "hex": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base36_upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64_url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
# Letters in English texts, a to z, in thousandths of a per cent.
ENGLISH = (
    8167, 1492, 2782, 4253, 12702, 2228, 2015, 6094, 6966, 153, 772, 4025, 2406,
    6749, 7507, 1929, 95, 5987, 6327, 9056, 2758, 978, 2360, 150, 1974, 74,
)
COUNTED = ALPHABETS["base36"]
CHUNK = 64


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column, kind: str = "long") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda a, x: a + x.cast(kind))


def _sums_before(lengths: Column) -> Column:
    """For each element the sum of those before it; in chunks, so that long lists stay cheap."""

    def within(chunk: Column, base: Column) -> Column:
        return F.transform(chunk, lambda _, i: base + _sum(F.slice(chunk, F.lit(1), i)))

    def chunked(chunks: Column) -> Column:
        sums = F.transform(chunks, lambda c: _sum(c))
        return _bind(sums, lambda s: F.flatten(F.transform(chunks, lambda c, i: within(c, _sum(F.slice(s, F.lit(1), i))))))

    def cut(x: Column) -> Column:
        last = F.floor((F.size(x) - 1) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(x, i * CHUNK + 1, F.lit(CHUNK)))

    return _bind(lengths, lambda x: _bind(cut(x), chunked))


def _spans(matches: Column, text: Column, pattern: str) -> Column:
    """(start, end, value) of each match, in code points, end exclusive.

    What a split leaves between the matches tells where they lie.
    """
    between = F.split(text, pattern, -1)

    def place(both: Column) -> Column:
        found, gaps = both["found"], both["gaps"]
        steps = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        return _bind(
            _sums_before(steps),
            lambda before: F.transform(
                found,
                lambda m, i: F.struct(
                    (F.get(before, i) + F.length(F.get(gaps, i))).alias("start"),
                    (F.get(before, i) + F.length(F.get(gaps, i)) + F.length(m)).alias("end"),
                    m.alias("value"),
                ),
            ),
        )

    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    some = _bind(F.struct(matches.alias("found"), between.alias("gaps")), place)
    return F.when(F.size(matches) > 0, some).otherwise(none)


def _alphabet(value: Column) -> Column:
    """The smallest alphabet that holds the string."""
    body = F.rtrim(value, F.lit("="))
    out = F.when(body.rlike("^[0-9]+$"), F.lit(ALPHABETS["digits"]))
    for name, pattern in (
        ("hex", "^[0-9a-f]+$"),
        ("hex_upper", "^[0-9A-F]+$"),
        ("lower", "^[a-z]+$"),
        ("upper", "^[A-Z]+$"),
        ("base32", "^[A-Z2-7]+$"),
        ("base36", "^[0-9a-z]+$"),
        ("base36_upper", "^[0-9A-Z]+$"),
        ("letters", "^[A-Za-z]+$"),
        ("base62", "^[0-9A-Za-z]+$"),
        ("base64", "^[0-9A-Za-z+/]+$"),
        ("base64_url", "^[0-9A-Za-z_-]+$"),
    ):
        out = out.when(body.rlike(pattern), F.lit(ALPHABETS[name]))
    return out.otherwise(F.lit(ALPHABETS["mixed"]))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable (Abramowitz and Stegun 7.1.26)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = poly * F.exp(-x * x) / 2
    return F.greatest(F.when(z >= 0, half).otherwise(1 - half), F.lit(1e-300))


def _joint_p(value: Column) -> Column:
    """Joint p-value of the three tests against "uniform in its alphabet"."""

    def coded(known: Column) -> Column:
        codes = F.transform(F.split(known["body"], ""), lambda c: F.instr(known["letters"], c) - 1)
        k, n = F.length(known["letters"]), F.length(known["body"])
        cells = F.greatest(F.lit(2), F.least(k, F.floor(n / CELL).cast("int")))
        return F.struct(codes.alias("x"), k.alias("k"), n.alias("n"), cells.alias("cells"))

    def sums(s: Column) -> Column:
        x, k, cells = s["x"], s["k"], s["cells"]

        def cell(j: Column) -> Column:
            width = F.ceil((j + 1) * k / cells) - F.ceil(j * k / cells)
            held = F.size(F.filter(x, lambda v: F.floor(v * cells / k) == j)).cast("double")
            return held * held / width

        squares = _sum(F.transform(F.sequence(F.lit(0), cells - 1), cell), "double")
        high = _sum(F.transform(x, lambda v: (v * 2 >= k).cast("long")))
        turns = _sum(F.transform(x, lambda v, i: F.coalesce(((F.get(x, i - 1) * 2 >= k) != (v * 2 >= k)).cast("long"), F.lit(0))))
        return F.struct(
            x.alias("x"),
            s["n"].cast("double").alias("n"),
            (squares * k / s["n"] - s["n"]).alias("chi"),
            (cells - 1).cast("double").alias("free"),
            high.cast("double").alias("high"),
            (turns + 1).alias("runs"),
            (_sum(x, "double") / s["n"]).alias("mean"),
        )

    def z_scores(s: Column) -> Column:
        x, n, free, mean = s["x"], s["n"], s["free"], s["mean"]
        # Wilson and Hilferty: the cube root of a chi-squared value is nearly normal.
        part = 2 / (9 * free)
        chi = (F.cbrt(F.greatest(s["chi"], F.lit(0.0)) / free) - (1 - part)) / F.sqrt(part)
        expected = 2 * s["high"] * (n - s["high"]) / n + 1
        runs = F.when(expected <= 2, F.lit(9.0)).otherwise(
            F.abs(s["runs"] - expected) / F.sqrt((expected - 1) * (expected - 2) / (n - 1))
        )
        spread = _sum(F.transform(x, lambda v: (v - mean) * (v - mean)), "double")
        product = _sum(F.transform(x, lambda v, i: F.coalesce((F.get(x, i - 1) - mean) * (v - mean), F.lit(0.0))), "double")
        serial = F.when(spread <= 0, F.lit(9.0)).otherwise(F.abs(product / spread) * F.sqrt(n))
        return F.struct(chi.alias("chi"), runs.alias("runs"), serial.alias("serial"))

    def fisher(z: Column) -> Column:
        p = (_upper_tail(z["chi"]), F.least(2 * _upper_tail(z["runs"]), F.lit(1.0)), F.least(2 * _upper_tail(z["serial"]), F.lit(1.0)))
        half = -sum((F.ln(x) for x in p), F.lit(0.0))
        return _bind(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))

    known = F.struct(F.rtrim(value, F.lit("=")).alias("body"), _alphabet(value).alias("letters"))
    return _bind(known, lambda w: _bind(_bind(_bind(coded(w), sums), z_scores), fisher))


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))


def tested(docs: DataFrame) -> DataFrame:
    """Base spans and tested strings of every whole text, beside the columns given.

    Adds ``base`` (start, kind, end), ``tried`` (start, end, band, body, uniform) and
    ``counted``, how often each letter and digit stands outside the tested strings. Null and
    empty texts have none of either.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        *(docs[c] for c in docs.columns),
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)).alias("_assign"),
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)).alias("_values"),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)).alias("_access"),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)).alias("_hex"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("_tokens"),
    )
    assign = F.filter(
        _spans(F.col("_assign"), text, ASSIGN),
        lambda s, i: F.length(F.get(F.col("_values"), i)) >= ASSIGN_VALUE,
    )
    kinds = (assign, _spans(F.col("_access"), text, ACCESS), _spans(F.col("_hex"), text, HEX))

    def of_kind(kind: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: _span(kind, s["start"], s["end"]))

    base = [of_kind(k, spans) for k, spans in enumerate(kinds)]
    tried = F.transform(
        _spans(F.col("_tokens"), text, CANDIDATE),
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.floor(F.log2((s["end"] - s["start"]).cast("double"))).cast("int").alias("band"),
            F.lower(F.rtrim(s["value"], F.lit("="))).alias("body"),
            _joint_p(s["value"]).alias("uniform"),
        ),
    )
    words = F.lower(F.when(F.size("_tokens") > 0, F.regexp_replace(text, CANDIDATE, " ")).otherwise(text))

    def counted(w: Column) -> Column:
        return F.array(*(F.octet_length(w) - F.octet_length(F.replace(w, F.lit(c), F.lit(""))) for c in COUNTED))

    return (
        found.withColumn("base", F.sort_array(F.concat(*base)))
        .withColumn("tried", tried)
        .withColumn("_words", words)
        .withColumn("counted", counted(F.col("_words")))
        .drop("_assign", "_values", "_access", "_hex", "_tokens", "_words")
    )


@dataclass(frozen=True)
class Ordinary:
    """How surprising letters (and digits) of ordinary words (and numbers) are: -ln of their
    share among all letters (digits), each counted once more than it occurs."""

    surprise: dict[str, float]
    mean: tuple[float, float]
    variance: tuple[float, float]
    hex_letters: float


def ordinary(counts: dict[str, int]) -> Ordinary:
    """Mean and variance of the surprise of a letter and of a digit, drawn by their counts."""
    surprise, mean, variance = {}, [], []
    for kind in (ALPHABETS["lower"], ALPHABETS["digits"]):
        total = sum(counts.get(c, 0) + 1 for c in kind)
        share = {c: (counts.get(c, 0) + 1) / total for c in kind}
        each = {c: -math.log(p) for c, p in share.items()}
        surprise |= each
        mean.append(sum(share[c] * each[c] for c in kind))
        variance.append(sum(share[c] * (each[c] - mean[-1]) ** 2 for c in kind))
    hex_letters = sum(math.exp(-surprise[c]) for c in "abcdef")
    return Ordinary(surprise, tuple(mean), tuple(variance), hex_letters)


def ordinary_letters(known: DataFrame) -> list[Ordinary]:
    """Published shares, and those of all texts if they hold any letter or digit; a row of 36
    sums leaves each task."""
    row = known.agg(*(F.sum(F.get("counted", i).cast("long")).alias(f"n{i}") for i in range(len(COUNTED)))).first()
    counts = {c: int(row[i] or 0) for i, c in enumerate(COUNTED)}
    published = ordinary(dict(zip(ALPHABETS["lower"], ENGLISH)))
    return [published, ordinary(counts)] if any(counts.values()) else [published]


def _ordinary_p(s: Column, nulls: list[Ordinary]) -> Column:
    """Chance that ordinary letters and digits, as many of each, surprise as much; 1 for structured strings."""

    def total(null: Ordinary) -> Column:
        table = F.create_map(*(F.lit(x) for pair in null.surprise.items() for x in pair))
        return _sum(F.transform(F.split(s["body"], ""), lambda c: F.coalesce(F.try_element_at(table, c), F.lit(0.0))), "double")

    def tail(n: Column) -> Column:
        each = []
        for i, null in enumerate(nulls):
            mean = n["letters"] * null.mean[0] + n["digits"] * null.mean[1]
            variance = SPREAD * (n["letters"] * null.variance[0] + n["digits"] * null.variance[1])
            rare = F.when(variance > 1e-9, _upper_tail((n[f"s{i}"] - mean) / F.sqrt(variance))).otherwise(F.lit(1.0))
            all_hex = F.when(n["hex"], F.pow(F.lit(null.hex_letters), n["letters"])).otherwise(F.lit(1.0))
            each.append(F.least(rare / (1 - HEX_SHARE), all_hex / HEX_SHARE, F.lit(1.0)))
        return F.greatest(*each, F.lit(0.0))

    both = F.struct(
        F.length(F.regexp_replace(s["body"], "[^a-z]", "")).cast("double").alias("letters"),
        F.length(F.regexp_replace(s["body"], "[^0-9]", "")).cast("double").alias("digits"),
        (~s["body"].rlike("[g-z]")).alias("hex"),
        *(total(null).alias(f"s{i}") for i, null in enumerate(nulls)),
    )
    return F.when(s["uniform"] < STRUCTURED, F.lit(1.0)).otherwise(_bind(both, tail))


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS_PER_TEN), F.lit(LAST_BIN)).cast("int")


def first_reported_bin(tried: DataFrame, rate: float = FALSE_DISCOVERY) -> dict[int, int]:
    """Per band of lengths the first bin of p-values whose strings are reported.

    Benjamini and Hochberg over counts per band and bin: at most 32 bands of 6,001 bins,
    whatever the number of strings. A bin counts as its largest p-value.
    """
    counts = tried.groupBy("band", _bin(F.col("p")).alias("bin")).agg(F.count("*").alias("n"))
    band = Window.partitionBy("band")
    ranked = counts.withColumn("m", F.sum("n").over(band)).withColumn("k", F.sum("n").over(band.orderBy(F.desc("bin"))))
    edge = F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_TEN)
    cut = ranked.filter(edge <= rate * F.col("k") / F.col("m")).groupBy("band").agg(F.min("bin").alias("bin"))
    return {row["band"]: row["bin"] for row in cut.collect()}


def find_spans(docs: DataFrame, rate: float = FALSE_DISCOVERY) -> DataFrame:
    """Add ``base`` and ``spans`` to documents, both sorted arrays of (start, kind, end).

    A random-looking string that overlaps a base span adds nothing.
    """
    known = stage(tested(docs), "tested")
    nulls = ordinary_letters(known)
    known = known.withColumn(
        "tried",
        F.transform("tried", lambda s: F.struct(s["start"], s["end"], s["band"], _ordinary_p(s, nulls).alias("p"))),
    )
    cuts = first_reported_bin(known.select(F.explode("tried").alias("t")).select("t.band", "t.p"), rate)
    if cuts:
        by_band = F.create_map(*(F.lit(x) for pair in sorted(cuts.items()) for x in pair))
        random = F.filter(
            F.col("tried"),
            lambda s: (_bin(s["p"]) >= F.coalesce(F.try_element_at(by_band, s["band"]), F.lit(LAST_BIN + 1)))
            & ~F.exists(F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
        )
        spans = F.concat(F.col("base"), F.transform(random, lambda s: _span(3, s["start"], s["end"])))
    else:
        spans = F.col("base")
    return known.withColumn("spans", F.sort_array(spans)).drop("tried", "counted")


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_report(docs: DataFrame, rate: float = FALSE_DISCOVERY) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans, per document."""
    found = find_spans(picked(docs, "doc_id", "text"), rate)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", rate: float = FALSE_DISCOVERY) -> DataFrame:
    """Documents with every span of their texts replaced by ``mark``; others stay as they are.

    Overlapping spans are replaced as one. All columns are kept; null texts stay null.
    """
    rows = docs.select(F.col("text"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    found = find_spans(rows, rate)

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["end"]
        kept = F.substring(F.col("text"), (done["end"] + 1).cast("int"), (s["start"] - done["end"]).cast("int"))
        return F.struct(
            F.greatest(done["end"], s["end"]).alias("end"),
            F.when(fresh, F.concat(done["out"], kept, F.lit(mark))).otherwise(done["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit("").alias("out"))
    redacted = F.aggregate(
        F.col("spans"), start, step, lambda x: F.concat(x["out"], F.substring(F.col("text"), (x["end"] + 1).cast("int"), F.length("text")))
    )
    text = F.when(F.size("spans") > 0, redacted).otherwise(F.col("text"))
    return found.select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
