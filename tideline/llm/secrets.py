"""Secret scan (operator 3), with DataFrame functions only.

Base patterns find assignments, access keys and hex strings. Beside them, every token of at least 12 characters is
tested: its encoding is inferred, and chi-squared uniformity over that alphabet, runs of
character classes (of vowels and consonants, where all letters are of one case) and serial correlation say whether it looks random. What passes gets a p-value: the chance that
a token of ordinary text of that length looks as random. A false-discovery threshold, found from the p-values of all documents for each band of
lengths, and apart for tokens with and without a digit, decides which tokens are added.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log10

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: kinds in order, patterns (an `assign` is told by its second group) and least lengths.
KINDS = ("assign", "access", "hex")
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 or more: what follows a failing match is shorter still
_HEX = r"[0-9a-f]{24,}"
_LEAST_ASSIGNED = 6

RANDOM = "random"
_TOKEN = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{12,}"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Inferred encoding: the first whose pattern the token matches, and the size of its alphabet.
_ENCODINGS = ((r"^([0-9a-f]+|[0-9A-F]+)$", 16), (r"^([a-z]+|[A-Z]+)$", 26), (r"^[A-Za-z]+$", 52), (r"^[A-Z2-7]+=*$", 32), (r"^([0-9a-z]+|[0-9A-Z]+)$", 36), (r"", 64))


@dataclass(frozen=True)
class Settings:
    discovery_rate: float = 0.01
    bands: tuple[int, ...] = (12, 16, 20, 28, 40, 64, 128)  # least lengths of the bands
    furthest: float = 3.3  # standard deviations from randomness that a test lets pass
    class_changes: float = 0.1  # changes of character class a letter in ordinary text
    vowel_changes: float = 0.6  # changes between vowels and consonants a letter in ordinary text
    steps: int = 20  # histogram steps for each power of ten of a p-value
    longest_power: int = 40


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _add(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def _running(values: Column) -> Column:
    """Sums of the first 1, 2, ... values, by blocks of about the root of their number."""

    def by_block(s: Column) -> Column:
        values, width = s["values"], s["width"]
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / width).cast("int") - 1), lambda k: _add(F.slice(values, k * width + 1, width)))
        return _let(
            F.struct(values.alias("values"), width.alias("width"), blocks.alias("blocks")),
            lambda t: _let(
                F.struct(t["values"].alias("values"), t["width"].alias("width"), F.transform(t["blocks"], lambda _, k: _add(F.slice(t["blocks"], F.lit(1), k))).alias("before")),
                lambda u: F.transform(
                    u["values"],
                    lambda _, i: F.element_at(u["before"], F.floor(i / u["width"]).cast("int") + 1)
                    + _add(F.slice(u["values"], F.floor(i / u["width"]).cast("int") * u["width"] + 1, i % u["width"] + 1)),
                ),
            ),
        )

    return _let(F.struct(values.alias("values"), F.ceil(F.sqrt(F.size(values))).cast("int").alias("width")), by_block)


def _places(text: Column, pattern: str, matches: Column) -> Column:
    """(start, end) of every match, in code points: the text is split at the matches and lengths are summed."""
    lengths = F.zip_with(
        F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap).cast("long")),
        F.transform(matches, lambda m: F.length(m).cast("long")),
        lambda gap, m: F.struct(F.coalesce(gap, F.lit(0)).alias("gap"), F.coalesce(m, F.lit(0)).alias("size")),
    )

    def summed(parts: Column) -> Column:
        ends = _running(F.transform(parts, lambda p: p["gap"] + p["size"]))
        both = F.zip_with(parts, ends, lambda p, end: F.struct((end - p["size"]).alias("start"), end.alias("end")))
        return F.slice(both, F.lit(1), F.size(matches))

    return F.when(F.size(matches) > 0, _let(lengths, summed)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


def _with_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base (start, kind, end) sorted, candidates (start, end, token)."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(
        "doc_id",
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(_ASSIGN), F.lit(0)).alias("assign"),
        F.regexp_extract_all(text, F.lit(_ACCESS), F.lit(0)).alias("access"),
        F.regexp_extract_all(text, F.lit(_HEX), F.lit(0)).alias("hex"),
        F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)).alias("tokens"),
    )
    values = F.when(F.size("assign") > 0, F.regexp_extract_all("text", F.lit(_ASSIGN), F.lit(2))).otherwise(F.array().cast("array<string>"))
    placed = found.select(
        "doc_id",
        F.zip_with(_places(F.col("text"), _ASSIGN, F.col("assign")), values, lambda p, v: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.length(v).alias("n"))).alias("assign"),
        _places(F.col("text"), _ACCESS, F.col("access")).alias("access"),
        _places(F.col("text"), _HEX, F.col("hex")).alias("hex"),
        F.zip_with(_places(F.col("text"), _TOKEN, F.col("tokens")), F.col("tokens"), lambda p, t: F.struct(p["start"].alias("start"), p["end"].alias("end"), t.alias("token"))).alias("candidates"),
    )

    def kind(name: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(name)).alias("kind"), s["end"].alias("end")))

    assigned = F.filter("assign", lambda s: s["n"] >= _LEAST_ASSIGNED)
    return placed.select(
        "doc_id",
        F.array_sort(F.concat(kind("assign", assigned), kind("access", F.col("access")), kind("hex", F.col("hex")))).alias("base"),
        "candidates",
    )


def _normal(z: Column) -> Column:
    """Standard normal distribution function (a logistic approximation, right to 2e-4, rising throughout)."""
    x = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(-(1.5976 * x + 0.070566 * x * x * x)))


def _statistics(token: Column, squares: float, cubes: float, s: Settings) -> Column:
    """(n, passed, p) of a token: whether it looks random, and the chance of ordinary text looking so."""
    size = F.lit(_ENCODINGS[-1][1])
    for pattern, letters in reversed(_ENCODINGS[:-1]):
        size = F.when(token.rlike(pattern), letters).otherwise(size)
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c).cast("double"))
    often = F.aggregate(
        F.array_distinct(F.split(token, "")), F.lit(0.0), lambda total, c: total + F.pow((F.length(token) - F.length(F.replace(token, c, F.lit("")))).cast("double"), F.lit(2.0))
    )
    kinds = F.when(size == 26, F.length(F.regexp_replace(F.lower(token), "[aeiou]+|[^aeiou]+", "x"))).otherwise(
        F.length(F.regexp_replace(token, "[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+", "x"))
    )
    facts = F.struct(token.rlike("[0-9]").alias("digits"), F.length(token).cast("double").alias("n"), size.cast("double").alias("k"), often.alias("often"), kinds.cast("double").alias("runs"), codes.alias("codes"))

    def tested(t: Column) -> Column:
        n, k = t["n"], t["k"]
        mean = F.aggregate(t["codes"], F.lit(0.0), lambda a, x: a + x) / n
        spread = F.aggregate(t["codes"], F.lit(0.0), lambda a, x: a + x * x) / n - mean * mean
        beside = F.zip_with(F.slice(t["codes"], F.lit(1), F.size(t["codes"]) - 1), F.slice(t["codes"], F.lit(2), F.size(t["codes"]) - 1), lambda x, y: x * y)
        product = F.aggregate(beside, F.lit(0.0), lambda a, x: a + x) / (n - 1) - mean * mean
        serial = F.when(spread > 0, product / spread).otherwise(1.0) * F.sqrt(n)
        chi = k / n * t["often"] - n
        uniform = (chi - (k - 1)) / F.sqrt(2 * (k - 1))
        digits = F.when(k == 16, 10 / 16).when(k == 32, 6 / 32).when(k == 36, 10 / 36).otherwise(10 / 64)
        # Chance of a change of class between neighbours of a random string.
        change = F.when(k == 26, 2 * 5 / 26 * 21 / 26).when(k == 52, 0.5).when(k == 64, 1 - 2 * (26 / 64) ** 2 - (10 / 64) ** 2 - (2 / 64) ** 2).otherwise(2 * digits * (1 - digits))
        runs = (t["runs"] - 1 - change * (n - 1)) / F.sqrt(change * (1 - change) * (n - 1))
        passed = (uniform <= s.furthest) & (F.abs(runs) <= s.furthest) & (F.abs(serial) <= s.furthest)
        # The same under ordinary letters: squares and cubes are sums of powers of their shares.
        text_mean = k * (1 - squares) + n * (k * squares - 1)
        text_spread = F.sqrt(4 * n * k * k * (cubes - squares * squares) + 2 * k * k * squares * squares)
        even = _normal((chi - text_mean) / text_spread)
        changes = s.class_changes * n
        vowels = s.vowel_changes * (n - 1)
        unmixed = _normal((t["runs"] - 1 - vowels) / F.sqrt(vowels * (1 - s.vowel_changes)))
        mixed = F.when(k == 26, unmixed).otherwise(_normal((changes - (t["runs"] - 1)) / F.sqrt(changes)))
        tail = -(F.log(F.greatest(even, F.lit(1e-30))) + F.log(F.greatest(mixed, F.lit(1e-30))))
        return F.struct(n.alias("n"), t["digits"].alias("digits"), passed.alias("passed"), (F.exp(-tail) * (1 + tail)).alias("p"))  # Fisher's method for two tests

    return _let(facts, tested)


def _band(test: Column, s: Settings) -> Column:
    """Band of the token's length; those of tokens without a digit come after the others."""
    return sum(((test["n"] >= least).cast("int") for least in s.bands[1:]), F.when(test["digits"], 0).otherwise(len(s.bands)))


def _step(p: Column, s: Settings) -> Column:
    """Step of the p-value's histogram; higher for smaller p."""
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * s.steps), F.lit(s.steps * s.longest_power)).cast("int")


def _letter_shares(spans: DataFrame) -> tuple[float, float]:
    """Sums of squares and cubes of the letters' shares in long tokens without digits, over all documents."""
    plain = F.transform(F.filter("candidates", lambda c: ~c["token"].rlike("[0-9]")), lambda c: c["token"])
    counts = spans.select(F.lower(F.array_join(plain, "")).alias("words")).agg(*[F.sum(F.length("words") - F.length(F.replace("words", F.lit(c), F.lit("")))).alias(c) for c in _LETTERS]).first()
    total = sum(x or 0 for x in counts)
    shares = [(x or 0) / total for x in counts] if total else [1 / len(_LETTERS)] * len(_LETTERS)
    return sum(x**2 for x in shares), sum(x**3 for x in shares)


def _thresholds(scored: DataFrame, s: Settings) -> list[int]:
    """By band: the least histogram step that is a discovery, by Benjamini and Hochberg's rule over all candidates."""
    counts = scored.groupBy("band", "step").agg(F.count("*").alias("n")).collect()
    out = []
    for band in range(2 * len(s.bands)):
        steps = sorted(((r["step"], r["n"]) for r in counts if r["band"] == band), reverse=True)
        total, so_far, least = sum(n for _, n in steps), 0, s.steps * s.longest_power + 1
        for step, n in steps:
            so_far += n
            if -step / s.steps <= log10(s.discovery_rate * so_far / total):
                least = step
        out.append(least)
    return out


def find_secrets(docs: DataFrame, scratch: str, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_random for every row of `docs` (doc_id, text).

    Null texts count as empty; repeated rows stay. Spans are kind:start:end by start, then kind, in code points, end exclusive; `random`
    ones come from the test battery and lie outside base spans. Places found in the texts
    are written to `scratch`, on shared storage, and read for the statistics; a few hundred numbers reach the driver.
    """
    s = settings
    spark = docs.sparkSession
    _with_spans(docs).write.parquet(scratch)
    spans = spark.read.parquet(scratch)
    squares, cubes = _letter_shares(spans)
    tested = spans.select("doc_id", "base", F.transform("candidates", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), _statistics(c["token"], squares, cubes, s).alias("test"))).alias("candidates"))
    each = tested.select(F.explode("candidates.test").alias("test"))
    scored = each.select(_band(F.col("test"), s).alias("band"), F.when(F.col("test.passed"), _step(F.col("test.p"), s)).otherwise(0).alias("step"))
    least = F.array(*[F.lit(x) for x in _thresholds(scored, s)])

    def added(c: Column) -> Column:
        test = c["test"]
        outside = ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        return test["passed"] & (_step(test["p"], s) >= F.element_at(least, _band(test, s) + 1)) & outside

    random = F.transform(F.filter("candidates", added), lambda c: F.struct(c["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), c["end"].alias("end")))
    both = tested.select("base", "doc_id", random.alias("random"))
    names = F.array(*[F.lit(k) for k in (*KINDS, RANDOM)])

    def shown(list_: Column) -> Column:
        return F.array_join(F.transform(list_, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(name: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(name))).cast("long").alias(f"n_{name}")

    return both.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(shown(F.col("base")), 256).alias("base_sha256"),
        shown(F.array_sort(F.concat("base", "random"))).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )
