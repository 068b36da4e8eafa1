"""Secret scans with DataFrame functions only.

Base patterns (assignments, access keys, long hexadecimal runs) are found with their positions. Every
other long token is put to a battery of randomness tests within its inferred encoding: chi-squared
uniformity of its alphabet, the runs test and the lag-one serial correlation; a token without digits also
to a test whether its letters follow each other as in prose. Its p-value is small
where the token has structure. Tokens are dismissed as structured by the step-up rule of false
discovery control over all tokens of the corpus, with weights that grow with the length, as longer
tokens give the tests more power; what is not dismissed is reported as ``random``.

The rule needs the ranks of all p-values; they are counted in a fixed number of bins (an aggregate
with partial results, BINS rows at most) and a bin counts with its largest p-value, so the threshold
errs to the safe side. Both passes are row by row inside the scan: no join, no shuffle of texts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
# Runs of hexadecimal characters are taken whole, so the minimum can stand in the pattern.
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"

# Encodings from narrow to wide: a name, the characters allowed, the alphabet.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
ENCODINGS = (
    ("decimal", r"^[0-9]+$", DIGITS),
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"),
    ("upper_hex", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^[A-Z2-7]+=*$", UPPER + "234567"),
    ("lower", r"^[a-z]+$", LOWER),
    ("lower36", r"^[a-z0-9]+$", DIGITS + LOWER),
    ("upper36", r"^[A-Z0-9]+$", DIGITS + UPPER),
    ("base62", r"^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("base64", r"^[A-Za-z0-9+/_-]+=*$", UPPER + LOWER + DIGITS + "+/-_"),
)

# For each letter and the next one, how much more often they occur in English prose than in random
# letters, on a logarithmic scale of ten steps; rows are the first letters.
BIGRAMS = (
    "06750240603879050989441150703090007809006207519000808050900860580090050970000075369310900412820366624030"
    "62785630500569354987043640702176009005019208388000507131924880063854086670200090009000800010800316000000"
    "56845650000659930498050001402090001000004100007000007340932090043645038550501080169400900801720066711070"
    "96109000700050880064600000717983806004238100895400502657283020156936095775500090039002600800870928600070"
    "10000000000000000000900000925592509052658306774230607162930680042376018970204070319109900310810766404050"
    "66657140600888160899000000900090009000005000000000009000700990030590054200200080919103700011390039000350"
    "7454541170034699078822602191009400900020420031000050"
)
_steps = [[int(BIGRAMS[26 * a + b]) for b in range(26)] for a in range(26)]
_mean = sum(map(sum, _steps)) / 676
_variance = sum((x - _mean) ** 2 for row in _steps for x in row) / 676
# Neighbouring pairs share a letter.
_shared = sum((sum(row[k] for row in _steps) / 26 - _mean) * (sum(_steps[k]) / 26 - _mean) for k in range(26)) / 26

RATE = 0.05
MIN_BITS = 96.0
BINS = 400
BINS_PER_DECADE = 20
TYPICAL_LENGTH = 32.0


def located(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Matches as an array of (s, e, token): code points, end exclusive; ``token`` is the group.

    Matches whose group is shorter than ``least`` are left out after matching, without a retry.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), whole.alias("all"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part")
    )
    kind = "array<struct<s:int,e:int,token:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def step(acc: Column, z: Column) -> Column:
        s = acc["at"] + F.char_length(z["gap"])
        e = s + F.char_length(z["all"])
        hit = F.array(F.struct(s.alias("s"), e.alias("e"), z["part"].alias("token")))
        return F.struct(e.alias("at"), F.concat(acc["found"], F.when(F.char_length(z["part"]) >= least, hit).otherwise(F.array().cast(kind))).alias("found"))

    # The last gap has no match after it.
    walk = F.aggregate(F.slice(parts, 1, F.size(whole)), start, step, lambda acc: acc["found"])
    return F.when(text.rlike(pattern), walk).otherwise(F.array().cast(kind))


def two_sided(z: Column) -> Column:
    """Tail probability of a normal value on both sides (rational approximation of erfc)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    # Coefficients of the published approximation.
    sum_ = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), F.greatest(F.lit(1e-18), sum_ * F.exp(-x * x)))


def upper_tail(x2: Column, k: Column) -> Column:
    """Upper tail of a chi-squared value with ``k`` degrees of freedom by the cube-root normal."""
    z = (F.pow(x2 / k, F.lit(1 / 3)) - (1 - 2 / (9 * k))) / F.sqrt(2 / (9 * k))
    return F.when(z > 0, two_sided(z) / 2).otherwise(1 - two_sided(z) / 2)


def alphabet_of(token: Column) -> Column:
    found = F.lit(ENCODINGS[-1][2])
    for _, pattern, alphabet in reversed(ENCODINGS[:-1]):
        found = F.when(token.rlike(pattern), F.lit(alphabet)).otherwise(found)
    return found


def battery(token: Column) -> Column:
    """p-value of the token under a uniform random choice of every character, three tests combined.

    Three times the smallest of the three p-values, at most 1.
    """

    def tests(alphabet: Column, body: Column) -> Column:
        chars = F.filter(F.split(body, ""), lambda c: c != "")
        places = F.transform(chars, lambda c: (F.instr(alphabet, c) - 1).cast("double"))
        n, size = F.char_length(body).cast("double"), F.char_length(alphabet).cast("double")
        expected = n / size
        squares = F.aggregate(
            F.filter(F.split(alphabet, ""), lambda c: c != ""),
            F.lit(0.0),
            lambda acc, c: acc + F.pow(n - F.char_length(F.replace(body, c, F.lit(""))) - expected, F.lit(2.0)),
        )
        uniform = upper_tail(squares / expected, size - 1)
        pairs = F.arrays_zip(F.slice(places, F.lit(1), F.size(places) - 1).alias("a"), F.slice(places, F.lit(2), F.size(places) - 1).alias("b"))
        half = size / 2
        high = F.aggregate(places, F.lit(0.0), lambda acc, p: acc + F.when(p >= half, 1.0).otherwise(0.0))
        low = n - high
        runs = F.aggregate(pairs, F.lit(1.0), lambda acc, z: acc + F.when((z["a"] >= half) != (z["b"] >= half), 1.0).otherwise(0.0))
        mean_runs = 2 * high * low / n + 1
        spread = F.sqrt(F.greatest(F.lit(1e-9), (mean_runs - 1) * (mean_runs - 2) / (n - 1)))
        run_test = F.when((high < 1) | (low < 1), F.pow(F.lit(0.5), n - 1)).otherwise(two_sided((runs - mean_runs) / spread))
        mean, var = (size - 1) / 2, (size * size - 1) / 12
        product = F.aggregate(pairs, F.lit(0.0), lambda acc, z: acc + (z["a"] - mean) * (z["b"] - mean))
        serial = two_sided(product / var / F.sqrt(n - 1))
        return F.least(F.lit(1.0), 3 * F.least(uniform, run_test, serial))

    body = F.regexp_replace(token, "=+$", "")
    # One-element arrays give the token's parts a name inside the expression.
    return F.transform(F.array(F.struct(alphabet_of(token).alias("a"), body.alias("b"))), lambda z: tests(z["a"], z["b"]))[0]


def prose(token: Column) -> Column:
    """p-value of the letters of the token under a random choice, against letters that follow as in prose."""

    def tail(letters: Column) -> Column:
        n = F.char_length(letters)
        code = lambda i: F.ascii(F.substr(letters, i, F.lit(1))) - 97
        total = F.aggregate(
            F.sequence(F.lit(1), n - 1), F.lit(0.0),
            lambda acc, i: acc + F.ascii(F.substr(F.lit(BIGRAMS), code(i) * 26 + code(i + 1) + 1, F.lit(1))) - 48,
        )
        z = (total - (n - 1) * _mean) / F.sqrt((n - 1) * _variance + (n - 2) * 2 * _shared)
        return F.when(n < 5, F.lit(1.0)).when(z > 0, two_sided(z) / 2).otherwise(1 - two_sided(z) / 2)

    return F.transform(F.array(F.regexp_replace(F.lower(token), "[^a-z]", "")), tail)[0]


def evidence(token: Column) -> Column:
    """The battery; a token without digits is put to the test of its letters, too."""
    digits = token.rlike("[0-9]")
    return F.least(F.lit(1.0), battery(token) * F.when(digits, 1.0).otherwise(4 / 3), F.when(digits, 1.0).otherwise(prose(token) * 4))


def bits(token: Column) -> Column:
    return F.char_length(token) * F.log2(F.char_length(alphabet_of(token)).cast("double"))


def tested(text: Column) -> Column:
    """Tokens with (s, e, token, p, wordy): p is divided by the weight of the token's length.

    Tokens without digits (``wordy``) are words run together far more often than keys; they have a step-up
    rule of their own, so neither kind moves the threshold of the other.
    """
    long_enough = F.filter(located(text, TOKEN), lambda m: bits(m["token"]) >= MIN_BITS)
    return F.transform(
        long_enough,
        lambda m: F.struct(
            m["s"].alias("s"), m["e"].alias("e"), m["token"].alias("token"),
            (evidence(m["token"]) * F.lit(TYPICAL_LENGTH) / F.greatest(F.lit(1.0), F.char_length(m["token"]).cast("double"))).alias("p"),
            (~m["token"].rlike("[0-9]")).alias("wordy"),
        ),
    )


def p_bin(p: Column) -> Column:
    return F.least(F.lit(BINS), F.greatest(F.lit(0), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS_PER_DECADE))).cast("int")


def dismissal_bins(docs: DataFrame, rate: float = RATE) -> tuple[int, int]:
    """The lowest bins whose tokens with digits and without are dismissed as structured; BINS + 1 where none is.

    Step-up rule over the bins: of m tokens, k have a p-value up to the bin's largest one; the
    bin and all below it in p are dismissed where that value is at most rate * k / m.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    tokens = docs.select(tested(body).alias("t")).select(F.explode("t").alias("t"))
    rows = tokens.groupBy(F.col("t.wordy").alias("wordy"), p_bin(F.col("t.p")).alias("b")).count().collect()
    return tuple(lowest_bin({r["b"]: r["count"] for r in rows if r["wordy"] == wordy}, rate) for wordy in (False, True))


def lowest_bin(counts: dict[int, int], rate: float) -> int:
    total, below, found = sum(counts.values()), 0, BINS + 1
    for b in range(BINS, -1, -1):
        below += counts.get(b, 0)
        if total and 10 ** (-b / BINS_PER_DECADE) <= rate * below / total:
            found = b
    return found


def spans_text(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, then end, comma-joined."""
    ordered = F.array_sort(spans)
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def as_spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), m["e"].alias("e")))


def find(docs: DataFrame, keep: Sequence[str] = ("doc_id",), rate: float = RATE) -> DataFrame:
    """Secrets of each row: arrays of (s, k, e) in ``base`` and ``random``, counts by base kind.

    A null text counts as empty and has none. Base spans of different kinds may overlap; a random
    token that overlaps a base span is left out. Repeated rows are scanned alike.
    """
    dismissed, dismissed_wordy = dismissal_bins(docs, rate)
    body = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("__body"))
    text = F.col("__body")
    found = body.select(
        *keep,
        as_spans(located(text, ASSIGN, group=2, least=6), "assign").alias("assign"),
        as_spans(located(text, ACCESS, least=20), "access").alias("access"),
        as_spans(located(text, HEX), "hex").alias("hex"),
        F.filter(tested(text), lambda m: p_bin(m["p"]) < F.when(m["wordy"], dismissed_wordy).otherwise(dismissed)).alias("__tokens"),
    ).withColumn("base", F.concat("assign", "access", "hex"))
    clear = F.filter(
        as_spans(F.col("__tokens"), "random"), lambda m: ~F.exists("base", lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"]))
    )
    return found.withColumn("random", clear).select(
        *keep, "base", "random", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex", "random")]
    )
