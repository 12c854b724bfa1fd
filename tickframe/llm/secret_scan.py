"""Secret scans in DataFrame functions only: fixed patterns, and a battery of randomness tests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.storage import materialise

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Maximal runs, so a least length in the pattern keeps the same matches as a filter behind it.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
STRETCH = 256
SPANS = "array<struct<start:int,kind:int,end:int>>"
#: Sum of squared and of cubed letter shares of Latin-script prose, and how often neighbouring
#: characters of a word or path change between lower case, upper case and digits.
TEXT_SQUARES, TEXT_CUBES, TEXT_CHANGES = 0.065, 0.0054, 0.1
#: Lag-1 serial correlation of the values of such text: its mean, its spread, and its weight beside the
#: other two scores, whose distance from random text grows with the length while this one's doesn't.
TEXT_SERIAL, SERIAL_SPREAD, SERIAL_WEIGHT = 0.3, 0.3, 0.25
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Inferred encodings, first fit wins: pattern, alphabet in order of value.
ENCODINGS = (
    ("^[0-9]+$", DIGITS),
    ("^[0-9a-f]+$", DIGITS + "abcdef"),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[a-z]+$", LOWER),
    ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[a-z0-9]+$", DIGITS + LOWER),
    ("^[A-Z0-9]+$", DIGITS + UPPER),
    ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("", UPPER + LOWER + DIGITS + "+/-_"),
)


def _let(value: Column, body) -> Column:
    """body(value) with the value made once: what a lambda names from outside is made anew at each call."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, join, zero: int = 0) -> Column:
    """Running totals of an array of int under an associative join(a, b). Stretches of STRETCH values are
    folded each by itself, since a fold copies what it has so far at every step, and moved on by the
    totals of those before."""
    none = F.expr("cast(array() as array<int>)")

    def fold(x: Column) -> Column:
        return F.aggregate(x, none, lambda acc, v: F.concat(acc, F.array(join(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(zero)), v))))

    def moved(stretches: Column) -> Column:
        starts = F.concat(F.array(F.lit(zero)), fold(F.transform(stretches, lambda x: F.element_at(x, -1))))
        return F.flatten(F.zip_with(stretches, F.slice(starts, F.lit(1), F.size(stretches)), lambda x, start: F.transform(x, lambda v: join(start, v))))

    def whole(v: Column) -> Column:
        cuts = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STRETCH).cast("int"))
        return F.when(F.size(v) > 0, _let(F.transform(cuts, lambda k: fold(F.slice(v, k * STRETCH + 1, F.lit(STRETCH)))), moved)).otherwise(none)

    return _let(values, whole)


def _located(text: Column, pattern: str, make) -> Column:
    """Array of make(start, match, group) over the leftmost non-overlapping matches; null where there is
    none. Positions come from the lengths of what lies between matches, in code points."""
    group = 2 if pattern == ASSIGN else 0

    def placed(matches: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)  # one more than matches
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda gap, m: gap + F.length(m))
        found = F.arrays_zip(_running(steps, lambda a, b: a + b).alias("end"), matches.alias("match"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("inner"))
        return make(F.transform(found, lambda m: F.struct((m["end"] - F.length(m["match"])).alias("start"), m["match"].alias("match"), m["inner"].alias("inner"))))

    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed))


def _spans(kind: str, keep=None):
    def make(found: Column) -> Column:
        kept = F.filter(found, keep) if keep else found
        return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (m["start"] + F.length(m["match"])).alias("end")))

    return make


def base_spans(text: Column) -> Column:
    """Sorted array of (start, kind, end) of the fixed patterns."""
    none = F.expr(f"cast(array() as {SPANS})")
    found = (
        _located(text, ASSIGN, _spans("assign", lambda m: F.length(m["inner"]) >= 6)),
        _located(text, ACCESS, _spans("access")),
        _located(text, HEX, _spans("hex")),
    )
    return F.array_sort(F.concat(*[F.coalesce(x, none) for x in found]))


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, to 1e-7 (a published rational approximation)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _battery(cands: DataFrame) -> DataFrame:
    """cands(token, ...) with p (evidence against ordinary text) and fit (smallest p of the tests of
    randomness). For the token's inferred alphabet of k symbols and its length n:

    chi-squared of the symbol counts against uniform (Wilson-Hilferty), Wald-Wolfowitz runs below and
    above the alphabet's middle, and lag-1 serial correlation of the symbols' values give `fit`. The
    same three quantities against their laws under prose give `p`: chi-squared (whose mean moves away
    from the uniform one in proportion to n, so power grows with length), runs of character classes
    (likewise), and the serial correlation, each a normal score, in a weighted sum. An alphabet of one
    class (digits, or lower-case letters) has no runs of classes, and the other two alone count."""
    body = F.rtrim(F.col("token"), F.lit("="))
    alphabet = F.lit(ENCODINGS[-1][1])
    for pattern, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(F.col("body").rlike(pattern), F.lit(letters)).otherwise(alphabet)
    d = cands.withColumn("body", body).withColumn("alphabet", alphabet)
    d = d.withColumn("chars", F.expr("filter(split(body, ''), c -> c <> '')"))
    d = d.withColumn("x", F.expr("transform(chars, c -> cast(locate(c, alphabet) as double))")).withColumn("n", F.size("chars").cast("double")).withColumn("k", F.length("alphabet").cast("double"))
    d = d.withColumn("squares", F.expr("aggregate(array_distinct(chars), 0d, (s, c) -> s + pow(size(filter(chars, y -> y = c)), 2))"))
    chi = F.col("k") / F.col("n") * F.col("squares") - F.col("n")
    d = d.withColumn("chi", chi).withColumn("df", F.col("k") - 1)
    spread = 2 / (9 * F.col("df"))
    d = d.withColumn("p_uniform", upper_tail((F.pow(F.greatest(F.col("chi"), F.lit(0.0)) / F.col("df"), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)))
    d = d.withColumn("high", F.expr("transform(x, v -> cast(v > k / 2 as int))")).withColumn("n1", F.expr("aggregate(high, 0, (s, v) -> s + v)").cast("double"))
    d = d.withColumn("n0", F.col("n") - F.col("n1"))
    d = d.withColumn("runs", F.expr("1d + aggregate(sequence(2, size(high)), 0, (s, i) -> s + cast(element_at(high, i) <> element_at(high, i - 1) as int))"))
    mean = 1 + 2 * F.col("n0") * F.col("n1") / F.col("n")
    var = (mean - 1) * (mean - 2) / (F.col("n") - 1)
    d = d.withColumn("p_runs", F.when(var > 0, 2 * upper_tail(F.abs((F.col("runs") - mean) / F.sqrt(F.greatest(var, F.lit(1e-9)))))).otherwise(F.lit(0.0)))
    d = d.withColumn("m", F.expr("aggregate(x, 0d, (s, v) -> s + v) / n"))
    d = d.withColumn("ss", F.expr("aggregate(x, 0d, (s, v) -> s + (v - m) * (v - m))"))
    d = d.withColumn("lag", F.expr("aggregate(sequence(2, size(x)), 0d, (s, i) -> s + (element_at(x, i) - m) * (element_at(x, i - 1) - m))"))
    r = F.try_divide(F.col("lag"), F.col("ss"))
    d = d.withColumn("p_serial", F.coalesce(2 * upper_tail(F.abs(r + 1 / F.col("n")) * F.sqrt("n")), F.lit(0.0)))
    pairs = F.col("n") * (F.col("n") - 1) / 2
    under_text = F.col("k") * (1 + TEXT_SQUARES * (F.col("n") - 1)) - F.col("n")
    text_sd = 2 * F.col("k") / F.col("n") * F.sqrt(pairs * TEXT_SQUARES * (1 - TEXT_SQUARES) + F.pow("n", F.lit(3)) * (TEXT_CUBES - TEXT_SQUARES**2))
    d = d.withColumn("kinds", F.expr("transform(chars, c -> case when c between '0' and '9' then 0 when c between 'A' and 'Z' then 1 when c between 'a' and 'z' then 2 else 3 end)"))
    d = d.withColumn("changes", F.expr("aggregate(sequence(2, size(kinds)), 0d, (s, i) -> s + cast(element_at(kinds, i) <> element_at(kinds, i - 1) as int))"))
    class_z = (F.col("changes") - TEXT_CHANGES * (F.col("n") - 1)) / F.sqrt(TEXT_CHANGES * (1 - TEXT_CHANGES) * (F.col("n") - 1))
    several = F.when(F.col("alphabet").isin(DIGITS, LOWER), F.lit(0.0)).otherwise(F.lit(1.0))
    serial_z = F.coalesce((TEXT_SERIAL - r) / SERIAL_SPREAD, F.lit(0.0))
    summed = (under_text - F.col("chi")) / text_sd + several * class_z + SERIAL_WEIGHT * serial_z
    d = d.withColumn("p", upper_tail(summed / F.sqrt(1 + several + SERIAL_WEIGHT**2)))
    return d.withColumn("fit", F.least("p_uniform", "p_runs", "p_serial"))


def _thresholds(cands: DataFrame, q: float) -> dict[int, float]:
    """Benjamini-Hochberg within each class of length (its power of two): the largest p to accept.
    p is rounded up to a grid of bins first, so only (class, bin) counts are ranked, not candidates."""
    step = 0.05
    bins = cands.groupBy("size", F.floor(-F.log(F.greatest("p", F.lit(1e-300))) / step).alias("bin")).agg(F.count("*").alias("c"))
    held: dict[int, list] = {}
    for row in bins.collect():  # at most 14,000 bins for each of the 30 powers of two
        held.setdefault(row["size"], []).append((row["bin"], row["c"]))
    out = {}
    for size, rows in held.items():
        total, rank = sum(c for _, c in rows), 0
        for b, c in sorted(rows, reverse=True):
            rank += c
            if (upper := math.exp(-b * step)) <= q * rank / total:
                out[size] = upper
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.01, fit: float = 0.001) -> DataFrame:
    """Every row of docs as (doc_id, base, spans, text_hash), arrays of (start, kind, end) by start,
    then kind, and xxhash64 of the whole text.

    base: the fixed patterns' spans. spans: these and "random" ones: runs of 20 or more characters of
    the base-64 alphabets that overlap no base span, look random (no test of the battery below `fit`)
    and unlike text (p within the false-discovery rate q among runs of their class of length). Of random
    tokens among ordinary ones about nine in ten are found from 20 characters on, but lower-case letters
    alone from 64; digits alone are hex spans from 24 on, and shorter runs of them, which prose has no
    law for, are never "random".
    Starts and ends are code points. Null texts are empty; an empty text has empty arrays; repeated
    rows come back as often as read; null ids stay null; empty tables give an empty result; other
    columns aren't looked at."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    cand = _located(F.col("t"), CANDIDATE, lambda found: found)
    d = d.select("doc_id", F.xxhash64("t").alias("text_hash"), base_spans(F.col("t")).alias("base"), cand.alias("cand"))
    free = "filter(cand, c -> not exists(base, b -> b.start < c.start + length(c.match) and c.start < b.end))"
    d = materialise(d.select("doc_id", "text_hash", "base", F.expr(f"transform({free}, c -> struct(c.start as start, c.match as token))").alias("cand")).withColumn("row", F.monotonically_increasing_id()), "spans")
    tested = _battery(d.select("row", F.inline("cand"))).select("row", "start", (F.col("start") + F.length("token")).alias("end"), F.floor(F.log2("n")).cast("int").alias("size"), "p", "fit")
    tested = materialise(tested, "tested")
    limit = F.lit(None).cast("double")
    for size, upper in _thresholds(tested, q).items():
        limit = F.when(F.col("size") == size, F.lit(upper)).otherwise(limit)
    found = tested.where((F.col("p") <= limit) & (F.col("fit") >= fit))
    random = F.struct("start", F.lit(KINDS.index("random")).alias("kind"), "end")
    found = found.groupBy("row").agg(F.collect_list(random).alias("more"))  # at most a text's own runs
    none = F.expr(f"cast(array() as {SPANS})")
    return d.join(found, "row", "left").select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"), "text_hash")


def named(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """text with every stretch of spans (overlapping or touching ones as one) replaced by mark. The text
    is taken apart into characters once, so that each piece costs its own length."""

    def pieced(x: Column) -> Column:
        def piece(s: Column, at: Column) -> Column:
            """What lies between the end reached before (null: no span yet) and the next span, and its mark."""
            own = F.concat(F.array_join(F.slice(x["chars"], F.coalesce(at, F.lit(0)) + 1, F.greatest(s["start"] - F.coalesce(at, F.lit(0)), F.lit(0))), ""), F.lit(mark))
            return F.when(at.isNull() | (s["start"] > at), own).otherwise("")

        before = F.concat(F.array(F.lit(None).cast("int")), F.slice(x["ends"], F.lit(1), F.size(x["ends"]) - 1))
        last = F.slice(x["chars"], F.element_at(x["ends"], -1) + 1, F.size(x["chars"]))
        return F.concat(F.array_join(F.zip_with(x["spans"], before, piece), ""), F.array_join(last, ""))

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    whole = F.struct(chars.alias("chars"), spans.alias("spans"), _running(F.transform(spans, lambda s: s["end"]), F.greatest).alias("ends"))
    return F.when(F.size(spans) > 0, _let(whole, pieced)).otherwise(text)
