"""URL filters: host and path rules, and association rules that FP-growth mines from labelled URLs."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.storage import materialise

#: (verdict, host, start of the path): a rule fits its host and all subdomains.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first "://" up to a slash, question mark, hash or the end (A-Z lower-cased),
    and from there up to a question mark, hash or the end. Both empty without "://" or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def fixed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule, as host + start of path, and its verdict; both null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(own + start)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """A URL's tokens, each with its place: every ending of the host at a dot, every segment of the path,
    the first and the last one, their number, every key of the query, and marks of the whole. Digits of
    the path are written as #, so that numbered pages share tokens."""
    labels = F.filter(F.split(host, r"\."), lambda s: s != "")
    segments = F.filter(F.split(F.regexp_replace(path, r"[0-9]+", "#"), "/"), lambda s: s != "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, r"^[^=]*", 0)), lambda k: k != "")
    endings = F.when(F.size(labels) > 0, F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.concat(F.lit("host:"), F.concat_ws(".", F.slice(labels, -k, k)))))
    marks = F.array(
        F.concat(F.lit("scheme:"), F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([^:/?#]*)://", 1), F.lit(""))),
        F.concat(F.lit("first:"), F.get(segments, F.lit(0))),
        F.concat(F.lit("last:"), F.when(F.size(segments) > 1, F.element_at(segments, -1))),
        F.concat(F.lit("depth:"), F.size(segments).cast("string")),
        F.when(F.contains(F.coalesce(url, F.lit("")), F.lit("#")), F.lit("has:fragment")),
        F.when(F.contains(host, F.lit("-")), F.lit("host has:hyphen")),
        F.when(host.rlike("[0-9]"), F.lit("host has:digit")),
    )

    def tagged(tag: str, x: Column) -> Column:
        return F.transform(x, lambda s: F.concat(F.lit(tag), s))

    return F.array_distinct(F.filter(F.concat(F.coalesce(endings, F.expr("cast(array() as array<string>)")), tagged("segment:", segments), tagged("query:", keys), marks), lambda t: t.isNotNull()))


def telling(labelled: DataFrame, support: float) -> list[str]:
    """Of the tokens of labelled(tokens, verdict) those that reach the support; of several that the very
    same URLs have, which would only multiply the combinations, the first by name. Their number is at
    most that of a URL's tokens over the support, on average."""
    total = labelled.count()
    rows = labelled.select(F.explode("tokens").alias("token"), F.xxhash64("tokens", "verdict", "row").alias("h"))
    held = rows.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.shiftright("h", 20)).alias("s")).where(F.col("n") >= support * total)
    return sorted(r["token"] for r in held.groupBy("n", "x", "s").agg(F.min("token").alias("token")).collect())


def mine(labelled: DataFrame, support: float = 0.01, confidence: float = 0.8) -> DataFrame:
    """labelled(row, tokens, verdict) -> (rare, antecedent, verdict, confidence, support): the rules that
    end in a verdict, with at least this share of all labelled URLs and this confidence, over the tokens
    that tell URLs apart (see `telling`). rare is the antecedent's least frequent token, under which the
    inverted index files the rule. A rule is pruned if a rule of one token less gives the same verdict
    with the same confidence or more."""
    tokens = F.array_intersect("tokens", F.lit(telling(labelled, support)).cast("array<string>"))
    sets = labelled.select(F.concat(tokens, F.array(F.concat(F.lit("="), F.col("verdict")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(sets)
    rules = model.associationRules.select("antecedent", F.element_at("consequent", 1).alias("to"), "confidence", "support").where(F.col("to").startswith("="))
    rules = materialise(rules.withColumn("antecedent", F.array_sort("antecedent")).withColumn("verdict", F.substring("to", 2, 99)).drop("to"), "rules")
    parts = rules.select(
        "verdict", "confidence", "antecedent", F.explode(F.transform("antecedent", lambda t: F.array_remove(F.col("antecedent"), t))).alias("part")
    )
    stronger = rules.select(F.col("antecedent").alias("part"), "verdict", F.col("confidence").alias("c"))
    weak = parts.join(stronger, ["part", "verdict"]).where("c >= confidence").select("antecedent", "verdict").distinct()
    rules = rules.join(weak, ["antecedent", "verdict"], "left_anti")
    often = materialise(model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("token"), "freq"), "tokens")
    ranked = rules.withColumn("token", F.explode("antecedent")).join(often, "token")
    return ranked.groupBy("antecedent", "verdict", "confidence", "support").agg(F.min_by("token", F.struct("freq", "token")).alias("rare"))


def judge(pages: DataFrame, rules=RULES, support: float = 0.01, confidence: float = 0.8, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """Every row of pages as (page_id, host, path, rule, verdict, by).

    The fixed rules decide first. Their verdicts are the labels from which association rules are
    mined; these judge the other URLs: of all mined rules whose tokens a URL has, the one of the
    highest confidence, then support, then most tokens, then the first by name. `by` says what decided
    (fixed, mined or default: no rule at all gives `otherwise`).

    A URL that is null or has no "://" has an empty host and path; repeated rows come back as often as
    read; null ids stay null; with no labelled URL nothing is mined; an empty table gives an empty
    result; other columns aren't looked at."""
    url = F.col("url")
    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
    host, path = host_and_path(url)
    d = d.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    d = d.withColumn("rule", name).withColumn("fixed", verdict).withColumn("tokens", url_tokens(url, F.col("host"), F.col("path")))
    d = materialise(d.drop("url").withColumn("row", F.monotonically_increasing_id()), "urls")
    labelled = d.where("fixed is not null").select("row", "tokens", F.col("fixed").alias("verdict"))
    if labelled.isEmpty():
        return d.select("page_id", "host", "path", "rule", F.lit(otherwise).alias("verdict"), F.lit("default").alias("by"))
    index = materialise(mine(labelled, support, confidence), "index")
    # the inverted index is small by its support; where Spark doesn't broadcast it, hot tokens are split as skew
    open_urls = d.where("fixed is null").select("row", "tokens", F.explode("tokens").alias("rare"))
    fired = open_urls.join(index, "rare").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.size("antecedent").alias("n"), F.col("antecedent").alias("a"), F.col("verdict").alias("mined"))).alias("b")
    mined = fired.groupBy("row").agg(best).select("row", "b.mined")
    out = d.join(mined, "row", "left")
    by = F.when(F.col("fixed").isNotNull(), F.lit("fixed")).when(F.col("mined").isNotNull(), F.lit("mined")).otherwise(F.lit("default"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("fixed", "mined", F.lit(otherwise)).alias("verdict"), by.alias("by"))
