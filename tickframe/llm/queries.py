"""The registered query of each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickframe.llm.hamming import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickframe.llm.bloom_lm import train_and_score

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))  # a null id is learnt from
    out, n = train_and_score(docs, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickframe.llm.secret_scan import KINDS, named, scan

    out = scan(_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as long)").alias(f"n_{name}") for k, name in enumerate(KINDS[:3])]
    return out.select("doc_id", *counts, F.sha2(named(F.col("base")), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def op4_cuckoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents go into an index in parts; the last part is taken out again and, after the index was
    reopened, put back, which leaves the answer as it was."""
    from tickframe.llm.cuckoo import BATCHES, CuckooIndex, answer, digests_of, indexed, portion

    rows = digests_of(_table(spark, sf_dir, "documents"))
    index = indexed(rows)
    last = portion(rows, BATCHES - 1, BATCHES)
    index.delete(last)
    index = CuckooIndex(spark, index.path)
    index.insert(last)
    return answer(rows, index).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


_OP4_SQL = r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents),
g as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from d group by 1)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from d join g using (text_sha256)
"""


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickframe.llm.quality import held_out, score, train

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, _table(spark, sf_dir, "labels")))
    p = F.col("quality_score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), p.alias("score"), (p >= 0.7).cast("int").alias("predicted"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tickframe.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickframe.llm.url_rules import judge

    return judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every whole text, decodes the ids, and tells whether the text came back."""
    import public_tokenizers

    from tickframe.llm.pieces import coded

    return coded(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads the counts of all documents under two tokenizer versions (and the same batch again, which
    changes nothing), revises those of texts of several lines by a token for each line break under one
    of them, retracts every copy of a text but the one of the smallest doc_id, and compacts."""
    import public_tokenizers

    from tickframe.llm.storage import materialise
    from tickframe.llm.token_rollup import TokenRollup, counted, doc_key, token_counter

    versions = {"byte-bpe-50k": token_counter(public_tokenizers.path("byte_bpe_50k.json")), "byte-bpe-multi-50k": token_counter(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))}
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"))
    breaks = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    rollup = TokenRollup(spark)
    loaded = materialise(counted(docs.withColumn("breaks", breaks), versions, keep=("breaks",)), "loaded")
    rollup.commit("load", loaded)
    rollup.commit("load", loaded)
    lines = loaded.where("breaks > 0 and tokenizer = 'byte-bpe-50k'")
    rollup.commit("revise", lines.withColumn("tokens", F.col("tokens") + F.col("breaks")).withColumn("op", F.lit("revise")))
    first = docs.select("doc_id", doc_key(F.col("doc_id"), F.col("text")).alias("doc"), F.sha2("text", 256).alias("h"))
    groups = materialise(first.groupBy("h").agg(F.min("doc_id").alias("keep")), "groups")  # a plain side, so that a hot text's rows can be split
    stays = F.coalesce(F.col("keep").cast("string"), F.concat(F.lit("text:"), F.col("h")))
    copies = first.join(groups, "h").where(F.col("doc") != stays).select("doc")
    rollup.commit("retract", copies.withColumn("tokenizer", F.explode(F.array(*map(F.lit, versions)))).withColumn("op", F.lit("delete")))
    rollup.compact()
    return rollup.totals()


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickframe.llm.simhash import near_duplicates

    out = near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickframe.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))


def op12_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tickframe.llm.retrieval import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _op13_texts(docs: DataFrame) -> DataFrame:
    """The texts that op13 reads: in one document of ten the words from one on are a repeated stretch. A
    null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    d = docs.select("doc_id", "text", F.expr("crc32(cast(doc_id as string)) div 10").alias("g"), F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words"))
    d = d.withColumn("a", F.when(F.col("n") > 0, F.try_mod("g", F.col("n").cast("long"))).cast("int"))
    d = d.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")  # eleven at most
    repeated = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("n") - F.col("a"))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), " ")
    return d.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickframe.llm.periodic import periodic_runs

    found = periodic_runs(_op13_texts(_table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    d = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return d.select(
        "doc_id", "n_runs", (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.less")).alias("period"),
        F.expr("(1000 * best.length) div -best.less").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_itq": op1_itq,
        "op2_lm": op2_lm,
        "op3_secrets": op3_secrets,
        "op4_cuckoo": op4_cuckoo,
        "op5_quality": op5_quality,
        "op6_packing": op6_packing,
        "op7_urls": op7_urls,
        "op8_pieces": op8_pieces,
        "op9_token_counts": op9_token_counts,
        "op10_simhash": op10_simhash,
        "op11_whitening": op11_whitening,
        "op12_retrieval": op12_retrieval,
        "op13_runs": op13_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_cuckoo": _OP4_SQL}
