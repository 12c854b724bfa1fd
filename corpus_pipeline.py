"""A corpus pipeline: quality classifier, exact dedup, near-dedup, secret scan, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm.cuckoo import exact_duplicates
from tickframe.llm.packing import pack
from tickframe.llm.quality import score, train
from tickframe.llm.secret_scan import redact, scan
from tickframe.llm.simhash import near_duplicates
from tickframe.ship import ship

#: Below this score the classifier rejects a document.
LEAST_QUALITY = 0.7
#: Near copies: a similarity of 0.8 or more of the whole sets of shingles of five words, exactly.
#: Fingerprints within RADIUS bits, found by TREES trees, group most copies first; all other pairs come by
#: a prefix join (see `simhash.near_duplicates`), so neither number decides which documents are linked.
WIDTH, SIMILARITY, RADIUS, TREES = 5, 0.8, 9, 5
#: Parts in which documents come to the exact index: each costs a commit.
PARTS = 2


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of docs has."""
    have = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in have:
            name = f"_{name}"
        out.append(name)
    return out


def _key(doc_id: Column, text_hash: Column) -> list[Column]:
    """Rows are named by id and whole text, so that rows of one id (or of none) with different texts
    stay apart."""
    return [F.coalesce(doc_id.cast("string"), F.lit("")), text_hash]


def _keyed(docs: DataFrame, names: list[str]) -> DataFrame:
    own = _key(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))))
    return docs.withColumns(dict(zip(names, own, strict=True)))


def _named(decisions: DataFrame, names: list[str], **more: Column) -> DataFrame:
    own = _key(F.col("doc_id"), F.col("text_hash"))
    return decisions.select(*[c.alias(n) for n, c in zip(names, own, strict=True)], *[c.alias(n) for n, c in more.items()])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below LEAST_QUALITY go. It is fitted on labelled rows of the
    labels table whose documents are here.

    Null and empty texts are scored as empty ones; long texts are scored whole; repeated rows are kept or
    go together; null ids are no training rows; with no labels every score is one half, so all go; no
    documents give none; any further columns come back as they were."""
    ship(spark)
    columns, (name,) = docs.columns, _free(docs, "quality_score")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, out=name).where(F.col(name) >= LEAST_QUALITY).select(*columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the document of the smallest id stays.

    Null and empty texts are equal; texts are compared whole; of repeated rows one stays; a null id stays
    only where the whole group has none (one row of each text then); no documents give none; any further
    columns come back as they were (those of one of the repeated rows)."""
    ship(spark)
    names = _free(docs, "row_id", "row_text")
    kept = _named(exact_duplicates(docs, batches=PARTS).where("kept"), names).distinct()
    return _keyed(docs, names).join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (linked, by way of others too) the document of the smallest id stays.

    Null, empty and blank texts have no shingles and are copies of each other, a text of under five words
    is one shingle, long texts are compared whole; repeated rows stay or go together; a null id stays only
    where the whole group has none; no documents give none; any further columns come back as they were."""
    ship(spark)
    names = _free(docs, "row_id", "row_text")
    found = near_duplicates(docs, width=WIDTH, radius=RADIUS, trees=TREES, similarity=SIMILARITY)
    kept = _named(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))), names).distinct()
    return _keyed(docs, names).join(kept, names, "left_semi").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text by a mark; every document stays, as often as it was there.

    Null and empty texts stay as they are; long texts are scanned whole; null ids make no difference; no
    documents give none. n_chars, where there is such a column, is the new text's length where the text
    changed; any further columns come back as they were."""
    ship(spark)
    *names, spans = _free(docs, "row_id", "row_text", "row_spans")
    found = _named(scan(docs).where(F.size("spans") > 0), names, **{spans: F.col("spans")}).dropDuplicates(names)
    out = _keyed(docs, names).join(found, names, "left")
    text = F.when(F.col(spans).isNotNull(), redact(F.col("text"), F.col(spans))).otherwise(F.col("text"))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(spans).isNotNull(), chars).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in sequences, a row for each piece.

    A null or empty text is a piece of one id; long texts are cut into pieces; repeated rows are packed as
    often as they are there; null ids stay null; no documents give none; further columns aren't looked at."""
    import public_tokenizers

    ship(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("SimHash near-dedup", near), ("secret scans", secrets), ("best-fit packing", packing)]

#: SQL can't express the classifier, the fingerprints' retrieval or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents table; each stage says what becomes of nulls,
    long and repeated texts, empty tables and further columns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
