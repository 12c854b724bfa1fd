"""Token counts: totals kept by signed deltas, with idempotent batch commits."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm.bpe import Encoder, RankEncoder
from tickframe.llm.storage import materialise, new_path

_CHANGES = "doc string, tokenizer string, op string, seq long, source string, lang string, tokens long"
_LEDGER = "doc string, tokenizer string, live boolean, source string, lang string, tokens long, version long"
_DELTAS = "source string, lang string, tokenizer string, docs long, tokens long"
_IDS = "batch string"
#: Commits of other writers that a commit may meet before it gives up.
ATTEMPTS = 20


@cache
def _encoder(path: str) -> Encoder | RankEncoder:
    return Encoder(path) if path.endswith(".json") else RankEncoder(path)


def token_counter(path: str) -> Callable[[Column], Column]:
    """A Column function that counts the tokens of a text under the vocabulary file at path (JSON of
    merges, or ranks)."""

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _encoder(path)
        for s in texts:
            yield pd.Series([len(own.ids(t)) for t in s], dtype="int64")

    return count


def doc_key(doc_id: Column, text: Column) -> Column:
    """The name of a document in the ledger: its id, or the SHA-256 of its text where it has none, so
    that documents without an id stay apart."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.sha2(text, 256)))


def counted(docs: DataFrame, versions: dict[str, Callable[[Column], Column]], op: str = "insert", keep: tuple[str, ...] = ()) -> DataFrame:
    """Changes for docs(doc_id, source, lang, text): a row per tokenizer version with the count of the
    whole text (null: empty), and the columns of keep. A version is any Column function, such as
    token_counter gives."""
    t = F.coalesce("text", F.lit(""))
    wide = docs.select(doc_key(F.col("doc_id"), t).alias("doc"), "source", "lang", *keep, F.lit(op).alias("op"), *[count(t).cast("long").alias(f"_n{k}") for k, count in enumerate(versions.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("tokenizer"), F.col(f"_n{k}").alias("tokens")) for k, name in enumerate(versions)])
    return wide.select("doc", "source", "lang", *keep, "op", F.inline(pairs))


class TokenRollup:
    """Totals of documents and tokens by source, language and tokenizer version.

    The log is a folder of small files, log/1, log/2, ...; file n names the folder that holds what
    version n adds: the ledger's new entries (what each touched document counts for from now on) and
    the deltas by group. A commit writes its folder first and then claims the next number, by a rename
    that fails where the number is taken; so of two writers that started from the same state one wins,
    and the other begins again from the new state, where it also sees whether its batch is there by
    now. A commit that broke off left no file in the log and so changed nothing. The claim is as atomic
    as the file system's rename without overwriting is (HDFS: fully), like that of Spark's own logs.

    compact() adds a version that stands for all before it, with the last entry of each document, one
    row of deltas for each group, and the names of all batches, so reads don't grow with the commits."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or new_path(spark, "rollup")

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _claim(self, version: int, entry: dict) -> bool:
        """Put log/version in place; False if it is there already."""
        jvm = self.spark._jvm
        fs, draft = self._fs(f"{self.path}/drafts/{uuid.uuid4().hex}")
        _, target = self._fs(f"{self.path}/log/{version}")
        fs.mkdirs(target.getParent())
        out = fs.create(draft, False)
        out.write(json.dumps(entry).encode())
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kinds, 1)
        options[0] = kinds.NONE
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
        except Exception as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def log(self) -> list[dict]:
        """The entries from the last compacted version on, in order; they stand for all."""
        fs, place = self._fs(f"{self.path}/log")
        found = sorted(int(x.getPath().getName()) for x in fs.listStatus(place) if x.getPath().getName().isdigit()) if fs.exists(place) else []
        out: list[dict] = []
        for n in reversed(found):
            out.append(self._entry(n) | {"version": n})
            if out[-1]["kind"] == "compact":
                break
        return out[::-1]

    def _entry(self, version: int) -> dict:
        fs, place = self._fs(f"{self.path}/log/{version}")
        stream = fs.open(place)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _read(self, log: list[dict], name: str, schema: str) -> DataFrame:
        found = [f"{self.path}/data/{x['folder']}/{name}" for x in log]
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def _ledger(self, log: list[dict]) -> DataFrame:
        entry = F.struct("live", "source", "lang", "tokens")
        last = self._read(log, "ledger", _LEDGER).groupBy("doc", "tokenizer").agg(F.max_by(entry, "version").alias("e"))
        return last.select("doc", "tokenizer", "e.*")

    def ledger(self) -> DataFrame:
        """The last entry of each (doc, tokenizer), those of deleted ones (not live) included."""
        return self._ledger(self.log())

    def _has(self, log: list[dict], batch_id: str) -> bool:
        if any(x["kind"] == "batch" and x["batch"] == batch_id for x in log):
            return True
        packed = [f"{self.path}/data/{x['folder']}/batches" for x in log if x["kind"] == "compact"]
        return bool(packed) and not self.spark.read.schema(_IDS).parquet(*packed).where(F.col("batch") == batch_id).isEmpty()

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply changes(doc, tokenizer, op, and where given seq, source, lang, tokens) once. False:
        the batch was committed before.

        Of several changes of one (doc, tokenizer) in a batch the one of the highest seq counts (among
        equals the greatest row). insert and revise set what a document counts for, whether or not it
        was there; delete takes back what it counts for, and nothing if it isn't there. A null source
        or language is a group of its own; a null doc is a document; null tokens count 0; an empty
        batch commits empty; other columns aren't looked at."""
        log = self.log()
        if self._has(log, batch_id):
            return False
        for name, kind in (x.split(" ") for x in _CHANGES.split(", ")):
            changes = changes.withColumn(name, (F.col(name) if name in changes.columns else F.lit(None)).cast(kind))
        row = F.struct((F.col("op") != "delete").alias("live"), "source", "lang", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
        last = changes.groupBy("doc", "tokenizer").agg(F.max(F.struct(F.coalesce("seq", F.lit(0)).alias("seq"), row.alias("new"))).alias("x")).select("doc", "tokenizer", "x.new")
        last = materialise(last, "changes")  # the texts are counted once, whatever the attempts
        for _ in range(ATTEMPTS):
            version, folder = (log[-1]["version"] if log else 0) + 1, uuid.uuid4().hex
            self._write(last, log, version, f"{self.path}/data/{folder}")
            if self._claim(version, {"kind": "batch", "batch": batch_id, "folder": folder}):
                return True
            fs, place = self._fs(f"{self.path}/data/{folder}")
            fs.delete(place, True)
            log = self.log()
            if self._has(log, batch_id):
                return False
        raise RuntimeError(f"other writers were faster {ATTEMPTS} times")

    def _write(self, last: DataFrame, log: list[dict], version: int, place: str) -> None:
        """The ledger's entries and the deltas of the changes against the state of the log."""
        old = self._ledger(log).where("live").select(F.col("doc").alias("d"), F.col("tokenizer").alias("t"), F.struct("live", "source", "lang", "tokens").alias("old"))
        joined = last.join(old, F.col("doc").eqNullSafe(F.col("d")) & F.col("tokenizer").eqNullSafe(F.col("t")), "left").select("doc", "tokenizer", "new", "old")
        joined = materialise(joined, "joined")
        joined.select("doc", "tokenizer", "new.*", F.lit(version).cast("long").alias("version")).write.parquet(f"{place}/ledger")
        sides = F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("e")), F.struct(F.lit(-1).alias("sign"), F.col("old").alias("e")))
        signed = F.filter(sides, lambda s: s["e"].isNotNull() & s["e"]["live"])
        flat = joined.select("tokenizer", F.inline(signed)).select("e.source", "e.lang", "tokenizer", F.col("sign").cast("long").alias("docs"), (F.col("sign") * F.col("e.tokens")).alias("tokens"))
        flat.groupBy("source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.parquet(f"{place}/deltas")

    def compact(self) -> bool:
        """Add a version that stands for all before it. False: another writer was faster, which does no harm."""
        log = self.log()
        if not log:
            return False
        version, folder = log[-1]["version"] + 1, uuid.uuid4().hex
        place = f"{self.path}/data/{folder}"
        self._ledger(log).withColumn("version", F.lit(version).cast("long")).write.parquet(f"{place}/ledger")
        self._sums(log).write.parquet(f"{place}/deltas")
        ids = self.spark.createDataFrame([(x["batch"],) for x in log if x["kind"] == "batch"], _IDS)
        for x in log:
            if x["kind"] == "compact":
                ids = ids.unionByName(self.spark.read.schema(_IDS).parquet(f"{self.path}/data/{x['folder']}/batches"))
        ids.write.parquet(f"{place}/batches")
        return self._claim(version, {"kind": "compact", "batch": "", "folder": folder})

    def _sums(self, log: list[dict]) -> DataFrame:
        return self._read(log, "deltas", _DELTAS).groupBy("source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) of the groups that hold a document."""
        return self._sums(self.log()).where("docs <> 0")
