"""The pipeline's stages on small documents, and the registered queries with SQL."""

import corpus_pipeline as pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import queries as registered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}ord" for i in range(3000)]
    good = [" ".join(rng.choice(vocabulary, 150)) + "." for _ in range(60)]
    bad = [" ".join(w + "***" for w in rng.choice(vocabulary, 150)) for _ in range(60)]
    near = [g.split() for g in good[:5]]
    for k, words in enumerate(near):
        words[20 + k] = "altered"
    rows = [(i, t) for i, t in enumerate(good + bad)]
    rows += [(500 + k, "  ".join(good[k].split(" "))) for k in range(4)] + [(600 + k, " ".join(near[k])) for k in range(5)]
    rows += [(700, good[10] + " password=hunter2hunter2"), (0, good[0]), (None, " ".join(rng.choice(vocabulary, 150)))]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1 if i < 60 else 0, 0) for i in range(120)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    ids = []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, corpus)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert out.columns == docs.columns
        ids.append(sorted((r.doc_id for r in out.select("doc_id").collect()), key=str))
        docs = out
    good = set(range(60))
    assert good <= set(ids[0]) and not set(range(60, 120)) & set(ids[0])
    assert ids[1] == sorted([*good, *range(600, 605), 700, None], key=str)
    assert ids[2] == sorted([*good - {700}, None], key=str)
    assert ids[3] == ids[2]
    assert set(ids[4]) == set(ids[3])


def test_secret_stage_redacts(spark, corpus):
    docs = spark.createDataFrame([(1, "a password=hunter2hunter2 b", "en", "s", 27), (2, None, None, None, None), (3, "clean", "en", "s", 5)], SCHEMA)
    out = {r.doc_id: (r.text, r.n_chars) for r in pipeline.secrets(spark, docs, corpus).collect()}
    assert out == {1: ("a [SECRET] b", 12), 2: (None, None), 3: ("clean", 5)}


def test_empty_documents(spark, corpus):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, corpus).count() == 0


def test_clashing_columns_and_no_n_chars(spark, corpus):
    schema = "doc_id long, text string, quality_score string, row_id string, _row_id string, row_text string, row_spans string, digest int, key string, rep int, fp int, id int, size int, kind int"
    texts = [(1, "plain words of a text with password=hunter2hunter2 in it"), (1, "plain words of a text with password=hunter2hunter2 in it"), (2, None), (None, "other words"), (3, ""), (4, "x" * 300_000)]
    docs = spark.createDataFrame([(i, t, "q", "a", "b", "c", "d", 1, "k", 2, 3, 4, 5, 6) for i, t in texts], schema)
    for name, stage in pipeline.STAGES[:4]:
        out = stage(spark, docs, corpus)
        assert out.columns == docs.columns
        rows = out.collect()
        assert all(r[2:] == ("q", "a", "b", "c", "d", 1, "k", 2, 3, 4, 5, 6) for r in rows), name
    assert sorted(r.text for r in rows if r.doc_id == 1) == ["plain words of a text with [SECRET] in it"] * 2
    assert pipeline.packing(spark, docs, corpus).count() > len(texts)


def test_near_stage_keeps_what_brute_force_keeps(spark, corpus):
    """Pairs of similarity 0.80 to 0.95, and just below: recall and precision of the stage's decisions."""
    rng = np.random.default_rng(21)
    vocabulary, rows = [f"w{i}" for i in range(6000)], []
    for k in range(90):
        words = list(rng.choice(vocabulary, int(rng.integers(60, 400))))
        copy = words.copy()
        for p in np.linspace(2, len(words) - 8, max(1, int(len(words) * rng.uniform(0.005, 0.035)))).astype(int):
            copy[p] = f"new{k}x{p}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    sets = [set(zip(*[t.split()[i:] for i in range(5)], strict=False)) for _, t in rows]
    linked = np.array([[len(a & b) >= 0.8 * len(a | b) - 1e-9 for b in sets] for a in sets])
    similarity = [len(sets[2 * k] & sets[2 * k + 1]) / len(sets[2 * k] | sets[2 * k + 1]) for k in range(90)]
    assert sum(0.8 <= x < 0.85 for x in similarity) > 8 and sum(0.72 < x < 0.8 for x in similarity) > 4
    label = np.arange(len(rows))
    for _ in range(len(rows)):
        label = np.array([label[linked[i]].min() for i in range(len(rows))])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in pipeline.near(spark, docs, corpus).select("doc_id").collect()) == sorted(set(label.tolist()))


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    df = registered.queries()[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert mine == sorted(con.sql(f"select {', '.join(columns)} from ({registered.oracle_sql()[name]})").fetchall(), key=repr)


def test_queries_run(spark):
    for name, query in registered.queries().items():
        assert query(spark, SF).agg(F.count("*")).first()[0] > 0, name
