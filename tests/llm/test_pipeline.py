"""Queries against SQL, and the pipeline against its stages done plainly."""

from __future__ import annotations

import random
import re
from itertools import combinations

import duckdb
import pytest
from helpers import SCHEMA, WORDS, documents
from pyspark.sql import functions as F
from test_dedup import joined, normal
from test_near import shingles, similar

import corpus_pipeline
from chatloom.llm import queries as Q
from chatloom.llm.language_id import LETTERS
from chatloom.llm.mixing import mix
from chatloom.llm.shared import uniform


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query(spark, data, name):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/sf0.001/{t}.parquet'")
    found = Q.QUERIES[name](spark, f"{data}/sf0.001")
    columns = sorted(found.columns)
    expected = con.sql(f"SELECT {', '.join(columns)} FROM ({Q.SQL[name]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in found.select(columns).collect()))) == sorted(map(repr, expected))


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_query_covers_the_table(spark, data, name):
    ids = Q.QUERIES[name](spark, f"{data}/sf0.001").select("doc_id").collect()
    assert sorted(r[0] for r in ids) == sorted(r[0] for r in Q.table(spark, f"{data}/sf0.001", "documents").select("doc_id").collect())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    rows = documents(random.Random(8), 150)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], random.Random(i).randint(0, 1), 0) for i, r in enumerate(rows) if r[0] is not None and i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = Q.table(spark, folder, "documents")
    columns, rows = docs.columns, docs.collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "mixture", "pieces"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema).cache()
        kept[name] = docs.collect()
        assert docs.columns == columns and set(kept[name]) <= set(before.collect())

    words = {w for own in WORDS.values() for w in own} | {"extra"}

    def known(text):
        """Half of the words at least are of a language in the corpus."""
        found = LETTERS.findall(text or "")
        return bool(found) and sum(w in words for w in found) >= len(found) / 2

    assert sorted(map(repr, kept["language"])) == sorted(repr(r) for r in rows if known(r["text"]))
    best = {}
    for r in kept["language"]:
        rank = (-len(r["text"]), r["doc_id"] is None, r["doc_id"] or 0)
        best[normal(r["text"])] = min(best.get(normal(r["text"]), (rank, r)), (rank, r), key=lambda x: x[0])
    assert sorted(map(repr, kept["exact"])) == sorted(repr(r) for _, r in best.values())
    sets = {r: shingles(r["text"]) for r in kept["exact"]}
    near = joined([(r, r) for r in sets] + [(r, q) for r, q in combinations(sets, 2) if similar(sets[r], sets[q])])
    first = {}
    for r, c in near.items():
        rank = (r["doc_id"] is None, r["doc_id"] or 0)
        first[c] = min(first.get(c, (rank, r)), (rank, r), key=lambda x: x[0])
    assert sorted(map(repr, kept["near"])) == sorted(repr(r) for _, r in first.values())

    thin = spark.createDataFrame(kept["near"], docs.schema)
    rated = mix(thin, Q.table(spark, folder, "labels"), Q.domain(), Q.TARGETS, Q.CLEAN).filter("doc_id is not null")
    stay = {r["doc_id"] for r in rated.filter(uniform(F.col("doc_id"), "mixing-draw") < F.col("rate")).collect()}
    assert {r["doc_id"] for r in kept["mixture"] if r["doc_id"] is not None} == stay

    last = corpus_pipeline.pieces(spark, docs, folder).collect()
    assert sorted(str(r["doc_id"]) for r in last) == sorted(str(r["doc_id"]) for r in kept["mixture"]) and all(r["round_trip"] for r in last)
    assert re.fullmatch("[0-9a-f]{64}", last[0]["ids_sha256"])


def test_run(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert found.count() > 10 and "ids" in found.columns


def test_empty_pipeline(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
