"""Registered queries against DuckDB, and the pipeline on planted documents."""

import random

import pytest
from oracle_compare import compare, duck_connection
from pyspark.sql import functions as F

import corpus_pipeline
from incentiva.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    result = compare(queries.QUERIES[name](spark, SF), duck_connection(SF), queries.ORACLE_SQL[name])
    assert result["hash_match"] and result["schema_match"], result


@pytest.mark.parametrize("name", ["op2_html_text", "op3_sentencepiece", "op6_line_dedup", "op9_language_id"])
def test_rows_cover_the_table(spark, name):
    got = queries.QUERIES[name](spark, SF)
    key, table = ("page_id", "pages") if name == "op2_html_text" else ("doc_id", "documents")
    assert got.select(key).distinct().count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name == "op3_sentencepiece":
        assert got.where("not round_trip").count() == 0


def test_pipeline_on_planted_documents(spark, tmp_path):
    rng = random.Random(1)
    en = "the of and to in that is was for with house water light people under".split()
    de = "der die und das ist nicht ein eine mit auf haus wasser licht leute unter".split()
    text = lambda v, n: " ".join(rng.choice(v) + str(rng.choice(["", "er", "en", "ly", "ing", "s"])) for _ in range(n))
    clean = [text(en if i % 2 else de, 90) + ".\n" + text(en if i % 2 else de, 20) for i in range(40)]
    question = text(en, 25)
    passage = text(en, 60)
    docs = list(clean)
    docs += [clean[0], clean[3]]  # exact copies: 40, 41
    near = clean[5].split(" ")
    near[50] = "changed"
    docs += [" ".join(near)]  # 42
    docs += [text(en, 30) + " " + question + " " + text(en, 30)]  # 43
    docs += [f"{text(en, 30)}\n{passage}\n{text(en, 30)}" for _ in range(3)]  # 44, 45, 46
    docs += ["12 34 !!", "", None]  # 47, 48, 49
    rows = [(i, t, ["de", "en"][i % 2] if i < 40 else "en", "src", len(t or "")) for i, t in enumerate(docs)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, question)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen, now = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now.columns
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert now.columns == before
        seen[name] = {r["doc_id"]: r["text"] if "text" in r else None for r in now.collect()} if k < 4 else None
    assert set(seen["language"]) == set(range(47))
    assert set(seen["language"]) - set(seen["line-dedup"]) == {40, 41}
    assert [passage in seen["line-dedup"][i] for i in (44, 45, 46)] == [True, False, False]
    assert all(seen["line-dedup"][i] == docs[i] for i in range(40))
    assert set(seen["near-duplicates"]) == set(seen["line-dedup"]) - {42}
    assert set(seen["decontamination"]) == set(seen["near-duplicates"]) - {43}
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in final.collect()} == set(seen["decontamination"])
    assert final.where(~F.col("round_trip")).count() == 0 and final.groupBy("doc_id").count().where("count <> 2").count() == 0
