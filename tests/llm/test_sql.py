"""Queries against their own SQL on texts with nulls, ties, repeated rows and split characters."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from locusweave.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    text = lambda n: " ".join("".join(rng.choices("abcdefgü", k=rng.randrange(1, 6))) for _ in range(n))
    base, passage = text(200), text(120)
    phrases = ["licensed under cc by nc 4 0", "MIT License", "by nc licensed under cc by 4 0", "GNU lesser old general public license", "under cc licensed under by nc cc by 4 0 nc 4"]
    texts = [None, "", " ", "two words", "Two  words", "x" * 400, "y" * 1000, "\u00fc" + "b" * 399, "\u0100\u017c" + "b" * 399, base, base, base + " end", base[:600] + base[300:]]
    texts += [text(rng.randrange(30)) + " " + rng.choice(phrases) + " " + rng.choice(phrases) + passage[rng.randrange(40) : 380 + rng.randrange(200)] for _ in range(40)]
    found = [*enumerate(texts), (3, "two words"), (700, base), (700, base), (None, passage)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(found, "doc_id long, text string").withColumn("lang", F.lit("en")).write.parquet(str(path / "documents.parquet"))
    return path


@pytest.mark.parametrize("name", ["op1_license_scan", "op4_jaccard_join", "op5_suffix_dedup"])
def test_sql_agrees(spark, folder, name):
    got = queries.QUERIES[name](spark, str(folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[name]}) q").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())
