"""The registered queries: SQL parity where there is SQL, and the pipeline against its definition."""

import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from telvault.llm import simhash, toxicity
from telvault.llm.oracle import SQL
from telvault.llm.queries import QUERIES
from tools.check_oracle import TABLES, norm, type_mismatches

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_are_registered():
    names = E.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names
    assert set(SQL) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rel = duck.sql(SQL[name])
    assert type_mismatches(df.schema, rel.columns, rel.types) == [] and sorted(df.columns) == sorted(rel.columns)
    columns = sorted(df.columns)
    want = Counter(tuple(norm(x) for x in r) for r in duck.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall())
    assert Counter(tuple(norm(x) for x in r) for r in df.select(columns).collect()) == want


def test_pipeline_against_its_definition(spark, duck):
    """Every stage brute-force, but for the toxicity weights, which come from the same fit."""
    from tests.llm.test_bpe import want as tokens
    from tests.llm.test_simhash import components
    import pandas as pd
    import tiktoken
    import public_tokenizers
    from telvault.llm import bpe

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r[0] for r in duck.sql(f"SELECT doc_id FROM ({SQL['op6_quality_rules']}) WHERE kept").fetchall()}
    docs = documents.where(documents.doc_id.isin(list(kept)))
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    rows = [r for r, s in zip(rows, model.scores([t for _, t in rows])) if s < 0.7]
    label = components([simhash.fingerprint(t) for _, t in rows])
    rows = [rows[k] for k in np.unique(label)]
    left = pd.DataFrame(rows, columns=["doc_id", "text"])
    duck.register("left_documents", left)
    sql = SQL["op9_decontamination"].replace("FROM documents", "FROM left_documents")
    bad = {r[0] for r in duck.sql(f"SELECT doc_id FROM ({sql}) WHERE contaminated").fetchall()}
    rows = [r for r in rows if r[0] not in bad]
    codec = bpe.Codec(bpe.load_ranks(public_tokenizers.path(bpe.RANKS)))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.bpe.ranks, special_tokens={})
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in rows} and bad
    texts = dict(rows)
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == tokens(theirs, texts[r["doc_id"]]) and len(r["ids"]) == r["n_tokens"] for r in got)


def test_stages_take_messy_and_empty_documents(spark, messy, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, messy, SF).columns == messy.columns, name
        assert stage(spark, empty, SF).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0


def test_pipeline_runs_over_messy_documents(spark, messy, tmp_path):
    import hashlib
    kept = messy.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("text", F.concat_ws("\n", "text", F.lit(PLAIN), F.col("doc_id")))
    both = messy.unionByName(kept)
    both.write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    digests = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in both.collect()}
    assert got and all((r["doc_id"], r["decoded_sha256"]) in digests and len(r["ids"]) == r["n_tokens"] for r in got)


# more words than the least, none of them repeated
PLAIN = " ".join(f"{a}{b}" for a in ("ber", "lam", "tor", "vin", "sel", "quo", "dra", "fen") for b in ("ist", "um", "ale", "ora", "ende", "ing", "eau"))
