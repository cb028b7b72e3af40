"""The pipeline against the stages' brute-force versions, registered queries against SQL, and their plans."""

import os
import sys
from collections import Counter

import brute
import duckdb
import public_tokenizers
import pytest
from corpus_fixture import DDL, make_corpus
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from forgeline.llm import catalog, oracle, quality_rules, substring_dedup  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_pipeline(spark, tmp_path):
    rows = [r for r in make_corpus(seed=8, n=60) if r[0] not in (912, 913)]  # brute force has one row for a doc_id
    spark.createDataFrame(rows, DDL).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = [(r[0], r[1], r[2]) for r in rows]
    kept = brute.quality_kept([(t, g) for _, t, g in docs], quality_rules.COMMON, quality_rules.Rules())
    docs = [(d, t) for (d, t, _), k in zip(docs, kept) if k]
    assert 20 < len(docs) < len(rows)
    docs = [(d, t if not gone else text) for (d, t), (text, _, gone) in zip(docs, brute.drop_lines(docs)) if not gone or brute.words(text)]
    docs = [(d, t) for (d, t), (_, c) in zip(docs, brute.join_components(docs)) if d == c]
    docs = [(d, " ".join(w) if gone else dict(docs)[d]) for d, w, n, gone in brute.remove_repeats(docs) if not gone or gone < n]
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert brute.check_packing(pieces, docs, lambda t: tokenizer.encode(t, add_special_tokens=False).ids) == 0


def test_stages_return_documents(spark):
    docs = catalog.table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).schema.names == docs.schema.names


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    query = entry.queries()[name](spark, SMALL)
    want, got = con.sql(entry.oracle_sql()[name]), query.collect()
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {c: kinds[t] for c, t in query.dtypes} == dict(zip(want.columns, map(str, want.types)))
    assert Counter(map(tuple, got)) == Counter(want.project(", ".join(query.columns)).fetchall())


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_texts_are_shuffled_once(spark):
    """All three passes over the blocks share one exchange of the texts."""
    df = substring_dedup.remove_repeats(catalog.table(spark, SMALL, "documents"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final
    assert "NestedLoop" not in final and "Cartesian" not in final
