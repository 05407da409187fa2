"""Host verdicts that single documents would not give, and benchmark blocks."""

import random

import duckdb

from faremill.llm import fm_decontaminate, host_rules, queries

FOLDER = "/root/testdata/sf0.001"


def test_a_bad_host_is_rejected_and_a_small_one_spared(spark):
    rng = random.Random(4)
    prose = lambda n: " ".join(f"w{rng.randrange(5_000)}" for _ in range(n))
    rows = [(f"h{h}-{i}", prose(5 if i == 0 else 60), f"h{h}.org") for h in range(20) for i in range(10)]
    rows += [(f"bad-{i}", prose(60 if i == 0 else 5), "bad.org") for i in range(31)]
    rows += [(f"small-{i}", prose(60 if i == 0 else 5), "small.org") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    kept = {r.doc_id for r in host_rules.judge_documents(docs).where("kept").collect()}
    # Two in three documents of the small host fail, but three say little against what all hosts say.
    assert "bad-0" not in kept and "small-0" in kept
    assert kept == {r.doc_id for r in host_rules.keep_good(docs).collect()}
    assert len(kept) == 20 * 9 + 1


def test_several_benchmark_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(fm_decontaminate, "BLOCK_CHARS", 400)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    found = queries.queries()["op4_decontamination"](spark, FOLDER)
    columns = ", ".join(sorted(found.columns))
    wanted = con.execute(f"select {columns} from ({queries.oracle_sql()['op4_decontamination']}) order by doc_id").fetchall()
    assert [tuple(r) for r in found.selectExpr(*columns.split(", ")).orderBy("doc_id").collect()] == wanted
