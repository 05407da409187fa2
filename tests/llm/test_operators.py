import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from faremill.llm import (
    byte_cnn,
    class_model,
    fm_decontaminate,
    host_rules,
    near_duplicates,
    page_text,
    pii_boost,
    queries,
    secret_scan,
    sentence_spans,
)

FOLDER = "/root/testdata/sf0.001"
#: Names that the operators use inside.
CLASHING = ("id", "n", "key", "keys", "part", "a", "b", "host", "label", "found", "spans", "digest", "ids", "kept")


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


OPERATORS = {
    "pieces": lambda d, s: queries.piece_digests(d),
    "class_model": lambda d, s: class_model.score_documents(d),
    "secrets": lambda d, s: secret_scan.find_secrets(d),
    "decontamination": lambda d, s: fm_decontaminate.contamination_report(d, table(s, "benchmark")),
    "host_rules": lambda d, s: host_rules.judge_documents(d),
    "sentence_spans": lambda d, s: sentence_spans.remove_repeated(d),
    "byte_cnn": lambda d, s: byte_cnn.score_quality(d, table(s, "labels")),
    "personal_data": lambda d, s: pii_boost.find_personal_data(d),
    "near_duplicates": lambda d, s: near_duplicates.near_duplicates(d),
}


def documents(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_have_a_result(spark, name):
    docs = table(spark, "documents")
    some = docs.orderBy("doc_id").limit(40)
    odd = spark.createDataFrame(
        [(10_001, None), (10_002, ""), (10_003, " \n\t"), (10_004, "long words and more. " * 5_000), (None, None)],
        "doc_id long, text string",
    )
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema if f.name not in ("doc_id", "text")]
    rows = some.unionByName(some).unionByName(odd.select("doc_id", "text", *rest))
    rows = rows.withColumns({c: F.lit(f"x-{c}") for c in CLASHING if c not in docs.columns})
    result = OPERATORS[name](rows, spark).select("doc_id").distinct().collect()
    wanted = {r.doc_id for r in rows.select("doc_id").collect()} - {None}
    assert {r.doc_id for r in result} - {None} == wanted


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "byte_cnn"])
def test_empty_table_gives_no_rows(spark, name):
    assert OPERATORS[name](table(spark, "documents").where("false"), spark).count() == 0


def test_pieces_are_those_of_the_library(spark):
    import numpy as np
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    letters = "aeinrst   ▁é中🙂\n\t.,-'0123ABC<>/\x00\x7f"
    texts = ["", " ", "  two  spaces  ", "▁", "<s> </s>", *["".join(rng.choices(letters, k=rng.randrange(1, 300))) for _ in range(150)]]
    found = {r.doc_id: r for r in queries.piece_digests(documents(spark, *texts)).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert found[i].n_tokens == len(ids), text
        assert found[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), text
        assert found[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest(), text


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(8, 120))] for _ in range(12)]
    texts = [None, "", "three short words", "Three SHORT words"]
    for words in base:
        for changes in (0, 0, 1, 2, 3, 6):
            copy = list(words)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in texts]
    part = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                part = [min(part[i], part[j]) if p in (part[i], part[j]) else p for p in part]
    rows = near_duplicates.near_duplicates(documents(spark, *texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {
        i: (len(sets[i]), p, i == p) for i, p in enumerate(part)
    }


@pytest.mark.parametrize("name", ["op4_decontamination", "op5_host_rules"])
def test_same_rows_as_the_statement(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    found = queries.queries()[name](spark, FOLDER)
    columns = ", ".join(sorted(found.columns))
    wanted = con.execute(f"select {columns} from ({queries.oracle_sql()[name]}) order by doc_id").fetchall()
    assert [tuple(r) for r in found.selectExpr(*columns.split(", ")).orderBy("doc_id").collect()] == wanted


def test_base_spans_of_secrets_and_personal_data(spark):
    docs = documents(spark, 'x API_key = "abcd.1234" AKIA' + "Q" * 12, "mail a.b@c.org or 4111 1111 1111 1111, 10.0.0.1 +1 (555) 010-9999")
    docs = docs.withColumn("source", F.lit("a.org"))
    first, second = secret_scan.find_secrets(docs).orderBy("doc_id").collect()
    assert (first.n_assign, first.n_access, first.n_hex) == (1, 1, 0) and second.spans == ""
    assert first.base_sha256 == hashlib.sha256(b"assign:2:22,access:24:40").hexdigest()
    row = pii_boost.find_personal_data(docs).where("doc_id = 1").first()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    assert row.base_sha256 == hashlib.sha256(b"email:5:14,card:18:37,ip:39:47,phone:48:65").hexdigest()


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, None, "<p>"), (None, None, "plain")], "page_id long, url string, html string")
    rows = page_text.extract_pages(pages).collect()
    assert len(rows) == 4 and all(r.n_chars == len(r.text) for r in rows)
    assert page_text.extract_pages(pages.where("false")).count() == 0
