"""What the class model costs: texts are read to be sized and coded, and words move in lists."""

from pyspark.sql import functions as F

from faremill.llm import class_model

ODD = [None, "", " \t\n", " A\x0bb\x0cc ", "x\x1cy x\x85y", "no\x00thing É é", "w " * 300]


def test_texts_are_read_twice_at_most(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(i, f"all some{i % 3} one{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(seen, "doc_id long, text string")
    assert class_model.score_documents(docs).count() == 200
    assert read.value <= 2 * 200


def test_blocks_and_buckets_change_no_score(spark, monkeypatch):
    rows = [(i % 90, f"All some{i % 7} some{i % 5} one{i} end{i % 2}") for i in range(120)]
    rows += [(200 + i, t) for i, t in enumerate(ODD * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id")
    # Bytes that are no UTF-8.
    odd = spark.createDataFrame([(300, bytearray(b"\xff\xfeAb all")), (301, bytearray(b"\xe9 \xe9 all"))], "doc_id long, b binary")
    docs = docs.unionByName(odd.select("doc_id", F.col("b").cast("string").alias("text")))
    whole = sorted(map(tuple, class_model.score_documents(docs).collect()))
    assert len(whole) == len(rows) + 2
    monkeypatch.setattr(class_model, "BLOCK_BYTES", 400)
    monkeypatch.setattr(class_model, "BUCKET_BYTES", 500)
    assert sorted(map(tuple, class_model.score_documents(docs).collect())) == whole


def test_a_block_has_one_row_for_a_bucket_and_each_of_its_words_once(spark, monkeypatch):
    monkeypatch.setattr(class_model, "BLOCK_BYTES", 1_000)
    monkeypatch.setattr(class_model, "BUCKET_BYTES", 2_000)
    texts = spark.createDataFrame([(i, f"all some{i % 7} Some{i % 5} one{i}", i % 4 == 0) for i in range(300)], "doc_id long, text string, held_out boolean")
    corpus = class_model._coded(texts)
    lists, coded = corpus.words.collect(), corpus.texts.collect()
    assert corpus.buckets > 2 and len({r.block for r in coded}) > 8
    assert len({(r.block, r.bucket) for r in lists}) == len(lists)
    words = {}
    for r in sorted(lists, key=lambda r: r.first):
        found = words.setdefault(r.block, [])
        assert r.first == len(found)
        found += bytes(r.words).decode().split(" ")
    assert all(len(set(w)) == len(w) for w in words.values())
    known = {r.doc_id: r.text.lower().split() for r in texts.collect()}
    at = lambda ids: [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)]
    assert {r.doc_id: [words[r.block][i] for i in at(bytes(r.ids))] for r in coded} == known
