"""Class model, sentence spans and byte network against plain versions, numbers and held-out rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.llm import byte_cnn, class_model, sentence_spans

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), ""]


def test_counts_and_base_of_the_class_model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, "one two"), (70_001, None), (70_002, ""), (70_003, "Ünseen NEVER")], "doc_id long, text string")
    docs = docs.unionByName(docs.where("doc_id < 9")).unionByName(odd).withColumns({"cls": F.lit("x"), "word": F.lit("y")})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    wanted = sorted(
        (str(i), held(i), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6))
        for i, t in rows
        for w in [tokens(t)]
    )
    found = class_model.score_documents(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == wanted
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(4)
    groups = rng.integers(0, 4, 60)
    matrix = rng.poisson(0.2 + 6 * (groups[:, None] == (groups[None, :] + 1) % 4)).astype(float)

    def likelihood(place):
        member = np.eye(8)[place]
        table = member.T @ matrix @ member
        return class_model._xlogx(table).sum() - class_model._xlogx(table.sum(0)).sum() - class_model._xlogx(table.sum(1)).sum()

    by_sweeps = [likelihood(class_model.exchange(matrix, 0, 8, sweeps)) for sweeps in range(6)]
    assert all(b >= a - 1e-9 for a, b in zip(by_sweeps, by_sweeps[1:])) and by_sweeps[-1] > by_sweeps[0] + 100
    # Words that behave alike end up together.
    place = class_model.exchange(matrix, 0, 8)
    assert np.mean([len(set(place[1:][groups[1:] == g])) for g in range(4)]) < 3


def test_chances_after_every_class_add_up_to_one():
    rng = np.random.default_rng(5)
    totals = {g: (int(rng.integers(1, 500)), int(rng.integers(1, 40))) for g in range(0, class_model.CLASSES, 2)}
    counts = rng.integers(0, 50, (class_model.CLASSES + 1, class_model.CLASSES + 1)).astype(float)
    steps = 10 ** class_model.log_transitions(counts, totals)
    added = class_model.ADDED
    kept = [(held + added * kinds) / (held + added * (kinds + 1)) for held, kinds in (totals.get(g, (0, 0)) for g in range(class_model.CLASSES))]
    assert np.allclose(steps[:, :-1] @ kept + steps[:, -1], 1)


def test_the_class_model_scores_held_out_texts_better_than_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = class_model.score_documents(docs).where("held_out").agg(
        (F.sum("score") / F.sum("n_tokens")).alias("score"), (F.sum("base_score") / F.sum("n_tokens")).alias("base")
    ).first()
    assert r.score > -3.7 and r.score > r.base + 0.3


def plain_removal(rows):
    """Sentences covered by a span that an earlier document, or place, has too."""
    firsts, gone = {}, {}
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    for i, text in order:
        for start, end, h in sentence_spans.spans(sentence_spans.sentences(text or "")):
            if h in firsts:
                gone.setdefault((i, text), set()).update(range(start, end + 1))
            else:
                firsts[h] = True
    return gone


def test_sentence_spans_against_one_table_of_all_spans(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rng = random.Random(6)
    said = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(999)}" for _ in range(n)).capitalize() + "."
    passage = " ".join(said(9) for _ in range(7))
    planted = [(80_000 + i, f"{said(12)} {said(8)} {passage} {said(10)}") for i in range(5)] + [(80_009, f"{passage}\n{passage}"), (None, passage), (80_010, None), (80_011, "")]
    docs = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string")).withColumns({"hash": F.lit("x"), "key": F.lit("y"), "gone": F.lit("z")})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    gone = plain_removal(rows)
    found = {(r.doc_id, r.text_in): r for r in sentence_spans.remove_repeated(docs).alias("r").join(docs.select(F.col("doc_id").alias("i"), F.col("text").alias("text_in")), F.col("r.doc_id").eqNullSafe(F.col("i"))).collect()}
    assert len(found) == len(rows)
    for (i, text), r in found.items():
        parts = sentence_spans.sentences(text or "")
        drop = sorted(gone.get((i, text), ()))
        assert r.n_sentences == len(parts)
        assert r.removed == ",".join(f"{parts[k][0]}:{parts[k][1]}" for k in drop), i
        if not drop:
            assert r.text == (text or "")
    assert passage in found[80_000, planted[0][1]].text
    assert all(passage[:40] not in found[key].text for key in planted[1:5])


def test_slopes_of_the_network_are_those_of_its_loss():
    rng = np.random.default_rng(2)
    net = byte_cnn.Network()
    for name in ("bytes", "filters", "shift", "top", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.top, net.shift = rng.normal(0, 0.5, net.top.shape), rng.normal(0, 0.1, net.shift.shape)
    texts = [bytes(rng.integers(1, 255, size).astype(np.uint8)) for size in (3, 700, 1_500)]
    labels = np.array([0.0, 1.0, 1.0])

    def loss():
        p = net.predict(texts)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    slopes = net._slopes([byte_cnn.chunks(t) for t in texts], labels)
    for name, slope in zip(("bytes", "filters", "shift", "top", "bias"), slopes, strict=True):
        value = getattr(net, name)
        at = np.argsort(-np.abs(slope).ravel())[:12]
        for i in at:
            kept, found = value.flat[i], []
            for step in (1e-5, -1e-5):
                value.flat[i] = kept + step
                found.append(loss())
            value.flat[i] = kept
            assert (found[0] - found[1]) / 2e-5 == pytest.approx(slope.flat[i], rel=0.02, abs=1e-5), (name, i)


def test_chunks_cover_every_byte():
    for size in (0, 1, byte_cnn.CHUNK, byte_cnn.CHUNK + 1, 5_000):
        text = bytes(i % 251 + 1 for i in range(size))
        rows = byte_cnn.chunks(text)
        whole = b"".join(r[: byte_cnn.STEP].tobytes() for r in rows[:-1]) + rows[-1].tobytes()
        assert whole.rstrip(b"\0") == text


def test_quality_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = byte_cnn.score_quality(docs, labels).join(labels, "doc_id").where("held_out and quality is not null").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert min(len(good), len(bad)) > 5
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.95
    # Labels of held-out rows change nothing.
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in byte_cnn.score_quality(docs, other).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, abs=1e-9) for r in rows)
