"""The sweep over the words outside the core against a plain version."""

import re

import numpy as np

from faremill.llm import class_model
from faremill.llm.class_model import ADDED, CLASSES, END_CLASS


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), ""]


def test_every_word_outside_the_core_is_placed_by_all_its_neighbours(spark, monkeypatch):
    monkeypatch.setattr(class_model, "BLOCK_BYTES", 4_000)
    rng = np.random.default_rng(6)
    names = [f"W{i}" for i in range(300)]
    texts = [" ".join(rng.choice(names, 40)) for _ in range(200)] + [None, "", "alone", "never met", "never met"]
    words = sorted({w for t in texts for w in tokens(t)} - {""})
    # No word of "alone" and "never met" has a core word beside it.
    core, cls = {f"w{i}" for i in range(20)}, {w: int(rng.integers(0, END_CLASS)) for w in words} | {"": END_CLASS}
    table, seen = np.zeros((CLASSES, CLASSES)), {w: np.zeros((2, CLASSES)) for w in words}
    for row in map(tokens, texts):
        for before, w, after in zip(["", *row], row, [*row[1:], ""]):
            table[cls[before], cls[w]] += 1
            if w:
                seen[w][0, cls[before]] += 1
                seen[w][1, cls[after]] += 1
    fit = np.log((table + ADDED) / np.outer(table.sum(1) + 1, table.sum(0) + 1))
    gain = {w: (seen[w][0] @ fit + seen[w][1] @ fit.T)[:END_CLASS] for w in words if w not in core}

    rows = [(bytearray(w.encode()), g, w in core or not w) for w, g in cls.items()]
    vocabulary = spark.createDataFrame(rows, "word binary, cls int, placed boolean")
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    found = {bytes(r.word).decode(): r.cls for r in class_model._sweep(train, vocabulary).collect()}
    assert found.keys() == gain.keys() and {"alone", "never", "met"} <= found.keys()
    assert all(gain[w][g] >= gain[w].max() - 1e-9 for w, g in found.items())


def test_a_word_after_no_core_word_leaves_class_0_in_a_scored_corpus(spark, monkeypatch):
    monkeypatch.setattr(class_model, "CORE", 8)
    swept, sweep = [], class_model._sweep
    monkeypatch.setattr(class_model, "_sweep", lambda train, words: (swept.append(out := sweep(train, words)), out)[1])
    # Rare words follow one another; only pairs of rare words tell "left" words from "right" ones.
    rare = [f"common{j} common{j + 1} left{i % 7} right{i % 5}" for i in range(70) for j in (0, 2, 4, 6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rare)], "doc_id long, text string")
    scored = class_model.score_documents(docs)
    assert scored.count() == len(rare)
    found = {bytes(r.word).decode(): r.cls for r in swept[0].collect()}
    rights = {w for w in found if w.startswith("right")}
    assert rights == {f"right{i}" for i in range(5)} and len({found[w] for w in rights}) == 1
