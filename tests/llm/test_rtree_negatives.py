import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.llm import rtree_negatives

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows):
    """Every score of every anchor, sorted."""
    rows = {(i, (lab + 1) % 10 if i % 7 == 0 else lab, tuple(v)) for i, v, lab in rows if None not in (i, lab, v) and np.isfinite([np.nan if c is None else c for c in v]).all()}
    width = max((len(v) for *_, v in rows), default=0)
    rows = sorted((i, lab, np.floor(256 * np.array([*v] + [0.0] * (width - len(v))))) for i, lab, v in rows)
    found = set()
    for i, lab, v in rows:
        if i % 50 == 0:
            scored = sorted((-int(v @ w), j, m) for j, m, w in rows)
            for less, p, _ in [x for x in scored if x[2] == lab and x[1] != i][:5]:
                good = [x for x in scored if x[2] != lab and 50 * -less <= 100 * -x[0] <= 95 * -less][:3]
                found |= {(i, p, k + 1, j, -less, -n) for k, (n, j, _) in enumerate(good)}
    return found


def mined(rows):
    found = [tuple(r) for r in rtree_negatives.hard_negatives(rows).collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_given_table_against_all_scores(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    assert mined(rows) == plain([(r.vec_id, r.embedding, r.label) for r in rows.collect()])


@pytest.mark.parametrize("tile, leaf", [(4096, 64), (37, 5)])
def test_clusters_ties_and_copies(spark, monkeypatch, tile, leaf):
    monkeypatch.setattr(rtree_negatives, "TILE", tile)
    monkeypatch.setattr(rtree_negatives, "LEAF", leaf)
    rng = random.Random(tile)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    rows = []
    for i in range(600):
        c = centres[0] if i % 3 == 0 else rng.choice(centres)
        v = c if i % 3 == 0 or rng.random() < 0.3 else [x + rng.gauss(0, 0.1) for x in c]
        rows.append((i, v, rng.randrange(10) if i % 2 else 3))
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_blocks_of_queries_change_nothing(spark, monkeypatch):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    whole = mined(rows)
    monkeypatch.setattr(rtree_negatives, "BLOCK_BYTES", 600)
    assert mined(rows) == whole


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.random() for _ in range(4)], i % 3) for i in range(120)]
    rows += [(50, [0.5, 0.25], 1), (100, [], 2), (51, None, 1), (None, [1.0] * 4, 1), (52, [1.0, None, 1.0, 1.0], 1)]
    rows += [(53, [1.0, float("nan"), 1.0, 1.0], 1), (54, [1.0, float("-inf"), 1.0, 1.0], 1), (55, [1.0] * 4, None), (56, [-9.5] * 4, -4)]
    rows += rows[:30]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "key", "vec", "slab", "second", "nr", "rank")})
    assert mined(table) == plain(rows)
    assert mined(table.where("false")) == set()
    assert mined(table.where("vec_id = 1")) == set()
    with pytest.raises(Exception, match="too large"):
        mined(spark.createDataFrame([(0, [1e9], 1)], SCHEMA))


def test_scores_beyond_floating_point_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-60_000, 60_000) for _ in range(40)], i % 4) for i in range(160)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == {
        r for r in plain_integers(rows)
    }


def plain_integers(rows):
    scaled = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [int(c) for c in np.floor(256 * np.array(v))]) for i, v, lab in rows]
    found = set()
    for i, lab, v in scaled:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, m) for j, m, w in scaled)
            for less, p, _ in [x for x in scored if x[2] == lab and x[1] != i][:5]:
                good = [x for x in scored if x[2] != lab and 50 * -less <= 100 * -x[0] <= 95 * -less][:3]
                found |= {(i, p, k + 1, j, -less, -n) for k, (n, j, _) in enumerate(good)}
    return found


def test_pruned_boxes_are_not_scored():
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(c, 1, (64, 4)) for c in ([0] * 4, [500, 0, 0, 0], [0, 500, 0, 0], [0, 0, 500, 0])]).round()
    tree = rtree_negatives.Tree(np.arange(256, dtype="<i8").tobytes(), np.zeros(256, "<i4").tobytes(), values.astype("<i4").tobytes(), np.float64)
    query = np.array([[1.0, 0, 0, 0]])
    seen = []
    tree.search(query, np.ones((1, 4), bool), lambda at, upper, lower: (upper >= 400) & (True if lower is None else lower <= 600), lambda at, leaf: seen.append(leaf))
    assert seen == [1]
