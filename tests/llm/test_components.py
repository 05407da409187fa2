import random

import pytest

from faremill.llm import components as module
from faremill.llm.components import components


def plain(links):
    part = {x: x for pair in links for x in pair}
    for a, b in links:
        low, high = sorted((part[a], part[b]))
        part = {k: low if v == high else v for k, v in part.items()}
    return part


def found(spark, links):
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(rows) == len({r.id for r in rows})
    return {r.id: r.label for r in rows}


def test_random_graphs(spark):
    rng = random.Random(2)
    for size in (5, 60):
        links = [(rng.randrange(size), rng.randrange(size)) for _ in range(size)]
        assert found(spark, links) == plain(links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("order", ["rising", "middle", "shuffled"])
def test_a_long_chain_takes_few_rounds(spark, monkeypatch, order):
    """Also with the smallest ids in the middle of its halves, where following neighbours alone takes a quarter of its length."""
    size = 2_048
    ids = list(range(size))
    if order == "middle":
        half = sorted(range(size // 2), key=lambda i: abs(i - size // 4))
        rank = {place: n for n, place in enumerate(half)}
        ids = [2 * rank[i % (size // 2)] + i // (size // 2) for i in range(size)]
    elif order == "shuffled":
        random.Random(1).shuffle(ids)
    stores = []
    monkeypatch.setattr(module, "stored", lambda df, name, keep=module.stored: stores.append(name) or keep(df, name))
    assert set(found(spark, list(zip(ids, ids[1:]))).values()) == {0}
    assert stores.count("labels") < 12 and len(stores) < 60
