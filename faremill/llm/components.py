"""Connected components of links as joins and group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import stored


def _followed(hooks: DataFrame) -> DataFrame:
    """``label``, ``up``: each label's last ancestor. Every round follows twice as far."""
    while True:
        onward = hooks.select(F.col("label").alias("up"), F.col("up").alias("next"))
        longer = stored(hooks.join(onward, "up", "left").select("label", F.coalesce("next", "up").alias("up"), "next"), "hooks")
        hooks = longer.select("label", "up")
        if not longer.where("next is not null").limit(1).count():
            return hooks


def _renamed(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """``df`` with the labels of a column replaced by their ancestors."""
    rest = [c for c in df.columns if c != column]
    return df.join(hooks.withColumnRenamed("label", column), column, "left").select(*rest, F.coalesce("up", column).alias(column))


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label`` (the smallest id reachable) for every id that ``links`` (``a``, ``b``) names.

    Works on a graph of labels that shrinks: every label with a smaller neighbour hooks to its
    smallest, all follow their hooks to the end, and the links are carried over to the labels that are
    left. A label without a smaller neighbour has a larger one, which hooks away, so what is left
    falls fast whatever the order of ids along a chain: the smallest labels of all neighbourhoods, of
    which no two are linked before the carrying over. Every step's table is stored; no more than
    whether one is empty reaches the driver. The joins read stored tables on both sides, so the
    partition of a hub with very many links can be split.
    """
    both = links.select("a", "b").union(links.select("b", "a")).toDF("src", "dst").distinct()
    edges = stored(both, "links")
    labels = edges.select(F.col("src").alias("id"), F.col("src").alias("label")).distinct()
    edges = edges.where("src != dst")
    while True:
        hooks = stored(
            edges.groupBy("src").agg(F.min("dst").alias("up")).where("up < src").withColumnRenamed("src", "label"), "hooks"
        )
        if not hooks.limit(1).count():
            return stored(labels, "labels")
        hooks = _followed(hooks)
        labels = stored(_renamed(labels, "label", hooks), "labels")
        carried = _renamed(_renamed(edges, "src", hooks), "dst", hooks)
        edges = stored(carried.where("src != dst").distinct(), "links")
