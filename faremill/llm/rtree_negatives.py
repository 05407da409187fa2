"""Hard negatives by best-first search in STR-packed R-trees.

Vectors are sorted by label, then into slabs by the coordinate that varies most, then by the next
such coordinate (sort-tile-recursive), and cut into tiles; each tile is a row that holds a packed
tree: its leaves are runs of vectors after one more sort, every leaf and the tile have a minimum
bounding box. For a query a box gives an interval per coordinate and, added up, bounds on every
inner product inside. Each query has a queue of leaves, best bound first; boxes whose bounds lie
outside the score window or strictly below the k-th score so far are pruned. Queries that take the
same leaf from their queues are scored together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import stored

ANCHOR_EVERY, SHIFTED_EVERY, LABELS = 50, 7, 10
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score as percent of the positive's, both ends included.
LOW, HIGH = 50, 95
#: Vectors in a tile and in a leaf.
TILE, LEAF = 4096, 64
#: Rows that the choice of coordinates is fitted on. It decides on speed only: every row is indexed.
SAMPLE = 10_000
#: Bytes of the queries that are broadcast at once.
BLOCK_BYTES = 32 << 20
#: Largest scaled component.
LARGEST = 1 << 24


def scaled_rows(rows: DataFrame) -> DataFrame:
    """``id``, ``label``, ``vec`` (scaled, whole) of the rows that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(c))
    shifted = F.when(F.col("vec_id") % SHIFTED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))

    def whole(c: F.Column) -> F.Column:
        big = F.abs(c.cast("double")) * SCALE > LARGEST - 1
        return F.when(big, F.raise_error(F.lit("a component is too large for exact scores")).cast("int")).otherwise(
            F.floor(c.cast("double") * SCALE).cast("int")
        )

    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    return good.select(F.col("vec_id").alias("id"), shifted.cast("int").alias("label"), F.transform(x, whole).alias("vec")).distinct()


def _boxes(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)


def _tree(ids: np.ndarray, labels: np.ndarray, values: np.ndarray, axes: list[int]) -> dict:
    """A tile as one row: vectors in leaf order, sorted by two more coordinates (slabs, then runs)."""
    if len(axes) > 3:
        leaves = -(-len(ids) // LEAF)
        slab = -(-leaves // max(1, round(leaves**0.5))) * LEAF
        order = np.lexsort((ids, values[:, axes[2]], labels))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids)) // slab
        order = np.lexsort((ids, values[:, axes[3]], place))
        ids, labels, values = ids[order], labels[order], values[order]
    return {"ids": ids.astype("<i8").tobytes(), "labels": labels.astype("<i4").tobytes(), "vecs": values.astype("<i4").tobytes()}


def build_tiles(rows: DataFrame, width: int, number: int) -> DataFrame:
    """``ids``, ``labels``, ``vecs`` (packed) of each tile of ``rows``; shorter vectors are filled up with 0."""
    sample = rows.limit(SAMPLE).select(F.posexplode("vec").alias("axis", "x"))
    by_spread = sample.groupBy("axis").agg(F.var_pop("x").alias("spread")).orderBy(F.desc("spread"), "axis").limit(4)
    axes = [r["axis"] for r in by_spread.collect()]
    value = lambda a: F.coalesce(F.get("vec", F.lit(a)), F.lit(0))
    tiles = max(1, -(-number // TILE))
    slabs = max(1, round((tiles / LABELS) ** 0.5))
    if slabs > 1:
        edges = rows.select(value(axes[0]).alias("x")).approxQuantile("x", [i / slabs for i in range(1, slabs)], 0.01)
        slab = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < value(axes[0])))
    else:
        slab = F.lit(0)
    second = value(axes[1]) if len(axes) > 1 else F.lit(0)
    dealt = (
        rows.withColumn("slab", slab)
        .withColumn("second", second)
        .repartitionByRange(tiles, "label", "slab", "second", "id")
        .sortWithinPartitions("label", "slab", "second", "id")
        .select("id", "label", "vec")
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def tree() -> pa.RecordBatch:
            ids, labels, vecs = [], [], []
            for b in held:
                ids.append(b["id"].to_numpy())
                labels.append(b["label"].to_numpy())
                values = np.zeros((b.num_rows, width), np.int64)
                size = b["vec"].value_lengths().to_numpy()
                row = np.repeat(np.arange(b.num_rows), size)
                at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                values[row, at] = b["vec"].flatten().to_numpy()
                vecs.append(values)
            found = _tree(np.concatenate(ids), np.concatenate(labels), np.concatenate(vecs), axes)
            return pa.RecordBatch.from_pylist([found], pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("vecs", pa.binary())]))

        count = 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, TILE - count)
                held.append(part)
                start, count = start + part.num_rows, count + part.num_rows
                if count == TILE:
                    yield tree()
                    held, count = [], 0
        if held:
            yield tree()

    return stored(dealt.mapInArrow(pack, "ids binary, labels binary, vecs binary"), "tiles")


class Nearest:
    """The best ``k`` (score, id) found so far for each query of a block."""

    def __init__(self, number: int, k: int):
        self.k = k
        self.scores = np.full((number, k), -np.inf)
        self.ids = np.full((number, k), np.iinfo(np.int64).max)

    def kth(self, at: np.ndarray) -> np.ndarray:
        return self.scores[at, self.k - 1]

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (-inf: none) of queries ``at`` with the vectors ``ids``; higher first, ties by smaller id."""
        hit = (scores >= self.kth(at)[:, None]) & (scores > -np.inf)
        rows = hit.any(axis=1)
        if not rows.any():
            return
        at, scores = at[rows], np.where(hit[rows], scores[rows], -np.inf)
        scores = np.concatenate([self.scores[at], scores], axis=1)
        ids = np.concatenate([self.ids[at], np.broadcast_to(ids, (len(at), len(ids)))], axis=1)
        best = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.scores[at] = np.take_along_axis(scores, best, 1)
        self.ids[at] = np.take_along_axis(ids, best, 1)


class Tree:
    """A tile as it is searched."""

    def __init__(self, ids: bytes, labels: bytes, vecs: bytes, exact: type):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i4")
        self.vecs = np.frombuffer(vecs, "<i4").reshape(len(self.ids), -1).astype(exact)
        self.starts = np.arange(0, len(self.ids), LEAF)
        self.low, self.high = _boxes(self.vecs, self.starts)
        self.box = self.low.min(axis=0, keepdims=True), self.high.max(axis=0, keepdims=True)
        self.least_label = np.minimum.reduceat(self.labels, self.starts)
        self.most_label = np.maximum.reduceat(self.labels, self.starts)

    def search(self, queries: np.ndarray, able: np.ndarray, wanted, score) -> None:
        """Best-first search for all ``queries`` at once.

        ``able`` says which (query, leaf) can hold a wanted label. ``wanted(at, upper, lower)`` says which
        boxes the queries ``at`` still need, given bounds on their inner products; ``score(at, leaf)``
        takes the leaf's vectors into account.
        """
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        upper, lower = (up @ self.box[1].T + down @ self.box[0].T), (up @ self.box[0].T + down @ self.box[1].T)
        at = np.flatnonzero(able.any(axis=1))
        at = at[wanted(at, upper[at, 0], lower[at, 0])]
        if not len(at):
            return
        upper = up[at] @ self.high.T + down[at] @ self.low.T
        lower = up[at] @ self.low.T + down[at] @ self.high.T
        upper = np.where(able[at], upper, -np.inf)
        queue = np.argsort(-upper, axis=1, kind="stable")
        row = np.arange(len(at))
        for turn in range(len(self.starts)):
            leaf = queue[row, turn]
            bound = upper[row, leaf]
            # Bounds only fall along a queue, so a query whose best box cannot reach its window is done.
            alive = bound > -np.inf
            alive[alive] = wanted(at[row[alive]], bound[alive], None)
            row, leaf = row[alive], leaf[alive]
            if not len(row):
                return
            inside = wanted(at[row], upper[row, leaf], lower[row, leaf])
            now, leaves = row[inside], leaf[inside]
            order = np.argsort(leaves, kind="stable")
            cuts = np.flatnonzero(np.diff(leaves[order])) + 1
            for part in np.split(order, cuts) if len(order) else []:
                score(at[now[part]], int(leaves[part[0]]))

    def leaf(self, number: int) -> slice:
        return slice(self.starts[number], min(self.starts[number] + LEAF, len(self.ids)))


def _exact(queries: np.ndarray, width: int, largest: int) -> type:
    """Floating point (much faster) where sums of products are whole numbers below 2 ** 53, else integers."""
    most = int(np.abs(queries).max(initial=0)) * largest * max(1, width)
    return np.float64 if most < 1 << 53 else np.int64


def _search(tiles: DataFrame, block, names: list[str], k: int, run_tile, outputs: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = block.value
        found = None
        for batch in batches:
            for ids, labels, vecs in zip(*(batch[c].to_pylist() for c in ("ids", "labels", "vecs")), strict=True):
                found = found or Nearest(len(queries["window"]), k)
                run_tile(queries, Tree(ids, labels, vecs, queries["vecs"].dtype.type), found)
        if found:
            row, place = np.nonzero(found.scores > -np.inf)
            at = pa.array(row)
            yield pa.RecordBatch.from_pydict(
                {n: pa.array(queries[n]).take(at) for n in names}
                | {"score": found.scores[row, place].astype(np.int64), "id": found.ids[row, place]}
            )

    return tiles.mapInArrow(run, outputs)


def _same_label(queries: dict, tree: Tree, found: Nearest) -> None:
    labels = queries["label"]
    able = (tree.least_label <= labels[:, None]) & (labels[:, None] <= tree.most_label)

    def wanted(at, upper, lower):
        return upper >= found.kth(at)

    def score(at, leaf):
        part = tree.leaf(leaf)
        scores = (queries["vecs"][at] @ tree.vecs[part].T).astype(np.float64)
        same = tree.labels[part] == labels[at][:, None]
        found.add(at, np.where(same, scores, -np.inf), tree.ids[part])

    tree.search(queries["vecs"], able, wanted, score)


def _other_label(queries: dict, tree: Tree, found: Nearest) -> None:
    labels, low, high = queries["label"], queries["low"], queries["high"]
    able = (tree.least_label != labels[:, None]) | (tree.most_label != labels[:, None])

    def wanted(at, upper, lower):
        inside = upper >= np.maximum(low[at], found.kth(at))
        return inside if lower is None else inside & (lower <= high[at])

    def score(at, leaf):
        part = tree.leaf(leaf)
        scores = (queries["vecs"][at] @ tree.vecs[part].T).astype(np.float64)
        fits = (tree.labels[part] != labels[at][:, None]) & (scores >= low[at][:, None]) & (scores <= high[at][:, None])
        found.add(at, np.where(fits, scores, -np.inf), tree.ids[part])

    tree.search(queries["vecs"], able, wanted, score)


def _packed_block(rows: list, width: int, largest: int, columns: list[str]) -> dict:
    values = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        values[i, : len(r["vec"])] = r["vec"]
    block = {c: np.array([r[c] for r in rows]) for c in columns}
    return block | {"vecs": values.astype(_exact(values, width, largest)), "window": np.arange(len(rows))}


def _in_blocks(tiles: DataFrame, queries: DataFrame, width: int, largest: int, columns: dict[str, str], k: int, run_tile) -> DataFrame:
    """The best ``k`` of each query (``key`` and more ``columns``), the queries taken in blocks of bounded size."""
    spark = tiles.sparkSession
    names = [c for c in columns if c != "label"]
    schema = ", ".join(f"{n} {columns[n]}" for n in names) + ", score bigint, id bigint"
    blocks = 1 + queries.count() * 8 * max(1, width) // BLOCK_BYTES
    found = None
    for b in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("key", F.lit(b"block")), F.lit(blocks)) == b).collect()
        if rows:
            block = spark.sparkContext.broadcast(_packed_block(rows, width, largest, list(columns)))
            part = stored(_search(tiles, block, names, k, run_tile, schema), "found")
            block.unpersist()
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"{schema}, rank int")
    best = Window.partitionBy(*names).orderBy(F.desc("score"), "id")
    return stored(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "best")


def hard_negatives(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Reads ``vec_id``, ``embedding`` and ``label``; other columns are ignored. Rows with a null id,
    label or vector, or a component that is null or not finite, take no part; an empty vector is all
    0, and shorter vectors are filled up with 0. Rows repeated in id, label and vector count once.
    Of rows with one id but other contents each takes part, and none is another's positive. A
    component of 65,536 or more ends the job, as scores could not be kept exact. A label may be any
    integer. Equal scores go by id. An empty table gives no rows.

    Of equal vectors with one label only the smallest ids can be among the best, so all others
    leave the index before anything else; a vector that a third of the rows hold is one query.
    """
    base = stored(scaled_rows(rows).withColumn("key", F.md5(F.concat_ws(",", "label", F.array_join("vec", ",")))), "rows")
    anchors = base.where(F.col("id") % ANCHOR_EVERY == 0).select(F.col("id").alias("anchor_id"), "key")
    first = Window.partitionBy("key").orderBy("id")
    kept = base.withColumn("nr", F.row_number().over(first)).where(F.col("nr") <= max(positives + 1, negatives)).drop("nr")
    index = stored(kept, "index")
    stats = index.agg(
        F.count("*").alias("n"),
        F.max(F.size("vec")).alias("width"),
        F.max(F.array_max(F.transform("vec", F.abs))).alias("largest"),
    ).first()
    width, largest = max(1, stats["width"] or 0), max(1, stats["largest"] or 0)
    asked = stored(index.join(anchors.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]).select("key", "label", "vec"), "asked")
    tiles = build_tiles(index.select("id", "label", "vec"), width, stats["n"])

    near = _in_blocks(tiles, asked, width, largest, {"key": "string", "label": "int"}, positives + 1, _same_label)
    near = near.select("key", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    p = F.col("positive_score")
    windows = (
        near.select("key", "positive_score")
        .distinct()
        .withColumn("low", F.ceil((p * low).cast("decimal(25,0)") / 100).cast("long"))
        .withColumn("high", F.floor((p * high).cast("decimal(25,0)") / 100).cast("long"))
        .where("low <= high")
    )
    windows = stored(windows.join(asked, "key"), "windows")
    columns = {"key": "string", "label": "int", "positive_score": "bigint", "low": "bigint", "high": "bigint"}
    hard = _in_blocks(tiles, windows, width, largest, columns, negatives, _other_label)

    order = Window.partitionBy("anchor_id", "key").orderBy(F.desc("positive_score"), "positive_id")
    pairs = (
        anchors.join(near, "key")
        .where(F.col("anchor_id") != F.col("positive_id"))
        .withColumn("nr", F.row_number().over(order))
        .where(F.col("nr") <= positives)
    )
    hard = hard.select("key", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(hard, ["key", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
