"""Near duplicates by fast similarity sketching, banding and exact verification.

A sketch has ``BANDS * ROWS`` coordinates. In round i every shingle of a document is hashed anew
and thrown into one bin; a bin keeps the smallest (round, hash) it gets. Rounds go on until all
bins are full. After as many rounds as there are bins, round i puts every shingle into bin i of
the second lap, so twice as many rounds always suffice. Two documents agree in a coordinate with
a probability equal to their similarity, and the number of agreements is concentrated as sharply
as that of independent hash functions, while a document of n shingles costs about
max(n, t log t) hashes for t coordinates instead of n * t.

Two sets at similarity 0.75 share none of the 64 bands of 6 coordinates with a probability below
4 in a million.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import LOWER, by_batch, enter, stored, utf8_bytes
from faremill.llm.components import components

WIDTH = 5
BANDS, ROWS = 64, 6
COORDINATES = BANDS * ROWS
#: Of 384 coordinates a pair at 0.75 shares 288 on average, with a deviation of 8.5. Pairs that
#: share fewer than this are not compared in full: 4.5 deviations below, which loses a pair at 0.75
#: about as rarely (6 in a million) as the bands do, and pairs above 0.75 more rarely still.
LEAST_SHARED = 250
#: Documents sketched together; bounds a task's memory, not the result.
GROUP = 1_000
KEPT_WORDS = 300_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_words: dict[bytes, int] = {}


def _let_go() -> None:
    _words.clear()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's runs of five words."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > KEPT_WORDS:
        _words.clear()
    known = _words
    for w in set(words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(WIDTH, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * _MIX + h[k : len(words) - width + 1 + k]
    return np.unique(_mixed(total))


def sketches(sets: list[np.ndarray], bins: int = COORDINATES) -> np.ndarray:
    """One row of ``bins`` coordinates for each non-empty set."""
    found = np.full(len(sets) * bins, _FULL, np.uint64)
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    row = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    for turn in range(2 * bins):
        seed = np.uint64((turn + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
        h = _mixed(items ^ seed)
        low = h & np.uint64(0xFFFFFFFF)
        at = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if turn < bins else turn - bins
        np.minimum.at(found, row * bins + at, low | np.uint64(turn << 32))
        open_rows = (found.reshape(-1, bins) == _FULL).any(axis=1)
        if not open_rows.any():
            break
        stay = open_rows[row]
        if not stay.all():
            items, row = items[stay], row[stay]
    return found.reshape(-1, bins)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch; bands do not share keys."""
    parts = rows.reshape(len(rows), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(rows), BANDS)).copy()
    for k in range(ROWS):
        keys = _mixed(keys * _MIX + parts[:, :, k])
    return keys


def _signatures(docs: DataFrame) -> DataFrame:
    """Per row: id, number of shingles, hash of the set, band keys and one byte of each coordinate."""

    def work(batch: pa.RecordBatch) -> dict:
        enter(__name__, _let_go)
        sets = [shingles(t) for t in utf8_bytes(batch["text"])]
        digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        keys: list[np.ndarray | None] = [None] * len(sets)
        bits: list[bytes | None] = [None] * len(sets)
        filled = [i for i, s in enumerate(sets) if len(s)]
        for start in range(0, len(filled), GROUP):
            part = filled[start : start + GROUP]
            rows = sketches([sets[i] for i in part])
            for i, k, b in zip(part, band_keys(rows).view(np.int64), rows.astype(np.uint8).view(np.int8), strict=True):
                keys[i], bits[i] = k, b
        return {
            "doc_id": batch["doc_id"],
            "n": pa.array([len(s) for s in sets], pa.int64()),
            "digest": pa.array(digest, pa.binary()),
            "keys": pa.array(keys, pa.list_(pa.int64())),
            "bits": pa.array(bits, pa.list_(pa.int8())),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, digest binary, keys array<bigint>, bits array<tinyint>"
    return by_batch(docs.select("doc_id", "text"), schema, work)


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The full sets of some documents: ``id``, ``items``."""

    def work(batch: pa.RecordBatch) -> dict:
        enter(__name__, _let_go)
        sets = [shingles(t).view(np.int64) for t in utf8_bytes(batch["text"])]
        return {"id": batch["doc_id"], "items": pa.array(sets, pa.list_(pa.int64()))}

    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = docs.select("doc_id", "text").join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    return by_batch(wanted, f"id {kind}, items array<bigint>", work)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - F.col("shared")
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .withColumn("shared", shared)
        .where(100 * F.col("shared") >= 75 * union)
        .select("a", "b")
        .distinct()
    )


def _alike(x: str, y: str, least: int) -> F.Column:
    """Whether two sketches share enough coordinates to be worth a comparison in full."""
    same = F.aggregate(
        F.zip_with(x, y, lambda p, q: F.when(p == q, 1).otherwise(0)), F.lit(0), lambda total, one: total + one
    )
    return same >= least


def near_duplicates(docs: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for each row of ``docs``.

    Equal sets are one class, which its smallest id stands for, so a group of copies costs one
    comparison-free row. Classes that share a band are compared in two steps, neither of which
    emits all pairs of a bucket: first each class with the smallest id of its buckets, which joins
    large groups into components; then only pairs that are still in different components, whose
    sizes and sketches allow 0.75, each once, in the first band it shares. Links hold between full
    sets. With ``least_shared`` 0 sketches rule no pair out that shares a band. Null and empty texts are linked with nothing and kept. A row without doc_id takes no
    part: it has no component and is kept. Repeated rows get the same result; classes that share
    their smallest doc_id count as one. Other columns are ignored; an empty table gives no rows.
    """
    rows = stored(_signatures(docs), "signatures")
    whole = rows.where("n > 0 and doc_id is not null")
    classes = stored(whole.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    firsts = whole.withColumn("id", F.col("doc_id")).join(classes, ["digest", "id"], "left_semi")
    members = stored(firsts.select("id", "n", "keys", "bits"), "members")

    spread = members.select("id", F.explode("keys").alias("key"))
    buckets = spread.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("key", "a")
    shared = stored(spread.join(buckets, "key"), "buckets")
    involved = stored(shared.select("id").distinct(), "involved")
    sets = stored(_sets(docs, involved), "sets")

    stars = stored(shared.where("a < id").select("a", F.col("id").alias("b")).distinct(), "stars")
    links = stored(_verified(stars, sets), "links")
    labels = components(links)

    placed = stored(
        shared.join(labels, "id", "left").select("key", "id", "a", F.coalesce("label", "id").alias("part")), "placed"
    )
    apart = placed.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p < q").select("key")
    open_rows = stored(
        placed.join(apart, "key", "left_semi").join(members, "id").select("key", "id", "a", "part", "n", "keys", "bits"),
        "open",
    )
    x, y = open_rows.alias("x"), open_rows.alias("y")
    common = F.zip_with("x.keys", "y.keys", lambda p, q: F.when(p == q, p))
    first_shared = F.get(F.filter(common, lambda p: p.isNotNull()), F.lit(0)) == F.col("x.key")
    pairs = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.id") != F.col("x.a"))
        & (F.col("x.part") != F.col("y.part"))
        & (100 * F.least("x.n", "y.n") >= 75 * F.greatest("x.n", "y.n"))
        & first_shared
        & _alike("x.bits", "y.bits", least_shared),
    ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    more = stored(_verified(stored(pairs, "pairs"), sets), "links")
    if more.limit(1).count():
        labels = components(links.unionByName(more))

    named = classes.join(labels, "id", "left").select("digest", F.coalesce("label", "id").alias("found"))
    return (
        rows.select("doc_id", F.col("n").alias("n_shingles"), "digest")
        .join(named, "digest", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


#: Ids whose rows are gathered by a broadcast; more are joined by Spark's own choice.
FEW = 100_000


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: the one whose id stands for the group.

    Of rows that share this id, repeated or with other texts, the first by text stays (ties: any
    order that depends on the rows' contents alone). Rows without doc_id and rows without words are in no group
    and stay, the latter once for each id. An empty table gives no rows.

    Texts are filtered by the ids that go, which are fewer than those that stay: they are broadcast
    while they are small, and dealt with the texts beyond.
    """
    by_id = near_duplicates(docs).groupBy("doc_id").agg(F.bool_or("kept").alias("stays"), F.count("*").alias("n"))
    others = stored(by_id.where("doc_id is not null and (not stays or n > 1)").select("doc_id", "stays"), "others")
    alone = docs.join(others.select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    several = others.where("stays").select("doc_id")
    number = several.limit(FEW + 1).count()
    if not number:
        return alone
    inner = [f"c{i}" for i in range(len(docs.columns))]
    wanted = F.broadcast(several) if number <= FEW else several
    rows = docs.join(wanted, "doc_id", "left_semi").select(docs.columns).toDF(*inner)
    first = Window.partitionBy(inner[docs.columns.index("doc_id")]).orderBy(inner[docs.columns.index("text")], F.xxhash64(*inner))
    return alone.unionByName(rows.withColumn("nr", F.row_number().over(first)).where("nr = 1").select(inner).toDF(*docs.columns))
