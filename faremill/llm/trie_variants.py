"""Spelling variants: words one edit apart, found by a frontier that walks a distributed trie.

The trie is a table of edges. Only prefixes at which words part or end are nodes; an edge carries
all characters between two nodes. A state is a word, a position in it, a node and the number of
edits so far. Level by level the frontier of states is joined with the edges of its nodes: along
the edge that spells what comes next, and, without an edit so far, along the edges that spell it but
for one replaced character; a character may also be left out at a node. A state that ends at a
word's end with one edit has found a neighbour. A word's own path has a node wherever another word
parts from it, so edits need to be tried at nodes alone.

Each pair is found once: a replacement from the side of the larger character, an inserted
character from the longer word, and in a run of equal characters the last is the one left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import LOWER, by_batch, small_batches, stored, utf8_bytes

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: How many times as common as a word its form must be.
FORM_TIMES = 5
#: One run in so many loses a character.
DAMAGED = 199
#: Distinct words a task adds up before it sends them on; bounds its memory, not the result.
KEPT_WORDS = 200_000
#: States that one copy of a node's edges stands for: common nodes have their edges in several copies.
STATES = 4096
ROOT = 0

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
_STEP = 0x9E3779B97F4A7C15


def runs_of(doc_id: str, text: bytes) -> Iterator[tuple[str, int]]:
    """The runs of a text that can give a word, as they stand after the deletion, with their numbers."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text.translate(LOWER).decode())).items():
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        yield run, n


def count_words(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of every word that occurs at least ``least_count`` times.

    Null texts have no words and a null doc_id counts as empty text. Tasks add up what they
    read before anything moves.
    """
    small_batches(docs.sparkSession)

    def table(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(counts, pa.string()), "n": pa.array(counts.values(), pa.int64())})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["id"].to_pylist(), utf8_bytes(batch["text"]), strict=True):
                for word, n in runs_of(doc_id, text):
                    counts[word] += n
                if len(counts) > KEPT_WORDS:
                    yield table(counts)
                    counts.clear()
        yield table(counts)

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counted = texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _prefix_hashes(word: str, powers: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of all prefixes of a word, the empty one first (``ROOT``).

    Two prefixes with one hash would share a node, which adds states but loses none; found pairs
    are checked in the end.
    """
    points = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(powers[0]) < len(points):
        powers[0] = np.multiply.accumulate(np.full(2 * len(points), _STEP, np.uint64))
    h = np.cumsum((points + np.uint64(1)) * powers[0][: len(points)], dtype=np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.concatenate([np.zeros(1, np.uint64), h ^ (h >> np.uint64(29))]).view(np.int64)


def _prefixes(words: DataFrame) -> DataFrame:
    """``word``, ``depth``, ``node`` of each prefix and ``sign``, the code point after it (0: the end)."""

    def work(batch: pa.RecordBatch) -> dict:
        powers = [np.multiply.accumulate(np.full(64, _STEP, np.uint64))]
        rows = batch["word"].to_pylist()
        hashes = [_prefix_hashes(w, powers) for w in rows]
        sizes = [len(h) for h in hashes]
        signs = np.frombuffer("".join(f"{w}\0" for w in rows).encode("utf-32-le"), "<i4")
        return {
            "word": batch["word"].take(pa.array(np.repeat(np.arange(len(rows)), sizes))),
            "depth": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]) if rows else pa.array([], pa.int32()),
            "node": np.concatenate(hashes) if rows else pa.array([], pa.int64()),
            "sign": pa.array(signs, pa.int32()),
        }

    return by_batch(words.select("word"), "word string, depth int, node bigint, sign int", work, 1_000)


def trie_edges(words: DataFrame) -> DataFrame:
    """The edges of the trie of ``words``.

    ``node``, ``copy`` (edges of common nodes stand here several times), ``first`` and ``rest``
    of the characters on the edge, ``width``, ``child``, ``copies`` of the child's edges, ``onward``
    (the first characters of the child's edges) and ``ending`` (the word that ends at the child).
    """
    prefixes = stored(_prefixes(words), "prefixes")
    nodes = (
        prefixes.groupBy("node")
        .agg(F.count("*").alias("below"), F.min("sign").alias("low"), F.max("sign").alias("high"))
        .where((F.col("low") != F.col("high")) | (F.col("low") == 0) | (F.col("node") == ROOT))
        .select("node", "below")
    )
    # The root is on every path and needs no join, which its key would make lopsided.
    on_path = prefixes.where("depth > 0").select("word", "depth", "node").join(nodes, "node")
    root = F.struct(F.lit(0).alias("depth"), F.lit(ROOT).cast("long").alias("node"), F.lit(words.count()).cast("long").alias("below"))
    inner = F.array_sort(F.collect_list(F.struct("depth", "node", "below")))
    paths = on_path.groupBy("word").agg(F.concat(F.array(root), inner).alias("path"))
    steps = paths.select("word", F.explode(F.arrays_zip(F.expr("slice(path, 1, size(path) - 1)").alias("a"), F.expr("slice(path, 2, size(path) - 1)").alias("b"))).alias("s"))
    label = F.substring("word", F.col("s.a.depth") + 1, F.col("s.b.depth") - F.col("s.a.depth"))
    ending = F.when(F.length("word") == F.col("s.b.depth"), F.col("word"))
    edges = stored(
        steps.select(
            F.col("s.a.node").alias("node"),
            F.col("s.b.node").alias("child"),
            label.alias("label"),
            F.col("s.a.below").alias("above"),
            F.col("s.b.below").alias("below"),
            ending.alias("ending"),
        )
        .groupBy("node", "child", "label", "above", "below")
        .agg(F.max("ending").alias("ending")),
        "edges",
    )
    copies = lambda n: (1 + n / STATES).cast("int")
    owned = edges.select(F.col("child").alias("node"), copies(F.col("above") + F.col("below")).alias("own"))
    onward = edges.groupBy("node").agg(F.array_join(F.array_sort(F.collect_set(F.substring("label", 1, 1))), "").alias("onward"))
    return stored(
        edges.join(owned, "node", "left")
        .join(onward.withColumnRenamed("node", "child"), "child", "left")
        .select(
            "node",
            F.explode(F.sequence(F.lit(0), F.coalesce("own", copies(F.col("above"))) - 1)).alias("copy"),
            F.substring("label", 1, 1).alias("first"),
            F.expr("substring(label, 2)").alias("rest"),
            F.length("label").alias("width"),
            "child",
            copies(F.col("above") + F.col("below")).alias("copies"),
            F.coalesce("onward", F.lit("")).alias("onward"),
            "ending",
        ),
        "trie",
    )


def _at(position: Column) -> Column:
    return F.substring("word", position + 1, F.lit(1))


def _live(arrived: DataFrame) -> DataFrame:
    """States that can go on or have found a neighbour, and those with the next character left out."""
    at, size = F.col("at"), F.length("word")
    left_out = (F.col("edits") == 0) & (at < size) & (_at(at) != _at(at + 1))
    both = F.when(left_out, F.array(F.struct(at.alias("at"), F.lit(0).alias("edits")), F.struct((at + 1).alias("at"), F.lit(1).alias("edits"))))
    states = arrived.withColumn("x", F.explode(F.coalesce(both, F.array(F.struct("at", "edits"))))).select(
        "word", "x.at", "x.edits", "node", "copies", "onward", "ending"
    )
    other = F.when((F.col("edits") == 1) & (at == size), F.col("ending"))
    goes_on = (at < size) & F.contains("onward", _at(at))
    return states.withColumn("other", other).where(goes_on | F.col("other").isNotNull()).drop("onward", "ending")


def _step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level on: along the edge that spells what comes next, or all of it but its first character."""
    states = frontier.where("other is null").withColumn("copy", F.pmod(F.hash("word"), "copies"))
    states = states.withColumn("next", _at(F.col("at"))).drop("copies", "other")
    spelled = F.col("rest") == F.substring("word", F.col("at") + 2, F.col("width") - 1)
    to = ["word", (F.col("at") + F.col("width")).alias("at"), F.col("child").alias("node"), "copies", "onward", "ending"]
    along = states.withColumnRenamed("next", "first").join(edges, ["node", "copy", "first"]).where(spelled).select(*to, "edits")
    clean = states.where("edits = 0").drop("edits")
    replaced = clean.join(edges, ["node", "copy"]).where((F.col("first") < F.col("next")) & spelled).select(*to, F.lit(1).alias("edits"))
    return along.unionByName(replaced)


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``other``: the pairs of words (distinct, not null) that differ by one inserted, deleted or
    replaced code point, each from both sides. An empty table gives no rows."""
    edges = trie_edges(words)
    root = edges.where(F.col("node") == ROOT).agg(
        F.coalesce(F.max("copy") + 1, F.lit(1)).alias("copies"),
        F.array_join(F.collect_set("first"), "").alias("onward"),
    )
    start = root.first()
    began = words.select(
        "word",
        F.lit(0).alias("at"),
        F.lit(0).alias("edits"),
        F.lit(ROOT).cast("long").alias("node"),
        F.lit(start["copies"]).alias("copies"),
        F.lit(start["onward"]).alias("onward"),
        F.lit(None).cast("string").alias("ending"),
    )
    frontier, pairs = stored(_live(began), "frontier"), []
    while frontier.limit(1).count():
        frontier = stored(_live(_step(frontier, edges)), "frontier")
        pairs.append(frontier.where("other is not null").select("word", "other"))
    if not pairs:
        return words.select("word", F.col("word").alias("other")).where("false")
    found = pairs[0]
    for more in pairs[1:]:
        found = found.unionByName(more)
    found = stored(found.where(F.levenshtein("word", "other", 1) == 1).distinct(), "pairs")
    return found.unionByName(found.select(F.col("other").alias("word"), F.col("word").alias("other")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and the last form that ``forms`` (``word``, ``form``) lead to.

    A form is at least five times as common as its word, so chains have 27 links at most and five
    rounds of following twice as far end at the last.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(5):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("last"))
        joined = stored(roots.join(onward, "root", "left").select("word", F.coalesce("last", "root").alias("root"), "last"), "roots")
        roots = joined.drop("last")
        if not joined.where("last is not null").limit(1).count():
            break
    return roots


def variants(words: DataFrame, form_times: int = FORM_TIMES) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for each row of ``words`` (``word``, ``n``).

    A word's form is its commonest neighbour (ties: the first in code-point order) if that is at
    least ``form_times`` as common; the root is the last form that forms lead to, or the word.
    Words must be distinct; an empty table gives no rows. Other columns are ignored.
    """
    words = stored(words.select("word", "n"), "words")
    near = neighbours(words).join(words.withColumnRenamed("word", "other").withColumnRenamed("n", "other_n"), "other")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= form_times * F.col("n"), F.col("best")).alias("best"),
    )
    found = stored(found.select("word", F.col("best.other").alias("form"), "n", "n_near", (-F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """The words of ``docs`` (see ``count_words``) with their forms (see ``variants``).

    Reads ``doc_id`` and ``text``; other columns are ignored. Repeated rows count as often as they
    stand there. An empty table gives no rows.
    """
    return variants(count_words(docs, least_count))
