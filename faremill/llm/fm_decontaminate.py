"""Benchmark decontamination with an FM-index over each shard of the training texts.

A shard is a bounded run of documents inside one task. Its words become symbols: the words of the
benchmark by number, anything else (and every document end) a separator, since no window can hold
a word that the benchmark doesn't have. The suffix array of the symbols gives the
Burrows-Wheeler transform, stored as a wavelet tree of bit vectors with counted ranks. All windows
are searched backwards at once, and each occurrence is located by stepping back to the next
sampled suffix. The spans found are merged for each document. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import enter, utf8_bytes

WINDOW = 10
#: Words of a shard before its index is built; a longer document is a shard of its own.
SHARD_WORDS = 2_000_000
#: Every so manieth position of a shard is kept as a sampled suffix.
SAMPLE = 8
#: Characters of benchmark text searched in one pass; a larger benchmark takes several passes.
BLOCK_CHARS = 8_000_000


def _word_table() -> bytes:
    """Each byte's place in words: A-Z lowered; other ASCII than letters and digits becomes a space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        table[c] = c
    for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        table[c] = c + 32
    return bytes(table)


_TABLE = _word_table()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector for each bit of the symbols, high bit first.

    Each level holds the sequence sorted stably by the bits above, so that a prefix of the parent's
    node maps into one of its two children. Ones are counted up to every position.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first ``upto`` elements."""
        low, high = np.zeros_like(upto), upto.copy()
        for level in range(self.bits):
            one = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            ones, zeros = self.ones[level], self.zeros[level]
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at some places."""
        found = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            bit = ones[at + 1] - ones[at]
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
            found = found * 2 + bit
        return found


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; the last symbol must be unique and least.

    Prefix doubling that sorts only suffixes still tied with others.
    """
    size = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(size, np.int64)
    change = np.concatenate(([True], symbols[order][1:] != symbols[order][:-1]))
    starts = np.flatnonzero(change)
    rank[order] = starts[np.cumsum(change) - 1]
    width = 1
    while True:
        held = rank[order]
        tied = np.concatenate((held[1:] == held[:-1], [False])) | np.concatenate(([False], held[1:] == held[:-1]))
        places = np.flatnonzero(tied)
        if not len(places):
            return order
        group = order[places]
        after = group + width
        key = np.where(after < size, rank[np.minimum(after, size - 1)], -1)
        first = rank[group]
        way = np.lexsort((key, first))
        group, key, first = group[way], key[way], first[way]
        order[places] = group
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (key[1:] != key[:-1])))
        rank[group] = places[np.flatnonzero(new)][np.cumsum(new) - 1]
        width *= 2


class FMIndex:
    """Backward search and location over one sequence of symbols from 1 up; 0 is added as its end."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        symbols = np.concatenate((symbols, [0])).astype(np.int64)
        order = suffix_array(symbols)
        self.last = WaveletTree(symbols[order - 1], max(1, int(kinds).bit_length()))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=kinds + 1))))
        self.size = len(symbols)
        self.sampled = order % SAMPLE == 0
        self.count = np.concatenate(([0], np.cumsum(self.sampled)))
        self.position = order[self.sampled]

    def ranges(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that start with each pattern (rows padded on the right)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            live = np.flatnonzero((sizes > k) & (low < high))
            symbol = patterns[live, k]
            low[live] = self.before[symbol] + self.last.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.last.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: step back until a sampled one is met, then add the steps."""
        found, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            here = rows[open_]
            hit = self.sampled[here]
            done = open_[hit]
            found[done] = self.position[self.count[rows[done]]] + steps[done]
            open_ = open_[~hit]
            here = rows[open_]
            symbol = self.last.access(here)
            rows[open_] = self.before[symbol] + self.last.rank(symbol, here)
            steps[open_] += 1
        return found


class Windows:
    """The distinct windows of some benchmark items as rows of word numbers."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 2) for w in words_of(text)]
            for i in range(max(1, len(ids) - WINDOW + 1)) if ids else ():
                owners.setdefault(tuple(ids[i : i + WINDOW]), set()).add(name)
        self.owners = [sorted(o) for o in owners.values()]
        self.sizes = np.array([len(w) for w in owners], np.int64)
        self.patterns = np.zeros((len(owners), WINDOW), np.int64)
        for i, w in enumerate(owners):
            self.patterns[i, : len(w)] = w

    def search(self, docs: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """For each document: merged spans of words hit (end exclusive), and the items found."""
        found: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in docs]
        if not len(self.sizes):
            return found
        sizes = np.array([len(d) + 1 for d in docs], np.int64)
        symbols = np.ones(sizes.sum(), np.int64)
        at = 0
        for d in docs:
            symbols[at : at + len(d)] = np.fromiter(map(self.numbers.get, d, repeat(1)), np.int64, len(d))
            at += len(d) + 1
        kept = self._kept(symbols)
        if not len(kept):
            return found
        index = FMIndex(symbols[kept], len(self.numbers) + 1)
        low, high = index.ranges(self.patterns, self.sizes)
        window = np.repeat(np.arange(len(low)), high - low)
        if not len(window):
            return found
        offset = np.arange(len(window)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        start = kept[index.locate(low[window] + offset)]
        first = np.concatenate(([0], np.cumsum(sizes)))
        doc = np.searchsorted(first, start, side="right") - 1
        self._merge(found, doc, start - first[doc], window)
        return found

    def _kept(self, symbols: np.ndarray) -> np.ndarray:
        """Places of the runs of known words as long as the shortest window, with one separator each."""
        known = symbols > 1
        edge = np.diff(np.concatenate(([0], known.view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= self.sizes.min()
        mark = np.zeros(len(symbols) + 1, np.int32)
        mark[starts[long]] += 1
        mark[np.minimum(ends[long] + 1, len(symbols))] -= 1
        return np.flatnonzero(np.cumsum(mark[:-1]) > 0)

    def _merge(self, found: list, doc: np.ndarray, start: np.ndarray, window: np.ndarray) -> None:
        for d, w in set(zip(doc.tolist(), window.tolist(), strict=True)):
            found[d][1].update(self.owners[w])
        way = np.lexsort((start, doc))
        for d, s, n in zip(doc[way].tolist(), start[way].tolist(), self.sizes[window[way]].tolist(), strict=True):
            spans = found[d][0]
            if spans and s <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], s + n))
            else:
                spans.append((s, s + n))


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], e))
        else:
            merged.append((s, e))
    return merged


def find_contamination(docs: DataFrame, benchmark: DataFrame, leaks: str = "leaks") -> DataFrame:
    """All columns of ``docs`` and last a struct ``leaks`` (``n_words``, ``spans`` of words, ``items``).

    A window is ten consecutive words of an item, or all of an item with fewer; its occurrences in
    a document are merged into spans, and ``items`` are the ids (as text) whose windows occur. Null
    texts and items have no words. An item without id is named by empty text. Equal items, repeated
    rows and ties change nothing. The benchmark is the stated query set: it is read in blocks of
    bounded size, each of which is broadcast and searched in one pass over the documents; no rows
    are moved between tasks. With an empty benchmark nothing is found. The struct's name may be
    chosen; a column of ``docs`` that has it goes.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text").where(
        "text is not null"
    )
    chars = items.select(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = int(chars // BLOCK_CHARS) + 1
    found = docs.drop(leaks).withColumn(
        leaks,
        F.struct(
            F.lit(0).cast("long").alias("n_words"),
            F.array().cast("array<struct<s:bigint,e:bigint>>").alias("spans"),
            F.array().cast("array<string>").alias("items"),
        ),
    )
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block).collect()
        windows = spark.sparkContext.broadcast(Windows([(r[0], r[1].encode()) for r in rows]))
        found = _one_pass(found, windows)
    return found


def _one_pass(docs: DataFrame, windows) -> DataFrame:
    text_at = docs.columns.index("text")

    def search(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        words = [words_of(t) for t in utf8_bytes(batch.column(text_at))]
        start, size = 0, 0
        for i, w in enumerate(words):
            size += len(w) + 1
            if size >= SHARD_WORDS or i == len(words) - 1:
                part = batch.slice(start, i + 1 - start)
                old = part.column(part.num_columns - 1).to_pylist()
                new = windows.value.search(words[start : i + 1])
                leaks = [
                    {
                        "n_words": len(w),
                        "spans": [{"s": s, "e": e} for s, e in _union([(x["s"], x["e"]) for x in o["spans"]] + spans)],
                        "items": sorted({*o["items"], *names}),
                    }
                    for o, (spans, names), w in zip(old, new, words[start : i + 1], strict=True)
                ]
                column = pa.array(leaks, batch.schema.field(batch.num_columns - 1).type)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], column], schema=batch.schema)
                start, size = i + 1, 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from search(batch)

    return docs.mapInArrow(run, docs.schema)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    hit = F.aggregate("leaks.spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return found.select(
        "doc_id",
        F.col("leaks.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("leaks.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("leaks.items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


_WORD = re.compile(rb"[^ ]+")


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of some spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text.translate(_TABLE))]
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join(kept) + text[at:]


def remove_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the words inside windows of the benchmark; ``n_chars`` follows the text.

    A document that has no other words goes; one without words (null or empty text) stays. Other
    columns, whatever their names, and untouched rows stay as they are. Repeated rows are cut
    alike, an empty table gives no rows.
    """
    names, schema = docs.columns, docs.schema
    text_at = names.index("text")
    found = find_contamination(docs, benchmark, "leaks" + "_" * max(map(len, names)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            out, sizes, stay = [], [], []
            leaks = batch.column(len(names)).to_pylist()
            for text, leak in zip(columns["text"].to_pylist(), leaks, strict=True):
                spans = [(x["s"], x["e"]) for x in leak["spans"]]
                stay.append(not spans or sum(e - s for s, e in spans) < leak["n_words"])
                out.append(cut_words(text.encode(), spans).decode() if spans else text)
                sizes.append(len(out[-1]) if spans else None)
            columns["text"] = pa.array(out, batch.column(text_at).type)
            if "n_chars" in columns:
                old = columns["n_chars"].to_pylist()
                new = [o if s is None else s for o, s in zip(old, sizes, strict=True)]
                columns["n_chars"] = pa.array(new, columns["n_chars"].type)
            yield pa.RecordBatch.from_pydict(columns).filter(pa.array(stay, pa.bool_()))

    return found.mapInArrow(run, schema)
