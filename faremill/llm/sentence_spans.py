"""Substring dedup by sliding spans of sentences.

A span is a run of consecutive sentences, at least ``SENTENCES`` of them and as many more as it
takes to reach ``WORDS`` words. The span that starts at every sentence is hashed; equal hashes are
joined over the corpus. The first occurrence of a span (by doc_id, then place) stays; sentences
covered by any later occurrence are removed.

Sentences end at ``. ! ? …`` before white space, or at a line end. A sentence of more than
``LONG`` words is cut after words chosen by their hash, so that a passage without full stops is cut
alike wherever it stands.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import by_batch, stored, texts

SENTENCES, WORDS = 3, 20
LONG, ANCHOR = 24, 8
_WORD = re.compile(r"\S+")
#: The end of a line, or of a word that closes a sentence.
_END = re.compile(r"\n|\Z|[.!?…][\"'”’)\]]*+(?!\S)")


def sentences(text: str) -> list[tuple[int, int, str]]:
    """Start, end (code points) and the words, joined by one space, of each sentence."""
    found, start = [], 0
    for m in _END.finditer(text):
        part = text[start : m.end()]
        if words := part.split():
            if len(words) > LONG:
                found += _cut(text, start, m.end())
            else:
                found.append((m.end() - len(part.lstrip()), start + len(part.rstrip()), " ".join(words)))
        start = m.end()
    return found


def _cut(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """The parts of a long sentence."""
    words = list(_WORD.finditer(text, start, end))
    ends = [i + 1 for i, w in enumerate(words) if zlib.crc32(w[0].encode()) % ANCHOR == 0 or i + 1 == len(words)]
    parts = [words[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    return [(p[0].start(), p[-1].end(), " ".join(w[0] for w in p)) for p in parts]


def spans(parts: list[tuple[int, int, str]]) -> list[tuple[int, int, bytes]]:
    """First and last sentence (inclusive) and 128-bit hash of the span from each sentence on."""
    sizes = [p[2].count(" ") + 1 for p in parts]
    found, end, words = [], 0, 0
    for start in range(len(parts)):
        while end < len(parts) and (end - start < SENTENCES or words < WORDS):
            words += sizes[end]
            end += 1
        if end - start < SENTENCES or words < WORDS:
            break
        text = "\n".join(p[2] for p in parts[start:end])
        found.append((start, end - 1, xxhash.xxh3_128_digest(text.encode())))
        words -= sizes[start]
    return found


def _all_spans(docs: DataFrame) -> DataFrame:
    def work(batch: pa.RecordBatch) -> dict:
        ids, keys, starts, ends, hashes = [], [], [], [], []
        for i, k, t in zip(batch["doc_id"].to_pylist(), batch["key"].to_pylist(), texts(batch["text"]), strict=True):
            for start, end, h in spans(sentences(t)):
                ids.append(i), keys.append(k), starts.append(start), ends.append(end), hashes.append(h)
        return {
            "doc_id": pa.array(ids, batch["doc_id"].type),
            "key": pa.array(keys, pa.int64()),
            "start": pa.array(starts, pa.int32()),
            "end": pa.array(ends, pa.int32()),
            "hash": pa.array(hashes, pa.binary()),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_batch(docs, f"doc_id {kind}, key bigint, start int, end int, hash binary", work)


def remove_repeated(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_sentences``, ``n_removed``, ``removed`` (code-point spans) and ``text`` of each row.

    Rows that agree in doc_id and text are one document and get one result each. Null and empty texts
    have no sentences and give an empty text. A null doc_id comes after all others. A repeat inside
    one text counts like one between texts. Texts without a removed sentence stay as they are.
    Other columns are ignored; an empty table gives no rows.

    Spans are counted before they move; only occurrences of repeated ones are joined, and Spark
    splits the partition of a span that very many documents hold.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    found = stored(_all_spans(rows), "spans", "zstd")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "start")
    counted = found.groupBy("hash").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    repeated = stored(counted.where("n > 1").select("hash", "first"), "repeated", "zstd")
    later = (
        found.join(repeated, "hash")
        .where(order > F.col("first"))
        .groupBy("doc_id", "key", "start")
        .agg(F.max("end").alias("end"))
        .groupBy("doc_id", "key")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gone"))
    )
    gone = stored(later, "gone")
    r, g = rows.alias("r"), gone.alias("g")
    same = F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("r.key") == F.col("g.key"))
    marked = r.join(g, same, "left").select("r.doc_id", "r.text", "g.gone")

    def cut(batch: pa.RecordBatch) -> dict:
        counts, removed, spelled, left = [], [], [], []
        for text, marks in zip(texts(batch["text"]), batch["gone"].to_pylist(), strict=True):
            parts = sentences(text)
            drop = {i for m in marks or () for i in range(m["start"], m["end"] + 1)}
            pieces, at, cuts = [], 0, []
            for i in sorted(drop):
                # A sentence goes with the white space before it.
                start = parts[i - 1][1] if i else 0
                pieces.append(text[at:start])
                at = parts[i][1]
                cuts.append(f"{parts[i][0]}:{parts[i][1]}")
            counts.append(len(parts)), removed.append(len(drop)), spelled.append(",".join(cuts))
            left.append(("".join(pieces) + text[at:]).lstrip() if drop else text)
        return {
            "doc_id": batch["doc_id"],
            "n_sentences": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "removed": pa.array(spelled, pa.string()),
            "text": pa.array(left, pa.string()),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_batch(marked, f"doc_id {kind}, n_sentences bigint, n_removed bigint, removed string, text string", cut)
