"""Quality classifier: a small convolutional network over bytes, written in numpy.

A text's UTF-8 bytes are covered by overlapping chunks. Each byte has a learned vector; filters run
over the chunk; each filter's greatest answer stands for the chunk. The mean and the maximum over a
document's chunks are combined into one probability. The network is trained by the driver on a
bounded sample of labelled documents (``TRAIN_DOCS``), whole texts, and applied by all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import by_batch, held_out, utf8_bytes

#: Bound of the training sample: labelled documents, chosen by a hash of their id.
TRAIN_DOCS = 2_000
CHUNK, STEP = 512, 448
VECTOR, WIDTH, STRIDE, FILTERS = 4, 8, 4, 32
EPOCHS, BATCH, RATE, DECAY = 12, 32, 0.01, 1e-4
THRESHOLD = 0.3
#: Chunks convolved at once; bounds memory, not the result.
AT_ONCE = 256
_WINDOWS = (CHUNK - WIDTH) // STRIDE + 1


def chunks(text: bytes) -> np.ndarray:
    """Overlapping chunks over all bytes; the last is filled up with zero bytes. Empty texts have one."""
    count = max(1, -(-(len(text) - CHUNK) // STEP) + 1)
    padded = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (count, CHUNK), (STEP, 1)).copy()


class Network:
    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.bytes = draw.normal(0, 0.5, (256, VECTOR)).astype(np.float32)
        self.filters = draw.normal(0, (2 / (WIDTH * VECTOR)) ** 0.5, (WIDTH * VECTOR, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.top = np.zeros(2 * FILTERS, np.float32)
        self.bias = np.zeros(1, np.float32)

    def _inputs(self, rows: np.ndarray) -> np.ndarray:
        """The vectors in every window of each chunk."""
        v = self.bytes[rows].reshape(len(rows), CHUNK * VECTOR)
        size = v.itemsize
        view = np.lib.stride_tricks.as_strided(
            v, (len(rows), _WINDOWS, WIDTH * VECTOR), (CHUNK * VECTOR * size, STRIDE * VECTOR * size, size)
        )
        return np.ascontiguousarray(view)

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """The greatest answer of each filter in each chunk."""
        parts = []
        for i in range(0, len(rows), AT_ONCE):
            x = self._inputs(rows[i : i + AT_ONCE])
            parts.append((x.reshape(-1, WIDTH * VECTOR) @ self.filters).reshape(len(x), _WINDOWS, FILTERS).max(1))
        return np.maximum(np.concatenate(parts) + self.shift, 0)

    def _document(self, pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
        sizes = np.diff(np.append(starts, len(pooled)))[:, None]
        mean = np.add.reduceat(pooled, starts) / sizes
        return np.concatenate((mean, np.maximum.reduceat(pooled, starts)), axis=1)

    def predict(self, texts: list[bytes]) -> np.ndarray:
        parts = [chunks(t) for t in texts]
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        h = self._document(self.pooled(np.concatenate(parts)), starts)
        return 1 / (1 + np.exp(-(h @ self.top + self.bias[0]).astype(np.float64)))

    def train(self, texts: list[bytes], labels: np.ndarray, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        parts = [chunks(t) for t in texts]
        names = ("bytes", "filters", "shift", "top", "bias")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        self.bias[0] = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
        turn = 0
        for epoch in range(EPOCHS):
            order = draw.permutation(len(texts))
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                turn += 1
                slopes = self._slopes([parts[k] for k in some], labels[some])
                for n, g in zip(names, slopes, strict=True):
                    value = getattr(self, n)
                    g = g + DECAY * value
                    first[n] = 0.9 * first[n] + 0.1 * g
                    second[n] = 0.999 * second[n] + 0.001 * g * g
                    rate = RATE * (1 - epoch / EPOCHS) * (1 - 0.999**turn) ** 0.5 / (1 - 0.9**turn)
                    setattr(self, n, (value - rate * first[n] / (np.sqrt(second[n]) + 1e-8)).astype(np.float32))

    def _slopes(self, parts: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, ...]:
        """Gradients of the mean log loss; only each filter's best window passes one on."""
        rows = np.concatenate(parts)
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        owner = np.repeat(np.arange(len(parts)), list(map(len, parts)))
        best = np.empty((len(rows), FILTERS), np.int64)
        raw = np.empty((len(rows), FILTERS), np.float32)
        for i in range(0, len(rows), AT_ONCE):
            x = self._inputs(rows[i : i + AT_ONCE])
            answers = (x.reshape(-1, WIDTH * VECTOR) @ self.filters).reshape(len(x), _WINDOWS, FILTERS)
            best[i : i + AT_ONCE] = answers.argmax(1)
            raw[i : i + AT_ONCE] = answers.max(1)
        pooled = np.maximum(raw + self.shift, 0)
        h = self._document(pooled, starts)
        error = (1 / (1 + np.exp(-(h @ self.top + self.bias[0]))) - labels) / len(labels)
        sizes = np.array([len(p) for p in parts], np.float32)
        mean_part = (error / sizes)[owner, None] * self.top[:FILTERS]
        peak = pooled == h[:, FILTERS:][owner]
        max_part = error[owner, None] * self.top[FILTERS:] * peak / np.maximum(np.add.reduceat(peak, starts)[owner], 1)
        g = ((mean_part + max_part) * (raw + self.shift > 0)).astype(np.float32)
        at = best[:, :, None] * STRIDE + np.arange(WIDTH)
        used = rows[np.arange(len(rows))[:, None, None], at]
        x = self.bytes[used].reshape(len(rows), FILTERS, WIDTH * VECTOR)
        to_filters = np.einsum("cf,cfk->kf", g, x)
        to_bytes = np.zeros_like(self.bytes)
        back = g[:, :, None, None] * self.filters.T.reshape(1, FILTERS, WIDTH, VECTOR)
        for v in range(VECTOR):
            to_bytes[:, v] = np.bincount(used.ravel(), back[..., v].ravel(), 256)
        return to_bytes, to_filters, g.sum(0), h.T @ error, np.array([error.sum()])


def train_network(docs: DataFrame, labels: DataFrame) -> Network | float:
    """A network trained on at most ``TRAIN_DOCS`` labelled documents that are not held out.

    If they have one label only, or none, the answer is a constant: the share of label 1, smoothed by
    one document of either label.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", 5))
    one = usable.groupBy("doc_id").agg(F.max("quality").alias("label"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    # The sample's bound is TRAIN_DOCS rows, so it may be broadcast.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("label").alias("label"))
        .orderBy("doc_id")
        .collect()
    )
    y = np.array([r["label"] for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        return float((y.sum() + 1) / (len(y) + 2))
    network = Network()
    network.train([r["text"].encode() for r in rows], y)
    return network


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each row of ``docs``.

    ``held_out`` rows (crc32 of the id as text is a multiple of 5) never teach a label. Null and empty
    texts are scored as one chunk of zero bytes. A null doc_id counts as empty text, which is held
    out. Of repeated labels the higher counts, of repeated training documents the least text. Other
    columns are ignored; an empty table gives no rows.
    """
    network = docs.sparkSession.sparkContext.broadcast(train_network(docs, labels))

    def work(batch: pa.RecordBatch) -> dict:
        model, found = network.value, utf8_bytes(batch["text"])
        scores = np.full(len(found), model) if isinstance(model, float) else _in_parts(model, found)
        return {
            "doc_id": batch["doc_id"],
            "held_out": batch["held_out"],
            "score": pa.array(scores, pa.float64()),
            "predicted": pa.array((scores >= THRESHOLD).astype(np.int32)),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", held_out("doc_id", 5).alias("held_out"))
    return by_batch(rows, f"doc_id {kind}, held_out boolean, score double, predicted int", work)


def _in_parts(model: Network, found: list[bytes], limit: int = 2_000_000) -> np.ndarray:
    """Scores of many texts, some megabytes at a time."""
    out: list[np.ndarray] = []
    part: list[bytes] = []
    size = 0
    for t in found:
        part.append(t)
        size += len(t) + CHUNK
        if size >= limit:
            out.append(model.predict(part))
            part, size = [], 0
    if part:
        out.append(model.predict(part))
    return np.concatenate(out)
