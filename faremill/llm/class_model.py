"""Class-based bigram language model: exchange clustering, smoothed scores.

P(word | previous word) = P(class of word | class of previous word) * P(word | its class).

1. Texts are read once and stored as numbers of words, in blocks of bounded size that number their own
   words. A block's words stand beside it in one list for each bucket of words.
2. Words are counted over all training texts.
3. The ``CORE`` most frequent words are clustered: each is moved to the class that raises the
   likelihood of the class bigrams most, again and again, until a sweep moves none. What this
   needs is a matrix of ``CORE`` by ``CORE`` counts, whatever the size of the corpus.
4. Every other training word is put, by the same criterion, into the class that fits the classes
   of the core words it follows. This takes all training texts, so no word is left out.
5. All words have a class now. In ``ROUNDS`` sweeps over the corpus every word outside the core is moved to
   the class that fits the classes of all its neighbours, before and after it, best. They move at
   once, as in distributed exchange; each word has neighbours, as text ends count.
6. Class bigrams are counted over all training texts and used to score all texts.

The vocabulary grows with the corpus and is never broadcast: a bucket holds bounded shares of it and of the
blocks' lists. Between blocks and buckets go one row for each pair of them, not one for each word.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from faremill.llm.common import by_batch, held_out, stored

#: Words that are clustered by exchange, and the number of classes; the last class is the text end.
CORE, CLASSES = 1_024, 64
END_CLASS, UNKNOWN = CLASSES - 1, CLASSES
SWEEPS = 20
#: Sweeps over the words outside the core; each reads the training texts once more.
ROUNDS = 1
#: Additive constant for counts, and the weight of the class frequencies in the transitions.
ADDED, PRIOR = 0.1, 20.0
#: UTF-8 bytes of text in a block at most, and for each bucket of words on average.
BLOCK_BYTES, BUCKET_BYTES = 32_000_000, 8_000_000
#: Words whose gains are summed at a time.
AT_ONCE = 1_024
#: Added to the class of a word that stays where it is.
PLACED = 2 * CLASSES


class Corpus(NamedTuple):
    """Texts as numbers of words, and the blocks' own words.

    ``texts`` has ``doc_id``, ``held_out``, ``block`` and ``ids``, the place of each word among the block's. ``words`` has
    for a ``block`` and a ``bucket`` the place ``first`` of the first word, the ``words`` with a space
    between, and how often training texts have them, ``c``.
    """

    texts: DataFrame
    words: DataFrame
    buckets: int


def _let_go(spark: SparkSession) -> None:
    """Shuffle files go once the driver's garbage is collected; called where all that is needed is stored."""
    gc.collect()
    spark._jvm.System.gc()


def _split(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and the words of all, A-Z lowered. Arrow's ASCII functions take any bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.view(pa.string()).fill_null("")))
    found = lists.flatten()
    # White space at either end of a text leaves an empty word there.
    whole = pc.greater(pc.binary_length(found), 0)
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    return np.bincount(row[whole.to_numpy(zero_copy_only=False)], minlength=len(lists)), found.filter(whole).view(pa.binary())


def _packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of the next ``sizes`` values in each row."""
    ends = np.concatenate(([0], np.cumsum(sizes))) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())]
    )


def _unpacked(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _in_blocks(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """What a task reads, in tables of ``limit`` bytes at most or of one row."""
    taken, size = [], 0
    for batch in batches:
        start = 0
        for row, n in enumerate(pc.binary_length(batch["text"]).fill_null(0).to_pylist()):
            if size and size + n + 8 > limit:
                yield pa.Table.from_batches([*taken, batch.slice(start, row - start)])
                taken, size, start = [], 0, row
            size += n + 8
        taken.append(batch.slice(start))
    if size:
        yield pa.Table.from_batches(taken)


def _coded(texts: DataFrame) -> Corpus:
    """``texts`` with ``doc_id``, ``text``, ``held_out``; stored, as another reading may come in other blocks."""
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, limit = int(size // BUCKET_BYTES) + 1, BLOCK_BYTES
    kind = texts.schema["doc_id"].dataType
    wanted = pa.schema(
        [
            ("block", pa.int64()), ("doc_id", to_arrow_type(kind)), ("held_out", pa.bool_()), ("ids", pa.binary()),
            ("bucket", pa.int32()), ("first", pa.int32()), ("words", pa.binary()), ("c", pa.binary()),
        ]
    )

    def rows(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({f.name: columns.get(f.name, pa.nulls(n, f.type)) for f in wanted}, schema=wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in enumerate(_in_blocks(batches, limit)):
            block = (TaskContext.get().partitionId() << 32) + number
            sizes, found = _split(table["text"])
            coded = found.dictionary_encode()
            names = coded.dictionary.to_pylist()
            bucket = np.fromiter(map(zlib.crc32, names), np.int64, len(names)) % buckets
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(names), np.uint32)
            place[order] = np.arange(len(names))
            ids = place[coded.indices.to_numpy()]
            train = np.repeat(~table["held_out"].to_numpy(), sizes)
            c = np.bincount(ids[train], minlength=len(names)).astype(np.uint32)
            doc_id, held = (table[name].combine_chunks() for name in ("doc_id", "held_out"))
            own = {"block": pa.array([block] * len(sizes), pa.int64()), "doc_id": doc_id, "held_out": held}
            yield rows({**own, "ids": _packed(ids, sizes)}, len(sizes))
            used, first, n = np.unique(bucket[order], return_index=True, return_counts=True)
            lists = [b" ".join([names[i] for i in order[at : at + m]]) for at, m in zip(first, n, strict=True)]
            own = {"block": pa.array([block] * len(used), pa.int64()), "bucket": pa.array(used.astype(np.int32))}
            own |= {"first": pa.array(first.astype(np.int32)), "words": pa.array(lists, pa.binary())}
            yield rows({**own, "c": _packed(c, n)}, len(used))

    schema = (
        f"block bigint, doc_id {kind.simpleString()}, held_out boolean, ids binary, "
        "bucket int, first int, words binary, c binary"
    )
    coded = stored(texts.select("doc_id", "text", "held_out").mapInArrow(run, schema), "coded", "zstd")
    return Corpus(
        coded.where("bucket is null").select("block", "doc_id", "held_out", "ids"),
        coded.where("bucket is not null").select("block", "bucket", "first", "words", "c"),
        buckets,
    )


def _count_words(corpus: Corpus) -> DataFrame:
    """``word``, ``c`` of the words of training texts."""

    def run(lists: pa.Table) -> pa.Table:
        coded = _split(lists["words"])[1].dictionary_encode()
        c = np.bincount(coded.indices.to_numpy(), _unpacked(lists["c"], np.uint32), len(coded.dictionary))
        return pa.table({"word": coded.dictionary.filter(pa.array(c > 0)), "c": pa.array(c[c > 0].astype(np.int64))})

    return corpus.words.groupBy("bucket").applyInArrow(run, "word binary, c bigint")


def _core_codes(corpus: Corpus, core: dict[bytes, int]) -> DataFrame:
    """For each of the blocks' lists, the ``code`` of its words: as ``core`` has it, or -1."""
    names, values = pa.array(list(core), pa.binary()), np.array([*core.values(), -1], np.int16)

    def run(batch: pa.RecordBatch) -> dict:
        sizes, found = _split(batch["words"])
        code = values[pc.index_in(found, names).fill_null(-1).to_numpy()]
        return {**{c: batch[c] for c in ("block", "bucket", "first")}, "code": _packed(code, sizes)}

    lists = corpus.words.select("block", "bucket", "first", "words")
    return by_batch(lists, "block bigint, bucket int, first int, code binary", run)


def _looked_up(corpus: Corpus, vocabulary: DataFrame, columns: dict[str, type]) -> DataFrame:
    """For each of the blocks' lists, what ``vocabulary`` has for its words in ``columns``, or -1."""
    known = vocabulary.where(F.octet_length("word") > 0).select(
        (F.crc32("word") % corpus.buckets).cast("int").alias("bucket"), "word", *columns
    )

    def run(lists: pa.Table, known: pa.Table) -> pa.Table:
        sizes, found = _split(lists["words"])
        at = pc.index_in(found, known["word"].combine_chunks()).fill_null(-1).to_numpy()
        own = {c: lists[c] for c in ("block", "bucket", "first")}
        return pa.table(own | {c: _packed(np.append(known[c].to_numpy(), -1).astype(k)[at], sizes) for c, k in columns.items()})

    schema = "block bigint, bucket int, first int, " + ", ".join(f"{c} binary" for c in columns)
    lists = corpus.words.select("block", "bucket", "first", "words")
    return lists.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(run, schema)


def _in_a_row(block: pa.Table, end: int) -> np.ndarray:
    """The ids of a block's words; ``end`` stands before the first text and after each."""
    texts = block["ids"].to_pylist()
    ends = np.cumsum([0, *(len(t) // 4 + 1 for t in texts)])
    row = np.full(ends[-1] + 1, end, np.int64)
    inside = np.ones(len(row), bool)
    inside[ends] = False
    row[inside] = np.frombuffer(b"".join(texts), np.uint32)
    return row


def _core_bigrams(corpus: Corpus, core: dict[bytes, int]) -> np.ndarray:
    """Counts of neighbours within the core, whose words count from 1; the end, 0, stands before and after each text."""
    size = len(core) + 1

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        code = np.append(_unpacked(known.sort_by("first")["code"], np.int16), 0).astype(np.int64)
        code = code[_in_a_row(block, len(code) - 1)]
        both = (code[:-1] >= 0) & (code[1:] >= 0)
        total = np.bincount(code[:-1][both] * size + code[1:][both], minlength=size * size)
        cells = np.flatnonzero(total)
        return pa.table({"cell": pa.array(cells), "c": pa.array(total[cells])})

    train, codes = corpus.texts.where("not held_out"), _core_codes(corpus, core)
    rows = train.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(run, "cell bigint, c bigint")
    found = rows.groupBy("cell").agg(F.sum("c").alias("c")).toPandas()
    matrix = np.zeros(size * size)
    matrix[found["cell"].to_numpy(np.int64)] = found["c"].to_numpy(np.float64)
    return matrix.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(matrix: np.ndarray, end: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each core word, from their bigram counts; word ``end`` has the last class to itself."""
    size = len(matrix)
    order = np.argsort(-(matrix.sum(0) + matrix.sum(1)), kind="stable")
    place = np.zeros(size, np.int64)
    place[order] = np.arange(size) % max(1, classes - 1)
    place[end] = classes - 1
    member = np.eye(classes)[place]
    table = member.T @ matrix @ member
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if w == end:
                continue
            member[w] = 0
            right, left, own = matrix[w] @ member, matrix[:, w] @ member, matrix[w, w]
            old = place[w]
            table[old] -= right
            table[:, old] -= left
            table[old, old] -= own
            cell = np.diagonal(table)
            gain = (_xlogx(table + right) - _xlogx(table)).sum(1) + (_xlogx(table.T + left) - _xlogx(table.T)).sum(1)
            gain -= _xlogx(cell + right) + _xlogx(cell + left) - 2 * _xlogx(cell)
            gain += _xlogx(cell + right + left + own) - _xlogx(cell)
            rows, columns = table.sum(1), table.sum(0)
            gain -= _xlogx(rows + right.sum() + own) - _xlogx(rows)
            gain -= _xlogx(columns + left.sum() + own) - _xlogx(columns)
            gain[classes - 1] = -np.inf
            new = int(np.argmax(gain)) if gain.max() > gain[old] + 1e-9 else old
            place[w], member[w, new] = new, 1
            table[new] += right
            table[:, new] += left
            table[new, new] += own
            moved += new != old
        if not moved:
            break
    return place


def _neighbours(corpus: Corpus, codes: DataFrame, after: bool = True) -> DataFrame:
    """For each of the blocks' lists: ``n``, how many neighbours with a class its words have, and these in ``near``.

    ``codes`` gives the classes of words, with ``PLACED`` added for those that stay and have no neighbours here.
    A neighbour is a byte, its class if it stands before the word, that plus ``CLASSES`` if after it, which
    ``after`` can leave out. One more row of a block, of bucket -1, has its counts of class bigrams.
    """

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("first")
        code = np.append(_unpacked(known["code"], np.int16), PLACED + END_CLASS).astype(np.int64)
        row = _in_a_row(block, len(code) - 1)
        cls = np.where(code < 0, -1, code % PLACED)[row]
        both = (cls[:-1] >= 0) & (cls[1:] >= 0)
        table = np.bincount(cls[:-1][both] * CLASSES + cls[1:][both], minlength=CLASSES * CLASSES)
        moved = np.flatnonzero(code[row] < PLACED)
        at, previous = row[moved] * PLACED, cls[moved - 1]
        near = (at + previous)[previous >= 0]
        if after:
            following = cls[moved + 1]
            near = np.concatenate([near, (at + CLASSES + following)[following >= 0]])
        near.sort()
        n = np.bincount(near // PLACED, minlength=len(code) - 1).astype(np.uint32)
        sizes = np.array([len(c) // 2 for c in known["code"].to_pylist()], np.int64)
        ends = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))[np.concatenate(([0], np.cumsum(sizes)))]
        first = block["block"] if block.num_rows else known["block"]
        lists = pa.table(
            {
                "block": known["block"], "bucket": known["bucket"],
                "n": _packed(n, sizes), "near": _packed((near % PLACED).astype(np.uint8), np.diff(ends)),
            }
        )
        counts = {"block": first[:1], "bucket": pa.array([-1], pa.int32()), "n": pa.array([b""]), "near": pa.array([table.tobytes()])}
        return pa.concat_tables([lists, pa.table(counts)])

    train = corpus.texts.where("not held_out")
    schema = "block bigint, bucket int, n binary, near binary"
    return train.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(run, schema)


def _class_bigrams(near: DataFrame) -> np.ndarray:
    """The sum of the blocks' counts; each task adds up its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for counts in batch["near"].to_pylist():
                total += np.frombuffer(counts, np.int64)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "c": pa.array(total[cells])})

    rows = near.where("bucket < 0").select("near").mapInArrow(run, "cell bigint, c bigint")
    found = rows.groupBy("cell").agg(F.sum("c").alias("c")).toPandas()
    counts = np.zeros(CLASSES * CLASSES)
    counts[found["cell"].to_numpy(np.int64)] = found["c"].to_numpy(np.float64)
    return counts.reshape(CLASSES, CLASSES)


def _fit(table: np.ndarray) -> np.ndarray:
    return np.log((table + ADDED) / np.outer(table.sum(1) + 1, table.sum(0) + 1))


def _best_classes(corpus: Corpus, near: DataFrame, gains: np.ndarray) -> DataFrame:
    """``word``, ``cls``: where the ``gains`` of a word's neighbours add up to most, for words that have any."""

    def run(lists: pa.Table, near: pa.Table) -> pa.Table:
        lists, near = lists.sort_by("block"), near.sort_by("block")
        coded = _split(lists["words"])[1].dictionary_encode()
        word = np.repeat(coded.indices.to_numpy().astype(np.int64), _unpacked(near["n"], np.uint32))
        seen = np.sort(word * PLACED + _unpacked(near["near"], np.uint8))
        found, best = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        bounds = np.arange(0, len(coded.dictionary) + AT_ONCE, AT_ONCE)
        for part in np.split(seen, np.searchsorted(seen, bounds[1:-1] * PLACED)):
            cells, c = np.unique(part, return_counts=True)
            words, starts = np.unique(cells // PLACED, return_index=True)
            if len(words):
                found.append(words)
                best.append(np.add.reduceat(gains[cells % PLACED] * c[:, None], starts, axis=0).argmax(1))
        names = coded.dictionary.take(pa.array(np.concatenate(found)))
        return pa.table({"word": names, "cls": pa.array(np.concatenate(best).astype(np.int32))})

    lists, rows = corpus.words.select("bucket", "block", "words"), near.where("bucket >= 0")
    return lists.groupBy("bucket").cogroup(rows.groupBy("bucket")).applyInArrow(run, "word binary, cls int")


def _place_others(corpus: Corpus, core: dict[bytes, int], table: np.ndarray) -> DataFrame:
    """``word``, ``cls`` of the words outside the core that follow a core word somewhere; ``core`` gives the class."""
    codes = _core_codes(corpus, {w: g + PLACED for w, g in core.items()})
    near = stored(_neighbours(corpus, codes, after=False), "near", "zstd")
    _let_go(near.sparkSession)
    return _best_classes(corpus, near, _fit(table)[:, :END_CLASS])


def _sweep(train: Corpus | DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``word``, ``cls`` of all words outside the core, from the classes of all their neighbours.

    ``vocabulary`` has ``word``, ``cls`` and ``placed`` for those in the core; a table of training texts is coded first.
    """
    if not isinstance(train, Corpus):
        train = _coded(train.select(F.lit(0).alias("doc_id"), "text", F.lit(False).alias("held_out")))
    code = F.col("cls") + F.when(F.col("placed"), PLACED).otherwise(0)
    codes = _looked_up(train, vocabulary.select("word", code.alias("code")), {"code": np.int16})
    near = stored(_neighbours(train, codes), "near", "zstd")
    _let_go(vocabulary.sparkSession)
    fit = _fit(_class_bigrams(near))
    return _best_classes(train, near, np.vstack([fit, fit.T])[:, :END_CLASS])


def _encoded(
    corpus: Corpus, vocabulary: DataFrame, base: tuple[int, int], ends: int, totals: dict[int, tuple[int, int]]
) -> DataFrame:
    """Per text: counts, base score, log10 of the emissions, and the class of each token as a byte.

    ``base`` has the number of training tokens and of distinct ones, ``ends`` that of training texts.
    """
    count, distinct = base
    known = _looked_up(corpus, vocabulary, {"cls": np.int16, "c": np.int64})
    kind = corpus.texts.schema["doc_id"].dataType
    schema = (
        f"doc_id {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, "
        "base_score double, emission double, classes binary"
    )
    wanted = pa.schema(
        [
            ("doc_id", to_arrow_type(kind)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("base_score", pa.float64()), ("emission", pa.float64()), ("classes", pa.binary()),
        ]
    )

    def score(block: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("first")
        c = np.append(np.maximum(_unpacked(known["c"], np.int64), 0), ends).astype(np.float64)
        g = np.where(c > 0, np.append(_unpacked(known["cls"], np.int16), END_CLASS), UNKNOWN).astype(np.int64)
        held, kinds = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
        for at, (n, v) in totals.items():
            held[at], kinds[at] = n, v
        low = np.log10((c + ADDED) / (count + ADDED * (distinct + 1)))
        emitted = np.where(g == UNKNOWN, 0.0, np.log10((c + ADDED) / (held[g] + ADDED * (kinds[g] + 1))))
        letters = g.astype(np.uint8)
        rows: dict[str, list] = {"n_tokens": [], "n_known": [], "base_score": [], "emission": [], "classes": []}
        for text in block["ids"].to_pylist():
            ids = np.append(np.frombuffer(text, np.uint32), len(c) - 1)
            rows["n_tokens"].append(len(ids))
            rows["n_known"].append(int((c[ids] > 0).sum()))
            rows["base_score"].append(float(low[ids].sum()))
            rows["emission"].append(float(emitted[ids].sum()))
            rows["classes"].append(letters[ids].tobytes())
        return pa.table({"doc_id": block["doc_id"], "held_out": block["held_out"], **rows}, schema=wanted)

    return corpus.texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, schema)


def _transitions(encoded: DataFrame) -> np.ndarray:
    """Counts of class bigrams over the training texts."""
    side = CLASSES + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            for text in batch["classes"].to_pylist():
                g = np.frombuffer(text, np.uint8).astype(np.int64)
                total += np.bincount(np.concatenate(([END_CLASS], g[:-1])) * side + g, minlength=side * side)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "c": pa.array(total[cells])})

    rows = encoded.where("not held_out").select("classes").mapInArrow(run, "cell bigint, c bigint")
    found = rows.groupBy("cell").agg(F.sum("c").alias("c")).toPandas()
    counts = np.zeros(side * side)
    counts[found["cell"].to_numpy(np.int64)] = found["c"].to_numpy(np.float64)
    return counts.reshape(side, side)


def log_transitions(counts: np.ndarray, totals: dict[int, tuple[int, int]]) -> np.ndarray:
    """log10 of P(class | class before); the last column is that of meeting any unknown word.

    A class's successors are smoothed by the frequencies of all classes, and the share that each
    class keeps for unknown words is summed over the classes.
    """
    held = np.array([totals.get(g, (0, 0))[0] for g in range(CLASSES)], np.float64)
    kinds = np.array([totals.get(g, (0, 0))[1] for g in range(CLASSES)], np.float64)
    prior = (held + ADDED) / (held + ADDED).sum()
    seen = counts[:, :CLASSES]
    chance = (seen + PRIOR * prior) / (seen.sum(1, keepdims=True) + PRIOR)
    unknown = chance @ (ADDED / (held + ADDED * (kinds + 1)))
    return np.log10(np.column_stack([chance, unknown]))


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of all texts under a model learned from those that are not held out.

    Gives ``doc_id``, ``held_out`` (crc32 of the id as text is a multiple of 10), ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score`` (unigrams), ``score`` and ``perplexity`` for each
    row. Tokens are the words of the text, A-Z lowered, and one end. Null and empty texts have the end
    alone. A null doc_id counts as empty text for the split, so it is held out. Repeated rows count
    as often as they occur. Without training texts all words are unknown. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    corpus = _coded(docs.select("doc_id", "text", held_out("doc_id", 10).alias("held_out")))
    words = stored(_count_words(corpus), "words", "zstd")
    _let_go(spark)
    # Each training text has one end, a token beside its words.
    ends = corpus.texts.where("not held_out").count()
    count, distinct = words.select(F.coalesce(F.sum("c"), F.lit(0)) + ends, F.count("*") + int(ends > 0)).first()

    top = words.orderBy(F.desc("c"), "word").limit(CORE).collect()
    core = {bytes(r["word"]): i for i, r in enumerate(top, 1)}
    matrix = _core_bigrams(corpus, core)
    place = exchange(matrix, 0)
    member = np.eye(CLASSES)[place]
    placed = {w: int(place[i]) for w, i in core.items()}

    _let_go(spark)
    known = spark.createDataFrame([(bytearray(w), g) for w, g in placed.items()], "word binary, cls int")
    others = _place_others(corpus, placed, member.T @ matrix @ member)
    known, cls = known.withColumn("placed", F.lit(True)), F.coalesce("cls", F.lit(0)).alias("cls")
    for step in range(ROUNDS + 1):
        found = known.unionByName(others.withColumn("placed", F.lit(False)))
        vocabulary = stored(
            words.join(found, "word", "left").select("word", "c", cls, F.coalesce("placed", F.lit(False)).alias("placed")),
            "vocabulary",
            "zstd",
        )
        del others, found
        _let_go(spark)
        if step < ROUNDS:
            others = _sweep(corpus, vocabulary)
    totals = {r[0]: (r[1], r[2]) for r in vocabulary.groupBy("cls").agg(F.sum("c"), F.count("*")).collect()}
    if ends:
        totals[END_CLASS] = (ends, 1)
    encoded = stored(_encoded(corpus, vocabulary, (count, distinct), ends, totals), "encoded", "zstd")
    _let_go(spark)
    steps = log_transitions(_transitions(encoded), totals)

    def finish(batch: pa.RecordBatch) -> dict:
        total = []
        for text, emission in zip(batch["classes"].to_pylist(), batch["emission"].to_pylist(), strict=True):
            g = np.frombuffer(text, np.uint8).astype(np.int64)
            total.append(emission + float(steps[np.concatenate(([END_CLASS], g[:-1])), g].sum()))
        kept = {c: batch[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score")}
        return {**kept, "score": pa.array(total, pa.float64())}

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    return (
        by_batch(encoded, schema, finish)
        .withColumn("train_tokens", F.lit(count).cast("long"))
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
        .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
    )
