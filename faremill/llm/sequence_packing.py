"""Packing documents into sequences: best-fit decreasing with certified bin counts.

Pieces are dealt evenly to parts of bounded size and each part is packed by best-fit decreasing.
Dual feasible functions bound from below how many sequences any packing of the part needs; a part
that reaches its bound is certified, and all but its emptiest sequence are final. Parts with a gap
exchange their pieces, and those of the emptiest sequences: all are dealt anew, to as few parts as
they need, and packed again. A round counts if it saves sequences; rounds end when what is left
reaches the bound of one whole packing.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faremill.llm.common import by_batch, enter, small_batches, stored

CAPACITY = 4096
#: Id that ends a document.
END = 1
#: Pieces packed together. Bounds a task's memory; a larger part wastes less before the exchange.
PART = 50_000
#: Exchanges at most. All pieces are placed whatever the number.
ROUNDS = 8
#: Chunks (and words) of text whose ids a worker keeps, and the longest it keeps. Results do not depend on them.
KEPT_CHUNKS, LONGEST_KEPT = 600_000, 64
#: Bytes of text that share one numbering of chunks.
BATCH_BYTES = 8 << 20
#: Dual feasible functions tried of each family that has a parameter.
FUNCTIONS = 64


# The rules of the tokenizer for which the shortcuts below hold.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SUFFIX = "</w>"
#: Lead bytes of all characters below U+0300; texts of these alone have no combining marks.
_BELOW_MARKS = bytes(range(0xCC))
_DOTTED_I = "\u0130".encode()
_AROUND = re.compile(r"([^\w\s']*)([^\W\d_]+)([^\w\s']*)")


class ChunkEncoder:
    """Ids of texts whose tokenizer drops white space and lets nothing reach across it.

    Every chunk between white space is encoded once and kept. Where the tokenizer lower-cases, splits
    letters from other signs and marks the ends of words, texts are lower-cased first, a chunk that
    is a word between signs is put together from theirs, and new words are encoded many at a time.
    """

    def __init__(self, model: str):
        self.tokenizer = Tokenizer.from_str(model)
        self._known: dict[bytes, bytes] = {}
        self._parts: dict[str, bytes] = {}
        rules = json.loads(model)
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        lowers = any(n["type"] == "Lowercase" for n in (rules.get("normalizer") or {}).get("normalizers", []))
        splits = any(x["type"] == "Split" and x["pattern"].get("Regex") == _SPLIT for x in steps)
        self._shortcuts = lowers and splits and rules["model"].get("end_of_word_suffix") == _SUFFIX
        self._ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for piece, number in self.tokenizer.get_vocab().items():
            self._ends[number] = piece.endswith(_SUFFIX)

    def _each(self, chunks: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words, which end where a piece ends a word."""
        for start in range(0, len(words), 500):
            part = words[start : start + 500]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) != len(part):
                yield from self._each(part)
                continue
            raw, at = ids.tobytes(), 0
            for end in (4 * ends).tolist():
                yield raw[at:end]
                at = end

    def _new(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        if not self._shortcuts:
            return dict(zip(chunks, self._each([c.decode() for c in chunks]), strict=True))
        plain, split, rest = [], {}, []
        for c in chunks:
            if c.isalpha():
                plain.append(c)
            elif not c.translate(None, _BELOW_MARKS) and _DOTTED_I not in c and (m := _AROUND.fullmatch(c.decode())) and m[2].isalpha():
                split[c] = m.groups()
            else:
                rest.append(c)
        found = dict(zip(plain, self._words(b" ".join(plain).decode().split(" ")), strict=True)) if plain else {}
        found.update(zip(rest, self._each([c.decode() for c in rest]), strict=True))
        new = set().union(*split.values()).difference(self._parts)
        words, signs = [p for p in new if p.isalpha()], [p for p in new if p and not p.isalpha()]
        if len(self._parts) + len(new) > KEPT_CHUNKS:
            self._parts = {p: self._parts[p] for three in split.values() for p in three if p in self._parts}
        self._parts[""] = b""
        self._parts.update(zip(words, self._words(words), strict=True))
        self._parts.update(zip(signs, self._each(signs), strict=True))
        ids = self._parts
        found.update((c, ids[before] + ids[word] + ids[after]) for c, (before, word, after) in split.items())
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (nulls are empty), and where each text's ids begin and end.

        The chunks of a batch are numbered by Arrow, so that only distinct ones are looked up, and their ids
        are gathered by number.
        """
        texts = pc.fill_null(texts, "")
        if self._shortcuts:
            # "<|" may begin a special token, whose case counts.
            low = [not t.translate(None, _BELOW_MARKS) and b"<|" not in t for t in texts.cast(pa.binary()).to_pylist()]
            texts = pc.if_else(pa.array(low, pa.bool_()), pc.ascii_lower(texts), texts)
        split = pc.ascii_split_whitespace(texts)
        numbered = split.flatten().dictionary_encode()
        distinct = numbered.dictionary.cast(pa.binary()).to_pylist()
        found = self._new([c for c in distinct if c not in self._known])
        if len(self._known) + len(found) > KEPT_CHUNKS:
            # What this batch shares with those before it is worth keeping.
            self._known = {c: self._known[c] for c in distinct if c in self._known}
        self._known.update(found)
        ids = [self._known[c] for c in distinct]
        for c in found:
            if len(c) > LONGEST_KEPT:
                del self._known[c]
        if not ids:
            return np.empty(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        flat, size = np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64)
        number = numbered.indices.to_numpy()
        sizes = size[number]
        ends = np.cumsum(sizes)
        shift = (np.cumsum(size) - size)[number] - (ends - sizes)
        gathered = flat[np.repeat(shift, sizes) + np.arange(len(shift) and ends[-1])]
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return gathered, bounds


_encoders: dict[int, ChunkEncoder] = {}


def _let_go() -> None:
    _encoders.clear()


def _encoder(model: str) -> ChunkEncoder:
    """One for each Python worker, kept over its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are what runs side by side
    key = hash(model)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(model)
    return _encoders[key]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked, ``ids`` (packed) of each piece.

    A document is its ids and ``END``; only one longer than ``capacity`` is cut, and only its last
    piece may be shorter. Null and empty texts are one piece of one id. Each of repeated rows gives
    its own pieces, a null doc_id stays null, other columns are ignored, an empty table gives no
    rows. ``tokenizer`` is the path of a ``tokenizers`` file (some megabytes), which the driver reads
    and broadcasts. The tokenizer must drop ASCII white space and let no rule reach across it, as
    lower-casing word tokenizers do; then chunks between white space can be encoded apart.
    """
    small_batches(docs.sparkSession, BATCH_BYTES)
    with open(tokenizer, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    size = 4 * capacity

    def work(batch: pa.RecordBatch) -> dict:
        enter(__name__, _let_go)
        flat, bounds = _encoder(model.value).encode(batch["text"])
        rows, piece, start, ids = [], [], [], []
        end = np.array([END], "<u4")
        for row in range(batch.num_rows):
            found = np.concatenate([flat[bounds[row] : bounds[row + 1]], end]).tobytes()
            for number, at in enumerate(range(0, len(found), size)):
                rows.append(row)
                piece.append(number)
                start.append(at // 4)
                ids.append(found[at : at + size])
        columns = {
            "doc_id": batch["doc_id"].take(pa.array(rows, pa.int64())),
            "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()),
            "length": pa.array([len(x) // 4 for x in ids], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
        }
        return columns | ({"ids": pa.array(ids, pa.binary())} if keep_ids else {})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return by_batch(docs.select("doc_id", "text"), schema, work)


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """A lower bound on the sequences that ``counts[length]`` pieces of each length need.

    The best of three families of dual feasible functions, which give every piece a weight such
    that no sequence can hold more than 1: lengths with the short ones left out and the long ones
    counted whole; lengths rounded to multiples of 1 / k; and pieces above a half counted by what
    they leave free.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    n = counts.astype(np.int64)
    number, total = np.cumsum(n), np.cumsum(n * x)
    short = np.arange(1, capacity // 2 + 1)
    over = number[-1] - number[capacity - short]
    middle = total[capacity - short] - total[short - 1]
    best = max(-(-int(total[-1]) // capacity), int((over - (-middle // capacity)).max(initial=0)))
    for k in range(1, FUNCTIONS):
        whole = (k + 1) * x % capacity == 0
        weight = np.where(whole, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((weight * n).sum()) // (capacity * k)))
    for part in range(2, FUNCTIONS):
        e = -(-capacity // part)
        slots = capacity // e
        weight = np.where(2 * x > capacity, slots - (capacity - x) // e, np.where(x >= e, 1, 0))
        best = max(best, -(-int((weight * n).sum()) // slots))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, and the room left in each sequence.

    Pieces go in order of falling length to the fullest sequence that can take them. A bit for
    each amount of room says whether a sequence has just that much.
    """
    order = np.argsort(-lengths, kind="stable")
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, rooms = 0, []
    at, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            room, place = capacity, len(rooms)
            rooms.append(capacity)
        at[i], offset[i] = place, capacity - room
        rooms[place] = left = room - size
        if left:
            if not by_room[left]:
                open_rooms |= 1 << left
            by_room[left].append(place)
    return at, offset, np.array(rooms, np.int64)


def _packed(pool: DataFrame, parts: int, turn: int, capacity: int) -> DataFrame:
    """Each piece of ``pool`` (``nr``, ``size``) with its sequence, offset, and whether it is up for exchange."""

    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table["nr"].to_numpy())
        nr, size = table["nr"].to_numpy()[order], table["size"].to_numpy()[order]
        at, offset, room = best_fit(size, capacity)
        heads = np.empty(len(room), np.int64)
        heads[at[offset == 0]] = nr[offset == 0]
        if parts == 1:
            exchanged = np.zeros(len(room), bool)
        elif len(room) == least_sequences(np.bincount(size, minlength=capacity + 1), capacity):
            exchanged = np.arange(len(room)) == room.argmax()
            exchanged &= room > 0
        else:
            exchanged = np.ones(len(room), bool)
        return pa.table({"nr": nr, "size": size, "sequence_id": heads[at], "offset": offset, "open": exchanged[at]})

    dealt = pool.select("nr", "size", F.pmod(F.xxhash64("nr", F.lit(turn)), F.lit(parts)).alias("part"))
    return dealt.groupBy("part").applyInArrow(pack, "nr bigint, size bigint, sequence_id bigint, offset bigint, open boolean")


def _fresh(name: str, taken: list[str]) -> str:
    return name if name not in taken else _fresh(f"_{name}", taken)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, part: int = PART, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (any columns, among them ``length``) with ``sequence_id`` and ``offset``.

    Sequences are filled from 0 without gaps up to ``capacity`` at most and are named by a number
    of their first piece. A length outside 1 to ``capacity``, or null, ends the job with an error.
    Equal rows are separate pieces; columns called ``sequence_id`` or ``offset`` are replaced; an
    empty table gives no rows. Pieces are dealt by their row number, so that equal rows spread; only
    row numbers and lengths move between tasks until all is placed.
    """
    pieces = pieces.drop("sequence_id", "offset")
    nr = _fresh("nr", pieces.columns)
    valid = F.when(F.col("length").between(1, capacity), F.col("length").cast("long"))
    wrong = F.raise_error(F.concat(F.lit("length of a piece: "), F.coalesce(F.col("length").cast("string"), F.lit("null"))))
    rows = stored(pieces.withColumn("length", F.coalesce(valid, wrong.cast("long"))).withColumn(nr, F.monotonically_increasing_id()), "pieces")
    sizes = rows.select(F.col(nr).alias("nr"), F.col("length").alias("size"))
    full = F.col("size") == capacity
    placed = [sizes.where(full).select("nr", F.col("nr").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    pool, best, goal = sizes.where(~full), None, 0
    for turn in range(rounds + 1):
        counts = np.zeros(capacity + 1, np.int64)
        # At most as many rows as there are lengths.
        for size, number in pool.groupBy("size").count().collect():
            counts[size] = number
        number = int(counts.sum())
        goal = least_sequences(counts, capacity)
        if not number or best is not None and best.where("offset = 0").count() == goal:
            break
        parts = -(-number // part)
        found = stored(_packed(pool, parts, turn, capacity), "packed")
        if best is not None:
            if found.where("offset = 0").count() >= best.where("offset = 0").count():
                continue
            placed.pop()
        placed += [found.where("not open"), found.where("open")]
        best = found.where("open")
        pool = best.select("nr", "size")
    where = placed[0].select("nr", "sequence_id", "offset")
    for more in placed[1:]:
        where = where.unionByName(more.select("nr", "sequence_id", "offset"))
    return rows.join(where.withColumnRenamed("nr", nr), nr).drop(nr)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents (see ``token_pieces``) and where they stand (see ``pack_pieces``)."""
    return pack_pieces(token_pieces(docs, tokenizer, capacity, keep_ids), capacity)


def assembled(placed: DataFrame) -> DataFrame:
    """``sequence_id``, ``length`` and packed ``ids`` of each sequence, from placed pieces that carry their ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform("parts", lambda x: x["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", joined.alias("ids")
    )
