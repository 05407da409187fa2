import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faremill.llm import sequence_packing as packing

MODEL = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return [*Tokenizer.from_file(MODEL).encode(text or "", add_special_tokens=False).ids, 1]


def sequences(rows, capacity):
    """Pieces by sequence, checked to stand without gaps up to the capacity."""
    found = {}
    for r in rows:
        found.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in found.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return found


def test_pieces_are_those_of_the_library(spark):
    rng = random.Random(3)
    letters = "aeinrstAEÉ'   \n\t\x0b  中🙂́.,-0123<|>"
    texts = [None, "", " ", "It's <|endoftext|>ok<|startoftext|>", "é ́x ́", "ΑΣ ΣΑΣ. İI", "a" * 9_000, "word " * 5_000, "x\x00y"]
    texts += ["".join(rng.choices(letters, k=rng.randrange(1, 200))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "no id"), (3, texts[3])], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("nr", "_nr", "length", "piece", "ids", "sequence_id", "offset", "part")})
    rows = packing.pack_documents(docs, MODEL).collect()
    found = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    wanted = []
    for doc_id, text in [*enumerate(texts), (None, "no id"), (3, texts[3])]:
        ids = ids_of(text)
        for i, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4").tobytes()
            wanted.append((str(doc_id), i, at, len(part) // 4, zlib.crc32(part)))
    assert found == sorted(wanted)
    sequences(rows, 4096)


def test_sequences_hold_their_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    placed = packing.pack_documents(docs, MODEL, keep_ids=True)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.assembled(placed).collect()}
    rows = placed.collect()
    assert set(whole) == set(sequences(rows, 4096))
    for r in rows:
        assert zlib.crc32(whole[r.sequence_id][r.offset : r.offset + r.length].astype("<u4").tobytes()) == r.ids_crc32


def exact(lengths, capacity):
    """The fewest sequences, by trying all ways to place the pieces."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= lengths[i] and room not in rooms[:j]:
                place(i + 1, [*rooms[:j], room - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_bound_holds_and_best_fit_comes_close():
    rng = random.Random(7)
    reached = 0
    for _ in range(150):
        capacity = rng.choice([10, 12, 30, 31])
        lengths = sorted((rng.randrange(1, capacity) for _ in range(rng.randrange(1, 10))), reverse=True)
        fewest = exact(lengths, capacity)
        bound = packing.least_sequences(np.bincount(lengths, minlength=capacity + 1), capacity)
        at, offset, room = packing.best_fit(np.array(lengths), capacity)
        assert bound <= fewest <= len(room) <= fewest + 1
        assert (capacity - room).sum() == sum(lengths) and (room >= 0).all()
        reached += bound == fewest
    assert reached > 120
    # Half and a bit: the sum of the lengths would allow 6.
    assert packing.least_sequences(np.bincount([6] * 10, minlength=11), 10) == 10


@pytest.mark.parametrize("part", [50_000, 150])
def test_parts_exchange_until_the_bound(spark, part):
    rng = random.Random(part)
    lengths = [min(60, 1 + int(rng.expovariate(1 / 12))) for _ in range(900)]
    pieces = spark.createDataFrame([*enumerate(lengths), *[(-1, 64)] * 3], "nr long, length long")
    rows = packing.pack_pieces(pieces, 64, part).collect()
    assert sorted((r.nr, r.length) for r in rows) == sorted((r.nr, r.length) for r in pieces.collect())
    bound = packing.least_sequences(np.bincount([r.length for r in rows], minlength=65), 64)
    assert len(sequences(rows, 64)) <= bound + (part < 900)


def test_exchange_saves_sequences_that_small_parts_waste(spark):
    rng = random.Random(40)
    pieces = spark.createDataFrame([(i, rng.randrange(1, 60)) for i in range(900)], "k long, length long")
    used = [len(sequences(packing.pack_pieces(pieces, 64, 40, rounds).collect(), 64)) for rounds in (0, 6)]
    assert used[1] < used[0] - 5


def test_equal_rows_spread_and_odd_lengths_fail(spark):
    pieces = spark.createDataFrame([(None, 7)] * 500, "doc_id long, length int")
    rows = packing.pack_pieces(pieces, 64, 100).collect()
    assert len(rows) == 500 and len(sequences(rows, 64)) == 56
    assert packing.pack_pieces(pieces.where("false")).count() == 0
    for wrong in (0, 65, None):
        with pytest.raises(Exception, match="length of a piece"):
            packing.pack_pieces(spark.createDataFrame([(1, wrong)], "doc_id long, length int"), 64).count()


def test_empty_documents(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0
