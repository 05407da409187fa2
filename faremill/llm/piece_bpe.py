"""SentencePiece BPE encoding by a table of last pieces, and decoding.

The encoding of a text's prefix ends in one certain piece. For each prefix that piece is found
among the pieces which an Aho-Corasick automaton sees ending there: it is the one that either is
the whole prefix or may stand after the last piece of the prefix before it. Two pieces may stand
side by side if merging their characters gives the two again. Walking back from the end of the
table gives the ids. The work for a stretch of text is done once: results are kept by word.
"""

from __future__ import annotations

from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from faremill.llm.common import by_batch, enter, texts

SPACE = "▁"
NORMAL, BYTE = 1, 6
#: Words whose ids a worker keeps. The store is emptied when full; results do not depend on it.
KEPT_WORDS = 200_000
#: Texts whose ids are in memory at once; bounds a worker's memory, not the result.
TEXTS = 256


class PieceEncoder:
    """Ids of texts under a BPE model with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, model: bytes, kept_words: int = KEPT_WORDS):
        self.kept_words = kept_words
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback are supported")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only models with identity normalisation and a dummy prefix are supported")
        self.pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.texts = [p.piece for p in proto.pieces]
        self.score = [p.score for p in proto.pieces]
        bytes_ = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_ids = [bytes_[f"<0x{b:02X}>"] for b in range(256)]
        self.begin, self.end = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.near = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self._check_spaces()
        if not all(c in self.pieces for p in self.pieces for c in p):
            raise ValueError("a character of a piece is no piece itself")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.pieces.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.sizes = [len(p) for p in self.texts]
        self._fits: dict[tuple[int, int], bool] = {}
        self._reached: dict[int, bool] = {}
        self._parts: dict[str, tuple[int, ...]] = {}
        self._words: dict[str, bytes] = {}

    def _check_spaces(self) -> None:
        """Spaces only start a piece, or make up a piece that is merged after all others.

        A run of spaces then is encoded by itself: in blocks as long as the longest piece, and a rest.
        """
        runs = {len(p) for p in self.pieces if p == SPACE * len(p)}
        last = [self.score[self.pieces[SPACE * n]] for n in runs if n > 1]
        others = [self.score[i] for p, i in self.pieces.items() if len(p) > 1 and p != SPACE * len(p)]
        inner = [p for p in self.pieces if SPACE in p[1:] and p != SPACE * len(p)]
        if inner or (last and max(last) >= min(others)):
            raise ValueError("the model's pieces with spaces are not of the supported form")
        self.longest_run = max(runs)
        self._runs = {n: self._merged(SPACE * n) for n in range(3 * self.longest_run)}
        for n, parts in self._runs.items():
            blocks, rest = divmod(n, self.longest_run)
            if parts != [SPACE * self.longest_run] * blocks + self._runs[rest]:
                raise ValueError("runs of spaces are not encoded in blocks")

    def _merged(self, text: str) -> list[str]:
        """Merge neighbours, best score first and then leftmost, as the model defines it."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                found = self.pieces.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.score[found] > best[0]):
                    best = (self.score[found], i)
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _fit(self, left: int, right: int) -> bool:
        """Whether merging the characters of two pieces gives the two again."""
        a, b = self.texts[left], self.texts[right]
        found = self._fits[left, right] = self._merged(a + b) == [a, b]
        return found

    def _whole(self, piece: int) -> bool:
        """Whether merging a piece's characters gives the piece."""
        known = self._reached.get(piece)
        if known is None:
            known = self._reached[piece] = self._merged(self.texts[piece]) == [self.texts[piece]]
        return known

    def _table(self, part: str) -> tuple[int, ...]:
        """Ids of a part whose characters are all pieces."""
        last: list[int] = [-1] * (len(part) + 1)
        size_of, fits = self.sizes, self._fits
        for at, piece in self.automaton.iter(part):
            if last[at + 1] < 0:
                start = at + 1 - size_of[piece]
                if start == 0:
                    if self._whole(piece):
                        last[at + 1] = piece
                elif (before := last[start]) >= 0:
                    fit = fits.get((before, piece))
                    if self._fit(before, piece) if fit is None else fit:
                        last[at + 1] = piece
        ids, at = [], len(part)
        while at:
            ids.append(last[at])
            at -= size_of[last[at]]
        return tuple(reversed(ids))

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a chunk, cut where no piece holds the two neighbouring characters."""
        ids: list[int] = []
        start = 0
        for i in range(1, len(chunk) + 1):
            if i < len(chunk) and chunk[i - 1 : i + 1] in self.near:
                continue
            part, start = chunk[start:i], i
            if part not in self._parts:
                if part in self.pieces or len(part) > 1:
                    found = self._table(part)
                else:
                    found = tuple(self.byte_ids[b] for b in part.encode())
                if len(self._parts) >= self.kept_words:
                    self._parts.clear()
                self._parts[part] = found
            ids.extend(self._parts[part])
        return tuple(ids)

    def _word(self, word: str) -> bytes:
        found = array("I", self._chunk(SPACE + word)).tobytes()
        if len(self._words) >= self.kept_words:
            self._words.clear()
        self._words[word] = found
        return found

    def _run(self, spaces: int) -> bytes:
        blocks, rest = divmod(spaces, self.longest_run)
        parts = [SPACE * self.longest_run] * blocks + self._runs[rest]
        return array("I", [self.pieces[p] for p in parts]).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        out = [array("I", [self.begin]).tobytes()]
        if text:
            known, words = self._words, text.replace(SPACE, " ").split(" ")
            if "" not in words:
                out.extend([known.get(w) or self._word(w) for w in words])
            else:
                alone, spaces = array("I", [self.pieces[SPACE]]).tobytes(), 0
                for word in words:
                    if not word:
                        spaces += 1
                        continue
                    ids = known.get(word) or self._word(word)
                    if spaces and ids[:4] == alone:
                        spaces, ids = spaces + 1, ids[4:]
                    out += [self._run(spaces), ids]
                    spaces = 0
                out.append(self._run(spaces))
        out.append(array("I", [self.end]).tobytes())
        return b"".join(out)


_workers: dict[int, tuple[PieceEncoder, sentencepiece.SentencePieceProcessor]] = {}


def _let_go() -> None:
    _workers.clear()


def _tools(model: bytes, kept_words: int):
    """One encoder and one processor for each Python worker, kept over its tasks."""
    key = hash((model, kept_words))
    if key not in _workers:
        _workers[key] = (PieceEncoder(model, kept_words), sentencepiece.SentencePieceProcessor(model_proto=model))
    return _workers[key]


def encode_documents(docs: DataFrame, model_path: str, kept_words: int = KEPT_WORDS) -> DataFrame:
    """``doc_id``, ``ids`` (packed little-endian unsigned 32-bit) and ``decoded`` for each row of ``docs``.

    Reads ``doc_id`` and ``text``; other columns are ignored. Null and empty texts give the begin
    and end ids and an empty decoded text. Repeated rows give repeated results, a null doc_id stays
    null, an empty table gives no rows. The model file (about half a megabyte) is read by the
    driver and broadcast. No rows are moved between tasks. A worker keeps the ids of ``kept_words`` words.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(batch: pa.RecordBatch) -> dict:
        enter(__name__, _let_go)
        encoder, library = _tools(model.value, kept_words)
        ids = [encoder.encode(t) for t in texts(batch["text"])]
        decoded = [library.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
        return {
            "doc_id": batch["doc_id"],
            "ids": pa.array(ids, pa.binary()),
            "decoded": pa.array(decoded, pa.string()),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_batch(docs.select("doc_id", "text"), f"doc_id {kind}, ids binary, decoded string", work, TEXTS)
