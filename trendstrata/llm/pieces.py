"""SentencePiece encoding and decoding by streaming Viterbi.

The best segmentation maximises the sum of the pieces' scores, the objective
of SentencePiece's unigram encoder, over the vocabulary and the scores that the
model file holds.  Texts are normalised as that file says (a dummy prefix,
spaces as U+2581, nothing else), characters without a piece fall back to bytes.

The encoder reads characters one by one and keeps the scores of one window of
the longest piece's length.  Back pointers live until all surviving paths run
through one boundary; ids before it are then final and leave.  That is so at every
position which no open piece reaches beyond, which is looked at before each step; where none comes
for a while, the back pointers of all open positions are followed to where they meet.

Where no piece can cross a boundary - before a space that follows another character, for
vocabularies without inner spaces - all paths meet by construction.  What the
encoder has committed for a stretch between two such places is remembered.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstrata.llm.common import slices, small_batches, table, text_sizes

SPACE = "▁"  # fixed value of the format
NONE = -1  # in place of an id: a character without a piece
UNKNOWN_PENALTY = 10.0  # fixed value: what an unknown character costs below the worst piece
CACHE = 600_000  # stretches whose ids a worker remembers, some 120 MB
REMEMBERED = 64  # characters of such a stretch at most
PART = 4096  # characters of a stream that are looked at together
SLICE = 1 << 21  # bytes of text between two batches of output

_STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Viterbi:
    """The streaming encoder: scores of a window, and back pointers since the last boundary that all surviving paths share."""

    def __init__(self, model: Pieces):
        self._model = model
        self._clear()

    def _clear(self) -> None:
        # Position 0 is the last committed boundary; `_best`, `_back` and `_piece` are the score, start and id of the best piece up to a position.
        self._text, self._at, self._reach = "", 0, 0
        self._best, self._back, self._piece = [0.0], [0], [NONE]

    def push(self, chars: str, last: bool = False) -> list[int]:
        """Ids that are certain once these characters are known, all of them if they are the last."""
        model = self._model
        begin, worst, longest = model.trie.get, model.worst, model.longest
        text = self._text + chars
        size = len(text)
        stop = size if last else size - longest + 1  # a step needs to see the longest piece
        at, reach, done = self._at, self._reach, 0
        room = size + 1 - len(self._best)
        best, back, piece = self._best + [-math.inf] * room, self._back + [0] * room, self._piece + [NONE] * room
        letters = list(text)
        ids: list[int] = []
        while at < stop:
            if at == reach and at > done:  # no open piece reaches beyond: all paths run through here
                self._commit(text, back, piece, done, at, ids)
                done = at
            start, score = at, best[at]
            node = begin(letters[at])
            at += 1
            found = node and node.get("")
            value = score + (found[0] if found else worst)
            if value > best[at]:
                best[at], back[at], piece[at] = value, start, found[1] if found else NONE
            if node:
                for end in range(at, size):
                    node = node.get(letters[end])
                    if node is None:
                        break
                    if "" in node:
                        value, id_ = node[""]
                        value += score
                        end += 1
                        if value > best[end]:
                            best[end], back[end], piece[end] = value, start, id_
                        if end > reach:
                            reach = end
            if at > reach:
                reach = at
        if last:
            if size > done:
                self._commit(text, back, piece, done, size, ids)
            self._clear()
            return ids
        if at - done > 4 * longest:
            meet = self._shared(back, [p for p in range(at, reach + 1) if best[p] > -math.inf], done)
            if meet > done:
                self._commit(text, back, piece, done, meet, ids)
                done = meet
        self._text, self._at, self._reach = text[done:], at - done, reach - done
        self._best, self._piece = best[done : reach + 1], piece[done : reach + 1]
        self._back = [start - done for start in back[done : reach + 1]]
        return ids

    def _commit(self, text: str, back: list[int], piece: list[int], lo: int, hi: int, ids: list[int]) -> None:
        path: list[int] = []
        while hi > lo:
            start, id_ = back[hi], piece[hi]
            if id_ == NONE:
                path += self._model._ids(text[start:hi])[::-1]
            else:
                path.append(id_)
            hi = start
        path.reverse()
        ids += path

    @staticmethod
    def _shared(back: list[int], open_: list[int], done: int) -> int:
        """The last boundary that the paths to all open positions run through."""
        nodes = set(open_)
        while len(nodes) > 1:
            last = max(nodes)
            nodes.remove(last)
            nodes.add(back[last] if last > done else done)
        return nodes.pop()


class Pieces:
    """Vocabulary, scores and both directions for one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("only models that leave characters and white space as they are")
        kinds = proto.ModelProto.SentencePiece
        self.prefix = SPACE if normal.add_dummy_prefix else ""
        self.surface = [p.piece for p in model.pieces]
        self.scores: dict[str, tuple[float, int]] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = 0
        self.silent: set[int] = set()
        for i, piece in enumerate(model.pieces):
            if piece.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.scores[piece.piece] = (piece.score, i)
            elif piece.type == kinds.BYTE:
                self.bytes[int(piece.piece[1:-1], 16)] = i
            elif piece.type == kinds.UNKNOWN:
                self.unknown = i
            elif piece.type == kinds.CONTROL:
                self.silent.add(i)
        self._last_special = max([*self.bytes.values(), *self.silent, self.unknown])
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.worst = min(s for s, _ in self.scores.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.scores))
        # A dictionary of next characters for each beginning of a piece; that of a whole piece holds its score and id under "".
        self.trie: dict = {}
        for piece, known in self.scores.items():
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = known
        self.divisible = not any(SPACE in p.lstrip(SPACE) for p in self.scores)
        self._known: dict[str, bytes] = {}
        self.room = CACHE
        self._machine = Viterbi(self)
        self._text = [s.replace(SPACE, " ") for s in self.surface]

    def _ids(self, piece: str) -> list[int]:
        known = self.scores.get(piece)
        if known:
            return [known[1]]
        if len(self.bytes) == 256:
            return [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def stream(self, chars: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of text in parts of any size, each given as soon as it is certain."""
        machine = Viterbi(self)
        for part in chars:
            for lo in range(0, len(part), PART):
                yield from machine.push(part[lo : lo + PART])
        yield from machine.push("", last=True)

    def _stretch(self, stretch: str) -> bytes:
        """Ids of a stretch, committed by the machine; those of a short one are remembered."""
        if len(stretch) <= REMEMBERED:
            ids = self._machine.push(stretch, last=True)
            coded = struct.pack(f"<{len(ids)}i", *ids)
            if len(self._known) < self.room:
                self._known[stretch] = coded
            return coded
        return np.fromiter(self.stream((stretch,)), "<i4").tobytes()

    def forget(self) -> None:
        self._known.clear()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<i4")
        text = self.prefix + text.replace(" ", SPACE)
        if not self.divisible:
            return np.fromiter(self.stream((text,)), "<i4")
        known = self._known
        if SPACE + SPACE in text or text[-1] == SPACE or text[0] != SPACE or "\x00" in text:
            stretches = _STRETCH.findall(text)
        else:
            stretches = text.replace(SPACE, "\x00" + SPACE).split("\x00")[1:]
        values = list(map(known.get, stretches))
        if None in values:
            values = [self._stretch(s) if v is None else v for s, v in zip(stretches, values, strict=True)]
        return np.frombuffer(b"".join(values), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids: bytes are put together, control ids are left out, the dummy prefix is taken off."""
        if len(ids) == 0:
            return ""
        if int(ids.min()) > self._last_special:
            text = "".join(map(self._text.__getitem__, ids.tolist()))
        else:
            parts = bytearray()
            for i in ids.tolist():
                if i in self.byte_of:
                    parts.append(self.byte_of[i])
                elif i not in self.silent:
                    parts += self._text[i].encode("utf-8", "surrogatepass")
            text = parts.decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _encoder(path: str, cache: int, keep: bool, check: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        model.room = cache
        for whole in batches:
            for batch in slices(whole, text_sizes(whole.column(1)), SLICE):
                coded = [model.encode(t.as_py() or "") for t in batch.column(1)]
                ends = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
                flat = np.concatenate(coded)
                columns = {"doc_id": batch.column(0), "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}
                if check:
                    texts = (model.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True))
                    columns["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        if not keep:
            model.forget()

    return run


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = pieces(path).decode
        for whole in batches:
            sizes = np.diff(np.asarray(whole.column(1).offsets))
            for batch in slices(whole, sizes, SLICE):
                lists = batch.column(1)
                flat, ends = lists.values.to_numpy(), np.asarray(lists.offsets)
                texts = pa.array([decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["doc_id", "ids", "decoded"])

    return run


def encode_documents(docs: DataFrame, model: str, cache: int = CACHE, keep: bool = True) -> DataFrame:
    """``doc_id, ids`` of every whole text; a NULL or empty text has no ids.  No shuffle.

    ``cache`` is the number of stretches that a worker remembers, at 200 bytes each, for the task or, with
    ``keep``, as long as it lives; neither changes a result.
    """
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_encoder(model, cache, keep), "doc_id long, ids array<int>")


def decode_ids(coded: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, decoded``.

    The text comes back exactly, but for U+2581, which the format itself reads as a space.
    """
    return coded.select("doc_id", "ids").mapInArrow(_decoder(model), "doc_id long, ids array<int>, decoded string")


def encoded_and_checked(docs: DataFrame, model: str, cache: int = CACHE, keep: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256``: what decoding the ids gives, by digest.

    The worker that encodes a document decodes its ids too, so neither ids nor texts pass through the JVM in between.
    """
    small_batches(docs.sparkSession)
    both = docs.select("doc_id", "text").mapInArrow(
        _encoder(model, cache, keep, check=True), "doc_id long, ids array<int>, decoded_sha256 string"
    )
    return both.select("doc_id", F.size("ids").alias("n_tokens"), "ids", "decoded_sha256")


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded_and_checked(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
