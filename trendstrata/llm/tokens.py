"""Token ids in files of fixed-width packed bits.

A file holds the ids of consecutive documents.  All numbers are little-endian:

    magic 8 bytes | width, ids per block: u32 each | documents, ids, blocks: u64 each
    per document: id i64, known u8 (0: the id is NULL), count u64   (three arrays, one after the other)
    block offsets: u64 each, one more than blocks, in bytes from the first block
    blocks

Every block but the last holds ``BLOCK`` ids of ``width`` bits, first id in the
lowest bits; 64 ids fill ``width`` 64-bit words exactly, so packing and
unpacking run over columns of such groups.  Any range of ids is read by
seeking to the blocks that hold it.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendstrata.llm.common import shuffle_parts, small_batches, stored, table
from trendstrata.session import fresh_folder

MAGIC = b"BITPACK1"
HEAD = struct.Struct("<8sIIQQQ")
BLOCK = 8192  # ids of a block, a multiple of 64
FILE_IDS = 1 << 22  # ids after which a task begins the next file
CACHE = 800_000  # stretches whose ids a worker remembers
TOGETHER = 64  # texts encoded at once


def width_for(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The ids in ``width`` bits each; the last group of 64 is filled up with zeros."""
    groups = -(-len(ids) // 64)
    padded = np.zeros(groups * 64, np.uint64)
    padded[: len(ids)] = ids
    if width in (8, 16, 32):  # the same layout, as whole numbers
        return padded.astype(f"<u{width // 8}").tobytes()
    columns = padded.reshape(groups, 64)
    words = np.zeros((groups, width), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[:, word] |= columns[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= columns[:, j] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    words = np.frombuffer(data, "<u8").reshape(-1, width)
    out = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = value & mask
    return out.reshape(-1)[:count]


def file_bytes(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, width: int) -> bytes:
    packed = pack(ids, width)  # a block is a multiple of 64 ids, so blocks are stretches of the whole
    offsets = np.append(np.arange(0, len(packed), BLOCK // 8 * width), len(packed)).astype("<u8")
    return b"".join(
        [
            HEAD.pack(MAGIC, width, BLOCK, len(doc_ids), len(ids), len(offsets) - 1),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is not None for d in doc_ids], "u1").tobytes(),
            np.array(counts, "<u8").tobytes(),
            offsets.tobytes(),
            packed,
        ]
    )


class BitFile:
    """Random access to one file, through any store that pyarrow opens."""

    def __init__(self, path: str):
        store, inner = arrow_fs.FileSystem.from_uri(path)
        self._file = store.open_input_file(inner)
        magic, self.width, self.block, docs, self.ids_total, blocks = HEAD.unpack(self._file.read(HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of packed ids")
        doc_ids = np.frombuffer(self._file.read(8 * docs), "<i8")
        known = np.frombuffer(self._file.read(docs), "u1")
        self.doc_ids = [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)]
        self.counts = np.frombuffer(self._file.read(8 * docs), "<u8").astype(np.int64)
        self._offsets = np.frombuffer(self._file.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self._data = HEAD.size + 17 * docs + 8 * (blocks + 1)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` to ``hi`` (exclusive) of the file, from the blocks that hold them."""
        if hi <= lo:
            return np.zeros(0, np.uint32)
        first, last = lo // self.block, (hi - 1) // self.block
        self._file.seek(self._data + self._offsets[first])
        data = self._file.read(int(self._offsets[last + 1] - self._offsets[first]))
        count = min(self.ids_total, (last + 1) * self.block) - first * self.block
        return unpack(data, self.width, count)[lo - first * self.block : hi - first * self.block]

    def close(self) -> None:
        self._file.close()

    def __enter__(self) -> BitFile:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


# Positions where a byte-level pre-tokenizer always begins a new piece: before
# a single space with no white space on either side.
_CUT = re.compile(r"(?<=\S)(?= \S)")
# A stretch that is cut safely from neighbours of the same kind.
_SAFE = re.compile(r" ?\S(?:.*\S)?\Z", re.DOTALL)
# One piece for the pre-tokenizer, with perhaps one mark behind it: letters below U+0100.
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?\Z")


def byte_alphabet() -> dict[int, str]:
    """Fixed values of byte-level vocabularies: the character for each byte.

    Visible bytes stand for themselves, the others for the code points from 256 on, in order.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Whole-text ids of a byte-level tokenizer, remembered by stretch.

    Such a tokenizer never merges across its pre-tokens, so the ids of a text
    are those of its stretches between safe cuts, one after the other.  New
    plain words go to the tokenizer's model past its slower pre-tokenizer.

    A literal added token (``<|endoftext|>``) stands for itself, as the library
    has it, and parts the text.  A tokenizer with a normalizer, or with added
    tokens that look at their neighbours or hold white space, encodes whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder()
        self._whole = self._tokenizer.normalizer is not None or any(
            t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content) for t in added.values()
        )
        self._added = {t.content: np.array([i], "<u4") for i, t in added.items() if t.content}
        longest = sorted(self._added, key=len, reverse=True)
        self._literal = re.compile(f"({'|'.join(map(re.escape, longest))})")
        self._words = Tokenizer(self._tokenizer.model)
        self._words.pre_tokenizer = pre_tokenizers.Split("\x00", "removed")
        self._alphabet = byte_alphabet()
        self.vocabulary = self._tokenizer.get_vocab_size()
        # Every character of a byte-level token stands for one byte.
        self._bytes = np.array([len(self._tokenizer.id_to_token(i) or "") for i in range(self.vocabulary)])
        self._known: dict[str, bytes] = {}

    def _cut(self, coded, stretches: list[str], found: dict[str, bytes]) -> None:
        """Share the ids of joined stretches out by the stretches' lengths in bytes."""
        ids = np.array(coded.ids, "<u4")
        ends = np.cumsum([len(p.encode()) for p in stretches])
        cuts = np.searchsorted(np.cumsum(self._bytes[ids]), ends) + 1
        data, last = ids.tobytes(), 0
        for stretch, cut in zip(stretches, (4 * cuts).tolist(), strict=True):
            found[stretch] = data[last:cut]
            last = cut

    def _learn(self, plain: dict[str, bytes], behind: dict[str, bytes], alone: dict[str, bytes]) -> None:
        """Fill in the ids of new stretches: plain ones, others that can follow one another, and the rest."""
        every = list(plain)
        for i in range(0, len(every), 2000):
            part = every[i : i + 2000]
            joined = "\x00".join([p if p[-1] not in ".," else f"{p[:-1]}\x00{p[-1]}" for p in part])
            mapped = joined.encode().decode("latin-1").translate({**self._alphabet, 0: "\x00"})
            self._cut(self._words.encode_batch_fast([mapped], add_special_tokens=False)[0], part, plain)
        every = list(behind)
        for i in range(0, len(every), 2000):
            part = every[i : i + 2000]
            self._cut(self._tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0], part, behind)
        for p in alone:
            alone[p] = np.array(self._tokenizer.encode(p, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, as the library's ``encode`` without the tokens it puts around a text."""
        if self._whole:
            return [np.array(self._tokenizer.encode(t, add_special_tokens=False).ids, "<u4") for t in texts]
        parted = {k: self._literal.split(t) for k, t in enumerate(texts) if any(a in t for a in self._added)}
        if not parted:
            return self._between(texts)
        each = [parted.get(k, [t]) for k, t in enumerate(texts)]
        coded = iter(self._between([p for parts in each for p in parts[::2]]))
        return [
            np.concatenate([self._added[p] if k % 2 else next(coded) for k, p in enumerate(parts)]) for parts in each
        ]

    def _between(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without literal added tokens.  Up to ``CACHE`` stretches are remembered, mostly the frequent ones: those seen first."""
        plain, behind, alone, work = {}, {}, {}, []
        get = self._known.get
        for text in texts:
            pieces = text.replace(" ", "\x00 ").split("\x00") if "\x00" not in text else [text]
            values = list(map(get, pieces))
            if None not in values:
                work.append((values, None))
                continue
            missing = [(k, pieces[k]) for k, v in enumerate(values) if v is None]
            if not all([_SAFE.match(p) for _, p in missing]):
                pieces = _CUT.split(text) if text else []
                values = list(map(get, pieces))
                missing = [(k, pieces[k]) for k, v in enumerate(values) if v is None]
            for _, p in missing:
                if _PLAIN.match(p):
                    plain[p] = b""
                elif p[0] == " " and _SAFE.match(p):
                    behind[p] = b""
                else:
                    alone[p] = b""
            work.append((values, missing))
        self._learn(plain, behind, alone)
        found = plain | behind | alone
        out = []
        for values, missing in work:
            for k, p in missing or ():
                values[k] = found[p]
            out.append(np.frombuffer(b"".join(values), "<u4"))
        if len(self._known) < CACHE:
            self._known.update(plain)
            self._known.update(behind)
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


MANIFEST = "part long, file long, path string, n_docs long, n_ids long"


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        encode = encoder(tokenizer)
        width = width_for(max(encode.vocabulary, end_id + 1))
        end = np.array([end_id], "<u4")
        store, inner = arrow_fs.FileSystem.from_uri(folder)
        doc_ids, counts, parts, held, number = [], [], [], 0, 0

        def coded(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
            for i in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(i, TOGETHER)
                texts = [t or "" for t in some.column(1).to_pylist()]
                yield from zip(some.column(0).to_pylist(), encode(texts), strict=True)

        def flush() -> pa.RecordBatch:
            # The attempt is in the name; only rows of the manifest that Spark commits count.
            name = f"part-{part:06d}-{number:06d}-{attempt}.bits"
            store.create_dir(inner, recursive=True)
            with store.open_output_stream(f"{inner}/{name}") as out:
                out.write(file_bytes(doc_ids, counts, np.concatenate(parts), width))
            row = [part], [number], [f"{folder}/{name}"], [len(doc_ids)], [held]
            return pa.RecordBatch.from_arrays(
                [pa.array(row[0], pa.int64()), pa.array(row[1], pa.int64()), pa.array(row[2], pa.string()),
                 pa.array(row[3], pa.int64()), pa.array(row[4], pa.int64())],
                ["part", "file", "path", "n_docs", "n_ids"],
            )

        for batch in batches:
            for doc_id, ids in coded(batch):
                parts += [ids, end]
                doc_ids.append(doc_id)
                counts.append(len(ids) + 1)
                held += len(ids) + 1
                if held >= FILE_IDS:
                    yield flush()
                    doc_ids, counts, parts, held, number = [], [], [], 0, number + 1
        if doc_ids:
            yield flush()

    return run


def write_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Encode whole texts, write the files, and return their manifest with the first id of each.

    Takes ``doc_id, text``; a NULL text is empty.  Documents lie in ascending
    order of ``doc_id`` over all files (NULL first, repeated ids in the order of
    their texts' hashes).  ``folder`` is fresh below the shared folder.  An empty
    table writes no file.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = fresh_folder(spark, "ids")
    rows = docs.select("doc_id", "text").withColumns(
        {"_tie": F.xxhash64("text"), "_row": F.monotonically_increasing_id()}
    )
    order = ["doc_id", "_tie", "_row"]
    ordered = rows.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    manifest = stored(
        ordered.select("doc_id", "text").mapInArrow(_writer(folder, tokenizer, end_id), MANIFEST), "manifest"
    )
    # One row per file.
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with BitFile(path) as file:
                ends = np.cumsum(file.counts)
                starts = ends - file.counts
                crcs, lo = np.zeros(len(ends), np.int64), 0
                while lo < len(ends):  # so many documents at once, one at least
                    hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + 64 * BLOCK, "right")))
                    ids = file.ids(int(starts[lo]), int(ends[hi - 1])).astype("<u4", copy=False)
                    for k in range(lo, hi):
                        crcs[k] = zlib.crc32(ids[starts[k] - starts[lo] : ends[k] - starts[lo]])
                    lo = hi
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(starts + start), pa.array(file.counts), pa.array(crcs)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )


def read_ids(manifest: DataFrame) -> DataFrame:
    """Per document of the files: its first id's place, its number of ids and their checksum."""
    files = manifest.select("path", "start")
    return files.repartition(shuffle_parts(files.sparkSession), "path").mapInArrow(_read, READ)


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return read_ids(write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2))
