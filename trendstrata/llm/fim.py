"""Fill-in-middle transformation: pieces of units, put in order by a secondary sort.

Every text is cut into units, and its prefix, middle and suffix into pieces of whole
units.  A piece knows its document and its place in the output; one repartition by
document, sorted by place, streams the pieces of a document past running digests.
The same pass finds the marks in the stream and gives each part its place in the
original, so sorting the partition once more, without another shuffle, streams
the restored text.  No step holds a whole document but the one that cuts it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstrata.llm.common import shuffle_parts, slices, small_batches, table, text_bytes, text_sizes

# The marks, and the order of the parts by form.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLACES = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}  # in the original

UNITS = 8192  # of one piece
SLICE = 1 << 22  # bytes cut at once

_HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
PIECES = f"row long, place long, mark binary, chunk binary, {_HEAD}"
PARTS = f"row long, part int, place long, chunk binary, output_sha256 string, {_HEAD}"
DIGESTS = f"{_HEAD}, output_sha256 string, restored_sha256 string"
HEAD = [field.split()[0] for field in _HEAD.split(", ")]


def drawn(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text`` and the numbers ``h1`` to ``h4`` that the id draws; a NULL id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    numbers = [F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", digest.alias("_digest"))
    return rows.select("row", "doc_id", "text", *numbers)


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte positions where units begin, units before each text, and code points before each byte."""
    point = (data & 0xC0) != 0x80
    lower = data | 0x20
    letter = (lower >= 0x61) & (lower <= 0x7A)
    begins = point.copy()
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(begins)
    points = np.concatenate([[0], np.cumsum(point, dtype=np.int64)])
    return at, np.searchsorted(at, offsets), points


def _marked(text: pa.Array) -> np.ndarray:
    found = np.zeros(len(text), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        found |= pc.match_substring(text, mark.decode()).fill_null(False).to_numpy(zero_copy_only=False)
    return found


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The pieces of the texts of a batch."""
    row, doc_id, text = batch.column(0), batch.column(1), batch.column(2)
    h1, h2, h3, h4 = (batch.column(k).to_numpy() for k in range(3, 7))
    data, offsets = text_bytes(text)
    at, first, points = _units(data, offsets)
    n = np.diff(first)
    plain = (n == 0) | _marked(text) | (h3 % 100 >= 90)
    spm = h4 % 100 < 20
    one, two = h1 % (n + 1), h2 % (n + 1)
    cuts = np.stack([np.zeros_like(n), np.minimum(one, two), np.maximum(one, two), n], 1)
    cuts[plain, 1:3] = 0  # a plain text is all suffix

    # The three parts of each document in their order in the original, and in pieces of UNITS.
    lo, hi = cuts[:, :3].ravel(), cuts[:, 1:].ravel()
    part = np.tile(np.arange(3), len(n))
    doc = np.repeat(np.arange(len(n)), 3)
    kept = ~(plain[doc] & (part < 2))
    lo, hi, part, doc = lo[kept], hi[kept], part[kept], doc[kept]
    times = np.maximum(1, -(-(hi - lo) // UNITS))
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    lo, hi, part, doc = (np.repeat(x, times) for x in (lo, hi, part, doc))
    lo = lo + nth * UNITS
    hi = np.minimum(hi, lo + UNITS)

    # By form: where prefix, middle and suffix stand in the output.
    stands = np.array([[0, 2, 1], [1, 2, 0]])[spm[doc].astype(int), part]
    place = np.where(plain[doc], 0, stands) * (1 << 40) + nth
    marks = np.array([PREFIX, MIDDLE, SUFFIX, b""], object)[np.where(plain[doc] | (nth > 0), 3, part)]
    edge = np.concatenate([at, [len(data)]])
    ends = edge[np.minimum(first[doc] + hi, len(at))]
    ends = np.where(hi == n[doc], offsets[doc + 1], ends)
    begin = np.where(lo == n[doc], offsets[doc + 1], edge[np.minimum(first[doc] + lo, len(at))])
    # Pieces follow each other without gaps, so the texts' bytes are the column's.
    bounds = np.concatenate([begin, ends[-1:]]).astype(np.int64)
    chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(data)])

    leads = place == 0
    who = pa.array(np.where(leads, doc, 0), mask=~leads)
    before = np.where(plain, 0, points[np.where(cuts[:, 1] == n, offsets[1:], edge[np.minimum(first[:-1] + cuts[:, 1], len(at))])] - points[offsets[:-1]])
    upto = np.where(plain, 0, points[np.where(cuts[:, 2] == n, offsets[1:], edge[np.minimum(first[:-1] + cuts[:, 2], len(at))])] - points[offsets[:-1]])
    form = pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")))
    head = [doc_id, pa.array(n), form, pa.array(before, mask=plain), pa.array(upto - before, mask=plain)]
    columns = [row.take(pa.array(doc)), pa.array(place), pa.array(marks, pa.binary()), chunks.cast(pa.binary()), *[c.take(who) for c in head]]
    return pa.RecordBatch.from_arrays(columns, ["row", "place", "mark", "chunk", *HEAD])


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, text_sizes(whole.column(2)), SLICE):
            yield _cut(batch)


def transformed(docs: DataFrame) -> DataFrame:
    """The pieces of all documents' outputs, a document's together and in the order of its output.

    Takes ``doc_id`` and ``text``; other columns are ignored.  The output of a
    document is ``mark`` and ``chunk`` of each of its pieces in turn.  The first piece
    carries ``doc_id, n, form, prefix_chars, middle_chars``.  A NULL text is
    empty; an empty text is one plain piece; repeated rows and NULL ids are
    documents of their own.  No documents, no pieces.
    """
    small_batches(docs.sparkSession)
    pieces = drawn(docs).mapInArrow(_cutter, PIECES)
    return pieces.repartition(shuffle_parts(docs.sparkSession), "row").sortWithinPartitions("row", "place")


class _Restorer:
    """Finds the marks in a stream of chunks and tells the parts between them."""

    def __init__(self, form: str):
        self._marks = list(ORDERS.get(form, ()))
        self._part = 0
        self._rest = b""
        self._place = 0

    def _told(self, chunk: bytes) -> Iterator[tuple[int, int, bytes]]:
        if chunk:
            yield self._part, self._place, chunk
            self._place += 1

    def feed(self, chunk: bytes) -> Iterator[tuple[int, int, bytes]]:
        """``(part, place, bytes)`` that are certain by now."""
        chunk = self._rest + chunk
        while self._marks:
            found = chunk.find(self._marks[0])
            if found < 0:
                break
            yield from self._told(chunk[:found])
            chunk = chunk[found + 3 :]
            self._part = PLACES[self._marks.pop(0)]
        # The next mark may begin in the last two bytes.
        cut = len(chunk) - 2 if self._marks else len(chunk)
        self._rest = chunk[max(0, cut) :]
        yield from self._told(chunk[: max(0, cut)])

    def end(self) -> Iterator[tuple[int, int, bytes]]:
        if self._marks:
            raise ValueError("a mark is missing in the output")
        yield from self._told(self._rest)


def _streamer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the outputs, and the outputs' parts with their places in the originals."""
    names = [field.split()[0] for field in PARTS.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    head: tuple | None = None
    row, digest, restorer = None, None, None
    out: list[tuple] = []
    nothing = (None,) * (1 + len(HEAD))

    def closed() -> None:
        out.extend((row, *told, *nothing) for told in restorer.end())
        out.append((row, -1, 0, b"", digest.hexdigest(), *head))

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for piece in zip(*columns, strict=True):
            if piece[0] != row:
                if row is not None:
                    closed()
                row, head = piece[0], piece[4:]
                digest, restorer = hashlib.sha256(), _Restorer(head[2])
            text = piece[2] + piece[3]
            digest.update(text)
            out.extend((row, *told, *nothing) for told in restorer.feed(text))
        if out:
            yield batch_of()
            out = []
    if row is not None:
        closed()
        yield batch_of()


def _digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, with the digest of its parts in their order in the original."""
    names = [field.split()[0] for field in DIGESTS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    head, digest = None, None
    out: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for part, chunk, output, *fields in zip(columns[1], *columns[3:], strict=True):
            if part < 0:
                if head is not None:
                    out.append((*head, digest.hexdigest()))
                head, digest = (*fields, output), hashlib.sha256()
            else:
                digest.update(chunk)
        if out:
            yield batch_of()
            out = []
    if head is not None:
        out.append((*head, digest.hexdigest()))
        yield batch_of()


def digests(pieces: DataFrame) -> DataFrame:
    """One row per document of ``transformed``: its lengths, its form, and digests of the output and of the text restored from it."""
    parts = pieces.mapInArrow(_streamer, PARTS).sortWithinPartitions("row", "part", "place")
    return parts.mapInArrow(_digester, DIGESTS)


def texts(pieces: DataFrame) -> DataFrame:
    """``doc_id, form, output`` of each document of ``transformed``, for documents that fit a row."""
    own = pieces.groupBy("row").agg(
        F.max(F.struct(F.col("form").isNotNull(), "doc_id", "form")).alias("_head"),
        F.sort_array(F.collect_list(F.struct("place", F.concat("mark", "chunk").alias("bytes")))).alias("_pieces"),
    )
    joined = F.concat_ws("", F.transform("_pieces", lambda p: F.decode(p["bytes"], "UTF-8")))
    return own.select("_head.doc_id", "_head.form", joined.alias("output"))


def op11_fim(spark, sf_dir: str) -> DataFrame:
    return digests(transformed(table(spark, sf_dir, "documents")))


ORACLE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
    CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (len(units) + 1) AS one,
    CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (len(units) + 1) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT doc_id, text, n, form,
    array_to_string(units[1:least(one, two)], '') AS prefix,
    array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
    array_to_string(units[greatest(one, two) + 1:n], '') AS suffix
  FROM drawn)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
