"""Suffix-array deduplication: find every ``LENGTH``-byte string that starts at two places of the corpus.

Shards by content.  The smallest hash among a window's ``GRAM``-byte grams
depends on the window's bytes alone, so equal windows have equal smallest hashes.  A run is
a stretch of windows of one document with the same smallest hash; its hash is
its shard key, and equal windows always meet in one shard.

1. Runs with equal bytes are equal in all their windows: those are settled
   by digests, and one of them stands for all.
2. Shards left with different runs (or one run that repeats a gram) get
   the bytes of one run per content.  A suffix array by Larsson-Sadakane
   refinement, and Kasai's common prefixes of neighbours, show the windows that occur twice.
3. A shard of more than ``SHARD`` bytes is cut into parts of their own.  Each part passes on its distinct
   windows as sorted arrays, cut at the same digests in all parts.  Arrays of the same range
   are merged two by two, each looking up its entries in the other by binary search.

Nothing is compared pair by pair, and the work is in proportion to the bytes.  Equal
windows are told by two 64-bit hashes, their shard's and their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstrata.llm.common import mixed, shuffle_parts, slices, small_batches, stored, table, text_bytes, text_sizes

LENGTH = 200  # bytes that make a repeat
GRAM = 32  # bytes of a gram
RUN = 1 << 15  # windows of one run at most; longer ones are cut
SLICE = 1 << 20  # bytes handled at once; hashing holds some ten times 8 bytes for each
SHARD = 1 << 18  # bytes of a shard above which it is cut into parts
ARRAY = 1 << 20  # bytes of one suffix array, about; it serves several small shards
CHAINS = 1 << 13  # common prefixes that are measured together; each takes some 2 KB
SAMPLED = 32  # one of so many documents shows which shards are large (for balance only)
CROWD = 512  # runs of a large shard that go to one task
END = 0xFF  # between stretches; no UTF-8 byte


def sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over all windows of ``width`` values."""
    size = 1
    while size * 2 <= width:
        a = op(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return op(a[: len(a) - rest], a[rest:]) if rest else a


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of each ``gram`` bytes (a power of two), by doubling."""
    h, size, base = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while size < gram:
        h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
        size *= 2
    return mixed(h)


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Runs of all documents in ``data``: document, first byte, end byte, shard key, whether a gram may repeat."""
    empty = {k: np.zeros(0, np.int64) for k in ("doc", "lo", "hi", "v", "multi")}
    sizes = np.diff(offsets)
    if len(data) < length or sizes.max(initial=0) < length:
        return empty
    width = length - GRAM + 1
    h = gram_hashes(data)
    least = sliding(h, width, np.minimum)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    last = np.repeat(offsets[1:], sizes)[: len(least)] - length
    windows = np.flatnonzero(np.arange(len(least)) <= last)
    value = least[windows]
    fresh = np.concatenate([[True], (windows[1:] != windows[:-1] + 1) | (value[1:] != value[:-1]) | (doc[windows[1:]] != doc[windows[:-1]])])
    starts = np.flatnonzero(fresh)
    counts = np.diff([*starts, len(windows)])
    if counts.max() > RUN:  # cut long runs
        pieces = -(-counts // RUN)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + within * RUN
        counts = np.diff([*starts, len(windows)])
    lo = windows[starts]
    v, of = value[starts], doc[lo].astype(np.int64)
    # A window's smallest gram stands at every place whose hash no window around it undercuts.
    shown = np.zeros(len(least), np.uint64)
    shown[windows] = value
    padded = np.concatenate([np.zeros(width - 1, np.uint64), shown, np.zeros(width - 1, np.uint64)])
    places = np.flatnonzero(sliding(padded, width, np.maximum)[: len(h)] == h)
    seen = np.sort(mixed(h[places] ^ mixed(doc[places].astype(np.uint64))))
    twice = np.unique(seen[1:][seen[1:] == seen[:-1]])
    multi = np.isin(mixed(v ^ mixed(of.astype(np.uint64))), twice)
    return {"doc": of, "lo": lo - offsets[of], "hi": lo - offsets[of] + counts - 1 + length, "v": v.view(np.int64), "multi": multi}


RUNS = "v long, c long, did long, h long, lo int, hi int, multi boolean"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for whole in batches:
        for batch in slices(whole, text_sizes(whole.column(2)), SLICE):
            data, offsets = text_bytes(batch.column(2))
            found = runs_of(data, offsets)
            bytes_ = memoryview(np.ascontiguousarray(data))
            at = offsets[found["doc"]]
            digest = xxhash.xxh3_64_intdigest
            c = [digest(bytes_[a:b]) for a, b in zip((at + found["lo"]).tolist(), (at + found["hi"]).tolist(), strict=True)]
            doc = pa.array(found["doc"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["v"]), pa.array(np.array(c, np.uint64).view(np.int64)), batch.column(0).take(doc), batch.column(1).take(doc),
                 pa.array(found["lo"].astype(np.int32)), pa.array(found["hi"].astype(np.int32)), pa.array(found["multi"].astype(bool))],
                ["v", "c", "did", "h", "lo", "hi", "multi"],
            )


# kind 0: bytes lo..hi of a document repeat; 1: a run whose bytes are needed
# (settled: all its windows are known to repeat; crowded: its shard is in several parts, which do not know of
# each other); 2: a part's windows of the range of digests in c, sorted and packed.
FOUND = "kind int, v long, c long, did long, h long, lo int, hi int, settled boolean, crowded boolean, packed binary"
_NAMES = ["kind", "v", "c", "did", "h", "lo", "hi", "settled", "crowded", "packed"]


def _rows(kind: int, v, c, did, h, lo, hi, settled, crowded=None, packed: list[bytes] | None = None) -> pa.RecordBatch:
    n = len(did)
    crowded = np.zeros(n, bool) if crowded is None else np.asarray(crowded, bool)
    columns = [np.full(n, kind, np.int32), v, c, did, h, np.asarray(lo, np.int32), np.asarray(hi, np.int32), np.asarray(settled, bool), crowded]
    packed_ = pa.nulls(n, pa.binary()) if packed is None else pa.array(packed, pa.binary())
    return pa.RecordBatch.from_arrays([*[pa.array(x) for x in columns], packed_], _NAMES)


# A window of a part: its digest, which of the part's stretches it lies in, its first byte there, whether it is known to repeat.
_WINDOW = np.dtype([("c", "<u8"), ("of", "<u4"), ("at", "<u4"), ("settled", "?")])
_STRETCH = np.dtype([("did", "<i8"), ("h", "<i8")])


def _packed(windows: np.ndarray, did: np.ndarray, h: np.ndarray) -> bytes:
    used, windows["of"] = np.unique(windows["of"], return_inverse=True)
    stretches = np.zeros(len(used), _STRETCH)
    stretches["did"], stretches["h"] = did[used], h[used]
    return np.array([len(used)], "<i8").tobytes() + stretches.tobytes() + windows.tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    stretches = np.frombuffer(data, _STRETCH, n, 8)
    return stretches, np.frombuffer(data, _WINDOW, offset=8 + n * _STRETCH.itemsize)


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows with equal first ``keys`` columns stay together."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held = pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches()[0]
        columns = [held.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        same = np.logical_and.reduce([x == x[-1] for x in columns])
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield held.slice(0, cut)
        rest = [held.slice(cut)]
    if rest:
        yield rest[0]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1 over rows sorted by shard and content: ``v, part, parts, c, did, h, lo, hi, multi``."""
    for batch in _whole_groups(batches, 2):
        v, part, parts, c, did, h, lo, hi, multi = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
        shard = np.concatenate([[True], (v[1:] != v[:-1]) | (part[1:] != part[:-1])])
        content = shard | np.concatenate([[True], c[1:] != c[:-1]])
        first = np.flatnonzero(content)
        count = np.diff([*first, len(v)])
        group = np.cumsum(shard)[first] - 1
        contents = np.bincount(group)[group]
        twice = count >= 2
        needed = (contents >= 2) | (parts[first] > 1) | (multi[first] & ~twice)
        all_twice = np.repeat(twice, count)
        yield _rows(0, *(x[all_twice] for x in (v, c, did, h, lo, hi)), np.ones(all_twice.sum()))
        one = first[needed]
        yield _rows(1, *(x[one] for x in (v, c, did, h, lo, hi)), twice[needed], parts[one] > 1)


def _settle_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contents that several parts of a shard hold, over rows sorted by shard and content: one of each goes on."""
    for batch in _whole_groups(batches, 2):
        v, c, did, h, lo, hi, settled = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
        first = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (c[1:] != c[:-1])]))
        count = np.diff([*first, len(v)])
        twice = np.repeat(count >= 2, count)
        told = twice & ~settled
        yield _rows(0, *(x[told] for x in (v, c, did, h, lo, hi)), np.ones(told.sum()))
        known = np.logical_or.reduceat(settled, first) | (count >= 2) if len(first) else np.zeros(0, bool)
        yield _rows(1, *(x[first] for x in (v, c, did, h, lo, hi)), known)


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` bytes at least, and which of them share half of that with the one before.

    Larsson-Sadakane: suffixes with equal first ``h`` symbols form a group;
    groups of more than one are sorted again by the rank of the suffix ``h``
    further on, which doubles ``h``.  Groups of one are left alone.
    """
    n = len(text)
    key, size = text.astype(np.uint64), 1
    while size < 8:
        shifted = np.zeros(n, np.uint64)
        shifted[: n - size] = key[size:]
        key = (key << np.uint64(8 * size)) | shifted
        size *= 2
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    first = np.flatnonzero(new)
    rank[order] = np.repeat(first, np.diff([*first, n]))
    shared, h = ~new, 8
    while h < depth:
        shared = ~new
        active = np.flatnonzero(~(new & np.append(new[1:], True)))
        if len(active) == 0:
            break
        suffix = order[active]
        both = rank[suffix] * np.int64(n + 2) + rank[np.minimum(suffix + h, n)] + 1
        again = np.argsort(both, kind="stable")
        suffix, both = suffix[again], both[again]
        order[active] = suffix
        begins = np.concatenate([[True], both[1:] != both[:-1]])
        new[active] = begins
        starts = np.flatnonzero(begins)
        rank[suffix] = np.repeat(active[starts], np.diff([*starts, len(active)]))
        h *= 2
    return order, shared


def common_prefixes(text: np.ndarray, order: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For suffixes that share a long prefix with the one before: suffix, that neighbour, common length.

    Kasai's rule in text order: where suffix and neighbour both move on by one,
    the common length falls by one, so only the first of such a chain is compared, and
    all chains are compared together.
    """
    at = np.flatnonzero(shared)
    at = at[at > 0]
    i, j = order[at], order[at - 1]
    by_text = np.argsort(i)
    i, j = i[by_text], j[by_text]
    if len(i) == 0:
        return i, j, i
    begins = np.concatenate([[True], (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)])
    first = np.flatnonzero(begins)
    step = 64
    padded = np.concatenate([text.astype(np.int16), np.full(step + 1, -1, np.int16)])
    a, b, common = i[first], j[first], np.zeros(len(first), np.int64)
    open_ = np.arange(len(first))
    reach = np.arange(step)
    while len(open_):
        longer = []
        for lo in range(0, len(open_), CHAINS):
            some = open_[lo : lo + CHAINS]
            left = np.minimum(a[some] + common[some], len(text))[:, None] + reach
            right = np.minimum(b[some] + common[some], len(text))[:, None] + reach
            equal = padded[np.minimum(left, len(padded) - 1)] == padded[np.minimum(right, len(padded) - 1)]
            length = np.where(equal.all(1), step, np.argmin(equal, axis=1))
            common[some] += length
            longer.append(some[length == step])
        open_ = np.concatenate(longer)
    chain = np.cumsum(begins) - 1
    return i, j, common[chain] - (np.arange(len(i)) - first[chain])


def repeated_windows(text: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Per position: whether the window there occurs again, and whether an earlier suffix shows the same window.

    ``ends`` is the end of the stretch of each position; stretches are separated by ``END``.
    """
    order, shared = suffix_array(text, length)
    i, j, common = common_prefixes(text, order, shared)
    inside = np.arange(len(text)) + length <= ends
    equal = (common >= length) & inside[i]
    again = np.zeros(len(text), bool)
    again[i[equal]] = True
    later = again.copy()
    again[j[equal]] = True
    return again & inside, later


def _spans(where: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges that windows at the given (sorted) positions cover, joined where the positions are consecutive."""
    if len(where) == 0:
        return where, where
    starts = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1] + 1]))
    ends = np.concatenate([starts[1:], [len(where)]]) - 1
    return where[starts], where[ends] + length


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2 over rows sorted by shard, part and place: ``v, part, parts, did, h, lo, settled, bytes``."""
    import xxhash

    def solve(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        v, part, parts, did, h, lo, settled = (rows.column(k).to_numpy(zero_copy_only=False) for k in range(7))
        pieces = [p.as_py() for p in rows.column(7)]
        text = np.frombuffer(bytes([END]).join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces])
        begin = np.cumsum(sizes + 1) - sizes - 1
        of = np.repeat(np.arange(len(pieces)), sizes + 1)[: len(text)]
        again, later = repeated_windows(text, (begin + sizes)[of])
        # Windows of different shards differ, so one array serves several shards.
        open_ = np.flatnonzero(again & ~settled[of])
        starts, ends = _spans(open_, LENGTH) if len(open_) else (open_, open_)
        k = of[starts]
        shift = lo[k] - begin[k]
        yield _rows(0, v[k], v[k], did[k], h[k], starts + shift, ends + shift, np.ones(len(k)))
        crowded = np.flatnonzero((parts[of] > 1) & ~later & (np.arange(len(text)) + LENGTH <= (begin + sizes)[of]))
        if len(crowded):
            view, digest = memoryview(np.ascontiguousarray(text)), xxhash.xxh3_64_intdigest
            k = of[crowded]
            windows = np.zeros(len(crowded), _WINDOW)
            windows["c"] = [digest(view[p : p + LENGTH]) for p in crowded.tolist()]
            windows["of"], windows["at"], windows["settled"] = k, crowded + lo[k] - begin[k], settled[k] | again[crowded]
            # As many ranges as the shard has parts, so that a merge sees about as much as a part.
            spread = (windows["c"] >> np.uint64(32)) * parts[k].astype(np.uint64) >> np.uint64(32)
            order = np.lexsort((windows["c"], spread, v[k]))
            windows, shard, spread = windows[order], v[k][order], spread[order].astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (spread[1:] != spread[:-1])]))
            ends = np.append(starts[1:], len(windows))
            packed = [_packed(windows[a:b].copy(), did, h) for a, b in zip(starts, ends, strict=True)]
            none = np.zeros(len(starts), np.int64)
            yield _rows(2, shard[starts], spread[starts], none, none, none, none, none, packed=packed)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of the input that repeat an id and a text bring their bytes once each: one of them is enough."""
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in (0, 1, 3, 4, 5)], 1)
            fresh = np.concatenate([[last is None or (keys[0] != last).any()], (keys[1:] != keys[:-1]).any(1)])
            last = keys[-1]
            yield batch if fresh.all() else batch.filter(pa.array(fresh))

    held, size = [], 0
    for batch in _whole_groups(once(batches), 2):
        v, part = (batch.column(k).to_numpy() for k in range(2))
        sizes = text_sizes(batch.column(7))
        starts = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (part[1:] != part[:-1])]))
        ends = np.concatenate([starts[1:], [len(v)]])
        lo = 0
        for end, add in zip(ends, np.add.reduceat(sizes, starts), strict=True):
            size += int(add)
            if size >= ARRAY:
                held.append(batch.slice(lo, end - lo))
                yield from solve(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, size, lo = [], 0, end
        if lo < len(v):
            held.append(batch.slice(lo))
    if held:
        yield from solve(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _both(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted digests of two arrays, and those of them that occur twice: the entries of one are looked up in the other."""
    (a, a_twice), (b, b_twice) = (one, other) if len(one[0]) >= len(other[0]) else (other, one)
    at = np.searchsorted(a, b)
    common = a[np.minimum(at, len(a) - 1)] == b
    fresh = ~common
    return np.insert(a, at[fresh], b[fresh]), np.unique(np.concatenate([a_twice, b_twice, b[common]]))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3 over packed arrays, sorted by shard and range: windows that other parts hold too."""

    def solve(v: int, packed: list[bytes]) -> pa.RecordBatch:
        parts = [_unpacked(p) for p in packed]
        arrays = [(windows["c"], windows["c"][:0]) for _, windows in parts]
        while len(arrays) > 1:
            arrays = [_both(*arrays[i : i + 2]) if i + 1 < len(arrays) else arrays[i] for i in range(0, len(arrays), 2)]
        twice = arrays[0][1]
        found = []
        for stretches, windows in parts:
            at = np.searchsorted(twice, windows["c"])
            hit = windows[(at < len(twice)) & ~windows["settled"]]
            at = np.searchsorted(twice, hit["c"])
            hit = hit[twice[at] == hit["c"]] if len(twice) else hit[:0]
            found.append((stretches["did"][hit["of"]], stretches["h"][hit["of"]], hit["at"].astype(np.int64)))
        did, h, lo = (np.concatenate(c) for c in zip(*found, strict=True))
        same = np.full(len(did), v, np.int64)
        return _rows(0, same, same, did, h, lo, lo + LENGTH, np.ones(len(did)))

    current, held = None, []
    for batch in batches:
        for v, c, packed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (v, c) != current:
                if len(held) > 1:
                    yield solve(current[0], held)
                current, held = (v, c), []
            held.append(packed)
    if len(held) > 1:
        yield solve(current[0], held)


def keyed(docs: DataFrame) -> DataFrame:
    """``did, h`` identify a document by id and text; repeated rows share them."""
    unknown = F.col("doc_id").isNull()
    return docs.withColumns({"did": F.coalesce("doc_id", F.lit(0)), "h": F.xxhash64(unknown, F.coalesce("text", F.lit("")))})


def _dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.repartition(shuffle_parts(df.sparkSession), *keys).sortWithinPartitions(*keys, *order)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``did, h, lo, hi``: byte ranges of repeated windows; ranges of a document may overlap.

    Repeated rows (same id and text) are places of their own.
    """
    small_batches(docs.sparkSession)
    texts = keyed(docs.select("doc_id", "text")).select("did", "h", "text")
    found = texts.mapInArrow(_runs, RUNS)
    sample = texts.filter(F.pmod(F.xxhash64("did", F.lit(7)), F.lit(SAMPLED)) == 0).mapInArrow(_runs, RUNS)
    large = stored(
        sample.groupBy("v")
        .agg((F.count(F.lit(1)) * SAMPLED).alias("_n"))
        .filter(F.col("_n") >= 8 * SAMPLED)
        .select("v", F.ceil(F.col("_n") / CROWD).cast("int").alias("_parts")),
        "large",
    )
    dealt = found.join(large, "v", "left").withColumn("parts", F.coalesce("_parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("did", "h", "lo"), F.col("parts")).cast("int"))
    dealt = dealt.select("v", "part", "parts", "c", "did", "h", "lo", "hi", "multi")
    first = stored(_dealt(dealt, ["v", "part"], ["c"]).mapInArrow(_settle, FOUND), "settled")

    columns = ["v", "c", "did", "h", "lo", "hi", "settled"]
    chosen = first.filter("kind = 1")
    across = stored(_dealt(chosen.filter("crowded").select(*columns), ["v", "c"], []).mapInArrow(_settle_parts, FOUND), "across")
    needed = chosen.filter("NOT crowded").select(*columns).unionAll(across.filter("kind = 1").select(*columns)).drop("c")
    sizes = needed.groupBy("v").agg(F.sum((F.col("hi") - F.col("lo")).cast("long")).alias("_bytes"))
    crowded = stored(
        sizes.filter(F.col("_bytes") > SHARD).select("v", F.ceil(F.col("_bytes") / SHARD).cast("int").alias("_parts")),
        "crowded",
    )
    needed = needed.join(crowded, "v", "left").withColumn("parts", F.coalesce("_parts", F.lit(1)))
    needed = needed.withColumn("part", F.pmod(F.xxhash64("did", "h", "lo", F.lit(3)), F.col("parts")).cast("int"))
    bytes_ = F.substring(F.col("text").cast("binary"), F.col("lo") + 1, F.col("hi") - F.col("lo"))
    pieces = needed.join(texts, ["did", "h"]).select("v", "part", "parts", "did", "h", "lo", "settled", bytes_.alias("bytes"))
    second = stored(_dealt(pieces, ["v", "part"], ["did", "h", "lo"]).mapInArrow(_arrays, FOUND), "arrays")
    windows = second.filter("kind = 2").select("v", "c", "packed")
    third = _dealt(windows, ["v", "c"], []).mapInArrow(_merge, FOUND)
    parts = [x.filter("kind = 0").select("did", "h", "lo", "hi") for x in (first, across, second, third)]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


def merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of byte ranges."""
    out: list[list[int]] = []
    for a, b in sorted(zip(lo, hi, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with ``_spans``: byte ranges of its text, NULL where nothing repeats."""
    lists = spans.groupBy("did", "h").agg(F.collect_set(F.struct("lo", "hi")).alias("_spans"))
    return keyed(docs).join(lists, ["did", "h"], "left").drop("did", "h")


def _kept(data: bytes, spans) -> tuple[list[tuple[int, int]], bytes]:
    gone = merged([s["lo"] for s in spans], [s["hi"] for s in spans]) if spans else []
    kept, at = [], 0
    for a, b in gone:
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return gone, b"".join(kept)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            data = (text.as_py() or "").encode()
            gone, kept = _kept(data, spans.as_py())
            rows.append((doc_id, len(data), sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        spans = batch.column(batch.schema.get_field_index("_spans"))
        texts = []
        for text, one in zip(batch.column(at), spans, strict=True):
            # A cut inside a character leaves its other bytes without meaning: they go too.
            texts.append(_kept(text.as_py().encode(), one.as_py())[1].decode("utf-8", "ignore") if one.is_valid else text.as_py())
        names = [n for n in batch.schema.names if n != "_spans"]
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(batch.schema.get_field_index(n)) for n in names]
        yield pa.RecordBatch.from_arrays(columns, names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with every byte of a repeated window taken out of ``text``, all other columns as they are."""
    return with_spans(docs, repeated_spans(docs)).mapInArrow(_cut, docs.schema)


def op9_suffixes(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = with_spans(docs, repeated_spans(docs)).select("doc_id", "text", "_spans")
    return marked.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
