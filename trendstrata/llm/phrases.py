"""Phrase collocation mining: suffix subtrees of words, built group by group.

The suffixes of all word sequences, cut to the longest phrase, are parted by their
first word.  A first word with more suffixes than a group may hold is extended by a
second word, and a pair by a third (vertical partitioning).  Prefixes fall into
buckets by a hash, and buckets are packed into groups of about equal weight
within the memory budget.  Each group's suffixes become one subtree: its leaves are
the distinct cut suffixes with their totals, and a node's count is the sum of the
leaves below it.

The texts are read once to weigh first words, once more for the pairs of those that
are too frequent, and once to send the leaves, packed, to their groups.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstrata.llm.common import mixed, runs, shuffle_parts, small_batches, stored, table

# Word and piece limits, and the query's bounds.
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
UNKNOWN = "und"
DEPTH = 3
LEAST = 10
WITHIN = 50  # per cent of a phrase's count that a longer one needs to replace it
TOP = 2000
SCALE = 1_000_000

SLICE = 1 << 23  # bytes of text whose leaves are put together before they are sent
MEMORY = 1 << 23  # suffixes of one group
BUCKETS = 8  # for each group

_LOWER = bytes(range(256)).lower()
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(SPACES)] = 1
_CLASS[list(BREAKS)] = 2
_BREAK = re.compile(b"[" + re.escape(BREAKS) + b"]")

WORDS = "lang string, word string, bucket long, n long"
PAIRS = "lang string, word string, word2 string, bucket long, n long"
LEAVES = "grp long, lang string, leaves binary"
NODES = "lang string, words int, w1 string, w2 string, w3 string, n long"


@dataclass
class Words:
    """The words of some texts of one language: ids into ``known``, and whether the next word follows in the same piece."""

    ids: np.ndarray
    follows: np.ndarray
    known: list[bytes]

    def after(self, by: int) -> np.ndarray:
        """Id plus one of the word ``by`` places on, 0 where the piece ends before it."""
        out = np.zeros(len(self.ids), np.int64)
        if len(self.ids) > by:
            there = self.follows[: len(self.ids) - by].copy()
            for k in range(1, by):
                there &= self.follows[k : len(self.ids) - by + k]
            out[:-by] = np.where(there, self.ids[by:] + 1, 0)
        return out


def words_of(text: bytes) -> Words:
    data = np.frombuffer(text.translate(_LOWER), np.uint8)
    kind = _CLASS[data]
    letter = np.concatenate([[False], kind == 0, [False]])
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    starts, ends = edges[::2], edges[1::2]
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    ends = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    chars = data[kind == 0]
    coded = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(chars)]).dictionary_encode()
    follows = np.zeros(len(starts), bool)
    follows[:-1] = piece[1:] == piece[:-1]
    return Words(coded.indices.to_numpy().astype(np.int64), follows, coded.dictionary.to_pylist())


def _stretches(text: bytes) -> Iterator[bytes]:
    """Cuts at the ends of pieces, so that no stretch is much longer than a slice unless one piece is."""
    lo = 0
    while len(text) - lo > SLICE:
        cut = max(text.rfind(bytes([b]), lo, lo + SLICE) for b in BREAKS)
        if cut < 0:
            found = _BREAK.search(text, lo + SLICE)
            cut = found.start() if found else len(text) - 1
        yield text[lo : cut + 1]
        lo = cut + 1
    yield text[lo:]


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """The words of about a slice of text at a time, language by language."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def told() -> Iterator[tuple[str, Words]]:
        for lang, texts in held.items():
            for text in _stretches(b"\n".join(texts)):
                found = words_of(text)
                if len(found.ids):
                    yield lang, found
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            text = text.as_py()
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= SLICE:
                yield from told()
                size = 0
    yield from told()


def _hashes(lang: str, known: list[bytes]) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    return mixed(np.fromiter((zlib.crc32(w, seed) for w in known), np.uint64, len(known)) + (np.uint64(seed) << np.uint64(32)))


def _longer(hashes: np.ndarray, nexts: np.ndarray) -> np.ndarray:
    """Hash of a prefix and one more word."""
    with np.errstate(over="ignore"):
        return mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + nexts)


def _texts(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())


def _word_counter(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _by_language(batches):
            n = np.bincount(words.ids, minlength=len(words.known))
            bucket = (_hashes(lang, words.known) % np.uint64(buckets)).astype(np.int64)
            columns = [pa.array([lang] * len(n)), _texts(words.known), pa.array(bucket), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "bucket", "n"])

    return run


def _pair_counter(frequent: Mapping[str, set[bytes]], buckets: int):
    """Counts of the pairs that begin with a frequent word; the second is NULL where a piece ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _by_language(batches):
            chosen = frequent.get(lang, set())
            held = np.fromiter((w in chosen for w in words.known), bool, len(words.known))
            mine = held[words.ids]
            size = len(words.known) + 1
            pairs, n = np.unique(words.ids[mine] * size + words.after(1)[mine], return_counts=True)
            first, second = pairs // size, pairs % size
            hashes = _hashes(lang, words.known)
            bucket = _longer(hashes[first], np.concatenate([[np.uint64(0)], hashes])[second]) % np.uint64(buckets)
            known = pa.array([None, *words.known], pa.binary()).cast(pa.string())
            columns = [
                pa.array([lang] * len(n), pa.string()), known.take(pa.array(first + 1)), known.take(pa.array(second)),
                pa.array(bucket.astype(np.int64)), pa.array(n),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "word2", "bucket", "n"])

    return run


@dataclass(frozen=True)
class Partition:
    """Which prefixes were extended, and the group of each bucket of prefixes."""

    words: Mapping[str, set[bytes]] = field(default_factory=dict)
    pairs: Mapping[str, set[tuple[bytes, bytes]]] = field(default_factory=dict)
    group_of: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))


def packed_groups(weights: np.ndarray, groups: int) -> np.ndarray:
    """The group of each bucket: heaviest first, each into the lightest group so far."""
    group_of = np.zeros(len(weights), np.int64)
    heap = [(0, g) for g in range(groups)]
    for bucket in np.argsort(-weights, kind="stable").tolist():
        load, g = heap[0]
        group_of[bucket] = g
        heapq.heapreplace(heap, (load + int(weights[bucket]), g))
    return group_of


def _summed(keys: tuple[np.ndarray, ...], n: np.ndarray, sizes: tuple[int, ...]) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Distinct rows of ``keys`` in order, and the sums of ``n`` over each."""
    if len(n) == 0:
        return keys, n
    bits = [max(1, int(s - 1).bit_length()) for s in sizes]
    if sum(bits) <= 63:
        packed = np.zeros(len(n), np.int64)
        for key, b in zip(keys, bits, strict=True):
            packed = packed << b | key
        order = np.argsort(packed)
        starts, _ = runs(packed[order])
    else:
        order = np.lexsort(keys[::-1])
        changed = np.zeros(len(n) - 1, bool)
        for key in keys:
            changed |= np.diff(key[order]) != 0
        starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
    return tuple(key[order[starts]] for key in keys), np.add.reduceat(n[order], starts)


def _pack(level: np.ndarray, keys: tuple[np.ndarray, ...], n: np.ndarray, known: list[bytes]) -> bytes:
    """Leaves with a word list of their own: a word holds no line break."""
    used, codes = np.unique(np.concatenate(keys), return_inverse=True)
    own = [b"" if k == 0 else known[k - 1] for k in used.tolist()]
    numbers = np.concatenate([[len(n)], n, codes, level]).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(numbers.tobytes() + b"\n".join(own))


def _unpack(leaves: bytes) -> tuple[np.ndarray, tuple[np.ndarray, ...], np.ndarray, list[bytes]]:
    data = zstandard.ZstdDecompressor().decompress(leaves)
    size = int(np.frombuffer(data, "<u4", 1)[0])
    numbers = np.frombuffer(data, "<u4", (DEPTH + 2) * size, 4).astype(np.int64).reshape(DEPTH + 2, size)
    return numbers[-1], tuple(numbers[1:-1]), numbers[0], data[4 * (1 + (DEPTH + 2) * size) :].split(b"\n")


def _leaf_sender(partition: Partition):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = np.uint64(len(partition.group_of))
        for lang, words in _by_language(batches):
            size = len(words.known) + 1
            keys = (words.ids + 1, words.after(1), words.after(2))
            keys, n = _summed(keys, np.ones(len(words.ids), np.int64), (size,) * DEPTH)

            chosen = partition.words.get(lang, set())
            frequent = np.fromiter((w in chosen for w in [b"", *words.known]), bool, size)
            level = 1 + frequent[keys[0]].astype(np.int64)
            if chosen and (pairs := partition.pairs.get(lang)):
                number = {w: k + 1 for k, w in enumerate(words.known)}
                there = [number[a] * size + (number[b] if b else 0) for a, b in pairs if a in number and (not b or b in number)]
                level += np.isin(keys[0] * size + keys[1], there)
            hashes = np.concatenate([[np.uint64(0)], _hashes(lang, words.known)])
            one = hashes[keys[0]]
            two = _longer(one, hashes[keys[1]])
            three = _longer(two, hashes[keys[2]])
            group = partition.group_of[np.choose(level - 1, [one, two, three]) % buckets]

            order = np.argsort(group, kind="stable")
            group, level, n = group[order], level[order], n[order]
            keys = tuple(k[order] for k in keys)
            starts, ends = runs(group)
            packed = [_pack(level[a:b], tuple(k[a:b] for k in keys), n[a:b], words.known) for a, b in zip(starts, ends, strict=True)]
            columns = [pa.array(group[starts]), pa.array([lang] * len(starts)), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["grp", "lang", "leaves"])

    return run


class Subtree:
    """The leaves of one group and language, and the nodes above them."""

    def __init__(self):
        self.number: dict[bytes, int] = {b"": 0}
        self.held: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, leaves: bytes, memory: int) -> None:
        level, keys, n, own = _unpack(leaves)
        number = self.number
        ids = np.fromiter((number.setdefault(w, len(number)) for w in own), np.int64, len(own))
        self.held.append((level, *[ids[k] for k in keys], n))
        self.rows += len(n)
        if self.rows > memory:
            self._fold()
            self.rows = 0  # until as many have come again

    def _fold(self) -> None:
        level, *keys, n = (np.concatenate(c) for c in zip(*self.held, strict=True))
        size = len(self.number)
        (*keys, level), n = _summed((*keys, level), n, (size,) * DEPTH + (DEPTH + 1,))
        self.held = [(level, *keys, n)]

    def nodes(self, least: int) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
        """``depth, words, count`` of the nodes from ``least`` on whose leaves are all in this group."""
        self._fold()
        level, *keys, n = self.held[0]
        for depth in range(1, DEPTH + 1):
            here = (level <= depth) & (keys[depth - 1] > 0)
            own = tuple(k[here] for k in keys[:depth])
            if len(own[0]) == 0:
                continue
            own, count = _summed(own, n[here], (len(self.number),) * depth)
            kept = count >= least
            yield depth, [k[kept] for k in own], count[kept]


def _tree_builder(least: int, memory: int):
    names = [part.split()[0] for part in NODES.split(", ")]

    def told(trees: dict[str, Subtree]) -> Iterator[pa.RecordBatch]:
        for lang, tree in trees.items():
            known = pa.array([None, *list(tree.number)[1:]], pa.binary()).cast(pa.string())
            for depth, words, count in tree.nodes(least):
                none = pa.nulls(len(count), pa.string())
                columns = [known.take(pa.array(w)) for w in words] + [none] * (DEPTH - depth)
                fixed = [pa.array([lang] * len(count), pa.string()), pa.array(np.full(len(count), depth, np.int32))]
                yield pa.RecordBatch.from_arrays([*fixed, *columns, pa.array(count)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trees = None, {}
        for batch in batches:
            for grp, lang, leaves in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if grp != group:
                    yield from told(trees)
                    group, trees = grp, {}
                trees.setdefault(lang, Subtree()).add(leaves, memory)
        yield from told(trees)

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, memory: int = MEMORY) -> tuple[DataFrame, DataFrame]:
    """``(nodes, sizes)``: counts of all phrases of up to three words from ``least`` on, and words per language.

    ``nodes`` holds ``lang, words, w1, w2, w3, n``.  Takes ``lang`` and ``text``,
    other columns are ignored; NULL languages are ``und``, NULL texts are
    empty.  Repeated rows count each.  An empty table gives no rows.

    ``memory`` bounds the suffixes of a group, except those of a single phrase,
    whose leaves are summed up as they come.  What reaches the driver are the
    prefixes above a group's share and ``BUCKETS`` weights per group.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = shuffle_parts(spark)
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))

    # The number of groups must be known before the words are: of each two bytes at most one begins a word.
    most = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    groups = parts * max(1, -(-most // 2 // (parts * memory)))
    buckets = BUCKETS * groups
    words = texts.mapInArrow(_word_counter(buckets), WORDS).groupBy("lang", "word", "bucket").agg(F.sum("n").alias("n"))
    words = stored(words, "words")
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    share = max(1, -(-total // groups))

    frequent: dict[str, set[bytes]] = {}
    for row in words.filter(F.col("n") > share).collect():
        frequent.setdefault(row["lang"], set()).add(row["word"].encode())
    weights = np.zeros(buckets, np.int64)
    for row in words.filter(F.col("n") <= share).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        weights[row["bucket"]] += row["n"]
    pairs: dict[str, set[tuple[bytes, bytes]]] = {}
    found = [words.filter(F.col("n") > share).select("lang", F.lit(1).alias("words"), F.col("word").alias("w1"), F.lit(None).cast("string").alias("w2"), "n")]
    if frequent:
        counted = texts.mapInArrow(_pair_counter(frequent, buckets), PAIRS)
        counted = stored(counted.groupBy("lang", "word", "word2", "bucket").agg(F.sum("n").alias("n")), "pairs")
        for row in counted.filter(F.col("n") > share).collect():
            second = None if row["word2"] is None else row["word2"].encode()
            pairs.setdefault(row["lang"], set()).add((row["word"].encode(), second))
            weights += row["n"] // buckets  # its third words spread over all buckets
        for row in counted.filter(F.col("n") <= share).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            weights[row["bucket"]] += row["n"]
        whole = counted.filter((F.col("n") > share) & F.col("word2").isNotNull())
        found.append(whole.select("lang", F.lit(2).alias("words"), F.col("word").alias("w1"), F.col("word2").alias("w2"), "n"))

    partition = Partition(frequent, pairs, packed_groups(weights, groups))
    leaves = texts.mapInArrow(_leaf_sender(partition), LEAVES)
    leaves = leaves.repartitionById(parts, F.pmod("grp", F.lit(parts)).cast("int")).sortWithinPartitions("grp")
    nodes = leaves.mapInArrow(_tree_builder(least, memory), NODES)
    for counts in found:  # what lies in several groups was counted when it was weighed
        counts = counts.filter(F.col("n") >= least)
        nodes = nodes.unionByName(counts.select("lang", "words", "w1", "w2", F.lit(None).cast("string").alias("w3"), "n"))
    return stored(nodes, "nodes"), sizes


def _score(a: Column, part: Column, rest: Column) -> Column:
    """floor(SCALE a a / (l r)) in whole numbers of up to 38 digits."""
    wide = [c.cast("decimal(19,0)") for c in (a, part, rest)]
    above = (wide[0] * wide[0]).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", above.cast("decimal(38,0)"), (wide[1] * wide[2]).cast("decimal(38,0)"))


def collocations(
    nodes: DataFrame, sizes: DataFrame, least: int = LEAST, within: int = WITHIN, top: int = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of two and three words.

    Candidates occur ``least`` times.  The lowest-scoring cut counts, of equal
    ones the first.  A phrase inside a longer candidate with at least
    ``within`` per cent of its occurrences is left out.  Ties go by count and phrase.
    """

    def of(words: int, *names: str, n: str) -> DataFrame:
        chosen = nodes.filter((F.col("words") == words) & (F.col("n") >= least))
        return chosen.select("lang", *[F.col(f"w{k + 1}").alias(name) for k, name in enumerate(names)], F.col("n").alias(n))

    two = of(2, "w1", "w2", n="a").join(of(1, "w1", n="l"), ["lang", "w1"]).join(of(1, "w2", n="r"), ["lang", "w2"])
    three = (
        of(3, "w1", "w2", "w3", n="a")
        .join(of(1, "w1", n="l1"), ["lang", "w1"])
        .join(of(2, "w2", "w3", n="r1"), ["lang", "w2", "w3"])
        .join(of(2, "w1", "w2", n="l2"), ["lang", "w1", "w2"])
        .join(of(1, "w3", n="r2"), ["lang", "w3"])
        .withColumns({"s1": _score(F.col("a"), F.col("l1"), F.col("r1")), "s2": _score(F.col("a"), F.col("l2"), F.col("r2"))})
    )
    first = F.col("s1") <= F.col("s2")
    inside = of(3, "w1", "w2", "w3", n="a")
    inside = inside.select("lang", "w1", "w2", "a").unionAll(inside.select("lang", F.col("w2"), F.col("w3"), "a"))
    longest = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("_longer"))
    two = (
        two.join(longest, ["lang", "w1", "w2"], "left")
        .filter(F.coalesce(F.col("_longer").cast("decimal(38,0)"), F.lit(0)) * 100 < F.col("a").cast("decimal(38,0)") * within)
        .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    )
    three = three.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    # Spark keeps the first rows of each task before they meet.
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(*phrase_counts(table(spark, sf_dir, "documents")))


ORACLE = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, regexp_extract_all(part, '[^\x20\x09]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part
      FROM documents))
  WHERE len(words) > 0),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, gram, count(*) AS f FROM (
    SELECT lang, words[i] AS gram FROM places
    UNION ALL SELECT lang, words[i] || ' ' || words[i + 1] FROM places WHERE i + 1 <= len(words)
    UNION ALL SELECT lang, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FROM places WHERE i + 2 <= len(words))
  GROUP BY ALL HAVING count(*) >= 10),
sizes AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
candidates AS (
  SELECT lang, gram, f AS a, string_split(gram, ' ') AS w FROM grams WHERE contains(gram, ' ')),
parts AS (
  SELECT lang, gram, len(w) AS k, a, 1 AS cut, w[1] AS part, array_to_string(w[2:], ' ') AS rest FROM candidates
  UNION ALL SELECT lang, gram, 3, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE len(w) = 3),
cuts AS (
  SELECT c.lang, c.gram, c.k, c.a, c.cut, p.f AS l, q.f AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (p.f::HUGEINT * q.f) AS BIGINT) AS score
  FROM parts c JOIN grams p ON p.lang = c.lang AND p.gram = c.part JOIN grams q ON q.lang = c.lang AND q.gram = c.rest),
scored AS (
  SELECT lang, gram, k, a, l, r, score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, gram, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS gram, a FROM candidates WHERE len(w) = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE len(w) = 3) GROUP BY ALL),
kept AS (
  SELECT s.*, s.gram AS phrase FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.gram = s.gram
  WHERE coalesce(i.longer, 0) * 100 < s.a * 50),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
