"""Jaccard join of documents on word shingles by chosen paths.

Documents with equal shingle sets form a class; one of them takes part.  Its
set is embedded as ``HASHES`` min-hash values.  A run starts with all sets in one
node; a node chooses coordinates (1 / threshold in expectation, at least one)
and sends each set to the child named by its value there, so similar sets tend to
choose the same paths.  Nodes of at most ``SMALL`` sets are compared by brute
force, larger ones are split again, up to ``DEPTH`` times; those that stay
large - sets that really are alike - are compared in parts, and the parts through
representatives.  ``runs_for`` repeats the recursion until a pair at the
threshold is found with the target probability.

Brute force compares signatures with room for their error and gives a graph of
candidates.  Its components are small clusters of documents, each of which goes with
its whole shingle sets to one task, or to a task per pair of blocks, for exact
similarities.  Links are counted there and never written out as pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendstrata.llm.common import mixed, shuffle_parts, slices, small_batches, stored, table, text_sizes
from trendstrata.llm.graph import components

WORDS = 5  # of a shingle
THRESHOLD = 0.8
RECALL = 0.99  # of the chosen paths, for a pair at the threshold that needs DEPTH splits
HASHES = 64
SMALL = 512  # sets compared by brute force
DEPTH = 4
ALIKE = 0.62  # share of equal min-hash values that makes a candidate
NEAR = 0.85  # a part's representative stands for sets with this share
FAR = 0.4  # representatives of two parts with this share connect them
BLOCK = 256  # documents of one exact comparison
SLICE = 1 << 22

_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, size=(2, HASHES), dtype=np.uint64) | np.uint64(1)
_MIX = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(WORDS)]


def runs_for(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met in a node of the given depth with probability ``recall``."""
    second = 1 / threshold - 1
    stays = 1 - (1 - threshold) * (1 - second * threshold)
    return math.ceil(math.log(1 - recall) / math.log(1 - stays**depth))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; a shorter text is one shingle, one without words has none."""
    import xxhash

    parts = text.split()
    if not parts:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(p) for p in parts], np.uint64)
    if len(h) < words:
        one = np.array([len(h)], np.uint64)
        for k in range(len(h)):
            one = mixed(one ^ h[k : k + 1] * _MIX[k])
        return one
    n = len(h) - words + 1
    total = np.zeros(n, np.uint64)
    for k in range(words):
        total += mixed(h[k : k + n]) * _MIX[k]
    return np.unique(mixed(total))


def signature(s: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(s), 4096):
        values = (s[None, i : i + 4096] * _SEEDS[0][:, None] + _SEEDS[1][:, None]) >> np.uint64(32)
        least = np.minimum(least, values.min(1).astype(np.uint32))
    return least


SIGNED = "rid long, doc_id long, h long, n int, f1 long, f2 long, sig binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    row = TaskContext.get().partitionId() << 33
    for whole in batches:
        for batch in slices(whole, text_sizes(whole.column(2)), SLICE):
            n, f1, f2, sig = [], [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py() or "")
                data = s.tobytes()
                n.append(len(s))
                f1.append(xxhash.xxh3_64_intdigest(data, 1))
                f2.append(xxhash.xxh3_64_intdigest(data, 2))
                sig.append(signature(s).tobytes() if len(s) else None)
            rid = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            columns = [pa.array(rid), batch.column(0), batch.column(1), pa.array(n, pa.int32())]
            columns += [pa.array(np.array(f, np.uint64).view(np.int64)) for f in (f1, f2)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sig, pa.binary())], ["rid", "doc_id", "h", "n", "f1", "f2", "sig"]
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _children(nodes: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and child nodes: every node's coordinates come from its own name."""
    one, two = mixed(nodes ^ np.uint64(0xA5A5)), mixed(nodes ^ np.uint64(0x5A5A5A))
    rows = np.arange(len(nodes))
    more = rows[(two >> np.uint64(11)) < np.uint64((1 / THRESHOLD - 1) * 2**53)]
    row = np.concatenate([rows, more])
    at = np.concatenate([one % np.uint64(HASHES), mixed(two)[more] % np.uint64(HASHES)]).astype(np.int64)
    value = sig[row, at].astype(np.uint64)
    return row, mixed(mixed(nodes[row] + np.uint64(1)) ^ mixed(value | (at.astype(np.uint64) << np.uint64(32))))


def _root(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _matrix(batch.column(1))
            nodes = np.tile(np.arange(1, count + 1, dtype=np.uint64), len(sig))
            row, child = _children(mixed(nodes), np.repeat(sig, count, axis=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row // count)), pa.array(child.view(np.int64))], ["rid", "node"]
            )

    return run


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            row, child = _children(batch.column(2).to_numpy().view(np.uint64), _matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(child.view(np.int64))], ["rid", "node"]
            )


def paths(signed: DataFrame, count: int) -> DataFrame:
    """``node, rid, parts``: the nodes to compare by brute force, and into how many parts a large one goes."""
    level = signed.select("rid", "sig").mapInArrow(_root(count), "rid long, node long")
    leaves = None
    for depth in range(1, DEPTH + 1):
        level = stored(level, "level")
        sizes = stored(level.groupBy("node").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "nodes")
        shared = level.join(sizes, "node")
        last = depth == DEPTH
        parts = F.ceil(F.col("_n") / SMALL).cast("int").alias("parts")
        ready = (shared if last else shared.filter(F.col("_n") <= SMALL)).select("node", "rid", parts)
        leaves = ready if leaves is None else leaves.unionAll(ready)
        large = sizes.filter(F.col("_n") > SMALL)
        if last or large.isEmpty():
            break
        again = level.join(large, "node").select("rid", "node").join(signed.select("rid", "sig"), "rid")
        level = again.select("rid", "sig", "node").mapInArrow(_split, "rid long, node long")
    return leaves


def _alike(sig: np.ndarray) -> np.ndarray:
    """Share of equal min-hash values of all pairs of rows."""
    equal = np.zeros((len(sig), len(sig)), np.int16)
    for k in range(HASHES):
        column = sig[:, k]
        equal += column[:, None] == column[None, :]
    return equal / HASHES


def _forest(linked: np.ndarray, ids: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges from every row to the smallest id of its component, given a symmetric matrix."""
    todo, a, b = np.ones(len(ids), bool), [], []
    for i in np.argsort(ids, kind="stable"):
        if not todo[i]:
            continue
        member = np.zeros(len(ids), bool)
        new = np.array([i])
        member[i] = True
        while len(new):
            reached = linked[new].any(0) & ~member
            member |= reached
            new = np.flatnonzero(reached)
        todo &= ~member
        others = ids[member & (ids != ids[i])]
        a += others.tolist()
        b += [int(ids[i])] * len(others)
    return a, b


# kind 0: a candidate edge; 1: a representative of a part, `b` its row, with node and signature.
LINKS = "kind int, a long, b long, sig binary"


def _links(kind: int, a, b, sig=None) -> pa.RecordBatch:
    sigs = pa.array([None] * len(a) if sig is None else [s.tobytes() for s in sig], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), sigs],
        ["kind", "a", "b", "sig"],
    )


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The rows of each stretch of equal first ``keys`` columns, as one batch."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            key = tuple(x[lo] for x in columns)
            if rest and key != last:
                yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
                rest = []
            rest.append(batch.slice(lo, hi - lo))
            last = key
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brute force in a node or a part of one: ``node, part, parts, rid, sig``."""
    a: list[int] = []
    b: list[int] = []
    for rows in _grouped(batches, 2):
        parts = rows.column(2)[0].as_py()
        ids, sig = rows.column(3).to_numpy(), _matrix(rows.column(4))
        if len(ids) > 1:
            share = _alike(sig)
            more = _forest(share >= ALIKE, ids)
            a += more[0]
            b += more[1]
        if parts > 1:
            share = _alike(sig)
            open_, chosen = np.ones(len(ids), bool), []
            while open_.any():
                one = int(np.argmax(open_))
                chosen.append(one)
                open_ &= share[one] < NEAR
                open_[one] = False
            node = np.full(len(chosen), rows.column(0)[0].as_py())
            yield _links(1, node, ids[chosen], sig[chosen])
        if len(a) > 50_000:
            yield _links(0, a, b)
            a, b = [], []
    yield _links(0, a, b)


def _connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the close representatives of a node's parts: ``node, rid, sig``; block against block."""
    for rows in _grouped(batches, 1):
        ids, sig = rows.column(1).to_numpy(), _matrix(rows.column(2))
        tree, a, b = np.arange(len(ids)), [], []
        for i in range(0, len(ids), 256):
            for j in range(0, i + 256, 256):
                x, y = np.nonzero((sig[i : i + 256, None, :] == sig[None, j : j + 256, :]).mean(2) >= FAR)
                x, y = x + i, y + j
                while True:
                    apart = tree[x] != tree[y]
                    if not apart.any():
                        break
                    x, y = x[apart], y[apart]
                    a.append(int(ids[x[0]]))
                    b.append(int(ids[y[0]]))
                    tree[tree == tree[y[0]]] = tree[x[0]]
        yield _links(0, a, b)


def candidates(signed: DataFrame) -> DataFrame:
    """Candidate edges ``a, b`` between rows: a spanning forest of each node's similar sets."""
    leaves = paths(signed, runs_for())
    part = F.pmod(F.xxhash64("rid", "node"), F.col("parts")).cast("int").alias("part")
    compared = leaves.select("node", part, "parts", "rid").join(signed.select("rid", "sig"), "rid")
    compared = compared.select("node", "part", "parts", "rid", "sig")
    n = shuffle_parts(signed.sparkSession)
    together = compared.repartition(n, "node", "part").sortWithinPartitions("node", "part")
    found = stored(together.mapInArrow(_compare, LINKS), "candidates")
    heads = found.filter("kind = 1").select(F.col("a").alias("node"), F.col("b").alias("rid"), "sig")
    joined = heads.repartition(n, "node").sortWithinPartitions("node").mapInArrow(_connect, LINKS)
    return found.filter("kind = 0").select("a", "b").unionAll(joined.select("a", "b"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        data = pa.array([shingles(t.as_py() or "").tobytes() for t in batch.column(at)], pa.binary())
        rest = [i for i in range(batch.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in rest], data], [*[batch.schema.names[i] for i in rest], "tokens"]
        )


def similarities(sets: list[np.ndarray]) -> np.ndarray:
    """Exact Jaccard similarity of all pairs: products of incidence columns, a bounded number at a time."""
    sizes = np.array([len(s) for s in sets])
    tokens, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    seen = np.bincount(at, minlength=len(tokens))
    number = np.cumsum(seen > 1) - 1  # tokens of one set alone are in no intersection
    keep = seen[at] > 1
    row, column = row[keep], number[at[keep]]
    inter = np.zeros((len(sets), len(sets)), np.float64)
    by_column = np.argsort(column, kind="stable")
    row, column = row[by_column], column[by_column]
    width = 2048
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [lo, lo + width])
        part = np.zeros((len(sets), width), np.float32)
        part[row[i:j], column[i:j] - lo] = 1
        inter += part @ part.T
    return inter / np.maximum(sizes[:, None] + sizes[None, :] - inter, 1)


COUNTED = "rid long, other long, links long"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links in a cluster, or between two blocks of one: ``label, low, high, block, rid, tokens``.

    A row per document with its links here, and one per edge of a spanning forest of the links (``other``).
    """
    for rows in _grouped(batches, 3):
        low, high = rows.column(1)[0].as_py(), rows.column(2)[0].as_py()
        ids, first = np.unique(rows.column(4).to_numpy(), return_index=True)
        block = rows.column(3).to_numpy()[first]
        tokens = rows.column(5)
        linked = similarities([np.frombuffer(tokens[int(i)].as_py(), np.uint64) for i in first]) >= THRESHOLD - 1e-12
        np.fill_diagonal(linked, False)
        if low != high:
            linked &= block[:, None] != block[None, :]
        a, b = _forest(linked, ids)
        count = linked.sum(1)
        some = count > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids[some], np.array(a, np.int64)])),
             pa.array([*[None] * int(some.sum()), *b], pa.int64()),
             pa.array(np.concatenate([count[some], np.zeros(len(a), np.int64)]).astype(np.int64))],
            ["rid", "other", "links"],
        )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, n_copies`` and ``did, h, first``.

    Takes ``doc_id, text``.  Shingles are runs of five white-space separated
    words as they are; a shorter text is one shingle.  ``n_copies`` documents
    have the same shingles as this one, ``n_links`` other shingle sets have a
    Jaccard similarity of 0.8 or more.  ``class_id`` is the smallest id among all
    documents that links and copies connect; ``first`` marks one row of them.
    A text without words (also NULL or empty) is alone in its class.
    Repeated rows are copies.  ``did, h`` identify id and text.
    """
    small_batches(docs.sparkSession)
    unknown = F.col("doc_id").isNull()
    keys = {"did": F.coalesce("doc_id", F.lit(0)), "h": F.xxhash64(unknown, F.coalesce("text", F.lit("")))}
    texts = docs.select("doc_id", "text").withColumns(keys)
    signed = stored(texts.select("doc_id", "h", "text").mapInArrow(_sign, SIGNED), "signatures")
    kinds = signed.filter("n > 0").groupBy("f1", "f2").agg(
        F.min("rid").alias("rid"), F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("n_copies")
    )
    kinds = stored(kinds, "kinds")
    ones = stored(kinds.select("rid").join(signed, "rid").select("rid", "doc_id", "h", "sig"), "representatives")

    clusters = stored(components(candidates(ones)), "clusters")
    sizes = clusters.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks"))
    sizes = stored(sizes, "sizes")
    members = clusters.select(F.col("v").alias("rid"), "label").join(ones.select("rid", "doc_id", "h"), "rid")
    members = members.withColumn("did", F.coalesce("doc_id", F.lit(0)))
    found = members.join(texts.select("did", "h", "text"), ["did", "h"]).select("rid", "label", "text")
    sets = found.mapInArrow(_sets, "rid long, label long, tokens binary").join(sizes, "label")
    block = F.pmod(F.xxhash64("rid"), F.col("_blocks")).cast("int")
    sets = sets.withColumn("block", block).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    sets = sets.select(
        "label", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"), "block", "rid", "tokens"
    )
    n = shuffle_parts(docs.sparkSession)
    together = sets.repartition(n, "label", "low", "high").sortWithinPartitions("label", "low", "high")
    counted = stored(together.mapInArrow(_verify, COUNTED), "links")

    labels = components(counted.filter("other IS NOT NULL"), "rid", "other").withColumnRenamed("v", "rid")
    links = counted.groupBy("rid").agg(F.sum("links").alias("n_links"))
    known = kinds.join(labels, "rid", "left").join(links, "rid", "left")
    known = known.withColumns({"label": F.coalesce("label", "rid"), "n_links": F.coalesce("n_links", F.lit(0))})
    known = stored(known, "known")
    least = stored(known.groupBy("label").agg(F.min("_least").alias("class_id")), "classes")
    info = stored(known.join(least, "label").select("f1", "f2", "label", "class_id", "n_links", "n_copies"), "info")
    rows = signed.select("rid", "doc_id", "h", "n", "f1", "f2").join(info, ["f1", "f2"], "left")
    none = F.col("n") == 0
    rows = rows.select(
        "rid",
        "doc_id",
        F.when(none, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(none, F.lit(0)).otherwise(F.col("n_links")).alias("n_links"),
        F.when(none, F.lit(1)).otherwise(F.col("n_copies")).alias("n_copies"),
        F.coalesce("doc_id", F.lit(0)).alias("did"),
        "h",
        F.when(none, -1 - F.col("rid")).otherwise(F.col("label")).alias("_label"),
    )
    rows = stored(rows, "documents")
    chosen = rows.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("_label").agg(F.min("rid").alias("rid"))
    return (
        rows.join(chosen.select("rid", F.lit(True).alias("first")), "rid", "left")
        .withColumn("first", F.coalesce("first", F.lit(False)))
        .drop("rid", "_label")
    )


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their classes; of rows that repeat id and text, one."""
    unknown = F.col("doc_id").isNull()
    keys = {"_did": F.coalesce("doc_id", F.lit(0)), "_h": F.xxhash64(unknown, F.coalesce("text", F.lit("")))}
    alone = found.filter("first").groupBy(F.col("did").alias("_did"), F.col("h").alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    number = F.row_number().over(Window.partitionBy("_did", "_h").orderBy(F.lit(0)))
    kept = docs.withColumns(keys).join(alone, ["_did", "_h"]).withColumn("_row", number)
    return kept.filter(F.col("_row") <= F.col("_n")).select(*docs.columns)


def op6_jaccard(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")
