"""Approximate nearest neighbours by multiprobe p-stable hashing.

``TABLES`` tables hash a vector to ``m`` cells ``floor((a.x + b) / w)`` of
Gaussian projections.  A query visits ``PROBES`` buckets of each table: its own
and those with perturbed cells, in order of the estimated chance of success.
The estimate orders sets of the ``2 m`` cell borders by the sum of expected
squared distances, once for all queries; a query's own borders, sorted by
distance, fill the sets.

A bucket's vectors and the queries that visit it meet in one task, where exact
distances give the nearest few; the nearest of all tables are merged.  Buckets
of more than ``SPLIT`` vectors are dealt to several tasks, whole.  Queries that
met fewer than ``k`` vectors, such as those far from the rest, are compared with
all rows, block against block.

``w`` follows the spread of a sample.  ``m`` follows the number of rows as far as
the recall allows: a sample of queries gets its exact nearest in one pass, and
``m`` is the largest with which these lie in the buckets visited, for
``WANTED`` of them.  So buckets keep their size as the table grows where the data
has structure, and grow with it where it has none: in near-isotropic vectors of 64
dimensions the nearest vector is hardly nearer than others, and 0.9 recall takes
candidates from more than half of all rows; see the README.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstrata.llm.common import mixed, shuffle_parts, stored, table
from trendstrata.llm.vectors import best, element, matrices, valid

TABLES = 12
PROBES = 64
WIDTH = 2.0  # cell width in units of the sample's spread
SAMPLE = 4096  # rows that set the spread, those with the smallest hash
TRIED = 64  # queries that set the number of projections, those with the smallest hash
WANTED = 0.95  # share of their nearest in visited buckets, above the 0.9 required since it is a sample's
PAIRS = 10**11  # of a query and a row that may be compared where hashing does not serve
SPLIT = 8192  # vectors of a bucket in one task
CHUNK = 2048  # vectors compared at once
HELD = 50_000  # queries whose nearest a task holds before it emits them
SEED = 20_240_229


def cells(rows: int) -> int:
    """Projections per table, at most."""
    return max(4, round(math.log2(max(rows, 2)) / 2))


@lru_cache(maxsize=8)
def projections(dim: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    return rng.normal(size=(dim, TABLES * m)), rng.uniform(size=TABLES * m)


@lru_cache(maxsize=8)
def perturbations(m: int, count: int) -> list[tuple[int, ...]]:
    """Sets of border ranks (0 the nearest), the most promising first; ranks ``j`` and ``2m-1-j`` are one cell's two borders."""
    near = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    far = [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    cost = near + far
    found: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(found) < count:
        total, ranks = heapq.heappop(heap)
        if all(2 * m - 1 - r not in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*ranks, last + 1)))
    return found


def _folded(grid: np.ndarray, dim: int, number: int) -> np.ndarray:
    """One key for the cells along the last axis, the table and the length."""
    key = mixed(np.full(grid.shape[:-1], dim * 1009 + number, np.uint64))
    for i in range(grid.shape[-1]):
        key = mixed(key ^ grid[..., i].astype(np.int64).view(np.uint64))
    return key.view(np.int64)


def bucket_keys(x: np.ndarray, m: int, width: float) -> np.ndarray:
    """``rows x TABLES`` keys."""
    a, b = projections(x.shape[1], m)
    grid = np.floor(x.astype(np.float64) @ a / width + b).reshape(len(x), TABLES, m)
    return np.stack([_folded(grid[:, t], x.shape[1], t) for t in range(TABLES)], axis=1)


def probe_keys(x: np.ndarray, m: int, width: float) -> np.ndarray:
    """``rows x TABLES x probes`` keys in order of estimated success."""
    a, b = projections(x.shape[1], m)
    at = (x.astype(np.float64) @ a / width + b).reshape(len(x), TABLES, m)
    base = np.floor(at)
    inside = at - base
    order = np.argsort(np.concatenate([inside, 1 - inside], axis=2), axis=2, kind="stable")
    cell, step = order % m, np.where(order < m, -1, 1)
    sets = perturbations(m, PROBES)
    rows, tables = np.ogrid[: len(x), :TABLES]
    out = np.empty((len(x), TABLES, len(sets)), np.int64)
    for s, ranks in enumerate(sets):
        grid = base.copy()
        for r in ranks:
            grid[rows, tables, cell[:, :, r]] += step[:, :, r]
        out[:, :, s] = np.stack([_folded(grid[:, t], x.shape[1], t) for t in range(TABLES)], axis=1)
    return out


def _hasher(m: int, width: float, probe: bool, batch_rows: int = 256):
    """Rows ``key, kind, id, vec``: a vector for each table, or a query for each bucket it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(begin, batch_rows)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                for rows, x in matrices(batch):
                    keys = (probe_keys if probe else bucket_keys)(x, m, width).reshape(len(x), -1)
                    each = keys.shape[1]
                    if probe:  # two visited buckets of a query differ, but for colliding keys
                        keys = np.sort(keys, axis=1)
                    taken = pa.array(np.repeat(rows, each))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.reshape(-1)), pa.array(np.full(keys.size, 0 if probe else 1, np.int32)),
                         pa.array(np.repeat(ids[rows], each)), batch.column(1).take(taken)],
                        ["key", "kind", "id", "vec"],
                    )

    return run


def _keys(m: int, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in matrices(batch):
                keys, counts = np.unique(bucket_keys(x, m, width), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    return run


class _Nearest:
    """The nearest found so far, per query, by exact distance."""

    def __init__(self, k: int):
        self.k, self.found = k, {}

    def add(self, ids: np.ndarray, queries: np.ndarray, data_ids: np.ndarray, data: np.ndarray) -> None:
        square = (queries**2).sum(1)[:, None] + (data**2).sum(1)[None] - 2 * queries @ data.T
        own = ids[:, None] == data_ids[None]
        square[own] = np.inf
        by_id = np.argsort(data_ids, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(data_ids[by_id]) != 0))
        # Rows that repeat an id count once, by the nearest.
        each = square if len(starts) == len(data) else np.minimum.reduceat(square[:, by_id], starts, axis=1)
        k = min(self.k, each.shape[1])
        limit = np.partition(each, k - 1, axis=1)[:, k - 1]
        slack = 1e-9 * (1 + np.abs(limit) + (queries**2).sum(1))
        for i in range(len(ids)):
            near = np.flatnonzero((square[i] <= limit[i] + slack[i]) & ~own[i])
            if len(near) == 0:
                continue
            exact = np.sqrt(((data[near] - queries[i]) ** 2).sum(1))
            ordered = np.lexsort((data_ids[near], exact))
            best_ = ordered[np.sort(np.unique(data_ids[near][ordered], return_index=True)[1])[: self.k]]
            held = self.found.setdefault(int(ids[i]), {})
            for at in best_:
                one, d = int(data_ids[near[at]]), float(exact[at])
                if d < held.get(one, math.inf):
                    held[one] = d
            if len(held) > 8 * self.k:
                self._cut(int(ids[i]))

    def _cut(self, query: int) -> list[tuple[float, int]]:
        kept = heapq.nsmallest(self.k, ((d, v) for v, d in self.found[query].items()))
        self.found[query] = {v: d for d, v in kept}
        return kept

    def emit(self) -> pa.RecordBatch:
        rows = [(q, v, d) for q in self.found for d, v in self._cut(q)]
        self.found = {}
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
            ["query_id", "vec_id", "score"],
        )


def _searcher(k: int):
    """Stream over rows sorted by bucket, queries first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = _Nearest(k)
        current, ids, queries = None, [], []
        for batch in batches:
            keys = batch.column(0).to_numpy()
            part = batch.column(1).to_numpy()
            kind = batch.column(2).to_numpy()
            all_ids = batch.column(3).to_numpy()
            vec = batch.column(4)
            change = np.concatenate([[True], (keys[1:] != keys[:-1]) | (part[1:] != part[:-1]) | (kind[1:] != kind[:-1])])
            starts = np.flatnonzero(change)
            for lo, hi in zip(starts, [*starts[1:], len(keys)], strict=True):
                at = (keys[lo], part[lo])
                if at != current:
                    current, ids, queries = at, [], []
                if kind[lo] == 1 and not ids:
                    continue  # no query visits this bucket
                dim = len(vec[int(lo)])
                flat = vec.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False)
                if flat.size != dim * (hi - lo):
                    raise ValueError("two lengths share a bucket key")
                x = flat.reshape(-1, dim).astype(np.float64)
                if kind[lo] == 0:
                    ids.append(all_ids[lo:hi])
                    queries.append(x)
                    continue
                q_ids, q = np.concatenate(ids), np.concatenate(queries)
                for i in range(0, len(x), CHUNK):
                    for j in range(0, len(q), CHUNK):
                        nearest.add(q_ids[j : j + CHUNK], q[j : j + CHUNK], all_ids[lo + i : lo + min(i + CHUNK, hi - lo)], x[i : i + CHUNK])
            if len(nearest.found) > HELD:
                yield nearest.emit()
        yield nearest.emit()

    return run


def spread(vectors: DataFrame) -> float:
    """Root mean square distance of a bounded sample from its mean, as the unit of the cell width."""
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()["vec"]
    total, count = 0.0, 0
    for size in {len(v) for v in drawn}:
        x = np.array([v for v in drawn if len(v) == size], np.float64)
        total += float(((x - x.mean(0)) ** 2).sum())
        count += len(x)
    return math.sqrt(total / count) if count and total else 1.0


def _exact(shared, k: int):
    """The nearest of a few queries among a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = _Nearest(k)
        asked = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for rows, x in matrices(batch):
                if x.shape[1] not in asked:
                    continue
                q_ids, q = asked[x.shape[1]]
                for i in range(0, len(x), CHUNK):
                    nearest.add(q_ids, q, ids[rows[i : i + CHUNK]], x[i : i + CHUNK].astype(np.float64))
        yield nearest.emit()

    return run


def _stacked(rows) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of collected rows by vector length."""
    found: dict[int, list] = {}
    for r in rows:
        found.setdefault(len(r["vec"]), []).append(r)
    return {n: (np.array([r["vec_id"] for r in own], np.int64), np.array([r["vec"] for r in own], np.float64)) for n, own in found.items()}


def recall(near: dict[int, set[int]], asked: dict, data: dict, m: int, width: float) -> float:
    """Share of the ``near`` ids of each query that have a vector in a bucket the query visits."""
    hit = 0
    for dim, (q_ids, q) in asked.items():
        if dim not in data:
            continue
        keys = bucket_keys(data[dim][1], m, width)
        for one, visited in zip(q_ids.tolist(), probe_keys(q, m, width), strict=True):
            met = np.any([np.isin(keys[:, t], visited[t]) for t in range(TABLES)], axis=0)
            hit += len(near.get(one, set()) & set(data[dim][0][met].tolist()))
    return hit / max(1, sum(map(len, near.values())))


def projections_for(data: DataFrame, asked: DataFrame, k: int, most: int, width: float) -> int:
    """The largest number of projections, up to ``most``, with ``WANTED`` recall for a sample of the queries; 0 if none has."""
    drawn = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRIED).collect()
    sample = _stacked({r["vec_id"]: r for r in drawn}.values())
    shared = data.sparkSession.sparkContext.broadcast(sample)
    exact = best(data.mapInArrow(_exact(shared, k), "query_id long, vec_id long, score double"), k, ascending=True).collect()
    near: dict[int, set[int]] = {}
    for r in exact:
        near.setdefault(r["query_id"], set()).add(r["vec_id"])
    wanted = data.sparkSession.createDataFrame([(v,) for v in set().union(*near.values())], "vec_id long")
    rows = _stacked(data.join(F.broadcast(wanted), "vec_id").select("vec_id", "vec").collect())
    for m in range(most, 0, -1):
        if not near or recall(near, sample, rows, m, width) >= WANTED:
            return m
    return 0


def _met(stored_rows: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """The best of each query among the vectors with its ``key`` and ``part``."""
    columns = ["key", "part", "kind", "id", "vec"]
    met = stored_rows.select(*columns).unionByName(visits.select(*columns))
    met = met.repartition(shuffle_parts(met.sparkSession), "key", "part").sortWithinPartitions("key", "part", "kind")
    return best(met.mapInArrow(_searcher(k), "query_id long, vec_id long, score double"), k, ascending=True)


def exact_neighbours(data: DataFrame, asked: DataFrame, k: int, rows: int) -> DataFrame:
    """``nearest_neighbours`` of valid vectors by comparing blocks of queries with blocks of the ``rows`` vectors."""
    blocks, groups = max(1, -(-rows // SPLIT)), max(1, -(-asked.count() // SPLIT))

    def placed(df: DataFrame, kind: int, own: int, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id"), F.lit(own)).cast("long")
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        block, group = (mine, other) if kind else (other, mine)
        some = df.select(F.size("vec").cast("long").alias("key"), block.alias("_b"), group.alias("_g"), "vec_id", "vec")
        return some.select(
            "key", (F.col("_b") * groups + F.col("_g")).alias("part"), F.lit(kind).alias("kind"), F.col("vec_id").alias("id"), "vec"
        )

    return _met(placed(data, 1, blocks, groups), placed(asked, 0, groups, blocks), k)


def _few(asked: DataFrame, rows: int, pairs: int) -> DataFrame:
    """``asked``, if it can be compared with all rows."""
    if (queries := asked.count()) * rows > pairs:
        raise ValueError(f"{queries} queries need to be compared with all {rows} rows: pass pairs={queries * rows} to have that done")
    return asked


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int, pairs: int = PAIRS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found, or all candidates if fewer, by exact Euclidean distance.

    Both sides have ``vec_id, embedding``.  Rows without an id, and vectors that
    are NULL, empty, zero or hold NULL or non-finite components take no part.
    Only vectors of a query's own length are candidates, never those with its
    id; rows that repeat an id count once, by the nearest.  Equal distances go
    by id.  An empty table gives no rows.

    Where no number of projections finds enough of a sample's neighbours, and for queries
    whose buckets hold fewer than ``k`` rows, queries are compared with all rows.  That is work of queries
    times rows: above ``pairs`` of them it is an error.
    """
    kind = element(vectors)
    data, asked = valid(vectors), valid(queries)
    array = "array<float>" if kind == "<f4" else "array<double>"
    width = WIDTH * spread(data)
    rows = data.count()
    m = projections_for(data, asked, k, cells(rows), width)
    if m == 0:
        return exact_neighbours(data, _few(asked, rows, pairs), k, rows)
    schema = f"key long, kind int, id long, vec {array}"
    crowded = (
        data.mapInArrow(_keys(m, width), "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("_n"))
        .filter(F.col("_n") > SPLIT)
        .select("key", F.ceil(F.col("_n") / SPLIT).cast("int").alias("_parts"))
    )
    stored_rows = data.mapInArrow(_hasher(m, width, False), schema).join(crowded, "key", "left")
    stored_rows = stored_rows.withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("_parts", F.lit(1))).cast("int"))
    visits = asked.mapInArrow(_hasher(m, width, True), schema).join(crowded, "key", "left")
    visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    found = stored(_met(stored_rows, visits, k), "neighbours")
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k).select("query_id")
    short = stored(asked.join(full, asked["vec_id"] == full["query_id"], "left_anti"), "short")
    if short.isEmpty():
        return found
    return found.join(full, "query_id", "left_semi").select(*found.columns).unionByName(exact_neighbours(data, _few(short, rows, pairs), k, rows))


def op7_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)
