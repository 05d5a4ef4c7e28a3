"""Exact top-k inner product search with M-trees.

Vectors become integers ``floor(scale * x)``.  One more coordinate, the root of
``R - |a|**2`` with ``R`` the largest square of all, puts every vector on one
sphere, where the largest inner product is the smallest Euclidean distance: a
metric, so an M-tree can search it.

Pages.  The root level holds up to ``PIVOTS`` routing objects with covering
radii, drawn from the rows by hash; it is small and every task has it.  Below
each is a subtree of its own, built in one task from the vectors nearest to it
(parts of them, where there are more than ``SPLIT``): inner pages of routing
objects with covering radius and distance to their parent, and leaf pages of
vectors with distance to their parent.

Search.  A query first goes to its nearest subtree alone; the k-th distance found there,
or that to the k-th routing object (routing objects are rows themselves), then decides which other subtrees'
balls it reaches.  The queries of a subtree go down its pages together, best-first:
next comes the page with the least lower bound of any query that still needs it.
``|d(q, parent) - d(o, parent)| - radius`` bounds the distance of an entry without computing it;
the distances that are computed are one matrix product per page.  Distances have a
slack for rounding and only decide what is visited; scores are integers, so results are exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstrata.llm.common import runs, shuffle_parts, stored, table
from trendstrata.llm.vectors import best, matrices, valid

SCALE = 256
PIVOTS = 4096  # routing objects of the root, at most
FANOUT_ROWS = 512  # rows per routing object while there are fewer
SPLIT = 2048  # rows of one subtree
PAGE = 64  # entries of a page
LARGEST = 1 << 62  # products of lengths from here on are scored with Python's integers
SLACK = 1e-7  # of the lengths; distances come from squares
BLOCK = 512  # queries that go down a subtree together
EXACT = 1 << 53  # whole numbers below are exact as doubles


@dataclass
class Page:
    """Entries with their distance to the page's own routing object; a leaf has ``rows``, others ``below``."""

    centres: np.ndarray
    parent: np.ndarray
    radius: np.ndarray | None = None
    below: list[Page] | None = None
    rows: np.ndarray | None = None


def _distance(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - one) ** 2).sum(1))


def _build(points: np.ndarray, rows: np.ndarray, centre: np.ndarray, rng: np.random.Generator) -> Page:
    """The page below ``centre`` for the given rows: a leaf, or routing objects and a page below each."""
    if len(rows) <= PAGE:
        return Page(points[rows], _distance(points[rows], centre), rows=rows)
    chosen = rows[rng.choice(len(rows), min(PAGE, -(-len(rows) // PAGE) + 1), replace=False)]
    square = (points[rows] ** 2).sum(1)[:, None] - 2 * points[rows] @ points[chosen].T + (points[chosen] ** 2).sum(1)[None]
    nearest = square.argmin(1)
    if len(np.unique(nearest)) == 1:  # equal points: deal them out evenly
        nearest = np.arange(len(rows)) % len(chosen)
    centres, radius, below = [], [], []
    for i in np.unique(nearest):
        own = rows[nearest == i]
        centres.append(points[chosen[i]])
        radius.append(_distance(points[own], centres[-1]).max())
        below.append(_build(points, own, centres[-1], rng))
    centres = np.array(centres)
    return Page(centres, _distance(centres, centre), radius=np.array(radius), below=below)


class MTree:
    """One subtree: ``values`` integer vectors, ``points`` the same on the sphere."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, square: float, centre: np.ndarray | None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        points = on_sphere(self.values, square)
        self.centre = points.mean(0) if centre is None else centre
        self.computed, self._square = 0, square
        self._longest = math.sqrt((self.values.astype(np.float64) ** 2).sum(1).max())
        self.root = _build(points, np.arange(len(points)), self.centre, np.random.default_rng(len(points)))

    def search_all(self, own: np.ndarray, queries: np.ndarray, limits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, id and score of up to ``k`` best rows of each query within its distance limit, best-first."""
        lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        repeated = len(np.unique(self.ids)) < len(self.ids)
        if repeated or self._longest * lengths.max(initial=0.0) >= EXACT:
            found = [(i, one, score) for i, q in enumerate(queries) for score, one in self.search(int(own[i]), q, limits[i], k)]
            return tuple(np.array(c, np.int64) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        q = queries.astype(np.float64)
        square = lengths**2
        slack = SLACK * (1 + lengths + math.sqrt(self._square))
        limit = limits.astype(np.float64)
        tops = np.full((len(q), k), -np.inf)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def away(points: np.ndarray, which: np.ndarray) -> np.ndarray:
            """Distances of queries, whose last coordinate is 0, and points."""
            d = square[which][:, None] - 2 * q[which] @ points[:, :-1].T + (points**2).sum(1)[None]
            return np.sqrt(np.maximum(d, 0.0))

        everyone = np.arange(len(q))
        queue = [(0.0, 0, self.root, everyone, away(self.centre[None], everyone)[:, 0], np.zeros(len(q)))]
        number = 0
        while queue:
            _, _, page, which, to_parent, lower = heapq.heappop(queue)
            still = lower <= limit[which] + slack[which]
            which, to_parent = which[still], to_parent[still]
            if len(which) == 0:
                continue
            reach = (limit + slack)[which][:, None]
            radius = 0.0 if page.radius is None else page.radius[None]
            near = np.abs(to_parent[:, None] - page.parent[None]) - radius <= reach
            self.computed += int(near.sum())
            if page.rows is None:
                d = away(page.centres, which)
                bound = np.maximum(d - page.radius[None], 0.0)
                near &= bound <= reach
                for i in np.flatnonzero(near.any(0)):
                    some = near[:, i]
                    number += 1
                    heapq.heappush(queue, (bound[some, i].min(), number, page.below[i], which[some], d[some, i], bound[some, i]))
                continue
            scores = q[which] @ self.values[page.rows].astype(np.float64).T
            ids = self.ids[page.rows]
            good = near & (scores >= tops[which][:, -1:]) & (ids[None] != own[which][:, None])
            rows, columns = np.nonzero(good)
            if len(rows) == 0:
                continue
            found.append((which[rows], ids[columns], scores[rows, columns]))
            # Ids are distinct here, so the k-th of all scores so far is a limit.
            changed = np.unique(rows)
            both = np.concatenate([tops[which[changed]], np.where(good[changed], scores[changed], -np.inf)], axis=1)
            tops[which[changed]] = -np.sort(-both, axis=1)[:, :k]
            kth = tops[which[changed], -1]
            full = np.isfinite(kth)
            now = which[changed][full]
            limit[now] = np.minimum(limit[now], np.sqrt(np.maximum(square[now] + self._square - 2 * kth[full], 0.0)))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        which, ids, scores = (np.concatenate(c) for c in zip(*found, strict=True))
        kept = scores >= tops[which, -1]
        which, ids, scores = which[kept], ids[kept], scores[kept].astype(np.int64)
        order = np.lexsort((ids, -scores, which))
        which, ids, scores = which[order], ids[order], scores[order]
        starts, ends = runs(which)
        first = np.arange(len(which)) - np.repeat(starts, ends - starts) < k
        return which[first], ids[first], scores[first]

    def search(self, own: int, query: np.ndarray, limit: float, k: int) -> list[tuple[int, int]]:
        """Up to ``k`` best ``(score, id)`` within distance ``limit``, best-first."""
        point = np.append(query.astype(np.float64), 0.0)
        slack = SLACK * (1 + np.sqrt((point**2).sum()) + np.sqrt((self.centre**2).sum()))
        top: list[tuple[int, int]] = []  # (score, -id), the worst first
        length = float((point**2).sum())
        square = self._square
        queue = [(0.0, 0, float(np.sqrt(((self.centre - point) ** 2).sum())), self.root)]
        number = 0
        fits = self._longest * math.sqrt(length) < LARGEST
        while queue:
            bound, _, to_parent, page = heapq.heappop(queue)
            if bound > limit + slack:
                break
            radius = page.radius if page.radius is not None else 0.0
            near = np.flatnonzero(np.abs(to_parent - page.parent) - radius <= limit + slack)
            self.computed += len(near)
            if page.rows is None:
                away = _distance(page.centres[near], point)
                for i, d in zip(near, away, strict=True):
                    lower = max(d - page.radius[i], 0.0)
                    if lower <= limit + slack:
                        number += 1
                        heapq.heappush(queue, (lower, number, d, page.below[i]))
                continue
            rows = page.rows[near]
            scores = self.values[rows] @ query if fits else self.values[rows].astype(object) @ query.astype(object)
            for row, score in zip(rows, scores.tolist(), strict=True):
                one = int(self.ids[row])
                if one == own or (len(top) == k and score < top[0][0]):
                    continue
                entry = (score, -one)
                same = [old for old in top if old[1] == -one]
                if same and same[0] < entry:  # another row with this id
                    top[top.index(same[0])] = entry
                    heapq.heapify(top)
                elif not same and len(top) < k:
                    heapq.heappush(top, entry)
                elif not same and entry > top[0]:
                    heapq.heapreplace(top, entry)
            if len(top) == k:
                limit = min(limit, math.sqrt(max(length + square - 2 * top[0][0], 0.0)))
        return [(score, -minus) for score, minus in top]


def on_sphere(values: np.ndarray, square: float) -> np.ndarray:
    x = values.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(square - (x**2).sum(1), 0.0))[:, None]], axis=1)


def scaled(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, vec`` with integer components, of the rows that take part."""
    bounded = F.lit(float(1 << 63))

    def whole(x):
        x = x.cast("double") * scale
        return F.when(F.abs(x) < bounded, F.floor(x)).otherwise(F.raise_error(F.lit("a scaled component leaves 64 bits")).cast("long"))

    return valid(df, zero=True).withColumn("vec", F.transform("vec", whole))


@dataclass
class Root:
    """Routing objects by vector length; ``first`` numbers the node of a length's first one."""

    ids: dict[int, np.ndarray]
    values: dict[int, np.ndarray]
    first: dict[int, int]
    square: float

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node of each vector and the distance to its routing object; lengths without one are node ``-length``."""
        dim = x.shape[1]
        if dim not in self.values:
            return np.full(len(x), -dim), np.zeros(len(x))
        at, pivots = on_sphere(x, self.square), on_sphere(self.values[dim], self.square)
        node, away = np.empty(len(x), np.int64), np.empty(len(x))
        for i in range(0, len(x), 256):
            d = (pivots**2).sum(1)[None] - 2 * at[i : i + 256] @ pivots.T
            own = d.argmin(1)
            node[i : i + 256] = own + self.first[dim]
            away[i : i + 256] = np.sqrt(((at[i : i + 256] - pivots[own]) ** 2).sum(1))
        return node, away


def root_page(rows: DataFrame, count: int, square: float) -> Root:
    wanted = max(1, min(PIVOTS, -(-count // FANOUT_ROWS)))
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()
    ids, values, first, at = {}, {}, {}, 0
    for dim in sorted({len(r["vec"]) for r in drawn}):
        own = [r for r in drawn if len(r["vec"]) == dim]
        ids[dim] = np.array([r["vec_id"] for r in own], np.int64)
        values[dim] = np.array([r["vec"] for r in own], np.int64)
        first[dim], at = at, at + len(own)
    return Root(ids, values, first, square)


def _assigner(root):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in matrices(batch):
                node, away = root.value.nearest(x)
                some = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(away), some.column(0), some.column(1)], ["node", "away", "vec_id", "vec"]
                )

    return run


ROUTED = "node long, part int, kind int, limit double, q long, vec_id long, vec array<bigint>"


def _router(root, radii, k: int, nearest: bool):
    """For each query its nearest subtree, or all others that may hold one of its best.

    Queries are ``q, vec_id, limit, vec``; the k-th routing object may lower the limit.
    """
    names = [part.split()[0] for part in ROUTED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = root.value
        for batch in batches:
            ids, given = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for rows, x in matrices(batch):
                dim = x.shape[1]
                limit = given[rows].copy()
                if dim in page.values:
                    pivots = on_sphere(page.values[dim], page.square)
                    nodes = page.first[dim] + np.arange(len(pivots))
                    points = x.astype(np.float64)
                    square = (points**2).sum(1)
                    away = np.sqrt(np.maximum(square[:, None] - 2 * points @ pivots[:, :-1].T + (pivots**2).sum(1)[None], 0.0))
                    # Distinct ids only: a repeated row must not stand for two candidates.
                    if len(np.unique(page.ids[dim])) == len(pivots) > k:
                        others = np.where(page.ids[dim][None] == ids[rows][:, None], np.inf, away)
                        limit = np.minimum(limit, np.partition(others, k - 1, axis=1)[:, k - 1])
                    own = away.argmin(1)
                    if nearest:
                        which, reached = np.arange(len(rows)), nodes[own]
                    else:
                        slack = SLACK * (1 + np.sqrt(square) + math.sqrt(page.square))
                        ball = np.array([radii.value.get(int(n), (0.0, 0))[0] for n in nodes])
                        near = away - ball[None] <= (limit + slack)[:, None]
                        near[np.arange(len(rows)), own] = False
                        which, columns = np.nonzero(near)
                        reached = nodes[columns]
                else:
                    which = np.arange(len(rows)) if nearest else np.zeros(0, np.int64)
                    reached = np.full(len(which), -dim)
                parts = np.array([radii.value.get(int(n), (0.0, 0))[1] for n in reached], np.int64)
                which, reached = np.repeat(which, parts), np.repeat(reached, parts)
                part = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
                some = batch.take(pa.array(rows[which]))
                columns = [
                    pa.array(reached.astype(np.int64)), pa.array(part.astype(np.int32)), pa.array(np.ones(len(which), np.int32)),
                    pa.array(limit[which]), some.column(0), some.column(1), some.column(3),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _searcher(k: int, square: float):
    """Stream over rows sorted by subtree, its vectors before the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tree = None, None
        held: list[pa.RecordBatch] = []  # the rows of one kind of the current subtree

        def vectors() -> tuple[np.ndarray, pa.Table]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            vec = rows.column(6)
            return vec.flatten().to_numpy().reshape(len(rows), -1), rows

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal tree
            if not held:
                return
            x, rows = vectors()
            if current[2] == 0:
                tree = MTree(rows.column(5).to_numpy(), x, square, None)
            elif tree is not None:
                own, q = rows.column(5).to_numpy(), rows.column(4).to_numpy()
                which, ids, scores = tree.search_all(own, x, rows.column(3).to_numpy(), k)
                columns = [pa.array(c.astype(np.int64)) for c in (q[which], own[which], ids, scores)]
                yield pa.RecordBatch.from_arrays(columns, ["q", "query_id", "vec_id", "score"])
            held.clear()

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], 1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if hi == lo:
                    continue
                at = tuple(keys[lo].tolist())
                if at != current:
                    yield from flushed()
                    if current is None or at[:2] != current[:2]:
                        tree = None
                    current = at
                held.append(batch.slice(lo, hi - lo))
                if current[2] == 1 and sum(len(h) for h in held) >= BLOCK:
                    yield from flushed()
        yield from flushed()

    return run


def top_products(vectors: DataFrame, queries: DataFrame, k: int, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest integer inner products of each query, exactly.

    Both sides have ``vec_id, embedding``.  Rows without an id and vectors that
    are NULL, empty or hold NULL or non-finite components take no part.  A scaled
    component, or one of the ``k`` largest scores, that leaves 64 bits raises an
    error.  Only vectors of a query's own length are candidates, never
    those with its id; rows that repeat an id count once, by the largest score.
    Equal scores go by id.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows, asked = scaled(vectors, scale), scaled(queries, scale)
    asked = stored(asked.select(F.monotonically_increasing_id().alias("q"), "vec_id", "vec"), "queries")
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    count, square = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    square = square or 0.0
    root = root_page(rows, count, square)
    page = spark.sparkContext.broadcast(root)
    placed = stored(rows.mapInArrow(_assigner(page), "node long, away double, vec_id long, vec array<bigint>"), "mtree")
    # At most PIVOTS nodes and one per length without a routing object.
    nodes = placed.groupBy("node").agg(F.max("away").alias("radius"), F.ceil(F.count(F.lit(1)) / SPLIT).alias("parts"))
    balls = {r["node"]: (r["radius"], r["parts"]) for r in nodes.collect()}
    radii = spark.sparkContext.broadcast(balls)
    parts = nodes.select("node", F.col("parts").alias("_parts"))
    data = placed.join(parts, "node").select(
        "node",
        F.pmod(F.xxhash64("vec_id"), F.col("_parts")).cast("int").alias("part"),
        F.lit(0).alias("kind"),
        F.lit(0.0).alias("limit"),
        F.lit(0).cast("long").alias("q"),
        "vec_id",
        "vec",
    )

    def searched(limited: DataFrame, nearest: bool) -> DataFrame:
        routed = limited.select("q", "vec_id", "limit", "vec").mapInArrow(_router(page, radii, k, nearest), ROUTED)
        met = data.unionByName(routed).repartition(shuffle_parts(spark), "node", "part")
        found = met.sortWithinPartitions("node", "part", "kind").mapInArrow(
            _searcher(k, square), "q long, query_id long, vec_id long, score long"
        )
        return stored(found, "found")

    first = searched(asked.withColumn("limit", F.lit(float("inf"))), nearest=True)
    kth = best(first.withColumn("query_id", F.col("q")), k, ascending=False)
    kth = kth.filter(F.col("rank") == k).select(F.col("query_id").alias("q"), "score")
    far = F.sqrt(F.greatest(norm + F.lit(square) - 2 * F.col("score").cast("double"), F.lit(0.0)))
    limited = asked.join(kth, "q", "left").withColumn("limit", F.coalesce(far, F.lit(float("inf"))))
    second = searched(limited, nearest=False)
    return best(first.unionByName(second), k, ascending=False)


def op10_mtree(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_products(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


ORACLE = """
WITH whole AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
spread AS (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM whole),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM spread q JOIN spread c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""
