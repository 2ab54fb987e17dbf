"""Exact top-k inner products by best-first search of M-trees.

Vectors are dealt to the nearest of a few pivots, and those of a pivot by hash to trees of bounded size, so copies of one
vector fill several trees instead of one. A tree has pages: an inner page has, for each child, a router (one of the
vectors), the covering radius of all vectors below it, its distance to the page's own router and the largest norm below
it; a leaf has vectors with their distances to its router. With |v| <= m below a router p of radius r,

    q.v <= q.p + |q| r     and     q.v = (|q|^2 + |v|^2 - d(q, v)^2) / 2 <= (|q|^2 + m^2 - max(0, d(q, p) - r)^2) / 2,

so pages are visited by their bound, best first, until no bound reaches the k-th score. The stored distance to the parent
gives d(q, p) >= |d(q, parent) - d(p, parent)|, which often settles a child, or a vector of a leaf, without computing it.

Each query first searches the tree where it would lie itself; the k-th score found there is a bound for all others. Then
blocks of queries meet groups of trees.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bankmetrics.llm.common import kept, work_folder

PIVOTS = 32
PAGE = 256
TREE_ROWS = 8192
GROUP_ROWS = 16384
BLOCK_QUERIES = 2048

#: Above the error of bounds in double precision, in parts of the largest squared norms that go into them: distances are
#: under twice their root, and a bound takes a few operations on them.
SLACK = 1e-14


def distances(rows: np.ndarray, norms: np.ndarray, q: np.ndarray, q_norm: float) -> np.ndarray:
    return np.sqrt(np.maximum(norms + q_norm - 2 * (rows @ q), 0))


class Tree:
    """A bulk-loaded M-tree over the rows of ``vectors`` (whole numbers in double precision) with ``ids``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE):
        self.page = page
        self.norms = (vectors * vectors).sum(axis=1)
        self.all, self.all_ids = vectors, ids
        self.most = float(self.norms.max(initial=0.0))
        #: Pages: (router, None, rows, distances to the router) of a leaf; inner pages have children and their data.
        self.pages: list[tuple] = []
        self.root = self._build(np.arange(len(ids)), None)

    def _build(self, rows: np.ndarray, router: int | None) -> int:
        to_router = np.zeros(len(rows)) if router is None else self._from(router, rows)
        if len(rows) <= self.page:
            rows, to_router = rows[np.argsort(to_router, kind="stable")], np.sort(to_router, kind="stable")
            self.pages.append((True, router, rows, to_router, self.all[rows], self.norms[rows], self.all_ids[rows]))
            return len(self.pages) - 1
        count = min(self.page, -(-2 * len(rows) // self.page))
        routers = rows[np.linspace(0, len(rows) - 1, count).astype(np.int64)]
        near = (self.norms[routers][None, :] - 2 * (self.all[rows] @ self.all[routers].T)).argmin(axis=1)
        if np.bincount(near, minlength=count).max() == len(rows):
            # All are closest to one router, as copies of one vector are: parts of equal size.
            near = np.arange(len(rows)) * count // len(rows)
        entries = []
        for i, r in enumerate(routers.tolist()):
            below = rows[near == i]
            if len(below):
                radius = float(self._from(r, below).max())
                parent = 0.0 if router is None else float(self._from(router, np.array([r]))[0])
                entries.append((r, radius, parent, float(self.norms[below].max()), self._build(below, r)))
        where, radius, parent, most, child = (np.array(x) for x in zip(*entries))
        self.pages.append((False, router, child, parent, self.all[where], self.norms[where], radius, most))
        return len(self.pages) - 1

    def _from(self, router: int, rows: np.ndarray) -> np.ndarray:
        return distances(self.all[rows], self.norms[rows], self.all[router], self.norms[router])

    def search(self, q: np.ndarray, own: int, k: int, found: list[tuple[int, int]], least: float) -> None:
        """Puts candidates that may be among the k best into ``found``, a heap of (score, -id) of at most k.

        ``least`` is a score that the k best reach anyhow. Vectors with the query's own id take no part.
        """
        norm = float(q @ q)
        size, slack = norm**0.5, SLACK * (norm + self.most)
        known = self.pages[self.root][1]
        first = 0.0 if known is None else float(self._from_query(q, norm, known))
        queue = [(-np.inf, self.root, first)]
        while queue:
            bound, page, to_router = heapq.heappop(queue)
            least = max(least, found[0][0]) if len(found) == k else least
            if -bound < least - slack:
                return
            leaf, router, rows, parent, vectors, norms = self.pages[page][:6]
            # Vectors that the parent's distance excludes are not computed.
            gap = np.abs(to_router - parent) if router is not None else np.zeros(len(rows))
            if leaf:
                open_rows = np.flatnonzero((norm + norms - gap * gap) / 2 >= least - slack)
                scores = vectors[open_rows] @ q if len(open_rows) < len(rows) else vectors @ q
                ids = self.pages[page][6][open_rows]
                good = np.flatnonzero((scores >= least) & (ids != own))
                for score, i in sorted(zip(scores[good].tolist(), (-ids[good]).tolist()), reverse=True):
                    if len(found) < k:
                        heapq.heappush(found, (score, i))
                    elif (score, i) > found[0]:
                        heapq.heapreplace(found, (score, i))
                    else:
                        break
                continue
            radius, most = self.pages[page][6:]
            settled = np.maximum(gap - radius, 0)
            open_rows = np.flatnonzero((norm + most - settled * settled) / 2 >= least - slack)
            dots = vectors[open_rows] @ q
            to = np.sqrt(np.maximum(norms[open_rows] + norm - 2 * dots, 0))
            near = np.maximum(to - radius[open_rows], 0)
            top = np.minimum(dots + size * radius[open_rows], (norm + most[open_rows] - near * near) / 2)
            for i in np.flatnonzero(top >= least - slack).tolist():
                heapq.heappush(queue, (-float(top[i]), int(rows[open_rows[i]]), float(to[i])))

    def _from_query(self, q: np.ndarray, norm: float, router: int) -> float:
        return float(np.sqrt(max(self.norms[router] + norm - 2 * float(self.all[router] @ q), 0)))


def whole(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """id, dim, vec: floor(scale * x) of each component as double. Rows that take no part are left out.

    These are rows without an id, and vectors that are null, empty, or hold null or non-finite components.
    """
    raw = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), raw.alias("raw"))
    rows = rows.where(F.col("id").isNotNull() & F.col("raw").isNotNull() & (F.size("raw") > 0))
    rows = rows.where(~F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return rows.select(
        "id",
        F.size("raw").cast("long").alias("dim"),
        F.transform("raw", lambda x: F.floor(x * scale).cast("double")).alias("vec"),
    )


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = pc.list_flatten(column)
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    return np.asarray(flat, dtype=np.float64).reshape(-1, dim)


def _dealt(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds ``cell``, the nearest of the pivots of the vector's length."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = _matrix(batch.column("vec").take(pa.array(at)), dim)
                p = pivots[dim]
                cell[at] = ((p * p).sum(axis=1)[None, :] - 2 * (x @ p.T)).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    return rows.mapInArrow(deal, "id long, dim long, vec array<double>, cell long")


def top_products(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query, ties to the smaller id.

    ``is_query`` tells the queries by their id, whose column is named ``id``. Ids are taken to be keys: rows of the
    query's own id are no candidates of it, and copies of another row are candidates each. Vectors of another length
    than the query's are no candidates either. Fewer than k candidates give fewer rows, an empty table none.
    Squared norms, scaled, must stay under 2**50, so that all sums are exact. The pivots, PIVOTS for each length of vector, come to the driver.
    """
    spark, folder = vectors.sparkSession, work_folder(vectors.sparkSession, "mtree")
    rows = whole(vectors, id_column, vector_column, scale)
    # Pivots: for each length, the row with the smallest hash of each of PIVOTS cells.
    marked = rows.select("id", "dim", "vec", F.xxhash64("id").alias("mark"))
    marked = marked.withColumn("part", F.pmod(F.shiftright("mark", 20), F.lit(PIVOTS)))
    least = marked.groupBy("dim", "part").agg(F.min("mark").alias("mark"))
    picked: dict[int, list] = {}
    for r in marked.join(least, ["dim", "part", "mark"], "left_semi").orderBy("dim", "id").collect():
        picked.setdefault(r["dim"], []).append(r["vec"])
    pivots = {dim: np.unique(np.array(v), axis=0) for dim, v in picked.items()}

    dealt = kept(_dealt(rows, pivots), folder, "dealt")
    counts = dealt.groupBy("dim", "cell").agg(F.count("*").alias("n"))
    parts = counts.select("dim", "cell", F.ceil(F.col("n") / TREE_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    dealt = kept(dealt.join(F.broadcast(parts), ["dim", "cell"]).withColumn("part", part), folder, "parts")
    sizes = dealt.groupBy().agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    groups, blocks = max(1, -(-sizes["n"] // GROUP_ROWS)), max(1, -(-sizes["q"] // BLOCK_QUERIES))
    tree = ["dim", "cell", "part"]
    queries = dealt.where(is_query).select(*(F.col(c).alias(f"q_{c}") for c in [*tree, "id", "vec"]))

    def home(key: tuple, own: pa.Table, asked: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        least: list[float | None] = []
        if asked.num_rows:
            built = Tree(own.column("id").to_numpy(), _matrix(own.column("vec"), dim))
            for i, q in zip(asked.column("q_id").to_pylist(), _matrix(asked.column("q_vec"), dim)):
                found: list = []
                built.search(q, i, k, found, -np.inf)
                least.append(found[0][0] if len(found) == k else None)
        return pa.Table.from_arrays(
            [
                asked.column("q_id"),
                pa.array([dim] * asked.num_rows, pa.int64()),
                asked.column("q_vec"),
                pa.array(least, pa.float64()),
            ],
            ["id", "dim", "vec", "least"],
        )

    started = dealt.select(*tree, "id", "vec").groupBy(*tree).cogroup(queries.groupBy(*(f"q_{c}" for c in tree)))
    started = kept(started.applyInArrow(home, "id long, dim long, vec array<double>, least double"), folder, "started")

    def best(key: tuple, own: pa.Table, asked: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        out: list[tuple[int, int, int]] = []
        if asked.num_rows and own.num_rows:
            name = own.column("cell").to_numpy() * (1 << 32) + own.column("part").to_numpy()
            order = np.argsort(name, kind="stable")
            ids, x = own.column("id").to_numpy()[order], _matrix(own.column("vec"), dim)[order]
            cuts = np.flatnonzero(np.concatenate([[True], name[order][1:] != name[order][:-1], [True]]))
            trees = [Tree(ids[a:b], x[a:b]) for a, b in zip(cuts, cuts[1:])]
            start = asked.column("least").to_pylist()
            for i, q, least in zip(asked.column("id").to_pylist(), _matrix(asked.column("vec"), dim), start):
                found: list = []
                for t in trees:
                    t.search(q, i, k, found, -np.inf if least is None else least)
                out += [(i, -v, int(s)) for s, v in found]
        columns = zip(*out) if out else ([], [], [])
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    group = F.pmod(F.xxhash64(*tree), F.lit(groups)).cast("int").alias("group")
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    each_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    all_trees = dealt.select("dim", "cell", "part", "id", "vec", group, each_block)
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    all_queries = started.select("dim", "id", "vec", "least", block, each_group)
    on = ["dim", "group", "block"]
    found = all_trees.groupBy(*on).cogroup(all_queries.groupBy(*on)).applyInArrow(best, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
