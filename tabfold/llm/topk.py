"""Exact top-k search by aggregation without random access.

Queries and candidates meet in cells of one block each.  Within a cell every
dimension is a list of the block's vectors, sorted by their component once for
all queries: read from the top for a query with a positive weight there, from
the bottom for one with a negative weight.  All lists are read on side by
side.  What was read gives an exact part of each score; what was not read lies
between the list's last value read and its far end, so each vector has a lower
and an upper bound.

The bounds of all queries are looked at in steps of 1 / ``GRID`` of the lists.
Reading stops for a query when at most ``OPEN`` vectors have an upper bound
that reaches the k-th lower bound: all others cannot qualify.  The final
scores of those few are then resolved exactly.  A query whose bounds never get
there reads to the end of the lists, and its scores are exact.  How deep the
first look is taken is found from a few of the cell's queries; it saves looks,
and decides nothing.

Bounds for the queries of a cell are matrix products: in place of a component
that is not read stands the value it may have at most, or at least.  Integer
scores are exact in double precision as long as their sums stay below 2**52; a
block with larger numbers is scored in Python integers.

Defined cases: scores must fit a 64-bit integer; vectors that are null, empty, or hold a null or a non-finite
number take no part; vectors of another length than the query's are no
candidates; a query never finds rows with its own id; ids that are null take
no part; repeated rows count once; ties go to the smaller id; a table without
rows or queries gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabfold.llm.common import ship_package

QUERY_BLOCK, ROW_BLOCK = 2048, 4096       # rows of a cell
CHUNK = 256                               # queries whose bounds are in memory at a time: CHUNK x ROW_BLOCK, a few times
GRID = 32                                 # looks at the bounds that reading the lists to the end may take
PROBES = 16                               # queries from which the depth of the first look is found
OPEN = 64                                 # vectors still possible when reading stops, at most (or 8 k, if that is more)


class Lists:
    """The sorted lists of a block, and what is known of it at a depth."""

    def __init__(self, x: np.ndarray):
        self.x, self.n = x, len(x)
        order = np.argsort(-x, axis=0, kind="stable")
        self.rank = np.empty(order.shape, dtype=np.int32)              # each component's place from the top
        np.put_along_axis(self.rank, order, np.arange(self.n, dtype=np.int32)[:, None].repeat(x.shape[1], 1), axis=0)
        self.column = np.take_along_axis(x, order, axis=0)
        self.known: dict[int, tuple[np.ndarray, ...]] = {}

    def at(self, t: int) -> tuple[np.ndarray, ...]:
        """With ``t`` rows of each list read: components at most, and at least, read from the top and from the bottom."""
        if t not in self.known:
            top, bottom = self.rank < t, self.rank >= self.n - t
            self.known = {t: (np.where(top, self.x, self.column[t - 1]).T, np.where(top, self.x, self.column[-1]).T,
                              np.where(bottom, self.x, self.column[self.n - t]).T, np.where(bottom, self.x, self.column[0]).T)}
        return self.known[t]

    def possible(self, plus: np.ndarray, minus: np.ndarray, own: np.ndarray, k: int, t: int) -> np.ndarray:
        """Which vectors may be among each query's best k after ``t`` rows of the lists; ``own``: those that are no candidates."""
        top_most, top_least, bottom_least, bottom_most = self.at(t)      # a negative weight turns most and least round
        lower = plus @ top_least + minus @ bottom_most
        lower[own] = -np.inf
        bar = np.partition(lower, self.n - k, axis=1)[:, self.n - k]
        may = plus @ top_most + minus @ bottom_least >= bar[:, None]
        may[own] = False
        return may


def _first_look(lists: Lists, plus: np.ndarray, minus: np.ndarray, own: np.ndarray, k: int, few: int) -> int:
    """The step at which half of some queries stop, by halving the steps."""
    lo, hi = 1, GRID - 1
    while lo < hi:
        mid = (lo + hi) // 2
        stopped = lists.possible(plus, minus, own, k, max(1, lists.n * mid // GRID)).sum(1) <= few
        lo, hi = (lo, mid) if 2 * stopped.sum() >= len(plus) else (mid + 1, hi)
    return lo


def nra_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple]:
    """(query id, id, score, depth) of each query's best k of this block, ties to smaller ids.

    ``depth``: the share of the lists that was read for the query.
    """
    n, dims = x.shape
    peak = int(abs(q).max(initial=0)) * int(abs(x).max(initial=0)) * dims
    if peak >= 1 << 52:
        q, x = q.astype(object), x.astype(object)
        return [r for i, own in enumerate(q_ids) for r in _best(own, ids, x.dot(q[i]), k, np.arange(n), 1.0)]
    lists, out = Lists(x.astype(np.float64)), []
    few = max(8 * k, OPEN)
    first = None
    for lo in range(0, len(q), CHUNK):
        qf, own_ids = q[lo:lo + CHUNK].astype(np.float64), q_ids[lo:lo + CHUNK]
        plus, minus, own = np.maximum(qf, 0), np.minimum(qf, 0), own_ids[:, None] == ids[None, :]
        live = np.arange(len(qf))
        if n > few:
            if first is None:
                first = _first_look(lists, plus[:PROBES], minus[:PROBES], own[:PROBES], k, few)
            for step in range(first, GRID):
                if not len(live):
                    break
                t = max(1, n * step // GRID)
                may = lists.possible(plus[live], minus[live], own[live], k, t)
                stops = may.sum(1) <= few
                for i in np.flatnonzero(stops):
                    at = np.flatnonzero(may[i])
                    out += _best(own_ids[live[i]], ids, lists.x[at] @ qf[live[i]], k, at, t / n)
                live = live[~stops]
        if len(live):                                             # lists read to their end
            scores = qf[live] @ lists.x.T
            scores[own[live]] = -np.inf
            bar = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(live), -np.inf)
            for i, which in enumerate(live):
                at = np.flatnonzero(scores[i] >= bar[i])
                out += _best(own_ids[which], ids, scores[i][at], k, at, 1.0)
    return out


def _best(own, ids: np.ndarray, scores: np.ndarray, k: int, at: np.ndarray, depth: float) -> list[tuple]:
    keep = ids[at] != own
    scores, at = scores[keep], at[keep]
    first = sorted(range(len(at)), key=lambda i: (-scores[i], ids[at[i]]))[:k]
    return [(int(own), int(ids[at[i]]), int(scores[i]), depth) for i in first]


def top_k(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding",
          scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of every query's ``k`` highest integer inner products, and ``depth``:
    the share of the lists that was read in the block where the vector was found.

    Cells are (query block, row block, length): each vector goes to every query
    block and each query to every row block, so a cell's size is fixed and no
    side is broadcast.  A cell returns at most k rows for a query; the merge
    takes the best of these.
    """
    ship_package(vectors.sparkSession)
    whole = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * scale).cast("long"))
    finite = F.forall(F.col(vector), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = (vectors.select(F.col(key).cast("long").alias("id"), is_query.alias("asks"), F.col(vector))
            .where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(vector) > 0))
            .select("id", F.coalesce("asks", F.lit(False)).alias("asks"), whole.alias("v"))
            .dropDuplicates(["id", "v"]))
    n, nq = rows.agg(F.count("*"), F.count_if("asks")).first()
    row_blocks, query_blocks = max(1, -(-n // ROW_BLOCK)), max(1, -(-nq // QUERY_BLOCK))
    dims = F.size("v").alias("dims")
    block = lambda m, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(m).cast("long"))
    copies = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    # names of their own on either side: both come from the same rows
    cand = (rows.select("id", "v", dims, block(row_blocks, 1).alias("rb"), copies(query_blocks).alias("qb"))
            .select(F.col("id").alias("x_id"), F.col("v").alias("x"), F.col("dims").alias("x_dims"), F.col("rb").alias("x_rb"), F.col("qb").alias("x_qb")))
    asks = (rows.where("asks").select("id", "v", dims, copies(row_blocks).alias("rb"), block(query_blocks, 2).alias("qb"))
            .select(F.col("id").alias("q_id"), F.col("v").alias("q"), F.col("dims").alias("q_dims"), F.col("rb").alias("q_rb"), F.col("qb").alias("q_qb")))

    def cell(qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(qs) and len(xs):
            q, x = np.stack(qs["q"].to_numpy()), np.stack(xs["x"].to_numpy())
            found = nra_block(qs["q_id"].to_numpy(), q, xs["x_id"].to_numpy(), x, k)
        frame = pd.DataFrame(found, columns=["query_id", "vec_id", "score", "depth"])
        return frame.astype({"query_id": "int64", "vec_id": "int64", "score": "int64", "depth": "float64"})

    near = asks.groupBy("q_qb", "q_rb", "q_dims").cogroup(cand.groupBy("x_qb", "x_rb", "x_dims")).applyInPandas(cell, "query_id long, vec_id long, score long, depth double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "depth"))
