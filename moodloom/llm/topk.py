"""Operator 13: the exact best matches of query vectors by inner product, searched with MaxScore.

A vector is a document whose terms are its dimensions, once for positive and once for negative values. A shard of the rows holds
for each term the postings (row and size of the value) and their largest size, which bounds what a term can add to
a score. Terms whose bounds together cannot lift a row over the worst of the best so far are non-essential: only postings of
the others are traversed, and the non-essential ones are looked up for rows that can still get there. Where most rows have
most terms, the essential postings of all queries are added up in one matrix product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodloom.llm.common import if_small, map_arrow
from moodloom.sources.staging import stage

K = 5
SCALE = 256
# Rows of a shard, and rows of it that are searched between two looks at the bounds.
SHARD_ROWS = 4096
STEP = 1024
# Queries that go to a shard together.
QUERY_ROWS = 256
MAX_TASKS = 100_000
# Share of the values that are not zero from which postings are added up by a matrix product.
DENSE = 0.25
# Sums of whole numbers below this are exact in floating point; larger ones are added up as Python integers.
EXACT = 2.0**53
MOST = (1 << 63) - 1


def held_in_range(scores: np.ndarray) -> np.ndarray:
    """Scores within a 64-bit integer; only Python integers can lie beyond."""
    if scores.dtype != object:
        return scores
    return np.array([max(-MOST - 1, min(MOST, s)) for s in scores], object)


class Shard:
    """Rows in the order of their ids, with the postings of each term: rows and values of each sign of each dimension."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = matrix
        lists = [[np.flatnonzero(column * sign > 0) for column in matrix.T] for sign in (1, -1)]
        self.postings = [[(rows, matrix[rows, d]) for d, rows in enumerate(side)] for side in lists]
        most = [[abs(values).max() if len(values) else 0 for _, values in side] for side in self.postings]
        self.most = np.array(most, matrix.dtype).reshape(2, -1)
        self.dense = sum(len(rows) for side in lists for rows in side) >= DENSE * max(matrix.size, 1)

    def search(self, queries: np.ndarray, k: int, own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores of the best ``k`` of each query, equal scores by row; ``own`` is a row to leave out, or -1."""
        matrix, n = self.matrix, len(queries)
        bounds = abs(queries) * np.where(queries < 0, self.most[1], self.most[0])
        order = np.argsort(bounds, axis=1, kind="stable")
        sums = np.concatenate([np.zeros((n, 1), matrix.dtype), np.cumsum(np.take_along_axis(bounds, order, 1), axis=1)], axis=1)
        rank = np.argsort(order, axis=1, kind="stable")
        best = [(np.zeros(0, "i8"), np.zeros(0, matrix.dtype))] * n
        for begin in range(0, len(matrix), STEP):
            end = min(begin + STEP, len(matrix))
            # A row without any of a query's terms could still be one of its best if fewer, or negative ones, are known.
            unknown = np.array([len(rows) < k or scores[-1] < 0 for rows, scores in best])
            worst = np.array([0 if u else scores[-1] for u, (_, scores) in zip(unknown, best)], matrix.dtype)
            found = [self.all_rows(queries, np.flatnonzero(unknown), begin, end, k, own)]
            essential = np.where(unknown, queries.shape[1], (sums[:, 1:] <= worst[:, None]).sum(axis=1))
            found.append(self.competitive(queries, order, sums, rank, essential, worst, begin, end))
            q, row = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            q, row = q[row != own[q]], row[row != own[q]]
            scores = held_in_range((matrix[row] * queries[q]).sum(axis=1)) if matrix.shape[1] else np.zeros(len(row), matrix.dtype)
            above = unknown[q] | (scores > worst[q])
            q, row, scores = q[above], row[above], scores[above]
            by_query = np.argsort(q, kind="stable")
            q, row, scores = q[by_query], row[by_query], scores[by_query]
            cuts = np.flatnonzero(np.diff(q)) + 1
            for i, new_rows, new_scores in zip(q[np.concatenate([[0], cuts])] if len(q) else (), np.split(row, cuts), np.split(scores, cuts)):
                rows, values = (np.concatenate([old, new]) for old, new in zip(best[i], (new_rows, new_scores)))
                top = sorted(range(len(rows)), key=lambda j: (-values[j], rows[j]))[:k]
                best[i] = rows[top], values[top]
        return best

    def all_rows(self, queries: np.ndarray, asked: np.ndarray, begin: int, end: int, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and row that hold the best ``k`` rows from ``begin`` to ``end``, and ties."""
        if not self.matrix.shape[1] or end - begin <= k + 1:
            q, row = np.divmod(np.arange(len(asked) * (end - begin)), end - begin)
            return asked[q], row + begin
        scores = queries[asked] @ self.matrix[begin:end].T
        # One more than k, as the own row is among them.
        q, row = np.nonzero(scores >= np.partition(scores, -k - 1, axis=1)[:, [-k - 1]])
        return asked[q], row + begin

    def competitive(
        self, queries: np.ndarray, order: np.ndarray, sums: np.ndarray, rank: np.ndarray, essential: np.ndarray, worst: np.ndarray,
        begin: int, end: int,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and row, from ``begin`` to ``end``, that can come to more than ``worst``.

        Terms of a query from rank ``essential`` on are traversed. The others are looked up, the largest bound first, as
        long as what is left can lift the row.
        """
        gained = self.traversed(queries, rank >= essential[:, None], begin, end)
        q, row = np.nonzero((gained > 0) & (gained + sums[np.arange(len(queries)), essential][:, None] > worst[:, None]))
        value, left = gained[q, row], essential[q]
        done = []
        while len(q):
            open_ = left > 0
            done.append((q[~open_], row[~open_]))
            q, row, value, left = q[open_], row[open_], value[open_], left[open_] - 1
            d = order[q, left]
            value = value + self.matrix[row + begin, d] * queries[q, d]
            alive = value + sums[q, left] > worst[q]
            q, row, value, left = q[alive], row[alive], value[alive], left[alive]
        if not done:
            return np.zeros(0, "i8"), np.zeros(0, "i8")
        return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done]) + begin

    def traversed(self, queries: np.ndarray, essential: np.ndarray, begin: int, end: int) -> np.ndarray:
        """What the essential terms add to the scores of the rows from ``begin`` to ``end``, or more.

        The matrix product counts postings of both signs; otherwise those that lower a score stay unread.
        """
        if self.dense:
            return np.where(essential, queries, 0) @ self.matrix[begin:end].T
        gained = np.zeros((len(queries), end - begin), self.matrix.dtype)
        for sign, side in enumerate(self.postings):
            for d, (rows, values) in enumerate(side):
                weights = queries[:, d]
                asking = np.flatnonzero(((weights < 0) if sign else (weights > 0)) & essential[:, d])
                if not len(asking):
                    continue
                low, high = np.searchsorted(rows, (begin, end))
                here = rows[low:high] - begin
                gained[asking[:, None], here] += weights[asking, None] * values[low:high]
        return gained


def packed(rows: DataFrame, name: str, size: int, total: int, dims: int) -> DataFrame:
    """``name`` (from 0), ``keys``, ``ids`` and ``matrix`` (64-bit floats) of about ``size`` rows each, by id; rows without one last."""

    def pack(table: pa.Table) -> pa.Table:
        ids, vectors = table.column("id").to_pylist(), table.column("vector").combine_chunks()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        lengths = np.diff(np.asarray(vectors.offsets))
        matrix = np.zeros((len(ids), dims))
        row = np.repeat(np.arange(len(ids)), lengths)
        matrix[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.asarray(vectors.flatten())
        matrix = matrix[order]
        columns = {
            name: table.column(name)[:1],
            "keys": pa.array([table.column("key").take(pa.array(order, pa.int64())).to_pylist()], pa.list_(pa.int64())),
            "ids": pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
            "matrix": pa.array([matrix.tobytes()], pa.binary()),
        }
        return pa.table(columns)

    parts = max(1, -(-total // size))
    dealt = rows.withColumn(name, F.pmod(F.xxhash64("key"), F.lit(parts)))
    return dealt.groupBy(name).applyInArrow(pack, f"{name} long, keys array<long>, ids array<long>, matrix binary")


def finite(vector: str) -> Column:
    """A vector without null, NaN or infinite components; not a null itself."""
    good = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & good, F.lit(False))


def search_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row with ``is_query`` the ``k`` other rows with the highest scores.

    A component x counts as floor(``scale`` * x); the score is the inner product of these whole numbers, exact; one beyond
    64 bits counts as the last number before. Equal scores are ordered by id, rows without an id last; such a row is a match with a null ``vec_id``. Vectors that
    are null or hold null, NaN or infinite components take no part; shorter ones end in zeros, so an empty one scores 0. Repeated
    rows are rows of their own: each is searched and found. Fewer than ``k`` other rows are all returned, none of an empty table.

    Rows and queries meet block by block: each pair of a shard and a block of queries is one small task. A shard gives
    at most ``k`` rows per query; these are merged.
    """
    doubles = F.col(vector_column).cast("array<double>").alias("vector")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), doubles, F.coalesce(is_query, F.lit(False)).alias("asks"))
    scaled = F.transform("vector", lambda x: x * float(scale)).alias("vector")
    rows = rows.where(finite("vector")).select("id", scaled, "asks", F.monotonically_increasing_id().alias("key"))
    rows = stage(rows, "vectors")
    asked = rows.where("asks")
    sizes = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("queries"), F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dims")
    ).first()
    dims = sizes["dims"]
    shards = stage(packed(rows, "shard", SHARD_ROWS, sizes["rows"], dims), "shards")
    blocks = stage(packed(asked, "block", QUERY_ROWS, sizes["queries"], dims), "queries")
    n_shards, n_blocks = max(1, -(-sizes["rows"] // SHARD_ROWS)), max(1, -(-sizes["queries"] // QUERY_ROWS))
    n_pairs = n_shards * n_blocks
    pairs = vectors.sparkSession.range(0, n_pairs, 1, min(n_pairs, MAX_TASKS))
    pairs = pairs.select((F.col("id") % n_shards).alias("shard"), F.floor(F.col("id") / n_shards).alias("block"))
    bytes_of = 16 * F.size("keys") + F.octet_length("matrix")
    blocks = blocks.select("block", *[F.col(c).alias(f"q_{c}") for c in ("keys", "ids", "matrix")])
    pairs = pairs.join(if_small(blocks, 16 * F.size("q_keys") + F.octet_length("q_matrix")), "block")
    pairs = pairs.join(if_small(shards, bytes_of), "shard")

    def matrix_of(data: bytes) -> np.ndarray:
        return np.floor(np.frombuffer(data, "f8")).reshape(-1, dims) if dims else np.zeros((0, 0))

    def work(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                keys, ids, q_keys, q_ids = (batch.column(c)[row].as_py() for c in ("keys", "ids", "q_keys", "q_ids"))
                matrix, queries = (matrix_of(batch.column(c)[row].as_py()) for c in ("matrix", "q_matrix"))
                if not dims:
                    matrix, queries = np.zeros((len(keys), 0)), np.zeros((len(q_keys), 0))
                elif float(abs(matrix).max()) >= EXACT / dims / max(float(abs(queries).max()), 1.0):
                    matrix, queries = (np.array([[int(x) for x in r] for r in m], object) for m in (matrix, queries))
                place = {key: i for i, key in enumerate(keys)}
                own = np.array([place.get(key, -1) for key in q_keys])
                out = {"key": [], "query_id": [], "vec_id": [], "score": []}
                for key, query_id, (found, scores) in zip(q_keys, q_ids, Shard(matrix).search(queries, k, own)):
                    out["key"] += [key] * len(found)
                    out["query_id"] += [query_id] * len(found)
                    out["vec_id"] += [ids[i] for i in found.tolist()]
                    out["score"] += [int(s) for s in scores.tolist()]
                yield out

    columns = ("shard", "block")
    found = map_arrow(pairs.drop(*columns), work, "key long, query_id long, vec_id long, score long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
