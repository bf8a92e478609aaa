"""Exact top-k search by distributed histogram selection.

Queries and candidates are dealt into cells, and every pair of a query cell and a
candidate cell scores all its pairs in one matrix product. No score leaves a cell.
A round counts the scores of each query in the bins of its range; the bin that holds
the k-th best value becomes the next range, until it holds one value. Then the scores
above that value, and the smallest ids at it, are the result.

A cell sends its bins from the top down to the one with its own k-th best score: the
k-th best of all is not lower, so the rest cannot matter. At the final value it sends
its k smallest ids. So a cell sends at most about k rows a query, however many
candidates tie.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.sources.staging import stage

# Rows and bytes of a cell: what one task holds of each side. The rows bound the scores.
CANDIDATES_PER_CELL, CANDIDATE_BYTES = 1 << 14, 8 << 20
QUERIES_PER_CELL, QUERY_BYTES = 1 << 11, 1 << 20

# Bins of a round.
BINS = 1 << 10

# Queries of a cell that are scored at one time.
STEP = 128

# Scores beyond it are an error, so that ranges of scores fit into a long.
MOST = (1 << 62) - 1

# From here on a double is a whole number.
ALL_WHOLE = float(1 << 53)


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def integer_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vec) with floor(256 * x) of every component as a double.

    Rows with a null key, a null vector, or a null or non-finite component are left out.
    """
    x = F.col("vec")
    unfit = F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    )
    return (
        vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vec"))
        .filter(F.col("key").isNotNull() & x.isNotNull() & ~unfit)
        # floor gives a bigint, which holds no number beyond its range.
        .select(
            "key",
            F.transform(
                x,
                lambda v: F.when(F.abs(v * 256) >= ALL_WHOLE, v * 256).otherwise(
                    F.floor(v * 256).cast("double")
                ),
            ).alias("vec"),
        )
    )


def _scores(
    queries: np.ndarray, candidates: np.ndarray, keys: np.ndarray, others: np.ndarray
) -> np.ndarray:
    """All inner products as whole numbers; raises ValueError for one beyond MOST."""
    bound = (np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0)) * max(
        1, queries.shape[1]
    )
    if bound < 2.0**53:
        return (queries @ candidates.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], object) for m in (queries, candidates)]
    found = whole[0].reshape(queries.shape) @ whole[1].reshape(candidates.shape).T
    beyond = np.argwhere((np.abs(found) > MOST) & (keys[:, None] != others[None, :]))
    if len(beyond):
        query, candidate = beyond[0]
        raise ValueError(
            f"the score of rows {keys[query]} and {others[candidate]} is beyond +-{MOST}"
        )
    return np.clip(found, -MOST, MOST).astype(np.int64)


def _matrix(column: pa.ChunkedArray, dimension: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _over_cells(
    queries: DataFrame,
    candidates: DataFrame,
    function: Callable[[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]], list[np.ndarray]],
    schema: str,
) -> DataFrame:
    """``function`` on the scores of every pair of cells, a few queries at a time.

    It gets (scores, query keys, candidate keys, state of these queries) and returns
    the columns of ``schema``. Scores of a query with itself are not to be used; they
    are marked by equal keys.
    """
    names = [field.split()[0] for field in schema.split(", ")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = []
        if left.num_rows and right.num_rows:
            dimension = left.column("dimension")[0].as_py()
            q, c = _matrix(left.column("vec"), dimension), _matrix(right.column("vec"), dimension)
            state = {n: left.column(n).to_numpy() for n in left.column_names if n not in ("vec",)}
            keys = right.column("key").to_numpy()
            for at in range(0, len(q), STEP):
                part = {n: v[at : at + STEP] for n, v in state.items()}
                found.append(function(_scores(q[at : at + STEP], c, part["key"], keys), part["key"], keys, part))
        columns = [
            np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64)
            for i in range(len(names))
        ]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    by = ["dimension", "query_cell", "candidate_cell"]
    return queries.groupBy(*by).cogroup(candidates.groupBy(*by)).applyInArrow(run, schema)


def _bins(k: int):
    """Counts of scores by bin, from the top to a cell's own k-th best."""

    def count(scores, keys, others, state):
        low, width = state["low"][:, None], state["width"][:, None]
        bins = (scores - low) // width
        # Above the range: known to be among the best, counted in earlier rounds.
        bins = np.where((keys[:, None] == others[None, :]) | (scores < low), -1, bins)
        bins[bins >= BINS] = -1
        rows, which, counts = [], [], []
        for at, own in enumerate(bins):
            histogram = np.bincount(own[own >= 0], minlength=BINS)
            from_top = np.cumsum(histogram[::-1])
            last = BINS - 1 - min(int(np.searchsorted(from_top, state["need"][at])), BINS - 1)
            used = np.nonzero(histogram[last:])[0] + last
            rows.append(np.full(len(used), keys[at]))
            which.append(used)
            counts.append(histogram[used])
        return [np.concatenate(x).astype(np.int64) for x in (rows, which, counts)]

    return count


def _best(k: int):
    """(query, candidate, score) above the k-th value, and the k smallest ids at it."""

    def choose(scores, keys, others, state):
        least = state["low"][:, None]
        usable = keys[:, None] != others[None, :]
        rows, which = np.nonzero((scores > least) & usable)
        tie_rows, tie_which = [], []
        for at, own in enumerate((scores == least) & usable):
            tied = np.nonzero(own)[0]
            if len(tied) > k:
                tied = tied[np.argpartition(others[tied], k - 1)[:k]]
            tie_rows.append(np.full(len(tied), at))
            tie_which.append(tied)
        rows = np.concatenate([rows, *tie_rows]).astype(np.int64)
        which = np.concatenate([which, *tie_which]).astype(np.int64)
        return [keys[rows], others[which], scores[rows, which]]

    return choose


def _cells(rows: DataFrame, most_rows: int, most_bytes: int) -> int:
    """How many cells keep ``rows`` below so many rows and bytes a cell, on average."""
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.col("dimension").cast("long") * 8)).first()
    return max(1, -(-n // most_rows), -(-(size or 0) // most_bytes))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    folder: str,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, key, score): each query's k highest integer inner products.

    Candidates are all rows but those with the query's own key; ties go to the smaller
    key; a query with fewer candidates gets them all. Only vectors of one length are
    compared. A key that repeats is queried once, with its least vector, and each of its
    rows is a candidate. ``key`` is of an integer type. Empty tables give no rows. Scores
    are exact up to 2**62; one beyond that raises an error that names its rows.
    """
    rows = vectors.withColumn("__query", F.coalesce(is_query, F.lit(False)))
    whole = integer_vectors(vectors, key, vector).select(
        F.col("key").cast("long").alias("key"), "vec", F.size("vec").alias("dimension")
    )
    asked = integer_vectors(rows.filter("__query"), key, vector).select(
        F.col("key").cast("long").alias("key"), "vec", F.size("vec").alias("dimension")
    )
    # The number tells rows with one key, and equal rows, apart: it deals them into cells.
    candidates = stage(
        whole.filter("dimension > 0").withColumn("number", F.monotonically_increasing_id()),
        folder,
        "candidates",
    )
    queries = stage(
        asked.filter("dimension > 0").groupBy("key").agg(F.min("vec").alias("vec"))
        .withColumn("dimension", F.size("vec")),
        folder,
        "queries",
    )
    candidate_cells = _cells(candidates, CANDIDATES_PER_CELL, CANDIDATE_BYTES)
    query_cells = _cells(queries, QUERIES_PER_CELL, QUERY_BYTES)
    cell_of_row = F.pmod(F.xxhash64("number"), F.lit(candidate_cells))
    # Each candidate goes to every query cell and each query to every candidate cell.
    candidates = candidates.select(
        "key",
        "vec",
        "dimension",
        cell_of_row.alias("candidate_cell"),
        F.explode(_numbers(query_cells)).alias("query_cell"),
    )
    queries = queries.select(
        "*",
        F.pmod(F.xxhash64("key"), F.lit(query_cells)).alias("query_cell"),
        F.explode(_numbers(candidate_cells)).alias("candidate_cell"),
    )
    largest = whole.filter("dimension > 0").agg(
        F.max(F.array_max(F.transform("vec", F.abs))), F.max("dimension")
    ).first()
    bound = min(int((largest[0] or 0) ** 2 * (largest[1] or 0)) + 1, MOST)
    width = 1
    while width * BINS < 2 * bound + 1:
        width *= BINS
    keys = queries.select("key").distinct()
    state = stage(
        keys.select("key", F.lit(-bound).cast("long").alias("low"), F.lit(k).cast("long").alias("need")),
        folder,
        "state_0",
    )
    round_ = 0
    while True:
        round_ += 1
        counted = _over_cells(
            queries.join(state, "key").withColumn("width", F.lit(width).cast("long")),
            candidates,
            _bins(k),
            "key bigint, bin bigint, n bigint",
        ).groupBy("key", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("key").orderBy(F.desc("bin"))
        reached = counted.withColumn("from_top", F.sum("n").over(down)).join(state, "key")
        # The first bin from the top with enough scores; all of them if they are too few.
        found = (
            reached.filter(F.col("from_top") >= F.col("need"))
            .groupBy("key")
            .agg(F.max(F.struct("bin", "from_top", "n", "low", "need")).alias("b"))
            .select(
                "key",
                (F.col("b.low") + F.col("b.bin") * width).alias("low_found"),
                (F.col("b.need") - (F.col("b.from_top") - F.col("b.n"))).alias("need_found"),
            )
        )
        state = stage(
            state.join(found, "key", "left").select(
                "key",
                F.coalesce("low_found", "low").alias("low"),
                F.coalesce("need_found", "need").alias("need"),
            ),
            folder,
            f"state_{round_}",
        )
        if width == 1:
            break
        width //= BINS
    chosen = _over_cells(
        queries.join(state, "key"), candidates, _best(k), "key bigint, other bigint, score bigint"
    )
    order = Window.partitionBy("key").orderBy(F.desc("score"), "other")
    return (
        chosen.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(F.col("key").alias("query_id"), "rank", F.col("other").alias(key), "score")
    )
