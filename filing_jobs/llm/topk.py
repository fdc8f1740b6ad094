"""Exact top-k inner-product search by distributed histogram selection.

Everything is scored, block by block. Each pass counts scores in bins of every query's current range,
adds the counts over all blocks and narrows the range to the bin with the k-th highest score, until
that score is known. A last pass keeps what reaches it; ties go to the smaller id.

All joins are told to merge: sizes that Spark estimates from packed and compressed blocks are far too low, and
it would broadcast the copies of all blocks through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filing_jobs.llm.common import picked, stored

#: Rows of a block, and bins of a pass.
BLOCK, BINS = 2048, 1024
#: The greatest long, and what is below every score.
MOST, NEVER = (1 << 63) - 1, -(1 << 63)


def matrix_of(data: bytes, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, dim) if dim else np.zeros((len(data), 0))


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64; those that do not fit one are MOST or -MOST."""
    dim = queries.shape[1]
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, dim)
    if most < 1 << 24 and queries.dtype == rows.dtype == np.float32:
        return (queries @ rows.T).astype("i8")
    if most < 1 << 53:
        return (queries.astype("f8") @ rows.T.astype("f8")).astype("i8")
    if most < 1 << 62:
        return queries.astype("i8") @ rows.T.astype("i8")
    exact = np.array([[int(x) for x in q] for q in queries], object) @ np.array([[int(x) for x in r] for r in rows], object).T
    return np.array([[max(-MOST, min(MOST, v)) for v in line] for line in exact], "i8").reshape(exact.shape)


def blocks(df: DataFrame, id_col: str, vector_col: str, scale: float, block: int) -> DataFrame:
    """Rows (dim, block, n, most, ids, kind, data): vectors quantised to floor(scale * x) and packed by their length.

    Null ids and vectors that are null or hold a null, NaN or infinite component take no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[int, int] = {}

        def out(dim: int, ids: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            most = float(np.abs(data).max(initial=0))
            kind = "<f4" if most < 1 << 24 else "<f8"
            packed = data.astype(kind).tobytes() if dim else bytes(len(ids))
            number += 1
            columns = {"dim": dim, "block": part << 32 | number - 1, "n": len(ids), "most": most, "ids": ids.astype("<i8").tobytes(), "kind": kind, "data": packed}
            return pa.RecordBatch.from_pylist([columns], schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("most", pa.float64()), ("ids", pa.binary()), ("kind", pa.string()), ("data", pa.binary())]))

        def full(dim: int, least: int) -> Iterator[pa.RecordBatch]:
            while sizes.get(dim, 0) >= least:
                ids, data = (np.concatenate(x) for x in zip(*held[dim], strict=True))
                yield out(dim, ids[:block], data[:block])
                held[dim], sizes[dim] = [(ids[block:], data[block:])], max(0, len(ids) - block)

        for batch in batches:
            lists = batch["v"]
            lengths = np.where(lists.is_valid(), lists.value_lengths().fill_null(0), 0)
            starts = np.concatenate([[0], lengths.cumsum()])
            with np.errstate(invalid="ignore", over="ignore"):
                flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)  # a null component is NaN
            broken = np.concatenate([[0], (~np.isfinite(flat)).cumsum()])
            good = lists.is_valid().to_numpy(zero_copy_only=False) & batch["id"].is_valid().to_numpy(zero_copy_only=False) & (broken[starts[1:]] == broken[starts[:-1]])
            names = batch["id"].fill_null(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths[good]).tolist():
                at = np.flatnonzero(good & (lengths == dim))
                held.setdefault(dim, []).append((names[at], flat[starts[at][:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0))))
                sizes[dim] = sizes.get(dim, 0) + len(at)
                yield from full(dim, block)
        for dim in sorted(held):
            yield from full(dim, 1)

    rows = picked(df, id=id_col, v=vector_col).select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "dim int, block long, n int, most double, ids binary, kind string, data binary")


def search(df: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0,
           block: int = BLOCK, bins: int = BINS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query among all other rows.

    Vectors of another length than the query's are no candidates. A row with the query's id is its own
    and no candidate; repeated rows of other ids each count. Every valid row of a query id asks, and the id's
    k highest are those of all its rows. Fewer candidates give fewer rows; no queries, none. A score that does not fit
    a long counts as the nearest one that does; such scores tie.
    """
    rows = picked(df, id=id_col, v=vector_col)
    asked = df.where(is_query).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    candidates = stored(blocks(rows, "id", "v", scale, block), "topk-rows")
    queries = stored(blocks(asked, "id", "v", scale, block), "topk-queries")
    sizes = queries.agg(F.count("*"), F.max("most"), F.max("dim")).first(), candidates.agg(F.count("*"), F.max("most")).first()
    n_queries, n_rows = sizes[0][0], sizes[1][0]
    bound = float(sizes[0][1] or 0) * float(sizes[1][1] or 0) * max(1, sizes[0][2] or 0) if n_queries and n_rows else 0.0
    bound = min(MOST, int(min(2e19, bound * (1 + 1e-9))) + 1)

    # a grid of cells: every pair of blocks meets in one, the many candidates are copied less often than the queries
    cells = max(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_queries * n_rows // 64)
    down = max(1, min(n_queries, math.isqrt(cells // 20)))
    across = max(1, min(n_rows, -(-cells // down)))
    right = candidates.select("dim", F.col("ids").alias("c_ids"), F.col("kind").alias("c_kind"), F.col("data").alias("c_data"), F.pmod(F.xxhash64("block"), F.lit(across)).alias("across"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("down"))

    def pairs(state: DataFrame | None) -> DataFrame:
        """Block pairs; with the queries' ranges (lo, width of a bin, span of all bins) once there are any."""
        left = queries.select("dim", "block", F.col("ids").alias("q_ids"), F.col("kind").alias("q_kind"), F.col("data").alias("q_data"))
        if state is not None:
            listed = state.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "lo", "width", "span"))).alias("ranges"))  # at most a block's rows
            left = left.join(listed.hint("merge"), "block", "left")
        else:
            left = left.withColumn("ranges", F.lit(None).cast("array<struct<at:int,lo:long,width:long,span:long>>"))
        left = left.withColumn("down", F.pmod(F.xxhash64("block"), F.lit(down)).cast("int")).withColumn("across", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))))
        return left.join(right.hint("merge"), ["dim", "down", "across"])

    def scored(batch: pa.RecordBatch, row: int, first: int) -> tuple:
        """Scores of a pair of blocks (own rows below everything) and each query's range."""
        get = lambda c: batch[c][row].as_py()
        q, c, dim = np.frombuffer(get("q_ids"), "<i8"), np.frombuffer(get("c_ids"), "<i8"), get("dim")
        scores = products(matrix_of(get("q_data"), dim, get("q_kind")), matrix_of(get("c_data"), dim, get("c_kind")))
        scores[q[:, None] == c[None, :]] = NEVER
        lo, width, span = np.full(len(q), -bound, "i8"), np.full(len(q), first, "i8"), np.full(len(q), NEVER, "i8")
        for at, *found in (x.values() for x in get("ranges") or ()):
            lo[at], width[at], span[at] = found
        return q, c, scores, lo, width, span

    def count(first: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    q, c, scores, lo, width, span = scored(batch, row, first)
                    own_kth = np.partition(scores, -k, axis=1)[:, -k] if len(c) > k else np.full(len(q), -bound)
                    # the k-th score of all rows is no lower than that of these, so lower bins don't matter
                    # unsigned: the range may be as wide as all longs. What is beyond the span is counted already
                    beyond = scores.view("u8") - lo.view("u8")[:, None]
                    bin_of = beyond // width.view("u8")[:, None]
                    inside = (span == NEVER)[:, None] | (beyond < span.view("u8")[:, None])
                    at, col = np.nonzero((scores >= np.maximum(own_kth, lo)[:, None]) & inside)
                    keys, counts = np.unique(at * bins + bin_of[at, col].astype("i8"), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), batch["block"][row].as_py()), pa.int64()), pa.array(keys // bins, pa.int32()), pa.array(keys % bins, pa.int64()), pa.array(counts, pa.int64())], ["block", "at", "bin", "n"])

        return run

    width = 1 << max(0, (-(-(2 * bound + 1) // bins) - 1).bit_length())
    state, first = None, width
    while n_queries and n_rows:
        counted = pairs(state).mapInArrow(count(first), "block long, at int, bin long, n long").groupBy("block", "at", "bin").agg(F.sum("n").alias("n"))
        upto = Window.partitionBy("block", "at").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        summed = counted.withColumn("upto", F.sum("n").over(upto))
        if state is None:
            summed = summed.select("*", F.lit(-bound).cast("long").alias("lo"), F.lit(0).cast("long").alias("above"), F.lit(None).cast("long").alias("span"))
        else:
            summed = summed.join(state.select("block", "at", "lo", "above", "span").hint("merge"), ["block", "at"])
        last = F.row_number().over(Window.partitionBy("block", "at").orderBy(F.desc("reached"), F.when(F.col("reached"), -F.col("bin")).otherwise(F.col("bin"))))
        # the first bin from above that reaches k; a query with fewer candidates keeps its lowest bin
        found = summed.withColumn("reached", F.col("above") + F.col("upto") >= k).withColumn("last", last).where("last = 1")
        wide = lambda x: x.cast("decimal(38,0)")
        own_span = F.when(F.col("span").isNull(), F.lit(width)).otherwise(F.least(F.lit(width), F.col("span") - F.col("bin") * F.lit(width)))  # the last bin may be cut
        state = stored(found.select("block", "at", (wide(F.col("lo")) + wide(F.col("bin")) * wide(F.lit(width))).cast("long").alias("lo"), (F.col("above") + F.col("upto") - F.col("n")).alias("above"), (F.col("above") + F.col("upto")).alias("upto"), F.lit(-(-width // bins)).cast("long").alias("width"), own_span.cast("long").alias("span")), "topk-ranges")
        if width == 1 or (state.agg(F.max("upto")).first()[0] or 0) <= 4 * k:
            break
        width = -(-width // bins)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q, c, scores, lo, _, _ = scored(batch, row, first)
                at, col = np.nonzero(scores >= lo[:, None])
                value = scores[at, col]
                order = np.lexsort((c[col], -value, at))
                at, col, value = at[order], col[order], value[order]
                place = np.arange(len(at)) - np.searchsorted(at, at)  # beyond the k best of these rows none is among the k best of all
                at, col, value = at[place < k], col[place < k], value[place < k]
                yield pa.RecordBatch.from_arrays([pa.array(q[at], pa.int64()), pa.array(c[col], pa.int64()), pa.array(value, pa.int64()), pa.array(np.full(len(at), batch["block"][row].as_py()), pa.int64())], ["query_id", "vec_id", "score", "block"])

    found = pairs(state).mapInArrow(keep, "query_id long, vec_id long, score long, block long")
    for keys in (("query_id", "block"), ("query_id",)):  # an id of many rows is ranked block by block before all of it is
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
        found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
