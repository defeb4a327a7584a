"""Exact top-k inner products by a Voronoi join.

Pivots are `pivots` data vectors with the lowest hash of their id (a bounded sample).
Every vector belongs to the cell of its nearest pivot, with its distance d to it. For a
query q and a vector x of the cell of pivot c,

    q.c - |q| d  <=  q.x  <=  q.c + |q| d.

A summary of each cell (rows, largest d, the smallest d of the k + 1 nearest ids) gives each
query a floor under its k-th score: k vectors of other ids reach it. A
query is sent only to the cells whose bound for the largest d reaches its floor, and
there meets only the vectors whose own d does. Queries move and not the data, since
there are fewer of them. Cells are cut into blocks of about `block_rows` vectors and the
queries into chunks of about `chunk_rows`, so a cell with most of the data, as
of one vector repeated, is many tasks. Each block returns k candidates a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.llm.common import sample_by_hash
from flowloom.session import settle


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, null for vectors that are null or empty or hold null or non-finite components."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when((F.size(vector) > 0) & ~bad, F.transform(wide, lambda x: F.floor(x * scale).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.int64)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; by way of doubles where those are exact."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _with_cells(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Cell (index of the nearest pivot of the same length) and distance of each row (id, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dim))
                if int(dim) not in pivots:
                    continue
                x, c = _matrix(part.column("v")).astype(np.float64), pivots[int(dim)].astype(np.float64)
                cell = ((c * c).sum(1)[None, :] - 2 * (x @ c.T)).argmin(1)
                d = np.sqrt(((x - c[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), pa.array(np.full(len(d), dim), pa.int32()),
                                                  pa.array(cell, pa.int32()), pa.array(d, pa.float64())], ["id", "v", "dim", "cell", "d"])

    return rows.mapInArrow(run, "id long, v array<long>, dim int, cell int, d double")


def top_k(data: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256,
          pivots: int = 64, block_rows: int = 16_384, chunk_rows: int = 2_048) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k highest integer inner products.

    Queries are the rows where `is_query` holds; candidates are all rows of another id and
    the same length. Ties go to the smaller id; with fewer candidates all are returned.
    Null ids and vectors that are null, empty or hold null or non-finite components
    take no part. A repeated query row counts once, repeated candidates each for
    themselves. An empty table gives no rows; other columns are not read. `pivots` is the bound of the collected sample,
    and one vector of each length that it misses; cells are summarised by at most k + 1 distances.
    """
    spark = data.sparkSession
    rows = data.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"), is_query.alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    chosen: dict[int, list] = {}
    for row in sample_by_hash(rows.select("id", "v"), F.col("id"), pivots).collect():
        chosen.setdefault(len(row.v), []).append(row.v)
    missed = rows.filter(~F.size("v").isin(list(chosen)))  # lengths that the sample has missed: a row a length
    for row in missed.groupBy(F.size("v").alias("dim")).agg(F.min("v").alias("v")).collect():
        chosen[row.dim] = [row.v]
    centres = {dim: np.unique(np.array(v, dtype=np.int64), axis=0) for dim, v in chosen.items()}
    cells = settle(_with_cells(rows.select("id", "v"), centres), "topk-cells")
    nearest = W.partitionBy("dim", "cell").orderBy("d", "id")
    least = (cells.groupBy("dim", "cell", "id").agg(F.min("d").alias("d")).withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= k + 1)
             .groupBy("dim", "cell").agg(F.sort_array(F.collect_list(F.struct("d", "id"))).alias("least")))
    summary = {(r["dim"], r["cell"]): r for r in cells.groupBy("dim", "cell").agg(F.count("*").alias("rows"), F.max("d").alias("far"))
               .join(least, ["dim", "cell"]).collect()}  # a row a pivot
    queries = rows.filter("q").select("id", "v").distinct()
    blocks = {key: -(-r["rows"] // block_rows) for key, r in summary.items()}
    chunks = max(1, -(-queries.count() // chunk_rows))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for qid, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                mine = [key for key in summary if key[0] == len(v)]
                if not mine:
                    continue
                q, norm = np.array(v, dtype=np.float64), float(np.linalg.norm(np.array(v, dtype=np.float64)))
                base = {key: float(centres[key[0]][key[1]].astype(np.float64) @ q) for key in mine}
                sure = sorted((base[key] - norm * d for key in mine for d, i in summary[key]["least"] if i != qid), reverse=True)
                floor = sure[k - 1] if len(sure) >= k else -np.inf
                floor -= 1e-9 * abs(floor) + 1e-3 if np.isfinite(floor) else 0  # for rounding
                for key in mine:
                    if base[key] + norm * summary[key]["far"] >= floor:
                        least_d = (floor - base[key]) / norm if norm and np.isfinite(floor) else -1.0
                        out += [(qid, v, *key, b, qid % chunks, least_d) for b in range(blocks[key])]
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["id", "v", "dim", "cell", "block", "chunk", "least_d"])

    types = [pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    asked = queries.mapInArrow(sent, "id long, v array<long>, dim int, cell int, block int, chunk int, least_d double")

    sizes = F.create_map(*[F.lit(x) for key, b in blocks.items() for x in (f"{key[0]}:{key[1]}", b)]) if blocks else F.create_map()
    per_cell = F.coalesce(sizes[F.concat_ws(":", "dim", "cell")], F.lit(1)) if blocks else F.lit(1)
    held = cells.withColumn("block", F.pmod(F.xxhash64("id"), per_cell).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("int"), F.lit(chunks - 1).cast("int"))))

    def solve(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("id", kind="stable")
            x, ids, far = np.stack(right["v"].to_numpy()), right["id"].to_numpy(), right["d"].to_numpy()
            least_d, names = left["least_d"].to_numpy(), left["id"].to_numpy()
            keep = far >= least_d.min()
            x, ids, far = x[keep], ids[keep], far[keep]
            q = np.stack(left["v"].to_numpy())
            for at in range(0, len(q), 256):
                scores = _dot(q[at : at + 256], x) if len(x) else np.empty((0, 0))
                for i, s in enumerate(scores):
                    fit = np.flatnonzero((far >= least_d[at + i]) & (ids != names[at + i]))
                    if len(fit) > k:
                        s_fit = s[fit]
                        edge = np.partition(s_fit, len(fit) - k)[len(fit) - k]
                        above, tied = fit[s_fit > edge], fit[s_fit == edge]
                        fit = np.concatenate([above, tied[: k - len(above)]])  # ids ascend
                    out.append(pd.DataFrame({"query_id": names[at + i], "vec_id": ids[fit], "score": s[fit]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    keys = ["dim", "cell", "block", "chunk"]
    found = asked.groupBy(keys).cogroup(held.groupBy(keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""
