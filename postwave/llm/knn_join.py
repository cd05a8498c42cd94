"""Exact top-k search by inner product as a Voronoi kNN join.

Data vectors fall into the Voronoi cells of ``PIVOTS`` pivots, queries into groups round pivots of their own
(both from k-means over a bounded sample; pivots only decide how the work is cut, never the result). Each cell is
summed up by its number of rows, its radius and the ``k + 1`` least distances to its pivot. From these alone follows,
for a query group with centre a and radius s and a row x at distance d of its cell's pivot p:

    a.p - |a| d - s |p| - s d  <=  q.x  <=  a.p + |a| d + s |p| + s d        for every query q of the group

so the (k+1)-th greatest lower bound over all cells is a score that every query of the group reaches with k rows besides
itself, and rows of a cell nearer to its pivot than the distance at which the upper bound gets there can't be
in any result. All other rows go to the group, in packed blocks dealt over splits of bounded size; hot groups of queries
are cut too. Each (group, cut, split) is solved with one matrix product at a time, and the splits' answers are merged by rank.

Unit vectors without clusters (as in the test tables) leave nothing to prune: every row goes to every group, whose number is
small for that reason (one per ``GROUP_QUERIES`` queries).

Defined cases: a vector that is null, or holds a null or non-finite component, takes no part; shorter vectors count as filled up
with zeros (an empty one scores 0); a query's own row is no candidate, but other rows with its id are; repeated query rows
each get their answers; a null id is no query, and as a candidate comes last among ties. Components are floor(scale * x) in
double, held to +-2^62, and scores to the range of a long. An empty table gives no rows. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postwave.llm.common import ready, stored

PIVOTS = 64
#: Rows the pivots are fitted on, and components these rows may hold together.
SAMPLE_ROWS, SAMPLE_COMPONENTS = 4096, 1 << 22
GROUP_QUERIES, LEAST_GROUPS = 1024, 4
#: Queries and data rows of one local solution.
CUT_QUERIES, SPLIT_ROWS = 4096, 16384
BLOCK_ROWS = 2000
LONG_MAX = (1 << 63) - 1


def quantised(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) in double, as integers held to +-2^62."""
    return np.clip(np.floor(scale * values.astype(np.float64)), -2.0**62, 2.0**62).astype(np.int64)


def _matrix(col: pa.Array, dim: int, scale: float) -> np.ndarray:
    """Rows of a list column as one matrix of integers, short rows filled up with zeros."""
    sizes = np.diff(col.offsets.to_numpy())
    flat = quantised(col.flatten().to_numpy(zero_copy_only=False), scale)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _centres(sample: np.ndarray, n: int) -> np.ndarray:
    """k-means over the sample, from evenly spaced distinct rows on."""
    rows = np.unique(sample, axis=0).astype(np.float64)
    centres = rows[np.linspace(0, len(rows) - 1, min(n, len(rows))).astype(int)].copy()
    for _ in range(5):
        near = _nearest(rows, centres)[0]
        for j in range(len(centres)):
            mine = rows[near == j]
            if len(mine):
                centres[j] = mine.mean(axis=0)
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and a distance to it that rounding can only have enlarged a little."""
    x = rows.astype(np.float64)
    near = ((centres * centres).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)
    return near, np.sqrt(((x - centres[near]) ** 2).sum(axis=1))


def least_distances(pivots: np.ndarray, cells: dict[int, list[float]], centre: np.ndarray, radius: float, k: int) -> np.ndarray:
    """For a query group, the distance from which on the rows of each cell are needed (inf: the cell is not).

    ``cells``: the least distances (up to k + 1) of each cell that has rows."""
    a = float(np.sqrt((centre * centre).sum()))
    lows = []
    for j, near in cells.items():
        p = float(np.sqrt((pivots[j] * pivots[j]).sum()))
        lows += [float(centre @ pivots[j]) - radius * p - (a + radius) * d for d in near]
    out = np.full(len(pivots), np.inf)
    reach = sorted(lows, reverse=True)[k] if len(lows) > k else -np.inf
    slack = 1e-6 * (abs(reach) + a * a + radius * radius + 1) if np.isfinite(reach) else 0.0
    for j in cells:
        p = float(np.sqrt((pivots[j] * pivots[j]).sum()))
        gap = reach - slack - float(centre @ pivots[j]) - radius * p
        out[j] = -np.inf if gap <= 0 or not np.isfinite(gap) else (gap / (a + radius) if a + radius > 0 else np.inf)
    return out


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in double below 2^53, in int64 below 2^63, else of Python's integers, held to a long."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * max(1, queries.shape[1])
    if most < 1 << 53:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    exact = queries.astype(object) @ rows.astype(object).T
    return np.vectorize(lambda v: max(-LONG_MAX - 1, min(LONG_MAX, v)), otypes=[np.int64])(exact)


def best(q_rows: np.ndarray, queries: np.ndarray, d_rows: np.ndarray, ids: np.ndarray, known: np.ndarray, data: np.ndarray, k: int):
    """(query position, data position, score) of each query's k best among the data, ties to the least id (unknown ids last)."""
    order = np.lexsort((ids, ~known))
    d_rows, data = d_rows[order], data[order]
    found = []
    for at in range(0, len(queries), 512):
        part = _scores(queries[at:at + 512], data)
        own = q_rows[at:at + 512, None] == d_rows
        if part.shape[1] > k + 1:
            # The own row may be among the k + 1 best; whoever scores less than all of those can't be in the result.
            low = np.partition(part, part.shape[1] - k - 1, axis=1)[:, part.shape[1] - k - 1]
            q, d = np.nonzero((part >= low[:, None]) & ~own)
        else:
            q, d = np.nonzero(~own)
        s = part[q, d]
        by = np.lexsort((d, ~s, q))
        q, d, s = q[by], d[by], s[by]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < k
        found.append((q[keep] + at, order[d[keep]], s[keep]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 3


def search(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best rows for each row on which ``queries`` holds."""
    spark = ready(vectors.sparkSession)
    vec = F.col(f"`{vec_col}`")
    fits = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    src = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("is_query"),
                         vec.alias("v"), fits.alias("fits")).where("fits").drop("fits")
    greatest = F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))
    n, n_queries, dim, top = src.agg(F.count(F.lit(1)), F.count_if("is_query"), F.max(F.size("v")), greatest).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n or not n_queries:
        return spark.createDataFrame([], schema)
    dtype = "<i2" if (top or 0) * scale < 32000 else "<i4" if (top or 0) * scale < 2e9 else "<i8"
    size = max(1, min(SAMPLE_ROWS, SAMPLE_COMPONENTS // max(1, dim)))
    picked = src.orderBy(F.xxhash64("v"), "id").limit(size).select("v").toArrow().column("v").combine_chunks()
    picked = picked.chunk(0) if isinstance(picked, pa.ChunkedArray) else picked
    sample = _matrix(picked, dim, scale)
    pivots = _centres(sample, PIVOTS)
    centres = _centres(sample, min(PIVOTS, max(LEAST_GROUPS, -(-n_queries // GROUP_QUERIES))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for b in batches:
            x = _matrix(b.column(2), dim, scale)
            cell, dist = _nearest(x, pivots)
            group, far = _nearest(x, centres)
            rows = np.arange(number, number + len(x))
            number += len(x)
            raw = pa.array([r.tobytes() for r in x.astype(dtype)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(rows), b.column(0), b.column(1), pa.array(cell.astype(np.int32)), pa.array(dist),
                                              pa.array(group.astype(np.int32)), pa.array(far), raw], ["row", "id", "is_query", "cell", "dist", "grp", "far", "v"])

    placed = stored(src.mapInArrow(assign, "row long, id long, is_query boolean, cell int, dist double, grp int, far double, v binary"), "knn-cells")
    # The summaries: k + 1 distances of each cell (a partial limit in every task), one row of each query group.
    nearest = Window.partitionBy("cell").orderBy("dist", "row")
    cells: dict[int, list[float]] = {}
    for r in placed.select("cell", "dist", "row").withColumn("at", F.row_number().over(nearest)).where(F.col("at") <= k + 1).collect():
        cells.setdefault(r["cell"], []).append(r["dist"])
    groups = placed.where("is_query").groupBy("grp").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    needed = {r["grp"]: least_distances(pivots, cells, centres[r["grp"]], r["radius"] * (1 + 1e-9) + 1e-6, k) for r in groups}
    cuts = {r["grp"]: -(-r["n"] // CUT_QUERIES) for r in groups}
    splits = -(-n // SPLIT_ROWS)
    keys = "grp int, cut int, split int, "

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each group's rows of a batch as one packed row for every cut of the group."""
        from pyspark import TaskContext

        at = TaskContext.get().partitionId()
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(lo, BLOCK_ROWS)
                at += 1
                rows, cell, dist = (part.column(c).to_numpy() for c in (0, 2, 3))
                for g, least in needed.items():
                    pick = np.flatnonzero(dist >= least[cell])
                    if not len(pick):
                        continue
                    mine = part.take(pa.array(pick))
                    ids = mine.column(1)
                    packed = [rows[pick].tobytes(), ids.fill_null(0).to_numpy().tobytes(), ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
                              b"".join(mine.column(4).to_pylist())]
                    out = [pa.array([g] * cuts[g], pa.int32()), pa.array(range(cuts[g]), pa.int32()), pa.array([at % splits] * cuts[g], pa.int32()),
                           *[pa.array([x] * cuts[g], pa.binary()) for x in packed]]
                    yield pa.RecordBatch.from_arrays(out, ["grp", "cut", "split", "rows", "ids", "known", "vs"])

    n_cuts = F.element_at(F.create_map(*[F.lit(x) for g, c in cuts.items() for x in (g, c)]), F.col("grp"))
    data = placed.select("row", "id", "cell", "dist", "v").mapInArrow(replicate, keys + "rows binary, ids binary, known binary, vs binary")
    asked = placed.where("is_query").select("grp", F.pmod(F.xxhash64("row"), n_cuts).cast("int").alias("cut"),
                                            F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"), "row", "id", "v")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        shape = (("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()))
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], t) for c, t in shape})
        q_rows, q_ids = left.column("row").to_numpy(), left.column("id").to_numpy()
        queries = np.frombuffer(b"".join(left.column("v").to_pylist()), dtype).reshape(len(q_rows), dim)
        held = None
        for block in right.to_pylist():
            rows, ids, known = np.frombuffer(block["rows"], np.int64), np.frombuffer(block["ids"], np.int64), np.frombuffer(block["known"], bool)
            q, d, s = best(q_rows, queries, rows, ids, known, np.frombuffer(block["vs"], dtype).reshape(len(rows), dim), k)
            new = [q, rows[d], ids[d], known[d], s]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            by = np.lexsort((held[1], held[2], ~held[3], ~held[4], held[0]))
            held = [x[by] for x in held]
            keep = np.arange(len(by)) - np.searchsorted(held[0], held[0]) < k
            held = [x[keep] for x in held]
        q, rows, ids, known, s = held
        return pa.table({"query_row": q_rows[q], "query_id": q_ids[q], "vec_row": rows, "vec_id": pa.array(ids, mask=~known), "score": s})

    on = ("grp", "cut", "split")
    solved = asked.groupBy(*on).cogroup(data.groupBy(*on)).applyInArrow(solve, "query_row long, query_id long, vec_row long, vec_id long, score long")
    ranked = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "vec_row")
    out = solved.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
