"""Approximate nearest neighbours by an inverted multi-index.

The two halves of a vector are quantised by their own codebooks; a pair of
centroids is a cell.  A query takes the cells in the order of the summed
squared distances of its halves to the centroids, with a heap over the sorted
distances (multi-sequence traversal), until the cells seen hold a set share of
all rows; every row of those cells is reranked by the exact distance.  Cells that cannot
hold a neighbour are passed over: the radius of a code in each half bounds the
distance of a cell's rows from below, and the k-th distance among a few rows of the
sample bounds the result's from above.

Fit: codebooks come from at most ``max_sample`` rows (least hash of the id).
The share is calibrated on that sample: the least share that finds ``target``
of the sample's true neighbours.  Structured data need little, directionless
data much; nothing else caps what is reranked.  Every row is indexed.

Scale: rows are packed by cell into buckets of about ``bucket_rows`` rows, a cell
larger than that is spread over several buckets, and a bucket asked for by many
queries is split by query; a task holds one bucket and its queries.  Vectors
that are equal tie at every distance, so at most k+1 of them (the smallest ids)
can ever be returned; the others are set aside before the index (exactly, by a
group limit ahead of the shuffle), which keeps a very common vector harmless.
The driver holds the sample and a table of at most ``max_codes``**2 counts.  Vectors of
another length lie in another space: each length has an index of its own.

Defined cases: null ids and vectors null, empty, zero, or with null or non-finite
components take no part; rows are near rows of their own length alone.  Rows repeated exactly count once.  Ties go to the smaller id.  An empty
table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.session import ship_package, write_shared

BOUNDS = 2048
RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's algorithm from evenly spread distinct rows; empty centroids stay."""
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    centres = distinct[np.random.default_rng(7).choice(len(distinct), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=k)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * (x @ centres.T)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return gaps(x, centres).argmin(1)


def traverse(
    first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: float, near: np.ndarray | None = None, far: np.ndarray | None = None, limit: float = np.inf
) -> list[int]:
    """Cells by summed distance until they hold ``enough`` rows; empty ones are passed.

    ``near`` and ``far`` are least squared distances to any row of a code: cells where they
    sum to more than ``limit`` count as seen, but are not returned.
    """
    i_of, j_of = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[i_of].tolist(), second[j_of].tolist()
    i_list, j_list = i_of.tolist(), j_of.tolist()
    width = len(b)
    heap = [(a[0] + b[0], 0, 0)]
    held, out = 0, []
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = i_list[i] * width + j_list[j]
        if counts[cell]:
            held += counts[cell]
            if near is None or near[i_list[i]] + far[j_list[j]] <= limit:
                out.append(cell)
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out


def least(squares: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Least squared distance to a row within ``radius`` of a centroid ``squares`` away, with room for rounding."""
    return np.maximum(0, np.sqrt(np.maximum(squares, 0)) * (1 - 1e-9) - radius * (1 + 1e-9) - 1e-9) ** 2


@dataclass(frozen=True)
class MultiIndex:
    first: np.ndarray
    second: np.ndarray
    share: float
    some: np.ndarray  # rows of the sample

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, : self.half], self.first) * len(self.second) + nearest(x[:, self.half :], self.second)

    def apart(self, x: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of the rows' halves to their centroids."""
        i, j = np.divmod(cells, len(self.second))
        a, b = x[:, : self.half] - self.first[i], x[:, self.half :] - self.second[j]
        return np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))

    def limits(self, x: np.ndarray, k: int) -> np.ndarray:
        """Squared distances that the k-th neighbour of a row does not exceed."""
        if len(self.some) <= k:
            return np.full(len(x), np.inf)
        # One more than k: the row itself may be among them.
        d = np.maximum(np.partition(gaps(x, self.some), k, axis=1)[:, k], 0)
        return d + 1e-6 * (1 + d + (x * x).sum(1))


def calibrate(x: np.ndarray, first: np.ndarray, second: np.ndarray, k: int, target: float, probes: int = 256) -> float:
    """Least share of rows to traverse that finds ``target`` of the sample's neighbours."""
    half = first.shape[1]
    cells = nearest(x[:, :half], first) * len(second) + nearest(x[:, half:], second)
    counts = np.bincount(cells, minlength=len(first) * len(second))
    needs = []
    for q in range(0, len(x), max(1, len(x) // probes)):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        near = np.argpartition(d, min(k, len(x) - 1) - 1)[: min(k, len(x) - 1)]
        if not len(near):
            continue
        sums = (gaps(x[q : q + 1, :half], first)[0][:, None] + gaps(x[q : q + 1, half:], second)[0][None]).ravel()
        order = np.argsort(sums, kind="stable")
        seen = np.empty(len(order))
        seen[order] = np.cumsum(counts[order])
        needs += (seen[cells[near]] / len(x)).tolist()
    return float(np.quantile(needs, target)) if needs else 1.0


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part, as (vec_id, v, n) with v as n doubles."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(
        F.col("vec_id").isNotNull()
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists("v", lambda c: c != 0)
    )
    return rows.withColumn("n", F.size("v"))


def fit(rows: DataFrame, total: int, k: int, max_sample: int, max_codes: int, target: float) -> MultiIndex:
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max_sample).toArrow()
    x = np.asarray(sample["v"].combine_chunks().flatten(), dtype=np.float64).reshape(len(sample), -1)
    half = max(1, x.shape[1] // 2)
    codes = int(max(2, min(max_codes, (total / 20) ** 0.5)))
    first = kmeans(x[:, :half], codes)
    second = kmeans(x[:, half:], codes) if half < x.shape[1] else np.zeros((1, 0))
    return MultiIndex(first, second, calibrate(x, first, second, k, target), x[:BOUNDS].copy())


def matrix(batch: pa.RecordBatch, name: str = "v") -> np.ndarray:
    column = batch.column(name)
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(batch), -1)


def rerank(ids: np.ndarray, x: np.ndarray, q: np.ndarray, k: int, own: int) -> list[tuple[int, float]]:
    """The k nearest of x to q by exact distance, ties to the smaller id."""
    rough = (x * x).sum(1) - 2 * (x @ q)
    rough[ids == own] = np.inf
    if len(rough) > k:
        bar = np.partition(rough, k - 1)[k - 1]
        pick = np.flatnonzero(rough <= bar + 1e-9 * (1 + abs(bar) + float(q @ q)))
    else:
        pick = np.arange(len(rough))
    pick = pick[ids[pick] != own]
    d = np.sqrt(((x[pick] - q) ** 2).sum(1))
    order = np.lexsort((ids[pick], d))[:k]
    return [(int(ids[pick[o]]), float(d[o])) for o in order]


def search(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    target: float = 0.96,
    max_sample: int = 8192,
    max_codes: int = 256,
    bucket_rows: int = 4096,
    bucket_queries: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest rows of every row whose id ``every`` divides."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = usable(vectors, id_col, vector_col)
    # Equal vectors: the k+1 smallest ids can be returned, no others.
    equal = Window.partitionBy("v").orderBy("vec_id")
    rows_once = (
        rows.withColumn("r", F.dense_rank().over(equal)).where(F.col("r") <= k + 1).select("vec_id", "v", "n").dropDuplicates()
    )
    kept = write_shared(rows_once, "ann-rows")
    out = spark.createDataFrame([], RESULT)
    for length in sorted(kept.groupBy("n").count().collect()):
        own = F.col("n") == length["n"]
        asked = rows.where(own & (F.col("vec_id") % every == 0)).select("vec_id", "v").dropDuplicates(["vec_id", "v"])
        index = fit(kept.where(own), length["count"], k, max_sample, max_codes, target)
        out = out.unionByName(_search(kept.where(own).select("vec_id", "v"), asked, index, length["count"], k, bucket_rows, bucket_queries))
    return out


def _search(
    kept: DataFrame, asked: DataFrame, index: MultiIndex, total: int, k: int, bucket_rows: int, bucket_queries: int
) -> DataFrame:
    """The k nearest rows of ``kept`` to each of ``asked``, vectors of one length."""
    spark = kept.sparkSession

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = matrix(batch)
                cells = index.cells(x)
                columns = [batch.column("vec_id"), batch.column("v"), pa.array(cells, pa.int32()), *map(pa.array, index.apart(x, cells))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "cell", "da", "db"])

    indexed = write_shared(kept.mapInArrow(locate, "vec_id bigint, v array<double>, cell int, da double, db double"), "ann-cells")
    width = len(index.second)
    counts = np.zeros(len(index.first) * width, dtype=np.int64)
    radius = np.zeros(len(index.first)), np.zeros(width)
    for r in indexed.groupBy("cell").agg(F.count("*").alias("n"), F.max("da").alias("a"), F.max("db").alias("b")).collect():
        counts[r["cell"]] = r["n"]  # at most max_codes ** 2 rows
        i, j = divmod(r["cell"], width)
        radius[0][i], radius[1][j] = max(radius[0][i], r["a"]), max(radius[1][j], r["b"])
    # Cells in the order of their first codes fill the buckets; large cells get several.
    parts = np.maximum(1, -(-counts // bucket_rows))
    bucket = np.zeros(len(counts), dtype=np.int64)
    at, load = 0, 0
    for cell, n in enumerate(counts.tolist()):
        if load and load + n > bucket_rows:
            at, load = at + 1, 0
        bucket[cell] = at
        if parts[cell] > 1:
            at, load = at + int(parts[cell]), 0
        else:
            load += n
    enough = index.share * total

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            x = matrix(batch)
            if not len(x):
                continue
            near, far = gaps(x[:, : index.half], index.first), gaps(x[:, index.half :], index.second)
            lows = least(near, radius[0]), least(far, radius[1])
            for q, v, a, b, c, d, limit in zip(batch.column("vec_id").to_pylist(), x, near, far, *lows, index.limits(x, k), strict=True):
                asked: dict[int, list[int]] = {}
                for cell in traverse(a, b, counts, enough, c, d, limit):
                    for p in range(int(parts[cell])):
                        asked.setdefault(int(bucket[cell]) + p, []).append(cell)
                out += [(q, v.tolist(), g, cells) for g, cells in asked.items()]
            schema = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.float64())), ("bucket", pa.int64()), ("cells", pa.list_(pa.int32()))])
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    routed = write_shared(asked.mapInArrow(route, "query_id bigint, q array<double>, bucket bigint, cells array<int>"), "ann-queries")
    # A bucket is read once for every bucket_queries queries that ask for it; one nobody asks for, never.
    chunks = routed.groupBy("bucket").agg(F.ceil(F.count("*") / bucket_queries).cast("int").alias("chunks"))
    chunks = write_shared(chunks, "ann-chunks")
    spread = spark.createDataFrame(
        [(c, int(bucket[c]), int(parts[c])) for c in np.flatnonzero(counts).tolist()], "cell int, base bigint, parts int"
    )  # at most max_codes ** 2 rows of three numbers
    dealt = indexed.join(F.broadcast(spread), "cell").select(
        "vec_id", "v", "cell", (F.col("base") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).alias("bucket")
    )
    dealt = dealt.join(chunks, "bucket").select(
        "vec_id", "v", "cell", "bucket", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    )
    queries = routed.join(chunks, "bucket").withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int")).drop("chunks")

    def nearby(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            ids, cell = rows["vec_id"].to_numpy(), rows["cell"].to_numpy()
            x = np.stack(rows["v"].to_numpy())
            for q, v, cells in zip(queries["query_id"], queries["q"], queries["cells"], strict=True):
                seen = np.isin(cell, cells)
                out += [(q, *r) for r in rerank(ids[seen], x[seen], np.asarray(v), k, q)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    pairs = (
        dealt.groupBy("bucket", "chunk")
        .cogroup(queries.groupBy("bucket", "chunk"))
        .applyInPandas(nearby, "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
