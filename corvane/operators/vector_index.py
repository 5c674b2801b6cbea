"""Vectors stored by cell, searched exactly: the triangle inequality tells which cells cannot hold a hit."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.operators.nearest import Best, matrix
from corvane.scale import ROWS_PER_TASK, Ordered, limit, materialize, scratch_path

# Most cells, and most values of a table of queries by cells that the driver holds.
MOST_CELLS = 4096
PLAN_VALUES = 8_000_000
# Values of the largest query block, and of the sample that the cells are fitted on.
QUERY_VALUES = 4_000_000
SAMPLE_VALUES = 4_000_000
_ROUNDS, _ROWS_PER_CELL, _LANES = 8, 8, 32
_NO_DIRECTION = -1      # cell of the zero vectors under cosine: similarity 0 with everything
_HALF_TURN = np.sqrt(2.0)   # distance of unit vectors whose similarity is 0
_SLACK = 1e-6           # rounding allowed for in a bound, relative to the lengths compared


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and which had a length at all."""
    norms = np.linalg.norm(vectors, axis=1)
    some = norms > 0
    return vectors / np.where(some, norms, 1.0)[:, None], some


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def _centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Lloyd's rounds over a bounded sample; a cell that loses all its rows keeps its place."""
    centres = sample[np.linspace(0, len(sample) - 1, cells).astype(int)].copy()
    for _ in range(_ROUNDS):
        own = np.concatenate([_distances(sample[i:i + 1024], centres).argmin(1) for i in range(0, len(sample), 1024)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        sizes = np.bincount(own, minlength=cells)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


@dataclass(frozen=True)
class SearchReport:
    """What a search had to look at: pairs of a query and a cell, and of a query and a row, as shares of all."""

    queries: int
    cells: int
    cell_share: float
    row_share: float


@dataclass(frozen=True)
class VectorIndex:
    """Rows ``__id``, ``__v``, ``__d`` (distance to the centre) under ``path/rows/cell=…``, cells in ``path/cells``.

    Building shuffles the corpus once, by cell; a cell of any size spans as many files as
    it needs. A search reads only cells in place and never shuffles them.
    """

    spark: SparkSession
    path: str
    metric: str
    id_type: str
    cells: np.ndarray      # cell numbers
    centres: np.ndarray
    sizes: np.ndarray
    radius: np.ndarray     # largest distance of a row to its centre

    @staticmethod
    def build(corpus: DataFrame, metric: str = "cosine", cid: str = "id", vector: str = "vector", path: str | None = None,
              sample_values: int | None = None, most_cells: int = MOST_CELLS) -> "VectorIndex":
        """Index every row with a vector.

        The centres are fitted on at most ``sample_values`` numbers (the rows with the least id
        hashes); they decide what a search reads, never what it finds. About as many cells as
        the root of the number of rows, ``most_cells`` at most.
        """
        spark = corpus.sparkSession
        sample_values = limit(spark, "blockValues", SAMPLE_VALUES, sample_values)
        path = path or scratch_path(spark, "index")
        rows = corpus.select(F.col(cid).alias("__id"), F.col(vector).alias("__v")).filter("__v is not null")
        shape = rows.agg(F.count("*").alias("n"), F.max(F.size("__v")).alias("d")).first()
        n, dim = shape["n"], shape["d"] or 1
        picked = rows.orderBy(F.xxhash64("__id")).limit(max(1, min(n, sample_values // dim))).select("__v").toPandas()
        sample = matrix(picked["__v"]) if len(picked) else np.zeros((1, dim))
        if metric == "cosine":
            sample, some = _unit(sample)
            sample = sample[some] if some.any() else sample[:1]
        cells = max(1, min(int(n ** 0.5), most_cells, len(sample) // _ROWS_PER_CELL))
        shared = spark.sparkContext.broadcast(_centres(sample, cells))

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if pdf.empty:
                    continue
                vectors = matrix(pdf["__v"])
                some = np.ones(len(vectors), bool)
                if metric == "cosine":
                    vectors, some = _unit(vectors)
                cell, dist = np.empty(len(vectors), np.int32), np.empty(len(vectors))
                for i in range(0, len(vectors), 1024):
                    d = _distances(vectors[i:i + 1024], shared.value)
                    cell[i:i + 1024] = d.argmin(1)
                    dist[i:i + 1024] = d.min(1)
                cell[~some], dist[~some] = _NO_DIRECTION, 0.0
                yield pdf.assign(cell=cell, __d=dist)
        id_type = rows.schema["__id"].dataType.simpleString()
        kinds = f"__id {id_type}, __v {rows.schema['__v'].dataType.simpleString()}, cell int, __d double"
        placed = rows.mapInPandas(assign, kinds)
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_TASK))
        placed.repartitionByRange(parts, "cell", F.xxhash64("__id")).write.partitionBy("cell").parquet(f"{path}/rows")
        stored = spark.read.schema(kinds).parquet(f"{path}/rows")
        found = stored.groupBy("cell").agg(F.count("*").alias("n"), F.max("__d").alias("radius")).toPandas()
        found["centre"] = [(shared.value[c] if c >= 0 else np.zeros(dim)).tolist() for c in found["cell"]]
        found["metric"], found["id_type"] = metric, id_type
        spark.createDataFrame(found, _CELLS).coalesce(1).write.parquet(f"{path}/cells")
        return VectorIndex.open(spark, path, metric, id_type)

    @staticmethod
    def open(spark: SparkSession, path: str, metric: str = "cosine", id_type: str = "bigint") -> "VectorIndex":
        """A stored index; ``metric`` and ``id_type`` only matter to one without rows."""
        found = spark.read.schema(_CELLS).parquet(f"{path}/cells").orderBy("cell").toPandas()  # at most MOST_CELLS + 1 rows
        if len(found):
            metric, id_type = found["metric"][0], found["id_type"][0]
        centres = matrix(found["centre"]) if len(found) else np.empty((0, 1))
        return VectorIndex(spark, path, metric, id_type, found["cell"].to_numpy(), centres, found["n"].to_numpy(),
                           found["radius"].to_numpy(dtype=np.float64))

    def search(self, queries: DataFrame, k: int = 10, qid: str = "qid", vector: str = "vector",
               query_values: int | None = None) -> DataFrame:
        """(__q, __id, __s, rank): the k nearest rows of each query, equal to those of a full scan.

        ``__s`` is larger for nearer rows, ties go to the lower id. ``qid`` is unique.
        """
        return self.search_reported(queries, k, qid, vector, query_values)[0]

    def search_reported(self, queries: DataFrame, k: int = 10, qid: str = "qid", vector: str = "vector",
                        query_values: int | None = None) -> tuple[DataFrame, SearchReport]:
        """Hits and what was read for them.

        Queries are taken in blocks of neighbours, bounded in size. A block first scans the nearest
        cells with k rows; the k-th score so found bounds the distance of any hit, and only cells
        whose centre less radius lies within it are scanned as well.
        """
        query_values = limit(self.spark, "queryValues", QUERY_VALUES, query_values)
        kind = queries.schema[qid].dataType.simpleString()
        schema = f"__q {kind}, __id {self.id_type}, __s double"
        q = materialize(queries.select(F.col(qid).alias("__q"), F.col(vector).alias("__v")).filter("__v is not null"), "queries")
        n, dim = q.count(), max(1, self.centres.shape[1])
        step = max(1, min(query_values // dim, PLAN_VALUES // max(k, len(self.cells), 1)))
        if n > step:
            q = materialize(Ordered(self._near(q, kind), [], ["__c", "__q"]).index("__ix").result(), "queries")
        out, cell_pairs, row_pairs = scratch_path(self.spark, "hits"), 0, 0
        paths = []
        for first in range(0, n if len(self.cells) else 0, step):
            block = q.filter(F.col("__ix").between(first, first + step - 1)) if n > step else q
            held = block.select("__q", "__v").toPandas()     # at most ``step`` rows
            hits, looked = self._block(held["__q"].to_numpy(), matrix(held["__v"]), k, schema)
            paths.append(f"{out}/block={first:012d}")
            hits.write.parquet(paths[-1])
            cell_pairs, row_pairs = cell_pairs + int(looked.sum()), row_pairs + int((looked @ self.sizes).sum())
        report = SearchReport(n, len(self.cells), cell_pairs / max(1, n * len(self.cells)),
                              row_pairs / max(1, n * int(self.sizes.sum())))
        if not paths:
            return self.spark.createDataFrame([], f"{schema}, rank int"), report
        return self.spark.read.schema(f"{schema}, rank int").parquet(*paths), report

    def _near(self, q: DataFrame, kind: str) -> DataFrame:
        """Queries with their nearest cell, so that a block of neighbours reads few cells."""
        shared = self.spark.sparkContext.broadcast(self.centres)

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    vectors = [_distances(matrix(pdf["__v"][i:i + 1024]), shared.value).argmin(1) for i in range(0, len(pdf), 1024)]
                    yield pdf.assign(__c=np.concatenate(vectors).astype(np.int32))
        return q.mapInPandas(place, f"__q {kind}, __v {q.schema['__v'].dataType.simpleString()}, __c int")

    def _bounds(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distance of each query to each centre, the least it can have to a row there, rounding, and which queries have a direction."""
        some = np.ones(len(vectors), bool)
        if self.metric == "cosine":
            vectors, some = _unit(vectors)
        apart = _distances(vectors, self.centres)
        reach = np.linalg.norm(self.centres, axis=1) + self.radius
        slack = _SLACK * (1.0 + np.linalg.norm(vectors, axis=1) + reach.max())
        least = np.maximum(apart - self.radius - slack[:, None], 0.0)
        if self.metric == "cosine":
            least[:, self.cells == _NO_DIRECTION] = _HALF_TURN
            least[~some] = 0.0           # every row is as near as any other
        return apart, least, slack, some

    def _block(self, qids: np.ndarray, vectors: np.ndarray, k: int, schema: str) -> tuple[DataFrame, np.ndarray]:
        apart, least, slack, some = self._bounds(vectors)
        order = np.argsort(least + 1e-9 * apart, axis=1, kind="stable")
        sizes = self.sizes[order]
        first = np.zeros(apart.shape, bool)
        np.put_along_axis(first, order, np.cumsum(sizes, axis=1) - sizes < k, axis=1)
        found = materialize(self._scan(qids, vectors, first, k, schema), "near")
        worst = found.filter(F.col("rank") == k).select("__q", "__s").toPandas()      # a row per query
        at = pd.Index(qids).get_indexer(worst["__q"])
        score = np.full(len(qids), -np.inf)
        score[at] = worst["__s"]
        within = np.sqrt(np.maximum(2.0 - 2.0 * score if self.metric == "cosine" else -score, 0.0)) + slack
        second = ~first & (least <= within[:, None])
        if not second.any():
            return found, first
        within[~some] = np.inf
        more = self._scan(qids, vectors, second, k, schema, apart, within)
        return _ranked(found.drop("rank").unionByName(more.drop("rank")), k), first | second

    def _scan(self, qids: np.ndarray, vectors: np.ndarray, wanted: np.ndarray, k: int, schema: str,
              apart: np.ndarray | None = None, within: np.ndarray | None = None) -> DataFrame:
        """The k best of the ``wanted`` cells of each query; rows too far from or too near to their centre are passed over."""
        metric = self.metric
        reading = wanted.any(0)
        shared = self.spark.sparkContext.broadcast((qids, vectors, {int(c): i for i, c in enumerate(self.cells)}, wanted, apart, within))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, mat, place, asked, far, reach = shared.value
            best = Best(ids, k)
            for pdf in batches:
                for cell, part in pdf.groupby("cell"):
                    at = place[int(cell)]
                    who = np.flatnonzero(asked[:, at])
                    if reach is not None and cell != _NO_DIRECTION:
                        d = part["__d"].to_numpy()
                        part = part[(d >= (far[who, at] - reach[who]).min()) & (d <= (far[who, at] + reach[who]).max())]
                    if len(who) and len(part):
                        best.offer(who, mat, part["__id"].to_numpy(), matrix(part["__v"]), metric)
            yield best.frame()
        rows = self.spark.read.parquet(f"{self.path}/rows")
        if not reading.all():
            rows = rows.filter(F.col("cell").isin(self.cells[reading].tolist()))
        return _ranked(rows.mapInPandas(scan, schema), k)


_CELLS = "cell int, n bigint, radius double, centre array<double>, metric string, id_type string"


def _ranked(near: DataFrame, k: int) -> DataFrame:
    """The k best of each query: first of each lane of tasks, then of the lanes."""
    order = [F.desc("__s"), F.col("__id")]
    lanes = near.withColumn("__lane", F.pmod(F.spark_partition_id(), F.lit(_LANES)))
    lane = Window.partitionBy("__q", "__lane").orderBy(*order)
    lanes = lanes.withColumn("rank", F.row_number().over(lane)).filter(F.col("rank") <= k).drop("__lane", "rank")
    return lanes.withColumn("rank", F.row_number().over(Window.partitionBy("__q").orderBy(*order))).filter(F.col("rank") <= k)


