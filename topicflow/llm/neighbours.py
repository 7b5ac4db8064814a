"""Approximate nearest neighbours: a neighbour graph by NN-descent, queries by greedy search on the graph.

Nearness is the largest inner product. Equal vectors are one *node*, so copies cost nothing and are put back
at the end. The graph starts from cells: each node is compared with others of its nearest pivots' cells,
in blocks of bounded size. Then NN-descent repeats: the neighbours of a node, and those it is a neighbour of, are joined
with each other, and a pair is kept where it is better than what either node has. Only pairs with a member that is new since
the last round are looked at.

A query starts at its own node's neighbours. In each round the unexpanded nodes among its best ``beam`` are joined with their
neighbours, these are scored, and the best ``beam`` stay, until nothing is left to expand. Queries are taken in blocks
of bounded size, whose vectors go to the tasks. Scores of results are computed anew from the original vectors in double
precision. The result is approximate; ``cells``, ``neighbours``, ``rounds`` and ``beam`` trade time for recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicflow.storage import fresh_folder, stored

CELL_BLOCK = 2560  # nodes compared with each other in one task
CELLS = 4  # cells a node is put into
MOST_PIVOTS = 4096
JOINED = 48  # neighbours, in either direction, that are joined with each other
QUERY_BLOCK = 20_000
MOST_SEARCH_ROUNDS = 40


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>): rows with an id and a finite vector that isn't zero, of the commonest length."""
    kept = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    ).where(
        """vec_id is not null and size(v) > 0 and exists(v, x -> x <> 0)
        and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"""
    )
    sizes = kept.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    first = sizes.orderBy(F.desc("rows"), "n").first()
    return kept.where(F.size("v") == (first.n if first else 0))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors as the bytes of their doubles."""
    for batch in batches:
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
        rows = flat.reshape(len(batch), -1) if len(batch) else np.empty((0, 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array([r.tobytes() for r in rows], pa.binary())], ["node", "v"]
        )


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1).astype(kind)


def _in_cells(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """node, cell, code: the cells of a node's nearest pivots."""
    for batch in batches:
        if not len(batch):
            continue
        rows = _matrix(batch.column("v"), np.float32)
        near = np.argsort(-(rows @ pivots.T), axis=1, kind="stable")[:, : min(CELLS, len(pivots))]
        nodes = batch.column("node").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(nodes, near.shape[1])), pa.array(near.ravel().astype(np.int32))], ["node", "cell"]
        )


def _best_in_block(table: pa.Table, neighbours: int) -> pa.Table:
    """node, nbr, score: the best neighbours of each node among the others of its block."""
    nodes = table.column("node").to_numpy()
    rows = _matrix(table.column("v").combine_chunks(), np.float32)
    scores = rows @ rows.T
    np.fill_diagonal(scores, -np.inf)
    count = min(neighbours, len(nodes) - 1)
    if count < 1:
        empty = np.empty(0, np.int64)
        return pa.table({"node": empty, "nbr": empty, "score": empty.astype(np.float32)})
    best = np.argpartition(-scores, count - 1, axis=1)[:, :count]
    return pa.table(
        {
            "node": np.repeat(nodes, count),
            "nbr": nodes[best.ravel()],
            "score": np.take_along_axis(scores, best, 1).ravel(),
        }
    )


def _local_join(table: pa.Table) -> pa.Table:
    """node, nbr, score: pairs of one node's neighbours that are better than what the first of them has."""
    nodes = table.column("v").to_numpy()
    fresh = table.column("fresh").to_numpy(zero_copy_only=False)
    worst = table.column("worst").to_numpy()
    rows = _matrix(table.column("code").combine_chunks(), np.float32)
    scores = rows @ rows.T
    better = (scores > worst[:, None]) & (fresh[:, None] | fresh[None]) & (nodes[:, None] != nodes[None])
    x, y = np.nonzero(better)
    return pa.table({"node": nodes[x], "nbr": nodes[y], "score": scores[x, y]})


def _ranked(rows: DataFrame, by: str, order: list, limit: int) -> DataFrame:
    """The first ``limit`` rows of each ``by``; Spark drops the rest before it shuffles them."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(
        F.col("rank") <= limit
    )


class Index:
    """The stored graph of one table of vectors (vec_id, embedding)."""

    def __init__(self, vectors: DataFrame, neighbours: int = 24, rounds: int = 2):
        self.spark: SparkSession = vectors.sparkSession
        self.neighbours = neighbours
        rows = usable(vectors)
        distinct = rows.select("v").distinct()
        # ids may repeat over different vectors, so nodes are numbered
        self.nodes = self._store(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
        self.rows = self._store(
            rows.join(self.nodes.withColumnRenamed("v", "same"), F.col("v") == F.col("same")).select("vec_id", "node"),
            "rows",
        )
        self.packed = self._store(self.nodes.mapInArrow(_packed, "node bigint, v binary"), "packed")
        self.graph = self._start()
        for _ in range(rounds):
            self.graph = self._descend()

    def _store(self, frame: DataFrame, label: str) -> DataFrame:
        return stored(frame, fresh_folder(self.spark, label))

    def _start(self) -> DataFrame:
        count = self.packed.count()
        wanted = int(min(max(8, CELLS * count // CELL_BLOCK), MOST_PIVOTS))
        chosen = self.packed.orderBy(F.xxhash64("node"), "node").limit(wanted).select("v").collect()
        pivots = np.array([np.frombuffer(row.v, np.float64) for row in chosen]).astype(np.float32)
        if not len(pivots):
            return self.spark.createDataFrame([], "node bigint, nbr bigint, score float, fresh boolean")
        pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
        cells = self._store(
            self.packed.mapInArrow(lambda rows: _in_cells(rows, pivots), "node bigint, cell int"), "cells"
        )
        sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_BLOCK).alias("blocks"))
        dealt = cells.join(sizes, "cell").select(
            "node", "cell", F.expr("pmod(xxhash64(node, cell), blocks)").alias("block")
        )
        neighbours = self.neighbours
        found = (
            dealt.join(self.packed, "node")
            .groupBy("cell", "block")
            .applyInArrow(lambda table: _best_in_block(table, neighbours), "node bigint, nbr bigint, score float")
        )
        found = found.dropDuplicates(["node", "nbr"]).withColumn("fresh", F.lit(True))
        return self._store(self._best(found), "graph")

    def _best(self, pairs: DataFrame) -> DataFrame:
        kept = _ranked(pairs, "node", [F.desc("score"), "nbr"], self.neighbours)
        return kept.select("node", "nbr", "score", "fresh")

    def around(self) -> DataFrame:
        """(u, v, fresh): neighbours of u and nodes u is a neighbour of, the new ones first, ``JOINED`` at most."""
        both = self.graph.select(F.col("node").alias("u"), F.col("nbr").alias("v"), "fresh").union(
            self.graph.select(F.col("nbr").alias("u"), F.col("node").alias("v"), "fresh")
        )
        both = both.groupBy("u", "v").agg(F.max("fresh").alias("fresh"))
        return _ranked(both, "u", [F.desc("fresh"), F.xxhash64("u", "v"), "v"], JOINED).select("u", "v", "fresh")

    def _descend(self) -> DataFrame:
        worst = self.graph.groupBy(F.col("node").alias("v")).agg(
            F.when(F.count(F.lit(1)) >= self.neighbours, F.min("score")).otherwise(F.lit(float("-inf"))).alias("worst")
        )
        codes = self.packed.select(F.col("node").alias("v"), F.col("v").alias("code")).join(worst, "v")
        codes = codes.select("v", "code", F.col("worst").cast("float").alias("worst"))
        found = (
            self.around()
            .join(codes, "v")
            .groupBy("u")
            .applyInArrow(_local_join, "node bigint, nbr bigint, score float")
        )
        merged = (
            self.graph.select("node", "nbr", "score", F.lit(False).alias("fresh"))
            .union(found.select("node", "nbr", "score", F.lit(True).alias("fresh")))
            .groupBy("node", "nbr")
            .agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
        )
        return self._store(self._best(merged), "graph")

    def search(self, queries: DataFrame, k: int = 20, beam: int = 160) -> DataFrame:
        """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each of ``queries`` (vec_id).

        Queries are rows of the indexed table; a query's own row is no answer, copies of it are. Ties go to the
        smaller vec_id. Ids that take no part in the index give no rows.
        """
        asked = self._store(
            self.rows.join(queries.select(F.col("vec_id").cast("bigint").alias("vec_id")).distinct(), "vec_id"), "asked"
        )
        starts = asked.select("node").distinct().join(self.packed, "node")
        blocks = asked.select("node").distinct().count() // QUERY_BLOCK + 1
        near = self._store(self.around().select("u", "v"), "around")
        found = None
        for block in range(blocks):
            mine = starts.where(F.pmod(F.xxhash64("node"), F.lit(blocks)) == block).orderBy("node").collect()
            if mine:
                ids = np.array([row.node for row in mine], np.int64)
                rows = np.array([np.frombuffer(row.v, np.float64) for row in mine])
                part = self._greedy(near, ids, rows, k, beam)
                found = part if found is None else found.union(part)
        if found is None:
            return self.spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
        # of each node as many rows as can be answers: k, and the query's own
        copies = _ranked(self.rows, "node", ["vec_id"], k + 1).select(F.col("node").alias("nbr"), "vec_id")
        answers = (
            asked.select(F.col("vec_id").alias("query_id"), F.col("node").alias("q"))
            .join(found, "q")
            .join(copies, "nbr")
            .where("not (q = nbr and vec_id = query_id)")
        )
        ranked = answers.withColumn(
            "rank", F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
        )
        return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def _greedy(self, near: DataFrame, ids: np.ndarray, rows: np.ndarray, k: int, beam: int) -> DataFrame:
        """(q, nbr, score): the best nodes of every query node, its own included."""
        single = rows.astype(np.float32)
        own = pa.table({"q": ids, "nbr": ids, "score": (rows * rows).sum(axis=1).astype(np.float32)})
        pool = self.spark.createDataFrame(own).select("q", "nbr", "score", F.lit(False).alias("expanded"))
        for _ in range(MOST_SEARCH_ROUNDS):
            offered = (
                pool.where("not expanded").join(near, F.col("nbr") == F.col("u")).select("q", F.col("v").alias("node"))
            )
            scored = (
                offered.distinct()
                .join(self.packed, "node")
                .mapInArrow(lambda batches: _scored(batches, ids, single), "q bigint, nbr bigint, score float")
            )
            pool = (
                pool.select("q", "nbr", "score", F.lit(True).alias("expanded"))
                .union(scored.select("q", "nbr", "score", F.lit(False).alias("expanded")))
                .groupBy("q", "nbr")
                .agg(F.max("score").alias("score"), F.max("expanded").alias("expanded"))
            )
            pool = self._store(
                _ranked(pool, "q", [F.desc("score"), "nbr"], beam).select("q", "nbr", "score", "expanded"), "pool"
            )
            if pool.where("not expanded").isEmpty():
                break
        best = _ranked(pool, "q", [F.desc("score"), "nbr"], 2 * k + 1).select("q", F.col("nbr").alias("node"))
        return best.join(self.packed, "node").mapInArrow(
            lambda batches: _scored(batches, ids, rows), "q bigint, nbr bigint, score double"
        )


def _scored(batches: Iterator[pa.RecordBatch], ids: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """q, nbr, score: inner products with the queries' vectors; ``ids`` ascend."""
    for batch in batches:
        if not len(batch):
            continue
        asked = batch.column("q").to_numpy()
        others = _matrix(batch.column("v"), rows.dtype)
        scores = np.einsum("ij,ij->i", rows[np.searchsorted(ids, asked)], others)
        yield pa.RecordBatch.from_arrays(
            [batch.column("q"), batch.column("node"), pa.array(scores)], ["q", "nbr", "score"]
        )


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, **parameters) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` (vec_id) among all rows of ``vectors`` (vec_id, embedding).

    Vectors that are null, zero, or hold nulls or numbers that aren't finite take no part, nor do rows without id or
    with another length than the commonest. Of rows that share an id each is answered. With fewer candidates than ``k``
    those found are returned. Empty tables give no rows.
    """
    beam = parameters.pop("beam", 160)
    return Index(vectors, **parameters).search(queries, k, beam)
