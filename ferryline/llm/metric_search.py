"""Exact top-k inner products through a paged M-tree.

Vectors are integers, ``floor(1024 * x)``. The tree has two levels of metric nodes: routing
vectors, taken from a bounded sample, and pages of at most ``PAGE`` vectors with a centre, a
covering radius, and the distance of the centre to its routing vector. A page keeps the distance of
each vector to the centre.

For a query q and a point at distance d or less from a centre c, the inner product is at most
``q.c + |q| d``. So the distance to the parent bounds a page without its centre, the covering
radius bounds all its vectors, and a vector's own distance bounds that vector. A search takes
pages in the order of their bounds and leaves out all that cannot reach the k-th best score so
far, ties included; the result is exact.

Queries are taken in blocks of ``QUERIES``, which bounds what is broadcast. Every task searches
its pages for a block and returns its best k for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferryline.runtime import materialize

PAGE = 256
#: Rows that a task splits into pages at a time.
BUFFER = 8192
#: The sample of routing vectors, and of vectors for the first threshold of each query.
ROUTES, SEEDS = 128, 2048
QUERIES = 1024
_PAGE = "route int, parent double, radius double, dims int, centre binary, ids binary, near binary, vectors binary"


def integer_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v``, the integers as doubles. Rows without id, and vectors NULL or with a NULL or non-finite component, are left out."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    whole = whole.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)
    return whole.select("id", F.transform("v", lambda x: F.floor(x * 1024).cast("double")).alias("v"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for n, v in enumerate(vectors):
        out[n, : min(len(v), width)] = v[:width]
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(square.clip(0))


def _split(vectors: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Pages of nearby rows: each node is halved between two of its far points until it fits a page."""
    work = [rows]
    while work:
        own = work.pop()
        if len(own) <= PAGE:
            yield own
            continue
        some = vectors[own]
        first = some[np.argmax(((some - some[0]) ** 2).sum(1))]
        second = some[np.argmax(((some - first) ** 2).sum(1))]
        order = np.argsort(some @ (second - first), kind="stable")
        work += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]


def build_pages(vectors: DataFrame, width: int, tasks: int) -> DataFrame:
    """The tree's pages. Rows are spread by routing vector and distance, so a hot vector fills many tasks."""
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(ROUTES).toPandas()
    routes = _matrix(sample["v"], width)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            far = _distances(_matrix(batch["v"], width), routes)
            best = far.argmin(1)
            yield batch.assign(route=best, far=far[np.arange(len(best)), best])

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def page(rows: pd.DataFrame) -> pd.DataFrame:
            matrix, ids, found = _matrix(rows["v"], width), rows["id"].to_numpy(np.int64), []
            for number, at in rows.groupby("route").indices.items():
                for own in _split(matrix, at):
                    centre = matrix[own].mean(0)
                    near = np.sqrt(((matrix[own] - centre) ** 2).sum(1))
                    order = np.argsort(near, kind="stable")
                    own, near = own[order], near[order]
                    parent = float(np.sqrt(((centre - routes[number]) ** 2).sum()))
                    blobs = [x.tobytes() for x in (centre, ids[own], near, matrix[own])]
                    found.append((int(number), parent, float(near[-1]), width, *blobs))
            return pd.DataFrame(found, columns=[c.split()[0] for c in _PAGE.split(", ")])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= BUFFER:
                yield page(pd.concat(held, ignore_index=True))
                held, size = [], 0
        if size:
            yield page(pd.concat(held, ignore_index=True))

    routed = vectors.mapInPandas(route, "id long, v array<double>, route int, far double")
    spread = routed.repartitionByRange(tasks, "route", "far", "id").sortWithinPartitions("route", "far", "id")
    return materialize(spread.mapInPandas(pages, _PAGE), "pages"), routes


class Block:
    """A block of queries with the best scores so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, least: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.least = least.copy()
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def scan(self, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        score = self.vectors[queries] @ vectors.T
        score[self.ids[queries][:, None] == ids[None]] = -np.inf
        score[score < self.least[queries][:, None]] = -np.inf
        some = np.flatnonzero((score > -np.inf).any(1))
        if not len(some):
            return
        own = queries[some]
        score = np.concatenate([self.scores[own], score[some]], axis=1)
        names = np.concatenate([self.found[own], np.broadcast_to(ids, (len(own), len(ids)))], axis=1)
        order = np.lexsort((names, -score), axis=1)[:, : self.k]
        self.scores[own] = np.take_along_axis(score, order, 1)
        self.found[own] = np.take_along_axis(names, order, 1)
        self.least[own] = np.maximum(self.least[own], self.scores[own, -1])

    def slack(self) -> np.ndarray:
        """What rounding may take from a bound."""
        return 1e-6 + 1e-9 * self.norms * self.norms.max(initial=1.0)


def search_pages(batch: pd.DataFrame, block: Block, routes: np.ndarray, routed: np.ndarray) -> None:
    """Search some pages, best bounds first. ``routed`` holds the inner products of queries and routing vectors."""
    if not len(batch):
        return
    parent, radius = batch["parent"].to_numpy(), batch["radius"].to_numpy()
    slack = block.slack()[:, None]
    cheap = routed[:, batch["route"].to_numpy()] + block.norms[:, None] * (parent + radius) + slack
    centres = np.array([np.frombuffer(c) for c in batch["centre"]])
    order = np.argsort(-cheap.max(0))
    for n in order:
        queries = np.flatnonzero(cheap[:, n] >= block.least)
        if not len(queries):
            continue
        middle = block.vectors[queries] @ centres[n]
        keep = middle + block.norms[queries] * radius[n] + slack[queries, 0] >= block.least[queries]
        queries, middle = queries[keep], middle[keep]
        if not len(queries):
            continue
        near = np.frombuffer(batch["near"].iloc[n])
        need = ((block.least[queries] - middle - slack[queries, 0]) / np.maximum(block.norms[queries], 1e-12)).min()
        low = int(np.searchsorted(near, need)) if np.isfinite(need) else 0
        ids = np.frombuffer(batch["ids"].iloc[n], np.int64)[low:]
        vectors = np.frombuffer(batch["vectors"].iloc[n]).reshape(len(near), -1)[low:]
        if len(ids):
            block.scan(queries, ids, vectors)


def top_products(rows: DataFrame, key: str, vector: str, query_where: str, k: int = 10) -> DataFrame:
    """``query_id``, ``rank`` from 1, the other row's ``id`` and its ``score``: the k largest integer inner products.

    Queries are the rows for which the SQL condition ``query_where`` on ``id`` holds; candidates are
    all rows with another id; ties go to smaller ids. Shorter vectors count as padded with zeros.
    Rows that repeat an id are candidates each; a repeated query is searched once for each different
    vector. Scores must stay below 2**53.
    """
    spark = rows.sparkSession
    vectors = materialize(integer_vectors(rows, key, vector), "vectors")
    shape = vectors.agg(F.max(F.size("v")).alias("w"), F.count("*").alias("n")).first()
    schema = "query_id long, id long, score long"
    if not shape["n"]:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    width = shape["w"]
    pages, routes = build_pages(vectors, width, max(1, min(shape["n"] // BUFFER + 1, 100_000)))
    seeds = vectors.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(SEEDS).toPandas()
    seed_ids, seed_vectors = seeds["id"].to_numpy(np.int64), _matrix(seeds["v"], width)
    queries = materialize(vectors.where(query_where).dropDuplicates(["id", "v"]), "queries")
    count = max(1, -(-queries.count() // (QUERIES // 2)))
    result = None
    for number in range(count):
        own = queries.where(F.pmod(F.xxhash64("id", "v"), F.lit(count)) == number).toPandas()
        if not len(own):
            continue
        ids, matrix = own["id"].to_numpy(np.int64), _matrix(own["v"], width)
        first = Block(ids, matrix, np.full(len(ids), -np.inf), k)
        first.scan(np.arange(len(ids)), seed_ids, seed_vectors)
        shared = spark.sparkContext.broadcast((ids, matrix, first.least, routes, matrix @ routes.T))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            own_ids, own_matrix, least, own_routes, routed = shared.value
            block = Block(own_ids, own_matrix, least, k)
            for batch in batches:
                search_pages(batch, block, own_routes, routed)
            at, place = np.nonzero(block.scores > -np.inf)
            yield pd.DataFrame({"query_id": own_ids[at], "id": block.found[at, place], "score": block.scores[at, place].astype(np.int64)})

        part = pages.mapInPandas(search, schema)
        result = part if result is None else result.unionByName(part)
    if result is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return result.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
