"""Hard negatives of anchor rows, from exact inner products of Kronecker-packed integers.

1. Components become whole numbers. Rows are sorted by label and packed into pages; anchors likewise into blocks.
   Both are tables in the shared folder.
2. A page meets a block in a cell, ``(block, slice of the pages)``. A cell is a part of one shuffle: its block comes first and
   stays, its pages pass by. Positives need only pages that share a label with the block.
3. A task biases the components of several candidates to be positive and puts them into fields of one wide integer.
   One multiplication by an anchor's component then serves all of them: the sum of the products over the components
   holds the exact score of each in its own field. Integers of up to 53 bits are carried by doubles, so that a page
   times a block is one matrix product; wider ones are Python integers.
4. A block has windows: one open window for each anchor finds its positives, then one for each positive finds the
   negatives between two bounds. Of each window a cell keeps the best few, so its state is bounded, and the cells'
   rows are ranked in Spark.

Only counts, the width and the bounds of the components reach the driver; anchors stay in tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.words import returning, text_batches
from ferryline.operators.numbering import number_rows
from ferryline.runtime import materialize

#: Candidates in a page, and anchors in a block at most. A block is worked through in stripes.
PAGE, BLOCK, STRIPE = 1024, 4096, 256
#: Bytes of the vectors of a page and of a block, as far as one vector allows; a thousand pages are one Arrow batch.
PAGE_BYTES, BLOCK_BYTES = 1 << 16, 1 << 20
#: Bits of a whole number that a double holds exactly, and fields of a wider integer.
EXACT, WIDE_FIELDS = 53, 8
_LOWEST = np.iinfo(np.int64).min
_PAGES = "page long, labels array<int>, ids binary, marks binary, vectors binary"
_FOUND = "block long, win long, anchor long, id long, score long"


@dataclass(frozen=True)
class Fields:
    """How scores are packed: ``bias`` makes components positive, ``most`` bounds a biased score, ``bits`` is a field's width."""

    bias: int
    most: int
    bits: int
    count: int

    @property
    def wide(self) -> bool:
        return self.bits > EXACT


def choose_fields(component: int, total: int) -> Fields:
    """Fields for candidates with components up to ``component`` and anchors with absolute sums up to ``total``."""
    most = max(1, 2 * component * total)
    bits = (2 * most + 1).bit_length()
    return Fields(component, most, bits, EXACT // bits if bits <= EXACT else WIDE_FIELDS)


def pack(candidates: np.ndarray, fields: Fields) -> np.ndarray:
    """Rows of whole numbers, several in one: as many columns as components, ``fields.count`` candidates in a row."""
    kind = object if fields.wide else np.float64
    groups = -(-len(candidates) // fields.count)
    biased = np.zeros((groups * fields.count, candidates.shape[1]), kind)
    biased[: len(candidates)] = candidates.astype(kind) + fields.bias
    packed = biased[:: fields.count].copy()
    for n in range(1, fields.count):
        packed += biased[n :: fields.count] * (1 << (fields.bits * n) if fields.wide else float(1 << (fields.bits * n)))
    return packed


def scores(anchors: np.ndarray, packed: np.ndarray, count: int, fields: Fields) -> np.ndarray:
    """Inner products of anchors with the first ``count`` packed candidates, as 64-bit numbers."""
    kind = object if fields.wide else np.float64
    lift = sum(fields.most << (fields.bits * n) for n in range(fields.count))
    product = anchors.astype(kind) @ packed.T
    product = product + lift if fields.wide else product.astype(np.int64) + lift
    mask, out = (1 << fields.bits) - 1, np.zeros((len(anchors), packed.shape[0] * fields.count), np.int64)
    back = fields.most + fields.bias * anchors.astype(kind).sum(1)
    for n in range(fields.count):
        field = (product >> (fields.bits * n)) & mask
        out[:, n :: fields.count] = (field - back[:, None]).astype(np.int64)
    return out[:, :count]


def whole_vectors(rows: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """``id``, ``label``, ``v`` in whole numbers, ``floor(scale * x)``, and ``row``.

    Rows without id, label or vector, and with a NULL or non-finite component, are left out.
    """
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    some = some.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
    return some.select("id", "label", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"), F.monotonically_increasing_id().alias("row"))


def _integers(component: int) -> type:
    return np.int16 if component < 1 << 15 else np.int32 if component < 1 << 31 else np.int64


def _paged(vectors: DataFrame, size: int, width: int, kind: type) -> DataFrame:
    """Pages of at most ``size`` rows, in the order of labels. The row number spreads repeated ids over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, rows = TaskContext.get().partitionId() << 32, [], 0

        def page(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(parts).combine_chunks()
            lists = table.column("v").combine_chunks()
            sizes, flat = np.asarray(lists.value_lengths()), np.asarray(lists.flatten())
            matrix = np.zeros((len(table), width), kind)
            starts = np.cumsum(sizes) - sizes
            matrix[np.repeat(np.arange(len(table)), sizes), np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
            marks = table.column("label").to_numpy().astype(np.int32)
            row = [number, np.unique(marks), table.column("id").to_numpy().astype(np.int64).tobytes(), marks.tobytes(), matrix.tobytes()]
            number += 1
            types = [pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types)], names=["page", "labels", "ids", "marks", "vectors"])

        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, size - rows)
                held.append(part)
                at, rows = at + len(part), rows + len(part)
                if rows == size:
                    yield page(held)
                    held, rows = [], 0
        if rows:
            yield page(held)

    order = ["label", "id", "row"]
    return vectors.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "label", "v").mapInArrow(run, _PAGES)


class Best:
    """The best ``keep`` candidates of each window of a block; ties go to smaller ids."""

    def __init__(self, wins: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int):
        self.wins, self.low, self.high, self.keep = wins, low, high, keep
        self.need = low.copy()
        self.at, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of the windows numbered ``at``."""
        if not len(at):
            return
        at, score, ids = (np.concatenate(x) for x in ((self.at, at), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, at))
        at, score, ids = at[order], score[order], ids[order]
        first = np.concatenate([[True], at[1:] != at[:-1]])
        place = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        kept = place < self.keep
        self.at, self.score, self.id = at[kept], score[kept], ids[kept]
        full = place == self.keep - 1
        self.need[at[full]] = np.maximum(self.need[at[full]], score[full])


def _search(fields: Fields, width: int, kind: type, keep: int, same: bool, positives: int) -> Callable:
    """A task's work on sorted cells; ``same`` looks for candidates of the anchor's label, else for those of others.

    Windows are numbered ``positives * place of the anchor + number of the positive``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, None
        ids = marks = matrix = None

        def result() -> pa.RecordBatch:
            win = best.wins[best.at]
            columns = [np.full(len(win), now[0]), win, ids[win // positives], best.id, best.score]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["block", "win", "anchor", "id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["ids"], np.int64)
                labels = np.frombuffer(row["marks"], np.int32)
                vectors = np.frombuffer(row["vectors"], kind).reshape(len(own), width)
                if (row["block"], row["part"]) != now:
                    if now is not None and len(best.at):
                        yield result()
                    now, ids, marks, matrix = (row["block"], row["part"]), own, labels, vectors
                    windows = [(w["win"], w["low"], w["high"]) for w in row["windows"]]
                    wins, low, high = (np.array(c, np.int64) for c in (zip(*sorted(windows)) if windows else ((), (), ())))
                    best = Best(wins, low, high, keep)
                    # The window of each place and number, and none as the last.
                    table = np.full((len(ids), positives), -1)
                    table[wins // positives, wins % positives] = np.arange(len(wins))
                    continue
                packed = pack(vectors, fields)
                for start in range(0, len(ids), STRIPE):
                    some = slice(start, start + STRIPE)
                    if same and not np.isin(marks[some], labels).any():
                        continue
                    found = scores(matrix[some], packed, len(own), fields)
                    fits = (marks[some, None] == labels[None]) == same
                    fits &= ids[some, None] != own[None]
                    found[~fits] = _LOWEST
                    for n in range(positives):
                        win = table[some, n]
                        there = np.flatnonzero(win >= 0)
                        if not len(there):
                            continue
                        w, part = win[there], found[there]
                        a, b = np.nonzero((part >= best.need[w][:, None]) & (part <= best.high[w][:, None]) & (part > _LOWEST))
                        best.add(w[a], part[a, b], own[b])
        if now is not None and len(best.at):
            yield result()

    return returning(run)


def _cells(blocks: DataFrame, pages: DataFrame, parts: int) -> DataFrame:
    """Blocks (``block``, ..., ``windows``) and pages (``block``, ...) brought together; each block before its pages."""
    columns = ["block", "part", "kind", "ids", "marks", "vectors", "windows"]
    first = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("kind", F.lit(0)).select(*columns)
    then = pages.withColumn("part", F.pmod(F.xxhash64("page"), F.lit(parts)).cast("int")).withColumn("kind", F.lit(1))
    then = then.withColumn("windows", F.lit(None).cast(blocks.schema["windows"].dataType)).select(*columns)
    return first.unionByName(then).repartition("block", "part").sortWithinPartitions("block", "part", "kind")


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("block", "win").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(
    rows: DataFrame,
    key: str,
    vector: str,
    label: str,
    anchor_where: str,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``, ``positive_score``, ``negative_score``.

    Scores are inner products of ``floor(scale * x)``. Anchors are the rows with ``anchor_where``, SQL on ``id``. An anchor's
    positives are its best ``positives`` candidates of its own label; for each, the best ``negatives`` candidates of other labels
    are returned whose score is from ``low`` to ``high`` hundredths of the positive's. Higher scores come first, then smaller ids.
    Candidates are the rows with another id. Rows without id, label or vector or with a NULL or non-finite component take no
    part; shorter vectors count as padded with zeros. Rows that repeat an id are candidates each; a repeated
    anchor is searched once for each different label and vector. Other columns do not matter. Scores of 2**56 or more are an error.
    """
    spark = rows.sparkSession
    nothing = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    vectors = materialize(whole_vectors(rows, key, vector, label, scale), "vectors")
    total = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + F.abs(x))
    shape = vectors.agg(F.max(F.size("v")).alias("width"), F.count("*").alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("component"))
    shape = shape.first()
    chosen = vectors.where(anchor_where).dropDuplicates(["id", "label", "v"])
    size = chosen.agg(F.count("*").alias("n"), F.max(total).alias("total")).first()
    if not size["n"] or not shape["width"]:
        return spark.createDataFrame([], nothing)
    fields, kind, width = choose_fields(shape["component"], size["total"]), _integers(shape["component"]), shape["width"]
    if fields.most >= 1 << 56:
        raise ValueError("components are too large for 64-bit scores")
    text_batches(rows)
    bytes_each = max(1, width * np.dtype(kind).itemsize)
    page = max(1, min(PAGE, PAGE_BYTES // bytes_each))
    pages = materialize(_paged(vectors, page, width, kind), "pages")
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = max(1, min(BLOCK, BLOCK_BYTES // bytes_each, -(-size["n"] // 16)))
    blocks = materialize(_paged(chosen, block, width, kind), "blocks")
    numbers = materialize(number_rows(blocks.select("page"), ["page"], "block"), "block-numbers")
    blocks = materialize(blocks.join(numbers, "page"), "numbered-blocks")
    count = numbers.count()
    parts = max(1, min(-(-2 * lanes // count), -(-shape["n"] // page)))

    # Positives: pages that share a label with a block.
    shared = pages.select("page", F.explode("labels").alias("label")).join(blocks.select("block", F.explode("labels").alias("label")), "label")
    near = pages.join(shared.select("page", "block").distinct(), "page")
    bound = 1 << 62
    places = F.transform(
        F.sequence(F.lit(0), (F.length("ids") / 8).cast("int") - 1),
        lambda n: F.struct(n.cast("long").alias("win"), F.lit(-bound).alias("low"), F.lit(bound).alias("high")),
    )
    cells = _cells(blocks.withColumn("windows", places), near, parts)
    found = materialize(cells.mapInArrow(_search(fields, width, kind, positives, True, 1), _FOUND), "positives")
    best = _ranked(found, positives).withColumn("window", F.col("win") * positives + F.col("rank") - 1)
    best = best.select("block", F.col("window").alias("win"), F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = materialize(best, "windows")

    # Negatives: every page; a block has at most ``positives`` windows for each of its anchors.
    least = F.expr(f"({low} * positive_score) div 100 + CAST(({low} * positive_score) % 100 > 0 AS INT)")
    most = F.expr(f"({high} * positive_score) div 100 - CAST(({high} * positive_score) % 100 < 0 AS INT)")
    windows = best.select("block", F.struct("win", least.cast("long").alias("low"), most.cast("long").alias("high")).alias("w"))
    windows = windows.where("w.low <= w.high").groupBy("block").agg(F.collect_list("w").alias("windows"))
    whole = pages.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    cells = _cells(blocks.join(windows, "block"), whole.join(windows.select("block"), "block", "left_semi"), parts)
    found = materialize(cells.mapInArrow(_search(fields, width, kind, negatives, False, positives), _FOUND), "negatives")
    result = _ranked(found, negatives).join(best, ["block", "win"])
    return result.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
