"""Benchmark passages in documents: a prefix-filtered set join of word windows.

A benchmark item has windows of ``length`` consecutive words; a shorter item is one window. Each
window is a set of shingles (runs of ``SHINGLE`` words, or of the whole window if that is shorter).

1. Shingles are ordered by rarity, their number of places in all documents.
2. A document contains a window only if it contains all its shingles, so a prefix of one shingle,
   the rarest, is enough to find it. Documents are joined with these prefix shingles.
3. A match fixes the window's place. The place must lie within the document (positional and length
   bound).
4. There the words must equal those of the window, one by one.

Tasks cut the benchmark into a table of distinct windows and another of their shingles. One pass over
the documents counts the places. The windows with their prefixes are taken in blocks of at most
``BLOCK_WINDOWS``, whose size bounds what is broadcast; documents pass through all blocks without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ferryline.llm.words import ALNUM, LOWER, Words, complete, hash_words, returning, slices, text_batches, windows
from ferryline.runtime import materialize

SHINGLE = 3
BLOCK_WINDOWS = 50_000
#: Windows of an item in a batch.
ROWS = 5_000
_FILTER_BITS = 22


def words_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    return hash_words(LOWER[data], bounds, ALNUM)


def spelled(words: Words, start: int, count: int) -> bytes:
    return b" ".join([words.data[a:b].tobytes() for a, b in zip(words.starts[start : start + count], words.ends[start : start + count])])


def distinct_windows(items: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """Table of the benchmark's distinct windows: ``id``, ``spelling``, ``length``, ``hash`` and ``items``, their sorted ids.

    Items without id have windows too, but are in no list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch, "t"):
                words = words_of(data, bounds)
                for item, a, b in zip(part.column(0).to_pylist(), words.first.tolist(), words.first[1:].tolist()):
                    size = min(length, b - a)
                    hashes = windows(words.hashes[a:b], size).view(np.int64) if size else ()
                    for low in range(0, len(hashes), ROWS):
                        own = hashes[low : low + ROWS]
                        texts = [spelled(words, a + low + n, size).decode() for n in range(len(own))]
                        yield pa.RecordBatch.from_pydict({"i": pa.array([item] * len(own), pa.string()), "spelling": texts, "length": pa.array([size] * len(own), pa.int32()), "hash": own})

    frame = items.select(F.col(key).cast("string").alias("i"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL")
    found = frame.mapInArrow(returning(run), "i string, spelling string, length int, hash long")
    whole = found.groupBy("spelling", "length", "hash").agg(F.array_sort(F.collect_set("i")).alias("items"))
    return materialize(whole.withColumn("id", F.monotonically_increasing_id()), "windows")


def shingles(distinct: DataFrame) -> DataFrame:
    """Each shingle of each window: ``id``, ``size``, ``s`` and its ``offset`` in the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch, "spelling"):
                words = words_of(data, bounds)
                for n, a, b in zip(part.column(0).to_pylist(), words.first.tolist(), words.first[1:].tolist()):
                    size = min(SHINGLE, b - a)
                    own = windows(words.hashes[a:b], size).view(np.int64)
                    arrays = [np.full(len(own), n), np.full(len(own), size, np.int32), own, np.arange(len(own), dtype=np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["id", "size", "s", "offset"])

    return distinct.select("id", "spelling").mapInArrow(returning(run), "id long, size int, s long, offset int")


def _bits(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def rarity(docs: DataFrame, text: str, rows: DataFrame) -> DataFrame:
    """``size``, ``s`` and ``n``, the places in all documents, of shingles; among them all of ``rows`` that occur.

    A bit table of ``rows`` leaves most others out. One pass over the documents.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes, values = np.array(batch.column(0)), np.array(batch.column(1)).view(np.uint64)
            for size in np.unique(sizes).tolist():
                tables.setdefault(size, np.zeros(1 << _FILTER_BITS, bool))[_bits(values[sizes == size])] = True
        for size, table in tables.items():
            yield pa.RecordBatch.from_pydict({"size": pa.array([size], pa.int32()), "bits": [zlib.compress(np.packbits(table).tobytes(), 1)]})

    tables: dict[int, np.ndarray] = {}
    for row in rows.select("size", "s").mapInArrow(returning(mark), "size int, bits binary").toLocalIterator():
        more = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
        tables[row["size"]] = tables[row["size"]] | more if row["size"] in tables else more
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {size: np.unpackbits(table).view(bool) for size, table in shared.value.items()}
        for batch in batches:
            for _, data, bounds in slices(batch, "t"):
                words = words_of(data, bounds)
                for size, table in bits.items():
                    own = windows(words.hashes, size)
                    own, n = np.unique(own[complete(words, size) & table[_bits(own)]], return_counts=True)
                    arrays = [np.full(len(own), size, np.int32), own.view(np.int64), n.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["size", "s", "n"])

    counted = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(returning(count), "size int, s long, n long")
    return counted.groupBy("size", "s").agg(F.sum("n").alias("n"))


def prefixes(distinct: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The windows with ``size``, ``shingle`` and ``offset`` of their rarest shingle.

    Windows with a shingle that no document has are left out: no document can contain them.
    """
    rows = materialize(shingles(distinct), "shingles")
    ranked = rows.join(rarity(docs, text, rows), ["size", "s"], "left").groupBy("id", "size")
    rarest = ranked.agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "s", "offset")).alias("p")).where("p.n > 0")
    found = distinct.join(rarest, "id").select("spelling", "length", "hash", "items", "size", F.col("p.s").alias("shingle"), "p.offset")
    return materialize(found, "prefixes")


@dataclass
class Block:
    """Some windows: words, hash and items; by shingle size the prefix entries (shingle, offset in the window, window, window length)."""

    spelling: list[bytes] = field(default_factory=list)
    hashes: list[int] = field(default_factory=list)
    items: list[list[str]] = field(default_factory=list)
    entries: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)

    def add(self, row: Row) -> None:
        entry = row["shingle"] & (2**64 - 1), row["offset"], len(self.spelling), row["length"]
        self.entries.setdefault(row["size"], []).append(entry)
        self.spelling.append(row["spelling"].encode())
        self.hashes.append(row["hash"] & (2**64 - 1))
        self.items.append(row["items"])


def blocks(found: DataFrame, limit: int = BLOCK_WINDOWS) -> Iterator[Block]:
    """The table of prefixes in blocks; the driver holds one block at a time."""
    block = Block()
    for row in found.toLocalIterator():
        block.add(row)
        if len(block.spelling) >= limit:
            yield block
            block = Block()
    if block.spelling:
        yield block


class Lookup:
    """Finds the places of given shingles, with a bit table in front of the exact search."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[(self.values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def places(self, found: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``found`` and the numbers of the values there."""
        place = np.flatnonzero(self.bits[(found >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] & allowed)
        at = np.searchsorted(self.values, found[place])
        same = (at < len(self.values)) & (self.values[np.minimum(at, len(self.values) - 1)] == found[place])
        return place[same], at[same]


class Matcher:
    """The windows of a block that occur in texts."""

    def __init__(self, block: Block):
        self.spelling, self.items = block.spelling, block.items
        self.hashes = np.array(block.hashes, np.uint64)
        self.sizes = {}
        for size, rows in block.entries.items():
            rows = sorted(rows)
            shingle = np.array([r[0] for r in rows], np.uint64)
            look = Lookup(shingle)
            first = np.searchsorted(shingle, look.values)
            self.sizes[size] = look, first, np.append(first[1:], len(rows)), np.array([r[1:] for r in rows], np.int64)

    def find(self, words: Words) -> Iterator[tuple[int, int, int, int]]:
        """Text, first word, length and window of every occurrence."""
        whole: dict[int, np.ndarray] = {}
        for size, (look, first, stop, rows) in self.sizes.items():
            place, at = look.places(windows(words.hashes, size), complete(words, size))
            count = stop[at] - first[at]
            entry = np.arange(int(count.sum())) + np.repeat(first[at] - (np.cumsum(count) - count), count)
            offset, window, length = rows[entry].T
            start, text = np.repeat(place, count) - offset, words.text[np.repeat(place, count)]
            inside = (start >= words.first[text]) & (start + length <= words.first[text + 1])
            start, text, window, length = start[inside], text[inside], window[inside], length[inside]
            for n in np.unique(length).tolist():
                if n not in whole:
                    whole[n] = windows(words.hashes, n)
                own = np.flatnonzero(length == n)
                own = own[whole[n][start[own]] == self.hashes[window[own]]]
                for t, s, w in zip(text[own].tolist(), start[own].tolist(), window[own].tolist()):
                    if spelled(words, s, n) == self.spelling[w]:
                        yield t, s, n, w


def _search(frame: DataFrame, block: Block) -> DataFrame:
    shared = frame.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            for part, data, bounds in slices(batch, "t"):
                words = words_of(data, bounds)
                change = np.zeros(len(words.starts) + 1, np.int32)
                hits, items = part.column(2).to_pylist(), [set(i) for i in part.column(3).to_pylist()]
                for t, s, n, w in matcher.find(words):
                    change[s] += 1
                    change[s + n] -= 1
                    items[t].update(matcher.items[w])
                for t, old in enumerate(hits):
                    for a, b in zip(old[::2], old[1::2]):
                        change[words.first[t] + a] += 1
                        change[words.first[t] + b] -= 1
                covered = np.cumsum(change) > 0
                found = []
                for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
                    own = covered[a:b]
                    found.append(np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).astype(np.int32) if own.any() else [])
                arrays = [pa.array(np.diff(words.first)), pa.array(found, pa.list_(pa.int32())), pa.array([sorted(i) for i in items], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays, part.column(4)], names=names)

    names = frame.schema.names
    return frame.mapInArrow(returning(run), frame.schema)


def contaminated_words(docs: DataFrame, text: str, keep: list[str], items: DataFrame, item_key: str, item_text: str, length: int = 13) -> DataFrame:
    """The columns ``keep`` with ``n_words``, ``hits`` and ``items``.

    ``hits`` lists the words inside occurrences of windows as from, to, from, to, ... in order;
    ``items`` has the ids, as sorted strings, of items with an occurring window. Words are runs of
    letters, digits and characters beyond ASCII, with A to Z lower-cased. NULL has no words. Passages of
    items without id are hits too.
    """
    text_batches(docs)
    none = F.array().cast(ArrayType(IntegerType())), F.array().cast(ArrayType(StringType()))
    others = [c for c in keep if c != text]
    kept = F.struct(*others, F.lit(0).alias("_")).alias("kept_columns")
    frame = docs.select(kept, F.lit(0).cast("long").alias("n_words"), none[0].alias("hits"), none[1].alias("items"), F.col(text).cast("string").alias("t"))
    found = False
    for block in blocks(prefixes(distinct_windows(items, item_key, item_text, length), docs, text)):
        frame, found = _search(frame, block), True
    if not found:
        frame = _search(frame, Block())
    back = [F.col("t").alias(c) if c == text else F.col("kept_columns").getField(c).alias(c) for c in keep]
    return frame.select(*back, "n_words", "hits", "items")


def figures() -> list[Column]:
    """The columns that judge a document, from ``n_words``, ``hits`` and ``items``."""
    hit = F.expr("aggregate(sequence(0, size(hits) div 2 - 1, 1), 0L, (s, i) -> s + hits[2 * i + 1] - hits[2 * i])")
    n_hit = F.when(F.size("hits") > 0, hit).otherwise(F.lit(0).cast("long"))
    return [
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    ]
