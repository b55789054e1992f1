"""Similarity join of documents on their word n-grams, by MinHash banding.

1. Tasks compute each document's set of n-grams, a digest of the set, and band hashes of its MinHash
   signature. The numbers of bands and rows are chosen for a recall at the threshold. Documents
   with the same set are one class; one of them stands for it.
2. Classes are shuffled on their band hashes. A bucket of more than ``BLOCK`` classes is cut
   into blocks, and each pair of blocks is a cell of its own, so no task holds a whole bucket.
3. Inside a cell a pair counts in the first band that both share, so it is compared once.
4. Members with pairs get their texts, and pairs are verified on the full n-gram sets. A cell
   returns for each member its number of links and the smallest member it is linked to, directly or
   not; pairs are never rows.
5. Links join into classes of near copies.

N-grams are runs of five words, words being lower-cased runs of letters, digits and characters
beyond ASCII. A text of one to four words has one n-gram, all its words.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.components import connected_components
from ferryline.llm.contamination import words_of
from ferryline.llm.words import Words, complete, joined, mix, pack, returning, slices, text_batches, unpack, windows
from ferryline.runtime import materialize

NGRAM = 5
#: Classes of a bucket in one block.
BLOCK = 512
#: Sets whose keys may be broadcast, at 24 bytes each.
FEW = 1_000_000
#: Rows of pairs compared at a time.
_STRIPE = 64


def choose_bands(threshold: float, recall: float = 0.9995, most: int = 128) -> tuple[int, int]:
    """Bands and rows: as many rows as give the recall at the threshold within ``most`` hash functions."""
    best = None
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError("no banding gives this recall; allow more hash functions")
    return best


def ngram_sets(words: Words, size: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """N-gram hashes of all texts in order, and the offsets of the texts in them. Repeats stay."""
    whole, values = complete(words, size), windows(words.hashes, size)
    counts = np.diff(words.first)
    found = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(found)])
    out = np.zeros(offsets[-1], np.uint64)
    long = np.repeat(counts >= size, found)
    out[long] = values[whole]
    for t in np.flatnonzero((counts > 0) & (counts < size)):
        out[offsets[t]] = windows(words.hashes[words.first[t] : words.first[t + 1]], int(counts[t]))[0]
    return out, offsets


def band_hashes(values: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of sets given one after the other, none of them empty: sets by bands."""
    random = np.random.Generator(np.random.Philox(7))
    factors = random.integers(1 << 62, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    out = np.zeros((len(starts), bands), np.uint64)
    for n, (factor, shift) in enumerate(zip(factors, shifts)):
        least = np.minimum.reduceat(values * factor + shift, starts)
        band = n // rows
        out[:, band] = mix(out[:, band] ^ least ^ np.uint64(band + 1))
    return out


def _signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch, "t"):
                values, offsets = ngram_sets(words_of(data, bounds))
                some = np.flatnonzero(np.diff(offsets))
                digests: list[bytes | None] = [None] * (len(bounds) - 1)
                for t in some:
                    digests[t] = hashlib.blake2b(np.unique(values[offsets[t] : offsets[t + 1]]).tobytes(), digest_size=16).digest()
                hashes: list[np.ndarray | None] = [None] * len(digests)
                if len(some):
                    for t, row in zip(some, band_hashes(values, offsets[some], bands, rows).view(np.int64)):
                        hashes[t] = row
                arrays = [part.column(0), part.column(1), pa.array(digests, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["d", "th", "digest", "bands"])

    return docs.mapInArrow(returning(run), "d long, th long, digest binary, bands array<long>")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Whole cells from sorted rows: tables with the ranges of their cells."""
    rest: pa.Table | None = None

    def ranges(table: pa.Table) -> list[int]:
        keys = [table.column(n).to_numpy() for n in ("key", "ci", "cj")]
        new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        return [0, *(np.flatnonzero(new) + 1).tolist(), len(table)]

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not len(table):
            continue
        edges = ranges(table)
        if len(edges) > 2:
            yield table.slice(0, edges[-2]), list(zip(edges[:-2], edges[1:-1]))
        rest = table.slice(edges[-2])
    if rest is not None and len(rest):
        edges = ranges(rest)
        yield rest, list(zip(edges, edges[1:]))


def _matrix(table: pa.Table, low: int, high: int) -> np.ndarray:
    lists = table.column("bands").slice(low, high - low).combine_chunks()
    return np.asarray(lists.flatten()).reshape(high - low, -1)


def own_pairs(key: int, bands: np.ndarray, ids: np.ndarray, blocks: np.ndarray, across: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a cell whose first common band is the cell's, in stripes; ``across``: of different blocks only."""
    band = np.flatnonzero((bands == key).all(axis=0))
    if not len(band):
        return
    before = bands[:, : band[0]]
    for low in range(0, len(ids), _STRIPE):
        some = before[low : low + _STRIPE]
        new = ~(some[:, None, :] == before[None]).any(axis=2)
        new &= ids[low : low + _STRIPE, None] < ids[None]
        if across:
            new &= blocks[low : low + _STRIPE, None] != blocks[None]
        left, right = np.nonzero(new)
        if len(left):
            yield left + low, right


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of cells that have a pair there."""
    for table, cells in _cells(batches):
        keep = np.zeros(len(table), bool)
        keys, ci, cj, blocks, ids = (table.column(n).to_numpy() for n in ("key", "ci", "cj", "block", "cls"))
        bands = _matrix(table, 0, len(table))
        for low, high in cells:
            for left, right in own_pairs(keys[low], bands[low:high], ids[low:high], blocks[low:high], ci[low] != cj[low]):
                keep[low + left] = keep[low + right] = True
        yield from table.filter(pa.array(keep)).combine_chunks().to_batches()


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of intersections of pairs of sets."""
    if len(left) < 2 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left.tolist(), right.tolist())])
    rows, columns = np.unique(left), np.unique(right)
    used = np.union1d(rows, columns)
    owner = np.repeat(np.arange(len(used)), [len(sets[n]) for n in used])
    values, at = np.unique(np.concatenate([sets[n] for n in used]), return_inverse=True)
    common = np.zeros((len(rows), len(columns)), np.float32)
    r, c = np.searchsorted(used, rows), np.searchsorted(used, columns)
    for low in range(0, len(values), 8192):
        own = (at >= low) & (at < low + 8192)
        incidence = np.zeros((len(used), min(8192, len(values) - low)), np.float32)
        incidence[owner[own], at[own] - low] = 1
        common += incidence[r] @ incidence[c].T
    return common[np.searchsorted(rows, left), np.searchsorted(columns, right)].astype(np.int64)


def _links(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cells in _cells(batches):
            keys, ci, cj, blocks, ids = (table.column(n).to_numpy() for n in ("key", "ci", "cj", "block", "cls"))
            out: list[tuple[int, int, int]] = []
            for low, high in cells:
                texts, sets = unpack(table.column("packed").slice(low, high - low).to_pylist()), []
                for _, _, data, bounds in joined(texts):
                    values, offsets = ngram_sets(words_of(data, bounds))
                    sets += [np.unique(values[a:b]) for a, b in zip(offsets, offsets[1:])]
                sizes = np.array([len(s) for s in sets])
                count, root = np.zeros(high - low, np.int64), np.arange(high - low)

                def top(n: int) -> int:
                    while root[n] != n:
                        root[n] = root[root[n]]
                        n = root[n]
                    return n

                for left, right in own_pairs(keys[low], _matrix(table, low, high), ids[low:high], blocks[low:high], ci[low] != cj[low]):
                    small, large = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
                    near = small >= threshold * large
                    left, right = left[near], right[near]
                    if not len(left):
                        continue
                    common = _common(sets, left, right)
                    linked = common >= threshold * (sizes[left] + sizes[right] - common)
                    left, right = left[linked], right[linked]
                    np.add.at(count, left, 1)
                    np.add.at(count, right, 1)
                    for a, b in zip(left.tolist(), right.tolist()):
                        if root[a] != root[b]:
                            a, b = top(a), top(b)
                            root[max(a, b)] = min(a, b)
                best: dict[int, int] = {}
                linked = np.flatnonzero(count).tolist()
                for n in linked:
                    best[top(n)] = min(best.get(top(n), int(ids[low + n])), int(ids[low + n]))
                out += [(int(ids[low + n]), int(count[n]), best[top(n)]) for n in linked]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cls", "n", "root"])

    return run


def near_copies(docs: DataFrame, key: str, text: str, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """``key``, ``rep``, ``class_id`` and ``n_links``, one row for each input row.

    ``rep`` is the smallest key with the same set of n-grams, ``class_id`` the smallest key that is
    reached through links, ``n_links`` the number of other sets with a Jaccard similarity of at least
    ``threshold``. Texts without words, NULL ones too, are alone. A NULL key gives NULL classes and no
    links. Rows that repeat a key have the figures of their own texts; equal ones have equal figures. Other columns do not matter.
    """
    text_batches(docs)
    bands, rows = choose_bands(threshold, recall)
    frame = docs.select(F.col(key).cast("long").alias("d"), F.xxhash64(F.col(text).cast("string")).alias("th"), F.col(text).cast("string").alias("t"))
    signed = materialize(_signatures(frame, bands, rows), "signatures")
    ready = signed.where("digest IS NOT NULL AND d IS NOT NULL")
    # One row for each set: a number of its own, and a text that has it, as key and hash.
    reps = ready.groupBy("digest").agg(F.min(F.struct("d", "th", "bands")).alias("r"))
    reps = materialize(reps.select(F.monotonically_increasing_id().alias("cls"), "digest", F.col("r.d").alias("rep"), "r.th", "r.bands"), "reps")
    members = reps.select("cls", F.explode("bands").alias("key"))
    sizes = materialize(members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    placed = members.join(sizes, "key").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("cls"), "blocks").cast("int"))
    other = F.when(F.col("blocks") > 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))
    placed = placed.join(reps.select("cls", "bands"), "cls").withColumn("other", F.explode(other))
    placed = placed.select("key", F.least("block", "other").alias("ci"), F.greatest("block", "other").alias("cj"), "block", "cls", "bands")
    cell = ["key", "ci", "cj"]
    schema = placed.schema
    paired = materialize(placed.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(returning(_members), schema), "cells")
    needed = materialize(reps.select("cls", "rep", "th").join(paired.select("cls").distinct(), "cls", "left_semi"), "needed")
    # Few needed texts are picked where they are read; only then are no other texts shuffled.
    picked = F.broadcast(needed) if needed.count() <= FEW else needed
    texts = pack(frame.where("d IS NOT NULL"), "t", ["d", "th"]).withColumnRenamed("d", "rep").join(picked, ["rep", "th"])
    texts = texts.groupBy("cls").agg(F.first("packed").alias("packed"))
    with_text = paired.join(texts, "cls").select(*cell, "block", "cls", "bands", "packed")
    links = with_text.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(returning(_links(threshold)), "cls long, n long, root long")
    links = materialize(links, "links")
    parts = connected_components(links.select(F.col("cls").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("cls").agg(F.sum("n").alias("n_links"))
    # Components have the smallest number as their name; classes have the smallest key.
    named = reps.select("cls", "digest", "rep").join(parts.select(F.col("u").alias("cls"), "m"), "cls", "left").withColumn("m", F.coalesce("m", "cls"))
    named = materialize(named.join(counts, "cls", "left"), "named")
    least = named.groupBy("m").agg(F.min("rep").alias("class"))
    known = materialize(named.join(least, "m").select("digest", "rep", "class", "n_links"), "classes")
    return signed.select("d", F.when(F.col("d").isNotNull(), F.col("digest")).alias("digest")).join(known, "digest", "left").select(
        F.col("d").alias(key),
        F.coalesce("rep", "d").alias("rep"),
        F.coalesce("class", "d").alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
