"""Removal of long passages that a document with a smaller id has too.

Minimizer runs stand for the compaction of a De Bruijn graph; no graph is built. Every run of
``length`` words is a window. Each window belongs to one node, its minimizer: the smallest hash of
its runs of ``NODE_WORDS`` words, which depends on its words alone. Consecutive windows of a
document at one node make a path, stored as one row with the digest of its words.

1. Paths with the same words are put together; the smallest document that has them is their source.
   All windows of a path are repeated if its source is a smaller document.
2. Nodes with one path do not branch and are done. At branching nodes the windows of each path's
   source are compared one by one, by the digest of their words, to find partly repeated paths.
3. Repeated windows become spans of words, which are cut out of the texts.

A path and its source coordinates stand for all its windows, so about one row for 20 words is
shuffled. Words are compared by 128-bit BLAKE2b digests of the words themselves, so equal
digests at the source coordinates verify a repeated span. Windows are judged on the input, not on
what is left.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ferryline.llm.words import SPACED, Words, complete, hash_words, joined, pack, returning, slices, text_batches, unpack, windows
from ferryline.runtime import materialize

NODE_WORDS = 8


class Normal:
    """The words of some texts with one blank between them, to take digests of runs of words."""

    def __init__(self, words: Words):
        inside = np.zeros(len(words.data) + 1, np.int8)
        np.add.at(inside, words.starts, 1)
        np.subtract.at(inside, words.ends, 1)
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        taken = inside.copy()
        taken[words.ends[words.ends < len(taken)]] = True
        self.data = np.where(inside, words.data, 0x20).astype(np.uint8)[taken].tobytes()
        place = np.concatenate([[0], np.cumsum(taken)])
        self.starts, self.ends = place[words.starts], place[words.ends]

    def digest(self, word: int, count: int) -> bytes:
        return hashlib.blake2b(self.data[self.starts[word] : self.ends[word + count - 1]], digest_size=16).digest()


def window_nodes(words: Words, length: int) -> np.ndarray:
    """The node of every window, over text borders too."""
    least, width = windows(words.hashes, min(NODE_WORDS, length)), length - min(NODE_WORDS, length) + 1
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        if len(least) <= step:
            return least[:0]
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least


def runs(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and node of every path."""
    node, whole = window_nodes(words, length), complete(words, length)
    if not whole.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (words.text[1 : len(node)] != words.text[: len(node) - 1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    stop = np.flatnonzero(np.append(new | ~whole, True))
    return first, stop[np.searchsorted(stop, first, "right")] - first, node[first]


def _paths(frame: DataFrame, length: int) -> DataFrame:
    """One row for each path of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch, "t"):
                words = hash_words(data, bounds, SPACED)
                first, count, node = runs(words, length)
                normal, of = Normal(words), words.text[first] if len(first) else first
                versions = np.array([zlib.crc32(data[a:b]) for a, b in zip(bounds, bounds[1:])], np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node.view(np.int64)),
                        pa.array([normal.digest(w, n + length - 1) for w, n in zip(first.tolist(), count.tolist())], pa.binary()),
                        part.column(0).take(pa.array(of)),
                        pa.array(versions[of], pa.int32()),
                        pa.array((first - words.first[of]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    names=["node", "digest", "d", "v", "pos", "n"],
                )

    return frame.mapInArrow(returning(run), "node long, digest binary, d long, v int, pos int, n int")


def _windows(texts: DataFrame, length: int) -> DataFrame:
    """Digests of the windows of given paths; equal neighbours are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for at, to, data, bounds in joined(unpack([r["packed"] for r in rows])):
                words = hash_words(data, bounds, SPACED)
                normal, values = Normal(words), windows(words.hashes, length)
                out: list[tuple] = []
                for t, row in enumerate(rows[at:to]):
                    version = int(np.uint32(zlib.crc32(data[bounds[t] : bounds[t + 1]])).view(np.int32))
                    for path in row["paths"]:
                        if path["v"] != version:
                            continue
                        start = int(words.first[t]) + path["pos"]
                        value = values[start : start + path["n"]]
                        cut = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
                        for offset, count in zip(cut.tolist(), np.diff(np.append(cut, len(value))).tolist()):
                            out.append((normal.digest(start + offset, length), row["d"], version, path["pos"] + offset, count))
                columns = list(zip(*out)) or [()] * 5
                types = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["digest", "d", "v", "pos", "n"])

    return texts.mapInArrow(returning(run), "digest binary, d long, v int, pos int, n int")


def repeated_spans(docs: DataFrame, key: str, text: str, length: int = 50) -> DataFrame:
    """Repeated runs of windows: ``d``, ``v`` (CRC-32 of the text), ``pos``, ``n`` and the source ``src_d``, ``src_pos``.

    Windows ``pos`` to ``pos + n - 1`` of document ``d`` are also in the smaller document ``src_d``,
    those of whole paths from window ``src_pos`` on. Rows with a NULL key take no part.
    """
    text_batches(docs)
    frame = docs.select(F.col(key).cast("long").alias("d"), F.col(text).cast("string").alias("t")).where("d IS NOT NULL AND t IS NOT NULL")
    occurrences = materialize(_paths(frame, length), "paths")
    source = F.min(F.struct("d", "pos")).alias("source")
    paths = materialize(occurrences.groupBy("digest").agg(F.first("node").alias("node"), source, F.max("d").alias("last")), "path-sources")
    branching = paths.groupBy("node").agg(F.count("*").alias("c")).where("c > 1").select("node")
    branching = materialize(branching, "branching")
    needed = paths.join(branching, "node", "left_semi").select("digest", "source", F.lit(True).alias("branches"))
    needed = needed.unionByName(
        paths.where("last > source.d").join(branching, "node", "left_anti").select("digest", "source", F.lit(False).alias("branches"))
    )
    found = materialize(occurrences.join(materialize(needed, "sources"), "digest"), "found")
    whole = found.where("source.d < d").select("d", "v", "pos", "n", F.col("source.d").alias("src_d"), F.col("source.pos").alias("src_pos"))
    rest = found.where("source.d = d AND branches").groupBy("d").agg(F.collect_list(F.struct("v", "pos", "n")).alias("paths"))
    texts = pack(frame, "t", ["d"]).join(rest, "d").select("d", "packed", "paths")
    singles = materialize(_windows(texts, length), "windows")
    firsts = singles.groupBy("digest").agg(F.min(F.struct("d", "pos")).alias("source"), F.max("d").alias("last"))
    firsts = materialize(firsts.where("last > source.d").select("digest", "source"), "window-sources")
    part = singles.join(firsts, "digest").where("source.d < d")
    return whole.unionByName(part.select("d", "v", "pos", "n", F.col("source.d").alias("src_d"), F.col("source.pos").alias("src_pos")))


def remove_repeats(docs: DataFrame, key: str, text: str, keep: list[str], length: int = 50, spacing: bool = False) -> DataFrame:
    """The columns ``keep`` with ``n_words``, ``n_removed``, ``kept`` (left words, one blank between) and ``spans``.

    With ``spacing`` the left parts keep their own white space, and an uncut text stays as it is.
    ``spans`` lists removed words as from, to, from, to, ... in order. One row for each input row.
    NULL has no words. A NULL key is neither source nor cut. Rows that repeat a key are one document
    if their texts are equal and never each other's source otherwise.
    """
    spans = repeated_spans(docs, key, text, length).groupBy("d").agg(F.collect_set(F.struct("v", "pos", "n")).alias("spans"))
    inner = docs.select(F.struct(*keep).alias("kept_columns"), F.col(key).cast("long").alias("d"), F.col(text).alias("t"))
    frame = pack(inner, "t", ["d", "kept_columns"]).join(spans, "d", "left").select("kept_columns", "packed", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(2).to_pylist()
            for at, to, data, bounds in joined(unpack(batch.column(1).to_pylist())):
                words = hash_words(data, bounds, SPACED)
                normal = Normal(words)
                totals, removed, kept, cut = [], [], [], []
                for t in range(to - at):
                    low, high = int(words.first[t]), int(words.first[t + 1])
                    change = np.zeros(high - low + 1, np.int32)
                    if found[at + t]:
                        version = int(np.uint32(zlib.crc32(data[bounds[t] : bounds[t + 1]])).view(np.int32))
                        own = np.array([(s["pos"], s["n"]) for s in found[at + t] if s["v"] == version], np.int64).reshape(-1, 2)
                        np.add.at(change, own[:, 0], 1)
                        np.subtract.at(change, own[:, 0] + own[:, 1] + length - 1, 1)
                    gone = np.cumsum(change) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[:-1], [False]]).astype(np.int8)))
                    stay = np.concatenate([[0], edges, [high - low]]).reshape(-1, 2)
                    stay = [(low + a, low + b) for a, b in stay.tolist() if b > a]
                    if spacing and not len(edges):
                        pieces = [data[bounds[t] : bounds[t + 1]].tobytes()]
                    elif spacing:
                        pieces = [data[words.starts[a] : words.ends[b - 1]].tobytes() for a, b in stay]
                    else:
                        pieces = [normal.data[normal.starts[a] : normal.ends[b - 1]] for a, b in stay]
                    totals.append(high - low)
                    removed.append(int(gone.sum()))
                    kept.append(b" ".join(pieces).decode())
                    cut.append(edges.astype(np.int32))
                arrays = [pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(cut, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), *arrays], names=["kept_columns", "n_words", "n_removed", "kept", "spans"])

    added = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType()), StructField("spans", ArrayType(IntegerType()))]
    return frame.mapInArrow(returning(run), StructType([frame.schema[0], *added])).select("kept_columns.*", "n_words", "n_removed", "kept", "spans")
