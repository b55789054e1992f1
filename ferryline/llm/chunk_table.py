"""Token ids of whole texts through a table of distinct words.

1. Tasks cut texts into words where no token can lie across the cut, and form blocks of texts. A
   block has a dictionary of its distinct words. The words belong to shares by their hash, and a block's
   dictionary is shuffled as one packed row for each share. There are as many shares as
   ``SHARE_BYTES`` of text, so a share stays small at any size of the input.
2. A share of all dictionaries is one part of the table of distinct words: each word of it is encoded
   once, and the ids go back to the blocks, again as one packed row for each block and share.
3. Meanwhile every text is kept as the numbers of its words in its block's dictionary. Ids join the
   blocks and go to their positions through these numbers.
4. Ids become pieces through a map-side join with the tokenizer's id-to-piece table, whose size is
   that of the vocabulary.

Only dictionaries are shuffled there and back, and word numbers once; never each word of a text. A block
holds about ``block_bytes`` of text, or one longer text. It is named by a digest of its keys and dictionary,
so a lost executor's blocks are found again when their rows are read again; were they other rows,
the job would stop and not mix up words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.words import returning, slices, text_batches

#: Bytes of text in a block, as far as whole texts allow. Larger blocks cost less time, smaller ones less memory.
BLOCK_BYTES = 4 << 20
#: Texts in a block, about; it matters where they are empty or very short.
BLOCK_ROWS = 100_000
#: Bytes of text for each share of the word table, so that a share's table of words fits in a task.
SHARE_BYTES = 8 << 20
#: Words given to a tokenizer at once, as what it returns for a word is much larger than its ids.
WORDS = 10_000


@dataclass(frozen=True)
class Coding:
    """A tokenizer as seen by the table; tasks get it by pickle and load what they need by its path.

    ``chunks`` cuts a text at white space, ``parts`` a chunk into words; both cut only where tokens end anyway. No word
    holds a blank. ``encode`` gives the ids of each of many words, ``pieces`` what each id stands for, and ``join`` the
    text that the pieces of all ids make. Blocks have about ``block_bytes`` of text. ``split``, if given, does the work of
    ``chunks`` for lists of texts at once: their different chunks, and for each text the places of its chunks among these.
    """

    path: str
    chunks: Callable[[str, str | None], list[str]]
    parts: Callable[[str, str], tuple[str, ...]]
    encode: Callable[[str, list[str]], list[list[int]]]
    pieces: Callable[[str], dict[int, str | bytes]]
    join: Callable[[list], str]
    block_bytes: int = BLOCK_BYTES
    split: Callable[[str, Iterable[list[str | None]]], tuple[list[str], list[np.ndarray]]] | None = None


class Ragged:
    """Lists of different lengths in one array."""

    def __init__(self, counts: np.ndarray, flat: np.ndarray):
        self.counts, self.flat = counts, flat
        self.starts = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else counts

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists at ``places`` one after the other, and their lengths."""
        n = self.counts[places]
        before = np.cumsum(n) - n
        return self.flat[np.arange(int(n.sum())) + np.repeat(self.starts[places] - before, n)], n


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, compressed with bytes of the same weight side by side."""
    import zstandard

    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack_numbers(packed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _dictionary(coding: Coding, keys: list[int | None], words: Iterable[str], shares: int) -> tuple[bytes, list[str], np.ndarray]:
    """A digest of keys and words, the words in order of share, and their shares.

    Within a share words are in order of spelling, or as they come from ``split``, which is the same in each reading.
    """
    ordered = list(words) if coding.split else sorted(words)
    share = np.array([zlib.crc32(w.encode()) % shares for w in ordered], np.int64)
    order = np.argsort(share, kind="stable")
    ordered = [ordered[n] for n in order.tolist()]
    name = hashlib.blake2b(str(keys).encode(), digest_size=16)
    name.update("\n".join(ordered).encode())
    return name.digest(), ordered, share[order]


def _text_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    """Parts of batches, together about as large as a block."""
    held, size, rows = [], 0, 0
    for batch in batches:
        for part, data, _ in slices(batch, "t"):
            held.append(part)
            size, rows = size + len(data), rows + len(part)
            if size >= block_bytes or rows >= BLOCK_ROWS:
                yield held
                held, size, rows = [], 0, 0
    if held:
        yield held


def _keys(block: list[pa.RecordBatch]) -> list[int | None]:
    return [key for part in block for key in part.column(0).to_pylist()]


def _texts(block: list[pa.RecordBatch]) -> Iterator[list[str | None]]:
    for part in block:
        yield part.column(1).to_pylist()


def _different(coding: Coding, block: list[pa.RecordBatch]) -> Iterable[str]:
    """The different chunks of a block's texts."""
    if coding.split:
        return coding.split(coding.path, _texts(block))[0]
    chunks: set[str] = set()
    for texts in _texts(block):
        for text in texts:
            chunks.update(coding.chunks(coding.path, text))
    chunks.discard("")
    return chunks


def _places(coding: Coding, block: list[pa.RecordBatch]) -> tuple[list[str], list[np.ndarray]]:
    """Chunks of a block's texts, and the places of each text's chunks among them."""
    if coding.split:
        return coding.split(coding.path, _texts(block))
    chunks: dict[str, int] = {}
    places = [np.array([chunks.setdefault(w, len(chunks)) for w in coding.chunks(coding.path, t) if w], np.int64) for ts in _texts(block) for t in ts]
    return list(chunks), places


def _dictionaries(coding: Coding, shares: int):
    """One row for each block and share with the words of it."""
    path = coding.path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        work = zstandard.ZstdCompressor(level=3)
        for block in _text_blocks(batches, coding.block_bytes):
            own = dict.fromkeys([w for chunk in _different(coding, block) for w in coding.parts(path, chunk)])
            digest, words, share = _dictionary(coding, _keys(block), own, shares)
            found, starts = np.unique(share, return_index=True)
            edges = [*starts.tolist(), len(words)]
            packed = [work.compress(" ".join(words[a:b]).encode()) for a, b in zip(edges, edges[1:])]
            columns = [pa.array([digest] * len(found), pa.binary()), pa.array(found, pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "share", "words"])

    return run


def _numbers(coding: Coding, shares: int):
    """One row for each block: its keys, and the number of words and the word numbers of each of its texts."""
    path = coding.path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _text_blocks(batches, coding.block_bytes):
            chunks, places = _places(coding, block)
            cut = [coding.parts(path, chunk) for chunk in chunks]
            keys = _keys(block)
            place: defaultdict[str, int] = defaultdict(count().__next__)
            flat = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), np.int64)
            digest, words, _ = _dictionary(coding, keys, place, shares)
            number = np.empty(len(words), np.uint32)
            number[np.fromiter(map(place.__getitem__, words), np.int64, len(words))] = np.arange(len(words))
            numbers = Ragged(np.array([len(ws) for ws in cut], np.int64), number[flat])
            coded = [numbers.take(p)[0] for p in places]
            row = [digest, len(words), keys, pack_numbers(np.array([len(c) for c in coded])), pack_numbers(np.concatenate(coded))]
            types = [pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = ["block", "size", "rows", "counts", "numbers"]
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types)], names=names)

    return run


def encode_words(dictionaries: DataFrame, coding: Coding) -> DataFrame:
    """Rows of packed words (``block``, ``share``, ``words``) with packed ids for them.

    The rows of a share meet in one task, one share after the other, so each distinct word is encoded once and
    the task holds the words of one share.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        work = zstandard.ZstdDecompressor()
        now, table = None, {}
        for batch in batches:
            ids, counts = [], []
            for share, packed in zip(batch.column("share").to_pylist(), batch.column("words").to_pylist()):
                if share != now:
                    now, table = share, {}
                words = work.decompress(packed).decode().split(" ")
                fresh = [w for w in words if w not in table]
                for low in range(0, len(fresh), WORDS):
                    some = fresh[low : low + WORDS]
                    table.update(zip(some, [np.array(x, "<u4").tobytes() for x in coding.encode(coding.path, some)]))
                found = [table[w] for w in words]
                counts.append(pack_numbers(np.array([len(x) // 4 for x in found])))
                ids.append(pack_numbers(np.frombuffer(b"".join(found), "<u4")))
            columns = [batch.column("block"), batch.column("share"), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["of", "share", "lengths", "ids"])

    together = dictionaries.repartition("share").sortWithinPartitions("share")
    return together.mapInArrow(returning(encode), "of binary, share int, lengths binary, ids binary")


def _share_count(texts: DataFrame) -> int:
    size = texts.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARE_BYTES))


def encode_and_decode(docs: DataFrame, key: str, text: str, coding: Coding) -> DataFrame:
    """``key``, ``ids`` (array of the text's token ids) and ``decoded`` (the text that they stand for).

    One row for each input row; NULL and empty texts have no ids and decode to an empty text. The key
    may be NULL or repeated. ``docs`` is read three times and must give the same rows in the same order in each task, as files do.
    """
    text_batches(docs)
    frame = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    shares = _share_count(frame)
    words = frame.mapInArrow(returning(_dictionaries(coding, shares)), "block binary, share int, words binary")
    coded = encode_words(words, coding)
    texts = frame.mapInArrow(returning(_numbers(coding, shares)), "block binary, size int, rows array<long>, counts binary, numbers binary")
    vocabulary = sorted(coding.pieces(coding.path).items())
    pieces = docs.sparkSession.sparkContext.broadcast([p for _, p in vocabulary])
    place = docs.sparkSession.sparkContext.broadcast(np.array([n for n, _ in vocabulary]))

    def put_back(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.table([pa.array([], t) for t in types], names=["k", "ids", "decoded"])
        found_shares, first = np.unique(right.column("share").to_numpy(), return_index=True)
        found = right.take(pa.array(first))
        lengths = [unpack_numbers(x) for x in found.column("lengths").to_pylist()]
        lists = [unpack_numbers(x) for x in found.column("ids").to_pylist()]
        none = np.zeros(0, np.uint32)
        ids = Ragged(np.concatenate([none, *lengths]).astype(np.int64), np.concatenate([none, *lists]))
        piece, known = pieces.value, place.value
        keys, coded, decoded = [], [], []
        for row in left.to_pylist():
            if row["size"] != len(ids.counts):
                raise RuntimeError("the documents changed between two readings; write them to a table first")
            keys += row["rows"]
            numbers, at = unpack_numbers(row["numbers"]), 0
            for n in unpack_numbers(row["counts"]).tolist():
                own = ids.take(numbers[at : at + n])[0].astype(np.int32)
                coded.append(own)
                decoded.append(coding.join([piece[p] for p in np.searchsorted(known, own).tolist()]))
                at += n
        return pa.table([pa.array(c, t) for c, t in zip((keys, coded, decoded), types)], names=["k", "ids", "decoded"])

    types = [pa.int64(), pa.list_(pa.int32()), pa.string()]
    joined = texts.groupBy("block").cogroup(coded.groupBy("of"))
    return joined.applyInArrow(put_back, "k long, ids array<int>, decoded string").withColumnRenamed("k", key)
