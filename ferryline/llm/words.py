"""Words of many texts at once: boundaries and 64-bit hashes, in numpy over Arrow buffers.

A word is a longest run of bytes that are not separators in the UTF-8 form of a text. All
separators here are ASCII, so words never split a character. Work goes through slices of
about ``SLICE_BYTES`` of text; only a single longer text makes a larger slice.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, StructField, StructType

SLICE_BYTES = 1 << 19

_RANDOM = np.random.Generator(np.random.Philox(20240607))
_BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _separators(codes) -> np.ndarray:
    keep = np.ones(256, bool)
    keep[list(codes)] = False
    return keep


#: Words separated by blank, tab, line feed, vertical tab, form feed and carriage return.
SPACED = _separators([0x20, *range(0x09, 0x0E)])
#: Words of letters, digits and all characters beyond ASCII.
ALNUM = _separators([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def powers(base: int, count: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for ``i`` below ``count``."""
    known = _POWERS.get(base)
    if known is None or len(known) < count:
        size = max(1 << 20, count)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 1 << 22:
            _POWERS[base] = known
    return known[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of some texts: ``text[i]`` is the text of word ``i``, ``first[t]`` the first word of text ``t``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray
    hashes: np.ndarray


def hash_words(data: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> Words:
    """``bounds`` holds the offsets of the texts in ``data``, one more than there are texts."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = keep[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    edges = bounds[(bounds > 0) & (bounds < n)]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside[1:-1] & ~before)
    ends = np.flatnonzero(inside[1:-1] & ~after) + 1
    first = np.searchsorted(starts, bounds)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(_BASE, n), out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(_BASE_INVERSE, n + 1)[starts]
    return Words(data, starts, ends, text, first, mix(value + (ends - starts).astype(np.uint64)))


def slices(batch: pa.RecordBatch, column: str | int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with the UTF-8 bytes of ``column`` and the offsets of its texts. NULL is empty."""
    texts = batch.column(column).cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield batch.slice(at, to - at), data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def windows(hashes: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """Hash of every run of ``size`` word hashes, over text borders too; mask those with ``complete``."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(base, n), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(pow(base, -1, 1 << 64), n)[: n - size + 1])


def complete(words: Words, size: int) -> np.ndarray:
    """Which runs of ``size`` words lie within one text."""
    if len(words.text) < size:
        return np.zeros(0, bool)
    return words.text[size - 1 :] == words.text[: len(words.text) - size + 1]


def text_batches(docs: DataFrame, rows: int = 1000) -> None:
    """Make the session's Arrow batches small enough for whole texts, unless a batch size was chosen for it.

    The default of 10,000 rows would put tens of megabytes of text into every batch, several times
    over in each Python worker and its executor.
    """
    conf = docs.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def returning(run):
    """The same map function; at the end of a task it gives freed memory back.

    Python workers serve one stage after another, and what one stage has freed would stay with the
    worker while the next stage fills other memory.
    """

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def per_text(docs: DataFrame, text: str, keep: list[str], added: list[StructField], make) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``added`` ones computed from the column ``text``.

    ``make()`` runs once in each task and returns a function from a list of texts (None for NULL)
    to one list for each added column. The batches pass through in Arrow form, so the kept columns
    stay as they are.
    """
    text_batches(docs)
    own = [F.col(c) for c in keep]
    frame = docs.select(*own, *([] if text in keep else [F.col(text).cast("string").alias("_text")]))
    names, place = [f.name for f in added], keep.index(text) if text in keep else len(keep)
    kept = frame.schema.fields[: len(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part, _, _ in slices(batch, place):
                columns = work(part.column(place).to_pylist())
                arrays = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *arrays], names=[*part.schema.names[: len(kept)], *names])

    types = [to_arrow_type(f.dataType) for f in added]
    return frame.mapInArrow(returning(run), StructType([*kept, *added]))


def pack(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``packed``, the compressed text, so that a shuffle of texts stays small. NULL stays NULL."""
    import zstandard

    text_batches(docs)
    frame = docs.select(*keep, F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part, _, _ in slices(batch, "_text"):
                texts = part.column(len(part.schema) - 1).cast(pa.binary()).to_pylist()
                packed = [None if t is None else work.compress(t) for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(packed, pa.binary())], names=[*part.schema.names[:-1], "packed"])

    return frame.mapInArrow(returning(run), StructType([*frame.schema.fields[:-1], StructField("packed", BinaryType())]))


def unpack(packed: list[bytes | None]) -> list[bytes]:
    """Texts in UTF-8; NULL is empty."""
    import zstandard

    work = zstandard.ZstdDecompressor()
    return [b"" if p is None else work.decompress(p) for p in packed]


def joined(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a list of texts: first and last index, their bytes and offsets."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= SLICE_BYTES):
            size += len(texts[to])
            to += 1
        data = np.frombuffer(b"".join(texts[at:to]), np.uint8)
        yield at, to, data, np.concatenate([[0], np.cumsum([len(t) for t in texts[at:to]])]).astype(np.int64)
        at = to
