"""SentencePiece encoding and decoding through a table of distinct marked words (``chunk_table``).

A text becomes one line of symbols, blanks being written as the marker and one marker put before it. If no piece has a
marker behind another character, no piece lies across the place before a run of markers: there the text is cut into marked
words. A word is cut further only between neighbours that no piece of the vocabulary holds side by side, as no merge can join
them: around line ends, before closing marks, and anywhere in long words. Each distinct word is segmented once
by the library, and its ids go back to the words' positions by join.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ferryline.llm import chunk_table

MARKER = "\u2581"
_MARKER = MARKER.encode()
#: ASCII marks that close a word.
_MARKS = "!\"#$%&()*+,-./:;=?@[]^_`{}~'"
#: Words of more characters are cut wherever the vocabulary allows it.
LONG = 24
#: Bytes of text in a block of the word table.
BLOCK_BYTES = 8 << 20
_UNKNOWN = " \u2047 "


@dataclass(frozen=True)
class Model:
    processor: object
    #: Neighbours within a piece.
    pairs: frozenset[str]
    #: Which bytes are characters that are in no longer piece.
    lone: np.ndarray
    #: Text whose last character is such a character, and the number of its ids.
    lead: str
    lead_ids: int


_MODELS: dict[str, Model] = {}


def load_model(path: str) -> Model:
    """The model of a file, loaded once in a worker. Stops if its pieces cross markers or line ends."""
    if path not in _MODELS:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [processor.id_to_piece(n) for n in range(len(processor)) if not (processor.is_byte(n) or processor.is_control(n) or processor.is_unknown(n))]
        pairs = frozenset(name[n : n + 2] for name in names for n in range(len(name) - 1))
        if any(pair[1] == MARKER != pair[0] for pair in pairs):
            raise ValueError("pieces of this model cross whitespace markers")
        held = {c for pair in pairs for c in pair}
        lone = [c for c in "\n\r\t" if c not in held]
        if "\n" not in lone:
            raise ValueError("pieces of this model cross line ends")
        probe = "Ab  \u00c5\ufb01 c "
        if processor.decode(processor.encode(probe)) != probe:
            raise ValueError("this model changes texts before it segments them")
        alone = np.zeros(256, bool)
        alone[[ord(c) for c in lone]] = True
        _MODELS[path] = Model(processor, pairs, alone, "\n", len(processor.encode("\n")))
    return _MODELS[path]


def split(path: str, groups: Iterable[list[str | None]]) -> tuple[list[str], list[np.ndarray]]:
    """Different marked words of texts, and for each text the places of its marked words among them.

    A marked word is a character that is in no longer piece, or a run of markers and what follows it. Its first bytes are
    found in all texts of a group at once, and equal words by Arrow's dictionary encoding. A word may be there twice, as
    a blank is the same as a marker.
    """
    lone = load_model(path).lone
    arrays, counts = [], [np.zeros(0, np.int64)]
    for texts in groups:
        raw = [b" " + t.encode() if t else b"" for t in texts]
        whole = b"".join(raw)
        data, ends = np.frombuffer(whole, np.uint8), np.cumsum([len(t) for t in raw], dtype=np.int64)
        mark = data == 0x20
        if _MARKER in whole:
            found = np.flatnonzero((data[:-2] == _MARKER[0]) & (data[1:-1] == _MARKER[1]) & (data[2:] == _MARKER[2]))
            mark[found] = mark[found + 1] = mark[found + 2] = True
        first = lone[data]
        first[1:] |= first[:-1].copy()
        first[1:] |= mark[1:] & ~mark[:-1]
        edges = np.concatenate([[0], ends])
        first[edges[edges < len(data)]] = True
        starts = np.append(np.flatnonzero(first), len(data))
        counts.append(np.diff(np.searchsorted(starts, edges)))
        arrays.append(pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(whole)))
    coded = pa.concat_arrays([*arrays, pa.array([], pa.large_string())]).dictionary_encode()
    places = np.split(coded.indices.to_numpy(), np.cumsum(np.concatenate(counts))[:-1])
    return [w.replace(" ", MARKER) for w in coded.dictionary.to_pylist()], places


def chunks(path: str, text: str | None) -> list[str]:
    """Marked words of a text in order."""
    words, (places,) = split(path, [[text]])
    return [words[n] for n in places.tolist()]


def parts(path: str, chunk: str) -> tuple[str, ...]:
    """A marked word, cut where no piece can lie across."""
    pairs = load_model(path).pairs
    if len(chunk) > LONG:
        cuts = [n for n in range(1, len(chunk)) if chunk[n - 1 : n + 1] not in pairs]
        return tuple(chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)]))
    body = len(chunk.rstrip(_MARKS))
    if 0 < body < len(chunk) and chunk[body - 1 : body + 1] not in pairs:
        return (chunk[:body], chunk[body:])
    return (chunk,)


def encode(path: str, words: list[str]) -> list[list[int]]:
    """Ids of words. The library puts a marker before each: the word's own one is left out, or a line end goes first and its ids go."""
    model = load_model(path)
    marked = [len(w) > 1 and w[0] == MARKER for w in words]
    found = model.processor.encode([w[1:] if own else model.lead + w for w, own in zip(words, marked)], num_threads=1)
    return [ids if own else ids[model.lead_ids :] for ids, own in zip(found, marked)]


def pieces(path: str) -> dict[int, bytes]:
    """What each id adds to a decoded text, in UTF-8."""
    processor, out = load_model(path).processor, {}
    for n in range(len(processor)):
        name = processor.id_to_piece(n)
        if processor.is_byte(n):
            out[n] = bytes([int(name[3:5], 16)])
        elif processor.is_control(n):
            out[n] = b""
        else:
            out[n] = (_UNKNOWN if processor.is_unknown(n) else name.replace(MARKER, " ")).encode()
    return out


def join(found: list[bytes]) -> str:
    """The text of all pieces, without the marker put before it. Bytes that are no character become U+FFFD."""
    whole = b"".join(found)
    return (whole[1:] if found and found[0].startswith(b" ") else whole).decode("utf-8", "replace")


def encode_and_decode(docs: DataFrame, key: str, text: str, model_path: str) -> DataFrame:
    """``key``, ``ids`` (array of the text's ids, without begin and end) and ``decoded``.

    One row for each input row; NULL and empty texts have no ids and decode to an empty text. The key may be NULL or
    repeated; other columns do not matter. The model must put a marker before a text, keep all blanks and other characters as they
    are, spell unknown characters in bytes, have no symbols of a user, and no piece with a marker or line end within it.
    ``docs`` is read three times and must give the same rows in the same order in each task, as files do.
    """
    return chunk_table.encode_and_decode(docs, key, text, chunk_table.Coding(model_path, chunks, parts, encode, pieces, join, BLOCK_BYTES, split))
