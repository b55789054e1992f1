"""BPE encoding and decoding through a table of distinct words (``chunk_table``).

Words are cut at blanks, tabs, line ends and before closing marks, where the tokenizer cuts as well. Each distinct
word is encoded once; its ids go back to the words' positions by join. Ids become pieces through a join with the id-to-piece table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ferryline.llm import chunk_table
from ferryline.llm.token_count import encode_pieces, load_tokenizer, parts, pre_tokens


def _chunks(path: str, text: str | None) -> list[str]:
    return pre_tokens(text)


def _parts(path: str, chunk: str) -> tuple[str, ...]:
    return parts(chunk)


def _encode(path: str, words: list[str]) -> list[list[int]]:
    return encode_pieces(load_tokenizer(path), words)


def _pieces(path: str) -> dict[int, str]:
    return {n: p for p, n in load_tokenizer(path).get_vocab(with_added_tokens=True).items()}


def _join(pieces: list[str]) -> str:
    return " ".join(pieces)


def encode_and_decode(docs: DataFrame, key: str, text: str, tokenizer_path: str) -> DataFrame:
    """``key``, ``ids`` (array of the text's token ids) and ``decoded`` (its pieces joined by blanks).

    One row for each input row; NULL and empty texts have no ids and decode to an empty text. The key
    may be NULL or repeated; other columns do not matter. The tokenizer must drop white space, never join characters across it,
    and have no decoder of its own, as its library then joins pieces by blanks. ``docs`` is read
    three times and must give the same rows in the same order in each task, as files do.
    """
    return chunk_table.encode_and_decode(docs, key, text, chunk_table.Coding(tokenizer_path, _chunks, _parts, _encode, _pieces, _join))
