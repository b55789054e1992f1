"""Token counts of whole texts by a two-tier lookup inside the tasks.

A text is cut at blanks, tabs and line ends into pre-tokens. The tokenizers used here drop
white space and never join characters across it, so a text has as many tokens as its
pre-tokens together. The lengths of frequent pre-tokens are broadcast; all others are
encoded once by each Python worker and kept in its cache. No pre-token is shuffled: a task
reports only those with at least a given share of its own words, at most ``1 / SHARE`` of
them.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from ferryline.llm.words import per_text, returning, text_batches
from ferryline.runtime import materialize

#: A pre-token with this share of all words is frequent, so there are at most 20,000 of them.
SHARE = 5e-5
#: ASCII marks without those of contractions and added tokens.
_MARKS = "!\"#$%&()*+,-./:;=?@[]^_`{}~"
#: Entries of a worker's cache of other pre-tokens; it is emptied when full.
CACHE = 600_000
_CACHES: dict[str, dict[str, int]] = {}
_TOKENIZERS: dict = {}


def pre_tokens(text: str | None) -> list[str]:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if text else []


def parts(piece: str) -> tuple[str, ...]:
    """A pre-token without the marks at its end, and those marks.

    The cut is made only between a letter or digit and a run of ASCII marks, where the tokenizer
    cuts as well, so the parts have the tokens of the whole. The letter must still be one when composed and
    lower-cased: a capital I with dot, or a letter that composition takes apart, ends in a combining mark, which
    the tokenizer leaves with the marks behind it. Plain ASCII parts are lower-cased, as
    the tokenizer would do. Far fewer different words are left.
    """
    body = piece.rstrip(_MARKS)
    last = body[-1:]
    if not last.isalnum() or not (last.isascii() or unicodedata.normalize("NFC", last).lower()[-1].isalnum()):
        return (piece,)
    if "<" not in body and body.isascii():
        return (body.lower(), piece[len(body) :]) if len(body) < len(piece) else (body.lower(),)
    return (body, piece[len(body) :]) if len(body) < len(piece) else (body,)


def load_tokenizer(path: str):
    """The tokenizer of a file, loaded once in a worker. It runs in one thread, as Spark fills the cores."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _TOKENIZERS[path] = tokenizer
    return _TOKENIZERS[path]


def encode_pieces(tokenizer, pieces: list[str]) -> list[list[int]]:
    """Ids of many short texts. Words of ASCII letters need no normaliser, so they go straight to the model."""
    model, out, other = tokenizer.model, [], []
    for n, piece in enumerate(pieces):
        if piece.isascii() and piece.isalpha():
            out.append([token.id for token in model.tokenize(piece.lower())])
        else:
            out.append([])
            other.append(n)
    found = tokenizer.encode_batch_fast([pieces[n] for n in other], add_special_tokens=False)
    for n, encoding in zip(other, found):
        out[n] = encoding.ids
    return out


def lengths(tokenizer, pieces: list[str]) -> list[int]:
    return [len(ids) for ids in encode_pieces(tokenizer, pieces)]


def frequent(docs: DataFrame, text: str, share: float = SHARE) -> dict[str, int]:
    """Pre-tokens with about ``share`` of all words, with their counts.

    Tasks count in windows of ``16 / share`` words, after each of which every count goes down by
    one and zeros are dropped; so their memory is bounded, and counts are low by a sixteenth of
    the share at most.
    """
    text_batches(docs)
    window = int(16 / share)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, seen, since = Counter(), 0, 0
        for batch in batches:
            for t in batch["t"]:
                pieces = pre_tokens(t)
                counts.update(pieces)
                seen, since = seen + len(pieces), since + len(pieces)
                if since >= window:
                    counts, since = Counter({w: n - 1 for w, n in counts.items() if n > 1}), 0
        counts.pop("", None)
        kept = {w: n for w, n in counts.items() if n >= seen * share}
        yield pd.DataFrame({"w": ["", *kept], "n": [seen, *kept.values()]})

    parts = docs.select(F.col(text).alias("t")).mapInPandas(returning(count), "w string, n long")
    total = materialize(parts.groupBy("w").agg(F.sum("n").alias("n")), "frequent")
    words = total.where("w = ''").agg(F.sum("n")).first()[0] or 0
    found = total.where((F.col("w") != "") & (F.col("n") >= max(1.0, share * words)))
    return {row["w"]: row["n"] for row in found.toLocalIterator()}


def token_counts(docs: DataFrame, text: str, tokenizer_path: str, keep: list[str], share: float = SHARE) -> DataFrame:
    """The columns ``keep`` with ``n_tokens``, the number of tokens of the whole text; NULL has none.

    ``tokenizer_path`` names a ``tokenizers`` file whose normaliser and pre-tokeniser drop white
    space; it must exist on every executor.
    """
    words = frequent(docs, text, share)
    tokenizer = load_tokenizer(tokenizer_path)
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(words, lengths(tokenizer, list(words)))))

    def make():
        own, first = load_tokenizer(tokenizer_path), table.value | {"": 0}
        cache = _CACHES.setdefault(tokenizer_path, {})

        def count(texts: list[str | None]) -> tuple[list]:
            out, missed = [], []
            for t in texts:
                pieces = pre_tokens(t)
                known = [first.get(p) for p in pieces]
                missed.append([p for p, n in zip(pieces, known) if n is None])
                out.append(sum([n for n in known if n is not None]))
            words = {piece: parts(piece) for pieces in missed for piece in pieces}
            fresh = {w for cut in words.values() for w in cut if w not in cache}
            if len(cache) + len(fresh) > CACHE:
                cache.clear()
                fresh = {w for cut in words.values() for w in cut}
            fresh = list(fresh)
            for low in range(0, len(fresh), 10_000):
                some = fresh[low : low + 10_000]
                cache.update(zip(some, lengths(own, some)))
            size = {piece: sum([cache[w] for w in cut]) for piece, cut in words.items()}
            return ([n + sum([size[p] for p in pieces]) for n, pieces in zip(out, missed)],)

        return count

    return per_text(docs, text, keep, [StructField("n_tokens", LongType())], make)
