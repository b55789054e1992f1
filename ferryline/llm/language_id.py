"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, derived from its code point. A letter
trigram is bound as the product of its three vectors, the first rotated by two places and
the second by one. A text is the sum (bundle) of its trigrams
with a letter in the middle; a language prototype is the
sum of the normalised texts of that language. A text gets the language whose prototype has
the largest cosine with it; equal cosines go to the first language in string order.

Letters are compared without case. Each run of letters is padded with one blank on both
sides, so word starts and ends are trigrams too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from ferryline.llm.words import per_text, returning, text_batches

DIMENSIONS = 512
#: Texts are cut into pieces of so many characters, so that a long text needs little memory.
PIECE = 1 << 18
_CODE = np.uint64(21)
_BLANK = np.uint64(0x20)


_LETTER = np.zeros(0x110000, np.int8)


def _is_letter(points: np.ndarray) -> np.ndarray:
    """Whether code points are letters; each code point is looked up once in a worker."""
    state = _LETTER[points]
    if (state == 0).any():
        for code in np.unique(points[state == 0]):
            _LETTER[code] = 1 if chr(code).isalpha() else -1
        state = _LETTER[points]
    return state > 0


class TrigramSpace:
    """Vectors of letters and of the trigrams met so far, for one task."""

    def __init__(self, dimensions: int = DIMENSIONS, keep: int = 20_000):
        self.dimensions, self.keep = dimensions, keep
        self.letters: dict[int, np.ndarray] = {}
        self.codes = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.vectors = np.zeros((keep, dimensions), np.float32)

    def letter(self, code: int) -> np.ndarray:
        vector = self.letters.get(code)
        if vector is None:
            bits = np.random.Generator(np.random.Philox(key=code + 1)).integers(0, 2, self.dimensions)
            vector = self.letters[code] = (2 * bits - 1).astype(np.float32)
        return vector

    def bind(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of trigrams given as packed codes."""
        low = np.uint64((1 << 21) - 1)
        out = np.ones((len(codes), self.dimensions), np.float32)
        for turn, letters in ((2, codes >> np.uint64(42)), (1, (codes >> _CODE) & low), (0, codes & low)):
            known, at = np.unique(letters, return_inverse=True)
            table = np.array([np.roll(self.letter(int(c)), turn) for c in known], np.float32)
            out *= table.reshape(len(known), self.dimensions)[at]
        return out

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct trigrams, no more than the table holds; known ones come from it."""
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        if not known.all():
            fresh = codes[~known]
            if len(self.codes) + len(fresh) > self.keep:
                self.codes, self.places, fresh = np.zeros(0, np.uint64), np.zeros(0, np.int64), codes
            places = np.arange(len(self.codes), len(self.codes) + len(fresh))
            self.vectors[places] = self.bind(fresh)
            merged = np.concatenate([self.codes, fresh])
            order = np.argsort(merged)
            self.codes, self.places = merged[order], np.concatenate([self.places, places])[order]
            at = np.searchsorted(self.codes, codes)
        return self.vectors[self.places[at]]

    def bundles(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The vectors of whole texts, and which of them have letters."""
        out = np.zeros((len(texts), self.dimensions))
        lettered = np.zeros(len(texts), bool)
        pieces = [(n, t[at : at + PIECE].lower()) for n, t in enumerate(texts) for at in range(0, len(t or ""), PIECE)]
        at = 0
        while at < len(pieces):
            to, size = at, 0
            while to < len(pieces) and (to == at or size + len(pieces[to][1]) <= PIECE):
                size += len(pieces[to][1])
                to += 1
            of = np.array([n for n, _ in pieces[at:to]])
            found, owner, codes, counts = self._trigrams([t for _, t in pieces[at:to]])
            lettered[of] |= found
            for low in range(0, len(codes), 4096):
                vectors = self.rows(codes[low : low + 4096])
                np.add.at(out, of, self._counts(owner, counts, low, len(vectors), to - at) @ vectors)
            at = to
        return out, lettered

    @staticmethod
    def _counts(owner: np.ndarray, row: np.ndarray, low: int, width: int, height: int) -> np.ndarray:
        some = (row >= low) & (row < low + width)
        flat = np.bincount(owner[some] * width + row[some] - low, minlength=height * width)
        return flat.reshape(height, width).astype(np.float32)

    @staticmethod
    def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which texts have letters; then for each trigram its text and its row; before the row, all distinct trigrams."""
        joined = " ".join(texts)
        points = np.frombuffer((joined + " ").encode("utf-32-le", "replace"), np.uint32)
        owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
        letters = _is_letter(points)
        found = np.zeros(len(texts), bool)
        found[owner[letters]] = True
        kept = letters.copy()
        kept[1:] |= letters[:-1]
        kept[:-1] |= letters[1:]
        points, owner = np.where(letters, points, _BLANK)[kept].astype(np.uint64), owner[kept]
        points = np.concatenate([np.array([_BLANK], np.uint64), points])
        owner = np.concatenate([owner[:1], owner])
        if len(points) < 3:
            return found, owner[:0], np.zeros(0, np.uint64), owner[:0]
        middle = points[1:-1] != _BLANK
        packed = ((points[:-2] << np.uint64(42)) | (points[1:-1] << _CODE) | points[2:])[middle]
        codes, row = np.unique(packed, return_inverse=True)
        return found, owner[1:-1][middle], codes, row


def prototypes(docs: DataFrame, text: str, label: str, per_label: int = 4_000) -> dict[str, np.ndarray]:
    """Language prototypes of labelled texts, as unit vectors.

    About ``per_label`` texts of each label are used, chosen by a hash of the text (all, if
    fewer); that bounds the fitting, and a larger sample does not move the sums' direction.
    The driver receives one vector for each label.
    """
    text_batches(docs)
    labelled = docs.select(F.col(text).alias("t"), F.col(label).alias("l")).where("t IS NOT NULL AND l IS NOT NULL")
    counts = {row["l"]: row["count"] for row in labelled.groupBy("l").count().toLocalIterator()}
    if not counts:
        return {}
    share = F.lit(1.0)
    for name, count in counts.items():
        share = F.when(F.col("l") == name, min(1.0, per_label / count)).otherwise(share)
    sample = labelled.where(F.pmod(F.xxhash64("t"), F.lit(1 << 20)) < share * (1 << 20))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space, total = TrigramSpace(), {}
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.iloc[low : low + 500]
                vectors, lettered = space.bundles(part["t"].tolist())
                vectors /= np.linalg.norm(vectors, axis=1, keepdims=True).clip(1e-9)
                for name in set(part["l"]):
                    total[name] = total.get(name, 0) + vectors[lettered & (part["l"] == name).to_numpy()].sum(axis=0)
        for name, vector in total.items():
            yield pd.DataFrame({"l": name, "i": np.arange(len(vector)), "v": vector})

    parts = sample.mapInPandas(returning(sums), "l string, i int, v double").groupBy("l", "i").agg(F.sum("v").alias("v"))
    rows = parts.groupBy("l").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("v")).collect()
    out = {row["l"]: np.array([x["v"] for x in row["v"]]) for row in rows}
    return {name: out[name] / max(np.linalg.norm(out[name]), 1e-9) for name in sorted(out)}


def identify(docs: DataFrame, text: str, languages: dict[str, np.ndarray], keep: list[str], lettered_as: str | None = None) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``, and whether a text has letters in a column ``lettered_as``.

    The score is the cosine with the prototype, 0 where that is negative. ``und`` with score 0
    is given to NULL and to texts without letters, or if there is no prototype.
    """
    names = list(languages)
    matrix = np.array([languages[name] for name in names])

    def make():
        space = TrigramSpace()

        def predict(texts: list[str | None]) -> tuple[list, ...]:
            if not names:
                lettered = [any(map(str.isalpha, (t or "").lower())) for t in texts] if lettered_as else []
                return (["und"] * len(texts), [0.0] * len(texts), lettered)[: len(added)]
            vectors, lettered = space.bundles(texts)
            cosine = vectors @ matrix.T / np.linalg.norm(vectors, axis=1, keepdims=True).clip(1e-9)
            best = cosine.argmax(axis=1)
            scores = np.where(lettered, cosine[np.arange(len(texts)), best].clip(0, 1), 0.0)
            return ([names[b] if ok else "und" for b, ok in zip(best, lettered)], scores, lettered.tolist())[: len(added)]

        return predict

    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    if lettered_as:
        added.append(StructField(lettered_as, BooleanType()))
    return per_text(docs, text, keep, added, make)


def held_out(key: str = "doc_id") -> Column:
    """One document in five, by its id; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))
