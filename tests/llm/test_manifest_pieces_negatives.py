"""Merkle manifest, marked words and hard negatives on small tables with odd rows, next to brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import floor

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F

from ferryline.llm import chunk_table, hard_negatives, merkle, piece_table
from ferryline.llm.queries import op12_merkle, piece_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    text = [None if row[c] is None else str(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return digest(*["-" if t is None else f"{len(t.encode())}:{t}" for t in text])


def tree(leaves):
    """The last node, and for each leaf its siblings as (left, right) by level, upwards."""
    paths, level, own = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[n : n + 8] for n in range(0, len(level), 8)]
        for n, at in enumerate(own):
            run = runs[at // 8]
            paths[n].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        own, level = [at // 8 for at in own], [digest(*run) for run in runs]
    return level[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        subs[name] = own, *tree([leaf_of(r) for r in own])
    root, tops = tree([subs[name][1] for name in names])
    out = []
    for n, name in enumerate(names):
        own, sub, paths = subs[name]
        for row, path in zip(own, paths):
            path = path + tops[n]
            found = dict(row)
            if row["doc_id"] is not None and row["text"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
                found["text"] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row["text"])
            folded = leaf_of(found)
            for left, right in path:
                folded = digest(left, folded, right)
            out.append((row["doc_id"], leaf_of(row), sub, root, digest(*[a + b for a, b in path]), folded, folded == root))
    return out


def manifest_rows(shape):
    rng, rows = random.Random(4), []
    for lang, count in shape.items():
        for n in range(count):
            rows.append({"doc_id": rng.randint(-9, 10**6), "text": rng.choice(["Ab c", "", None, "É zé", "x" * 3000, f"T{n}"]), "lang": lang, "source": rng.choice([None, "s"]), "n_chars": n or None})
    return rows


@pytest.mark.parametrize(
    "shape",
    [{"en": 1}, {"en": 9}, {None: 8, "": 1}, {"en": 600, None: 65, "de": 64, "é": 2}, {f"g{n}": 1 + n % 3 for n in range(70)}],
)
def test_manifest(spark, tmp_path, shape):
    rows = manifest_rows(shape)
    rows += [dict(rows[0])] * 3 + [dict(rows[0], doc_id=None)] * 2
    frame = spark.createDataFrame([tuple(r[c.split()[0]] for c in DOCS.split(", ")) for r in rows], DOCS)
    frame = frame.withColumn("leaf", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("digest", F.lit("x")).repartition(4)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_merkle(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(expected(rows))


def test_manifest_of_nothing_and_of_some_requests(spark):
    rows = manifest_rows({"en": 200, "de": 3, None: 1})
    frame = spark.createDataFrame([tuple(r[c.split()[0]] for c in DOCS.split(", ")) for r in rows], DOCS)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    none = merkle.build(frame.where("false"), "doc_id", "lang", fields)
    assert none.root is None and merkle.verify(none).count() == 0
    manifest = merkle.build(frame, "doc_id", "lang", fields)
    some = manifest.leaves.where("key % 5 = 0 OR group IS NULL").select("number", "rank", "key", F.col("leaf").alias("own"))
    some = some.unionByName(some.limit(0)).unionByName(spark.createDataFrame([(1, 999, 7, "x"), (9, 0, 7, "x")], "number long, rank long, key long, own string"))
    got = merkle.proofs(manifest, some).withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert len(got) == sum(r["lang"] is None or r["doc_id"] % 5 == 0 for r in rows)
    assert all(r.leaf == r.own and r.folded == r.root == manifest.root for r in got)
    assert manifest.nodes.count() == manifest.nodes.select("digest").distinct().count()


# -- marked words ------------------------------------------------------------------------------


def pieces_library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_file())


def test_marked_words_have_the_ids_of_the_whole():
    library, path, rng = pieces_library(), piece_file(), random.Random(8)
    names = piece_table.pieces(path)
    letters = " \n\t\r▁aabAeitn.,'\"-)(:;<>/0123xéßİ日本語のあ😀́\x00 　क़s"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for text in [*texts, "<s></s><unk><0x0A>", "x" * 5000 + "日本" * 2000, "    def f(x):\n\t\treturn x  "]:
        words = [w for chunk in piece_table.chunks(path, text) for w in piece_table.parts(path, chunk)]
        ids = [i for found in piece_table.encode(path, words) for i in found]
        wanted = library.encode(text)
        assert ids == wanted and piece_table.join([names[i] for i in ids]) == library.decode(wanted), text


@pytest.mark.parametrize("size", [1, 7, 5000])
def test_texts_cut_together_have_their_own_marked_words(size):
    path, rng, letters = piece_file(), random.Random(5), " \n\t\r▁▂━aab.,日é😀\x00"
    texts = [None, "", " ", "▁", "\n", *["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(4000)], "", None]
    alone = "".join(c for c in "\n\r\t" if piece_table.load_model(path).lone[ord(c)])
    shape = re.compile(f"[{alone}]|▁*[^▁{alone}]+|▁+")
    words, places = piece_table.split(path, [texts[n : n + size] for n in range(0, len(texts), size)])
    found = [[words[n] for n in own.tolist()] for own in places]
    assert found == [shape.findall("▁" + t.replace(" ", "▁")) if t else [] for t in texts]


def test_dictionaries_and_numbers_name_the_same_words():
    """Both passes put the words of a block in the same order, whatever rows are in it."""
    texts = ["b a, a\nc", None, "", "a▁b a b", "z " * 50, "c. b"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["k", "t"])
    path = piece_file()
    coding = chunk_table.Coding(path, piece_table.chunks, piece_table.parts, piece_table.encode, piece_table.pieces, piece_table.join, split=piece_table.split)
    shares = [row for part in chunk_table._dictionaries(coding, 3)(iter([batch])) for row in part.to_pylist()]
    words = [w for row in shares for w in zstandard.ZstdDecompressor().decompress(row["words"]).decode().split(" ")]
    (part,) = chunk_table._numbers(coding, 3)(iter([batch]))
    (row,) = part.to_pylist()
    assert {r["block"] for r in shares} == {row["block"]} and row["size"] == len(words) == len(set(words))
    numbers = iter(chunk_table.unpack_numbers(row["numbers"]).tolist())
    found = ["".join(words[next(numbers)] for _ in range(n)) for n in chunk_table.unpack_numbers(row["counts"]).tolist()]
    assert found == ["▁" + t.replace(" ", "▁") if t else "" for t in texts]


def test_pieces_of_whole_texts(spark):
    texts = [(1, None), (2, ""), (3, " "), (4, "A  b\n"), (4, "A  b\n"), (5, "ha " * 40_000 + "end"), (None, "é <s> 漢字"), (6, "\x00")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("t", F.lit(1)).repartition(3)
    library = pieces_library()
    wanted = Counter((k, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for k, t in texts)
    got = piece_table.encode_and_decode(frame, "doc_id", "text", piece_file())
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got.collect()) == wanted
    assert piece_table.encode_and_decode(frame.where("false"), "doc_id", "text", piece_file()).count() == 0


# -- hard negatives ----------------------------------------------------------------------------


def negatives(rows, anchors, scale=256):
    own = [(k, v, l) for k, v, l in rows if None not in (k, v, l) and all(x is not None and np.isfinite(x) for x in v)]
    own = [(k, [floor(scale * x) for x in v], l) for k, v, l in own]
    out, seen = [], set()
    for key, vector, label in own:
        if key % anchors or (key, tuple(vector), label) in seen:
            continue
        seen.add((key, tuple(vector), label))
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), k, l == label) for k, v, l in own if k != key)
        for s, positive, _ in [x for x in scored if x[2]][:5]:
            fits = [(-n, k) for n, k, same in scored if not same and 30 * -s <= 100 * -n <= 90 * -s]
            out += [(key, positive, r, k, -s, n) for r, (n, k) in enumerate(fits[:10], 1)]
    return Counter(out)


@pytest.mark.parametrize("size", [1.0, 1e5])
def test_hard_negatives(spark, monkeypatch, size):
    monkeypatch.setattr(hard_negatives, "PAGE", 16)
    monkeypatch.setattr(hard_negatives, "BLOCK", 3)
    rng = random.Random(3)
    rows = [(n, [size * (rng.uniform(-1, 1) + (k == n % 4)) for k in range(4)], n % 4) for n in range(300)]
    rows += [(n, [size * 0.5] * 4, n % 3) for n in range(300, 360)]  # ties
    rows += [(20, [size] * 4, 1), (20, [size] * 4, 1), (20, [-size] * 4, 2)] + [(700, [size, size, size], 0)] * 30  # repeated ids, a short vector
    rows += [(800, None, 1), (801, [size, None], 1), (802, [float("nan")] * 4, 1), (803, [float("inf")] * 4, 1), (804, [0.0] * 4, None), (None, [size] * 4, 1), (900, [], 3), (901, [0.0] * 4, -5)]
    schema = "vec_id long, embedding array<double>, label int, block int, win int"
    frame = spark.createDataFrame([(*r, 1, 1) for r in rows], schema).repartition(5)
    got = hard_negatives.mine(frame, "vec_id", "embedding", "label", "id % 20 = 0")
    assert Counter(map(tuple, got.collect())) == negatives(rows, 20)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for nothing in (frame.where("false"), frame.where("vec_id % 20 = 1")):
        assert hard_negatives.mine(nothing, "vec_id", "embedding", "label", "id % 20 = 0").collect() == []


@pytest.mark.parametrize("largest", [3, 300, 40_000, 2**27])
def test_packed_products_are_exact(largest):
    rng = np.random.default_rng(1)
    anchors, candidates = rng.integers(-largest, largest + 1, (5, 7)), rng.integers(-largest, largest + 1, (13, 7))
    candidates[0], anchors[0] = largest, -largest
    fields = hard_negatives.choose_fields(largest, int(np.abs(anchors).sum(1).max()))
    assert fields.count > 1 or 26 < fields.bits <= 53
    assert fields.wide == (largest == 2**27)
    found = hard_negatives.scores(anchors, hard_negatives.pack(candidates, fields), len(candidates), fields)
    assert (found == anchors @ candidates.T).all()
