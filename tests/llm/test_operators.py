"""Every operator on small tables with odd rows, next to a brute-force version."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ferryline.llm import (
    bpe_table,
    chunk_table,
    contamination,
    dom,
    language_id,
    metric_search,
    ngram_join,
    sharding,
    substring_dedup,
    token_count,
    warc_store,
    wrapper,
)
from ferryline.llm.queries import tokenizer_file
from ferryline.runtime import shared_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{n % 977} x{n}" for n in range(60_000))
PASSAGE = " ".join(f"p{n}" for n in range(60))
TAIL = " ".join(f"z{n}" for n in range(60))
COPY = " ".join(f"w{n}" for n in range(100))
TEXTS = [
    (1, COPY),
    (2, COPY),
    (3, COPY.replace("w50 ", "other ")),
    (4, None),
    (5, ""),
    (6, " \n\t"),
    (7, "A.b, ÉCOLE don't <|endoftext|> x\x1cy ½ 漢字"),
    (8, LONG),
    (9, "start " + PASSAGE + " end"),
    (10, "begin\n" + PASSAGE.replace(" ", "\n") + "\tfin " + TAIL),
    (11, "one two"),
    (11, "one two"),
    (None, COPY),
    (12, "ha " * 300),
    (13, "ha " * 200),
    (14, "!!! ??? 123"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k and k % 2 else None, None, len(t or "")) for k, t in TEXTS]
    return spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit(1)).withColumn("_text", F.lit("x")).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def library():
    return token_count.load_tokenizer(tokenizer_file())


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


# -- tokens ---------------------------------------------------------------------------


def test_token_counts(docs, empty):
    rows = token_count.token_counts(docs, "text", tokenizer_file(), ["doc_id", "text", "kept"]).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        assert row.n_tokens == len(library().encode(row.text or "", add_special_tokens=False).ids)
    assert token_count.token_counts(empty, "text", tokenizer_file(), ["doc_id"]).count() == 0


def test_bpe(docs, empty):
    rows = bpe_table.encode_and_decode(docs, "doc_id", "text", tokenizer_file()).collect()
    wanted = []
    for key, text in TEXTS:
        ids = library().encode(text or "", add_special_tokens=False).ids
        wanted.append((key, tuple(ids), library().decode(ids, skip_special_tokens=False)))
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == Counter(wanted)
    assert bpe_table.encode_and_decode(empty, "doc_id", "text", tokenizer_file()).count() == 0


def test_bpe_of_words_without_ids_and_of_equal_blocks(spark):
    texts = ["\x01", "a \x01 b", " \x02\n", "same words", None, ""]
    # Every task holds the same texts, with other keys, the same keys, and none.
    rows = [(part if part < 3 else None, text) for part in (1, 2, 2, 3) for text in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    parts = frame.where("doc_id = 1").union(frame.where("doc_id = 2")).union(frame.where("doc_id = 2")).union(frame.where("doc_id IS NULL"))
    found = bpe_table.encode_and_decode(parts, "doc_id", "text", tokenizer_file()).collect()
    wanted = []
    for key in [1, *[2] * 4, None]:
        for text in texts:
            ids = library().encode(text or "", add_special_tokens=False).ids
            wanted.append((key, tuple(ids), library().decode(ids, skip_special_tokens=False)))
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found) == Counter(wanted)


def test_packed_numbers_come_back():
    for numbers in ([], [0], [1, 255, 256, 65_536, (1 << 32) - 1]):
        assert chunk_table.unpack_numbers(chunk_table.pack_numbers(chunk_table.np.array(numbers, "u8"))).tolist() == numbers


def test_parts_have_the_tokens_of_the_whole():
    rng = random.Random(3)
    marks = "aB1é'\"<|>*.$%,-_漢́² Σs"
    for _ in range(3000):
        piece = "".join(rng.choice(marks) for _ in range(rng.randint(1, 7)))
        cut = [i for part in token_count.parts(piece) for i in token_count.encode_pieces(library(), [part])[0]]
        assert cut == library().encode(piece, add_special_tokens=False).ids, piece


def test_words_that_end_in_a_capital_i_with_dot():
    for text in ("ŞİRKETİ.", "(Sİ)", "TÜRKİYE'Sİ, VE", "\u0958, \ufb1d."):
        cut = [i for piece in token_count.pre_tokens(text) for part in token_count.parts(piece) for i in token_count.encode_pieces(library(), [part])[0]]
        assert cut == library().encode(text, add_special_tokens=False).ids, text


def test_each_word_of_a_share_is_encoded_once(spark):
    """Several shares come to one task one after the other, each with its own table."""
    rows = [(n, " ".join(f"v{(n * 7 + k) % 300}" for k in range(40))) for n in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    calls = spark.sparkContext.accumulator(0)

    def encode(path, words):
        calls.add(len(words))
        return [[int(w[1:])] for w in words]

    coding = chunk_table.Coding("", lambda p, t: (t or "").split(" "), lambda p, c: (c,), encode, lambda p: {n: f"v{n}" for n in range(300)}, " ".join)
    got = chunk_table.encode_and_decode(frame, "doc_id", "text", coding).collect()
    assert {(r.doc_id, r.decoded) for r in got} == set(rows) and calls.value == 300


# -- languages ---------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", language_id.held_out())
    languages = language_id.prototypes(docs.where("NOT held_out"), "text", "lang")
    assert list(languages) == ["de", "en", "es", "fr"]
    found = language_id.identify(docs.where("held_out AND lang IS NOT NULL"), "text", languages, ["lang"])
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


def test_texts_without_letters_have_no_language(docs, empty):
    languages = language_id.prototypes(docs, "text", "lang")
    rows = language_id.identify(docs, "text", languages, ["doc_id"]).collect()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {4, 5, 6, 14}
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(TEXTS)
    none = language_id.prototypes(empty, "text", "lang")
    assert none == {} and {r.lang_pred for r in language_id.identify(docs, "text", none, ["doc_id"]).collect()} == {"und"}


def test_unlabelled_texts_with_letters_pass_the_language_stage(spark, docs):
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.known_language(spark, bare, "")
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 7, 8, 9, 10, 11, 12, 13, None} and kept.columns == bare.columns
    assert {r.lang for r in kept.collect()} == {None}


def test_language_stage_fills_missing_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang IS NOT NULL")
    hidden = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang"))).withColumn("score", F.lit(1))
    kept = corpus_pipeline.known_language(spark, hidden, "").withColumnRenamed("lang", "filled").join(docs.select("doc_id", "lang"), "doc_id")
    right = kept.groupBy(F.col("doc_id") % 5 == 0).agg(F.avg((F.col("lang") == F.col("filled")).cast("double"))).collect()
    assert dict(right)[False] == 1 and dict(right)[True] > 0.97
    assert {r.lang for r in corpus_pipeline.known_language(spark, hidden, "", ["de"]).collect()} == {"de"}


# -- copies -------------------------------------------------------------------------------


def test_near_copies(spark, docs, empty):
    rng = random.Random(5)
    many = [(100 + n, " ".join(w if rng.random() > 0.004 else f"c{n}" for w in COPY.split())) for n in range(40)]
    more = spark.createDataFrame(many, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    got = {r.doc_id: r for r in ngram_join.near_copies(more, "doc_id", "text").collect()}
    sets = {}
    for key, text in [*many, *TEXTS]:
        words = alnum(text)
        if key is not None and words:
            sets[key] = frozenset(zip(*[words[i:] for i in range(5)])) if len(words) >= 5 else frozenset([tuple(words)])
    first = {}
    for key in sorted(sets):
        first.setdefault(sets[key], key)
    links, root = Counter(), {k: k for k in first.values()}

    def top(k):
        return k if root[k] == k else top(root[k])

    for (a, x), (b, y) in combinations(first.items(), 2):
        if len(a & b) >= 0.8 * len(a | b):
            links[x] += 1
            links[y] += 1
            low, high = sorted((top(x), top(y)))
            root[high] = low
    for key, own in sets.items():
        assert (got[key].rep, got[key].n_links, got[key].class_id) == (first[own], links[first[own]], top(first[own]))
    assert got[None].class_id is None and got[4].class_id == 4 and got[4].n_links == 0
    assert ngram_join.near_copies(empty, "doc_id", "text").count() == 0


def test_rows_that_repeat_a_key(spark):
    other = " ".join(f"v{n}" for n in range(100))
    rows = [(1, COPY)] * 3 + [(2, COPY + " two"), (3, COPY + " three"), (1, other), (4, other + " four"), (5, "alone here")]
    got = Counter(map(tuple, ngram_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()))
    assert got == Counter([(1, 1, 1, 2)] * 3 + [(2, 2, 1, 2), (3, 3, 1, 2), (1, 1, 1, 1), (4, 4, 1, 1), (5, 5, 5, 0)])


def test_recall_on_documents(spark):
    """Links of all documents next to those of all pairs that share an n-gram."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_copies(docs, "doc_id", "text").collect()}
    sets = {}
    for row in docs.select("doc_id", "text").collect():
        words = alnum(row.text)
        if words:
            sets[row.doc_id] = frozenset(zip(*[words[i:] for i in range(5)])) if len(words) >= 5 else frozenset([tuple(words)])
    first = {}
    for key in sorted(sets):
        first.setdefault(sets[key], key)
    holders = {}
    for own, key in first.items():
        for gram in own:
            holders.setdefault(gram, []).append(key)
    common = Counter(pair for keys in holders.values() for pair in combinations(sorted(keys), 2))
    links = Counter(k for pair, n in common.items() for k in pair if n >= 0.8 * (sum(len(sets[k]) for k in pair) - n))
    wanted = sum(links[first[own]] for own in sets.values())
    assert wanted and sum(n for _, n in got.values()) >= 0.99 * wanted
    assert all(got[key][1] <= links[first[own]] for key, own in sets.items())


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rows = [(n, COPY + f" tail{n}") for n in range(50)]
    got = ngram_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 49)}


def test_banding_reaches_its_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = ngram_join.choose_bands(threshold)
        assert 1 - (1 - threshold**rows) ** bands >= 0.9995 and bands * rows <= 128


# -- passages ------------------------------------------------------------------------------


def test_substring_dedup(docs, empty):
    rows = substring_dedup.remove_repeats(docs, "doc_id", "text", ["doc_id", "text"]).collect()
    first = {}
    for key, text in TEXTS:
        words = spaced(text)
        for i in range(len(words) - 49) if key is not None else ():
            window = tuple(words[i : i + 50])
            first[window] = min(key, first.get(window, key))
    for row in rows:
        words = spaced(row.text)
        gone = set()
        for i in range(len(words) - 49) if row.doc_id is not None else ():
            if first[tuple(words[i : i + 50])] < row.doc_id:
                gone.update(range(i, i + 50))
        assert (row.n_words, row.n_removed) == (len(words), len(gone))
        assert row.kept == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert len(rows) == len(TEXTS)
    assert substring_dedup.remove_repeats(empty, "doc_id", "text", ["doc_id"]).count() == 0


def test_uncut_texts_keep_their_white_space(docs):
    rows = substring_dedup.remove_repeats(docs, "doc_id", "text", ["doc_id", "text"], spacing=True).collect()
    assert all(r.kept == (r.text or "") for r in rows if not r.n_removed)
    assert next(r.kept for r in rows if r.doc_id == 10) == "begin fin " + TAIL


@pytest.mark.parametrize("block", [50_000, 3])
def test_contamination(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(contamination.blocks, "__defaults__", (block,))
    given = [(1, PASSAGE[:150]), (2, "one two"), (3, None), (4, ""), (None, "one"), (5, "W5 w6. w7-w8"), (6, "ha ha ha"), (7, "absent")]
    items = spark.createDataFrame(given, "item_id long, text string")
    windows = [(str(i), w) for i, t in given if i is not None for words in [alnum(t)] for w in {tuple(words[k : k + 13]) for k in range(max(1, len(words) - 12))} if w]
    rows = contamination.contaminated_words(docs, "text", ["doc_id", "text"], items, "item_id", "text").collect()
    for row in rows:
        words, hit, found = alnum(row.text), set(), set()
        if len(words) < 10_000:
            for item, w in windows:
                for i in range(len(words) - len(w) + 1):
                    if tuple(words[i : i + len(w)]) == w:
                        hit.update(range(i, i + len(w)))
                        found.add(item)
        spans = {p for a, b in zip(row.hits[::2], row.hits[1::2]) for p in range(a, b)}
        assert (row.n_words, spans, row["items"]) == (len(words), hit, sorted(found))
    nothing = contamination.contaminated_words(docs, "text", ["doc_id"], items.where("false"), "item_id", "text")
    assert nothing.where("size(hits) > 0").count() == 0 and nothing.count() == len(TEXTS)
    assert contamination.contaminated_words(empty, "text", ["doc_id"], items, "item_id", "text").count() == 0


def test_items_without_id_are_hits(spark, docs):
    items = spark.createDataFrame([(None, PASSAGE), (7, "one two"), (None, "one"), (8, "absent words")], "item_id long, text string")
    found = contamination.contaminated_words(docs, "text", ["doc_id"], items, "item_id", "text").select("doc_id", *contamination.figures(), "items").collect()
    got = {r.doc_id: r for r in found}
    assert (got[9].n_hit, got[9].n_items, got[9]["items"], got[9].contaminated) == (60, 0, [], True)
    assert (got[11].n_hit, got[11]["items"]) == (2, ["7"]) and got[1].n_hit == 0


def test_one_long_item_is_cut_into_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(contamination, "ROWS", 10)
    items = spark.createDataFrame([(None, LONG), (3, LONG)], "item_id long, text string").where("item_id = 3")
    windows = contamination.distinct_windows(items.withColumn("text", F.substring("text", 1, 3000)), "item_id", "text", 13)
    assert windows.count() == len(alnum(LONG[:3000])) - 12 and windows.where("items != array('3')").count() == 0


# -- archive, shards, search --------------------------------------------------------------


def test_archive_gives_back_exact_records(spark):
    body = "<p>é</p>\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n" * 5
    rows = [(3, "http://a/ \r\nWARC-Type: x", body), (1, None, body), (2, "http://b", body + " "), (4, "u", None), (5, "u", "short"), (6, "u", "short"), (None, "u", body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = shared_folder(spark, "warc")
    warc_store.write_archive(pages, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    got = warc_store.read_archive(spark, folder).collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in got} == {
        (1, "response", None), (3, "revisit", 1), (None, "revisit", 1), (2, "response", None), (4, "response", None), (5, "response", None), (6, "response", None),
    }
    for r in got:
        html = next(h for k, _, h in rows if k == r.page_id) or ""
        assert r.payload == html.encode() and r.payload_digest == hashlib.sha256(r.payload).hexdigest()
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest == (r.payload if r.record_type == "response" else b"") + b"\r\n\r\n" and length == len(rest) - 4
    none = shared_folder(spark, "warc")
    warc_store.write_archive(pages.where("false"), none)
    assert warc_store.read_archive(spark, none).count() == 0


def test_shards_fit_and_split_no_more_than_needed(spark):
    rows = [(n, 10 + n % 7) for n in range(500)] + [(7, 60)] * 9 + [(None, None), (900, 5000)]
    sizes = spark.createDataFrame(rows, "k long, size long")
    got = sharding.assign_shards(sizes, "k", "size", 200, ["k", "size"]).collect()
    assert len(got) == len(rows)
    total, count = Counter(), Counter()
    for r in got:
        total[r.shard] += r.size or 0
        count[r.shard] += 1
    assert all(total[s] <= 200 or count[s] == 1 for s in total)
    assert {r.shard: r.shard_bytes for r in got} == dict(total)
    names = sorted(total)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    assert sharding.assign_shards(sizes.where("false"), "k", "size", 200, ["k"]).count() == 0
    few = sharding.assign_shards(sizes.where("k < 40 AND size < 20"), "k", "size", 200, ["k"])
    entries = {r.prefix: r.shard for r in sharding.directory(few).collect()}
    depth = max(map(len, entries.values()))
    assert len(entries) == 2**depth and all(p.startswith(s) for p, s in entries.items())


def test_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(metric_search, "PAGE", 16)
    monkeypatch.setattr(metric_search, "QUERIES", 4)
    rng = random.Random(11)
    rows = [(n, [rng.uniform(-1, 1) for _ in range(5)]) for n in range(400)] + [(n, [0.5] * 5) for n in range(400, 520)]
    rows += [(600, None), (601, [1.0, None, 0.0, 0.0, 0.0]), (602, [float("nan")] * 5), (603, [float("inf")] * 5), (604, []), (None, [1.0] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = metric_search.top_products(frame, "vec_id", "embedding", "id % 50 = 0").collect()
    whole = {k: [math.floor(1024 * x) for x in v] for k, v in rows[:520]} | {604: []}
    for q in range(0, 520, 50):
        ranked = sorted((-sum(a * b for a, b in zip(whole[q], v)), k) for k, v in whole.items() if k != q)[:10]
        assert sorted((r.rank, r.id, r.score) for r in got if r.query_id == q) == [(n, k, -s) for n, (s, k) in enumerate(ranked, 1)]
    assert metric_search.top_products(frame.where("false"), "vec_id", "embedding", "id % 50 = 0").count() == 0


# -- pages ----------------------------------------------------------------------------------


def page(n, body):
    words = " ".join(f"t{n}w{i}" for i in range(30))
    return f"<html><head><title>x</title></head><body><div class='topbar'>Welcome to Our Site</div><div id=content><h2>Title {n}</h2><p>{words}<p>{body}</div></body></html>"


def test_template_texts_are_removed(spark):
    rows = [(n, "https://user@Host.example:80/p", page(n, f"end &amp; of\n {n}")) for n in range(20)]
    rows += [(100, None, None), (101, "x", ""), (102, "x", "plain <b>te</b>xt &eacute;"), (103, "x", "<p>a<br>b<ul><li>1<li>2</ul><!-- c"), (104, "x", "<" * 500 + "\"'" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrapper.extract(pages, "url", "html", ["page_id", "url"]).collect()}
    for n in range(20):
        assert got[n] == f"Title {n}\n\n" + " ".join(f"t{n}w{i}" for i in range(30)) + f"\n\nend & of {n}"
    assert got[100] == got[101] == "" and got[102] == "plain text é" and got[103] == "a b\n\n1\n\n2" and len(got) == len(rows)
    assert wrapper.extract(pages.where("false"), "url", "html", ["page_id"]).count() == 0


def test_parts_that_are_no_article():
    html = """<nav>menu</nav><header>site</header><main><article><header><h1>T</h1></header><p>one <a href=x>link</a></p>
    <aside>side</aside><div class="ad-box ad">buy</div><form><input><label>l</label></form><script>if (a < b) "</p>"</script>
    <p hidden>h</p><table><tr><td>c1<td>c2</table><section class="comments"><p>troll</p></section></article></main><footer>f</footer>"""
    assert wrapper.main_text(html, None) == "T\n\none link\n\nc1\n\nc2"
    assert dom.parse("<p>a<p>b").elements()[1].text() == "b"


BODY = "Long words of the article stand here in a row."


@pytest.mark.parametrize(
    "html, wanted",
    [
        (f"<div class='content has-sidebar'><p>{BODY}</p></div>", BODY),
        (f"<article class='post comments-open'><p>{BODY}</p></article>", BODY),
        (f"<div class='overflow-hidden page-modal'><article><p>{BODY}</p></article></div>", BODY),
        (f"<div class='modal'><article class='widget'><p>{BODY}</p></article></div>", BODY),
        (f"<div class='sidebar'><p>{BODY}</p></div>", BODY),
        (f"<form id='aspnet'><main><p>{BODY}</p><input></main></form>", BODY),
        (f"<article><h2 id='related-work'>Related</h2><section id='notice-period'><p>{BODY}</p></section></article>", f"Related\n\n{BODY}"),
        (f"<article><p>{BODY}</p><ul><li><a>a</a><li><a>b</a><li><a>c</a></ul></article>", f"{BODY}\n\na\n\nb\n\nc"),
        (f"<div class='x'><ul><li><a>a</a><li><a>b</a><li><a>c</a></ul></div><div><p>{BODY}</p></div>", BODY),
        (f"<div class='ad'>{BODY} {BODY}</div><article><p>short</p><div class='ad'>b</div></article>", "short"),
        (f"<article><p>{BODY}</p></article><div class='related'><article><p>{BODY} {BODY} {BODY}</p></article></div>", BODY),
    ],
)
def test_marks_do_not_cut_the_article(html, wanted):
    assert wrapper.main_text(f"<html><body>{html}</body></html>", None) == wanted


@pytest.mark.parametrize(
    "html, wanted",
    [
        ("<div>" + "".join(f"<article><p>{BODY} {n}</p></article>" for n in range(10)) + "</div>", "\n\n".join(f"{BODY} {n}" for n in range(10))),
        (f"<main><p>intro</p><article><p>{BODY}</p></article><p>end</p></main>", f"intro\n\n{BODY}\n\nend"),
        (f"<div><div><h1>Title</h1><div>intro</div><div class='body'><div><p>{BODY} {BODY}</p></div></div></div></div>", f"Title\n\nintro\n\n{BODY} {BODY}"),
        (f"<div><div><p>first {BODY}</p></div><div><p>{BODY} {BODY} {BODY}</p></div></div>", f"first {BODY}\n\n{BODY} {BODY} {BODY}"),
        (f"<div class='body'><p>{BODY} {BODY}</p></div><article><p>teaser</p></article>", f"{BODY} {BODY}\n\nteaser"),
        (f"<div>menu</div><article><header><h1>Title</h1></header><p>{BODY}</p></article>", f"Title\n\n{BODY}"),
    ],
)
def test_all_parts_of_the_article_are_returned(html, wanted):
    assert wrapper.main_text(f"<html><body>{html}</body></html>", None) == wanted


def texts_of_host(pages):
    slots = [wrapper.page_slots(html)[1] for html in pages]
    template = slots[0]
    wrapper.drop_members(template)
    for other in slots[1:]:
        wrapper.fold(template, other)
    template = wrapper.constants(wrapper.tidy(template))
    return [wrapper.main_text(html, template) for html in pages]


@pytest.mark.parametrize(
    "html",
    [
        "<p>{0}</p><p>Share this line</p><p>{0} more</p>",
        "<div><p>Notice to all</p></div><div><p>{0}</p><p>{0} more</p></div>",
        "<article id='post-{1}' class='post-{1} post'><p>Share this line</p><p>{0}</p><p>{0} more</p></article>",
        "<article id='{1}-slug'>" + "".join(f"<p>Line {n} of the site</p>" for n in range(40)) + "<p>{0}</p><p>{0} more</p></article>",
    ],
)
def test_constant_members_of_a_row_are_template(html):
    own = [f"{BODY} {n} " + " ".join(f"v{n}x{i}" for i in range(9)) for n in range(20)]
    found = texts_of_host([html.format(text, n) for n, text in enumerate(own)])
    assert found == [f"{text}\n\n{text} more" for text in own]


@pytest.mark.parametrize("pages", [2, 3, 7, 8, 20])
def test_two_different_pages_make_a_template(pages):
    legal = "All rights of this site are reserved by its owners. " * 20
    html = "<div class='top'>Welcome</div><noscript>" + "Switch it on. " * 99 + "</noscript><h1>Title {0}</h1><p>text {0}</p><div class='end'>" + legal + "</div>"
    assert texts_of_host([html.format(n) for n in range(pages)]) == [f"Title {n}\n\ntext {n}" for n in range(pages)]


@pytest.mark.parametrize("pages", [3, 30, 100])
def test_all_constant_texts_of_a_long_slot_are_template(pages):
    html = "<div>" + "".join(f"<p>Clause {n} of the site</p>" for n in range(700)) + "<p>{0}</p><p>{0} more</p></div>"
    assert texts_of_host([html.format(f"own {n}") for n in range(pages)]) == [f"own {n}\n\nown {n} more" for n in range(pages)]


def test_a_constant_text_is_found_among_many_that_came_first():
    own = [[f"text {n} {k}" for k in range(300)] for n in range(50)]
    pages = ["".join(f"<p>{t}</p>" for t in (*texts, *["Legal note"] * (n >= 15))) for n, texts in enumerate(own)]
    assert texts_of_host(pages) == ["\n\n".join(texts) for texts in own]


def test_texts_that_are_dropped_can_be_no_template(monkeypatch):
    """The same texts are template if none is dropped, over templates of parts that are merged."""

    def template(pages):
        parts = []
        for start in range(4):
            first, *others = [wrapper.page_slots(html)[1] for html in pages[start::4]]
            wrapper.drop_members(first)
            for other in others:
                wrapper.fold(first, other)
            parts.append(wrapper.packed(first))
        whole = wrapper.unpacked(parts[0])
        for part in parts[1:]:
            wrapper.fold(whole, wrapper.unpacked(part))
        held = sum(len(s.texts) for s in wrapper.every_slot(whole))
        return held, [(s.key, s.pages, sorted(s.texts)) for s in wrapper.every_slot(wrapper.constants(whole))]

    monkeypatch.setattr(wrapper, "TEXTS", 1)
    for seed in range(25):
        draw = random.Random(seed)
        shares = [draw.uniform(0.3, 0.9) for _ in range(30)]
        pages = []
        for n in range(draw.choice([5, 20, 26, 30, 40, 60, 250])):
            texts = [f"c{k}" for k, share in enumerate(shares) if draw.random() < share] + [f"own {n} {k}" for k in range(5)]
            pages.append("".join(f"<p>{t}</p>" for t in texts) + f"<div><h2>Head {n % 3}</h2>" * (n % 2) + "<i>end</i>")
        pages += draw.sample(pages, 3)
        held, found = template(pages)
        with monkeypatch.context() as patch:
            patch.setattr(wrapper, "bound", lambda seen: float("inf"))
            most, wanted = template(pages)
        assert found == wanted
        assert held < most or len(pages) < 60


def test_templates_of_a_task_are_passed_on_when_they_hold_many_texts(spark, monkeypatch):
    rows = [(n, f"http://h{n % 2}/{n}", "".join(f"<p>Line {k} of the site</p>" for k in range(200)) + f"<p>own {n}</p>") for n in range(24)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").coalesce(1)
    for held in (wrapper.HELD, 300):
        monkeypatch.setattr(wrapper, "HELD", held)
        texts = {r.page_id: r.text for r in wrapper.extract(pages, "url", "html", ["page_id"]).collect()}
        assert texts == {n: f"own {n}" for n in range(24)}


def test_copies_of_a_page_make_no_template():
    html = "<nav>menu {0}</nav><div class='ad'>buy {0}</div><article><h1>Title</h1><p>text</p></article>"
    assert texts_of_host([html.format(n) for n in range(9)]) == ["Title\n\ntext"] * 9


# -- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark, docs):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    folder = shared_folder(spark, "pipeline")
    items.write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    kept, left = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, folder)
        left[name] = Counter(r.doc_id for r in kept.collect())
        if name != "bpe":
            assert kept.columns == docs.columns
    assert left["language_id"].keys() == {1, 2, 3, 7, 8, 9, 10, 11, 12, 13, None}
    assert left["ngram_join"] == Counter({1: 1, 7: 1, 8: 1, 9: 1, 10: 1, 11: 2, 12: 1, None: 1})
    assert left["decontamination"].keys() == left["substring_dedup"].keys() - {9}
    whole = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole.keys() == left["bpe"].keys()
    assert list(whole[7].ids) == library().encode(dict(TEXTS)[7], add_special_tokens=False).ids


# -- deep and wide pages ------------------------------------------------------------


def test_deep_pages_do_not_stop_a_host(spark):
    deep = "<div>" * 5000 + "own {}" + "</div>" * 5000
    rows = [(1, "http://a/1", deep.format(1)), (2, "http://a/2", deep.format(2)), (3, "http://a/3", "<b>" * 5000 + "left open")]
    rows += [(n, f"http://a/{n}", f"<h6>same line</h6><p>text {n}</p>") for n in range(4, 12)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    texts = {r.page_id: r.text for r in wrapper.extract(pages, "url", "html", ["page_id"]).collect()}
    assert texts == {1: "own 1", 2: "own 2", 3: "left open", **{n: f"text {n}" for n in range(4, 12)}}


def test_long_lists_are_matched_in_bounded_work():
    rows = "".join(f"<p>{n}</p><ul><li>{n}</li></ul>" for n in range(5000))
    other = "".join(f"<c{n % 877}>{n}</c{n % 877}>" for n in range(10_000))
    a, b, c = (wrapper.page_slots(html)[1] for html in (rows, "<h1>more</h1>" + rows, other))
    assert len(wrapper.Matching(a, b).partners(a, b)) == 10_000
    assert wrapper.Matching(a, c).partners(a, c) == []


def test_long_and_short_lists_are_matched_alike():
    for seed in range(200):
        draw = random.Random(seed)
        n, m = draw.randint(0, 8), draw.randint(0, 8)
        weight = {(i, j): draw.randint(1, 4) for i in range(n) for j in range(m) if draw.random() < 0.4}
        whole, few = wrapper.heaviest(n, m, weight), wrapper.heaviest_of_few(m, weight)
        assert sum(weight[p] for p in whole) == sum(weight[p] for p in few)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(few, few[1:]))


def listed(draw, rows):
    """A page with a long list of heads and rows, some of them with more inside."""
    inside = ["x", "<i>x</i>", "<b>x</b><i>y</i>", "<u><b>x</b></u>", "<i>y</i><b>x</b>"]
    return "".join(f"<h3>{draw.choice(inside)}</h3><p>{draw.choice(inside)}</p>" + "<hr>" * (draw.random() < 0.1) for _ in range(rows))


def test_long_lists_lose_no_partner(monkeypatch):
    """Every pair of places counts, not only those with as many of their kind before or behind them."""
    for seed in range(60):
        draw = random.Random(seed)
        own = listed(draw, draw.randint(2, 40))
        other = listed(draw, draw.randint(0, 3)) + own + listed(draw, draw.randint(0, 3)) if seed % 2 else listed(draw, draw.randint(2, 40))
        a, b = (wrapper.page_slots(html)[1] for html in (own, other))
        found = []
        for grid in (0, 10**9):
            monkeypatch.setattr(wrapper, "GRID", grid)
            found.append(wrapper.Matching(a, b).partners(a, b))
        assert found[0] == found[1]
        assert len(found[0]) == len(a.inner) or not seed % 2


def test_template_in_the_midst_of_a_long_list():
    def page(n):
        rows = [f"<h3>head {n} {k}</h3><p>text {n} {k}</p>" for k in range(400 + 3 * n)]
        rows.insert(200 + n, "<h3>note {0}</h3><p><i>Same legal note</i></p>".format(n))
        return "".join(rows)

    texts = texts_of_host([page(n) for n in range(5)])
    assert not any("legal" in text for text in texts)
    assert [text.count("text") for text in texts] == [400 + 3 * n for n in range(5)]


def test_formulas_and_labels_outside_forms_are_text():
    html = "<article><p>x <math>E=mc</math> y</p><form><label>name</label></form><p><label>figure</label> one</p></article>"
    assert wrapper.main_text(html, None) == "x E=mc y\n\nfigure one"
