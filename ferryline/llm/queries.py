"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm import bpe_table, contamination, hard_negatives, language_id, merkle, metric_search, ngram_join, piece_table, sharding, substring_dedup, token_count, warc_store, wrapper
from ferryline.llm.registry import QUERIES, query, read  # noqa: F401
from ferryline.runtime import shared_folder


def tokenizer_file() -> str:
    """The public word-level BPE file, found where the tokenizers are installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_file() -> str:
    """The public SentencePiece model, found where the tokenizers are installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query()
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = token_count.token_counts(docs, "text", tokenizer_file(), ["doc_id", "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query()
def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = bpe_table.encode_and_decode(read(spark, sf, "documents"), "doc_id", "text", tokenizer_file())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op11_pieces(spark: SparkSession, sf: str) -> DataFrame:
    coded = piece_table.encode_and_decode(read(spark, sf, "documents"), "doc_id", "text", piece_file())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").withColumn("held_out", language_id.held_out())
    languages = language_id.prototypes(docs.where("NOT held_out"), "text", "lang")
    return language_id.identify(docs, "text", languages, ["doc_id", "held_out"])


@query(
    r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(13, len(w)) AS l FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, l, array_to_string(w[i : i + l - 1], ' ') AS k
       FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS i FROM bl)),
dw AS (SELECT doc_id, l, i, array_to_string(w[i : i + l - 1], ' ') AS k
       FROM (SELECT d.*, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bw))),
m AS (SELECT doc_id, i, dw.l, item_id FROM dw JOIN bw USING (l, k)),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM m)) GROUP BY 1),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM m GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
)
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination.contaminated_words(
        read(spark, sf, "documents"), "text", ["doc_id"], read(spark, sf, "benchmark"), "item_id", "text"
    )
    return found.select("doc_id", "n_words", *contamination.figures())


@query(
    r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - 48)) AS i FROM d)),
f AS (SELECT k, min(doc_id) AS first FROM k GROUP BY 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM k JOIN f USING (k) WHERE first < doc_id),
r AS (SELECT doc_id, list(p) AS p FROM g GROUP BY 1),
x AS (SELECT doc_id, len(w) AS n, coalesce(len(p), 0) AS gone,
             CASE WHEN p IS NULL THEN array_to_string(w, ' ')
                  ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(p, i)), ' ') END AS kept
      FROM d LEFT JOIN r USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, gone::BIGINT AS n_removed, sha256(kept) AS kept_sha256 FROM x
"""
)
def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(read(spark, sf, "documents"), "doc_id", "text", ["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query(
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h))::BIGINT AS n, sha256(h) AS s FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS first FROM q)
SELECT page_id, n AS payload_bytes, s AS payload_digest,
       CASE WHEN n < 100 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n < 100 OR page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
)
def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    warc_store.write_archive(read(spark, sf, "pages"), folder)
    records = warc_store.read_archive(spark, folder)
    return records.select("page_id", F.length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


@query(
    """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
)
def op8_top_k(spark: SparkSession, sf: str) -> DataFrame:
    found = metric_search.top_products(read(spark, sf, "embeddings"), "vec_id", "embedding", "id % 100 = 0")
    return found.withColumnRenamed("id", "vec_id")


#: Bytes of text in a shard.
SHARD_BYTES = 2 << 20


@query(
    f"""
WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes,
                  lpad(bin(CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT)), 32, '0') AS b FROM documents),
e AS (SELECT doc_id, n_bytes, g AS depth, substr(b, 1, g) AS shard FROM d, range(0, 33) t(g)),
s AS (SELECT depth, shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS n FROM e GROUP BY ALL),
r AS (SELECT e.doc_id, e.n_bytes, e.shard, e.depth, s.shard_bytes,
             row_number() OVER (PARTITION BY e.doc_id ORDER BY e.depth) AS k
      FROM e JOIN s USING (depth, shard) WHERE s.shard_bytes <= {SHARD_BYTES} OR s.n = 1)
SELECT doc_id, n_bytes, shard, depth::INTEGER AS depth, shard_bytes FROM r WHERE k = 1
"""
)
def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return sharding.assign_shards(docs, "doc_id", "n_bytes", SHARD_BYTES, ["doc_id", "n_bytes"])


@query()
def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_copies(read(spark, sf, "documents"), "doc_id", "text")


@query()
def op3_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    texts = wrapper.extract(read(spark, sf, "pages"), "url", "html", ["page_id", "url"])
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def _field(value: str) -> str:
    """A field of a leaf in DuckDB."""
    return f"coalesce(octet_length(encode({value}))::VARCHAR || ':' || {value}, '-')"


_HEAD = " || ".join(_field(v) for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR"))


@query(
    f"""
WITH RECURSIVE
c AS (SELECT *, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '0'), ''),
             lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc FROM documents),
d AS (SELECT doc_id, lang, sha256({_HEAD} || {_field("text")}) AS leaf,
             sha256({_HEAD} || {_field("CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END")}) AS found
      FROM c),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n,
             dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM d),
u AS (SELECT 0 AS lv, g, r AS i, leaf AS h, n FROM l
      UNION ALL
      SELECT lv + 1, g, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM u WHERE n > 1 GROUP BY lv, g, i // 8, n),
s AS (SELECT g, h FROM u WHERE n = 1),
t AS (SELECT 0 AS lv, g AS i, h, count(*) OVER () AS n FROM s
      UNION ALL
      SELECT lv + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM t WHERE n > 1 GROUP BY lv, i // 8, n),
a AS (SELECT 0 AS st, lv, g, i, h FROM u WHERE n > 1 UNION ALL SELECT 1, t.lv, s.g, t.i, t.h FROM t, s WHERE t.n > 1),
o AS (SELECT g, r, a.st, a.lv, a.i, a.h, CASE WHEN st = 0 THEN r ELSE g END // (8 ** a.lv)::BIGINT AS me FROM l JOIN a USING (g)
      WHERE a.i // 8 = CASE WHEN st = 0 THEN r ELSE g END // (8 ** (a.lv + 1))::BIGINT),
p AS (SELECT g, r, coalesce(string_agg(h, '' ORDER BY st, lv, i) FILTER (i <> me), '') AS path FROM o GROUP BY ALL),
q AS (SELECT g, r, st * 100 + lv AS k, i < me AS before, string_agg(h, '' ORDER BY i) FILTER (i <> me) AS hs FROM o GROUP BY ALL),
w AS (SELECT g, r, k, row_number() OVER (PARTITION BY g, r ORDER BY k) AS step, coalesce(max(hs) FILTER (before), '') AS lft, coalesce(max(hs) FILTER (NOT before), '') AS rgt
      FROM q GROUP BY g, r, k),
f AS (SELECT g, r, 0 AS step, found AS h FROM l
      UNION ALL
      SELECT f.g, f.r, f.step + 1, sha256(lft || f.h || rgt) FROM f JOIN w ON w.g = f.g AND w.r = f.r AND w.step = f.step + 1),
e AS (SELECT g, r, arg_max(h, step) AS folded FROM f GROUP BY g, r)
SELECT l.doc_id, l.leaf, s.h AS subroot, z.h AS root, sha256(coalesce(path, '')) AS proof_sha256, folded AS folded_root, folded = z.h AS verified
FROM l JOIN s USING (g) JOIN e USING (g, r) LEFT JOIN p USING (g, r), (SELECT h FROM t WHERE n = 1) z
"""
)
def op12_merkle(spark: SparkSession, sf: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    manifest = merkle.build(
        read(spark, sf, "documents"),
        "doc_id",
        "lang",
        ["doc_id", "source", "lang", "n_chars", "text"],
        {"text": F.when(tampered, lower).otherwise(F.col("text"))},
    )
    return merkle.verify(manifest).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified"
    )


@query(
    """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND k <= 5
      AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
)
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf, "embeddings").withColumn("label", noisy), "vec_id", "embedding", "label", "id % 100 = 0")
