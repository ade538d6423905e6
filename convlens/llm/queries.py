"""The package's queries: one per operator, over its whole table, with the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convlens.llm import fingerprints, hnsw, html_text, ngram_join, packing, phrases, pii, repeats, sentencepiece_fst, sharding, token_alignment, toxicity, warc
from convlens.llm.common import table

ORACLE: dict[str, str] = {}


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")), F.lit(5)) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn_from=~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str = "/opt/tokenizers/piece_bpe_32k.model") -> DataFrame:
    model = sentencepiece_fst.read_model(model_path)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentencepiece_fst.encode(docs, model)
    return sentencepiece_fst.decode(encoded, model).select(
        "doc_id", F.size("ids").alias("n_ids"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, key="op4", count_col="n_replaced")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("length"))  # bytes and an end mark
    return packing.pack_documents(docs, "doc_id", "length", capacities=(2048, 4096, 8192, 16384))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
    return sharding.shuffle_to_shards(rows, 16, seed=6).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"), "page_id", "url", "html", least_bytes=1000)
    return warc.read_records(index, with_payload=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op7_warc"] = """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
         m AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
    SELECT page_id, payload_bytes, p.payload_digest AS payload_digest,
           CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id < last THEN last END AS refers_to
    FROM p LEFT JOIN m ON p.payload_digest = m.payload_digest AND p.payload_bytes >= 1000"""


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)


ORACLE["op8_ngram_join"] = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id != b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
    reach AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.m, d.doc_id))::BIGINT AS component_id
    FROM documents d LEFT JOIN n USING (doc_id)
    LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY 1) r USING (doc_id)"""


def op9_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE["op9_hnsw"] = """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x != 0)) > 0),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id != b.vec_id
              AND list_cosine_similarity(a.e, b.e) >= 0.98),
    reach AS (SELECT a AS vec_id, b AS other FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a)
    SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(r.m, e.vec_id))::BIGINT AS component_id,
           e.vec_id <= coalesce(r.m, e.vec_id) AS kept
    FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
    LEFT JOIN (SELECT vec_id, min(other) AS m FROM reach GROUP BY 1) r ON r.vec_id = e.vec_id"""


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = fingerprints.with_next(docs, "doc_id", "text", {"text": "next_text", "fp": "next_fp"},
                                   lambda df: fingerprints.with_fingerprint(df, "text", "fp"))
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    done = fingerprints.with_fingerprint(pairs.withColumn("edited", edited), "edited", "edited_fp")
    return done.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        fingerprints.hex_string(F.col("fp")).alias("fingerprint"),
        fingerprints.hex_string(F.col("edited_fp")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def op11_alignment(spark: SparkSession, sf_dir: str, a_path: str = "/opt/tokenizers/byte_bpe_50k.json",
                   b_path: str = "/opt/tokenizers/piece_bpe_32k.model") -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), a_path, b_path)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE["op12_phrases"] = r"""
    WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    w AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
    n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
    g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
    f AS (SELECT lang, p, k, count(*) AS f FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 100),
    c AS (SELECT lang, p, k, f, string_split(p, ' ') AS w FROM f WHERE k > 1),
    inner_ AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS p, max(f) AS longer
               FROM (SELECT lang, w, f, k, s, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM c)) GROUP BY 1, 2),
    cuts AS (SELECT lang, p, f, c.w AS w, unnest(range(1, k)) AS cut FROM c),
    s AS (SELECT cuts.lang AS lang, cuts.p AS p, cuts.f AS a, cut, x.f AS l, y.f AS r, n,
                 ((1000::HUGEINT * cuts.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
          FROM cuts JOIN n USING (lang)
          JOIN f x ON x.lang = cuts.lang AND x.p = array_to_string(w[1:cut], ' ')
          JOIN f y ON y.lang = cuts.lang AND y.p = array_to_string(w[cut + 1:], ' ')),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
    k AS (SELECT b.* FROM b LEFT JOIN inner_ i ON i.lang = b.lang AND i.p = b.p WHERE longer IS NULL OR longer < a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score FROM k
    QUALIFY rank <= 2000"""


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400)


ORACLE["op13_repeats"] = """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS k
          FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM d WHERE len(h) >= 800)),
    s AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new
          FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
    runs AS (SELECT r, min(i) AS a, max(i) + 400 AS b
             FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM s) GROUP BY r, g),
    pieces AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS lo, a AS hi FROM runs
               UNION ALL SELECT r, max(b), 1000000000 FROM runs GROUP BY r),
    kept AS (SELECT pieces.r AS r, string_agg(substr(h, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo) AS h FROM pieces JOIN d ON d.r = pieces.r GROUP BY 1),
    sums AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
    SELECT doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
           sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
    FROM d LEFT JOIN sums ON sums.r = d.r LEFT JOIN kept ON kept.r = d.r"""


QUERIES = {f.__name__: f for f in (op1_html_text, op2_toxicity, op3_sentencepiece, op4_pii, op5_packing, op6_sharding, op7_warc, op8_ngram_join, op9_hnsw, op10_fingerprints,
                                  op11_alignment, op12_phrases, op13_repeats)}
