"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clientlens.llm import ann, decontam, jaccard, language, lm, quality, toxicity, urlrules
from clientlens.llm.archive import read_archive, write_archive
from clientlens.llm.collocations import collocations
from clientlens.llm.mixing import mix_to_targets
from clientlens.llm.packing import pack
from clientlens.llm.shared import held_out, scratch, table
from clientlens.llm.vectorcodes import vector_codes


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, keep=~held_out("doc_id", 3))
    return language.identify(docs, model).select("doc_id", held_out("doc_id", 3).alias("held_out"), "lang_pred", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), keep=~held_out("doc_id", 3))
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id", 3).alias("held_out"), "score",
                                              (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest",
                                            "record_type", "refers_to")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlrules.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"),
                         F.col("url_rule").alias("rule"), F.col("url_verdict").alias("verdict"), F.col("url_mined").alias("mined"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs)).select("doc_id", "score", (F.col("score") >= 0.5).alias("keep"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return lm.score_texts(table(spark, sf_dir, "documents"), held_out("doc_id", 5), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix_to_targets(table(spark, sf_dir, "documents"))
    return m.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                    F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
                    decontam.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


#: how near, in words, a window's words lie to its rarest in a proximity match
NEAR = 20


def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other kind of match of operator 8, on whole tables: how many windows
    a document has with all words near an occurrence of the rarest."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), within=NEAR).select("doc_id", "n_near")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), is_query="id % 20 = 0", k=20)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings")).select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                                                                   "codebooks_sha256")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_warc_archive": op3_warc_archive,
    "op4_url_rules": op4_url_rules,
    "op5_quality": op5_quality,
    "op6_lm_scores": op6_lm_scores,
    "op7_mix_sources": op7_mix_sources,
    "op8_decontamination": op8_decontamination,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_packing": op11_packing,
    "op12_vector_codes": op12_vector_codes,
    "op13_collocations": op13_collocations,
    "benchmark_proximity": benchmark_proximity,
}

# DuckDB SQL ----------------------------------------------------------------
_B32 = " || ".join(
    f"lpad(to_base(('0x' || substr(h, {i}, 5))::BIGINT, 32), 4, '0')" for i in range(1, 40, 5))

OP3_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h FROM p),
o AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS owner FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       translate(upper({_B32}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = owner THEN NULL ELSE owner END AS refers_to
FROM o"""

_MIX_CTES = """
sz AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
              substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15) AS h FROM {docs}),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sz GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
                 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w FROM s0),
s2 AS (SELECT *, source_size * 2.0::DOUBLE AS lim, source_size * 2.0::DOUBLE / w AS r FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(lim) OVER b, 0.0::DOUBLE))
                 / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0::DOUBLE)) AS lv
       FROM s2 WINDOW b AS (ORDER BY r, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, (SELECT arg_min(lv, r) FROM s3 WHERE lv <= r) AS lev FROM s3),
s5 AS (SELECT source, source_size, least(lim, coalesce(lev * w, lim)) AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS q FROM s5),
s7 AS (SELECT *, target - q * source_size AS rest FROM s6),
g0 AS (SELECT source, h, sum(size)::BIGINT AS s FROM sz GROUP BY source, h),
g1 AS (SELECT *, coalesce(sum(s) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef
       FROM g0),
g2 AS (SELECT g1.source, h, CASE WHEN bef + s <= rest THEN 1
              WHEN bef <= rest AND s - (rest - bef) < rest - bef THEN 1 ELSE 0 END AS x
       FROM g1 JOIN s7 ON g1.source IS NOT DISTINCT FROM s7.source)"""

OP7_SQL = "WITH " + _MIX_CTES.format(docs="documents") + """
SELECT doc_id, size, source_size, target, (size * (q + x))::BIGINT AS taken
FROM sz JOIN s7 ON sz.source IS NOT DISTINCT FROM s7.source
JOIN g2 ON sz.source IS NOT DISTINCT FROM g2.source AND sz.h = g2.h"""

_DECONTAM_CTES = """
iw AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(w, s + 1, s + 13) AS g
        FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 13, 0) + 1)) AS s FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, row_number() OVER () AS rid,
              list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM {docs}),
sz AS (SELECT DISTINCT len(g) AS n FROM win),
dg AS (SELECT rid, n, s, list_slice(w, s + 1, s + n) AS g
       FROM (SELECT rid, n, w, unnest(range(len(w) - n + 1)) AS s FROM dw, sz WHERE len(w) >= n)),
m AS (SELECT rid, s, n, item_id FROM dg JOIN win USING (g)),
hit AS (SELECT rid, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM m) GROUP BY rid),
its AS (SELECT rid, count(*)::BIGINT AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS i FROM m WHERE item_id IS NOT NULL) GROUP BY rid)"""

# proximity: the rarest word of a window, then all its other words near it
_NEAR_CTES = f""",
wt AS (SELECT g, unnest(g) AS term, unnest(range(len(g))) AS off FROM (SELECT DISTINCT g FROM win)),
pt AS (SELECT rid, pos, term FROM (SELECT rid, unnest(w) AS term, unnest(range(len(w))) AS pos FROM dw) WHERE term IN (SELECT term FROM wt)),
df AS (SELECT term, count(*) AS df FROM pt GROUP BY term),
wd AS (SELECT g, wt.term, min(off) AS off, any_value(df) AS df FROM wt LEFT JOIN df ON wt.term = df.term GROUP BY g, wt.term),
rk AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY df, off) AS nth, count(*) OVER (PARTITION BY g) AS size,
              count(df) OVER (PARTITION BY g) AS found FROM wd),
rare AS (SELECT pt.rid, pt.pos, rk.g, rk.size FROM pt JOIN rk ON pt.term = rk.term WHERE nth = 1 AND found = size),
nr AS (SELECT rid, count(DISTINCT g)::BIGINT AS n_near FROM (
         SELECT rare.rid, rare.pos, rare.g FROM rare JOIN rk ON rare.g = rk.g
         JOIN pt ON pt.rid = rare.rid AND pt.term = rk.term AND pt.pos BETWEEN rare.pos - {NEAR} AND rare.pos + {NEAR}
         GROUP BY rare.rid, rare.pos, rare.g, rare.size HAVING count(DISTINCT rk.term) = rare.size) GROUP BY rid)"""

OP8_SQL = "WITH " + _DECONTAM_CTES.format(docs="documents") + """
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)"""

PROXIMITY_SQL = "WITH " + _DECONTAM_CTES.format(docs="documents") + _NEAR_CTES + """
SELECT doc_id, coalesce(n_near, 0) AS n_near FROM dw LEFT JOIN nr USING (rid)"""



def _codes_sql(rounds: int = 2, parts: int = 16, entries: int = 64) -> str:
    """Assign and update, once a round, then assign again. A distance and its
    entry are one number (distance * entries + entry), so the least breaks ties."""
    near = """
a{n} AS (SELECT rid, p, min(list_sum(list_transform(list_zip(q.x, c.x), lambda z: ((z[1] - z[2]) * (z[1] - z[2]))::BIGINT))::BIGINT * {k} + c.e) AS m
         FROM q JOIN c{n} c USING (p) GROUP BY rid, p)"""
    move = """
s{n} AS (SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS c
         FROM (SELECT q.p, (m % {k}) AS e, q.x, unnest(range(1, len(q.x) + 1)) AS i FROM a{n} JOIN q USING (rid, p)) GROUP BY p, e, i),
u{n} AS (SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS x FROM s{n} GROUP BY p, e),
c{o} AS (SELECT c.p, c.e, coalesce(u.x, c.x) AS x FROM c{n} c LEFT JOIN u{n} u ON c.p = u.p AND c.e = u.e)"""
    steps = ",".join(near.format(n=n, k=entries) + "," + move.format(n=n, o=n + 1, k=entries) for n in range(rounds))
    return f"""
WITH kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid,
                     list_transform(embedding, lambda y: floor(256.0::DOUBLE * y::DOUBLE)::BIGINT) AS v
              FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
q AS (SELECT rid, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS x
      FROM (SELECT rid, v, unnest(range({parts})) AS p FROM kept)),
c0 AS (SELECT p, rid - 1 AS e, x FROM q WHERE rid <= {entries}),{steps},{near.format(n=rounds, k=entries)},
o AS (SELECT vec_id, label, string_agg(lpad(lower(to_hex(m % {entries})), 2, '0'), '' ORDER BY p) AS code, sum(m // {entries})::BIGINT AS error
      FROM a{rounds} JOIN kept USING (rid) GROUP BY rid, vec_id, label),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o, h"""


# all pairs by shared shingles, then everything that links reach
OP10_SQL = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
         lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT rid, array_to_string(w[s + 1:s + 5], ' ') AS g
       FROM (SELECT rid, w, unnest(range(greatest(len(w) - 5, 0) + 1)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*)::BIGINT AS n FROM sh GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sh a JOIN sh b USING (g) WHERE a.rid < b.rid GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT rid AS x, rid AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT a.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(b.doc_id) AS component_id
FROM r JOIN d a ON a.rid = r.x JOIN d b ON b.rid = r.y LEFT JOIN n ON n.rid = a.rid GROUP BY a.rid, a.doc_id"""

OP12_SQL = _codes_sql()
OP13_SQL = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
s AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM s
      UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM s WHERE len(w) >= 2
      UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM s WHERE len(w) >= 3),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM s GROUP BY lang),
t AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
c AS (SELECT lang, k, phrase, a, w, 1 AS cut, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM t
      UNION ALL SELECT lang, k, phrase, a, w, 2, w[1] || ' ' || w[2], w[3] FROM t WHERE k = 3),
v AS (SELECT c.lang, c.k, c.phrase, c.a, cut, l.a AS l, r.a AS r, 1000000 * c.a * c.a // (l.a * r.a) AS score
      FROM c JOIN f l ON c.lang = l.lang AND c.x = l.phrase JOIN f r ON c.lang = r.lang AND c.y = r.phrase),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
e AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM t WHERE k = 3
      UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM t WHERE k = 3) GROUP BY lang, phrase),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
      FROM b LEFT JOIN e ON b.lang = e.lang AND b.phrase = e.phrase WHERE e.longer IS NULL OR 100 * e.longer < 50 * b.a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM o JOIN n USING (lang) WHERE rank <= 2000"""

ORACLE_SQL = {"op3_warc_archive": OP3_SQL, "op7_mix_sources": OP7_SQL, "op8_decontamination": OP8_SQL,
              "op10_ngram_jaccard": OP10_SQL, "op12_vector_codes": OP12_SQL,
              "op13_collocations": OP13_SQL,
              "benchmark_proximity": PROXIMITY_SQL}
