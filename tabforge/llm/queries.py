"""One query for each operator, over whole tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tabforge.llm import audit, bitslice, exactdedup, htmltext, langid, mixing, packing, perplexity
from tabforge.llm import resample, runindex, simhash, tokencount, urlfilter
from tabforge.llm.registry import QUERIES, SQL, query, table
from tabforge.llm.words import one_space

__all__ = ["QUERIES", "SQL"]

WORDS_SQL = "len(regexp_extract_all(coalesce({0}, ''), '[^\\x20\\x09-\\x0D]+'))"
BLANKS_SQL = "regexp_replace(coalesce({0}, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')"

MIX_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, source, CAST({WORDS_SQL.format("text")} AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS total, 3.0 * sum(size) AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY source),
rounds AS (
  SELECT 0 AS i, source, total, cap, weight, CAST(NULL AS DOUBLE) AS fixed FROM sources
  UNION ALL
  SELECT i + 1, source, total, cap, weight,
         CASE WHEN fixed IS NOT NULL THEN fixed
              WHEN weight * ((sum(total) OVER () - coalesce(sum(fixed) OVER (), 0))
                             / sum(CASE WHEN fixed IS NULL THEN weight END) OVER ()) >= cap THEN cap END
  FROM rounds WHERE i < (SELECT count(*) FROM sources)),
final AS (SELECT * FROM rounds WHERE i = (SELECT max(i) FROM rounds)),
targets AS (
  SELECT source, total,
         coalesce(fixed, weight * ((sum(total) OVER () - coalesce(sum(fixed) OVER (), 0))
                                   / sum(CASE WHEN fixed IS NULL THEN weight END) OVER ())) AS target
  FROM final),
rates AS (SELECT *, CASE WHEN total > 0 THEN target / total ELSE 0 END AS rate FROM targets)
SELECT d.doc_id, d.size, CAST(r.total AS BIGINT) AS source_size, r.target AS target,
       d.size * CAST(least(floor(r.rate) + CASE WHEN
         CAST(CAST('0x' || substr(md5(concat_ws(':', CAST(d.doc_id AS VARCHAR), '42')), 1, 13) AS BIGINT) AS DOUBLE)
           / 4503599627370496.0 < r.rate - floor(r.rate) THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM docs d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source"""


@query("op3_mix_sources", MIX_SQL)
def op3_mix_sources(spark, folder):
    """Words each document gives to a mix of sources weighing 1, 2, 3 in turn."""
    plan = mixing.plan_mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return plan.select("doc_id", "size", "source_size", "target", taken)


ALLOW = ["com/", "www.example.com/en/"]
BLOCK = ["example.com/en/", "net/es/", "net/fr/"]

URL_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rhost, rpath, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT p.page_id, p.host, p.path, r.rhost || r.rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost) DESC NULLS LAST, length(r.rpath) DESC) AS n
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best WHERE n = 1"""


@query("op4_url_filter", URL_SQL)
def op4_url_filter(spark, folder):
    """Every page's host and path, the longest rule that fits, and the verdict; allowed if none fits."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urlfilter.filter_urls(pages, ALLOW, BLOCK).drop("url")


@query("op6_token_counts")
def op6_token_counts(spark, folder):
    """Tokens of every whole document."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return tokencount.count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"), limit=2048)


EXACT_SQL = f"""
WITH norm AS (SELECT doc_id, sha256({BLANKS_SQL.format("text")}) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM norm WINDOW g AS (PARTITION BY text_sha256)"""


@query("op7_exact_dedup", EXACT_SQL)
def op7_exact_dedup(spark, folder):
    """The group of equal texts of every document."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    digests = documents.withColumn("text_sha256", F.sha2(one_space("text"), 256))
    return exactdedup.mark_duplicates(digests, carry=["text_sha256"])


@query("op1_simhash_near_dedup")
def op1_simhash_near_dedup(spark, folder):
    """Fingerprints of 4-word shingles and the component of those that differ in 4 bits at most."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(documents, shingle=4, distance=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query("op2_language_id")
def op2_language_id(spark, folder):
    """The language of every document, learned from those that are not held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    documents = documents.withColumn("held_out", langid.held_out("doc_id"))
    model = langid.fit(documents.where("NOT held_out"))
    return langid.predict(documents.drop("lang"), model)


TOP_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x::DOUBLE[], c.x::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.x) = len(q.x)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


@query("op5_top_k", TOP_SQL)
def op5_top_k(spark, folder):
    """The 20 best rows by integer inner product for every twentieth vector."""
    embeddings = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return bitslice.top_k(embeddings, F.col("vec_id") % 20 == 0, k=20)


@query("op9_pack_sequences")
def op9_pack_sequences(spark, folder):
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    vocabulary, ranks = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
    return packing.pack(documents, vocabulary, ranks, capacity=2048)


@query("op8_quality_classifier")
def op8_quality_classifier(spark, folder):
    """Perplexity of every document, its language's threshold, and whether it is kept."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return perplexity.judge(documents, table(spark, folder, "labels").select("doc_id", "quality", "toxic"))


@query("op10_repeated_passages")
def op10_repeated_passages(spark, folder):
    """What is left of every document without the bytes of 50-byte strings that an earlier one has."""
    return runindex.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))


RESAMPLE_SQL = r"""
WITH crc AS MATERIALIZED (
  SELECT list(list_reduce(list_concat([i], [0 FOR _ IN range(8)]),
              lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
texts AS (
  SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 't', row_number() OVER (), text FROM benchmark),
words AS (
  SELECT side, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS (
  SELECT side, doc_id, unnest(list_concat(w, list_concat(
    [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))],
    [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]))) AS g FROM words),
counted AS (SELECT side, doc_id, g, count(*) AS n FROM grams GROUP BY ALL),
hexed AS (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM counted)),
hashed AS (
  SELECT g, xor(list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], [CAST('0x' || h[2 * i + 1 : 2 * i + 2] AS BIGINT) FOR i IN range(len(h) // 2)]),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM hexed, crc),
features AS (SELECT side, doc_id, bucket, n FROM counted JOIN hashed USING (g)),
tally AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t
  FROM features GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000)
                                      / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM tally),
weights AS (
  SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight
  FROM features JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         len(w) >= 20 AS enough,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (doc_id) WHERE side = 'd'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id) AS n,
         5 * count(*) OVER (PARTITION BY enough) // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN enough AND n <= drawn THEN n END AS rank FROM ranked"""


@query("op11_resample", RESAMPLE_SQL)
def op11_resample(spark, folder):
    """Every document's weight towards the benchmark texts, and its rank in the draw of a twentieth."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return resample.resample(documents, table(spark, folder, "benchmark").select("text"), percent=5, least_words=20)


AUDIT_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
marks AS (
  SELECT doc_id, part,
         CAST(len(w) < 200 AS INT) AS a,
         CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT) AS b,
         CAST(100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(text) AS INT) AS c,
         CAST(regexp_matches(text, '[#$%&*|]') AS INT) AS d,
         CAST(doc_id > min(doc_id) OVER (PARTITION BY text) AS INT) AS e
  FROM texts),
once AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM marks LEFT JOIN once USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(range(5)) AS i),
orders AS (
  SELECT [p.i, q.i, r.i, s.i, t.i] AS o FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
steps AS (
  SELECT list_aggregate([substr('ABCDE', CAST(x + 1 AS INT), 1) FOR x IN o], 'string_agg', '') AS filter_order,
         CAST(k AS INT) AS step, 1 << o[k] AS bit,
         CAST(coalesce(list_sum([1 << x FOR x IN o[1 : k - 1]]), 0) AS BIGINT) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS k)),
parts AS (SELECT DISTINCT part FROM masks),
removed AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM masks, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM removed"""


@query("op12_filter_audit", AUDIT_SQL)
def op12_filter_audit(spark, folder):
    """What each of five filters removes at each step of all their orders, for every language."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return audit.audit(documents, table(spark, folder, "labels").select("doc_id", "quality", "toxic"))


@query("op13_main_text")
def op13_main_text(spark, folder):
    """The article of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return htmltext.extract_pages(pages).withColumn("n_chars", F.length("text").cast("long"))
