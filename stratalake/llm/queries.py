"""The operators as registered queries over the test tables, and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .domain_mixing import mix_domains
from .level_windows import repeated_windows
from .max_sketches import ranked_search
from .retrieval_packing import pack
from .run_index import repeat_report
from .segment_search import segment_search
from .shingle_forest import shingle_join
from .sign_dedup import sign_dedup
from .site_quality import site_quality
from .source_divergence import source_divergence
from .token_blocks import token_blocks
from .url_cascade import host_and_path, url_verdicts
from .warc_index import warc_index

URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
#: Target shares of the words of each domain.
DOMAIN_WEIGHTS = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}
#: A domain of the corpus is listed if one of its labels is one of these.
LISTED_LABELS = ["ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x"]


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The domain (language) of the documents that are labelled good."""
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("domain")).join(good, "doc_id")


def op2_domain_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix_domains(docs, labelled_domains(docs, table(spark, sf_dir, "labels")), DOMAIN_WEIGHTS).drop("tid")


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = warc_index(table(spark, sf_dir, "pages"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("tid")


def op5_shingle_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join(table(spark, sf_dir, "documents"), size=5, threshold=0.8)


def op6_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_search(table(spark, sf_dir, "embeddings"), every=20, k=20, scale=64)


def op7_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"), length=200)


def op8_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=1, window=2048)


def op9_sign_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sign_dedup(table(spark, sf_dir, "embeddings"), threshold=0.9, recall=0.999)


def op10_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    hosts = pages.select(F.col("url").alias("__url")).select(host_and_path(F.col("__url"))[0].alias("key")).distinct()
    listed = hosts.filter(F.arrays_overlap(F.split("key", r"\."), F.array(*map(F.lit, LISTED_LABELS))))
    return url_verdicts(pages, URL_RULES, listed)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"), least=10, top=10)


def op12_max_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_level_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_windows(table(spark, sf_dir, "documents"), length=50)


QUERIES = {
    "op1_token_blocks": op1_token_blocks,
    "op2_domain_mixing": op2_domain_mixing,
    "op3_warc_index": op3_warc_index,
    "op4_site_quality": op4_site_quality,
    "op5_shingle_forest": op5_shingle_forest,
    "op6_segment_search": op6_segment_search,
    "op7_run_index": op7_run_index,
    "op8_retrieval_packing": op8_retrieval_packing,
    "op9_sign_dedup": op9_sign_dedup,
    "op10_url_cascade": op10_url_cascade,
    "op11_source_divergence": op11_source_divergence,
    "op12_max_sketches": op12_max_sketches,
    "op13_level_windows": op13_level_windows,
}

_SEARCH = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS ints FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.ints, x.ints)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

_LISTED = ", ".join(f"'{x}'" for x in LISTED_LABELS)
_URLS = f"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r
), c(verdict, rule) AS (VALUES {", ".join(f"('{v}', '{r}')" for v, r in URL_RULES)}),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p JOIN c ON ('.' || host) LIKE ('%.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY page_id
)
SELECT p.page_id, host, path, rule,
  coalesce(verdict, CASE WHEN list_has_any(split(host, '.'), [{_LISTED}]) THEN 'block' ELSE 'allow' END) AS verdict,
  list_has_any(split(host, '.'), [{_LISTED}]) AS listed
FROM p LEFT JOIN fits USING (page_id)
"""

_WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), w AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM w
"""

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT id, lang, source, {_LOWERED.format("term")} AS term
  FROM (SELECT id, lang, source, unnest(regexp_extract_all(text, '{_TERM}')) AS term FROM d)
), k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term
), l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang
), g AS (
  SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) d
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * l.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.total + 2)) // (l.n + 2 * l.v)::HUGEINT AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), x AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM x QUALIFY part = 'pair' OR rank <= 10
"""

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_RANKED = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({_LOWERED.format("coalesce(text, '')")}, '{_WORD}') AS terms FROM documents
), t AS (SELECT id, unnest(terms) AS term FROM d
), s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_words FROM d WHERE len(terms) > 0
), q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({_LOWERED.format("text")}, '{_WORD}')) AS term FROM benchmark) GROUP BY ALL
), f AS (SELECT id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY id, term
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s
), x AS (
  SELECT item_id, doc_id, id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(terms) * n_docs) // n_words))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN d USING (id), s GROUP BY item_id, doc_id, id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, id)::INTEGER AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 20
"""

_REPEATED = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT id, doc_id, i, array_to_string(words[i:i + 49], ' ') AS word_sequence
  FROM (SELECT id, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)
), r AS (SELECT id, i FROM w QUALIFY min(doc_id) OVER (PARTITION BY word_sequence) < doc_id
), c AS (SELECT DISTINCT id, unnest(range(i, i + 50)) AS i FROM r
), k AS (
  SELECT id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n_kept
  FROM (SELECT id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d) ANTI JOIN c USING (id, i) GROUP BY id
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (id)
"""

ORACLE: dict[str, str] = {
    "op3_warc_index": _WARC,
    "op6_segment_search": _SEARCH,
    "op10_url_cascade": _URLS,
    "op11_source_divergence": _DIVERGENCE,
    "op12_max_sketches": _RANKED,
    "op13_level_windows": _REPEATED,
}
