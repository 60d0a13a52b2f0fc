"""The registered queries over the numbered operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, read
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.htmltext import extract
from tidemark.llm.langid import language
from tidemark.llm.lm import lm_scores
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.pieces import encoded
from tidemark.llm.prefixtrie import prefix_trie
from tidemark.llm.pulearn import pu_quality
from tidemark.llm.quality import STOP_WORDS, quality
from tidemark.llm.substrings import passages
from tidemark.llm.tokenalign import cross_alignment
from tidemark.llm.toxicity import toxicity
from tidemark.llm.urlfilter import url_filter


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read(spark, sf_dir, "documents", "doc_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity(docs, labels, crc_mod("doc_id", 5) != 0)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scores(read(spark, sf_dir, "documents", "doc_id", "text"), crc_mod("doc_id", 5) != 1)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language(read(spark, sf_dir, "documents", "doc_id", "text", "lang"), crc_mod("doc_id", 4) != 2)
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


#: The rules of the registered query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS t(host, path, verdict)")
    return url_filter(read(spark, sf_dir, "pages", "page_id", "url"), rules)


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality")
    scored = pu_quality(docs, labels, crc_mod("doc_id", 5) != 0)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_alignment(read(spark, sf_dir, "documents", "doc_id", "text"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_pieces": op2_pieces,
    "op3_toxicity": op3_toxicity,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_html_text": op5_html_text,
    "op6_lm_scores": op6_lm_scores,
    "op7_language": op7_language,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filters": op9_url_filters,
    "op10_substrings": op10_substrings,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_token_alignment": op12_token_alignment,
    "op13_prefix_trie": op13_prefix_trie,
}

_STOP = ", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))

OP8_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (SELECT k, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
hits AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2]) AS c FROM win),
covered AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM hits WHERE c > 1) GROUP BY k),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         greatest(len(w), 1)::DOUBLE AS one, greatest(len(l), 1)::DOUBLE AS lines,
         length(regexp_replace(text, '[^\pL]+', '', 'g')) AS alpha,
         len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS stops,
         len(list_filter(w, lambda x: contains(x, '|'))) AS bars,
         len(list_filter(w, lambda x: x LIKE '%!!')) AS shouts
  FROM d LEFT JOIN covered c USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR n_repeat_words / one > 0.5 AS base_failed,
       NOT (n_words < 50 OR n_repeat_words / one > 0.5) AND NOT (
         n_words > 1000000 OR word_chars / one < 2 OR word_chars / one > 14 OR n_symbols / one > 0.25
         OR bars / one > 0.2 OR shouts / one > 0.5 OR stops / one < 0.03 OR n_dup_lines / lines > 0.5
         OR alpha / greatest(word_chars, 1) < 0.6) AS kept
FROM m
"""

OP9_SQL = r"""
WITH u AS (
  SELECT row_number() OVER () AS k, page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT k, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
r(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (
  SELECT p.k, r.*, row_number() OVER (PARTITION BY p.k ORDER BY length(rh) + length(rp) DESC, length(rh) DESC) AS n
  FROM p JOIN r ON (p.host = rh OR p.host LIKE '%.' || rh) AND starts_with(p.path, rp))
SELECT p.page_id, p.host, p.path, f.rh || f.rp AS rule, coalesce(f.rv, 'allow') AS verdict
FROM p LEFT JOIN f ON p.k = f.k AND f.n = 1
"""

#: DuckDB has no crc32, so it is folded over the digits' codes, bit by bit.
OP13_SQL = r"""
WITH c AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS p,
         coalesce(role, '') AS r, coalesce(text, '') AS t
  FROM conversations WHERE conv_id IS NOT NULL),
v AS (
  SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base,
         xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM c)),
f AS (SELECT v.conv_id, c.p, c.r, c.t FROM v JOIN c ON c.conv_id = v.base AND c.p < v.h),
k AS (SELECT conv_id, count(*) AS n FROM f GROUP BY conv_id),
seq AS (
  SELECT conv_id, p, r, t FROM f
  UNION ALL SELECT conv_id, c.p - v.h + coalesce(k.n, 0), c.r, c.t FROM c JOIN v USING (conv_id) LEFT JOIN k USING (conv_id) WHERE c.p >= v.h),
s AS (SELECT v.conv_id, coalesce(list(struct_pack(r := seq.r, t := seq.t) ORDER BY seq.p) FILTER (WHERE seq.p IS NOT NULL), []) AS s FROM v LEFT JOIN seq USING (conv_id) GROUP BY v.conv_id),
pre AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM s),
names AS (
  SELECT conv_id, d, len(s) AS n, min(conv_id) OVER (PARTITION BY d, s[1:d]) AS name, CASE WHEN d > 0 THEN octet_length(encode(s[d].t)) ELSE 0 END AS size FROM pre),
node AS (
  SELECT name, d, count(*) AS n_convs, max(size) AS size, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends FROM names GROUP BY name, d),
up AS (SELECT node.*, a.name AS parent FROM node LEFT JOIN names a ON a.conv_id = node.name AND a.d = node.d - 1),
kids AS (SELECT parent AS name, d - 1 AS d, count(*) AS n FROM up WHERE parent IS NOT NULL GROUP BY ALL),
own AS (SELECT up.*, coalesce(kids.n, 0) AS kids FROM up LEFT JOIN kids USING (name, d)),
tot AS (
  SELECT a.name, a.d, sum(CASE WHEN x.kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((x.n_convs - 1) * x.size) AS saved
  FROM own x JOIN names a ON a.conv_id = x.name AND a.d <= x.d GROUP BY a.name, a.d)
SELECT own.name AS conv_id, own.d::BIGINT AS depth, parent AS parent_conv_id, n_convs::BIGINT AS n_convs, kids::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM own JOIN tot USING (name, d)
"""

ORACLE = {
    "op13_prefix_trie": OP13_SQL,
    "op8_quality_rules": OP8_SQL,
    "op9_url_filters": OP9_SQL,
}
