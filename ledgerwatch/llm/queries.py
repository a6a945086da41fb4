"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm.harmonic import harmonic_sequences
from ledgerwatch.llm.language_model import score_texts
from ledgerwatch.llm.leaks import find_leaks
from ledgerwatch.llm.packing import packed_documents
from ledgerwatch.llm.phrases import collocations
from ledgerwatch.llm.quality import MEASURES, ledger, passes
from ledgerwatch.llm.secrets import scan_secrets
from ledgerwatch.llm.simhash import near_duplicates
from ledgerwatch.llm.tokens import count_tokens
from ledgerwatch.llm.toxicity import score_toxicity
from ledgerwatch.llm.trie import prefix_trie, turn_sequences
from ledgerwatch.llm.urls import judge_urls
from ledgerwatch.llm.weak_labels import score_quality
from ledgerwatch.session import stored

#: The rules of op4.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def leaks(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, folder, "pages").select("page_id", "url"), rules)


def quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    judged = ledger(_table(spark, folder, "documents").select("doc_id", "text"))
    q = {m: F.col(f"quality.{m}").alias(m) for m in MEASURES}
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id",
        *(q[m] for m in base),
        (~passes("base")).alias("base_failed"),
        passes("v1").alias("kept"),
        F.col("quality.failures").alias("failures"),
        *(q[m] for m in MEASURES if m not in base),
    )


def packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(_table(spark, folder, "documents"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = scan_secrets(docs, repository=F.concat_ws("/", "source", "lang"))
    listed = lambda where: F.array_join(F.expr(f"transform(filter(found, x -> {where}), x -> concat_ws(':', x.kind, x.start, x.end))"), ",")
    number = lambda where: F.expr(f"CAST(size(filter(found, x -> {where})) AS BIGINT)")
    return found.select(
        "doc_id",
        *(number(f"x.kind = '{k}'").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(listed("x.base"), 256).alias("base_sha256"),
        listed("true").alias("spans"),
        number("x.live").alias("n_live"),
        number("NOT x.live").alias("n_copied"),
    )


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(_table(spark, folder, "documents"))


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Conversations that begin with the first h turns of the one whose id is the next smaller multiple of five."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    first = sequences.where("conv_id % 5 = 0").select(F.col("conv_id").alias("first_id"), F.slice("turns", 1, 8).alias("head"))
    both = sequences.withColumn("h", h).join(first, F.col("first_id") == F.col("conv_id") - F.col("conv_id") % 5, "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    return both.select("conv_id", F.concat(head, own).alias("turns"))


def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(rebuilt(stored(turn_sequences(_table(spark, folder, "conversations")), "turn-sequences")))


def phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(_table(spark, folder, "documents"))


def harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return harmonic_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")).drop("ids")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": near_copies,
        "op2_leaks": leaks,
        "op3_tokens": token_counts,
        "op4_urls": url_rules,
        "op5_quality": quality_ledger,
        "op6_packing": packing,
        "op7_language_model": model_scores,
        "op8_toxicity": toxicity,
        "op9_secrets": secret_spans,
        "op10_weak_labels": quality_scores,
        "op11_prefix_trie": conversation_trie,
        "op12_collocations": phrases,
        "op13_harmonic": harmonic_packing,
    }


_OP4 = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), matched AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM (SELECT DISTINCT page_id, host, path FROM split) s
  JOIN rules ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
)
SELECT s.page_id, s.host, s.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM split s LEFT JOIN matched m ON s.page_id = m.page_id AND s.host = m.host AND s.path = m.path AND m.place = 1
"""

_OP5 = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT *, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS g FROM base
), numbered AS (
  SELECT row_number() OVER () AS r, * FROM windows
), each AS (
  SELECT r, unnest(g) AS x, unnest(range(1, len(g) + 1)) AS pos FROM numbered
), twice AS (
  SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, x) AS n FROM each) WHERE n > 1
), covered AS (
  SELECT r, sum(least(5, coalesce(after - pos, 5))) AS n FROM (SELECT r, pos, lead(pos) OVER (PARTITION BY r ORDER BY pos) AS after FROM twice) GROUP BY r
), measured AS (
  SELECT doc_id,
         CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: regexp_matches(x, '^\p{Lu}{2}\P{Ll}*$'))) AS BIGINT) AS n_capital_words,
         CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclamations,
         CAST(len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS BIGINT) AS n_stutters,
         CAST(len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) AS BIGINT) AS n_letterless
  FROM numbered LEFT JOIN covered c USING (r)
), judged AS (
  SELECT *,
    CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN 2 * n_capital_words > n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_exclamations > n_words THEN 32 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 16 * n_words THEN 64 ELSE 0 END
    + CASE WHEN 5 * n_stutters > n_words THEN 128 ELSE 0 END
    + CASE WHEN 2 * n_letterless > n_words THEN 256 ELSE 0 END AS failures
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failures & 3) <> 0 AS base_failed, failures = 0 AS kept, failures,
       n_lines, n_capital_words, n_exclamations, n_stutters, n_letterless
FROM judged
"""

_OP11 = r"""
WITH turns AS (
  SELECT conv_id AS c, turn, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t FROM conversations WHERE conv_id IS NOT NULL
), original AS (
  SELECT c, list(t ORDER BY turn NULLS FIRST, t) AS l FROM turns GROUP BY c
), hashed AS (
  SELECT c, l,
         xor(4294967295, list_reduce(
           list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(c AS VARCHAR), i, 1)) AS BIGINT)),
           lambda a, b: list_reduce(CAST(range(8) AS BIGINT[]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)),
           4294967295::BIGINT)) % 9 AS h
  FROM original
), built AS (
  SELECT o.c, list_concat(coalesce(p.l, [])[1:o.h], o.l[o.h + 1:]) AS l FROM hashed o LEFT JOIN original p ON p.c = o.c - o.c % 5
), begun AS (
  SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM built
), nodes AS (
  SELECT l[1:d] AS p, d, min(c) AS conv_id, count(*) AS n,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE len(l) = d), '')) AS ends
  FROM begun GROUP BY l[1:d], d
), children AS (
  SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY p[1:d - 1]
), each AS (
  SELECT n.p, n.d, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf, CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * strlen(n.p[n.d].text) END AS saved
  FROM nodes n LEFT JOIN children c ON c.p = n.p
), above AS (
  SELECT p[1:k] AS p, sum(leaf) AS leaves, sum(saved) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM each) GROUP BY p[1:k]
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children,
       CAST(a.leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN above a ON a.p = n.p LEFT JOIN children c ON c.p = n.p LEFT JOIN nodes up ON n.d > 0 AND up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
"""

_OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM words, (VALUES (1), (2), (3)) AS sizes(k)
), f AS (
  SELECT lang, k, g, count(*) AS c FROM grams GROUP BY lang, k, g
), sizes AS (
  SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, g, c AS a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND c >= 10
), inside AS (
  SELECT lang, part, max(a) AS most
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM candidates WHERE k = 3) GROUP BY lang, part
), cuts AS (
  SELECT c.lang, c.k, c.g, c.a, unnest(range(1, c.k)) AS cut, c.w
  FROM candidates c LEFT JOIN inside i ON c.k = 2 AND i.lang = c.lang AND i.part = c.g
  WHERE i.most IS NULL OR 100 * i.most < 50 * c.a
), scored AS (
  SELECT c.lang, c.g, c.a, c.cut, l.c AS l, r.c AS r,
         CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.c AS HUGEINT) * r.c) AS BIGINT) AS score
  FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.k = c.cut AND l.g = array_to_string(c.w[1:c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.k = c.k - c.cut AND r.g = array_to_string(c.w[c.cut + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
FROM lowest s JOIN sizes USING (lang)
QUALIFY rank <= 2000
"""


def llm_statements() -> dict[str, str]:
    """The others need a tokenizer, XXH64, a trained model or places of matches; tests hold them against brute force."""
    return {"op4_urls": _OP4, "op5_quality": _OP5, "op11_prefix_trie": _OP11, "op12_collocations": _OP12}
