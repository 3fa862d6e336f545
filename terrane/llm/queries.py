"""The queries of this subpackage: one per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import byte_bpe, collocations, decontaminate, fill_in_middle, html, licenses, mixing, passages, quality, secrets, simhash, token_shards, toxicity
from terrane.llm.common import read


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # A document's owner is its source; a repository is a source's part in one language.
    found = secrets.scan_secrets(docs.withColumn("_repo", F.concat_ws("/", "source", "lang")), owner_col="source", repo_col="_repo")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", secrets.digest("base_spans").alias("base_sha256"), secrets.render("spans").alias("spans"), "n_live", "n_example")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.passage_classes(read(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))), ",")
    return found.select("doc_id", "class_id", "n_dup_words", spans.alias("spans"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", "_toxicity.expected_severity", "_toxicity.p_toxic", "_toxicity.severity", "_toxicity.toxic")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    m = F.col("_match")
    return found.select(
        "doc_id",
        m["n_words"].alias("n_words"),
        m["n_hit"].alias("n_hit"),
        F.size(m["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(m["items"], ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
        m["longest"].alias("longest_match"),
    )


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.training_order(read(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(read(spark, sf_dir, "pages"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return byte_bpe.decode(encoded).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fill_in_middle.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_secret_scan": op2_secret_scan,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_mix_sources": op6_mix_sources,
    "op7_toxicity": op7_toxicity,
    "op8_decontaminate": op8_decontaminate,
    "op9_training_order": op9_training_order,
    "op10_html_text": op10_html_text,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_collocations": op12_collocations,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_W = r"[^\x20\x09-\x0D]+"

ORACLE: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '{_W}') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS lines
  FROM d
), win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n
  FROM (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3))
), rep AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM win WHERE n >= 2) GROUP BY rid
), f AS (
  SELECT w.rid, doc_id, text, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.rid = rep.rid
), b AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(f"({r.sql})" for r in quality.DEFAULT_RULES)}) AS kept
FROM b
""",
    "op12_collocations": r"""
WITH piece AS (
  SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
), f AS (
  SELECT lang, m, phrase, count(*) AS a
  FROM (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS v(m) WHERE len(w) >= m))
  GROUP BY lang, m, phrase
), n AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang
), cand AS (
  SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 10
), cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:m], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)
), scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r,
         CAST((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM cut c JOIN f x ON c.lang = x.lang AND c.first = x.phrase JOIN f y ON c.lang = y.lang AND c.rest = y.phrase
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS a
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE m = 3)
  GROUP BY lang, phrase
), ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, b.score
  FROM best b LEFT JOIN longer x ON b.lang = x.lang AND b.phrase = x.phrase
  WHERE x.a IS NULL OR 100 * x.a < 50 * b.a
)
SELECT r.lang, rank, phrase, a, l, r, n.n, score FROM ranked r JOIN n ON r.lang = n.lang WHERE rank <= 2000
""",
    "op13_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), t AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT doc_id, text, w, CAST(len(w) AS BIGINT) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS lo, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS hi,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), p AS (
  SELECT doc_id, text, n, form, array_to_string(w[1:lo], '') AS prefix, array_to_string(w[lo + 1:hi], '') AS middle, array_to_string(w[hi + 1:n], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM p
""",
}
