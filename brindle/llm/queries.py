"""The registered queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import alignment_report
from .ann import nearest_neighbours
from .fim import fim_report
from .html_tree import extract_main_text
from .isolation import quality_rules
from .jaccard import ngram_jaccard_join
from .licenses import COPYRIGHT_LINE, KNOWN_TEXTS, SPELLINGS, license_scan
from .lm_scoring import cross_entropy_difference
from .mixing import mixture_report
from .packing import pack
from .quality_qda import quality_scores
from .storage import table
from .substring import substring_dedup
from .warc import archive_report


#: The public byte-level BPE files that the machines carry; their folder is a parameter.
TOKENIZER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return scored.select("doc_id", "n_tokens", F.round("score", 6).alias("score"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op3_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), *TOKENIZER, capacity=1024)


def op5_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_report(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"), n=3, percent=90)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), length=13, digest=True)
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op9_cross_polytope_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op10_isolation_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(table(spark, sf_dir, "documents"), *TOKENIZER, PIECES, size_b=32_000)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_report(table(spark, sf_dir, "documents"), seed=1)


def op13_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {f.__name__: f for f in (op1_cross_entropy_difference, op2_license_scan, op3_quality_discriminant, op4_harmonic_packing, op5_mixing_sources, op6_ngram_jaccard_join, op7_substring_dedup, op8_site_style_tree, op9_cross_polytope_neighbours, op10_isolation_quality_rules, op11_tokenizer_alignment, op12_fill_in_middle, op13_warc_archives)}


def _canonical_sql(text: str) -> str:
    out = f"trim(regexp_replace(regexp_replace(lower({text}), '{COPYRIGHT_LINE}', ' ', 'g'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for old, new in SPELLINGS:
        out = f"regexp_replace({out}, '(^| ){old}( |$)', '\\1{new}\\2', 'g')"
    return f"sha256({out})"


_KNOWN = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN_TEXTS)
ORACLE_SQL: dict[str, str] = {
    "op1_cross_entropy_difference": """WITH t AS (SELECT doc_id, text, false AS target FROM documents UNION ALL SELECT NULL, text, true FROM benchmark),
 w AS (SELECT doc_id, target, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM t),
 vocabulary AS (SELECT count(DISTINCT x) AS v FROM (SELECT unnest(w) AS x FROM w)),
 pairs AS (SELECT doc_id, target, unnest(w[1:len(w) - 1]) AS a, unnest(w[2:]) AS b FROM w WHERE len(w) > 1),
 pc AS (SELECT a, b, count(*) FILTER (target) AS ct, count(*) FILTER (NOT target) AS cb FROM pairs GROUP BY a, b),
 fc AS (SELECT a, sum(ct)::DOUBLE AS ft, sum(cb)::DOUBLE AS fb FROM pc GROUP BY a),
 s AS (SELECT doc_id, count(*) AS n, avg(ln(ct + 0.01::DOUBLE) - ln(ft + 0.01::DOUBLE * v) - ln(cb + 0.01::DOUBLE) + ln(fb + 0.01::DOUBLE * v)) AS score
  FROM pairs JOIN pc USING (a, b) JOIN fc USING (a), vocabulary WHERE NOT target GROUP BY doc_id)
 SELECT DISTINCT d.doc_id, coalesce(n, 0)::BIGINT AS n_tokens, round(coalesce(score, 0), 6) AS score FROM documents d LEFT JOIN s USING (doc_id)""",
    "op2_license_scan": f"""WITH known AS (SELECT {_canonical_sql('x')} AS digest, min(name) AS license FROM (VALUES {_KNOWN}) k(name, x) GROUP BY 1),
 lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
 found AS (SELECT doc_id, license FROM (SELECT doc_id, {_canonical_sql('line')} AS digest FROM lines) JOIN known USING (digest)),
 notices AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names FROM found GROUP BY doc_id),
 d AS (SELECT doc_id, {_canonical_sql('text')} AS digest FROM documents)
 SELECT d.doc_id, d.digest, license, coalesce(n, 0)::BIGINT AS n_notices, coalesce(names, '') AS notices FROM d LEFT JOIN known USING (digest) LEFT JOIN notices ON d.doc_id = notices.doc_id""",
    "op12_fill_in_middle": """WITH t AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
 u AS (SELECT *, ('0x' || h[1:8])::UBIGINT % (n + 1) AS h1, ('0x' || h[9:16])::UBIGINT % (n + 1) AS h2, ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM t),
 f AS (SELECT *, least(h1, h2)::BIGINT AS a, greatest(h1, h2)::BIGINT AS b, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
 p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM f)
 SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
 sha256(t) AS restored_sha256 FROM p""",
    "op13_warc_archives": """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
 q AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS original FROM p)
 SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, CASE WHEN n >= 1000 AND page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
 CASE WHEN n >= 1000 AND page_id < original THEN original END AS refers_to FROM q""",
}
