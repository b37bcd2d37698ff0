"""Registered queries of the text operators and the corpus pipeline."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import (bpe, decontaminate, html_extract, jaccard_join, lexical_search, lm_score, pii, prefix_trie, quality, secret_scan,
                        substring_dedup, suffix_dedup, toxicity)
from encore.registry.common import Registry

R = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Words of a text in DuckDB, after lower-casing A-Z only.
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w,
                  row_number() OVER () AS r FROM documents),
b AS (SELECT item_id, regexp_extract_all({_ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, list_slice(w, i, i + least(10, len(w)) - 1) AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT r, size, i, list_slice(w, i, i + size - 1) AS win
       FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT DISTINCT dw.r, dw.i, dw.size, bw.item_id FROM dw JOIN bw USING (size, win)),
marks AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS listed
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marks USING (r) LEFT JOIN items USING (r)
"""


@R.add("op1_decontaminate", _OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@R.add("op2_secrets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


_WORDS = "'[^\\x20\\x09-\\x0D]+'"

_OP3_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
win AS (SELECT r, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
        FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM win JOIN again USING (h)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n
         FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) a ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

_OP5_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_ASCII_LOWER}, {_WORDS}) AS w FROM documents),
grams AS (SELECT DISTINCT r, array_to_string(list_slice(w, i, i + 4), ' ') AS g
          FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
met AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached(r, s) AS (SELECT r, r FROM d UNION SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.s)
SELECT d.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN sizes USING (r) JOIN reached ON reached.r = d.r JOIN d o ON o.r = reached.s GROUP BY d.r, d.doc_id
"""


@R.add("op3_substring_dedup", _OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@R.add("op4_word_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@R.add("op5_jaccard_join", _OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_groups(table(spark, sf_dir, "documents"))


@R.add("op6_html")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


@R.add("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], "base_sha256", "spans")


@R.add("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@R.add("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@R.add("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", F.round("severity", 6).alias("severity"), F.round("p_toxic", 6).alias("p_toxic"), "grade", "toxic")


# CRC-32 (reflected, 0xEDB88320) of a decimal number, a byte and then eight bits at a time.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda s: unicode(s)::BIGINT)),
      lambda c, s: list_reduce([xor(c, s), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295::BIGINT)"""

_OP11_SQL = f"""
WITH own AS (SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS t
             FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hs AS (SELECT c, t, {_CRC.format(x="c")} % 4 AS h FROM own),
seqs AS (SELECT a.c, list_concat(list_slice(coalesce(b.t, []), 1, a.h), list_slice(a.t, a.h + 1, len(a.t))) AS s
         FROM hs a LEFT JOIN own b ON b.c = a.c - a.c % 20),
prefixes AS (SELECT c, len(s) AS n, d, list_slice(s, 1, d) AS p FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends,
                 (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d].text, '[^\\x20\\x09-\\x0D]+')) END AS own_saved
          FROM prefixes GROUP BY d, p),
kids AS (SELECT d - 1 AS d, list_slice(p, 1, d - 1) AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
below AS (SELECT up, list_slice(q.p, 1, up) AS p, sum(own_saved) AS saved, count(*) FILTER (WHERE leaf) AS leaves
          FROM (SELECT n.p, n.own_saved, k.n_children IS NULL AS leaf, unnest(range(0, n.d + 1)) AS up
                FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.p = n.p) q GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.up = n.d AND b.p = n.p LEFT JOIN kids k ON k.d = n.d AND k.p = n.p
     LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = list_slice(n.p, 1, n.d - 1)
"""


@R.add("op11_prefix_trie", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


_OP12_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
q AS (SELECT item_id, row_number() OVER () AS i, regexp_extract_all({_ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS weight FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), s),
qt AS (SELECT i, t, count(*) AS q FROM (SELECT i, unnest(w) AS t FROM q) GROUP BY i, t),
m AS (SELECT r, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms AS m FROM d, s WHERE len(w) > 0),
hits AS (SELECT i, r, sum(q * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
         FROM qt JOIN tf USING (t) JOIN df USING (t) JOIN m USING (r) GROUP BY i, r)
SELECT item_id, rank, doc_id, score
FROM (SELECT i, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM hits JOIN m USING (r) WHERE score > 0)
     JOIN q USING (i) WHERE rank <= 10
"""


@R.add("op12_lexical_search", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@R.add("op13_lm_score")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


R.add("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
