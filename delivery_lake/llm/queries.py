"""The registered queries of the text operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from delivery_lake.llm import op1_sentencepiece, op11_spelling, op12_conversations, op13_templates, op2_secrets, op3_recompression, op4_fm_index, op5_simhash, op6_lattice_lm, op7_langid, op8_subword_classifier, op9_weak_supervision, op10_suffix_repeats
from delivery_lake.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[key] = query
        if sql:
            ORACLE[key] = sql
        return query
    return keep


@register("op1_sentencepiece")
def op1_sentencepiece_query(spark, sf_dir):
    return op1_sentencepiece.digest(documents(spark, sf_dir))


@register("op2_secrets")
def op2_secrets_query(spark, sf_dir):
    return op2_secrets.digest(documents(spark, sf_dir))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT k, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
least_ids AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT k, p FROM win JOIN least_ids USING (s), unnest(range(i, i + 13)) AS t(p) WHERE m < doc_id),
lists AS (SELECT k, count(*) AS n, list(p) AS ps FROM gone GROUP BY k),
words AS (SELECT d.k, string_agg(w[p], ' ' ORDER BY p) AS kept FROM d, unnest(range(1, len(w) + 1)) AS t(p)
          WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.k = d.k AND g.p = t.p) GROUP BY d.k)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN lists USING (k) LEFT JOIN words USING (k)
"""


@register("op3_substring_dedup", OP3_SQL)
def op3_substring_dedup(spark, sf_dir):
    return op3_recompression.digest(documents(spark, sf_dir))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
       FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.phrase = bw.phrase AND dw.n = bw.n),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT doc_id, n, i FROM hit), unnest(range(i, i + n)) AS t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@register("op4_decontamination", OP4_SQL)
def op4_decontamination(spark, sf_dir):
    return op4_fm_index.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register("op5_simhash")
def op5_simhash_query(spark, sf_dir):
    return op5_simhash.digest(documents(spark, sf_dir))


@register("op6_lattice_lm")
def op6_lattice_lm_query(spark, sf_dir):
    return op6_lattice_lm.digest(documents(spark, sf_dir))


@register("op7_langid")
def op7_langid_query(spark, sf_dir):
    return op7_langid.digest(documents(spark, sf_dir))


@register("op8_subword_classifier")
def op8_subword_classifier_query(spark, sf_dir):
    return op8_subword_classifier.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@register("op9_weak_supervision")
def op9_weak_supervision_query(spark, sf_dir):
    return op9_weak_supervision.digest(documents(spark, sf_dir))


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT k, doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, unnest(range(0, (length(h) // 2) - 49)) AS t(i)),
least_ids AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (SELECT k, i FROM win JOIN least_ids USING (s) WHERE m < doc_id),
ends AS (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS before FROM hit),
runs AS (SELECT k, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY i) AS run FROM ends),
spans AS (SELECT k, run, min(i) AS a, max(i) + 50 AS b, lag(max(i) + 50, 1, 0) OVER (PARTITION BY k ORDER BY run) AS last FROM runs GROUP BY k, run),
cut AS (SELECT k, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
        string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' ORDER BY a) AS head FROM spans JOIN d USING (k) GROUP BY k)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (k)
"""


@register("op10_suffix_repeats", OP10_SQL)
def op10_suffix_repeats_query(spark, sf_dir):
    return op10_suffix_repeats.digest(documents(spark, sf_dir))


#: crc32 of a text's UTF-8 bytes, by the usual table: ``crc_table`` makes it, ``_crc`` uses it.
CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY n) AS t FROM (
  SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(n)))"""


def _crc(text: str) -> str:
    data = f"list_transform(range(strlen({text})), lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


#: Near words by what is left when one code point is deleted: words that lose one at the same place and agree
#: differ by a replacement, a word that another one becomes by losing one by an insertion.
OP11_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS key, w, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents)
  WHERE length(w) >= 6 GROUP BY ALL),
hashed AS (SELECT w, n, {_crc('key')} AS h FROM runs, crc_table),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shorter AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM words, unnest(range(1, length(word) + 1)) AS x(i)),
pairs AS (
  SELECT a.word AS a, b.word AS b, b.n FROM shorter a JOIN shorter b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.v = w.word
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.v = w.word),
best AS (SELECT a, b, n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS k FROM pairs),
found AS (SELECT word, CASE WHEN b.n >= 5 * w.n THEN b END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 5 * w.n THEN b.n END AS form_n
  FROM words w LEFT JOIN best b ON b.a = w.word AND k = 1),
way AS (SELECT word, word AS reached, form AS next FROM found UNION ALL SELECT way.word, found.word, found.form FROM way JOIN found ON way.next = found.word)
SELECT word, form, reached AS root, n, n_near, form_n FROM found JOIN (SELECT word, reached FROM way WHERE next IS NULL) USING (word)
"""


@register("op11_spelling", OP11_SQL)
def op11_spelling_query(spark, sf_dir):
    return op11_spelling.digest(documents(spark, sf_dir))


def _moved(letter: str, state: str) -> str:
    """Cost and audit when a turn stands for a letter behind a state."""
    same = f"initial = '{letter}'"
    return (f"CASE WHEN forced THEN far ELSE {{'c': {state}.c + extra + CASE WHEN {same} THEN 0 ELSE 1 END, "
            f"'a': {state}.a || CASE WHEN {same} THEN 'K' ELSE 'R' END}} END")


def _deleted(state: str) -> str:
    return f"{{'c': {state}.c + 2, 'a': {state}.a || 'D'}}"


#: The cheapest repair turn by turn, by the letter that the conversation has got to (z: none). Insertions are
#: left out: with the kept or rerolled turn beside it an insertion can always be deleted for less.
OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (SELECT *, {_crc('key')} % 20 AS kind FROM src, crc_table),
hurt AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, unnest(CASE kind WHEN 3 THEN [1, 2] WHEN 0 THEN [] ELSE [1] END) AS x(copy)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt),
faults AS (SELECT *, substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
  CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
       WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM placed),
turns AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS forced, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM faults),
way AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': ''}} AS z, {{'c': 100000000, 'a': ''}} AS s, {{'c': 100000000, 'a': ''}} AS u,
         {{'c': 100000000, 'a': ''}} AS a, {{'c': 100000000, 'a': ''}} AS far FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT way.conv_id, t.i, {_deleted('z')},
    list_min([{_deleted('s')}, CASE WHEN forced OR initial <> 's' THEN far ELSE {{'c': z.c + extra, 'a': z.a || 'K'}} END]),
    list_min([{_deleted('u')}, {_moved('u', 'z')}, {_moved('u', 's')}, {_moved('u', 'a')}]),
    list_min([{_deleted('a')}, {_moved('a', 'u')}]), far
  FROM way JOIN turns t ON t.conv_id IS NOT DISTINCT FROM way.conv_id AND t.i = way.i + 1),
ends AS (SELECT conv_id, list_min([z, a]) AS best FROM way
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
edits AS (SELECT t.conv_id, t.i, role, text, substr(best.a, CAST(t.i AS INTEGER), 1) AS edit FROM turns t JOIN ends e ON t.conv_id IS NOT DISTINCT FROM e.conv_id),
left_ AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS j, count(*) OVER (PARTITION BY conv_id) AS m FROM edits WHERE edit <> 'D'),
texts AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j + m) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j) AS repaired
  FROM left_ GROUP BY conv_id),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
  count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
  count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@register("op12_conversations", OP12_SQL)
def op12_conversations_query(spark, sf_dir):
    return op12_conversations.digest(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@register("op13_templates")
def op13_templates_query(spark, sf_dir):
    return op13_templates.digest(spark.read.parquet(f"{sf_dir}/pages.parquet"))
