"""The registered queries of the operators, and DuckDB SQL where it can say
the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    chaining,
    chat,
    decontaminate,
    filter_audit,
    fim,
    host_rules,
    html_extract,
    langid,
    mixing,
    nbsvm,
    pii,
    pitman_yor,
    simhash,
)
from tessera.llm.common import table


def op1_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_rules(table(spark, sf_dir, "documents"))


def op3_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"))


def op8_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts hold the marks."""
    marked = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", marked), (-1, 1, "assistant", marked)],
        "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(rows.unionByName(extra))


def op9_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_fim_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op12_filter_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_word_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.classify(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_site_templates": op1_site_templates,
    "op2_host_rules": op2_host_rules,
    "op3_nbsvm": op3_nbsvm,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_pii": op6_pii,
    "op7_pitman_yor": op7_pitman_yor,
    "op8_prefix_targets": op8_prefix_targets,
    "op9_collinear_chains": op9_collinear_chains,
    "op10_mixing": op10_mixing,
    "op11_fim_sort": op11_fim_sort,
    "op12_filter_diagrams": op12_filter_diagrams,
    "op13_word_backoff": op13_word_backoff,
}

_OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT k, doc_id, source, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
g AS (
  SELECT k, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
s AS (
  SELECT k, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] AS z FROM g),
t AS (SELECT k, i, count(*) OVER (PARTITION BY k, z) AS c FROM s),
r AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT k, unnest(range(i, i + 5)) AS p FROM t WHERE c > 1) GROUP BY k),
m AS (
  SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(n_symbols AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines
  FROM w LEFT JOIN r USING (k)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
f AS (
  SELECT *, base_failed OR n_symbols * 5 > n_words OR n_dup_lines * 3 > n_lines
            OR word_chars < n_words * 2 OR word_chars > n_words * 15 AS failed FROM b),
h AS (
  SELECT source AS host, CAST(count(*) AS DOUBLE) AS n,
         CAST(sum(CAST(failed AS INT)) AS DOUBLE) AS f FROM f GROUP BY source),
p0 AS (SELECT sum(f) / sum(n) AS m FROM h),
p1 AS (SELECT max(m) AS m, sum(n * (f / n - m) * (f / n - m)) / sum(n) AS v FROM h, p0),
p AS (SELECT m, CASE WHEN v * 10000 <= m * (1 - m) THEN 10000
                     ELSE greatest(1, m * (1 - m) / v - 1) END AS k FROM p1),
q AS (SELECT host, (f + m * k) / (n + k) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       round(rate, 9) AS host_rate,
       CASE WHEN rate >= 0.8 THEN 'blocked' WHEN rate >= 0.3 THEN 'strict' ELSE 'open' END AS host_verdict,
       NOT base_failed AND rate < 0.8 AND NOT (rate >= 0.3 AND failed) AS kept
FROM f JOIN q ON f.source IS NOT DISTINCT FROM q.host
"""

_OP4 = r"""
WITH i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                              lambda x: x <> '') AS w FROM benchmark),
i2 AS (SELECT item_id, w, least(len(w), 5) AS width FROM i WHERE len(w) > 0),
a AS (
  SELECT DISTINCT item_id, width, array_to_string(w[p:p + width - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS p FROM i2)),
n AS (SELECT item_id, count(*) AS n_shingles FROM a GROUP BY item_id),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                             lambda x: x <> '') AS w FROM documents),
v AS (SELECT DISTINCT width FROM a),
b AS (
  SELECT DISTINCT doc_id, width, array_to_string(w[p:p + width - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS p FROM d, v WHERE len(w) >= width)),
c AS (
  SELECT doc_id, item_id, count(*) AS n_matched
  FROM a JOIN b USING (width, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_matched,
       CAST(n_matched AS DOUBLE) / CAST(n_shingles AS DOUBLE) AS containment
FROM c JOIN n USING (item_id) WHERE CAST(n_matched AS DOUBLE) / CAST(n_shingles AS DOUBLE) >= 0.8
"""

_OP8 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
o AS (
  SELECT *, row_number() OVER (
      PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    23 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
       + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 1 AS n FROM c),
s AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY k) AS upto,
    max(k) OVER (PARTITION BY conv_id) AS last FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR k = last THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""

_OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
f AS (
  SELECT doc_id, text, n, u, least(h1 % (n + 1), h2 % (n + 1)) AS a,
         greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p,
         array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM f)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

_OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good,
             max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic FROM labels GROUP BY doc_id),
s AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(w) < 50 AS fa, 100 * len(list_distinct(w)) < 65 * len(w) AS fb,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS fc,
    regexp_matches(text, '[#$%&*|]') AS fd, coalesce(d.doc_id > first, false) AS fe
  FROM d JOIN s USING (text) LEFT JOIN g ON g.doc_id = d.doc_id),
c AS (
  SELECT part, (CASE WHEN fa THEN 'A' ELSE '' END) || (CASE WHEN fb THEN 'B' ELSE '' END)
      || (CASE WHEN fc THEN 'C' ELSE '' END) || (CASE WHEN fd THEN 'D' ELSE '' END)
      || (CASE WHEN fe THEN 'E' ELSE '' END) AS fails,
    count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
t AS (
  SELECT filter_order, i AS step, filter_order[i] AS f, filter_order[1:i - 1] AS before
  FROM o, unnest(range(1, 6)) AS r(i)),
r AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN translate(fails, before || f, '') = fails THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, f) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, t GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""

ORACLE_SQL: dict[str, str] = {
    "op2_host_rules": _OP2,
    "op4_decontaminate": _OP4,
    "op8_prefix_targets": _OP8,
    "op11_fim_sort": _OP11,
    "op12_filter_diagrams": _OP12,
}
