"""The operators applied to whole tables, as the check runs them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dropsieve.llm import bpe, conversation, divergence, langid, minhash, packing, pii, quality, rules, substring, suffix, topk, toxicity
from dropsieve.llm.common import fold, table

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def _held_out() -> Column:
    return F.coalesce(F.expr(f"{fold()} = 0"), F.lit(False)).alias("held_out")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, *quality.learning_ids(docs, labels))
    return quality.predict(docs, model).select("*", _held_out())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"), length=50)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path(RANKS))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, toxicity.learning_labels(labels))
    return toxicity.predict(docs, model).select("*", _held_out())


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.learning_rows(docs))
    held = F.coalesce(F.expr(f"{fold(folds=4)} = 2"), F.lit(False)).alias("held_out")
    return langid.predict(docs, model).select("*", held)


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = rules.ledger(table(spark, sf_dir, "documents"))
    base = rules.POLICIES["base"]
    return led.selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures"
    ).select(
        "*",
        (~base.kept()).alias("base_failed"),
        rules.POLICIES["v1"].kept().alias("kept"),
    )


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), query="vec_id % 50 = 0", k=5)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.report(table(spark, sf_dir, "documents"), length=400)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation.damaged(table(spark, sf_dir, "conversations"))
    return conversation.repair(turns, copies="copies")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_substring_dedup,
        op3_bpe,
        op4_toxicity,
        op5_language,
        op6_rules,
        op7_top_k,
        op8_packing,
        op9_near_dedup,
        op10_suffix_dedup,
        op11_pii,
        op12_conversations,
        op13_divergence,
    )
}

_OP6 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
      FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 3)) AS i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, range(5) AS t(k) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
u AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines,
             len(regexp_extract_all(text, '[A-Z]')) AS n_upper
      FROM w LEFT JOIN c USING (doc_id) LEFT JOIN u USING (doc_id)),
f AS (SELECT *, {bits} AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       CAST(failures AS BIGINT) AS failures, failures & 3 <> 0 AS base_failed, failures = 0 AS kept
FROM f
"""

_OP7 = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM e AS q JOIN e AS d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id AND len(q.v) = len(d.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP2 = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
      FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 48)) AS i)),
r AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS m FROM g) WHERE m < doc_id),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM r, range(50) AS t(k)),
n AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
k AS (SELECT w.doc_id, ws, coalesce(len(gone), 0) AS n_removed,
             CASE WHEN gone IS NULL THEN ws
                  ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END AS kept
      FROM w LEFT JOIN n USING (doc_id))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM k
"""

# Places follow from the lengths of the matches and of the pieces between them.
_OP11 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
           FROM documents),
p AS (SELECT * FROM (VALUES
  (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
  (2, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
  (3, 'card', '[0-9]([\x20-]?[0-9])+'),
  (4, 'phone', '\+[0-9][\x20().0-9-]+[0-9]'),
  (5, 'address', '{address}'),
  (6, 'account', '{account}'),
  (7, 'iban', '{iban}')) AS v(k, kind, re)),
m AS (SELECT r, k, kind, regexp_extract_all(CASE WHEN k < 5 THEN t ELSE low END, re) AS ms,
             string_split_regex(CASE WHEN k < 5 THEN t ELSE low END, re) AS ps FROM d, p),
u AS (SELECT r, k, kind, ms[i] AS m,
             list_sum(list_transform(ps[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS pos
      FROM m, LATERAL (SELECT unnest(range(1, len(ms) + 1)) AS i)),
w AS (SELECT r, k, kind, pos + length(m) AS stop,
             CASE k WHEN 6 THEN regexp_extract(m, '[a-z0-9]+(-[a-z0-9]+)*$')
                    WHEN 7 THEN regexp_extract(m, 'iban[\x20]*[=:#]?[\x20]*(.*)$', 1) ELSE m END AS s FROM u),
x AS (SELECT *, regexp_replace(s, '[^0-9]', '', 'g') AS ds, replace(s, ' ', '') AS z FROM w),
y AS (SELECT r, k, kind, stop - length(s) AS start, stop FROM x WHERE CASE k
  WHEN 2 THEN len(list_filter(string_split(s, '.'), lambda o: length(ltrim(o, '0')) > 3
                                OR coalesce(TRY_CAST(o AS BIGINT), 999) > 255)) = 0
  WHEN 3 THEN length(ds) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(ds) + 1), lambda i:
    CASE WHEN i % 2 = 1 THEN CAST(ds[-i] AS INTEGER)
         ELSE 2 * CAST(ds[-i] AS INTEGER) - CASE WHEN ds[-i] > '4' THEN 9 ELSE 0 END END)) % 10 = 0
  WHEN 4 THEN length(ds) BETWEEN 10 AND 15
  WHEN 5 THEN NOT starts_with(s, 'tel:') OR length(ds) BETWEEN 7 AND 15
  WHEN 6 THEN length(replace(s, '-', '')) >= 8 AND length(ds) > 0
  WHEN 7 THEN length(z) BETWEEN 15 AND 34 AND list_reduce(list_transform(string_split(z[5:] || z[1:4], ''),
    lambda c: CASE WHEN c >= 'a' THEN ascii(c) - 87 ELSE ascii(c) - 48 END),
    lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97, 0) = 1
  ELSE true END),
s AS (SELECT r, count(*) FILTER (k = 1) AS n_email, count(*) FILTER (k = 2) AS n_ip,
             count(*) FILTER (k = 3) AS n_card, count(*) FILTER (k = 4) AS n_phone,
             string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, k) FILTER (k < 5) AS base,
             string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, k) AS spans
      FROM y GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (r)
"""

# Backward and forward passes as recursive queries; b0 to b3 are the costs from the four states.
_OP12 = r"""
WITH RECURSIVE
t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             list_transform(string_split(concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':',
                            coalesce(CAST(turn AS VARCHAR), ' ')), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS place
      FROM conversations),
k AS (SELECT *, xor(list_reduce(place, lambda a, b: list_reduce(range(8), lambda v, n:
        CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(a, b)),
        CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS k FROM t),
m AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
             CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM k, range(2) AS c(c) WHERE k <> 0 AND (c = 0 OR k = 3)),
o AS (SELECT *, coalesce(conv_id, -9223372036854775807) AS conv,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                md5(concat(length(role), ':', role, text))) AS i FROM m),
f AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
             row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
             regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut,
             left(role, 1) AS r, lead(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS r2 FROM o),
g AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
             count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
             count(*) FILTER (r2 IS NOT NULL AND r || r2 NOT IN ('su', 'ua', 'au')) AS illegal,
             count(*) AS n FROM f GROUP BY conv),
e AS (SELECT conv, i, role, text, r, CASE WHEN blank OR again THEN 1000000000 ELSE 0 END AS stay,
             CASE WHEN cut THEN 1 ELSE 0 END AS c FROM f),
b(conv, i, b0, b1, b2, b3) AS (
  SELECT conv, n + 1, 0, 4, 2, 0 FROM g
  UNION ALL
  SELECT conv, i, least(a0, 2 + a2, 4 + a3), least(a1, 2 + a2, 4 + a3), least(a2, 2 + a3), least(a3, 2 + a2)
  FROM (SELECT conv, e.i,
          least(3 + b0, stay + c + CASE r WHEN 's' THEN least(b1, 2 + b2) WHEN 'u' THEN b2 ELSE 2 + b2 END) AS a0,
          least(3 + b1, stay + c + CASE WHEN r = 'u' THEN 0 ELSE 2 END + b2) AS a1,
          least(3 + b2, stay + c + CASE WHEN r = 'a' THEN 0 ELSE 2 END + b3) AS a2,
          least(3 + b3, stay + c + CASE WHEN r = 'u' THEN 0 ELSE 2 END + b2) AS a3
        FROM b JOIN e USING (conv) WHERE e.i = b.i - 1)),
v AS (SELECT b.conv, b.i, [b.b0, b.b1, b.b2, b.b3] AS here, [n.b0, n.b1, n.b2, n.b3] AS after, e.role, e.text, e.r,
             e.c, e.stay = 0 AS may
      FROM b LEFT JOIN b AS n ON n.conv = b.conv AND n.i = b.i + 1
      LEFT JOIN e ON e.conv = b.conv AND e.i = b.i),
w(conv, i, s, audit, lines, stop) AS (
  SELECT conv, 1, 1, '', CAST([] AS VARCHAR[]), false FROM g
  UNION ALL
  SELECT conv, CASE WHEN edit IN ('I', 'E') THEN i ELSE i + 1 END,
         CASE WHEN edit IN ('D', 'E') THEN s WHEN edit = 'K' AND s = 1 AND r = 's' THEN 2 ELSE nx END,
         audit || CASE WHEN edit = 'E' THEN '' ELSE edit END,
         CASE edit WHEN 'K' THEN list_append(lines, role || ':' || text)
                   WHEN 'R' THEN list_append(lines, new || ':' || text)
                   WHEN 'I' THEN list_append(lines, new || ':') ELSE lines END,
         edit = 'E'
  FROM (SELECT w.*, v.role, v.text, v.r, CASE WHEN s = 3 THEN 4 ELSE 3 END AS nx,
               CASE WHEN s = 3 THEN 'assistant' ELSE 'user' END AS new,
               CASE WHEN after[1] IS NOT NULL AND 3 + after[s] = here[s] THEN 'D'
                    WHEN 2 + here[CASE WHEN s = 3 THEN 4 ELSE 3 END] = here[s] THEN 'I'
                    WHEN after[1] IS NULL THEN 'E'
                    WHEN may AND (CASE WHEN s = 3 THEN r = 'a' ELSE r = 'u' END OR s = 1 AND r = 's')
                         AND c + after[CASE WHEN s = 1 AND r = 's' THEN 2 WHEN s = 3 THEN 4 ELSE 3 END] = here[s] THEN 'K'
                    ELSE 'R' END AS edit
        FROM w JOIN v USING (conv, i) WHERE NOT stop))
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b0, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id, -9223372036854775807) AS conv FROM conversations) AS a
LEFT JOIN g USING (conv) LEFT JOIN b ON b.conv = a.conv AND b.i = 1 LEFT JOIN w ON w.conv = a.conv AND stop
"""

_OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  coalesce(text, '') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(
        translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
m AS (SELECT lang, source, term, coalesce(c.n, 0) AS n,
             sum(coalesce(c.n, 0)) OVER (PARTITION BY lang, source) AS total, k.n AS lang_n
      FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, m.n,
             CAST(1 + (1000000000 * (CAST(m.n AS HUGEINT) + 2)) // (total + 2 * v) AS HUGEINT) AS p,
             CAST(1 + (1000000000 * (CAST(lang_n AS HUGEINT) + 2)) // (v.n + 2 * v) AS HUGEINT) AS q
      FROM m JOIN v USING (lang)),
a AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
      FROM p AS x JOIN p AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
      FROM g AS x JOIN g AS y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value
      FROM p WHERE n > 0 AND p > q),
u AS (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM u QUALIFY part = 'pair' OR rank <= 10
"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


ORACLE_SQL: dict[str, str] = {
    "op11_pii": _OP11.format(
        address=_quoted("|".join(f"{s}{p}" for s, p in pii.SCHEMES.items())),
        account=_quoted(f"(^|[^a-z0-9_-])({'|'.join(pii.CUES)}){pii.ACCOUNT}"),
        iban=_quoted(f"(^|[^a-z0-9_-])iban{pii.IBAN}"),
    ),
    "op12_conversations": _OP12,
    "op13_divergence": _OP13,
    "op2_substring_dedup": _OP2,
    "op7_top_k": _OP7,
    "op6_rules": _OP6.format(
        bits=" + ".join(
            f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, (_, rule) in enumerate(rules.RULES)
        )
    ),
}
