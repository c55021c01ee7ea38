"""The registered queries of this subpackage and, where SQL can express them, their checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import (
    alignment,
    ball_tree,
    decontaminate,
    language,
    line_dedup,
    packing,
    phrases,
    quality,
    secret_scan,
    simhash,
    token_store,
    toxicity,
    url_rules,
)
from tabloom.llm.common import fold, table
from tabloom.llm.token_ids import default_path
from tabloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

# Verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), default_path()))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, labels.filter(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language.fit(language.learned_rows(docs, "doc_id", held_out))
    return language.predict(docs, model, keep=("doc_id",)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, distance=2, seed=42)


@query
def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write_shards(table(spark, sf_dir, "documents"), path, default_path())
    return token_store.read_shards(spark, path)


@query
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = quality.fit(docs, quality.graded(labels.filter(~held_out)))
    return quality.judge(docs, model, top=1).select(
        "doc_id", held_out.alias("held_out"), "expected_grade", "tail_probability",
        (F.col("tail_probability") >= 0.5).alias("selected"),
    )


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, top=2000, cover=80)


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), *alignment.default_paths())


@query
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, ledger = table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger")
    secret_scan.record(docs, ledger)
    return secret_scan.report(secret_scan.findings(docs, ledger))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CHECKS["op1_decontamination"] = f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
items AS (SELECT item, w, least(10, len(w)) AS k FROM item_words WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS run
            FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT k FROM windows),
runs AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS run
         FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, sizes WHERE len(w) >= k)),
found AS (SELECT doc_id, item, r.k, i FROM runs r JOIN windows v ON r.run = v.run AND r.k = v.k),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_KEY = (
    "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
LINE_DEDUP = f"""
lines AS (SELECT r, doc_id, i, line, {_KEY} AS key
          FROM (SELECT r, doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line
                FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
shared AS (SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 AND doc_id IS NOT NULL
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT l.*, coalesce(doc_id < keeper, false) AS drops FROM lines l LEFT JOIN shared USING (key)),
kept AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (drops) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT drops), '') AS text FROM judged GROUP BY r)
"""
CHECKS["op4_line_dedup"] = f"""
WITH {LINE_DEDUP}
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept
"""

CHECKS["op6_topk"] = """
WITH v AS (SELECT vec_id, [floor(1024 * x) for x in CAST(embedding AS DOUBLE[])] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""

CHECKS["op9_url_rules"] = r"""
WITH cut AS (SELECT row_number() OVER () AS r, page_id,
             CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS u FROM pages),
parts AS (SELECT r, page_id,
          translate(coalesce(regexp_extract(u, '(?s)^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          coalesce(regexp_extract(u, '(?s)^[^/?#]*([^?#]*)', 1), '') AS path,
          coalesce(regexp_extract(u, '(?s)^[^?#]*\?([^#]*)', 1), '') AS q FROM cut),
rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (SELECT r, h || p AS rule, verdict FROM parts, rules
         WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
         QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC) = 1),
tokens AS (SELECT DISTINCT r, t FROM (
    SELECT r, 'h:' || unnest(string_split(host, '.')) AS t FROM parts
    UNION ALL SELECT r, 'p:' || unnest(string_split(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '/')) FROM parts
    UNION ALL SELECT r, 'q:' || string_split(unnest(string_split(q, '&')), '=')[1] FROM parts) WHERE length(t) > 2),
learned AS (SELECT r, t, verdict FROM tokens JOIN fits USING (r)),
least AS (SELECT ceil(0.01 * count(DISTINCT r)) AS n FROM learned),
often AS (SELECT t FROM learned GROUP BY t HAVING count(*) >= (SELECT n FROM least)),
l AS (SELECT learned.* FROM learned JOIN often USING (t)),
sets AS (SELECT r, verdict, t AS a, '' AS b, '' AS c FROM l
         UNION ALL SELECT x.r, x.verdict, x.t, y.t, '' FROM l x JOIN l y ON x.r = y.r AND x.t < y.t
         UNION ALL SELECT x.r, x.verdict, x.t, y.t, z.t FROM l x JOIN l y ON x.r = y.r AND x.t < y.t JOIN l z ON z.r = y.r AND y.t < z.t),
seen AS (SELECT a, b, c, count(*) AS seen FROM sets GROUP BY a, b, c),
mined AS (SELECT a, b, c, verdict, count(*) / any_value(seen) AS confidence, any_value(seen) AS seen
          FROM sets JOIN seen USING (a, b, c) GROUP BY a, b, c, verdict
          HAVING count(*) >= (SELECT n FROM least) AND count(*) / any_value(seen) >= 0.8),
others AS (SELECT r, t FROM tokens WHERE r NOT IN (SELECT r FROM fits)),
found AS (SELECT o.r, m.verdict, m.confidence, m.seen, 1 + (b <> '')::INT + (c <> '')::INT AS size FROM others o JOIN mined m ON o.t = m.a
          WHERE (b = '' OR EXISTS (SELECT 1 FROM others x WHERE x.r = o.r AND x.t = m.b))
            AND (c = '' OR EXISTS (SELECT 1 FROM others x WHERE x.r = o.r AND x.t = m.c))),
best AS (SELECT r, verdict FROM found QUALIFY row_number() OVER (PARTITION BY r ORDER BY confidence DESC, seen DESC, size, verdict DESC) = 1)
SELECT page_id, host, path, rule, coalesce(fits.verdict, best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (r) LEFT JOIN best USING (r)
"""

CHECKS["op11_collocations"] = f"""
WITH pieces AS (SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
words AS (SELECT p, lang, unnest(w) AS word, unnest(range(len(w))) AS i
          FROM (SELECT p, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces)),
leads AS (SELECT lang, word AS w1, lead(word, 1) OVER s AS w2, lead(word, 2) OVER s AS w3, lead(word, 3) OVER s AS w4
          FROM words WINDOW s AS (PARTITION BY p ORDER BY i)),
grams AS (SELECT lang, 1 AS size, w1 AS phrase FROM leads
          UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM leads WHERE w2 IS NOT NULL
          UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM leads WHERE w3 IS NOT NULL
          UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM leads WHERE w4 IS NOT NULL),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 30),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (SELECT lang, phrase, size, a, k, array_to_string(w[1:k], ' ') AS p1, array_to_string(w[k + 1:], ' ') AS p2
         FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
scored AS (SELECT x.lang, x.phrase, x.size, x.a, l.f AS l, r.f AS r, x.k,
           CAST((CAST(x.a AS HUGEINT) * 2000000) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
           FROM cuts x JOIN f l ON l.lang = x.lang AND l.phrase = x.p1 JOIN f r ON r.lang = x.lang AND r.phrase = x.p2),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = b.lang AND c.size > b.size AND 100 * CAST(c.a AS HUGEINT) >= 80 * CAST(b.a AS HUGEINT)
    AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


def _secret_sql(kind: str, place: int, pattern: str, least: int, group: int = 0, any_case: bool = False) -> str:
    """Spans of one kind: matches are set between marks, and what stands between marks is measured."""
    text = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')" if any_case else "t"
    quoted = pattern.replace("'", "''")
    return f"""
SELECT r, '{kind}' AS kind, {place} AS place, before AS start, before + length(part) AS stop
FROM (SELECT r, i, part, coalesce(sum(length(part)) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM (SELECT r, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i
            FROM (SELECT r, string_split(regexp_replace({text}, '({quoted})', chr(57344) || '\\1' || chr(57344), 'g'), chr(57344)) AS parts FROM docs)))
WHERE i % 2 = 0 AND length(regexp_extract(part, '{quoted}', {group})) >= {least}"""


_SECRETS = [
    _secret_sql(r.kind, i, r.pattern.replace("A-Za-z0-9+", "a-z0-9+") if r.any_case else r.pattern, r.least, r.group, r.any_case)
    for i, r in enumerate(secret_scan.RULES)
]
CHECKS["op13_secrets"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_SECRETS)}),
joined AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < 3) AS base,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
           FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""
