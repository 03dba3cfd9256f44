"""Registered queries of this subpackage, and their reference SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import decontaminate, exact_dedup, html_wrapper, language, lexical, mixing, ngram_join, pii, resample, substring_dedup, turn_trie, vectors, warc
from ebbtide.llm.common import documents, pages

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query()
def op1_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.coalesce(good, F.lit(False)).alias("is_target"))
    ratio = resample.fit(docs, labels.where("is_target").select("doc_id"))
    return resample.resample(docs, ratio, resample.sample_size(docs, labels))


@query(r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k, md5(coalesce(text, '')) AS tie
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS t, sum(w) OVER () AS ws,
         coalesce(sum(3 * source_size) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before
  FROM s WINDOW o AS (ORDER BY 3 * source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, cap::DOUBLE * (ws - w_before)::DOUBLE <= w::DOUBLE * (t - cap_before)::DOUBLE AS capped FROM c),
g AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE
         (t - coalesce(sum(cap) FILTER (capped) OVER (), 0))::DOUBLE * w
         / nullif(ws - coalesce(sum(w) FILTER (capped) OVER (), 0), 0)::DOUBLE END AS target FROM b),
p AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)::BIGINT ELSE 0 END AS whole
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, floor(target - whole * source_size + 0.5)::BIGINT - before)))::BIGINT AS taken
FROM p""")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return mixing.mix_sources(docs, carry=["doc_id", "source"]).select("doc_id", "size", "source_size", "target", "taken")


@query(rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, least(10, len(w)) AS m
  FROM benchmark WHERE item_id IS NOT NULL),
p AS (
  SELECT DISTINCT item_id, m, array_to_string(w[k : k + m - 1], ' ') AS gram
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM i WHERE m > 0)),
h AS (
  SELECT r, k, c.m, array_to_string(w[k : k + c.m - 1], ' ') AS gram
  FROM (SELECT d.r, d.w, l.m, unnest(range(1, len(d.w) - l.m + 2)) AS k FROM d, (SELECT DISTINCT m FROM p) l) c),
o AS (SELECT h.r, h.k, h.m, p.item_id FROM h JOIN p USING (m, gram)),
n AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(k, k + m)) AS word FROM o) GROUP BY r),
e AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM o) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(e.n_items, 0) AS n_items,
       sha256(coalesce(e.ids, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN e USING (r)""")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.benchmark_hits(
        documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query(r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
m AS (
  SELECT r, 0 AS kind, string_split_regex(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS p,
         regexp_extract_all(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS v FROM t
  UNION ALL SELECT r, 1, string_split_regex(x, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), regexp_extract_all(x, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') FROM t
  UNION ALL SELECT r, 2, string_split_regex(x, '[0-9]([\x20-]?[0-9])+'), regexp_extract_all(x, '[0-9]([\x20-]?[0-9])+') FROM t
  UNION ALL SELECT r, 3, string_split_regex(x, '\+[0-9][\x20().0-9-]+[0-9]'), regexp_extract_all(x, '\+[0-9][\x20().0-9-]+[0-9]') FROM t),
c AS (
  SELECT r, kind, v[i] AS value, regexp_replace(v[i], '[^0-9]', '', 'g') AS digits, p[i] AS b, p[i + 1] AS a,
         sum(length(p[i]) + length(v[i])) OVER (PARTITION BY r, kind ORDER BY i) AS stop
  FROM (SELECT r, kind, p, v, unnest(range(1, len(v) + 1)) AS i FROM m)),
base AS (
  SELECT r, kind, stop - length(value) AS start, stop, lower(value) AS value
  FROM c
  WHERE CASE kind WHEN 0 THEN true
    WHEN 1 THEN list_bool_and(list_transform(string_split(value, '.'), lambda q: length(ltrim(q, '0')) <= 3 AND coalesce(try_cast(left(ltrim(q, '0'), 3) AS INTEGER), 0) <= 255))
    WHEN 2 THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN substr(reverse(digits), i, 1)::INTEGER
           WHEN substr(reverse(digits), i, 1)::INTEGER > 4 THEN substr(reverse(digits), i, 1)::INTEGER * 2 - 9
           ELSE substr(reverse(digits), i, 1)::INTEGER * 2 END)) % 10 = 0
    ELSE length(digits) BETWEEN 8 AND 15 END),
n AS (SELECT count(*)::DOUBLE AS total FROM t),
held AS (SELECT DISTINCT r, kind, value FROM base),
vals AS (SELECT kind, value, count(*) AS n_value FROM held GROUP BY ALL HAVING count(*) >= 2),
words AS (SELECT r, unnest(list_distinct(regexp_extract_all(lower(x), '\p{L}+'))) AS term FROM t),
pairs AS (SELECT r, kind, value, term FROM held JOIN vals USING (kind, value) JOIN words USING (r)),
near AS (
  SELECT kind, value, term, both_n, n_value
  FROM (SELECT kind, value, term, count(*) AS both_n FROM pairs GROUP BY ALL HAVING count(*) >= 2) JOIN vals USING (kind, value), n WHERE n_value < total),
spread AS (SELECT term, count(*) AS n_term FROM words WHERE term IN (SELECT term FROM near) GROUP BY term),
disclosing AS (
  SELECT kind, value, term, round(ln(both_n * total / (n_value * n_term)) / ln(total / n_value), 6) AS d FROM near JOIN spread USING (term), n),
terms AS (SELECT DISTINCT r, term FROM pairs JOIN disclosing USING (kind, value, term) WHERE d >= 0.9),
w AS (
  SELECT r, lower(v[i]) AS term, length(v[i]) AS size, sum(length(p[i]) + length(v[i])) OVER (PARTITION BY r ORDER BY i) AS stop
  FROM (SELECT r, p, v, unnest(range(1, len(v) + 1)) AS i FROM (
    SELECT r, string_split_regex(x, '\p{L}+') AS p, regexp_extract_all(x, '\p{L}+') AS v FROM t WHERE r IN (SELECT r FROM terms)))),
spans AS (
  SELECT r, kind, start, stop FROM base
  UNION ALL SELECT w.r, 4, w.stop - w.size, w.stop FROM w JOIN terms USING (r, term)
  WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.r = w.r AND base.start < w.stop AND base.stop > w.stop - w.size)),
g AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip, count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone,
         string_agg(['email', 'ip', 'card', 'phone', 'term'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY kind, start) AS spans,
         string_agg(['email', 'ip', 'card', 'phone'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY kind, start) FILTER (kind < 4) AS base
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (r)""")
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_columns(pii.personal_spans(documents(spark, sf_dir).select("doc_id", "text")))


@query()
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir).select("doc_id", "text"))


@query()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out()))
    return language.identify(docs, model).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
c AS (
  SELECT page_id, h, x, list_transform(range(8), lambda k: ('0x' || x[5 * k + 1 : 5 * k + 5])::BIGINT) AS g, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, strlen(h) AS payload_bytes,
       array_to_string(list_transform(g, lambda v: array_to_string(list_transform([15, 10, 5, 0],
         lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INTEGER + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM c""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captures(pages(spark, sf_dir)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(pages(spark, sf_dir))


@query(f"""
WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marked = exact_dedup.exact_duplicates(docs, carry=["doc_id"])
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, {TERMS}) AS w FROM documents),
n AS (SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
s AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_words FROM n),
i AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all({LOWERED}, {TERMS})) AS t FROM benchmark) GROUP BY ALL),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY ALL),
v AS (SELECT t, floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY t, all_docs),
x AS (
  SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_docs) // all_words))) AS share
  FROM p JOIN v USING (t) JOIN n USING (r), s),
y AS (SELECT item_id, r, sum(c * share)::BIGINT AS score FROM i JOIN x USING (t) GROUP BY ALL),
z AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM y JOIN n USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM z WHERE rank <= 20""")
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return lexical.ranked_documents(documents(spark, sf_dir).select("doc_id", "text"), bench)


# Rebuilt conversations as lists of turns; a node is named by md5 of its turns, each turn by md5 of role and text.
@query("""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || chr(0) || coalesce(text, ''))) AS j,
         md5(coalesce(role, '') || chr(0) || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS b
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(k ORDER BY j) AS k, list(b ORDER BY j) AS b FROM t GROUP BY c),
h AS (
  SELECT c, k, b, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda r, x: list_reduce(list_concat([xor(r, x)], range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 9 AS h FROM o),
r AS (
  SELECT h.c, list_concat(coalesce(f.k[1:h.h], []), h.k[h.h + 1:]) AS k, list_concat(coalesce(f.b[1:h.h], []), h.b[h.h + 1:]) AS b
  FROM h LEFT JOIN o f ON f.c = h.c - h.c % 5),
p AS (SELECT c, d, md5(array_to_string(k[1:d], '')) AS id, CASE WHEN d = 0 THEN 0 ELSE b[d] END AS b, len(k) = d AS last FROM r, unnest(range(0, len(k) + 1)) u(d)),
n AS (
  SELECT d, id, min(c) AS conv_id, count(*) AS n_convs, max(b) AS b, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM p GROUP BY d, id),
x AS (SELECT n.*, q.id AS above, m.conv_id AS parent_conv_id FROM n LEFT JOIN p q ON q.c = n.conv_id AND q.d = n.d - 1 LEFT JOIN n m ON m.d = q.d AND m.id = q.id),
k AS (SELECT d - 1 AS d, above AS id, count(*) AS n_children FROM x WHERE d > 0 GROUP BY ALL),
s AS (
  SELECT q.d, q.id, count(*) FILTER (k.id IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.b)::BIGINT AS saved_tokens
  FROM x LEFT JOIN k ON k.d = x.d AND k.id = x.id JOIN p q ON q.c = x.conv_id AND q.d <= x.d GROUP BY ALL)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, ends_sha256
FROM x JOIN s USING (d, id) LEFT JOIN k USING (d, id)""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))


@query()
def op13_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
