"""The registered query of every operator, and its SQL where SQL can say it."""

import corpus_pipeline
from campuswatt.llm import (byte_pairs, cube_mixing, hnsw, jaccard_join, license_scan, packing, paragraph_dedup, quality_cascade,
                            quality_classifier, shallot, suffix_dedup, variants, warc)
from campuswatt.llm.common import table


def op1_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def op2_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_hnsw_neighbours(spark, sf_dir):
    return hnsw.neighbours(table(spark, sf_dir, "embeddings"))


def op4_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.links(table(spark, sf_dir, "documents")).drop("row")


def op5_paragraph_dedup(spark, sf_dir):
    return paragraph_dedup.repeats(table(spark, sf_dir, "documents"))


def op6_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op7_cube_mixing(spark, sf_dir):
    return cube_mixing.mix(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op9_warc_salvage(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_quality_cascade(spark, sf_dir):
    return quality_cascade.assess(table(spark, sf_dir, "documents"))


def op11_shallot_clusters(spark, sf_dir):
    return shallot.assignments(table(spark, sf_dir, "embeddings"))


def op12_byte_pairs(spark, sf_dir):
    return byte_pairs.round_trip(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark, sf_dir):
    return variants.variants(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""

_TEMPLATES = ", ".join(f"('{label}', ['" + "', '".join(sorted(set(words.split(" ")))) + "'])" for label, words in license_scan.TEMPLATES.items())

OP6_SQL = r"""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
words AS (SELECT doc_id, low, regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
places AS (
  SELECT doc_id, w, list_filter(range(len(w)), lambda i: w[i + 1] = 'cc' AND w[i + 2] = 'by') AS cc,
    list_filter(range(len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS gpl,
    list_filter(range(len(w)), lambda i: w[i + 1] = 'all' AND w[i + 2] = 'rights' AND w[i + 3] = 'reserved') AS res
  FROM words),
templates(label, words) AS (VALUES TEMPLATES),
enough AS (SELECT doc_id, w, label, t.words AS ws, len(t.words) AS n FROM words, templates t WHERE 100 * len(list_intersect(w, t.words)) >= 80 * len(t.words)),
blocks AS (SELECT doc_id, label, ws, n, w[i:i + 2 * n - 1] AS block FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM enough)),
held AS (SELECT doc_id, label, len(list_intersect(block, ws)) AS k, n FROM blocks),
own AS (SELECT doc_id, list(DISTINCT label) AS labels, max(k / n) AS share FROM held WHERE 100 * k >= 80 * n GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, (len(cc) + len(gpl) + len(res))::BIGINT AS n_base,
    list_min(list_concat(cc, gpl, res))::BIGINT AS first_word, list_max(list_concat(cc, gpl, res))::BIGINT AS last_word,
    list_concat(CASE WHEN len(cc) > 0 THEN ['cc-by'] ELSE [] END, CASE WHEN len(gpl) > 0 THEN ['gpl'] ELSE [] END,
                CASE WHEN len(res) > 0 THEN ['reserved'] ELSE [] END) AS labels
  FROM places)
SELECT b.doc_id, n_words, n_base, first_word, last_word, array_to_string(b.labels, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(b.labels, coalesce(o.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM base b LEFT JOIN own o USING (doc_id)
""".replace("TEMPLATES", _TEMPLATES)

OP8_SQL = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, length(h) // 2 AS n FROM t),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS s FROM (SELECT doc_id, h, unnest(range(n - 199)) AS i FROM n WHERE n >= 200)),
r AS (SELECT doc_id, i FROM w WHERE s IN (SELECT s FROM w GROUP BY s HAVING count(*) > 1)),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM r),
k AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 200 AS b FROM k GROUP BY ALL),
cut AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n_spans, max(b) AS tail FROM spans GROUP BY doc_id),
parts AS (
  SELECT s.doc_id, a, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0) + 1,
    2 * (a - coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0))) AS part FROM spans s JOIN n USING (doc_id)),
heads AS (SELECT doc_id, string_agg(part, '' ORDER BY a) AS head FROM parts GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN head IS NULL THEN h ELSE head || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM n LEFT JOIN cut USING (doc_id) LEFT JOIN heads USING (doc_id)
"""

OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM f
"""

OP10_SQL = r"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM words WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM runs) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice CROSS JOIN range(5) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup FROM (
    SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words)),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, n_dup::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters
  FROM words LEFT JOIN covered c USING (doc_id) JOIN lines USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 20 * n_words AND 10 * n_symbols <= 3 * n_words
  AND 10 * n_dup_lines <= 5 * n_lines AND 10 * upper <= 6 * letters AS kept
FROM judged
"""

def _op11_sql(clusters=8, rounds=10, seed=3, components=64):
    """Lloyd's rounds written out one after another; whole numbers as doubles, exact below 2^53."""
    inner = "list_inner_product"
    parts = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT {clusters}))"""]
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d::HUGEINT * {clusters} + c) AS m
  FROM (SELECT k.r, k.vec_id, k.v, c.c, {inner}(k.v, k.v) - 2 * {inner}(k.v, c.v) + {inner}(c.v, c.v) AS d FROM kept k, c{k} c) GROUP BY r)""")
        if k < rounds:
            parts.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(n.v, c.v) AS v FROM c{k} c LEFT JOIN (
    SELECT c, list(floor(s / n) ORDER BY i) AS v FROM (
      SELECT m % {clusters} AS c, i, sum(x) AS s, count(*) AS n FROM (SELECT m, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k}) GROUP BY ALL)
    GROUP BY c) n ON n.c = c.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, (m % {clusters})::INTEGER AS cluster, (m // {clusters})::BIGINT AS distance,
  (sum(m // {clusters}) OVER (PARTITION BY m % {clusters}))::BIGINT AS cluster_inertia, (sum(m // {clusters}) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.m % {clusters}"""


OP11_SQL = _op11_sql()

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_hnsw_neighbours": op3_hnsw_neighbours,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_paragraph_dedup": op5_paragraph_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_cube_mixing": op7_cube_mixing,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_warc_salvage": op9_warc_salvage,
    "op10_quality_cascade": op10_quality_cascade,
    "op11_shallot_clusters": op11_shallot_clusters,
    "op12_byte_pairs": op12_byte_pairs,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op6_license_scan": OP6_SQL,
    "op8_suffix_array_dedup": OP8_SQL,
    "op9_warc_salvage": OP9_SQL,
    "op4_ngram_jaccard_join": OP4_SQL,
    "op10_quality_cascade": OP10_SQL,
    "op11_shallot_clusters": OP11_SQL,
}
