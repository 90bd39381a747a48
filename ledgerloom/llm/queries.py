"""The registered queries of this subpackage: each applies one operator, with its production settings, to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    compression, cross_parsing, decontaminate, fill_middle, html_text, licenses, mixing, ns_clusters, pii, preferences, quality_rules, simhash, url_filter)
from ledgerloom.llm.shared import table
from ledgerloom.llm.url_filter import Rule

#: The rules that the url query applies.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: The surrogates' key for the test tables, which hold no one's data; a corpus has its own, kept secret.
TEST_KEY = b"key of the test tables"
#: The blocklist of the url query.
BLOCKED_DOMAINS = tuple(
    f"{site}.example.{top}" for site in ("ads-track", "adult-x", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = spark.createDataFrame([(d,) for d in BLOCKED_DOMAINS], "key string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES, blocked)


def op7_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree, ten to a directory and ten of those to one above; every tenth is its directory's licence file,
    and every hundredth lies in the directory above."""
    n = F.col("doc_id")
    above, below = F.concat(F.lit("c"), F.floor(n / 100)), F.concat(F.lit("/d"), F.floor(n / 10) % 10)
    path = F.when(n % 100 == 0, F.concat(above, F.lit("/LICENSE"))).when(n % 10 == 0, F.concat(above, below, F.lit("/LICENSE"))).otherwise(
        F.concat(above, below, F.lit("/f"), n, F.lit(".txt")))
    return licenses.scan_licences(table(spark, sf_dir, "documents").withColumn("path", path))


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.anonymised(table(spark, sf_dir, "documents"), TEST_KEY)


def op10_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against one that branches off it; the table has no preferences."""
    convs = preferences.conversations(table(spark, sf_dir, "conversations"))
    rows = preferences.preference_rows(preferences.branched_pairs(convs))
    return rows.select(
        F.col("pair_id").alias("conv_id"), "n_common", "prompt",
        *[x for c in ("chosen", "rejected") for x in (preferences.rendered(F.col(c)).alias(c), preferences.trained_text(F.col(c)).alias(f"{c}_trained"))])


def op11_ns_bounds_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ns_clusters.clustered(table(spark, sf_dir, "embeddings"))


def op12_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_parsing.languages(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.middle_digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_pareto_mixing": op2_pareto_mixing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_url_filter": op6_url_filter,
    "op7_compression_classifier": op7_compression_classifier,
    "op8_license_scan": op8_license_scan,
    "op9_pii_surrogates": op9_pii_surrogates,
    "op10_preference_formatting": op10_preference_formatting,
    "op11_ns_bounds_clustering": op11_ns_bounds_clustering,
    "op12_cross_parsing_language": op12_cross_parsing_language,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_WORDS = r"len(regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+'))"

_OP6 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(verdict, rule_host, rule_path) AS (VALUES %s),
fitting AS (
  SELECT page_id, host, path,
    (SELECT arg_max(struct_pack(rule := rule_host || rule_path, verdict := verdict), length(rule_host || rule_path)) FROM rules
     WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best,
    EXISTS (SELECT 1 FROM (VALUES %s) AS blocked(domain) WHERE host = domain OR ends_with(host, '.' || domain)) AS listed
  FROM named)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict FROM fitting
""" % (", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES), ", ".join(f"('{d}')" for d in BLOCKED_DOMAINS))

_OP10 = """
WITH turns AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
branched AS (
  SELECT a.conv_id, a.t AS chosen, b.t AS other, ('0x' || substr(md5(a.conv_id::VARCHAR), 1, 8))::BIGINT % (len(a.t) + 1) AS kept
  FROM turns a LEFT JOIN turns b ON b.conv_id = a.conv_id + 1),
paired AS (SELECT conv_id, chosen, list_concat(chosen[1:kept], coalesce(other, [])[kept + 1:]) AS rejected FROM branched),
counted AS (SELECT *, len(list_filter(range(1, least(len(chosen), len(rejected)) + 1), lambda i: chosen[1:i] = rejected[1:i])) AS n FROM paired),
formatted AS (
  SELECT conv_id, n, list_transform(chosen[:n], lambda x: {whole}) AS prompt,
    list_transform(chosen[n + 1:], lambda x: {whole}) AS c, list_transform(list_filter(chosen[n + 1:], lambda x: x.role = 'assistant'), lambda x: {body}) AS c_trained,
    list_transform(rejected[n + 1:], lambda x: {whole}) AS r, list_transform(list_filter(rejected[n + 1:], lambda x: x.role = 'assistant'), lambda x: {body}) AS r_trained
  FROM counted)
SELECT conv_id, CAST(n AS INT) AS n_common, array_to_string(prompt, '') AS prompt, array_to_string(c, '') AS chosen, array_to_string(c_trained, '') AS chosen_trained,
  array_to_string(r, '') AS rejected, array_to_string(r_trained, '') AS rejected_trained
FROM formatted
""".format(whole="'<|im_start|>' || replace(x.role, '<|', '<\u200b|') || chr(10) || replace(x.text, '<|', '<\u200b|') || '<|im_end|>' || chr(10)",
           body="replace(x.text, '<|', '<\u200b|') || '<|im_end|>' || chr(10)")

_OP2 = r"""
WITH sizes AS (SELECT doc_id, source, CAST(%s AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) %% 3)::INT] AS weight FROM sizes GROUP BY source),
ranked AS (
  SELECT *, 2 * source_size AS cap, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS place FROM sources),
rest AS (
  SELECT *, 3 * (SELECT sum(source_size) FROM ranked) - 2 * coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    2 * sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining FROM ranked),
filled AS (SELECT *, rest * weight >= remaining * cap AS is_full FROM rest),
level AS (SELECT CAST(arg_min(rest, place) AS DOUBLE) / CAST(arg_min(remaining, place) AS DOUBLE) AS level FROM filled WHERE NOT is_full),
goals AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE (SELECT level FROM level) * weight END AS target FROM filled),
by_size AS (
  SELECT s.source, s.size, sum(s.size) AS words, any_value(g.target) AS target
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source WHERE s.size > 0 GROUP BY s.source, s.size),
tried AS (
  SELECT source, size, (target - 2 * (sum(words) OVER (PARTITION BY source ORDER BY size DESC) - words))
    / sum(words * sqrt(CAST(size AS DOUBLE))) OVER (PARTITION BY source ORDER BY size) AS scale FROM by_size),
scales AS (SELECT source, arg_max(scale, size) AS scale FROM tried WHERE scale * sqrt(CAST(size AS DOUBLE)) < 2 GROUP BY source),
copies AS (
  SELECT s.doc_id, s.source, s.size, g.source_size, g.target,
    CASE WHEN s.size > 0 THEN least(2.0, coalesce(c.scale * sqrt(CAST(s.size AS DOUBLE)), 2.0)) ELSE 0.0 END AS copies,
    (CAST('0x' || substr(md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source LEFT JOIN scales c ON s.source IS NOT DISTINCT FROM c.source),
ordered AS (
  SELECT *, floor(copies) AS certain, copies - floor(copies) AS p,
    target - sum(floor(copies) * size) OVER (PARTITION BY source) AS need FROM copies),
placed AS (SELECT *, CASE WHEN p > 0 THEN u * (1 - p) / (u * (1 - p) + p * (1 - u)) END AS rank FROM ordered),
cut AS (SELECT *, sum(CASE WHEN rank IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY rank NULLS LAST) <= need AS first_cut FROM placed),
gaps AS (SELECT *, need - coalesce(sum(CASE WHEN rank IS NOT NULL AND first_cut THEN size END) OVER (PARTITION BY source), 0) AS gap FROM cut),
filling AS (
  SELECT *, sum(CASE WHEN rank IS NOT NULL AND NOT first_cut AND size <= gap THEN size END) OVER (PARTITION BY source ORDER BY rank NULLS LAST) <= gap AS second_cut
  FROM gaps)
SELECT doc_id, size, source_size, target,
  CAST((certain + CASE WHEN rank IS NOT NULL AND (first_cut OR (size <= gap AND second_cut)) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM filling
""" % _WORDS.format("text")

_listed = lambda templates: ", ".join(f"({n}, '{name}', '{text}')" for n, (name, text) in enumerate(templates))
_TERMS = f"regexp_extract_all(replace(lower({{}}), 'licence', 'license'), '{licenses.TERM}')"


def _vectors(p, templates):
    return f"""
{p}_templates(template, license, text) AS (VALUES {_listed(templates)}),
{p}_counted AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest({_TERMS.format('text')}) AS term FROM {p}_templates) GROUP BY ALL),
{p}_weighed AS (SELECT *, ln({len(templates) + 1}::DOUBLE / (count(*) OVER (PARTITION BY term) + 1)) + 1 AS idf FROM {p}_counted),
{p}_vectors AS (SELECT *, tf * idf / sqrt(sum(tf * idf * (tf * idf)) OVER (PARTITION BY template)) AS weight FROM {p}_weighed)"""


def _cosines(p, templates):
    """Of the bodies (doc_id, path, nr, template, body) of the table `<p>_bodies`; a null template stands for all."""
    return f"""
{p}_tf AS (SELECT doc_id, path, nr, template, term, count(*) AS n FROM (SELECT doc_id, path, nr, template, unnest(body) AS term FROM {p}_bodies) GROUP BY ALL),
{p}_valued AS (
  SELECT t.*, i.idf IS NOT NULL AS known, n * coalesce(i.idf, ln({len(templates) + 1}::DOUBLE) + 1) AS w FROM {p}_tf t LEFT JOIN (SELECT DISTINCT term, idf FROM {p}_vectors) i ON i.term = t.term),
{p}_norms AS (SELECT doc_id, path, nr, sqrt(sum(w * w)) AS norm FROM {p}_valued GROUP BY ALL),
{p}_dots AS (
  SELECT b.doc_id, b.path, b.nr, v.template, v.license, sum(w * weight) AS dot FROM {p}_valued b JOIN {p}_vectors v ON v.term = b.term AND (b.template IS NULL OR b.template = v.template)
  WHERE known GROUP BY ALL),
{p}_cosines AS (SELECT doc_id, path, license, round(dot / norm, 6) AS cosine FROM {p}_dots JOIN {p}_norms USING (doc_id, path, nr))"""


_OP8 = rf"""
WITH {_vectors('head', licenses.TEMPLATES)}, {_vectors('file', licenses.LICENCE_TEXTS)},
places AS (
  SELECT template, len(ws) AS size, unnest(range(1, len(ws) + 1)) AS place, unnest(ws) AS anchor FROM (SELECT template, {_TERMS.format('text')} AS ws FROM head_templates)),
files AS (
  SELECT doc_id, text, CASE WHEN doc_id % 100 = 0 THEN 'c' || doc_id // 100 || '/LICENSE'
    WHEN doc_id % 10 = 0 THEN 'c' || doc_id // 100 || '/d' || (doc_id // 10) % 10 || '/LICENSE'
    ELSE 'c' || doc_id // 100 || '/d' || (doc_id // 10) % 10 || '/f' || doc_id || '.txt' END AS path FROM documents),
worded AS (SELECT doc_id, path, {_TERMS.format('text')} AS ws FROM files WHERE regexp_matches(text, '{licenses.CUE}')),
hits AS (SELECT * FROM (SELECT doc_id, path, ws, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS anchor FROM worded) WHERE anchor IN {licenses.ANCHORS}),
head_bodies AS (
  SELECT doc_id, path, row_number() OVER () AS nr, template, ws[greatest(pos - place + 1, 1) : pos - place + size] AS body FROM hits JOIN places USING (anchor)),
file_bodies AS (
  SELECT doc_id, path, row_number() OVER () AS nr, NULL::INT AS template, ws AS body FROM worded WHERE regexp_matches(regexp_extract(path, '[^/]*$'), '{licenses.LICENCE_FILE}')),
{_cosines('head', licenses.TEMPLATES)}, {_cosines('file', licenses.LICENCE_TEXTS)},
own AS (
  SELECT * FROM (SELECT * FROM head_cosines UNION ALL SELECT * FROM file_cosines) WHERE cosine >= {licenses.THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY cosine DESC, license) = 1),
given AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS above, license FROM own WHERE regexp_matches(regexp_extract(path, '[^/]*$'), '{licenses.LICENCE_FILE}')
  QUALIFY row_number() OVER (PARTITION BY above ORDER BY cosine DESC, license) = 1),
placed AS (SELECT doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS directory FROM files),
nearest AS (
  SELECT doc_id, path, above, license FROM placed JOIN given ON above = '' OR directory = above OR starts_with(directory, above || '/')
  QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY length(above) DESC) = 1)
SELECT p.doc_id, coalesce(o.license, n.license) AS license, o.cosine, CASE WHEN o.license IS NOT NULL THEN 'own' WHEN n.license IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN o.license IS NULL THEN n.above END AS from_directory
FROM placed p LEFT JOIN own o USING (doc_id, path) LEFT JOIN nearest n USING (doc_id, path)
"""



def _op11() -> str:
    """Plain k-means, every round with all distances."""
    def assigned(t):
        return f"""
a{t} AS MATERIALIZED (
  SELECT rid, arg_min(c, d * {ns_clusters.CLUSTERS} + c) AS c, min(d) AS d
  FROM (SELECT rid, c, list_sum(list_transform(range(1, {ns_clusters.DIMENSIONS + 1}), lambda i: (v[i] - cv[i]) * (v[i] - cv[i])))::BIGINT AS d FROM points, c{t}) GROUP BY rid)"""

    def moved(t):
        return f"""
c{t + 1} AS MATERIALIZED (
  SELECT c{t}.c, coalesce(m.cv, c{t}.cv) AS cv FROM c{t} LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) / n)::BIGINT ORDER BY i) AS cv
    FROM (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT rid, unnest(v) AS x, unnest(range(len(v))) AS i FROM points) JOIN a{t} USING (rid) GROUP BY c, i)
    GROUP BY c) m USING (c))"""

    rounds = ",".join(f"{assigned(t)},{moved(t)}" for t in range(ns_clusters.ROUNDS))
    return f"""
WITH points AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({ns_clusters.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {ns_clusters.DIMENSIONS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND abs({ns_clusters.SCALE} * x::DOUBLE) < {ns_clusters.LARGEST})) = {ns_clusters.DIMENSIONS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{ns_clusters.SEED}:' || vec_id::VARCHAR) NULLS LAST, v) - 1 AS c, v AS cv
  FROM points ORDER BY c LIMIT {ns_clusters.CLUSTERS}),{rounds},{assigned(ns_clusters.ROUNDS)}
SELECT vec_id, c::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(cv, ',')) AS centroid_sha256
FROM points JOIN a{ns_clusters.ROUNDS} USING (rid) JOIN c{ns_clusters.ROUNDS} USING (c)
"""


_OP13 = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
cut AS (
  SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM texts),
placed AS (SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS lo, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS hi FROM cut),
parts AS (
  SELECT *, array_to_string(lines[1:lo], '') AS p, array_to_string(lines[lo + 1:hi], '') AS m, array_to_string(lines[hi + 1:], '') AS s,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM placed)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

ORACLE_SQL: dict[str, str] = {
    "op2_pareto_mixing": _OP2,
    "op6_url_filter": _OP6,
    "op8_license_scan": _OP8,
    "op10_preference_formatting": _OP10,
    "op11_ns_bounds_clustering": _op11(),
    "op13_fill_in_middle": _OP13,
}
