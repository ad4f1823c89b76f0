"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

import math
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from delaykit.llm import (
    bpe_codec,
    conversation_repair,
    decontamination,
    quality_gam,
    quality_rules,
    secret_scan,
    simhash,
    simplex_clusters,
    substrings,
    token_counts,
    token_shards,
    toxicity_kn,
    url_rules,
)
from delaykit.llm.common import stage_path, table, written

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_quality_gam(spark: SparkSession, sf: str) -> DataFrame:
    return quality_gam.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_toxicity_kn(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity_kn.score(table(spark, sf, "documents"), table(spark, sf, "labels"), stretch=toxicity_kn.STRETCH)


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf, "documents"), BYTE_BPE)


def op4_token_shards(spark: SparkSession, sf: str) -> DataFrame:
    folder = stage_path(spark, "token-shards")
    index = written(token_shards.write_shards(table(spark, sf, "documents"), folder, WORD_BPE), "shard-index")
    return token_shards.read_shards(spark, folder, index)


def op5_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf, "documents"), BYTE_BPE)


def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.digest(table(spark, sf, "documents"))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.containment(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op9_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    return url_rules.judge(table(spark, sf, "pages"))


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf, "documents"))


def op11_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.judge(table(spark, sf, "documents"))


def op12_simplex_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return simplex_clusters.clusters(table(spark, sf, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_repair.judge(table(spark, sf, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_gam, op2_toxicity_kn, op3_token_counts, op4_token_shards, op5_bpe_codec, op6_simhash,
        op7_substring_dedup, op8_decontamination, op9_url_rules, op10_quality_rules,
        op11_secret_scan, op12_simplex_clusters, op13_conversation_repair,
    )
}

SQL: dict[str, str] = {
    "op8_decontamination": r"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark
), shingles AS (
  SELECT DISTINCT side, id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT side, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT id, count(*) AS n FROM shingles WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(n) AS n_shingles, count(*) AS n_shared,
  count(*) / any_value(n)::DOUBLE AS containment
FROM shingles d JOIN shingles i ON d.s = i.s AND d.side = 'd' AND i.side = 'i' JOIN sizes ON sizes.id = i.id
GROUP BY d.id, i.id HAVING count(*) * 5 >= any_value(n) * 4
""",
    "op9_url_rules": r"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS pos FROM pages
), cut AS (
  SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM parts
), hosts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut
), pieces AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), hits AS (
  SELECT page_id, host, path, h || p AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC NULLS LAST, length(p) DESC) AS rank
  FROM pieces LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM hits WHERE rank = 1
""",
    "op7_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), gone AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM gone
), flat AS (
  SELECT doc_id, w[j] AS word, j FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM words WHERE len(w) > 0)
), kept AS (
  SELECT f.doc_id, string_agg(word, ' ' ORDER BY f.j) AS text, count(*) AS n
  FROM flat f ANTI JOIN covered c ON f.doc_id = c.doc_id AND f.j = c.j GROUP BY f.doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
""",
}


def kmeans_sql(k: int = 8, rounds: int = 10, dimension: int = 64, seed: int = 3) -> str:
    """Plain rounds, one after the other: all distances, least of them, floors of the means."""
    parts = [f"""
WITH cells AS MATERIALIZED (
  SELECT r, vec_id, i, CASE WHEN isfinite(x) THEN CAST(floor(1024 * x) AS BIGINT) END AS x
  FROM (SELECT r, vec_id, i, CAST(embedding[i] AS DOUBLE) AS x
        FROM (SELECT row_number() OVER () AS r, vec_id, embedding, unnest(range(1, {dimension + 1})) AS i FROM embeddings WHERE len(embedding) = {dimension}))
), good AS MATERIALIZED (
  SELECT * FROM cells WHERE r IN (SELECT r FROM cells GROUP BY r HAVING count(x) = {dimension})
), c0 AS MATERIALIZED (
  SELECT n - 1 AS k, i, x FROM good JOIN (
    SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) AS n FROM (SELECT DISTINCT r, vec_id FROM good)
  ) USING (r) WHERE n <= {k}
)"""]
    near = """a{n} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, min(d * {k} + k) % {k} AS k, min(d * {k} + k) // {k} AS d FROM (
    SELECT r, vec_id, k, sum((good.x - c{n}.x) * (good.x - c{n}.x))::BIGINT AS d FROM good JOIN c{n} USING (i) GROUP BY r, vec_id, k
  ) GROUP BY r
)"""
    move = """c{m} AS MATERIALIZED (
  SELECT c{n}.k, c{n}.i, coalesce((s - ((s % z + z) % z)) // z, c{n}.x)::BIGINT AS x FROM c{n} LEFT JOIN (
    SELECT k, i, sum(x)::BIGINT AS s, count(*) AS z FROM good JOIN a{n} USING (r) GROUP BY k, i
  ) AS t ON c{n}.k = t.k AND c{n}.i = t.i
)"""
    for n in range(rounds):
        parts += [near.format(n=n, k=k), move.format(n=n, m=n + 1)]
    parts.append(near.format(n=rounds, k=k))
    parts.append(f"digests AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY k)")
    return ", ".join(parts) + f"""
SELECT vec_id, k::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN digests USING (k)
"""


def secrets_sql(window: int = secret_scan.WINDOW) -> str:
    """Every window of every candidate counted anew."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = [(rank, kind, p) for rank, (kind, p, _) in enumerate(secret_scan.BASE)] + [(3, "run", f"[A-Za-z0-9+/_=-]{{{window},}}")]
    found = " UNION ALL ".join(
        f"SELECT r, {rank} AS rank, '{kind}' AS kind, regexp_extract_all(t, {quoted('(' + p + ')')}, 1) AS f, string_split_regex(t, {quoted(p)}) AS g FROM docs"
        for rank, kind, p in kinds
    )
    least = next(n for kind, _, n in secret_scan.BASE if kind == "assign")
    allowed = " OR ".join(f"regexp_matches(f, {quoted(a)})" for a in secret_scan.ALLOWED)
    whole = round(math.log2(window) * secret_scan.SCALE * window)
    count = lambda c: f"length(regexp_replace(s, '[^{c}]', '', 'g'))"
    limits = secret_scan.LIMITS
    return f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
flat AS (SELECT r, rank, kind, unnest(f) AS f, unnest(g[1:len(f)]) AS g, generate_subscripts(f, 1) AS i FROM found WHERE len(f) > 0),
placed AS MATERIALIZED (
  SELECT r, rank, kind, f, i, (sum(length(g)) OVER w + sum(length(f)) OVER w - length(f))::BIGINT AS a
  FROM flat WINDOW w AS (PARTITION BY r, rank ORDER BY i ROWS UNBOUNDED PRECEDING)
),
base AS MATERIALIZED (
  SELECT r, rank, kind, a, a + length(f) AS b FROM placed
  WHERE rank < 3 AND (rank > 0 OR length(regexp_extract(f, {quoted(secret_scan.ASSIGN)}, 1)) >= {least})
),
windows AS (
  SELECT r, i, a, w, substr(f, w + 1, {window}) AS s
  FROM (SELECT r, i, a, f, unnest(range(0, length(f) - {window} + 1)) AS w FROM placed WHERE rank = 3 AND NOT ({allowed}))
),
letters AS (SELECT r, i, w, c, count(*) AS n FROM (SELECT r, i, w, unnest(string_split(s, '')) AS c FROM windows) GROUP BY ALL),
sums AS (SELECT r, i, w, {whole} - sum(round(n * log2(n) * {secret_scan.SCALE})) AS e FROM letters GROUP BY ALL),
classed AS (
  SELECT r, i, a, w, {count('a-f')} AS l1, {count('g-z')} AS l2, {count('A-F')} AS u1, {count('G-Z')} AS u2, {count('0-9')} AS d, {count('+/_=-')} AS o FROM windows
),
flagged AS (
  SELECT r, i, a, w FROM classed JOIN sums USING (r, i, w) WHERE e >= {window} * CASE
    WHEN d > 0 AND l2 + u2 + o = 0 AND l1 + u1 > 0 AND (l1 = 0 OR u1 = 0) THEN {limits['hex']}
    WHEN l1 + l2 > 0 AND u1 + u2 > 0 AND d > 0 THEN {limits['mixed']}
    WHEN d >= 4 AND l1 + l2 + u1 + u2 > 0 AND (l1 + l2 = 0 OR u1 + u2 = 0) THEN {limits['plain']} END
),
islands AS (
  SELECT r, i, a, w, sum(fresh) OVER (PARTITION BY r, i ORDER BY w) AS island
  FROM (SELECT *, CASE WHEN w <= lag(w) OVER (PARTITION BY r, i ORDER BY w) + {window} THEN 0 ELSE 1 END AS fresh FROM flagged)
),
added AS (SELECT r, any_value(a) + min(w) AS a, any_value(a) + max(w) + {window} AS b FROM islands GROUP BY r, i, island),
every AS (
  SELECT r, rank, kind, a, b FROM base UNION ALL
  SELECT r, 3, 'entropy', a, b FROM added WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.r = added.r AND base.a <= added.a AND base.b >= added.b)
)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
  count(*) FILTER (rank = 2) AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (rank < 3), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank), '') AS spans
FROM docs LEFT JOIN every USING (r) GROUP BY r
"""


SQL["op11_secret_scan"] = secrets_sql()
SQL["op12_simplex_clusters"] = kmeans_sql()
