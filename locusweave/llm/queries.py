"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontaminate, fingerprints, importance, jaccard_join, langid, licenses, line_dedup, packing, quality, suffix_dedup, toxicity, warc
from .runtime import held_out, prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = toxicity.score(docs, toxicity.fit(docs, labels.where(~held_out("doc_id"))))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("evidence").alias("n_evidence"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup(table(spark, sf_dir, "documents")))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_dropped").alias("n_dropped"), "n_chars", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.fit(docs.where(~held_out("doc_id"))))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = importance.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return importance.ranked(scores).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality.score(docs, quality.fit(docs, labels.where(~held_out("doc_id"))))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("evidence").alias("n_evidence"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_license_scan, op2_toxicity, op3_decontaminate, op4_jaccard_join, op5_suffix_dedup, op6_line_dedup, op7_best_fit_packing, op8_language_id, op9_fingerprints, op10_warc, op11_importance, op12_centroids, op13_quality)
}

_WORDS3 = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

_TEMPLATES = ", ".join(f"({n}, '{t.label}', {t.exact}, '{t.phrase}')" for n, t in enumerate(licenses.BASE + licenses.BODIES))

#: crc32 of bytes: a table of 256 remainders made from the polynomial, then a byte at a time.
_CRC_TABLE = "SELECT list(list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)"


def _crc32(text: str) -> str:
    """SQL of the unsigned crc32 of a text's bytes, beside a table t of _CRC_TABLE."""
    raw = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({raw}) // 2), lambda i: CAST(concat('0x', {raw}[2 * i + 1:2 * i + 2]) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {octets}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _kmeans(k: int, rounds: int) -> str:
    """SQL of plain rounds of k-means; a round's clusters are a<r> and its centroids c<r>."""
    steps = [
        f"""WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256(concat('2:', coalesce(CAST(vec_id AS VARCHAR), 'null'))), p) - 1 AS c, p FROM v QUALIFY row_number() OVER (ORDER BY sha256(concat('2:', coalesce(CAST(vec_id AS VARCHAR), 'null'))), p) <= {k})",
    ]
    for n in range(rounds + 1):
        far = "list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"a{n} AS (SELECT r, min({{'d': CAST(d AS BIGINT), 'c': c}}) AS b FROM (SELECT v.r, c.c, {far} AS d FROM v, c{n} c) x GROUP BY r)")
        if n < rounds:
            total = "CAST(sum(v.p[i]) AS BIGINT)"
            mean = f"({total} - (({total} % count(*)) + count(*)) % count(*)) // count(*)"
            steps.append(f"m{n} AS (SELECT c, list(x ORDER BY i) AS p FROM (SELECT a.b.c AS c, i, {mean} AS x FROM a{n} a JOIN v USING (r), range(1, 65) g(i) GROUP BY 1, 2) y GROUP BY c)")
            steps.append(f"c{n + 1} AS (SELECT c0.c, coalesce(m{n}.p, c0.p) AS p FROM c{n} c0 LEFT JOIN m{n} USING (c))")
    return ",\n".join(steps)


SQL: dict[str, str] = {
    "op1_license_scan": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS3} AS w FROM documents),
t AS (SELECT n, label, exact, string_split(phrase, ' ') AS p FROM (VALUES {_TEMPLATES}) x(n, label, exact, phrase)),
tg AS (SELECT n, exact, len(p) - 1 AS size, i - 1 AS tp, p[i] AS a, p[i + 1] AS b FROM (SELECT *, unnest(range(1, len(p))) AS i FROM t) x),
dg AS (SELECT r, i - 1 AS pos, w[i] AS a, w[i + 1] AS b FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM d) x),
v AS (SELECT DISTINCT r, n, exact, size, pos, tp, pos - tp AS diagonal FROM dg JOIN tg USING (a, b)),
g AS (SELECT r, n, exact, size, diagonal, min(pos) AS lo, max(pos) AS hi FROM v GROUP BY r, n, exact, size, diagonal HAVING NOT exact OR count(DISTINCT tp) = size),
g1 AS (SELECT *, CASE WHEN NOT exact AND diagonal - lag(diagonal) OVER (PARTITION BY r, n ORDER BY diagonal) <= 3 THEN 0 ELSE 1 END AS apart FROM g),
g2 AS (SELECT *, sum(apart) OVER (PARTITION BY r, n ORDER BY diagonal) AS band FROM g1),
g3 AS (SELECT *, max(hi) OVER (PARTITION BY r, n, band ORDER BY lo, diagonal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM g2),
g4 AS (SELECT *, sum(CASE WHEN lo - seen <= 8 THEN 0 ELSE 1 END) OVER (PARTITION BY r, n, band ORDER BY lo, diagonal) AS stretch FROM g3),
s AS (SELECT r, n, exact, size, band, stretch, min(lo) AS lo, max(hi) AS hi FROM g4 GROUP BY r, n, exact, size, band, stretch),
sv AS (SELECT g4.r, g4.n, band, stretch, pos, tp FROM g4 JOIN v ON v.r = g4.r AND v.n = g4.n AND v.diagonal = g4.diagonal WHERE NOT g4.exact),
chain AS (SELECT r, n, band, stretch, pos, tp, 1 AS l FROM sv
          UNION SELECT c.r, c.n, c.band, c.stretch, x.pos, x.tp, c.l + 1 FROM chain c JOIN sv x ON x.r = c.r AND x.n = c.n AND x.band = c.band AND x.stretch = c.stretch AND x.pos > c.pos AND x.tp > c.tp),
m AS (SELECT r, n, band, stretch, max(l) AS l FROM chain GROUP BY r, n, band, stretch),
k AS (SELECT s.r, s.n, s.exact, s.lo, CASE WHEN s.exact THEN 1.0 ELSE m.l / s.size END AS share
      FROM s LEFT JOIN m ON m.r = s.r AND m.n = s.n AND m.band = s.band AND m.stretch = s.stretch
      WHERE s.exact OR (m.l >= 0.75 * s.size AND m.l >= least(2, s.size))),
o AS (SELECT r, count(*) FILTER (WHERE exact) AS n_base, min(lo) FILTER (WHERE exact) AS first_word, max(lo) FILTER (WHERE exact) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
      FROM (SELECT k.*, t.label FROM k JOIN t USING (n)) x GROUP BY r)
SELECT any_value(doc_id) AS doc_id, CAST(max(len(w)) AS BIGINT) AS n_words, CAST(coalesce(any_value(n_base), 0) AS BIGINT) AS n_base, any_value(first_word) AS first_word, any_value(last_word) AS last_word,
       coalesce(any_value(base_labels), '') AS base_labels, coalesce(any_value(labels), '') AS labels, CAST(coalesce(any_value(score), 0) AS DOUBLE) AS score
FROM d LEFT JOIN o USING (r) GROUP BY r""",
    "op4_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0) t),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
e AS (SELECT x, y FROM p JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (SELECT r, r AS t FROM d UNION SELECT reach.r, e.y FROM reach JOIN e ON reach.t = e.x)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN reach USING (r) JOIN d o ON o.r = reach.t LEFT JOIN n ON n.r = d.r GROUP BY d.r, d.doc_id""",
    "op5_suffix_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
u AS (SELECT doc_id, b, min(r) AS r FROM d GROUP BY doc_id, b),
w AS (SELECT r, i, md5(b[i:i + {suffix_dedup.LENGTH - 1}]) AS h FROM (SELECT r, b, unnest(range(1, octet_length(b) - {suffix_dedup.LENGTH - 2})) AS i FROM u) t),
c AS (SELECT r, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
f AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= {suffix_dedup.LENGTH} THEN 0 ELSE 1 END AS fresh FROM c),
g AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM f),
s AS (SELECT r, min(i) AS lo, max(i) + {suffix_dedup.LENGTH} AS hi FROM g GROUP BY r, k),
l AS (SELECT r, list(lo ORDER BY lo) AS lo, list(hi ORDER BY lo) AS hi FROM s GROUP BY r),
o AS (SELECT u.doc_id, u.b, octet_length(u.b) AS n, coalesce(len(lo), 0) AS m,
             list_transform(range(0, coalesce(len(lo), 0) + 1), lambda j: hex(u.b[CASE WHEN j = 0 THEN 1 ELSE hi[j] END:CASE WHEN j = coalesce(len(lo), 0) THEN octet_length(u.b) ELSE lo[j + 1] - 1 END])) AS parts
      FROM u LEFT JOIN l USING (r)),
x AS (SELECT doc_id, b, n, m, unhex(array_to_string(parts, '')) AS kept,
             decode(unhex(array_to_string(list_transform(parts, lambda p: regexp_replace(regexp_replace(p, '^([89AB].)+', ''), '([CDEF].|[EF].[89AB].|F.[89AB].[89AB].)$', '')), ''))) AS text FROM o)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n - octet_length(kept) AS BIGINT) AS n_removed, CAST(m AS BIGINT) AS n_spans, sha256(kept) AS kept_sha256, m > 0 AS has_repeats, text
FROM d JOIN x ON x.b = d.b AND x.doc_id IS NOT DISTINCT FROM d.doc_id""",
    "op3_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS3} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_WORDS3} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0) t),
dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) ks WHERE len(w) >= k) t),
h AS (SELECT r, i, k, item FROM dw JOIN bw USING (k, g)),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, i, k FROM h) t) u GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) t GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)""",
    "op6_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, n_chars, string_split(text, chr(10)) AS l FROM documents),
p AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
c AS (SELECT source, k, count(*) AS n FROM (SELECT DISTINCT r, source, trim(u, ' ') AS k FROM (SELECT r, source, unnest(l) AS u FROM d) t) v WHERE k <> '' GROUP BY source, k),
o AS (SELECT doc_id, l, text, n_chars, CASE WHEN ks IS NULL THEN l ELSE list_filter(l, lambda x: NOT list_contains(ks, trim(x, ' '))) END AS kept
      FROM d LEFT JOIN (SELECT c.source, list(c.k) AS ks FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source WHERE n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.MAX_RATIO} * pages GROUP BY c.source) b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CAST(coalesce(len(l) - len(kept), 0) AS BIGINT) AS n_dropped,
       CAST(CASE WHEN len(l) > len(kept) THEN length(array_to_string(kept, chr(10))) ELSE n_chars END AS BIGINT) AS n_chars,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS text_sha256
FROM o""",
    "op10_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT page_id, n, d, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM f""",
    "op11_importance": f"""
WITH tb AS ({_CRC_TABLE}),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS3} AS w FROM documents),
b AS (SELECT {_WORDS3} AS w FROM benchmark),
df AS (SELECT r, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, range(1, 4) o(k) WHERE len(w) >= k) x),
bf AS (SELECT array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b, range(1, 4) o(k) WHERE len(w) >= k) x),
gb AS (SELECT g, {_crc32("g")} % 10000 AS b FROM (SELECT g FROM df UNION SELECT g FROM bf) u, tb),
s AS (SELECT b, count(*) AS s FROM df JOIN gb USING (g) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bf JOIN gb USING (g) GROUP BY b),
gain AS (SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM df) + 10000.0::DOUBLE) / ((s + 1.0::DOUBLE) * ((SELECT count(*) FROM bf) + 10000.0::DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (b)),
wt AS (SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM df JOIN gb USING (g) JOIN gain USING (b) GROUP BY r),
sc AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(concat('0x', sha256(concat('42:', coalesce(CAST(doc_id AS VARCHAR), 'null')))[1:8]) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
       FROM d LEFT JOIN wt USING (r)),
rk AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM sc WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN k <= 5 * (SELECT count(*) FROM rk) // 100 THEN k END AS rank, CAST(n_words AS BIGINT) AS n_words FROM sc LEFT JOIN rk USING (r)""",
    "op12_centroids": f"""
{_kmeans(centroids.K, centroids.ROUNDS)},
i AS (SELECT b.c AS c, CAST(sum(b.d) AS BIGINT) AS inertia FROM a{centroids.ROUNDS} GROUP BY 1)
SELECT vec_id, CAST(b.c AS INTEGER) AS cluster, b.d AS distance, i.inertia AS cluster_inertia, CAST((SELECT sum(inertia) FROM i) AS BIGINT) AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM a{centroids.ROUNDS} a JOIN v USING (r) JOIN c{centroids.ROUNDS} c ON c.c = a.b.c JOIN i ON i.c = a.b.c""",
}
