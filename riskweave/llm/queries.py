"""The operators bound to the shared tables: one query per operator, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables
from . import hamming, html, langid, minhash, negatives, packing, quality, repair, secrets, spm, suffix, toxicity, warc
from .common import ship_package


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return tables.read_table(spark, sf_dir, name)


def op1_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(secrets.spans_text("base"), 256).alias("base_sha256"),
                        secrets.spans_text("spans").alias("spans"))


def op2_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.embeddings_top_k(read_table(spark, sf_dir, "embeddings"))


def op3_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_warc(warc.write_warc(read_table(spark, sf_dir, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(read_table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words")


def op6_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = spm.round_trip(read_table(spark, sf_dir, "documents"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
                        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"))


def op8_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_digest(read_table(spark, sf_dir, "documents"))


def op9_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op10_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op11_scalar_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digest(read_table(spark, sf_dir, "conversations"))


def op12_bitmask_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op13_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"))


REGISTRY = {f.__name__: f for f in (
    op1_secret_battery, op2_multi_index_hashing, op3_zip_warc, op4_block_rules, op5_quality_rules,
    op6_boosted_toxicity, op7_piece_viterbi, op8_suffix_radix, op9_residual_packing, op10_prob_minhash,
    op11_scalar_repair, op12_bitmask_langid, op13_threshold_negatives)}
ORACLE: dict[str, str] = {
    "op2_multi_index_hashing": """
        WITH pairs AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   len(list_filter(list_zip(q.embedding, v.embedding),
                                   lambda p: coalesce(p[1] > 0, false) <> coalesce(p[2] > 0, false))) AS distance
            FROM embeddings q JOIN embeddings v ON q.embedding IS NOT NULL AND v.embedding IS NOT NULL
            WHERE q.vec_id % 50 = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
        FROM ranked WHERE rank <= 10""",
    "op3_zip_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
        SELECT page_id, n AS payload_bytes,
               array_to_string(list_transform(generate_series(0, 31), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
                       (CAST('0x' || substr(x, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)),
                   '') AS payload_digest,
               CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM d""",
    "op13_threshold_negatives": """
        WITH v AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, o.vec_id AS other, a.label = o.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.z, o.z), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
            FROM v a JOIN v o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
        ranked AS (
            SELECT p.anchor_id, p.positive_id,
                   CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
                   s.other AS negative_id, p.positive_score, s.score AS negative_score
            FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
             AND 100 * s.score BETWEEN 80 * p.positive_score AND 100 * p.positive_score)
        SELECT * FROM ranked WHERE rank <= 5""",
    "op5_quality_rules": r"""
        WITH docs AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs),
        lines AS (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM docs),
        worded AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS k FROM lines),
        dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded WHERE k > 0 GROUP BY doc_id),
        wins AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS win
                 FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8)),
        twice AS (SELECT doc_id, unnest(list(i)) AS i FROM wins GROUP BY doc_id, win HAVING count(*) > 1),
        rep AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM twice, generate_series(0, 7) g(j) GROUP BY doc_id),
        short AS (SELECT doc_id, host, t, k,
                         regexp_replace(trim(regexp_replace(lower(line), '\s+', ' ', 'g')), '[0-9]', '0', 'g') AS norm
                  FROM worded WHERE k BETWEEN 1 AND 30),
        hosts AS (SELECT host, count(DISTINCT t) AS host_docs FROM docs GROUP BY host),
        often AS (SELECT host, norm FROM short JOIN hosts USING (host) GROUP BY host, norm, host_docs
                  HAVING count(DISTINCT t) > 10 AND count(DISTINCT t) > host_docs * 0.01),
        gone AS (SELECT doc_id, sum(k) AS removed FROM short JOIN often USING (host, norm) GROUP BY doc_id),
        stats AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                         CAST(coalesce(removed, 0) AS BIGINT) AS removed_words
                  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
        judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM stats)
        SELECT *, NOT base_failed AND removed_words <= 0.5 * n_words AS kept FROM judged""",
    "op1_secret_battery": r"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        pats(kind, rnk, pat) AS (VALUES
            ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
            ('access', 1, 'AKIA[A-Z0-9]+'), ('hex', 2, '[0-9a-f]{32,}'), ('random', 3, '[A-Za-z0-9+/_=-]{20,}')),
        cut AS (SELECT r, t, kind, rnk, pat, regexp_extract_all(t, pat) AS ms, string_split_regex(t, pat) AS ps
                FROM docs, pats WHERE regexp_matches(t, pat)),
        placed AS (SELECT r, kind, rnk, pat, ms[i] AS m,
                      sum(length(ps[i]) + length(ms[i])) OVER (PARTITION BY r, kind ORDER BY i) AS e
               FROM (SELECT *, unnest(generate_series(1, len(ms))) AS i FROM cut)),
        found AS (SELECT r, kind, rnk, m, CAST(e - length(m) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed
                  WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(m, pat, 2)) >= 8
                                  WHEN 'access' THEN length(m) >= 16 ELSE TRUE END),
        base AS (SELECT * FROM found WHERE rnk < 3),
        cand AS (SELECT * FROM found f WHERE rnk = 3 AND NOT EXISTS (
                     SELECT 1 FROM base b WHERE b.r = f.r AND b.s < f.e AND f.s < b.e)),
        core AS (SELECT m, regexp_replace(m, '[^A-Za-z0-9]', '', 'g') AS x FROM (SELECT DISTINCT m FROM cand)),
        enc AS (SELECT m, x, length(x) AS n,
                       CASE WHEN regexp_full_match(x, '[0-9a-f]+') THEN '0123456789abcdef'
                            WHEN regexp_full_match(x, '[0-9A-F]+') THEN '0123456789ABCDEF'
                            WHEN regexp_full_match(x, '[A-Z2-7]+') THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
                            WHEN regexp_full_match(x, '[0-9a-z]+') THEN '0123456789abcdefghijklmnopqrstuvwxyz'
                            WHEN regexp_full_match(x, '[0-9A-Z]+') THEN '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'
                            ELSE '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz' END AS alphabet
                FROM core
                WHERE CAST(regexp_matches(x, '[0-9]') AS INT) + CAST(regexp_matches(x, '[a-z]') AS INT)
                      + CAST(regexp_matches(x, '[A-Z]') AS INT) >= 2
                  AND length(x) >= 18 AND length(m) - length(x) <= 0.125 * length(m)
                  AND NOT regexp_full_match(m, '[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}')),
        chars AS (SELECT m, i, substr(x, i, 1) AS c, CAST(strpos(alphabet, substr(x, i, 1)) AS DOUBLE) AS v,
                         CASE WHEN substr(x, i, 1) BETWEEN '0' AND '9' THEN 'd'
                              WHEN substr(x, i, 1) BETWEEN 'a' AND 'z' THEN 'l' ELSE 'u' END AS cls
                  FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM enc)),
        same AS (SELECT m, CAST(sum(k * (k - 1) / 2) AS DOUBLE) AS pairs
                 FROM (SELECT m, c, count(*) AS k FROM chars GROUP BY ALL) GROUP BY m),
        dev AS (SELECT m, i, cls, v - avg(v) OVER (PARTITION BY m) AS d FROM chars),
        nxt AS (SELECT m, d, cls, lead(d) OVER w AS d2, lead(cls) OVER w AS cls2 FROM dev WINDOW w AS (PARTITION BY m ORDER BY i)),
        run AS (SELECT m, count(*) FILTER (cls2 <> cls) AS switches, sum(d * d) AS var, sum(d * d2) AS lag FROM nxt GROUP BY m),
        nums AS (SELECT enc.m, n, length(alphabet) AS k, pairs, switches,
                        1 - (power(length(regexp_replace(alphabet, '[^0-9]', '', 'g')), 2)
                             + power(length(regexp_replace(alphabet, '[^a-z]', '', 'g')), 2)
                             + power(length(regexp_replace(alphabet, '[^A-Z]', '', 'g')), 2)) / power(length(alphabet), 2) AS ps,
                        CASE WHEN var > 0 THEN abs(lag / var + 1.0 / n) * sqrt(n) ELSE 99.0 END AS zs,
                        n * (n - 1) / 2.0 / length(alphabet) AS even
                 FROM enc JOIN same USING (m) JOIN run USING (m)),
        zs AS (SELECT *, (pairs - even) / sqrt(even * (1 - 1.0 / k)) AS zp,
                      abs((switches - (n - 1) * ps) / sqrt((n - 1) * ps * (1 - ps))) AS zr,
                      (even * 1.75 - pairs) / sqrt(even * 1.75) AS tp,
                      (switches - (n - 1) * 0.25) / sqrt((n - 1) * 0.25 * 0.75) AS tr FROM nums),
        p AS (SELECT m, n, least(1.0, 3 * least(f(zp), 2 * f(zr), 2 * f(zs))) AS fair, -(ln(f(tp)) + ln(f(tr))) AS half FROM zs),
        b AS (SELECT m, fair, CAST(n >= 28 AS INT) + CAST(n >= 40 AS INT) + CAST(n >= 64 AS INT) AS len,
                     least(300, CAST(floor(-log10(exp(-half) * (1 + half)) * 10) AS INT)) AS bin FROM p),
        h AS (SELECT len, bin, sum(count(*)) OVER (PARTITION BY len ORDER BY bin DESC) AS above,
                     sum(count(*)) OVER (PARTITION BY len) AS m FROM b GROUP BY len, bin),
        cutoff AS (SELECT len, min(bin) AS least_bin FROM h WHERE power(10, -bin / 10.0) <= 0.01 * above / m GROUP BY len),
        hits AS (SELECT b.m FROM b JOIN cutoff USING (len) WHERE bin >= least_bin AND fair >= 0.001),
        spans AS (SELECT r, kind, rnk, s, e FROM base UNION ALL SELECT r, kind, rnk, s, e FROM cand SEMI JOIN hits USING (m)),
        told AS (SELECT r, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS x,
                        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rnk) FILTER (rnk < 3) AS base,
                        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rnk) AS spans FROM spans GROUP BY r)
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(x, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(told.spans, '') AS spans
        FROM docs LEFT JOIN told USING (r)""",
}
# the tail of the normal distribution as the operator computes it
for _z in ("zp", "zr", "zs", "tp", "tr"):
    ORACLE["op1_secret_battery"] = ORACLE["op1_secret_battery"].replace(
        f"f({_z})", f"(1 / (1 + exp(least(1.5976 * {_z} + 0.07056 * {_z} * {_z} * {_z}, 600.0))))")
