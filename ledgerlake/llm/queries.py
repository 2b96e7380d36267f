"""The driver queries of the corpus operators and, where SQL can express them, their DuckDB statements.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, decontam, html_text, langid, lm, mil, near_dup, phrases, quality_rules, secrets_scan, shards, subword, va_file
from ledgerlake.llm.store import read

RANKS = "byte_bpe_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    done = bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=["doc_id"], decoded="decoded")
    return bpe.digests(done, ["doc_id"])


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = html_text.extract(spark, read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return done.withColumn("n_chars", F.length("text").cast("long"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link(spark, read(spark, sf_dir, "documents", "doc_id", "text"), size=2)


def _remainder(doc_id: str, n: int) -> Column:
    """CRC-32 of the id as text, modulo ``n`` (null: as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", _remainder("doc_id", 10) == 0)
    return lm.score(spark, docs.withColumn("learn", ~F.col("held_out")), "learn", ["doc_id", "held_out"], label="lang")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", _remainder("doc_id", 3) == 1)
    return langid.predict(spark, docs, ~F.col("held_out"), ["doc_id", "held_out"])


def op6_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(spark, read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and digest from the spans that the combined automaton finds."""
    found = secrets_scan.find(read(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])
    kinds = [r.kind for r in secrets_scan.BASE]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select("doc_id", *map(count, kinds), F.sha2(secrets_scan.listing(base), 256).alias("base_sha256"),
                        secrets_scan.listing(F.col("spans")).alias("spans"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(spark, read(spark, sf_dir, "documents", "doc_id", "text", "source"), ["doc_id"])


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(spark, read(spark, sf_dir, "documents", "doc_id", "text"),
                                 read(spark, sf_dir, "benchmark", "item_id", "text"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", _remainder("doc_id", 5) == 0)
    found = mil.score(spark, docs, read(spark, sf_dir, "labels", "doc_id", "quality"), _remainder("doc_id", 5) != 0, ["doc_id", "held_out"])
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op11_va_file_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.cluster(spark, read(spark, sf_dir, "embeddings", "vec_id", "embedding")).drop("n_candidates")


def op12_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", _remainder("doc_id", 5) == 0)
    found = subword.score(spark, docs, read(spark, sf_dir, "labels", "doc_id", "toxic"), _remainder("doc_id", 5) != 0, ["doc_id", "held_out"])
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(spark, read(spark, sf_dir, "documents", "text", "lang"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_html_extraction": op2_html_extraction,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_context_mixing": op4_context_mixing,
    "op5_language_id": op5_language_id,
    "op6_sampled_splitters": op6_sampled_splitters,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_va_file_clusters": op11_va_file_clusters,
    "op12_subword_toxicity": op12_subword_toxicity,
    "op13_phrase_mining": op13_phrase_mining,
}

WS = r"[\x20\x09-\x0D]+"
OP8_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT rid, [x FOR x IN string_split_regex(t, '{WS}') IF x <> ''] AS w FROM docs),
windows AS (SELECT rid, unnest([{{'i': i, 'v': w[i:i + 7]}} FOR i IN range(1, greatest(len(w) - 6, 1))], recursive := true)
            FROM words),
rep AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, v) > 1),
cover AS (SELECT rid, count(DISTINCT i + k)::BIGINT AS n FROM rep, range(8) AS r(k) GROUP BY rid),
alllines AS (SELECT rid, unnest(string_split(t, chr(10))) AS raw, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM docs),
lines AS (SELECT rid, pos, raw, trim(regexp_replace(lower(raw), '{WS}', ' ', 'g')) AS line FROM alllines),
full_lines AS (SELECT * FROM lines WHERE line <> ''),
dup AS (SELECT rid, count(*) - count(DISTINCT raw) AS n FROM full_lines GROUP BY rid),
ctx AS (SELECT l.rid, d.source, d.t, l.pos, l.line, lag(l.line) OVER p AS prev, lead(l.line) OVER p AS next
        FROM full_lines l JOIN docs d USING (rid) WINDOW p AS (PARTITION BY l.rid ORDER BY l.pos)),
once AS (SELECT source, line, t, arg_min(coalesce(prev, '') || chr(10) || coalesce(next, chr(10)), pos) AS c
         FROM ctx GROUP BY ALL),
frequent AS (SELECT source, line FROM once GROUP BY ALL
             HAVING count(*) >= {quality_rules.MIN_DOCS} AND count(DISTINCT c) >= {quality_rules.MIN_CONTEXTS}),
gone AS (SELECT c.rid, sum(len(string_split(c.line, ' ')))::BIGINT AS n
         FROM ctx c JOIN frequent f ON c.line = f.line AND c.source IS NOT DISTINCT FROM f.source GROUP BY c.rid),
stats AS (SELECT d.doc_id, len(w.w)::BIGINT AS n_words,
                 len(regexp_replace(d.t, '{WS}', '', 'g'))::BIGINT AS word_chars,
                 (len(d.t) - len(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                 coalesce(u.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
                 coalesce(g.n, 0)::BIGINT AS n_line_words
          FROM docs d JOIN words w USING (rid) LEFT JOIN dup u USING (rid) LEFT JOIN cover c USING (rid) LEFT JOIN gone g USING (rid)),
base AS (SELECT *, n_words < {quality_rules.MIN_WORDS}
                   OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM stats)
SELECT *, NOT base_failed AND n_words - n_line_words >= {quality_rules.MIN_WORDS}
          AND n_words - n_line_words >= {quality_rules.MIN_SHARE} * n_words AS kept FROM base
"""



def _floor_div(a: str, b: str) -> str:
    """Whole quotient rounded down, also of negative numbers."""
    return f"(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"


def _op11_sql(k: int = 16, rounds: int = 3) -> str:
    nearest = """near{i} AS MATERIALIZED (SELECT rid, c, dist FROM (
    SELECT v.rid, m.c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS dist FROM x v JOIN cent{i} m USING (d) GROUP BY v.rid, m.c)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY dist, c) = 1)"""
    update = """cent{j} AS MATERIALIZED (SELECT o.c, o.d, coalesce(n.x, o.x) AS x FROM cent{i} o LEFT JOIN (
    SELECT c, d, """ + _floor_div("sum(x)::HUGEINT", "count(*)::HUGEINT") + """ AS x FROM x JOIN near{i} USING (rid) GROUP BY c, d) n USING (c, d))"""
    steps = [nearest.format(i=0)]
    for i in range(rounds):
        steps += [update.format(i=i, j=i + 1), nearest.format(i=i + 1)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e::DOUBLE))) = 64),
x AS MATERIALIZED (SELECT rid, unnest(range(64)) AS d, unnest(v) AS x FROM kept),
start AS (SELECT v, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM kept QUALIFY c < {k}),
cent0 AS MATERIALIZED (SELECT c, unnest(range(64)) AS d, unnest(v)::HUGEINT AS x FROM start),
{", ".join(steps)},
digest AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS h FROM cent{rounds} GROUP BY c)
SELECT k.vec_id, n.c::INTEGER AS cluster, n.dist AS distance, (sum(n.dist) OVER (PARTITION BY n.c))::BIGINT AS cluster_inertia,
       (sum(n.dist) OVER ())::BIGINT AS inertia, g.h AS centroid_sha256
FROM near{rounds} n JOIN kept k USING (rid) JOIN digest g USING (c)
"""


ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP13_SQL = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(string_split_regex(translate(coalesce(text, ''), '{ALPHABET}', '{ALPHABET.lower()}'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces WHERE len(regexp_extract_all(p, '[^\x20\x09]+')) > 0),
f1 AS MATERIALIZED (SELECT lang, p, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(w) AS p FROM w) GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*)::HUGEINT AS f FROM (
  SELECT lang, unnest(w[:-2]) AS w1, unnest(w[2:]) AS w2 FROM w WHERE len(w) > 1) GROUP BY ALL),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*)::HUGEINT AS f FROM (
  SELECT lang, unnest(w[:-3]) AS w1, unnest(w[2:-2]) AS w2, unnest(w[3:]) AS w3 FROM w WHERE len(w) > 2) GROUP BY ALL HAVING f >= 10),
over AS (SELECT lang, a, b, max(f) AS m FROM (SELECT lang, w1 AS a, w2 AS b, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
s2 AS (SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, x.f AS l, y.f AS r, 1000000 * t.f * t.f // (x.f * y.f) AS score
       FROM f2 t JOIN f1 x ON x.lang = t.lang AND x.p = t.w1 JOIN f1 y ON y.lang = t.lang AND y.p = t.w2
       LEFT JOIN over o ON o.lang = t.lang AND o.a = t.w1 AND o.b = t.w2 WHERE t.f >= 10 AND (o.m IS NULL OR 100 * o.m < 50 * t.f)),
cut AS (SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
               1000000 * t.f * t.f // (x.f * yz.f) AS k1, 1000000 * t.f * t.f // (xy.f * z.f) AS k2
        FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.p = t.w1 JOIN f1 z ON z.lang = t.lang AND z.p = t.w3
        JOIN f2 xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2 JOIN f2 yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3),
s AS (SELECT * FROM s2 UNION ALL
      SELECT lang, phrase, a, if(k1 <= k2, l1, l2), if(k1 <= k2, r1, r2), least(k1, k2) FROM cut),
n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n.n::BIGINT AS n, score::BIGINT AS score
FROM s JOIN n ON n.lang = s.lang QUALIFY rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {"op8_quality_rules": OP8_SQL, "op11_va_file_clusters": _op11_sql(), "op13_phrase_mining": OP13_SQL}
