"""Registered queries of this subpackage: ``op<N>_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightlake.llm import (bpe, fingerprint, html, importance, licenses, lm, mixing, neardup, phrases,
                            quality, repeats, sharding, toxicity)
from brightlake.llm.text import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file, installed at the same place on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = toxicity.train_model(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@register("op2_minhash_neardup")
def op2_minhash_neardup(spark, sf_dir):
    return neardup.components(table(spark, sf_dir, "documents"), words=4)


@register("op3_license_scan")
def op3_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@register("op4_lm_scoring")
def op4_lm_scoring(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) != 1)


@register("op5_sharding")
def op5_sharding(spark, sf_dir):
    placed = sharding.reshard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@register("op6_html_extraction")
def op6_html_extraction(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


@register("op7_fingerprints")
def op7_fingerprints(spark, sf_dir):
    return fingerprint.compare_versions(table(spark, sf_dir, "documents"))


@register("op8_quality_rules")
def op8_quality_rules(spark, sf_dir):
    return quality.score_quality(table(spark, sf_dir, "documents"))


@register("op9_bpe_encoding")
def op9_bpe_encoding(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path())


@register("op10_source_mixing")
def op10_source_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


@register("op11_collocations")
def op11_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@register("op12_suffix_array_dedup")
def op12_suffix_array_dedup(spark, sf_dir):
    return repeats.find_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@register("op13_importance_resampling")
def op13_importance_resampling(spark, sf_dir):
    return importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# ---- SQL of the queries that it can express ---------------------------------------------

_WORDS = r"regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')"

SQL["op2_minhash_neardup"] = rf"""WITH RECURSIVE
d AS (SELECT doc_id, {_WORDS.replace("COALESCE(text, '')", "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
      FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], chr(31)) AS g
      FROM (SELECT doc_id, w, unnest(range(1, GREATEST(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * k >= {neardup.PERCENT} * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS m FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.m)
SELECT r.doc_id, COALESCE(MAX(n.n), 0) AS n_shingles, MIN(r.m) AS component_id,
       r.doc_id = MIN(r.m) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""


def _repeats(name: str, k: int) -> str:
    window = " || chr(31) || ".join(f"w[i + {j}]" for j in range(k))
    covered = " UNION ".join(f"SELECT doc_id, i + {j} AS i FROM {name}_w WHERE t > 1" for j in range(k))
    return f"""{name}_w AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, {window}) AS t
   FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM d WHERE len(w) >= {k})),
{name} AS (SELECT doc_id, COUNT(*) AS n FROM ({covered}) GROUP BY 1)"""


SQL["op8_quality_rules"] = rf"""WITH
d AS (SELECT doc_id, COALESCE(text, '') AS t, {_WORDS} AS w FROM documents),
lines AS (SELECT doc_id, line, COUNT(*) AS c FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2),
dup AS (SELECT doc_id, SUM(c - 1) AS n FROM lines GROUP BY 1),
{_repeats('rep3', 3)},
{_repeats('rep5', 5)},
m AS (SELECT d.doc_id, len(w) AS words, len(array_to_string(w, '')) AS word_chars,
        len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS symbols,
        COALESCE(dup.n, 0) AS dups, COALESCE(rep3.n, 0) AS r3, COALESCE(rep5.n, 0) AS r5,
        len(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_,
        len(regexp_replace(t, '[^A-Za-z]', '', 'g')) + strlen(t) - len(regexp_replace(t, '[^\x00-\x7F]', '', 'g')) AS letters,
        len(regexp_replace(t, '[^!]', '', 'g')) AS shouts,
        strlen(t) - len(regexp_replace(t, '[^\x00-\x20]', '', 'g')) AS solid,
        len(t) - len(regexp_replace(t, '[^\x00-\x20]', '', 'g')) AS points,
        len(regexp_replace(t, '[^\n]', '', 'g')) + 1 AS n_lines
      FROM d LEFT JOIN dup ON dup.doc_id = d.doc_id LEFT JOIN rep3 ON rep3.doc_id = d.doc_id
             LEFT JOIN rep5 ON rep5.doc_id = d.doc_id),
f AS (SELECT *, words < {quality.MIN_WORDS} OR 100 * r3 > {quality.MAX_REPEAT_PERCENT} * words AS failed FROM m)
SELECT doc_id, words AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(symbols AS BIGINT) AS n_symbols,
       CAST(dups AS BIGINT) AS n_dup_lines, CAST(r3 AS BIGINT) AS n_repeat_words, failed AS base_failed,
       NOT (failed OR 10 * symbols > words OR 10 * upper_ > 3 * letters OR 10 * shouts > words
            OR 10 * letters < 6 * solid OR points < 2 * words OR points > 15 * words
            OR 2 * dups > n_lines OR 10 * r5 > 4 * words) AS kept
FROM f"""


SQL["op11_collocations"] = rf"""WITH
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
  SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f1 AS (SELECT lang, g, COUNT(*) AS f FROM (SELECT lang, unnest(w) AS g FROM p) GROUP BY 1, 2),
f2 AS (SELECT lang, x, y, COUNT(*) AS f FROM (SELECT lang, w[i] AS x, w[i + 1] AS y FROM (
  SELECT lang, w, unnest(range(1, len(w))) AS i FROM p)) GROUP BY 1, 2, 3),
f3 AS (SELECT lang, x, y, z, COUNT(*) AS f FROM (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM (
  SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM p)) GROUP BY 1, 2, 3, 4
  HAVING COUNT(*) >= {phrases.MIN_COUNT}),
n AS (SELECT lang, SUM(f) AS n FROM f1 GROUP BY 1),
cuts AS (
  SELECT f2.lang, x || ' ' || y AS phrase, 1 AS k, f2.f AS a, b.f AS l, c.f AS r
  FROM f2 JOIN f1 b ON b.lang = f2.lang AND b.g = x JOIN f1 c ON c.lang = f2.lang AND c.g = y
  WHERE f2.f >= {phrases.MIN_COUNT} AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = f2.lang
    AND (t.x = f2.x AND t.y = f2.y OR t.y = f2.x AND t.z = f2.y) AND 100 * t.f >= {phrases.COVER_PERCENT} * f2.f)
  UNION ALL SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, 1, t.f, b.f, c.f
  FROM f3 t JOIN f1 b ON b.lang = t.lang AND b.g = t.x
    JOIN f2 c ON c.lang = t.lang AND c.x = t.y AND c.y = t.z
  UNION ALL SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, 2, t.f, b.f, c.f
  FROM f3 t JOIN f2 b ON b.lang = t.lang AND b.x = t.x AND b.y = t.y
    JOIN f1 c ON c.lang = t.lang AND c.g = t.z),
s AS (SELECT *, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS score FROM cuts),
best AS (SELECT * FROM s QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
top AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT top.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM top JOIN n ON n.lang = top.lang WHERE rank <= {phrases.TOP}"""
