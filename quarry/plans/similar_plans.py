"""Driver queries: string-similarity joins over distinct part names (family G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import similar as S
from quarry.plans.registry import query
from quarry.sources.io import load

EDIT_TAU = 0.7
COSINE_TAU = 0.8

# One common Han character for each Latin letter, to make Han text from table columns.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
HAN = "人大中国上下小山水火木土金日月天地东西南北花鸟鱼虫风"


def _names(spark, sf):
    return load(spark, sf, "part").select("p_name").distinct()


_EDIT_SQL = f"""
WITH n AS (SELECT DISTINCT p_name FROM part WHERE length(p_name) > 0),
p AS (
  SELECT a.p_name AS name_a, b.p_name AS name_b, CAST(levenshtein(lower(a.p_name), lower(b.p_name)) AS INTEGER) AS dist,
         greatest(length(a.p_name), length(b.p_name)) AS mx
  FROM n a JOIN n b ON a.p_name < b.p_name)
SELECT name_a, name_b, dist, round(1 - dist / mx, 6) AS ratio FROM p WHERE 1 - dist / mx >= {EDIT_TAU} - 1e-9
"""


@query("edit_ratio_pairs", ops="O81", sql=_EDIT_SQL)
def edit_ratio_pairs(spark, sf):
    out = S.edit_ratio_join(_names(spark, sf), "p_name", "p_name", EDIT_TAU)
    return out.select(F.col("key_a").alias("name_a"), F.col("key_b").alias("name_b"), "dist",
                      F.round("ratio", 6).alias("ratio"))


_COSINE_SQL = f"""
WITH n AS (SELECT DISTINCT p_name FROM part),
c AS (SELECT p_name, unnest(regexp_extract_all(p_name, '[A-Za-z]')) AS ch FROM n),
v AS (SELECT p_name, ch, count(*) AS cnt FROM c GROUP BY p_name, ch),
nr AS (SELECT p_name, sqrt(sum(cnt * cnt)) AS nrm FROM v GROUP BY p_name),
d AS (SELECT a.p_name AS name_a, b.p_name AS name_b, sum(a.cnt * b.cnt) AS dot
      FROM v a JOIN v b ON a.ch = b.ch AND a.p_name < b.p_name GROUP BY 1, 2)
SELECT name_a, name_b, round(dot / (na.nrm * nb.nrm), 6) AS cosine
FROM d JOIN nr na ON na.p_name = name_a JOIN nr nb ON nb.p_name = name_b
WHERE dot / (na.nrm * nb.nrm) >= {COSINE_TAU} - 1e-9
"""


@query("char_cosine_pairs", ops="O82", sql=_COSINE_SQL)
def char_cosine_pairs(spark, sf):
    out = S.char_cosine_join(_names(spark, sf), "p_name", "p_name", COSINE_TAU, char_class=S.LATIN_CLASS)
    return out.select(F.col("key_a").alias("name_a"), F.col("key_b").alias("name_b"),
                      F.round("cosine", 6).alias("cosine"))


@query("letter_cosine_pairs", ops="O82 (blocks under angle bounds)", sql=_COSINE_SQL)
def letter_cosine_pairs(spark, sf):
    out = S.letter_cosine_join(_names(spark, sf), "p_name", "p_name", COSINE_TAU, LETTERS.upper() + LETTERS)
    return out.select(F.col("key_a").alias("name_a"), F.col("key_b").alias("name_b"),
                      F.round("cosine", 6).alias("cosine"))


# Letters of every third name written with characters 32 code points away (one match under the rule), 64
# away (none), or not at all, so that the strict rule and folded case differ.
SWAPS = (("aeio", "!EI/"), ("aet", "A0T"), ("psn", "0sN"))


def _written_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN translate(p_name, '{a}', '{b}')" for i, (a, b) in enumerate(SWAPS))
    return f"CASE length(p_name) % 3 {cases} END"


@query("edit_ratio_strict_pairs", ops="O81 (strict +-32 comparator)", sql=f"""
WITH RECURSIVE n AS (
  SELECT p_name, t, length(t) AS len, array_to_string(list_transform(string_split(t, ''), lambda c: chr(64 + ascii(c) % 32)), '') AS m
  FROM (SELECT DISTINCT p_name, {_written_sql()} AS t FROM part) WHERE length(t) > 0),
pairs AS (  -- equal modulo 32 is the wider rule: its distance is never above the strict one
  SELECT a.p_name AS name_a, b.p_name AS name_b, a.t AS x, b.t AS y, a.len AS lx, b.len AS ly, greatest(a.len, b.len) AS mx
  FROM n a JOIN n b ON a.p_name < b.p_name
  WHERE 1 - levenshtein(a.m, b.m) / greatest(a.len, b.len) >= {EDIT_TAU} - 1e-9),
dp AS (
  SELECT *, 0::BIGINT AS i, range(ly + 1) AS r FROM pairs
  UNION ALL
  SELECT name_a, name_b, x, y, lx, ly, mx, i + 1, list_transform(range(ly + 1), lambda j:
           j + list_min(list_transform(range(j + 1), lambda k: s[k + 1] - k)))
  FROM (SELECT *, list_transform(range(ly + 1), lambda j: CASE WHEN j = 0 THEN i + 1 ELSE least(r[j + 1] + 1, r[j] +
           CASE WHEN abs(ascii(substr(x, i + 1, 1)) - ascii(substr(y, j, 1))) IN (0, 32) THEN 0 ELSE 1 END) END) AS s
        FROM dp WHERE i < lx)),
d AS (SELECT name_a, name_b, CAST(r[ly + 1] AS INTEGER) AS dist, mx FROM dp WHERE i = lx)
SELECT name_a, name_b, dist, round(1 - dist / mx, 6) AS ratio FROM d WHERE 1 - dist / mx >= {EDIT_TAU} - 1e-9
""")
def edit_ratio_strict_pairs(spark, sf):
    """Names in mixed case with digits and signs, where the +-32 rule and folded case give different distances."""
    third = F.length("p_name") % 3
    text = F.coalesce(*[F.when(third == i, F.translate("p_name", a, b)) for i, (a, b) in enumerate(SWAPS)])
    out = S.edit_ratio_join(_names(spark, sf).withColumn("written", text), "p_name", "written", EDIT_TAU, strict=True)
    return out.select(F.col("key_a").alias("name_a"), F.col("key_b").alias("name_b"), "dist",
                      F.round("ratio", 6).alias("ratio"))


@query("han_cosine_pairs", ops="O82 (Han characters of GB2312)", sql=f"""
WITH n AS (SELECT DISTINCT p_name, translate(lower(p_name), '{LETTERS}', '{HAN}') AS han FROM part),
c AS (SELECT p_name, unnest(regexp_extract_all(han, '[{HAN}]')) AS ch FROM n),
v AS (SELECT p_name, ch, count(*) AS cnt FROM c GROUP BY p_name, ch),
nr AS (SELECT p_name, sqrt(sum(cnt * cnt)) AS nrm FROM v GROUP BY p_name),
d AS (SELECT a.p_name AS name_a, b.p_name AS name_b, sum(a.cnt * b.cnt) AS dot
      FROM v a JOIN v b ON a.ch = b.ch AND a.p_name < b.p_name GROUP BY 1, 2)
SELECT name_a, name_b, round(dot / (na.nrm * nb.nrm), 6) AS cosine
FROM d JOIN nr na ON na.p_name = name_a JOIN nr nb ON nb.p_name = name_b
WHERE dot / (na.nrm * nb.nrm) >= {COSINE_TAU} - 1e-9
""")
def han_cosine_pairs(spark, sf):
    names = _names(spark, sf).withColumn("han", F.translate(F.lower("p_name"), LETTERS, HAN))
    out = S.char_cosine_join(names, "p_name", "han", COSINE_TAU, allowed=S.gb2312_chars(spark))
    return out.select(F.col("key_a").alias("name_a"), F.col("key_b").alias("name_b"),
                      F.round("cosine", 6).alias("cosine"))
