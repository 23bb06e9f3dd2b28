"""String-similarity joins without a cross join (inventory O81, O82, H6).

``edit_ratio_join`` finds every pair with edit-distance ratio
``1 - d / max(len) >= tau``. ``char_cosine_join`` finds every pair whose
character-frequency cosine is ``>= tau``. Both generate candidates with an
exact filter (no pair above the threshold is lost), join on signatures, and
verify each candidate with the exact score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EPS = 1e-9


# ---------------------------------------------------------------- edit ratio

def _dmax(length, tau: float):
    """Largest distance a pair whose longer string has ``length`` may have."""
    return F.floor(F.lit(1.0 - tau) * length + F.lit(_EPS)).cast("int")


def _segment(length, d, i):
    """Start and length of segment ``i`` when a string of ``length`` is cut
    into ``d + 1`` parts: the first parts get the shorter length."""
    parts = d + 1
    base = F.floor(length / parts).cast("int")
    extra = (length % parts).cast("int")
    short = parts - extra
    start = F.when(i < short, i * base).otherwise(short * base + (i - short) * (base + 1))
    seg_len = F.when(i < short, base).otherwise(base + 1)
    return start, seg_len


def _salted(published: DataFrame, probing: DataFrame, of: str, salt: int) -> tuple[DataFrame, DataFrame]:
    """Published rows spread over ``salt`` values by a hash of their key, probing rows copied to each."""
    return (published.withColumn("_s", F.pmod(F.xxhash64(F.col(of)), F.lit(salt)).cast("int")),
            probing.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))))


def edit_ratio_join(df: DataFrame, key: str, text: str, tau: float, fold_case: bool = True,
                    strict: bool = False, block: str | None = None, salt: int = 4) -> DataFrame:
    """All pairs (key_a < key_b) with ``1 - lev(a, b) / max(len) >= tau``.

    Segment filter: a pair within distance ``d`` of a string cut into
    ``d + 1`` segments must contain one segment unchanged; taking the first
    unchanged one bounds how far it can have moved (edits before and after
    it, and the length difference), which fixes a short window of start
    positions to probe. The longer string of a pair publishes its segments; the
    shorter one publishes, for each length it could pair with, the
    substrings at those positions; the two meet in an equi-join on
    (length, segment number, text). Candidates are verified with Spark's
    bounded ``levenshtein``. Case is folded with ``lower`` (the source
    compares code units equal up to +-32, which folds ASCII case; declared
    difference for other pairs). Empty strings have an undefined ratio
    (0/0) and never pair.

    ``strict=True`` reproduces the source's comparator exactly: two code
    units match when equal or 32 apart. That rule is not an equivalence, so
    no normalisation reproduces it; candidates come from the same segment
    filter on the strings mapped to ``code point mod 32`` (characters that
    match under the rule share that value, so no pair is lost) and each
    candidate is verified by ``strict_distance``.

    ``block`` names a column that both rows of a pair must share: with texts
    that are short or very alike the output grows with the square of a
    group's size, and a block is the way to say which pairs are wanted.
    ``salt`` spreads the copies of one frequent segment over that many tasks.
    """
    if not 0.0 < tau <= 1.0:
        raise ValueError("tau must be in (0, 1]")
    blk = (F.col(block) if block else F.lit(0)).alias("blk")
    if strict:
        t = F.expr(f"concat_ws('', transform(split(`{text}`, ''), c -> chr(64 + ascii(c) % 32)))")
        s = (df.select(F.col(key).alias("k"), t.alias("t"), F.col(text).alias("orig"), blk)
             .where(F.length("t") > 0).withColumn("L", F.length("t")))
    else:
        t = F.lower(F.col(text)) if fold_case else F.col(text)
        s = df.select(F.col(key).alias("k"), t.alias("t"), blk).where(F.length("t") > 0).withColumn("L", F.length("t"))

    # Index side: segments of each string as the longer (or equal) member.
    idx = (s.withColumn("d", _dmax(F.col("L"), tau))
           .select("k", "blk", "t", "L", "d", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("i")))
    st, ln = _segment(F.col("L"), F.col("d"), F.col("i"))
    idx = (idx.select("k", "blk", "t", "L", "i", st.alias("p"), ln.alias("n"))
           .select(F.col("k").alias("k_long"), "blk", "L", "i", F.expr("substring(t, p + 1, n)").alias("seg")))

    # Probe side: every length L2 in [l, l / tau] the string may pair with.
    pr = s.select("k", "blk", "t", F.col("L").alias("l"),
                  F.explode(F.sequence(F.col("L"), F.floor(F.col("L") / F.lit(tau) + F.lit(_EPS)).cast("int"))).alias("L2"))
    pr = pr.withColumn("d2", _dmax(F.col("L2"), tau)).where(F.col("L2") - F.col("l") <= F.col("d2"))
    pr = pr.select("*", F.explode(F.sequence(F.lit(0), F.col("d2"))).alias("i"))
    st2, ln2 = _segment(F.col("L2"), F.col("d2"), F.col("i"))
    pr = pr.select("k", "blk", "t", "l", "L2", "d2", "i", st2.alias("p"), ln2.alias("n"))
    # Shift x = p - q of the unchanged segment i, taking segment i as the first
    # unchanged one: at least i edits lie before it, so at most d2 - i after;
    # with delta = L2 - l, |delta - x| <= d2 - i and |x| + |delta - x| <= d2.
    delta, d2, i = F.col("L2") - F.col("l"), F.col("d2"), F.col("i")
    x_lo = F.greatest(delta - (d2 - i), F.ceil((delta - d2) / 2).cast("int"))
    x_hi = F.least(delta + (d2 - i), F.floor((delta + d2) / 2).cast("int"))
    lo = F.greatest(F.lit(0), F.col("p") - x_hi)
    hi = F.least(F.col("l") - F.col("n"), F.col("p") - x_lo)
    pr = (pr.where(lo <= hi)
          .select("k", "blk", "L2", "i", "n", F.explode(F.sequence(lo, hi)).alias("q"), "t")
          .select(F.col("k").alias("k_short"), "blk", F.col("L2").alias("L"), "i",
                  F.expr("substring(t, q + 1, n)").alias("seg")))

    idx, pr = _salted(idx, pr, "k_long", salt)
    cand = (pr.join(idx, ["blk", "L", "i", "seg", "_s"]).where(F.col("k_short") != F.col("k_long"))
            .select(F.least("k_short", "k_long").alias("key_a"), F.greatest("k_short", "k_long").alias("key_b"))
            .distinct())
    src = "orig" if strict else "t"
    a = s.select(F.col("k").alias("key_a"), F.col(src).alias("ta"), F.col("L").alias("la"))
    b = s.select(F.col("k").alias("key_b"), F.col(src).alias("tb"), F.col("L").alias("lb"))
    v = cand.join(a, "key_a").join(b, "key_b")
    mx = F.greatest("la", "lb")
    v = v.withColumn("_thr", _dmax(mx, tau))
    dist = strict_distance("ta", "tb", F.col("_thr")) if strict else F.expr("levenshtein(ta, tb, _thr)")
    v = v.withColumn("dist", dist).where(F.col("dist") >= 0)
    ratio = F.lit(1.0) - F.col("dist") / mx
    return (v.select("key_a", "key_b", "dist", ratio.alias("ratio"))
            .where(F.col("ratio") >= F.lit(tau) - F.lit(_EPS)))


def strict_distance(a: str, b: str, bound: Column) -> Column:
    """Edit distance under the +-32 rule, or null when it is over ``bound``.

    Only the diagonal band of width ``2 * bound + 1`` can hold such a
    distance: a row of the table is that band as an array, folded over the
    characters of ``a`` with built-in functions, and left as it is once every
    entry is over the bound.
    """
    far, d = F.lit(1_000_000), bound
    codes = lambda c: F.transform(F.split(F.col(c), ""), lambda ch: F.ascii(ch))
    start = F.struct(codes(a).alias("x"), codes(b).alias("y"))

    def rows(s):
        n, m = F.size(s["x"]), F.size(s["y"])
        first = F.transform(F.sequence(F.lit(0), 2 * d), lambda k: F.when((k >= d) & (k - d <= m), k - d).otherwise(far))

        def row(prev, i):
            def cell(cur, k):
                j = i + k - d
                gap = F.abs(F.get(s["x"], i - 1) - F.get(s["y"], j - 1))
                best = F.least(F.get(prev, k) + F.when(gap.isin(0, 32), 0).otherwise(1),
                               F.coalesce(F.get(prev, k + 1), far) + 1, F.coalesce(F.get(cur, k - 1), far) + 1)
                return F.array_append(cur, F.when((j < 0) | (j > m), far).when(j == 0, i).otherwise(best))

            band = F.aggregate(F.sequence(F.lit(0), 2 * d), F.array().cast("array<int>"), cell)
            return F.when(F.array_min(prev) > d, prev).otherwise(band)

        last = F.aggregate(F.sequence(F.lit(1), n), first, row)
        dist = F.get(last, m - n + d)
        return F.when(n == 0, m).when(F.abs(m - n) <= d, dist)

    dist = F.get(F.transform(F.array(start), rows), 0)
    return F.when(dist <= d, dist)


def edit_ratio(a, b, fold_case: bool = True):
    """Column form for one pair (O81): float ratio, NaN for two empty strings."""
    x, y = (F.lower(a), F.lower(b)) if fold_case else (a, b)
    mx = F.greatest(F.length(x), F.length(y))
    return F.when(mx == 0, F.lit(float("nan"))).otherwise(F.lit(1.0) - F.levenshtein(x, y) / mx).cast("float")


# ---------------------------------------------------------------- character cosine

# Fixed value: the range of Han characters that count.
HAN_CLASS = "[\\u4e00-\\u9fa5]"
LATIN_CLASS = "[A-Za-z]"


def gb2312_chars(spark) -> DataFrame:
    """Han characters U+4E00..U+9FA5 that GB2312 encodes, built from the codec
    (a fixed table of a few thousand rows)."""
    chars = []
    for cp in range(0x4E00, 0x9FA6):
        ch = chr(cp)
        try:
            ch.encode("gb2312")
        except UnicodeEncodeError:
            continue
        chars.append((ch,))
    return spark.createDataFrame(chars, "ch string")


def char_vectors(df: DataFrame, key: str, text: str, char_class: str = HAN_CLASS,
                 allowed: DataFrame | None = None, block: str | None = None) -> DataFrame:
    """(k, ch, cnt) counts of the characters of ``char_class`` per row, and its block."""
    blk = (F.col(block) if block else F.lit(0)).alias("blk")
    v = (df.select(F.col(key).alias("k"), blk,
                   F.explode(F.regexp_extract_all(F.col(text), F.lit(char_class), 0)).alias("ch"))
         .groupBy("k", "blk", "ch").agg(F.count(F.lit(1)).alias("cnt")))
    return v if allowed is None else v.join(allowed.select("ch"), "ch", "left_semi")


def char_cosine_join(df: DataFrame, key: str, text: str, tau: float, char_class: str = HAN_CLASS,
                     allowed: DataFrame | None = None, block: str | None = None, salt: int = 8) -> DataFrame:
    """All pairs (key_a < key_b) with character-frequency cosine ``>= tau``.

    Prefix filter: order characters globally rarest first. If the first
    character two rows share is ``c``, Cauchy-Schwarz bounds their cosine by
    the product of the norm shares of both rows from ``c`` on; so each row
    only publishes its characters while its remaining norm share is at least
    ``tau``, and pairs meet on those rare characters. Candidates are scored
    exactly on all shared characters. A row with no character of the class
    has zero norm (0/0 in the source) and never pairs. ``block`` and ``salt``
    as in ``edit_ratio_join``: a Latin alphabet has 52 join keys.
    """
    if not 0.0 < tau <= 1.0:
        raise ValueError("tau must be in (0, 1]")
    v = char_vectors(df, key, text, char_class, allowed, block)
    freq = v.groupBy("ch").agg(F.count(F.lit(1)).alias("df"))
    vf = v.join(freq, "ch")
    w_all = Window.partitionBy("k")
    w_suffix = (Window.partitionBy("k").orderBy(F.desc("df"), F.desc("ch"))
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    vf = (vf.withColumn("nsq", F.sum(F.col("cnt") * F.col("cnt")).over(w_all))
          .withColumn("suf", F.sum(F.col("cnt") * F.col("cnt")).over(w_suffix)))
    prefix = vf.where(F.col("suf") >= F.lit(tau * tau) * F.col("nsq") * F.lit(1.0 - _EPS)).select("k", "blk", "ch")
    pa = prefix.select(F.col("k").alias("key_a"), "blk", "ch")
    pb = prefix.select(F.col("k").alias("key_b"), "blk", "ch")
    pb, pa = _salted(pb, pa, "key_b", salt)
    cand = pa.join(pb, ["blk", "ch", "_s"]).where(F.col("key_a") < F.col("key_b")).select("key_a", "key_b").distinct()
    va = v.select(F.col("k").alias("key_a"), "ch", F.col("cnt").alias("ca"))
    vb = v.select(F.col("k").alias("key_b"), "ch", F.col("cnt").alias("cb"))
    dots = (cand.join(va, "key_a").join(vb, ["key_b", "ch"])
            .groupBy("key_a", "key_b").agg(F.sum(F.col("ca") * F.col("cb")).alias("dot")))
    norms = v.groupBy("k").agg(F.sqrt(F.sum(F.col("cnt") * F.col("cnt"))).alias("nrm"))
    na = norms.select(F.col("k").alias("key_a"), F.col("nrm").alias("na"))
    nb = norms.select(F.col("k").alias("key_b"), F.col("nrm").alias("nb"))
    out = dots.join(na, "key_a").join(nb, "key_b")
    cos = F.col("dot") / (F.col("na") * F.col("nb"))
    return out.select("key_a", "key_b", cos.alias("cosine")).where(F.col("cosine") >= F.lit(tau) - F.lit(_EPS))


def letter_cosine_join(df: DataFrame, key: str, text: str, tau: float, letters: str, **layout) -> DataFrame:
    """``char_cosine_join`` for a small alphabet (O82): (key_a, key_b, cosine).

    With a few dozen characters nearly all texts share one, so meeting on
    characters would propose nearly all pairs. The counts are taken as vectors
    and compared block by block under angle bounds instead (``topk.pairs_above``).
    """
    from quarry.operators.topk import pairs_above

    c = F.col(text)
    counts = F.array(*[(F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))).cast("double") for ch in letters])
    pairs = pairs_above(df.select(F.col(key).alias("id"), counts.alias("features")), tau, **layout)
    return pairs.select(F.col("a").alias("key_a"), F.col("b").alias("key_b"), F.col("score").alias("cosine"))
