import math
import random
from functools import lru_cache

from pyspark.sql import functions as F

from quarry.operators import similar as S


def lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def brute_edit(strings, tau):
    out = set()
    for i, a in enumerate(strings):
        for b in strings[i + 1:]:
            x, y = sorted((a, b))
            m = max(len(x), len(y))
            if m and 1 - lev(x.lower(), y.lower()) / m >= tau - 1e-9:
                out.add((x, y))
    return out


def test_edit_ratio_join_equals_brute_force(spark):
    rnd = random.Random(3)
    base = ["shanghai road 12", "Shanghai Road 12", "shanghai rd 12", "beijing", "beijin", "bejing", "a", "b",
            "ab", "", "abcdefghij", "abcdefghik", "xbcdefghij", "road", "Road", "roads"]
    alphabet = "abcde "
    strings = list(dict.fromkeys(base + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 9)))
                                         for _ in range(120)]))
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for tau in (0.5, 0.7, 0.85, 1.0):
        got = {(r.key_a, r.key_b) for r in S.edit_ratio_join(df, "s", "s", tau).collect()}
        assert got == brute_edit(strings, tau), tau


def test_edit_ratio_single_pair(spark):
    df = spark.createDataFrame([("长江路幸福小区A栋305", "长江路幸福小区B栋1305"), ("", "")], "a string, b string")
    r = df.select(S.edit_ratio(df.a, df.b).alias("r")).collect()
    a, b = "长江路幸福小区A栋305", "长江路幸福小区B栋1305"
    assert abs(r[0].r - (1 - lev(a, b) / max(len(a), len(b)))) < 1e-6
    assert math.isnan(r[1].r)


def cosine(a, b, ok):
    from collections import Counter

    ca, cb = Counter(c for c in a if ok(c)), Counter(c for c in b if ok(c))
    dot = sum(ca[c] * cb[c] for c in ca)
    na, nb = math.sqrt(sum(v * v for v in ca.values())), math.sqrt(sum(v * v for v in cb.values()))
    return dot / (na * nb) if na and nb else float("nan")


def test_char_cosine_join_equals_brute_force(spark):
    rnd = random.Random(5)
    strings = list(dict.fromkeys(["".join(rnd.choice("aabbbcdefgXY1 ") for _ in range(rnd.randint(0, 12)))
                                  for _ in range(150)]))
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    ok = lambda c: c.isascii() and c.isalpha()
    for tau in (0.5, 0.8, 0.95):
        got = {(r.key_a, r.key_b) for r in S.char_cosine_join(df, "s", "s", tau, char_class=S.LATIN_CLASS).collect()}
        want = set()
        for i, a in enumerate(strings):
            for b in strings[i + 1:]:
                c = cosine(a, b, ok)
                if not math.isnan(c) and c >= tau - 1e-9:
                    want.add(tuple(sorted((a, b))))
        assert got == want, tau


def test_char_cosine_han_with_gb2312(spark):
    df = spark.createDataFrame([(1, "长江路幸福小区A栋305"), (2, "长江路幸福小区B栋1305"), (3, "abc")],
                               "id int, t string")
    allowed = S.gb2312_chars(spark)
    assert allowed.count() > 6000
    out = S.char_cosine_join(df, "id", "t", 0.5, allowed=allowed).collect()
    assert len(out) == 1 and (out[0].key_a, out[0].key_b) == (1, 2)
    assert abs(out[0].cosine - 1.0) < 1e-9


def loose_distance(a, b):
    """Edit distance where characters 32 apart count as equal, by memoised suffixes."""
    @lru_cache(maxsize=None)
    def rest(i, j):
        if i == len(a) or j == len(b):
            return len(a) - i + len(b) - j
        gap = 0 if abs(ord(a[i]) - ord(b[j])) in (0, 32) else 1
        return min(rest(i + 1, j + 1) + gap, rest(i + 1, j) + 1, rest(i, j + 1) + 1)
    return rest(0, 0)


def test_strict_distance_within_its_bound(spark):
    rng = random.Random(8)
    rows = [("".join(rng.choice("aA0Pp z") for _ in range(rng.randrange(0, 9))),
             "".join(rng.choice("aA0Pp z") for _ in range(rng.randrange(0, 9))), rng.randrange(0, 5)) for _ in range(120)]
    df = spark.createDataFrame(rows, "a string, b string, d int").where("a <> '' AND b <> ''")
    for r in df.withColumn("x", S.strict_distance("a", "b", F.col("d"))).collect():
        want = loose_distance(r.a, r.b)
        assert r.x == (want if want <= r.d else None), r


def test_blocks_and_salt_on_many_texts(spark):
    """Thousands of distinct texts, one block with a third of them; pairs stay inside their block."""
    rng = random.Random(9)
    rows = [(i, "b0" if i % 3 == 0 else f"b{i % 97}", "".join(rng.choice("abcdefghijklmnop") for _ in range(10)))
            for i in range(2400)]
    rows += [(3000 + i, rows[i][1], rows[i][2][:-1] + "#") for i in range(0, 300)]
    df = spark.createDataFrame(rows, "k int, blk string, t string")
    got = {(r.key_a, r.key_b) for r in S.edit_ratio_join(df, "k", "t", 0.9, block="blk", salt=5).collect()}
    assert got == {(i, 3000 + i) for i in range(300)}
    other = {(r.key_a, r.key_b) for r in S.char_cosine_join(df, "k", "t", 0.97, S.LATIN_CLASS, block="blk").collect()}
    plain = {(r.key_a, r.key_b) for r in S.char_cosine_join(df, "k", "t", 0.97, S.LATIN_CLASS, salt=1).collect()}
    block = {k: b for k, b, _ in rows}
    assert other == {(a, b) for a, b in plain if block[a] == block[b]}


def test_strict_edit_ratio_equals_brute_force(spark):

    rnd = random.Random(11)
    alphabet = "aAbB0P@`pq"  # pairs 32 apart: a/A, b/B, 0/P, @/`, p/P
    strings = list(dict.fromkeys(["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 7)))
                                  for _ in range(90)] + ["0P0", "P0P", "长江", "长江小区"]))
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for tau in (0.6, 0.8):
        got = {(r.key_a, r.key_b) for r in S.edit_ratio_join(df, "s", "s", tau, strict=True).collect()}
        want = set()
        for i, a in enumerate(strings):
            for b in strings[i + 1:]:
                x, y = sorted((a, b))
                if 1 - loose_distance(x, y) / max(len(x), len(y)) >= tau - 1e-9:
                    want.add((x, y))
        assert got == want, tau
    assert loose_distance("0", "P") == 0 and loose_distance("a", "A") == 0


def test_edit_ratio_join_longer_strings_small_alphabet(spark):
    rnd = random.Random(23)
    base = ["".join(rnd.choice("ab") for _ in range(rnd.randint(8, 20))) for _ in range(40)]
    # near copies: a few random edits each
    near = []
    for s in base[:20]:
        t = list(s)
        for _ in range(rnd.randint(1, 4)):
            op, pos = rnd.choice("isd"), rnd.randrange(len(t))
            if op == "i":
                t.insert(pos, rnd.choice("ab"))
            elif op == "s":
                t[pos] = rnd.choice("ab")
            elif len(t) > 1:
                del t[pos]
        near.append("".join(t))
    strings = list(dict.fromkeys(base + near))
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    for tau in (0.6, 0.75, 0.9):
        got = {(r.key_a, r.key_b) for r in S.edit_ratio_join(df, "s", "s", tau).collect()}
        assert got == brute_edit(strings, tau), tau


def test_strict_query_differs_from_folded_case(spark, sf001):
    """The rows of ``edit_ratio_strict_pairs`` are such that folding case gives other distances."""
    from quarry.plans import similar_plans as P

    third = F.length("p_name") % 3
    text = F.coalesce(*[F.when(third == i, F.translate("p_name", a, b)) for i, (a, b) in enumerate(P.SWAPS)])
    folded = S.edit_ratio_join(P._names(spark, sf001).withColumn("written", text), "p_name", "written", P.EDIT_TAU)
    a = {(r.key_a, r.key_b, r.dist) for r in folded.collect()}
    b = {(r.name_a, r.name_b, r.dist) for r in P.edit_ratio_strict_pairs(spark, sf001).collect()}
    assert a - b and b - a
