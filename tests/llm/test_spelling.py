import collections
import random
import re
import zlib

import pytest

from quarry.llm import variable_grams as V

SCHEMA = "doc_id bigint, text string, word string, n string, gram string, length string"


def table(spark, rows):
    """Documents with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, t, "clash", "clash", "clash", "clash") for i, t in rows], SCHEMA)


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, min_length=6, min_count=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}
    form, out = {}, {}
    for w in n:
        close = sorted((-n[x], x) for x in n if near(w, x))
        if close and -close[0][0] >= 5 * n[w]:
            form[w] = close[0][1]
        out[w] = len(close)
    rows = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n[w], out[w], n.get(form.get(w))))
    return sorted(rows)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed):
    """Hubs with variants of variants, repetitive words, other letters, one hot word, repeated ids and rows."""
    rng = random.Random(seed)
    letters = "abcéÿß"
    words = ["".join(rng.choice(letters[:rng.choice([2, 6])]) for _ in range(rng.choice([5, 6, 7, 12]))) for _ in range(25)]
    pool = []
    for w in words:
        weight = rng.choice([1, 8, 60])
        pool += [w] * weight
        for _ in range(4):
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            x = w[:i] + ("" if kind == 0 else rng.choice(letters)) + w[i + (kind < 2):]
            pool += [x] * rng.choice([1, 2, 10])
    pool += ["aaaaaa", "aaaaaaa", "aaaaaaaa"] * 20 + ["Hausboot", "HAUSBOOT"] * 400 + ["ÉCOLES", "écoles"] * 9
    rows = [(rng.choice([i, 3, None]), " ".join(rng.choice(pool) for _ in range(rng.choice([0, 10, 60])))) for i in range(150)]
    return rows + [(1, None), (2, ""), (5, "x1boats,Boats-boats " * 3), (6, "Hausboot " * 2000), (6, "Hausboot " * 2000)]


@pytest.mark.parametrize("seed,list_size,entries", [(1, 16, 50_000), (2, 1, 50_000), (3, 1, 3)])
def test_equals_brute_force(spark, seed, list_size, entries):
    rows = corpus(seed)
    want = brute(rows)
    assert any(r[1] for r in want) and sum(r[4] for r in want) > 20
    assert got(V.spelling_variants(table(spark, rows), list_size=list_size, entries=entries)) == want


def test_ties_go_to_the_smallest_form_and_roots_follow_the_chain(spark):
    rows = [(1, "bbbbbb " * 5 + "bbbbbz " * 30 + "bbbbbé " * 30 + "bbbbaz " * 150)]
    want = brute(rows)
    assert ("bbbbbb", "bbbbbz", "bbbbaz", 5, 2, 30) in want
    assert got(V.spelling_variants(table(spark, rows))) == want


def test_empty_tables(spark):
    for rows in ([], [(None, None)], [(1, "short word s " * 9), (2, "")]):
        assert got(V.spelling_variants(table(spark, rows))) == []
    with pytest.raises(ValueError):
        V.spelling_variants(table(spark, []), min_length=2)


@pytest.mark.parametrize("seed", range(4))
def test_near_words_share_a_posted_gram_at_the_same_place(seed):
    """The bound of affected grams holds for every single edit, whatever the dictionary is."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("ab") for _ in range(rng.choice([6, 7, 11]))) for _ in range(60)}
    grams = collections.Counter(s[p:p + q] for w in words for s in [w + V.END] for p in range(len(w)) for q in range(2, 6)
                                if p + q <= len(s))
    frequent = {g: c for g, c in grams.items() if c > rng.choice([1, 5, 40])}
    for w in words:
        for i in range(len(w)):
            for x in (w[:i] + w[i + 1:], w[:i] + "b" + w[i:], w[:i] + "c" + w[i + 1:]):
                if len(x) < 6 or x == w:
                    continue
                a, b = sorted((w, x), key=len)
                pa, pb = (V.posted(y, frequent, 2, 5) for y in (a, b))
                shift = {0} if len(a) == len(b) else {0, 1}
                assert any(g == h and q - p in shift for g, p in pa for h, q in pb)


def test_dictionary_is_pruned_by_frequency_and_bounded(spark):
    words = spark.createDataFrame([(f"abcd{chr(101 + i % 22)}{chr(101 + i // 22)}", 5) for i in range(484)], "word string, n int")
    d = V.gram_dictionary(words, 2, 5)
    assert d["ab"] == d["abcd"] == 484 and all(n > 16 for n in d.values())
    assert "abcde" in d and V.decompose("abcdeé", d, 2, 5)[:2] == [("abcde", 0), ("bcdeé", 1)]
    few = V.gram_dictionary(words, 2, 5, entries=2)
    assert all(sum(len(g) == q for g in few) <= 2 for q in range(2, 6))
