import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import pytest
import zstandard

from quarry.llm import queries
from quarry.llm import secret_layers as S

SECRET = "token = abcdefgh12 "


def brute_base(text):
    """Character by character, without the operator's patterns."""
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    out, at = [], 0
    while at < len(text):  # assign
        end = None
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text[at:at + len(word)]) == word:
                i = at + len(word)
                i += text[i:i + 1] in ("'", '"')
                while text[i:i + 1] == " ":
                    i += 1
                if text[i:i + 1] not in (":", "="):
                    continue
                i += 1
                while text[i:i + 1] == " ":
                    i += 1
                i += text[i:i + 1] in ("'", '"')
                j = i
                while j < len(text) and text[j] in value:
                    j += 1
                if j > i:
                    end = j
                    if j - i >= 8:
                        out.append(("assign", at, j))
                    break
        at = end or at + 1
    for kind, first, letters, least in (("access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 16),
                                        ("hex", "", set("0123456789abcdef"), 32)):
        at = 0
        while at < len(text):
            j = at + len(first)
            if text.startswith(first, at) and j < len(text) and text[j] in letters:
                while j < len(text) and text[j] in letters:
                    j += 1
                if j - at >= least:
                    out.append((kind, at, j))
                at = j
            else:
                at += 1
    return sorted(out, key=lambda s: (s[1], S.KINDS.index(s[0])))


@pytest.mark.parametrize("seed", range(3))
def test_base_equals_brute_force(seed):
    rng = random.Random(seed)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "AKIA", "AKIAAKIA",
             "0123456789abcdef", "0123456789ABCDEF", "x" * 8, "é", "K", "ſecret", "\n", "short", "a1" * 20, "-._+/"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        base, spans = S.unwrap(text)
        assert base == brute_base(text)
        assert set(base) <= set(spans)


def url(s):
    return "".join(f"%{b:02x}" for b in s.encode())


def every(s):
    return {
        "url": url(s), "quoted": urllib.parse.quote(s, safe=""), "u4": "".join(f"\\u{ord(c):04X}" for c in s),
        "x2": "".join(f"\\x{ord(c):02x}" for c in s), "u8": "".join(f"\\U{ord(c):08x}" for c in s),
        "brace": "".join(f"\\u{{{ord(c):x}}}" for c in s), "entity": "".join(f"&#{ord(c)};" for c in s),
        "hex entity": "".join(f"&#x{ord(c):X};" for c in s), "base64": base64.b64encode(s.encode()).decode(),
        "urlsafe": base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
        "lines": base64.encodebytes(s.encode() * 9).decode(),
        **{name: base64.b64encode(f(s.encode())).decode() for name, f in (
            ("zlib", zlib.compress), ("gzip", gzip.compress), ("bz2", bz2.compress), ("xz", lzma.compress),
            ("zstd", zstandard.ZstdCompressor().compress))},
        "compressed url": "".join(f"%{b:02X}" for b in zlib.compress(s.encode())),
    }


def hidden(text):
    """Spans that only decoding gives."""
    base, spans = S.unwrap(text)
    return sorted(set(spans) - set(base))


@pytest.mark.parametrize("outer", sorted(every("x")))
def test_every_pair_of_layers_is_unwrapped_and_mapped(outer):
    for inner in every("x"):
        code = every(every("some words; " + SECRET + "more")[inner])[outer]
        text = "étre plain " * 3 + code + " plain after " * 3
        lo, hi = text.index(code[:20]), text.index(code[:20]) + len(code)
        found = [s for s in hidden(text) if s[0] == "assign"]
        assert found, (outer, inner)
        assert all(lo - 1 <= a < b <= hi + 1 for _, a, b in found), (outer, inner, found)


def test_spans_are_exact_where_escapes_carry_the_characters():
    text = "é %74oken%20%3D%20abcdefgh%31%32 z"
    assert hidden(text) == [("assign", 2, len(text) - 2)]
    code = base64.b64encode(b"abc token=abcdefgh xyz").decode()
    (kind, a, b), = hidden("é " + code)
    assert (kind, a, b) == ("assign", 2 + 4 * 8 // 6, 2 + -(-18 * 8 // 6))
    packed = base64.b64encode(zlib.compress(b"abc token=abcdefgh xyz")).decode()
    (kind, a, b), = hidden("é " + packed + " tail")
    assert (a, b) == (2, 2 + len(packed.rstrip("=")))


def test_secret_split_between_plain_text_and_an_escape():
    assert S.unwrap("password=abc%64efgh")[1] == [("assign", 0, 19)]
    assert S.unwrap("password=abcdefgh%2Bij")[1] == [("assign", 0, 17), ("assign", 0, 22)]


@pytest.mark.parametrize("depth", [3, S.LEVELS, 40])
def test_deep_nesting_reaches_the_fixpoint(depth):
    code = "token=abcdefgh12"
    for i in range(depth):
        code = code.replace("=", "%3D") if i == 0 else code.replace("%", "%25") if i % 2 else code.replace("%", "\\u0025")
    text = "x " + code + " y"
    assert ("assign", 2, 2 + len(code)) in S.unwrap(text)[1]


def test_settle_equals_repeated_steps():
    rng = random.Random(1)
    parts = ["%", "25", "41", "\\", "u00", "5c", "&#", "37", ";", "x", "{", "}", "é", "%5c", "u0025", "&#x25;"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        layer = S.Layer(text)
        while (inner := S.unescape(layer)) is not None:
            layer = inner
        done = S.settle(S.Layer(text))
        # from the left or layer by layer: no escape is left, and each character knows where it came from
        for x in (layer, done or S.Layer(text)):
            assert not S.ESCAPE.search(x.text)
            spans = [x.span(i, i + 1) for i in range(len(x.text))]
            assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])][:len(spans)]
            assert not spans or spans[-1][1] == len(text)


def test_data_that_unpacks_to_itself_ends(monkeypatch):
    calls = []

    def quine(text, at, magic):
        calls.append(at)
        assert len(calls) < 50
        yield text.encode("latin-1"), len(text)

    monkeypatch.setattr(S, "_inflate", quine)
    assert S.unwrap("\x1f\x8b\x08 token=abcdefgh")[1] == [("assign", 0, 18), ("assign", 4, 18)]


def test_large_and_broken_payloads():
    bomb = base64.b64encode(zlib.compress(b"\0" * 30_000_000 + b" token=abcdefgh ")).decode()
    assert [k for k, _, _ in hidden(bomb)] == ["assign"]
    whole = gzip.compress((SECRET * 50 + "".join(map(chr, range(40, 120))) * 40).encode())
    cut = base64.b64encode(whole[:len(whole) * 2 // 3]).decode()
    assert any(k == "assign" for k, _, _ in hidden(cut))
    for text in ("%zz%4", "\\u12", "x^2 + x^3", "BZh91AY&SY broken", "=" * 500, "A" * 5000, "%" * 5000, "\x1f\x8b\x08"):
        assert hidden(text) == []
    assert S.unwrap("%" + "25" * 100_000)[0] == [("hex", 1, 200_001)]


def test_plain_prose_gains_nothing():
    text = ("The quick brown fox; 100% of x^2, Donaudampfschifffahrtsgesellschaft/Kapitän &amp; co.\n" * 50
            + "https://example.org/a/very/long/path/of/words?x=1%20&y=2 ------------------------ ")
    assert S.unwrap(text) == ([], [])


def test_rows(spark):
    secret, sha = "token = abcdefgh12", hashlib.sha256
    rows = [(1, f"x {secret} AKIA{'B' * 12} {'0a' * 16}"), (1, None), (None, ""), (2, url(secret)), (3, secret), (3, secret),
            (4, "word " * 400_000 + secret)]
    src = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows], "doc_id bigint, text string, spans string, n_hex int")
    got = sorted((tuple(r) for r in S.secret_digests(src).collect()), key=str)
    want = []
    for i, t in rows:
        base, spans = brute_base(t or ""), S.unwrap(t)[1]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        want.append((i, *(sum(s[0] == k for s in base) for k in S.KINDS), sha(text.encode()).hexdigest(),
                     ",".join(f"{k}:{a}:{b}" for k, a, b in spans)))
    assert got == sorted(want, key=str)
    assert S.secret_digests(src.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op13_secret_layers"](spark, sf).collect()}
    assert len(got) == len(docs) and any(r.n_assign for r in got.values())
    for d in docs:
        maybe = re.search("(?i)pass|secret|token|key|AKIA|[0-9a-f]{32}", d.text or "")
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in (brute_base(d.text) if maybe else []))
        assert got[d.doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert got[d.doc_id].spans == base  # nothing is encoded in these tables
