import hashlib
import os
import random
import subprocess
import sys
import zlib

import numpy as np
from pyspark.sql import functions as F

from quarry.llm.piece_viterbi import BLANK, Encoder, decode_documents, encode_documents, encode_stream

ODD = ["a  b", "  x y ", "\n\n a\n", "é中文 𝔘 \x00 zz", " ", "a" * 400, "x" * 50 + "    " * 9 + "q", "abc" * 200, "."]


def brute(pieces, text):
    s = (" " + text).replace(" ", BLANK) if text else ""
    n = len(s)
    best, back = [0.0] + [float("-inf")] * n, [None] * (n + 1)
    for i in range(1, n + 1):
        for j in range(max(0, i - pieces.longest), i):
            v = pieces.table.get(s[j:i])
            if v and best[j] + v[0] > best[i]:
                best[i], back[i] = best[j] + v[0], (j, v[1])
        if s[i - 1] not in pieces.table and best[i - 1] + pieces.unknown_score > best[i]:
            best[i], back[i] = best[i - 1] + pieces.unknown_score, (i - 1, None)
    ids = []
    while n:
        j, k = back[n]
        ids = list((k,) if k is not None else pieces.bytes_of(s[j])) + ids
        n = j
    return ids


def test_streaming_equals_whole_text_viterbi(spark, sf001):
    e = Encoder()
    texts = ODD + [r.text[:1200] for r in spark.read.parquet(f"{sf001}/documents.parquet").limit(25).collect()]
    for t in texts:
        want = brute(e.pieces, t)
        assert e.encode(t).tolist() == want
        cut = random.Random(len(t)).randrange(1, 9)
        assert list(encode_stream(e.pieces, [t[i:i + cut] for i in range(0, len(t), cut)])) == want
        assert e.decode(want) == t
    tiny = Encoder(room=2)
    assert [tiny.encode(t).tolist() for t in ODD] == [e.encode(t).tolist() for t in ODD]


def test_stream_commits_before_the_end():
    e = Encoder()
    from quarry.llm.piece_viterbi import StreamingViterbi

    v, got = StreamingViterbi(e.pieces), 0
    for _ in range(200):
        got += len(v.feed(BLANK + "these" + BLANK + "words"))
        assert len(v.text) < 8 * e.pieces.longest
    assert got > 300


def test_documents_round_trip(spark, sf001):
    rows = [(1, None), (2, ""), (3, "x " * 30000), (4, "same"), (4, "same"), (None, "no id"), *((10 + i, t) for i, t in
            enumerate(ODD))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    ids = encode_documents(df)
    out = decode_documents(ids).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    by = {r.doc_id: r.ids for r in ids.collect()}
    assert all(r.n_ids == len(by[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.asarray(by[r.doc_id], "<u4").tobytes())
               for r in out)
    assert decode_documents(encode_documents(df.limit(0))).count() == 0
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    back = decode_documents(encode_documents(docs)).withColumnRenamed("text", "back").join(docs, "doc_id")
    assert back.where("back <> text").count() == 0


def test_pipeline_stages(spark, sf001):
    import corpus_pipeline as C
    from test_packing import check
    from test_repeats import brute as brute_repeats

    names = [n for n, _ in C.STAGES]
    assert names == ["quality classifier", "language ID", "n-gram Jaccard join", "suffix-array dedup", "best-fit packing"]
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    empty = spark.createDataFrame([(9001, None, None, "s", None), (9002, "123 456 !!", "en", None, 10)], docs.schema)
    docs = docs.unionByName(empty)
    kept = [docs]
    for _, stage in C.STAGES[:4]:
        out = stage(spark, kept[-1], sf001)
        assert out.schema.names == list(C.COLUMNS)
        kept.append(spark.createDataFrame(out.collect(), out.schema))
    n = [d.count() for d in kept]
    assert n[0] >= n[1] >= n[2] > n[3] == n[4]
    assert kept[2].where("doc_id in (9001, 9002)").count() == 0  # no letter: no language
    lab = spark.read.parquet(f"{sf001}/labels.parquet")
    good = lab.where("quality = 1")
    assert kept[1].join(good, "doc_id").count() >= 0.95 * kept[0].join(good, "doc_id").count()
    before = [(r.doc_id, r.text) for r in kept[3].collect()]
    want = {d: h for d, _, _, _, h in brute_repeats(before, 200)}
    for r in kept[4].collect():
        assert r.n_chars == len(r.text)
        if "�" not in r.text and hashlib.sha256(r.text.encode()).hexdigest() != want[r.doc_id]:
            assert any(ord(c) > 127 for c in dict(before)[r.doc_id])  # a cut inside a character
    last = C.STAGES[4][1](spark, kept[4], sf001).collect()
    check(last, [(r.doc_id, r.text) for r in kept[4].collect()])
    run = C.run(spark, sf001)
    assert run.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_entry_imports_without_the_package(tmp_path):
    """The other queries are still there when this package and the pipeline are not."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.makedirs(tmp_path / "quarry")
    for f in os.listdir(f"{root}/quarry"):
        if f not in ("llm", "__pycache__"):
            os.symlink(f"{root}/quarry/{f}", tmp_path / "quarry" / f)
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "entry_copy.py")
    code = "import entry_copy as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q); e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)},
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
