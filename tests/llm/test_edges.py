"""Empty tables, extra columns, very long texts and odd vectors, for the pipeline and for single operators."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from quarry.llm.permutation_index import search
from quarry.llm.projection_dedup import vector_components
from quarry.llm.suffix_dedup import remove_repeats

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, piece int, score double"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def folder(spark, tmp_path, docs, labels):
    spark.createDataFrame([(*d, "clash", 1, 0.5) for d in docs], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(*r, "clash") for r in labels], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (None, 0, 1), (2, None, None)]])
def test_pipeline_over_empty_documents(spark, tmp_path, labels):
    out = C.run(spark, folder(spark, tmp_path, [], labels))
    assert out.collect() == [] and "sequence_id" in out.columns


def test_pipeline_over_extra_columns_nulls_and_a_megabyte(spark, tmp_path):
    base = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    lab = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
           .select("doc_id", "quality", "toxic").collect()]
    docs = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in base.values()]
    rng = random.Random(1)
    words = [w for r in base.values() if r.lang == "en" for w in r.text.split()][:4000]
    long = " ".join(rng.choice(words) for _ in range(170_000))
    docs += [(9001, None, None, None, None), (None, "", "en", "s", 0), (9002, long, "en", "s", len(long)), (9002, long, "en", "s", len(long))]
    sf = folder(spark, tmp_path, docs, lab)
    table = spark.read.parquet(f"{sf}/documents.parquet")
    for stage in (C.quality, C.language):  # the classifiers decide by content; every column they return is the table's
        out = stage(spark, table, sf)
        assert out.columns == list(C.COLUMNS) and out.where("doc_id < 9000").count() > 20
    out = table.select(*C.COLUMNS)
    for stage in (C.near_duplicates, C.repeats):
        out = spark.createDataFrame(stage(spark, out, sf).collect(), out.schema)
    whole = out.where("doc_id = 9002").collect()
    assert len(whole) == 1 and whole[0].text == long  # its copy went, nothing of it is repeated elsewhere
    pieces = C.packing(spark, out, sf).where("doc_id = 9002").orderBy("piece").collect()
    assert len(pieces) > 100 and [p.piece for p in pieces] == list(range(len(pieces)))
    assert all(a.start + a.length == b.start for a, b in zip(pieces, pieces[1:]))


def test_repeats_in_a_text_of_megabytes(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(900))
    body = ["".join(rng.choice("klmnopqrst ") for _ in range(700_000)) for _ in range(2)]
    rows = [(1, body[0] + passage + body[1] + passage[:150]), (2, "x" + passage[100:] + "y"), (3, None), (4, "z" * 199)]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (got[1].n_removed, got[1].n_spans, got[1].n_bytes) == (800, 1, 1_400_000 + 1050)
    kept = (body[0] + passage[:100] + body[1] + passage[:150]).encode()
    assert hashlib.sha256(bytes(got[1].kept)).hexdigest() == hashlib.sha256(kept).hexdigest()
    assert (got[2].n_removed, got[2].n_spans) == (800, 1) and got[4].n_removed == 0 and got[3].n_bytes == 0


def test_vectors_of_other_lengths(spark):
    """Vectors of another length than most take no part, however many there are of one length."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0]) for i in range(6)] + [(200, [1.0]), (300, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("node", F.lit("clash"))
    comps = {r.vec_id: r for r in vector_components(df).collect()}
    assert len(comps) == len(rows)
    assert comps[300].component_id == 0 and comps[0].n_links == 1
    assert all(comps[100 + i].n_links == 0 and comps[100 + i].kept for i in range(6))
    found = {r.vec_id for r in search(df).collect()} | {r.query_id for r in search(df).collect()}
    assert not found & {*range(100, 106), 200} and 300 in found
