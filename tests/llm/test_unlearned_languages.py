import random
import string

import pytest

import corpus_pipeline as C

FINNISH = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
           "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. ")
POLISH = ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i "
          "sumieniem i powinni postępować wobec innych w duchu braterstwa. ")
RUSSIAN = "Все люди рождаются свободными и равными в своем достоинстве и правах. "


@pytest.mark.parametrize("langs", [("en", "de", "fr", "es"), ("en", "de"), ("en",)])
def test_texts_in_no_learned_language_go(spark, sf001, langs):
    rng = random.Random(3)
    letters = [" ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(n))
               for n in (10, 200, 2000)]
    planted = [FINNISH, FINNISH * 30, POLISH, POLISH * 30, RUSSIAN, *letters]
    docs = spark.read.parquet(f"{sf001}/documents.parquet").where(f"lang in {tuple(langs) + ('',)}")
    extra = spark.createDataFrame([(90_000 + i, t, None, "s", len(t)) for i, t in enumerate(planted)], docs.schema)
    kept = {r.doc_id for r in C.language(spark, docs.unionByName(extra), sf001).select("doc_id").collect()}
    assert not [planted[i - 90_000][:40] for i in kept if i >= 90_000]
    learned = {r.doc_id for r in docs.select("doc_id").collect()}
    assert len(learned - kept) <= 0.02 * len(learned)
