"""Driver queries: word count, TF-IDF, naive Bayes (family D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import text as X
from quarry.plans.registry import query
from quarry.sources.io import load, stored

_STOP_SQL = ", ".join(f"'{w}'" for w in X.STOP_WORDS)

_TOKENS_SQL = f"""
WITH toks AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) AS term FROM documents),
tf AS (
  SELECT doc_id, term, count(*) AS tf FROM toks WHERE term NOT IN ({_STOP_SQL}) GROUP BY doc_id, term)
"""


_TOP_WORDS_SQL = """
WITH lines AS (SELECT unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS line FROM documents),
toks AS (
  SELECT CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
              ELSE string_split(rtrim(line, ' '), ' ') END AS ws FROM lines),
w AS (SELECT unnest(ws) AS word FROM toks)
SELECT word, count(*) AS count FROM w GROUP BY word ORDER BY count DESC, word LIMIT 20
"""


@query("word_count_top", ops="O01 O46 O61 O75", sql=_TOP_WORDS_SQL)
def word_count_top(spark, sf):
    docs = load(spark, sf, "documents").select("text")
    counts = X.word_count(X.words(X.text_lines(docs)))
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(20)


@query("top_words_exact", ops="O51 O61 O66 (bounded summaries)", sql=_TOP_WORDS_SQL)
def top_words_exact(spark, sf):
    """The same list from task summaries and an exact count of what they leave in question."""
    from quarry.operators.heavy import top_values_exact

    words = X.words(X.text_lines(load(spark, sf, "documents").select("text")))
    return top_values_exact(words, "word", 20).rows.select(F.col("value").alias("word"), "count")


def doc_terms(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", X.tokens("text", stop_words=None).alias("toks"))
    return X.term_counts(docs, "doc_id", "toks", stop_words=X.STOP_WORDS)


@query("tfidf_terms", ops="O86 O88 O89", sql=_TOKENS_SQL + """
, n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT tf.doc_id, tf.term, tf.tf, round(tf.tf * ln((n.n + 1.0) / (df.df + 1)), 6) AS tfidf
FROM tf JOIN df USING (term) CROSS JOIN n
""")
def tfidf_terms(spark, sf):
    n_docs = load(spark, sf, "documents").count()
    out = X.tfidf(doc_terms(spark, sf), "doc_id", n_docs)
    return out.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


@query("naive_bayes_scores", ops="O92 O94", sql=_TOKENS_SQL + """
, docs AS (SELECT doc_id, lang, doc_id IN (SELECT doc_id FROM labels) AS train FROM documents),
ttf AS (SELECT tf.*, docs.lang FROM tf JOIN docs USING (doc_id) WHERE docs.train),
cnt AS (SELECT lang, term, sum(tf) AS cnt FROM ttf GROUP BY lang, term),
v AS (SELECT count(DISTINCT term) AS v FROM cnt),
cls AS (
  SELECT d.lang, d.n, coalesce(t.tot, 0) AS tot FROM
    (SELECT lang, count(*) AS n FROM docs WHERE train GROUP BY lang) d
    LEFT JOIN (SELECT lang, sum(cnt) AS tot FROM cnt GROUP BY lang) t USING (lang)),
model AS (
  SELECT lang, ln(n + 1.0) - ln((SELECT sum(n) FROM cls) + (SELECT count(*) FROM cls) * 1.0) AS pi,
         ln(tot + (SELECT v FROM v) * 1.0) AS den FROM cls),
test AS (SELECT doc_id, lang FROM docs WHERE NOT train),
known AS (SELECT tf.doc_id, tf.term, tf.tf FROM tf JOIN test USING (doc_id)
          WHERE tf.term IN (SELECT term FROM cnt)),
len AS (SELECT doc_id, sum(tf) AS len FROM known GROUP BY doc_id),
sp AS (SELECT k.doc_id, c.lang, sum(k.tf * ln(c.cnt + 1.0)) AS s FROM known k JOIN cnt c USING (term)
       GROUP BY k.doc_id, c.lang),
sc AS (
  SELECT t.doc_id, t.lang, m.lang AS cls,
         m.pi - m.den * coalesce(l.len, 0) + coalesce(sp.s, 0) AS score
  FROM test t CROSS JOIN model m LEFT JOIN len l ON l.doc_id = t.doc_id
  LEFT JOIN sp ON sp.doc_id = t.doc_id AND sp.lang = m.lang)
SELECT doc_id, lang, arg_max(cls, score) AS prediction FROM sc GROUP BY doc_id, lang
""")
def naive_bayes_scores(spark, sf):
    """Train on the documents that have a row in ``labels``, score all others."""
    docs = load(spark, sf, "documents")
    labelled = load(spark, sf, "labels").select("doc_id")
    train_docs = docs.select("doc_id", "lang").join(labelled, "doc_id", "left_semi")
    test_docs = docs.select("doc_id", "lang").join(labelled, "doc_id", "left_anti")
    # Texts meet their labels once and are tokenised once; an id that documents share has all their labels.
    langs = train_docs.groupBy("doc_id").agg(F.collect_list("lang").alias("langs"))
    toks = stored(docs.select("doc_id", "text").join(langs, "doc_id", "left")
                  .select("doc_id", "langs", X.tokens("text", stop_words=None).alias("toks")), "tokens")

    def terms(rows, *keep):
        one = rows.select(*keep, F.explode("toks").alias("term")).where(~F.col("term").isin(*X.STOP_WORDS))
        return one.withColumn("tf", F.lit(1).cast("bigint"))

    train = toks.where("langs IS NOT NULL").select("doc_id", F.explode("langs").alias("lang"), "toks")
    model = X.ExactNaiveBayes(1.0).fit(terms(train, "doc_id", "lang"), train_docs, "doc_id", "lang")
    return model.predict(terms(toks.where("langs IS NULL"), "doc_id"), test_docs, "doc_id")


# User phrases kept whole by the tokeniser in ``phrase_terms``.
PHRASES = ["of the", "on the", "and the"]


@query("phrase_terms", ops="O84 O86 O87", sql=f"""
WITH toks AS (
  SELECT replace(unnest(regexp_extract_all(lower(text), 'and the|of the|on the|\\p{{L}}+')), ' ', '') AS term
  FROM documents)
SELECT term, count(*) AS count FROM toks WHERE term NOT IN ({_STOP_SQL}) GROUP BY term
""")
def phrase_terms(spark, sf):
    docs = load(spark, sf, "documents")
    toks = docs.select(F.explode_outer(X.tokens("text", phrases=PHRASES)).alias("term")).where(F.col("term").isNotNull())
    return toks.groupBy("term").agg(F.count(F.lit(1)).alias("count"))


@query("phrase_dictionary_terms", ops="O84 O86 O87 (dictionary of any size)", sql=f"""
WITH bw AS (SELECT list_filter(string_split_regex(lower(text), '[^\\p{{L}}]+'), lambda x: x <> '') AS ws FROM benchmark),
dict AS (SELECT DISTINCT ws[i] || ' ' || ws[i + 1] || ' ' AS p FROM (SELECT ws, unnest(range(1, len(ws))) AS i FROM bw)),
t AS (SELECT doc_id, lower(text) AS x FROM documents),
toks AS (
  SELECT doc_id, unnest(range(len(regexp_extract_all(x, '\\p{{L}}+')))) AS i, unnest(regexp_extract_all(x, '\\p{{L}}+')) AS w,
         unnest(regexp_extract_all(x, '\\p{{L}}+([^\\p{{L}}]*)', 1)) AS sep FROM t),
nxt AS (SELECT *, lead(w) OVER d AS w2, lead(sep) OVER d AS sep2 FROM toks WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT n.*, dict.p IS NOT NULL AS hit FROM nxt n
      LEFT JOIN dict ON dict.p = n.w || ' ' || n.w2 || ' ' AND n.sep = ' ' AND n.sep2[1] = ' '),
isles AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, hit ORDER BY i) AS isle FROM m),
taken AS (SELECT *, hit AND row_number() OVER (PARTITION BY doc_id, hit, isle ORDER BY i) % 2 = 1 AS took FROM isles),
kept AS (SELECT *, coalesce(lag(took) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS covered FROM taken),
terms AS (SELECT CASE WHEN took THEN w || w2 ELSE w END AS term FROM kept WHERE NOT covered)
SELECT term, count(*) AS count FROM terms WHERE term NOT IN ({_STOP_SQL}) GROUP BY term
""")
def phrase_dictionary_terms(spark, sf):
    """Every pair of words that follow each other in a benchmark text is a phrase (with the blank after it)."""
    from quarry.operators.phrases import phrase_tokens

    ws = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    pairs = F.transform(F.sequence(F.lit(1), F.size("ws") - 1),
                        lambda i: F.concat(F.get("ws", i - 1), F.lit(" "), F.get("ws", i), F.lit(" ")))
    dictionary = (load(spark, sf, "benchmark").select(ws.alias("ws")).where(F.size("ws") > 1)
                  .select(F.explode(pairs).alias("phrase")).distinct())
    docs = phrase_tokens(load(spark, sf, "documents").select("text"), dictionary, stop_words=X.STOP_WORDS)
    # explode_outer: explode would have the tokens worked out twice, once to filter texts by their number
    terms = docs.select(F.explode_outer("toks").alias("term")).where(F.col("term").isNotNull())
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("count"))


@query("whitespace_token_counts", ops="O85", sql="""
WITH toks AS (
  SELECT unnest(regexp_split_to_array(regexp_replace(lower(text), '\\s+$', ''), '\\s')) AS word FROM documents)
SELECT word, count(*) AS count FROM toks GROUP BY word
""")
def whitespace_token_counts(spark, sf):
    from pyspark.ml.feature import Tokenizer

    docs = load(spark, sf, "documents").select("text")
    words = Tokenizer(inputCol="text", outputCol="words").transform(docs)
    return (words.select(F.explode_outer("words").alias("word")).where(F.col("word").isNotNull())
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))
