"""Tokens with a phrase dictionary of any size (inventory O84, O87).

Gives the tokens that the regex "every phrase, longest first, or a word" gives,
but the dictionary is a table that is joined, not a pattern that grows with it.
Texts are cut at their token starts into pieces, a token and what stands
between it and the next. Phrases are cut likewise, so a phrase has a form: how
many pieces it runs over and how much of the last one it takes. A token that
begins some phrase is looked up once for every form that phrases of that
beginning have (an equi-join on the text itself). A fold over the matches of a
text, from the left and the longest first, then takes those a scanner would
take: a match counts where no earlier one covers its start. A phrase that ends
inside a word leaves the rest of the word to be scanned on, so for such words
every inner position is a start as well; this is repeated while it finds new
ones. A place in a text is the number of its piece times 2^32 and the offset
within that piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.text import WORD_PATTERN
from quarry.sources.io import stored

RUN = r"[a-z[\p{L}&&[^\p{IsHan}]]]"  # a-z are letters too; named first, they are found without a table
_PIECE = 1 << 32
_TAKEN = "array<struct<at:bigint,end:bigint,p:string>>"


def _cut(text: Column, other: str) -> tuple[Column, Column]:
    """(tokens, pieces) of a text, of like length; ``other``: characters that are starts besides words, as a class."""
    pattern = F.lit(rf"({RUN}+|[\p{{IsHan}}{other}])[^a-z\p{{L}}\p{{IsHan}}{other}]*")
    return F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(0))


def _found(starts: DataFrame, beginnings: DataFrame, entries: DataFrame, inner: Sequence[int]) -> DataFrame:
    """(row, at, p, end, open): the phrases at every start (row, i, off, toks, pieces); both arrays begin there and
    hold as many pieces as the longest phrase has; ``open``: the match ends inside a word."""
    met = starts.withColumn("t", F.get("toks", F.lit(0))).join(beginnings, "t", "left" if inner else "inner")
    forms = F.col("forms")
    if inner:  # phrases within one word: their lengths are tried at every word
        any_word = F.array(*[F.struct(F.lit(1).alias("k"), F.lit(True).alias("part"), F.lit(n).alias("n")) for n in inner])
        forms = F.concat(F.coalesce(forms, F.array().cast("array<struct<k:int,part:boolean,n:int>>")), any_word)
    met = met.select("row", "i", "off", "toks", "pieces", F.explode(forms).alias("f")).where("f.k <= size(pieces)")
    met = (met.withColumn("last", F.expr("get(pieces, f.k - 1)")).withColumn("word", F.expr("length(get(toks, f.k - 1))"))
           .withColumn("n", F.expr("if(f.part, f.n, word + f.n)"))
           .where("if(f.part, n <= word, n <= length(last))")
           .select("row", "i", "off", F.col("f.k").alias("k"), "n", F.expr("f.part AND n < word").alias("open"),
                   F.expr("concat(array_join(slice(pieces, 1, f.k - 1), ''), substring(last, 1, n))").alias("p")))
    met = met.join(entries.select("p"), "p")
    end = F.expr(f"if(open, (i + k - 1) * {_PIECE} + if(k = 1, off, 0) + n, (i + k) * {_PIECE})")
    return met.select("row", F.expr(f"i * {_PIECE} + off").alias("at"), "p", end.alias("end"), "open")


def phrase_matches(texts: DataFrame, phrases: DataFrame, phrase: str = "phrase") -> tuple[DataFrame, str]:
    """(row, taken) and the characters besides words that phrases begin with (as a class): for every row of ``texts``
    (row, text; lower-cased) with a match, the matches that a scan from the left takes, as an array of
    (at, end, p): where the phrase ``p`` is and where the scan goes on."""
    known = phrases.select(F.lower(F.col(phrase)).alias("p")).where("p <> ''").distinct()
    known = stored(known, "phrases")
    # phrases that begin with something else than a word: their first characters are starts too (a set of characters)
    others = known.where(~F.expr("substring(p, 1, 1)").rlike(WORD_PATTERN)).select(F.expr("substring(p, 1, 1)").alias("ch"))
    other = "".join("\\x{%x}" % ord(r["ch"]) for r in others.distinct().collect())
    toks, pieces = _cut(F.col("p"), other)
    entries = (known.select("p", toks.alias("toks"), pieces.alias("pieces"))
               .select("p", F.get("toks", F.lit(0)).alias("t"), F.size("toks").alias("k"), F.element_at("toks", -1).alias("tok"),
                       F.length(F.element_at("pieces", -1)).alias("n"))
               .withColumn("part", (F.length("tok") == F.col("n")) & F.col("tok").rlike(f"^{RUN}"))
               .select("p", "t", "k", "part", F.expr("if(part, n, n - length(tok))").alias("n")))
    entries = stored(entries, "phrase-entries")
    within = "k = 1 AND part"
    size = entries.agg(F.max("k").alias("k"), F.max("part").alias("part"),
                       F.sort_array(F.collect_set(F.expr(f"if({within}, n, NULL)"))).alias("inner")).first()
    if size["k"] is None:
        return texts.sparkSession.createDataFrame([], f"row bigint, taken {_TAKEN}"), other
    form = F.struct("k", "part", "n")
    beginnings = stored(entries.where(f"NOT ({within})").groupBy("t").agg(F.collect_set(form).alias("forms")), "phrase-beginnings")
    toks, pieces = _cut(F.col("text"), other)
    cut = texts.select("row", toks.alias("ts"), pieces.alias("ps"))
    ahead = [F.expr(f"slice({c}, CAST(i AS int) + 1, {size['k']})") for c in ("ts", "ps")]
    starts = (cut.select("row", "ts", "ps", F.posexplode("ts").alias("i", "tok"))
              .select("row", F.col("i").cast("bigint").alias("i"), F.lit(0).alias("off"), ahead[0].alias("toks"), ahead[1].alias("pieces")))
    every = _found(starts, beginnings, entries, size["inner"])
    if size["part"]:
        # words that some match ends inside: the scan may go on from any place in them
        found = every = stored(every, "phrase-found")
        done = None
        while True:
            ends = found.where("open").groupBy("row").agg(F.collect_set("end").alias("ends"))
            inside = (ends.join(cut, "row").select("row", "ts", "ps", F.explode("ends").alias("end"))
                      .select("row", F.expr(f"end DIV {_PIECE}").alias("i"), F.expr(f"CAST(end % {_PIECE} AS int)").alias("from"), "ts", "ps")
                      .select("row", "i", "from", ahead[0].alias("toks"), ahead[1].alias("pieces")))
            new = inside.select("row", "i", F.explode(F.expr("sequence(from, length(toks[0]) - 1)")).alias("off"), "toks", "pieces")
            rest = [F.expr(f"concat(array(substring({c}[0], off + 1)), slice({c}, 2, {size['k']}))").alias(c) for c in ("toks", "pieces")]
            new = new.select("row", "i", "off", *rest).dropDuplicates(["row", "i", "off"])
            if done is not None:
                new = new.join(done, ["row", "i", "off"], "left_anti")
            new = stored(new, "phrase-starts")
            if new.isEmpty():
                break
            found = stored(_found(new, beginnings, entries, size["inner"]), "phrase-found")
            every = every.unionAll(found)
            places = new.select("row", "i", "off")
            done = places if done is None else done.unionAll(places)

    def take(state, m):
        free = (m["at"] >= state["end"]) & ((m["at"] % _PIECE == 0) | (m["at"] == state["end"]))
        one = F.struct(m["at"].alias("at"), m["end"].alias("end"), m["p"].alias("p"))
        return F.when(free, F.struct(m["end"].alias("end"), F.array_append(state["taken"], one).alias("taken"))).otherwise(state)

    first = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast(_TAKEN).alias("taken"))
    longest_first = F.struct("at", (-F.length("p")).alias("less"), "end", "p")
    return (every.groupBy("row").agg(F.sort_array(F.collect_list(longest_first)).alias("m"))
            .select("row", F.aggregate("m", first, take, lambda s: s["taken"]).alias("taken"))), other


def phrase_tokens(docs: DataFrame, phrases: DataFrame, text: str = "text", phrase: str = "phrase",
                  stop_words: Sequence[str] | None = None, name: str = "toks") -> DataFrame:
    """``docs`` with the array ``name`` of lower-cased tokens, phrases kept whole (blanks in them removed, O84).

    A null text has null tokens, an empty one none. Empty and null phrases are
    ignored; with an empty dictionary the tokens are the words. Rows that
    repeat are each tokenised.
    """
    even = docs.repartition(docs.sparkSession.sparkContext.defaultParallelism)  # texts are cut in tasks of like size
    rows = stored(even.withColumn("_row", F.monotonically_increasing_id()), "phrase-texts")
    texts = rows.select(F.col("_row").alias("row"), F.lower(F.col(text)).alias("text")).where("text IS NOT NULL")
    taken, other = phrase_matches(texts, phrases, phrase)
    out = rows.join(taken.select(F.col("row").alias("_row"), F.col("taken").alias("_taken")), "_row", "left")

    def words(tokens):
        return F.filter(tokens, lambda t: t.rlike(f"^(?:{WORD_PATTERN})")) if other else tokens

    def segment(ts, taken, j):
        """The words between two taken matches and the second of them."""
        here = F.get(taken, j)
        begin = F.coalesce(F.get(taken, j - 1)["end"], F.lit(0))
        stop = F.coalesce(here["at"], F.size(ts) * F.lit(_PIECE))
        i, off = F.floor(begin / _PIECE).cast("int"), (begin % _PIECE).cast("int")
        n = F.floor(stop / _PIECE).cast("int") - i
        tail = F.concat(F.array(F.substr(F.get(ts, i), off + 1)), F.slice(ts, i + 2, F.greatest(n - 1, F.lit(0))))
        between = F.when(begin == stop, F.slice(ts, 1, 0)).when(off > 0, tail).otherwise(F.slice(ts, i + 1, F.greatest(n, F.lit(0))))
        return F.when(here.isNull(), words(between)).otherwise(F.array_append(words(between), F.replace(here["p"], F.lit(" "), F.lit(""))))

    def kept(s):
        held = F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["taken"])), lambda j: segment(s["ts"], s["taken"], j)))
        return F.when(s["taken"].isNull(), words(s["ts"])).otherwise(held)

    # an array of one struct: its fields are worked out once a text, not at every use
    ts = F.regexp_extract_all(F.lower(F.col(text)), F.lit(rf"{RUN}+|[\p{{IsHan}}{other}]"), F.lit(0))
    toks = F.get(F.transform(F.array(F.struct(ts.alias("ts"), F.col("_taken").alias("taken"))), kept), F.lit(0))
    if stop_words:
        toks = F.filter(toks, lambda t: ~t.isin(*stop_words))
    return out.withColumn(name, toks).drop("_row", "_taken")
