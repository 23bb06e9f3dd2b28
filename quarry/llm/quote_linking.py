"""Chat formatting by quotation linking (operator 2), DataFrame operations only.

Lines that start with ``>`` marks are quotes, their nesting level is the
number of marks. Runs of lines of one level are passages; a blank line parts
their paragraphs. Quoted passages, paragraphs and single lines (of trimmed
quotes) are normalised (lower case, white space collapsed), hashed, and joined
to the first message of the same conversation whose own text, or a paragraph or
a line of it, has that hash and that came earlier. The lowest quote level, then
whole passages before paragraphs before lines, then the latest such message
decides what a message replies to. Threads are found
by pointer doubling; messages are put in reply order: thread by thread, a
reply always after what it answers, quotes removed.

Only aggregates with a partial step meet on a hash, so a greeting that a third
of all messages share is one row per task; positions come from a distributed
sort, so a conversation of any size is never gathered.

Defined cases: rows equal in all four columns are one message; a null text has
no lines and an empty own text; a null conv_id or turn links with nothing and
is a thread of its own; a quote of a later or unknown message, or of a part of a line,
stays unlinked; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._shared import materialise
from quarry.operators.tables import serial_number

MARKS = r"^([ \t]*>)+[ \t]?"
_KEY = ("conv_id", "turn", "_m")


def _norm(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\r\n]+", " "))


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def _joined(lines: str = "_l") -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "body"))), lambda x: x["body"]), "\n")


def quote_lines(messages: DataFrame) -> DataFrame:
    """One row per line: level, body, number of its passage and of its paragraph."""
    lines = messages.select(*_KEY, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    mark = F.regexp_extract("line", MARKS, 0)
    lines = lines.select(*_KEY, "pos", F.length(F.regexp_replace(mark, "[^>]", "")).alias("level"),
                         F.expr("substring(line, length(regexp_extract(line, '^([ \\\\t]*>)+[ \\\\t]?', 0)) + 1)")
                         .alias("body"))
    w = Window.partitionBy(*_KEY).orderBy("pos")
    turn = F.coalesce((F.col("level") != F.lag("level").over(w)).cast("int"), F.lit(1))
    lines = lines.withColumn("_new", turn).withColumn("blank", _strip(F.col("body")) == "")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return (lines.withColumn("passage", F.sum("_new").over(upto))
            .withColumn("paragraph", F.sum(F.greatest("_new", F.col("blank").cast("int"))).over(upto)).drop("_new"))


def _threads(replies: DataFrame) -> DataFrame:
    """conv_id, turn, root, depth of every message that replies, by pointer doubling."""
    jump = materialise(replies.select("conv_id", "turn", F.col("parent_turn").alias("root"),
                                      F.lit(1).cast("bigint").alias("depth")), "threads")
    while True:
        up = jump.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("root").alias("_r"),
                         F.col("depth").alias("_d"))
        step = jump.join(up, (F.col("conv_id") == F.col("_c")) & (F.col("root") == F.col("_t")), "left")
        step = materialise(step.select("conv_id", "turn", F.coalesce("_r", "root").alias("root"),
                                       (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"),
                                       F.col("_r").isNotNull().alias("moved")), "threads")
        jump = step.drop("moved")
        if step.where("moved").isEmpty():
            return jump


def link_quotes(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (quotes removed), n_quotes, max_level, parent_turn, root_turn, depth, reply_pos."""
    msgs = (conversations.select("conv_id", "turn", "role", "text").distinct()
            .withColumn("_m", F.xxhash64("role", "text", F.col("text").isNull())))
    msgs = materialise(msgs, "messages")
    lines = materialise(quote_lines(msgs), "quote-lines")
    own = lines.where("level = 0").groupBy(*_KEY).agg(_strip(_joined()).alias("own"))
    own = materialise(own, "own-texts")
    paragraphs = (lines.where("not blank").groupBy(*_KEY, "paragraph", "level").agg(_norm(_joined()).alias("t"))
                  .select(*_KEY, "level", F.lit(1).alias("kind"), F.md5("t").alias("h")))
    passages = (lines.where("level > 0").groupBy(*_KEY, "passage", "level").agg(_norm(_joined()).alias("t"))
                .where("t <> ''").select(*_KEY, "level", F.lit(0).alias("kind"), F.md5("t").alias("h")))
    single = lines.where("not blank").select(*_KEY, "level", F.lit(2).alias("kind"), F.md5(_norm(F.col("body"))).alias("h"))
    said = (own.select("conv_id", "turn", _norm(F.col("own")).alias("t")).where("t <> ''")
            .select("conv_id", "turn", F.md5("t").alias("h"))
            .unionByName(paragraphs.where("level = 0").select("conv_id", "turn", "h"))
            .unionByName(single.where("level = 0").select("conv_id", "turn", "h")))
    first = said.groupBy("conv_id", "h").agg(F.min("turn").alias("said_turn"))
    quotes = passages.unionByName(paragraphs.where("level > 0")).unionByName(single.where("level > 0"))
    best = F.min(F.struct("level", "kind", (-F.col("said_turn")).alias("late")))
    replies = (quotes.join(first, ["conv_id", "h"]).where("said_turn < turn").groupBy("conv_id", "turn")
               .agg(best.alias("b")).select("conv_id", "turn", (-F.col("b.late")).alias("parent_turn")))
    replies = materialise(replies, "replies")
    threads = _threads(replies)
    counts = passages.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_quotes"), F.max("level").alias("max_level"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in _KEY]
    out = msgs.drop("text").alias("l").join(own.alias("r"), same, "left").select("l.*", "own")
    out = out.alias("l").join(counts.alias("r"), same, "left").select("l.*", "n_quotes", "max_level")
    out = out.join(replies, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
    out = out.select(
        "conv_id", "turn", "role", F.coalesce("own", F.lit("")).alias("text"),
        F.coalesce("n_quotes", F.lit(0)).cast("bigint").alias("n_quotes"),
        F.coalesce("max_level", F.lit(0)).cast("int").alias("max_level"), "parent_turn",
        F.coalesce("root", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"), "_m")
    order = [F.col("conv_id"), F.col("root_turn"), F.col("turn"), F.col("role"), F.col("text"), F.col("_m")]
    placed = serial_number(out, order, "_s")
    start = placed.groupBy(F.col("conv_id").alias("_c")).agg(F.min("_s").alias("_f"))
    return (placed.join(start, F.col("conv_id").eqNullSafe(F.col("_c")))
            .withColumn("reply_pos", F.col("_s") - F.col("_f") + 1).drop("_c", "_f", "_s", "_m"))


ORACLE_SQL = r"""
WITH RECURSIVE msgs AS (
  SELECT row_number() OVER (ORDER BY conv_id, turn, role, text) AS m, * FROM
    (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
raw AS (
  SELECT m, conv_id, turn, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos FROM msgs WHERE text IS NOT NULL),
leveled AS (
  SELECT m, conv_id, turn, pos, regexp_extract(line, '^([ \t]*>)+[ \t]?', 0) AS mark, line FROM raw),
lines AS (
  SELECT m, conv_id, turn, pos, length(regexp_replace(mark, '[^>]', '', 'g')) AS level,
         substr(line, length(mark) + 1) AS body FROM leveled),
marked AS (
  SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY m ORDER BY pos) THEN 0 ELSE 1 END AS fresh,
         regexp_replace(body, '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') = '' AS blank FROM lines),
numbered AS (
  SELECT *, sum(fresh) OVER w AS passage, sum(greatest(fresh, blank::INT)) OVER w AS paragraph
  FROM marked WINDOW w AS (PARTITION BY m ORDER BY pos ROWS UNBOUNDED PRECEDING)),
own AS (
  SELECT m, conv_id, turn,
         regexp_replace(string_agg(body, chr(10) ORDER BY pos), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS own
  FROM numbered WHERE level = 0 GROUP BY ALL),
paragraphs AS (
  SELECT m, conv_id, turn, level, 1 AS kind,
         trim(regexp_replace(lower(string_agg(body, chr(10) ORDER BY pos)), '[ \t\r\n]+', ' ', 'g')) AS t
  FROM numbered WHERE NOT blank GROUP BY m, conv_id, turn, level, paragraph),
passages AS (
  SELECT * FROM (SELECT m, conv_id, turn, level, 0 AS kind,
         trim(regexp_replace(lower(string_agg(body, chr(10) ORDER BY pos)), '[ \t\r\n]+', ' ', 'g')) AS t
  FROM numbered WHERE level > 0 GROUP BY m, conv_id, turn, level, passage) WHERE t <> ''),
single AS (
  SELECT m, conv_id, turn, level, 2 AS kind, trim(regexp_replace(lower(body), '[ \t\r\n]+', ' ', 'g')) AS t
  FROM numbered WHERE NOT blank),
said AS (
  SELECT conv_id, t, min(turn) AS said_turn FROM (
    SELECT conv_id, turn, t FROM
      (SELECT conv_id, turn, trim(regexp_replace(lower(own), '[ \t\r\n]+', ' ', 'g')) AS t FROM own) WHERE t <> ''
    UNION ALL SELECT conv_id, turn, t FROM paragraphs WHERE level = 0
    UNION ALL SELECT conv_id, turn, t FROM single WHERE level = 0) GROUP BY ALL),
links AS (
  SELECT q.conv_id, q.turn, q.level, q.kind, s.said_turn FROM
    (SELECT * FROM passages UNION ALL SELECT * FROM paragraphs WHERE level > 0
     UNION ALL SELECT * FROM single WHERE level > 0) q
    JOIN said s ON q.conv_id = s.conv_id AND q.t = s.t AND s.said_turn < q.turn),
replies AS (
  SELECT conv_id, turn, said_turn AS parent_turn FROM links
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, kind, said_turn DESC) = 1),
threads AS (
  SELECT conv_id, turn, parent_turn AS root, 1 AS depth FROM replies
  UNION ALL
  SELECT t.conv_id, t.turn, r.parent_turn, t.depth + 1 FROM threads t
    JOIN replies r ON r.conv_id = t.conv_id AND r.turn = t.root),
tops AS (
  SELECT conv_id, turn, root, depth FROM threads
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY depth DESC) = 1),
counts AS (SELECT m, count(*) AS n_quotes, max(level) AS max_level FROM passages GROUP BY m),
flat AS (
  SELECT a.conv_id, a.turn, a.role, coalesce(own.own, '') AS text, coalesce(n_quotes, 0) AS n_quotes,
         coalesce(max_level, 0)::INT AS max_level, r.parent_turn, coalesce(t.root, a.turn) AS root_turn,
         coalesce(t.depth, 0)::BIGINT AS depth, a.m
  FROM msgs a LEFT JOIN own ON own.m = a.m LEFT JOIN counts c ON c.m = a.m
    LEFT JOIN replies r ON r.conv_id = a.conv_id AND r.turn = a.turn
    LEFT JOIN tops t ON t.conv_id = a.conv_id AND t.turn = a.turn)
SELECT conv_id, turn, role, text, n_quotes, max_level, parent_turn, root_turn, depth,
       row_number() OVER (PARTITION BY conv_id ORDER BY root_turn NULLS FIRST, turn NULLS FIRST,
                          role NULLS FIRST, text NULLS FIRST, m) AS reply_pos
FROM flat
"""
