import duckdb
from pyspark.sql import functions as F

from quarry.llm.quote_linking import ORACLE_SQL, link_quotes

ROWS = [
    (1, 0, "user", "Hello there\nhow are you?\n\nSecond para"), (1, 1, "assistant", "> Hello there\n> how are you?\n\nFine."),
    (1, 2, "user", "> > Hello there\n>> how are you?\n> Fine.\nGood\nok"), (1, 3, "user", ">  good OK \nnew"),
    (1, 4, "x", None), (1, 5, "x", ""), (1, 5, "y", ">nothing known\n>>Fine.\nz"), (1, 6, "u", ">Second para\nlast"),
    (2, 0, "user", "Hello there"), (2, 1, "u", "> Second para"), (2, 2, "u", "> hello   THERE"),
    (2, 2, "u", "> hello   THERE"), (None, 1, "u", "> hello   THERE"), (3, None, "u", "q"), (3, 1, "u", ">q"),
    (4, 0, "a", "line1\nline2"), (4, 1, "a", " \t> line1\n\t>line2\n> \n> more\nx\n\n"), (4, 2, None, "> line1 line2\n"),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def as_set(rows, cols):
    return sorted((tuple(None if v is None else str(v) for v in r) for r in rows), key=str), cols


def compare(spark, df):
    got = link_quotes(df)
    cols = sorted(got.columns)
    c = duckdb.connect()
    c.register("conversations", df.select(*SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")).toArrow())
    want = c.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL})").fetchall()
    assert as_set([tuple(r) for r in got.select(*cols).collect()], cols) == as_set(want, cols)
    return {(r.conv_id, r.turn, r.role): r for r in got.collect()}


def test_links_and_sql_agree(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("level", F.lit(1)).withColumn("body", F.lit("clash"))
    r = compare(spark, df)
    assert [r[1, t, w].parent_turn for t, w in ((1, "assistant"), (2, "user"), (3, "user"), (6, "u"))] == [0, 1, 2, 0]
    assert r[1, 3, "user"].depth == 3 and r[1, 3, "user"].root_turn == 0
    assert r[1, 2, "user"].text == "Good\nok" and r[1, 2, "user"].max_level == 2
    assert r[2, 1, "u"].parent_turn is None  # said in another conversation only
    assert r[None, 1, "u"].parent_turn is None and r[3, 1, "u"].parent_turn is None
    assert r[4, 1, "a"].text == "x"


def test_reply_order_puts_replies_after_their_source(spark):
    r = link_quotes(spark.createDataFrame(ROWS, SCHEMA)).where("conv_id = 1").orderBy("reply_pos").collect()
    assert [x.reply_pos for x in r] == list(range(1, len(r) + 1))
    at = {x.turn: x.reply_pos for x in r}
    assert all(at[x.parent_turn] < x.reply_pos for x in r if x.parent_turn is not None)


def test_long_chain_and_hot_greeting(spark):
    chain = [(1, i, "u", f"> said {i - 1}\nsaid {i}") for i in range(70)]
    greet = [(10 + i % 7, i, "u", "hi" if i % 2 else "> hi\nyes") for i in range(300)]
    r = compare(spark, spark.createDataFrame(chain + greet, SCHEMA))
    assert r[1, 69, "u"].depth == 69 and r[1, 69, "u"].root_turn == 0


def test_empty_table_and_given_table(spark, sf001):
    assert link_quotes(spark.createDataFrame([], SCHEMA)).count() == 0
    compare(spark, spark.read.parquet(f"{sf001}/conversations.parquet"))


def test_only_dataframe_operations(spark, sf001):
    plan = link_quotes(spark.read.parquet(f"{sf001}/conversations.parquet"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_trimmed_quotes_and_very_long_texts(spark):
    rows = [(1, 0, "a", "First point.\nSecond point, longer.\nThird."), (1, 1, "b", "> second point,  longer.\n\nAgreed."),
            (1, 2, "a", "Other\nThird."), (1, 3, "b", ">Third.\n>Other"),  # lines of two messages: the later one answers
            (1, 4, "b", ">Second point\nno"),  # part of a line: unlinked
            (1, 5, "c", "> First point.\n> Second point, longer.\n> Third.\nall"),  # a whole passage before any line
            (2, 0, "a", "x" * 300_000 + "\n" + "line\n" * 50_000), (2, 1, "b", "> " + "x" * 300_000)]
    r = compare(spark, spark.createDataFrame(rows, SCHEMA))
    got = [r[1, t, w].parent_turn for t, w in ((1, "b"), (3, "b"), (4, "b"), (5, "c"))]
    assert got == [0, 2, None, 0] and r[2, 1, "b"].parent_turn == 0
