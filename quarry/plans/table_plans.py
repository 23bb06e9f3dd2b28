"""Driver queries over the supplied tables: table jobs (families B, C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import tables as T
from quarry.plans.registry import query
from quarry.session import shared_path
from quarry.sources.io import load, stored

from quarry.fixed import AGE_REFERENCE_YEAR, PIVOT_DEFAULT, PIVOT_VALUES


def _items(spark, sf):
    """Orders stand for the item table, keyed by the order key as text."""
    o = load(spark, sf, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("item"), "o_orderkey", "o_custkey",
                    "o_orderstatus", "o_totalprice", "o_orderdate")


@query("items_without_detail_ranked", ops="O03 O22 O26 O44 O38 O25 O59 O63", sql="""
WITH items AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS item, o_orderkey, o_custkey, o_orderstatus, o_totalprice
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY CAST(o_orderkey AS VARCHAR)
                             ORDER BY o_orderdate DESC, o_totalprice DESC, o_custkey DESC) = 1),
nodetail AS (
  SELECT * FROM items i WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = i.o_orderkey)),
ranked AS (
  SELECT item, o_custkey, o_orderstatus, o_totalprice, TRY_CAST(item AS BIGINT) AS item_long,
         row_number() OVER (ORDER BY TRY_CAST(item AS BIGINT) ASC NULLS FIRST, item ASC) AS serial
  FROM nodetail)
SELECT item, o_custkey, o_orderstatus, o_totalprice, item_long, CAST(serial AS BIGINT) AS serial
FROM ranked
""")
def items_without_detail_ranked(spark, sf):
    # Grouping on the numeric key gives the same groups as the text key and
    # leaves the rows hash-partitioned for the anti join below: one shuffle.
    items = T.keep_last(_items(spark, sf), ["o_orderkey"], ["o_orderdate", "o_totalprice", "o_custkey"])
    detail = load(spark, sf, "lineitem")
    missing = T.anti_join(items, detail, "o_orderkey", "l_orderkey")
    typed = missing.select("item", "o_custkey", "o_orderstatus", "o_totalprice",
                           F.col("item").try_cast("bigint").alias("item_long"))
    ranked = T.serial_number(typed, [F.col("item_long").asc_nulls_first(), F.col("item").asc()])
    return T.cap_rows(ranked, "serial")


@query("keep_last_per_key", ops="O04 O44", sql="""
SELECT event_id, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def keep_last_per_key(spark, sf):
    from quarry.sources.io import read_table
    from quarry.session import table_path

    ev = read_table(spark, "parquet", table_path(sf, "events"))
    last = T.keep_last(ev.select("user_id", "event_id", "ts", "event_type", "value", "props"),
                       ["user_id"], ["ts", "event_id"])
    return last.select("event_id", "user_id", "event_type", "value", "props")


@query("distinct_rows", ops="O45", sql="""
SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem
""")
def distinct_rows(spark, sf):
    return load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("item_detail_join", ops="O36 O37 O24", sql="""
SELECT CAST(o_orderkey AS VARCHAR) AS item, o_orderstatus AS status, o_totalprice,
       CAST(l_orderkey AS VARCHAR) AS detail_item, l_linestatus AS detail_status, l_linenumber, l_quantity
FROM orders JOIN lineitem ON CAST(o_orderkey AS VARCHAR) = CAST(l_orderkey AS VARCHAR)
""")
def item_detail_join(spark, sf):
    # The text keys are made from numeric keys one-to-one, so the join runs on
    # the numbers (8-byte shuffle keys) and the text columns ride along.
    items = load(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("item"),
                                             F.col("o_orderstatus").alias("status"), "o_totalprice")
    detail = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                                F.col("l_orderkey").cast("string").alias("item"),
                                                F.col("l_linestatus").alias("status"), "l_linenumber", "l_quantity")
    j = T.join_prefixed(items, detail, "o_orderkey", "o_orderkey", prefix="detail_")
    return j.select("item", "status", "o_totalprice", "detail_item", "detail_status", "l_linenumber", "l_quantity")


def _ip_points(spark, sf):
    ev = load(spark, sf, "events")
    ip = F.concat_ws(".", F.lit("10"), (F.col("user_id") % 4).cast("string"),
                     (F.col("user_id") % 7).cast("string"), (F.col("user_id") % 256).cast("string"))
    return ev.select("event_id", ip.alias("ip"))


def _range_groups(spark, sf):
    n = load(spark, sf, "nation")
    k, r = F.col("n_nationkey"), F.col("n_regionkey").cast("string")
    first = F.concat(F.lit("10.0."), r, F.lit("."), (k * 10).cast("string"),
                     F.lit("-10.0."), r, F.lit("."), (k * 10 + 14).cast("string"))
    lo2 = (k * 37) % 250
    second = F.concat(F.lit("10.1.1."), lo2.cast("string"), F.lit("-10.1.1."), (lo2 + 5).cast("string"))
    return n.select("n_nationkey", F.array(first, second).alias("ips"))


_RANGE_SQL_PREFIX = """
WITH p AS (
  SELECT event_id, '10.' || (user_id % 4) || '.' || (user_id % 7) || '.' || (user_id % 256) AS ip FROM events),
g AS (
  SELECT n_nationkey, unnest([
    '10.0.' || n_regionkey || '.' || (n_nationkey * 10) || '-10.0.' || n_regionkey || '.' || (n_nationkey * 10 + 14),
    '10.1.1.' || ((n_nationkey * 37) % 250) || '-10.1.1.' || ((n_nationkey * 37) % 250 + 5)]) AS rng
  FROM nation),
b AS (
  SELECT n_nationkey, split_part(rng, '-', 1) AS lo_addr, split_part(rng, '-', 2) AS hi_addr FROM g)
"""


@query("range_membership_join", ops="O40 O76", sql=_RANGE_SQL_PREFIX + """
SELECT DISTINCT p.event_id, p.ip, b.n_nationkey FROM p JOIN b
  ON CAST(split_part(p.ip, '.', 4) AS INT)
     BETWEEN CAST(split_part(b.lo_addr, '.', 4) AS INT) AND CAST(split_part(b.hi_addr, '.', 4) AS INT)
""")
def range_membership_join(spark, sf):
    out = T.range_membership_join(_ip_points(spark, sf), _range_groups(spark, sf), "ip", "ips",
                                  group_key=["n_nationkey"])
    return out.select("event_id", "ip", "n_nationkey")


def _ipnum(col: str) -> str:
    return (f"(CAST(split_part({col}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({col}, '.', 2) AS BIGINT) * 65536"
            f" + CAST(split_part({col}, '.', 3) AS BIGINT) * 256 + CAST(split_part({col}, '.', 4) AS BIGINT))")


@query("range_membership_full", ops="O40 O76 (full address)", sql=_RANGE_SQL_PREFIX + f"""
SELECT DISTINCT p.event_id, p.ip, b.n_nationkey FROM p JOIN b
  ON {_ipnum('p.ip')} BETWEEN {_ipnum('b.lo_addr')} AND {_ipnum('b.hi_addr')}
""")
def range_membership_full(spark, sf):
    out = T.range_membership_join(_ip_points(spark, sf), _range_groups(spark, sf), "ip", "ips",
                                  group_key=["n_nationkey"], match="full")
    return out.select("event_id", "ip", "n_nationkey")


def graph_documents(spark, sf):
    """Nested graph documents made from line items: two nodes per document
    (part and supplier), with null names, empty label lists and null node
    arrays where the source data had them."""
    li = load(spark, sf, "lineitem")
    part_node = F.struct(
        F.col("l_partkey").cast("double").alias("id"),
        F.struct(F.when(F.col("l_linenumber") == 3, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("part-"), F.col("l_partkey").cast("string"))).alias("name")).alias("properties"),
        F.array(F.when(F.col("l_returnflag") == "R", F.lit("Person")).otherwise(F.lit("Company")), F.lit("Node")).alias("labels"))
    supp_node = F.struct(
        F.col("l_suppkey").cast("double").alias("id"),
        F.struct(F.concat(F.lit("supp-"), F.col("l_suppkey").cast("string")).alias("name")).alias("properties"),
        F.when(F.col("l_linestatus") == "O", F.array().cast("array<string>")).otherwise(F.array(F.lit("Company"))).alias("labels"))
    nodes = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.array(part_node, supp_node))
    return li.select(F.struct(F.struct(nodes.alias("nodes")).alias("data")).alias("content"))


@query("flatten_nested", ops="O23 O30 O31 O39 O45 O60 O73 O74", sql="""
SELECT DISTINCT CAST(l_partkey AS DOUBLE) AS node_id,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE 'part-' || l_partkey END AS name
FROM lineitem WHERE l_linenumber <> 7 AND l_returnflag <> 'R'
UNION
SELECT DISTINCT CAST(l_suppkey AS DOUBLE) AS node_id, 'supp-' || l_suppkey AS name
FROM lineitem WHERE l_linenumber <> 7 AND l_linestatus <> 'O'
""")
def flatten_nested(spark, sf):
    from quarry.operators.clean import flatten_company_nodes

    return flatten_company_nodes(graph_documents(spark, sf)).select("node_id", "name")


@query("pivot_popular", ops="O47 O48 O61 O78", sql="""
WITH tops AS (
  SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) AS rk
  FROM events GROUP BY event_type QUALIFY rk <= 20)
SELECT e.user_id,
       COALESCE(arg_min(e.value, e.ts) FILTER (WHERE t.rk = 1), 3.0) AS top1,
       COALESCE(arg_min(e.value, e.ts) FILTER (WHERE t.rk = 2), 3.0) AS top2,
       COALESCE(arg_min(e.value, e.ts) FILTER (WHERE t.rk = 3), 3.0) AS top3,
       COALESCE(arg_min(e.value, e.ts) FILTER (WHERE t.rk = 4), 3.0) AS top4,
       COALESCE(arg_min(e.value, e.ts) FILTER (WHERE t.rk = 5), 3.0) AS top5
FROM events e LEFT JOIN tops t ON e.event_type = t.event_type
GROUP BY e.user_id
""")
def pivot_popular(spark, sf):
    ev = load(spark, sf, "events").select("user_id", "event_type", "value", "ts")
    vals = T.top_values(ev, "event_type", PIVOT_VALUES)
    return T.pivot_first(ev, "user_id", "event_type", "value", "ts", vals, float(PIVOT_DEFAULT),
                         names=[f"top{i + 1}" for i in range(len(vals))])


def ratings(spark, sf):
    """Ratings from line items: user = customer, item = part, rating 1..5."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"),
                    (F.lit(1) + F.col("l_quantity").cast("bigint") % 5).cast("double").alias("rating"))


_RATINGS_SQL = """
WITH ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item, CAST(1 + CAST(l_quantity AS BIGINT) % 5 AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


@query("rating_profile", ops="O49 O50", sql=_RATINGS_SQL + """
SELECT count(rating) AS n, round(avg(rating), 6) AS mean, round(stddev_pop(rating), 6) AS stdev,
       max(rating) AS max, min(rating) AS min FROM ratings
""")
def rating_profile(spark, sf):
    s = T.numeric_summary(ratings(spark, sf), "rating")
    return s.select("n", F.round("mean", 6).alias("mean"), F.round("stdev", 6).alias("stdev"), "max", "min")


@query("value_histogram", ops="O51", sql=_RATINGS_SQL + """
SELECT rating, count(*) AS count FROM ratings GROUP BY rating
""")
def value_histogram(spark, sf):
    return T.value_histogram(ratings(spark, sf), "rating")


@query("group_sizes", ops="O47 O52", sql="""
SELECT o_custkey, count(*) AS size FROM orders GROUP BY o_custkey
""")
def group_sizes(spark, sf):
    return T.group_sizes(load(spark, sf, "orders"), "o_custkey")


@query("column_cardinality", ops="O53", sql="""
SELECT count(DISTINCT c_nationkey) AS distinct_c_nationkey, count(DISTINCT c_mktsegment) AS distinct_c_mktsegment,
       count(DISTINCT c_name) AS distinct_c_name, count(DISTINCT c_acctbal) AS distinct_c_acctbal
FROM customer
""")
def column_cardinality(spark, sf):
    return T.column_cardinality(load(spark, sf, "customer"), ["c_nationkey", "c_mktsegment", "c_name", "c_acctbal"])


@query("age_histogram", ops="O54", sql="""
WITH y AS (SELECT TRY_CAST(split_part(strftime(o_orderdate, '%d-%b-%Y'), '-', 3) AS INT) AS yr FROM orders)
SELECT 1998 - yr AS age, count(*) AS count FROM y WHERE yr IS NOT NULL GROUP BY 1
""")
def age_histogram(spark, sf):
    o = load(spark, sf, "orders").select(F.date_format("o_orderdate", "dd-MMM-yyyy").alias("release"))
    return T.age_histogram(o, "release", ref_year=AGE_REFERENCE_YEAR)


@query("sql_count", ops="O49", sql="""
SELECT count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def sql_count(spark, sf):
    ratings(spark, sf).createOrReplaceTempView("ratings")
    return spark.sql("SELECT count(0) AS n FROM ratings")


@query("composite_sort_top", ops="O62", sql="""
SELECT l_suppkey AS first, l_partkey AS second, l_orderkey, l_linenumber FROM lineitem
ORDER BY first, second, l_orderkey, l_linenumber
""")
def composite_sort(spark, sf):
    li = load(spark, sf, "lineitem").select(F.col("l_suppkey").alias("first"), F.col("l_partkey").alias("second"),
                                            "l_orderkey", "l_linenumber")
    return T.composite_sort(li, "first", "second", "l_orderkey", "l_linenumber")


@query("observed_counters", ops="O56", sql="""
SELECT CAST(sum(l_linenumber) AS BIGINT) AS sum_linenumber, count(*) AS n, min(l_quantity) AS min_quantity,
       max(l_quantity) AS max_quantity
FROM lineitem
""")
def observed_counters(spark, sf):
    # The counting pass runs in a sibling session (same cluster), see T.observed_counters.
    li = load(spark.newSession(), sf, "lineitem")
    # Only fixed-size metrics reach the driver; collecting the values themselves
    # (the source's array accumulator) is shown on ten rows in the tests.
    m = T.observed_counters(li, {
        "sum_linenumber": F.sum("l_linenumber"), "n": F.count(F.lit(1)),
        "min_quantity": F.min("l_quantity"), "max_quantity": F.max("l_quantity")})
    return spark.createDataFrame(
        [(m["sum_linenumber"], m["n"], m["min_quantity"], m["max_quantity"])],
        "sum_linenumber bigint, n bigint, min_quantity double, max_quantity double")


@query("observed_lists", ops="O56 (list)", sql="""
SELECT string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(*) AS n FROM events
""")
def observed_lists(spark, sf):
    """Values collected as a side effect of one pass; the distinct ones, which keeps the metric row small."""
    ev = load(spark.newSession(), sf, "events")  # a sibling session, see T.observed_counters
    m = T.observed_counters(ev, {"types": F.array_join(F.sort_array(F.collect_set("event_type")), ","),
                                 "n": F.count(F.lit(1))}, name="lists")
    return spark.createDataFrame([(m["types"], m["n"])], "types string, n bigint")


@query("top_rows_per_user", ops="O65", sql="""
SELECT o_custkey, o_orderkey, o_totalprice,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
FROM orders QUALIFY rank <= 10
""")
def top_rows_per_user(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return T.top_per_group(o, "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@query("key_frequency", ops="O66", sql="""
SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey ORDER BY count DESC, o_custkey
""")
def key_frequency(spark, sf):
    o = load(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "o_custkey")


@query("titles_lookup", ops="O43", sql="""
WITH t AS (SELECT p_partkey, p_name FROM part
           QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY p_name DESC) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, t.p_name
FROM lineitem LEFT JOIN t ON l_partkey = t.p_partkey
""")
def titles_lookup(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    titles = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return T.lookup_titles(li, titles, "l_partkey", "p_name").select("l_orderkey", "l_linenumber", "l_partkey", "p_name")


_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("export_csv", ops="O12", sql=_CUSTOMER_SQL)
def export_csv(spark, sf):
    from quarry.session import shared_path
    from quarry.sources import io

    c = load(spark, sf, "customer")
    path = shared_path(spark, "export_csv")
    io.export_csv(c, path)
    return io.read_table(spark, "csv", path, schema=c.schema, header="true")


@query("export_parquet", ops="O11 O14", sql=_CUSTOMER_SQL)
def export_parquet(spark, sf):
    from quarry.session import shared_path
    from quarry.sources import io

    c = load(spark, sf, "customer")
    path = shared_path(spark, "export_parquet")
    io.export_parquet(c, path)
    return io.read_table(spark, "parquet", path)


@query("ordinal_scan", ops="O05", sql="""
SELECT c_custkey, c_nationkey FROM customer
""")
def ordinal_scan(spark, sf):
    from quarry.sources.io import ordinal_scan as scan

    return scan(load(spark, sf, "customer"), [0, 2])


@query("daily_distinct", ops="O53 (mergeable)", sql="""
SELECT 'user_id' AS "column", count(DISTINCT user_id) AS exact, TRUE AS within, TRUE AS same_as_one_pass, TRUE AS day_within FROM events
UNION ALL SELECT 'event_type', count(DISTINCT event_type), TRUE, TRUE, TRUE FROM events
UNION ALL SELECT 'event_id', count(DISTINCT event_id), TRUE, TRUE, TRUE FROM events
""")
def daily_distinct(spark, sf):
    """Sketches of each day, added in two runs, against the exact counts, the sketch of one pass, and one day's counts."""
    from quarry.operators import sketches as K

    ev = load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    cols, path = ["user_id", "event_type", "event_id"], shared_path(spark, "daily-sketches")
    odd = F.pmod(F.dayofmonth("day"), F.lit(2)) == 1
    K.add_parts(spark, path, ev.where(odd), "day", cols)
    kept = K.add_parts(spark, path, ev.where(~odd | odd.isNull()), "day", cols)
    once = K.distinct_counts(K.part_sketches(ev, F.lit("all"), cols)).select("column", F.col("estimate").alias("once"))
    last = ev.agg(F.max("day").cast("string")).first()[0]
    day = K.distinct_counts(kept, [last]).select("column", F.col("estimate").alias("of_day"))
    exact, exact_day = T.column_cardinality(ev, cols), T.column_cardinality(ev.where(F.col("day").cast("string") == last), cols)

    def long(wide, name):
        return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"distinct_{c}").alias(name))
                                               for c in cols])).alias("x")).select("x.*")

    err = K.relative_error()
    out = (long(exact, "exact").join(long(exact_day, "exact_day"), "column").join(K.distinct_counts(kept), "column")
           .join(once, "column").join(day, "column"))

    def close(e, x):
        return F.abs(F.col(e) - F.col(x)) <= F.ceil(F.col(x) * err)

    return out.select("column", "exact", close("estimate", "exact").alias("within"),
                      (F.col("estimate") == F.col("once")).alias("same_as_one_pass"), close("of_day", "exact_day").alias("day_within"))


@query("packed_partitions", ops="O98", sql="""
WITH n AS (SELECT count(*) AS n FROM events),
k AS (SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type)
SELECT event_type, n_rows, (k.n_rows > ceil(n.n / 8.0)) AS cut, TRUE AS together, TRUE AS fair FROM k, n
""")
def packed_partitions(spark, sf):
    """Events in eight partitions by their type; types with more rows than a fair share are spread."""
    from quarry.operators.placing import place_by_key

    ev = load(spark, sf, "events").select("event_id", "event_type")
    placed = place_by_key(ev, F.col("event_type"), 8, F.col("event_id"))
    at = placed.rows.select("event_type", F.spark_partition_id().alias("p"))
    cells = stored(at.groupBy("event_type", "p").agg(F.count(F.lit(1)).alias("n")), "packed")
    fair = cells.groupBy("p").agg(F.sum("n").alias("n")).agg(F.max("n").alias("m"), F.sum("n").alias("n")).first()
    even = fair["m"] <= 1.5 * fair["n"] / 8  # within a half of the fair share
    out = cells.groupBy("event_type").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("parts"))
    cut = F.col("n_rows") > F.ceil(F.lit(fair["n"]) / 8)
    return out.select("event_type", "n_rows", cut.alias("cut"), (cut | (F.col("parts") == 1)).alias("together"),
                      F.lit(bool(even)).alias("fair"))
