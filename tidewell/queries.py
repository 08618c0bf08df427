"""The engine's queries over the driver's tables, each with the same as SQL for an independent check."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import __version__
from .functions import arrays, bloom
from .functions.sql import search_hint, version
from .operators.remote import read_remote, remote_splits
from .plans.aggregates import Agg, avg, count, count_distinct, max_, min_, sum_
from .plans.predicates import Call, Local, col
from .sources import local
from .streaming.events import windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as a query, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _dec(c: str, scale: int = 2):
    return F.col(c).cast(f"decimal(18,{scale})")


# Scans, projections and filters.


@query("SELECT r_regionkey, r_name FROM region")
def remote_scan(spark, d):
    return read_remote(spark, d, "region").to_df().select("r_regionkey", "r_name")


@query("SELECT n_nationkey, n_name FROM (SELECT * FROM nation WHERE n_regionkey = 1)")
def remote_scan_sql(spark, d):
    return read_remote(spark, d, sql="SELECT * FROM nation WHERE n_regionkey = 1").select("n_nationkey", "n_name").to_df()


@query("SELECT l_orderkey, l_quantity FROM lineitem")
def projection_pushdown(spark, d):
    return read_remote(spark, d, "lineitem").select("l_orderkey", "l_quantity").to_df()


@query("SELECT s_name, s_suppkey FROM supplier")
def projection_reorder(spark, d):
    return read_remote(spark, d, "supplier", split=True).select("s_name", "s_suppkey").to_df()


@query("SELECT o_orderkey + 1 AS next_key, length(o_orderpriority) AS n, CAST(round_even(o_totalprice, 0) AS BIGINT) AS price FROM orders")
def projection_expr(spark, d):
    return read_remote(spark, d, "orders").to_df().select((F.col("o_orderkey") + 1).alias("next_key"), F.length("o_orderpriority").cast("long").alias("n"), F.bround("o_totalprice").cast("long").alias("price"))


@query("SELECT o_orderkey FROM orders WHERE o_totalprice >= 1000.0 AND o_orderkey <> 7 AND o_orderkey < 50000")
def filter_cmp(spark, d):
    return read_remote(spark, d, "orders").where((col("o_totalprice") >= 1000.0) & (col("o_orderkey") != 7) & (col("o_orderkey") < 50000)).select("o_orderkey").to_df()


@query("SELECT event_id, v FROM (SELECT event_id, nullif(event_type, 'click') AS v FROM events) WHERE v IS NULL OR event_id < 10")
def filter_null(spark, d):
    r = read_remote(spark, d, sql="SELECT event_id, nullif(event_type, 'click') AS v FROM events")
    return r.where(col("v").is_null() | (col("event_id") < 10)).to_df()


@query("SELECT event_id FROM (SELECT event_id, nullif(event_type, 'click') AS v FROM events) WHERE v IS NOT NULL")
def filter_not_null(spark, d):
    return read_remote(spark, d, sql="SELECT event_id, nullif(event_type, 'click') AS v FROM events").where(col("v").is_not_null()).select("event_id").to_df()


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_returnflag = 'R' OR l_returnflag = 'A') AND (l_quantity > 45.0 OR l_discount < 0.01)")
def filter_and_or(spark, d):
    flag = (col("l_returnflag") == "R") | (col("l_returnflag") == "A")
    return read_remote(spark, d, "lineitem").where(flag & ((col("l_quantity") > 45.0) | (col("l_discount") < 0.01))).select("l_orderkey", "l_linenumber").to_df()


@query("SELECT c_custkey FROM customer WHERE c_mktsegment LIKE 'B%' AND length(c_name) > 5 AND NOT c_custkey = 3")
def filter_fallback(spark, d):
    r = read_remote(spark, d, "customer").where(Local("c_mktsegment LIKE 'B%'") & (Call("length", (col("c_name"),)) > 5) & ~(col("c_custkey") == 3))
    return r.select("c_custkey").to_df()


@query("SELECT p_name FROM part WHERE p_size BETWEEN 5 AND 10")
def proj_filter(spark, d):
    return read_remote(spark, d, "part").where(col("p_size").between(5, 10)).select("p_name").to_df()


# Aggregates.


@query("SELECT count(*) AS n FROM lineitem")
def agg_count_star(spark, d):
    return read_remote(spark, d, "lineitem").agg(count(name="n"))


@query("SELECT count(v) AS n, count(*) AS n_all FROM (SELECT nullif(event_type, 'click') AS v FROM events)")
def agg_count_col(spark, d):
    return read_remote(spark, d, sql="SELECT nullif(event_type, 'click') AS v FROM events").agg(count("v", "n"), count(name="n_all"))


@query("SELECT CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem")
def agg_sum(spark, d):
    return read_remote(spark, d, "lineitem").agg(sum_("l_linenumber", "total"))


@query("SELECT min(o_orderdate) AS first, max(o_orderdate) AS last, min(o_orderpriority) AS low, max(o_totalprice) AS high FROM orders")
def agg_min_max(spark, d):
    return read_remote(spark, d, "orders").agg(min_("o_orderdate", "first"), max_("o_orderdate", "last"), min_("o_orderpriority", "low"), max_("o_totalprice", "high"))


@query("SELECT CAST(CAST(avg(l_linenumber) AS DECIMAL(18,9)) AS DOUBLE) AS mean FROM lineitem")
def agg_avg(spark, d):
    return read_remote(spark, d, "lineitem").agg(avg("l_linenumber", "mean")).select(F.col("mean").cast("decimal(18,9)").cast("double").alias("mean"))


@query("SELECT count(DISTINCT l_suppkey) AS n FROM lineitem")
def agg_count_distinct(spark, d):
    return read_remote(spark, d, "lineitem").agg(count_distinct("l_suppkey", "n"))


@query("SELECT count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem WHERE l_returnflag = 'N' AND l_quantity >= 10.0")
def agg_filter(spark, d):
    return read_remote(spark, d, "lineitem").where((col("l_returnflag") == "N") & (col("l_quantity") >= 10.0)).agg(count(name="n"), sum_("l_linenumber", "total"))


@query("SELECT count(*) FILTER (WHERE l_returnflag = 'N') AS n, CAST(sum(l_linenumber * 2) AS BIGINT) AS total FROM lineitem")
def agg_expression(spark, d):
    return read_remote(spark, d, "lineitem").agg(count(name="n", where=col("l_returnflag") == "N"), sum_(col("l_linenumber") * 2, "total"))


@query("SELECT count(*) AS n, CAST(CAST(stddev(l_linenumber) AS DECIMAL(18,6)) AS DOUBLE) AS dev FROM lineitem")
def agg_mixed_fallback(spark, d):
    return read_remote(spark, d, "lineitem", split=True).agg(count(name="n"), Agg("stddev", col("l_linenumber"), "dev")).select("n", F.col("dev").cast("decimal(18,6)").cast("double").alias("dev"))


@query("SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total, min(o_orderkey) AS low FROM orders WHERE o_orderkey < -1")
def agg_empty(spark, d):
    return read_remote(spark, d, "orders", split=True, split_size=50_000).where(col("o_orderkey") < -1).agg(count(name="n"), sum_("o_orderkey", "total"), min_("o_orderkey", "low"))


@query("SELECT l_returnflag, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total, max(l_shipdate) AS last FROM lineitem GROUP BY l_returnflag")
def agg_group_by(spark, d):
    return read_remote(spark, d, "lineitem").group_by("l_returnflag").agg(count(name="n"), sum_("l_linenumber", "total"), max_("l_shipdate", "last"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_quantity) AS low FROM lineitem GROUP BY l_returnflag, l_linestatus")
def agg_group_by_multi(spark, d):
    return read_remote(spark, d, "lineitem").group_by("l_returnflag", "l_linestatus").agg(count(name="n"), min_("l_quantity", "low"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice >= 2000.0 GROUP BY o_orderpriority HAVING count(*) > 2")
def agg_filter_group(spark, d):
    return read_remote(spark, d, "orders").where(col("o_totalprice") >= 2000.0).group_by("o_orderpriority").agg(count(name="n")).where("n > 2")


@query("SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price, CAST(max(CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS tax, CAST(min(l_linenumber) AS TINYINT) AS low FROM lineitem GROUP BY l_returnflag")
def agg_types_decimal(spark, d):
    df = read_remote(spark, d, "lineitem").to_df()
    return df.groupBy("l_returnflag").agg(F.sum(_dec("l_extendedprice")).cast("double").alias("price"), F.max(F.col("l_tax").cast("decimal(4,2)")).cast("double").alias("tax"), F.min("l_linenumber").cast("byte").alias("low"))


# Splits.


@query("SELECT count(*) AS n FROM lineitem")
def split_count(spark, d):
    return read_remote(spark, d, "lineitem", split=True, split_size=100_000).agg(count(name="n"))


@query("SELECT CAST(sum(l_partkey) AS BIGINT) AS total, min(l_shipdate) AS first, max(l_extendedprice) AS high FROM lineitem")
def split_sum_min_max(spark, d):
    return read_remote(spark, d, "lineitem", split=True, split_size=100_000).agg(sum_("l_partkey", "total"), min_("l_shipdate", "first"), max_("l_extendedprice", "high"))


@query("SELECT CAST(CAST(avg(l_linenumber) AS DECIMAL(18,9)) AS DOUBLE) AS mean FROM lineitem WHERE l_quantity > 3.0")
def split_avg(spark, d):
    return read_remote(spark, d, "lineitem", split=True, split_size=100_000).where(col("l_quantity") > 3.0).agg(avg("l_linenumber", "mean")).select(F.col("mean").cast("decimal(18,9)").cast("double").alias("mean"))


@query("SELECT count(DISTINCT l_partkey) AS n FROM lineitem")
def split_count_distinct(spark, d):
    return read_remote(spark, d, "lineitem", split=True, split_size=100_000).agg(count_distinct("l_partkey", "n"))


@query("SELECT l_linestatus, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS total FROM lineitem GROUP BY l_linestatus")
def split_group_by(spark, d):
    return read_remote(spark, d, "lineitem", split=True, split_size=100_000).group_by("l_linestatus").agg(count(name="n"), sum_("l_orderkey", "total"))


@query("SELECT true AS same_count, true AS same_sum, count(*) AS n FROM orders")
def split_vs_nonsplit(spark, d):
    aggs = [count(name="n"), sum_("o_orderkey", "s")]
    whole = read_remote(spark, d, "orders").agg(*aggs)
    parts = read_remote(spark, d, "orders", split=True, split_size=20_000).agg(*(a.named(a.alias + "2") for a in aggs))
    return whole.crossJoin(parts).select((F.col("n") == F.col("n2")).alias("same_count"), (F.col("s") == F.col("s2")).alias("same_sum"), "n")  # one row each


def _together(spark, found: DataFrame, *columns) -> DataFrame:
    """The rows that the queries of splits give, opened side by side, as each reads a file's schema."""
    queries = [r.query for r in found.select("query").collect()]  # a row for each split
    with ThreadPoolExecutor(8) as pool:
        parts = list(pool.map(inheritable_thread_target(spark)(lambda q: spark.sql(q).select(*columns)), queries))
    while len(parts) > 1:  # in pairs, as each union is analysed with all that it is of
        parts = [reduce(DataFrame.unionAll, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


@query("SELECT l_orderkey, l_linenumber FROM lineitem")
def split_scan_covers(spark, d):
    """Each split's own query, and their union."""
    return _together(spark, remote_splits(spark, d, "lineitem", split_size=200_000), "l_orderkey", "l_linenumber")


@query("SELECT true AS own_ids, true AS sound, count(*) AS n_rows FROM lineitem")
def splits(spark, d):
    """The splits of a table: their ids and checksums, and the rows that their queries give together."""
    found = remote_splits(spark, d, "lineitem", split_size=200_000)
    rows = _together(spark, found, F.lit(1))
    said = found.agg((F.count("*") == F.count_distinct("query_id")).alias("own_ids"), F.bool_and(F.md5("query") == F.col("query_checksum")).alias("sound"))
    return said.crossJoin(rows.agg(F.count("*").alias("n_rows")))  # one row each


# Functions of arrays and Bloom filters.

_H = "split(text, ' ')"
_N = "CASE lang WHEN 'en' THEN array('the', NULL) WHEN 'de' THEN array('und', 'der') WHEN 'fr' THEN array('no such word') WHEN 'es' THEN array() END"
_ON = "CASE lang WHEN 'en' THEN ['the', NULL] WHEN 'de' THEN ['und', 'der'] WHEN 'fr' THEN ['no such word'] WHEN 'es' THEN [] END"


def _needles(spark, d) -> DataFrame:
    df = read_remote(spark, d, "documents").to_df()
    return df.select("doc_id", F.expr(_H).alias("h"), F.expr(_N).cast("array<string>").alias("n"))


_ALL = "CASE WHEN h IS NULL OR n IS NULL THEN NULL WHEN len(n) = 0 THEN true WHEN len(h) = 0 THEN false ELSE list_has_all(h, list_filter(n, lambda x: x IS NOT NULL)) END"
_DOCS = f"(SELECT doc_id, string_split(text, ' ') AS h, CAST({_ON} AS VARCHAR[]) AS n FROM documents)"


@query(f"SELECT doc_id, {_ALL} AS found FROM {_DOCS}")
def array_contains_all(spark, d):
    return _needles(spark, d).select("doc_id", arrays.array_contains_all("h", "n").alias("found"))


@query(f"SELECT doc_id, {_ALL} AS found FROM {_DOCS}")
def array_contains_all_rowmode(spark, d):
    return _needles(spark, d).select("doc_id", arrays.array_contains_all("h", "n", columnar=False).alias("found"))


@query(f"SELECT doc_id, {_ALL} AS found FROM {_DOCS}")
def array_contains_all_bloom(spark, d):
    rows = _needles(spark, d).withColumn("f", bloom.bloom_filter_create("h"))
    return rows.select("doc_id", arrays.array_contains_all("h", "n", blob="f").alias("found"))


def _whole(spark, d) -> DataFrame:
    return read_remote(spark, d, "documents").to_df().select("doc_id", F.expr(_H).alias("items"))


# A row for each bit that is set, then for each byte: lists would take items times size.
_BITS = """WITH s AS (SELECT *, CAST(ceil(least(greatest(greatest(len(items), 1) * 10, 64), 8388608) / 8.0) * 8 AS BIGINT) AS m FROM (SELECT doc_id, string_split(text, ' ') AS items FROM documents)),
x AS (SELECT DISTINCT doc_id, m, unnest(items) AS x FROM s),
b AS (SELECT doc_id, m, CAST('0x' || substr(md5(x), 1, 12) AS BIGINT) AS b FROM x WHERE x IS NOT NULL),
p AS (SELECT DISTINCT doc_id, (b + i * (b >> 16) + i * i) % m AS p FROM b, range(3) AS t(i))"""
_LE = "substr(printf('%08X', m), 7, 2) || substr(printf('%08X', m), 5, 2) || substr(printf('%08X', m), 3, 2) || substr(printf('%08X', m), 1, 2)"


@query(f"""{_BITS},
g AS (SELECT doc_id, p // 8 AS j, bit_or(CAST(1 AS BIGINT) << CAST(p % 8 AS BIGINT)) AS v FROM p GROUP BY ALL),
a AS (SELECT doc_id, unnest(range(m // 8)) AS j FROM s WHERE items IS NOT NULL),
h AS (SELECT a.doc_id, string_agg(printf('%02X', coalesce(v, 0)), '' ORDER BY a.j) AS body FROM a LEFT JOIN g USING (doc_id, j) GROUP BY a.doc_id)
SELECT s.doc_id, CASE WHEN items IS NOT NULL THEN '4D4F4C42' || {_LE} || '0300000000000000' || body END AS filter FROM s LEFT JOIN h USING (doc_id)""")
def bloom_create_bytes(spark, d):
    return _whole(spark, d).select("doc_id", F.hex(bloom.bloom_filter_create("items")).alias("filter"))


def _may(words: str) -> str:
    return f"""{_BITS},
q AS (SELECT doc_id, (b + i * (b >> 16) + i * i) % m AS p FROM (SELECT doc_id, m, CAST('0x' || substr(md5(w), 1, 12) AS BIGINT) AS b FROM s, (SELECT unnest([{words}]) AS w)), range(3) AS t(i)),
f AS (SELECT q.doc_id, bool_and(p.p IS NOT NULL) AS may FROM q LEFT JOIN p USING (doc_id, p) GROUP BY q.doc_id)
SELECT s.doc_id, CASE WHEN items IS NOT NULL THEN may END AS may FROM s JOIN f USING (doc_id)"""


@query(_may("'the'"))
def bloom_contains(spark, d):
    return _whole(spark, d).withColumn("f", bloom.bloom_filter_create("items")).select("doc_id", bloom.bloom_filter_contains("f", "'the'").alias("may"))


@query(_may("'the', 'of'"))
def bloom_contains_all(spark, d):
    return _whole(spark, d).withColumn("f", bloom.bloom_filter_create("items")).select("doc_id", bloom.bloom_filter_contains_all("f", "array('the', NULL, 'of')").alias("may"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3)")
def bloom_semi_join(spark, d):
    """A filter of the few keys drops most rows of the large side before the exact join."""
    keys = read_remote(spark, d, "customer").where((col("c_mktsegment") == "BUILDING") & (col("c_nationkey") == 3)).select("c_custkey").to_df()
    orders = read_remote(spark, d, "orders").select("o_orderkey", "o_custkey").to_df()
    most = bloom.MAX_BITS // bloom.BITS
    if keys.limit(most + 1).count() <= most:  # more keys than the largest filter is for would pass most rows
        made = keys.agg(F.collect_set(F.col("c_custkey").cast("string")).alias("items")).select(bloom.bloom_filter_create("items").alias("f"))
        # One row of 1 MB at most.
        orders = orders.crossJoin(F.broadcast(made)).where(bloom.bloom_filter_contains("f", "CAST(o_custkey AS STRING)")).drop("f")
    return orders.join(keys, orders.o_custkey == keys.c_custkey, "left_semi")


@query("SELECT n_nationkey FROM nation")
def search_hint_filter(spark, d):
    return read_remote(spark, d, "nation").to_df().where(search_hint(F.col("n_name"), F.array(F.lit("x")))).select("n_nationkey")


@query(f"SELECT '{__version__}' AS version")
def engine_version(spark, d):
    return spark.range(1).select(version().alias("version"))


# What else queries over such relations use.


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 150000 GROUP BY o_orderstatus")
def session_variable(spark, d):
    """A variable of the session in a query's place of a literal."""
    spark.sql("DECLARE OR REPLACE VARIABLE least_price DOUBLE DEFAULT 100000")
    spark.sql("SET VARIABLE least_price = 150000")
    orders = read_remote(spark, d, "orders").to_df()
    return orders.where(F.expr("o_totalprice > session.least_price")).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("WITH big AS (SELECT * FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)) SELECT o_orderstatus, count(*) AS n FROM big GROUP BY o_orderstatus")
def cte_subquery(spark, d):
    return read_remote(spark, d, sql="WITH big AS (SELECT * FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)) SELECT o_orderstatus, count(*) AS n FROM big GROUP BY o_orderstatus").to_df()


@query("SELECT (SELECT count(*) FROM orders) = (SELECT count(*) FROM (SELECT * FROM orders)) AS same")
def scalar_subqueries(spark, d):
    return read_remote(spark, d, sql="SELECT (SELECT count(*) FROM orders) = (SELECT count(*) FROM (SELECT * FROM orders)) AS same").to_df()


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10")
def order_limit(spark, d):
    return read_remote(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").to_df().orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(10)


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 5")
def group_order_limit(spark, d):
    return read_remote(spark, d, "lineitem").group_by("l_suppkey").agg(count(name="n")).orderBy(F.desc("n"), "l_suppkey").limit(5)


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_inner(spark, d):
    n, r = read_remote(spark, d, "nation").to_df(), read_remote(spark, d, "region").to_df()
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_name", "r_name")


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def join_left_agg(spark, d):
    c, o = read_remote(spark, d, "customer").to_df(), read_remote(spark, d, "orders").to_df()
    return c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def join_anti(spark, d):
    c, o = read_remote(spark, d, "customer").to_df(), read_remote(spark, d, "orders").to_df()
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query("SELECT a.n + b.n AS total FROM (SELECT count(*) AS n FROM nation) a, (SELECT count(*) AS n FROM region) b")
def cross_join_single_rows(spark, d):
    a, b = read_remote(spark, d, "nation").agg(count(name="a")), read_remote(spark, d, "region").agg(count(name="b"))
    return a.crossJoin(b).select((F.col("a") + F.col("b")).alias("total"))  # one row each


@query("SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def union_all(spark, d):
    return read_remote(spark, d, "nation").to_df().select(F.col("n_name").alias("name")).unionByName(read_remote(spark, d, "region").to_df().select(F.col("r_name").alias("name")))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def window_top_per_group(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return read_remote(spark, d, "orders").to_df().withColumn("rn", F.row_number().over(w)).where("rn = 1").select("o_orderkey", "o_custkey", "o_totalprice")


_Q6 = "l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24"


@query(f"SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem WHERE {_Q6}")
def q6_revenue(spark, d):
    df = read_remote(spark, d, "lineitem").to_df().where(_Q6.replace("TIMESTAMP", "TIMESTAMP_NTZ"))
    return df.agg(F.sum(_dec("l_extendedprice") * _dec("l_discount")).cast("double").alias("revenue"))


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""")
def q1_summary(spark, d):
    df = read_remote(spark, d, "lineitem").to_df().where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02'")
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.sum(_dec("l_quantity")).cast("double").alias("sum_qty"), F.sum(_dec("l_extendedprice")).cast("double").alias("sum_price"), F.count("*").alias("n"))


@query("SELECT left(c_name, 4) AS head, octet_length(CAST(c_name AS BLOB)) AS n_bytes, array_to_string(list_transform(range(1, 4), lambda x: x * c_nationkey), ',') AS xs FROM customer")
def scalar_builtins(spark, d):
    df = read_remote(spark, d, "customer").to_df()
    return df.select(F.expr("left(c_name, 4)").alias("head"), F.octet_length("c_name").cast("long").alias("n_bytes"), F.expr("array_join(transform(sequence(1, 3), x -> x * c_nationkey), ',')").alias("xs"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY ALL")
def event_windows(spark, d):
    out = windowed_counts(read_remote(spark, d, "events").to_df())
    return out.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"), "total": F.col("total").cast("double")})
