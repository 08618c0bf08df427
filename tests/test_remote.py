"""The facade over a folder and over a server, held against golden values and each other."""

from __future__ import annotations

import decimal
import json
import subprocess
import sys
import urllib.request
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewell.operators.cancel import cancellable, remote_query
from tidewell.operators.remote import read_remote, remote_splits
from tidewell.plans.aggregates import Agg, avg, count, count_distinct, max_, min_, stddev, sum_
from tidewell.plans.predicates import Local, Unsupported, col, literal
from tidewell.sources import arrow_ipc, http, local


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory) -> str:
    base = tmp_path_factory.mktemp("tables")
    small = [("east", "pending", 10), ("east", "done", 20), ("west", "pending", 30), ("west", "done", 40), ("north", "pending", 50)]
    tables = {
        "orders_small": pa.table({"region": [r[0] for r in small], "status": [r[1] for r in small], "amount": pa.array([r[2] for r in small], pa.int32())}),
        "nullable_ints": pa.table({"x": pa.array([10, None, 30, None, 50], pa.int32())}),
        "nulls_only": pa.table({"x": pa.array([None, None], pa.int32())}),
        "id_name": pa.table({"id": pa.array([1, 2, 3], pa.int32()), "name": ["a", None, "c'\"x"]}),
    }
    tiny = [100, 50, -80, 40, None, 20, 30, 40, 60, None]
    small_ = ["99.99", "12.34", "-89.01", "23.45", None, "34.56", "45.67", "67.89", "90.01", None]
    dec = lambda v, p, s: pa.array([None if x is None else decimal.Decimal(x) for x in v], pa.decimal128(p, s))
    scaled = lambda k: [None if t is None else t * k for t in tiny]
    tables["all_types"] = pa.table({
        "tiny_col": pa.array(tiny, pa.int8()), "small_col": pa.array(scaled(10), pa.int16()), "int_col": pa.array(scaled(100), pa.int32()), "big_col": pa.array(scaled(1000), pa.int64()),
        "double_col": pa.array([100.5, 10.5, -80.5, 20.5, None, 30.5, 40.5, 50.5, 90.5, None]), "decimal_small": dec(small_, 4, 2), "partition": pa.array([0] * 5 + [1] * 5, pa.int32()),
    })
    for name, table in tables.items():
        pq.write_table(table, base / f"{name}.parquet")
    return str(base)


@pytest.fixture(scope="module")
def server(folder):
    run = subprocess.Popen([sys.executable, str(Path(__file__).parent / "stub_server.py"), folder], stdout=subprocess.PIPE, text=True)
    yield f"http://127.0.0.1:{run.stdout.readline().strip()}"
    run.kill()
    run.wait()


@pytest.fixture(params=["folder", "server"])
def url(request):
    return request.getfixturevalue(request.param)


def log(server: str) -> list[str]:
    return json.loads(urllib.request.urlopen(f"{server}/log").read())


def rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def test_parameters(spark):
    with pytest.raises(ValueError, match="requires either 'source_table' or 'sql'"):
        read_remote(spark, "http://localhost:1")
    with pytest.raises(ValueError, match="not both"):
        read_remote(spark, "http://localhost:1", source_table="t", sql="SELECT 1")
    with pytest.raises(TypeError):
        read_remote(spark, "http://localhost:1", sql="SELECT 1", invalid_param="x")
    with pytest.raises(ValueError, match="requires either"):
        remote_splits(spark, "http://localhost:1")
    with pytest.raises(Exception, match="requires either 'source_table' or 'sql'"):
        spark.sql("SELECT * FROM read_remote(url => 'http://localhost:1')").collect()


@pytest.mark.parametrize("split", [False, True])
def test_scan_filter_project(spark, url, split):
    r = read_remote(spark, url, "id_name", split=split, split_size=1)
    assert rows(r.where(col("id") > 1).select("name", "id").to_df()) == [("c'\"x", 3), (None, 2)]
    assert rows(r.where(col("name").is_null()).select("id").to_df()) == [(2,)]
    assert rows(r.where(col("name") == "c'\"x").select("id").to_df()) == [(3,)]
    assert rows(r.where((col("id") == 1) | (col("id") == 3)).select("id").to_df()) == [(1,), (3,)]
    assert rows(r.where(Local("name LIKE 'c%'")).select("id").to_df()) == [(3,)]
    assert rows(r.to_df().selectExpr("id + 1 AS next")) == [(2,), (3,), (4,)]


@pytest.mark.parametrize("split", [False, True])
def test_aggregates(spark, url, split):
    r = read_remote(spark, url, "orders_small", split=split, split_size=1)
    assert rows(r.agg(count(name="n"), sum_("amount", "s"), min_("amount", "lo"), max_("amount", "hi"), count("region", "c"))) == [(5, 150, 10, 50, 5)]
    assert rows(r.agg(avg("amount", "a"))) == [(30.0,)]
    assert rows(r.agg(count_distinct("status", "n"), count(name="m"))) == [(2, 5)]
    assert rows(r.where(col("amount") > 20).agg(count(name="n"))) == [(3,)]
    assert rows(r.where((col("status") == "pending") & (col("amount") >= 20)).agg(sum_("amount", "s"))) == [(80,)]
    assert rows(r.group_by("region").agg(count(name="n"), sum_("amount", "s"), max_("amount", "m"))) == [("east", 2, 30, 20), ("north", 1, 50, 50), ("west", 2, 70, 40)]
    assert rows(r.group_by("region", "status").agg(count(name="n"))) == [(a, b, 1) for a, b in sorted([("east", "done"), ("east", "pending"), ("north", "pending"), ("west", "done"), ("west", "pending")])]
    assert rows(r.agg(count(name="n", where=col("region") == "west"), stddev("amount", "d")))[0][0] == 2
    assert rows(r.agg(Agg("collect_list", col("region"), "l")).selectExpr("size(l)")) == [(5,)]
    assert rows(r.agg(sum_(col("amount") * 2, "s"))) == [(300,)]


@pytest.mark.parametrize("split", [False, True])
def test_nulls_and_no_rows(spark, url, split):
    r = read_remote(spark, url, "nullable_ints", split=split, split_size=1)
    aggs = [count(name="n"), count("x", "c"), sum_("x", "s"), min_("x", "lo"), max_("x", "hi"), avg("x", "a")]
    assert rows(r.agg(*aggs)) == [(5, 3, 90, 10, 50, 30.0)]
    assert rows(r.where(col("x") > 100).agg(*aggs)) == [(0, 0, None, None, None, None)]
    assert rows(read_remote(spark, url, "nulls_only", split=split).agg(*aggs)) == [(2, 0, None, None, None, None)]


@pytest.mark.parametrize("split", [False, True])
def test_types(spark, url, split):
    r = read_remote(spark, url, "all_types", split=split, split_size=1)
    for c, total, low, high in (("tiny_col", 260, -80, 100), ("small_col", 2600, -800, 1000), ("int_col", 26000, -8000, 10000), ("big_col", 260000, -80000, 100000), ("decimal_small", decimal.Decimal("284.90"), decimal.Decimal("-89.01"), decimal.Decimal("99.99")), ("double_col", 263.0, -80.5, 100.5)):
        assert rows(r.agg(sum_(c, "s"), min_(c, "lo"), max_(c, "hi"), count(c, "n"))) == [(total, low, high, 8)]
    assert rows(r.group_by("partition").agg(sum_("int_col", "s"), count(name="n"))) == [(0, 11000, 5), (1, 15000, 5)]


def test_what_is_pushed(spark, server):
    r = read_remote(spark, server, "orders_small")
    r.where(col("amount") > 20).select("region").to_df().collect()
    assert any('SELECT "region" FROM (SELECT * FROM orders_small) AS _subq WHERE ("amount" > 20)' in x for x in log(server))
    r.where(col("amount") > 20).agg(sum_("amount", "s")).collect()
    assert any('sum("amount") AS "s"' in x and '("amount" > 20)' in x for x in log(server))
    spark.read.format("remote_arrow").option("url", server).option("source_table", "orders_small").load().where("amount = 40 AND region LIKE 'w%'").collect()
    assert any('("amount" = 40)' in x for x in log(server))
    assert not any(x.startswith("/v1/cancel") for x in log(server))  # finished queries aren't cancelled


def test_splits(spark, folder, server):
    for url in (folder, server):
        df = remote_splits(spark, url, "orders_small", split_size=1)
        assert df.columns == ["endpoints", "query_id", "query", "producer_id", "split_size", "query_checksum"]
        assert df.count() > 1
        assert remote_splits(spark, url, "orders_small", sql="ignored", split_size=10**6).count() == 1
    assert spark.sql(f"SELECT * FROM remote_splits(url => '{server}', source_table => 'orders_small')").count() == 2
    assert spark.sql(f"SELECT sum(amount) AS s FROM read_remote(url => '{server}', sql => 'SELECT * FROM orders_small', split => true)").head().s == 150


def test_login_and_errors(spark, server):
    assert http.login(server, "u", "good", '{"a": "x", "b": 1}') == "token-1"
    assert 'login {"claims": {"a": "x"}, "password": "good", "username": "u"}' in log(server)
    assert http.login(server.removeprefix("http://"), "u", "good", "not json") == "token-1"
    with pytest.raises(http.BadRequest):
        http.login(server, "u", "bad")
    with pytest.raises(ValueError):
        http.login(server, None, "x")
    with pytest.raises(http.BadRequest):
        list(http.batches(server, "SELECT * FROM nowhere"))
    with pytest.raises(http.BadRequest):
        list(http.batches(server, "SELECT 1", "wrong"))
    with pytest.raises(http.RemoteError, match="not an Arrow stream"):
        list(http.batches(server, "html"))
    with pytest.raises(http.RemoteError):
        http.parse_plan("{}")
    assert http.parse_plan('[{"descriptor": {}}, 3]') == []


def test_cancel(spark, server):
    reader = http.batches(server, "SELECT * FROM range(100000)", query_id=77)
    next(reader)
    reader.close()
    assert any(x.startswith("/v1/cancel") for x in log(server))
    with pytest.raises(RuntimeError), cancellable(spark) as tag:
        assert tag in spark.getTags()
        raise RuntimeError
    assert not spark.getTags()
    with pytest.raises(RuntimeError), remote_query(server, "SELECT 2"):
        raise RuntimeError
    assert "/v1/cancel SELECT 2" in log(server)


def test_ipc(spark):
    batch = pa.table({"f0": [1, 2, 3, 4], "f1": ["foo", "bar", "baz", None], "f2": [True, None, False, True]})
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as w:
        for _ in range(5):
            w.write_table(batch)
    df = arrow_ipc.from_ipc(spark, [out.getvalue().to_pybytes()], "ipc_rows")
    assert df.count() == 20
    assert spark.sql("SELECT count(f1) AS n FROM ipc_rows").head().n == 15
    assert pa.ipc.open_stream(arrow_ipc.to_ipc(df)).read_all().num_rows == 20
    with pytest.raises(ValueError):
        arrow_ipc.from_ipc(spark, [])


def test_literals():
    assert literal("a'b") == "'a''b'"
    assert literal(None) == "NULL"
    assert literal(True) == "TRUE"
    assert col('a"b').sql() == '"a""b"'
    with pytest.raises(Unsupported):
        literal(b"x")


def test_views_are_of_one_session(spark):
    import pyarrow as pa
    from pyspark.errors import AnalysisException

    from tidewell.sources.arrow_ipc import forget, from_ipc

    def stream(**columns):
        table, out = pa.table(columns), pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema) as writer:
            writer.write_table(table)
        return out.getvalue().to_pybytes()

    other = spark.newSession()
    from_ipc(spark, [stream(a=[1337])], "arrow_buffer")
    from_ipc(other, [stream(b=[42])], "arrow_buffer")
    assert spark.table("arrow_buffer").collect() == [(1337,)] and other.table("arrow_buffer").columns == ["b"]
    with pytest.raises(AnalysisException):
        from_ipc(spark, [stream(a=[1])], "arrow_buffer", force=False)
    assert forget(spark, "arrow_buffer") and not forget(spark, "arrow_buffer")
    assert other.table("arrow_buffer").collect() == [(42,)]
    forget(other, "arrow_buffer")


def test_a_token_from_a_session_variable(spark, server):
    spark.sql("DECLARE OR REPLACE VARIABLE auth_token STRING DEFAULT 'secret'")
    assert spark.sql(f"SELECT count(*) AS n FROM read_remote(url => '{server}', source_table => 'orders_small', auth_token => auth_token)").head().n == 5


def test_estimated_bytes(spark, folder):
    assert 0 < read_remote(spark, folder, "orders_small").estimated_bytes() < 10**6


def test_splits_of_a_large_file(spark, tmp_path):
    """A file is read once for each of its splits: their number is bounded, and together they have each row once."""
    spark.range(5000).coalesce(1).write.parquet(f"{tmp_path}/many.parquet")
    found = [r.query for r in remote_splits(spark, str(tmp_path), "many", split_size=10).collect()]
    assert 1 < len(found) <= local.MOST_SPLITS
    assert sorted(r.id for q in found for r in spark.sql(q).collect()) == list(range(5000))


def test_splits_skip_rows_by_a_key(spark, tmp_path):
    """Splits of a file that is stored by a key read few rows but their own; any others, all. Together each row comes once."""
    n = 100_000
    stored = spark.range(n).coalesce(1).selectExpr("'x' AS s", "id + -9223372036854775808 AS `a``key`", "id AS place")
    apart = stored.withColumn("a`key", F.expr("pmod(place * 7919, 100000)"))
    sparse = stored.withColumn("a`key", F.expr("IF(place % 40000 = 0, NULL, place)"))
    for name, df, few in (("stored", stored, True), ("apart", apart, False), ("sparse", sparse, True)):
        df.write.option("parquet.block.size", 20_000).option("parquet.enable.dictionary", "false").parquet(f"{tmp_path}/{name}.parquet")
        parts = [spark.sql(r.query).select("place") for r in remote_splits(spark, str(tmp_path), name, split_size=1).collect()]
        assert len(parts) == local.MOST_SPLITS
        assert sorted(r.place for p in parts for r in p.collect()) == list(range(n))
        read = sum(p._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value() for p in parts)
        assert (read < 5 * n) == few, (name, read)


def test_splits_of_many_files(spark, tmp_path):
    """Files of unlike sizes: small ones are read whole, large ones in ranges; a table without rows has no split."""
    for low, high in ((0, 10), (10, 2000), (2000, 3000)):
        spark.range(low, high).coalesce(1).write.mode("append").parquet(f"{tmp_path}/files.parquet")
    found = [r.query for r in remote_splits(spark, str(tmp_path), "files", split_size=1).collect()]
    assert len(found) > 3 and sum("WHERE" not in q for q in found) == 1
    assert sorted(r.id for q in found for r in spark.sql(q).collect()) == list(range(3000))
    spark.range(0).write.parquet(f"{tmp_path}/none.parquet")
    assert remote_splits(spark, str(tmp_path), "none", split_size=1).count() == 0
