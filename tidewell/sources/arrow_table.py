"""SQL table functions: ``read_remote(url => ..., sql => ...)`` and ``remote_splits(url => ..., ...)``.

A table function runs in one task; for large results use the data source ``remote_arrow``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from . import http
from .remote_arrow import query_of

SPLITS = StructType([StructField("endpoints", ArrayType(StringType())), StructField("query_id", LongType()), StructField("query", StringType()), StructField("producer_id", StringType()), StructField("split_size", LongType()), StructField("query_checksum", StringType())])


def _value(argument: AnalyzeArgument | None):
    return None if argument is None else argument.value


class ReadRemote:
    @staticmethod
    def analyze(url: AnalyzeArgument, source_table: AnalyzeArgument = None, sql: AnalyzeArgument = None, split: AnalyzeArgument = None, split_size: AnalyzeArgument = None, auth_token: AnalyzeArgument = None) -> AnalyzeResult:
        query = query_of(_value(source_table), _value(sql))
        return AnalyzeResult(from_arrow_schema(http.schema(_value(url), query, _value(auth_token))))

    def eval(self, url: str, source_table: str = None, sql: str = None, split: bool = False, split_size: int = -1, auth_token: str = None):
        query = query_of(source_table, sql)
        queries = [s.query for s in http.plan(url, query, auth_token, split_size or -1)] if split else [query]
        names = None
        for q in queries:
            for batch in http.batches(url, q, auth_token, http.new_query_id()):
                names = names or batch.schema.names
                for row in batch.select(names).to_pylist():
                    yield tuple(row.values())


class RemoteSplits:
    @staticmethod
    def analyze(url: AnalyzeArgument, source_table: AnalyzeArgument = None, sql: AnalyzeArgument = None, auth_token: AnalyzeArgument = None, split_size: AnalyzeArgument = None) -> AnalyzeResult:
        if not _value(source_table) and not _value(sql):
            raise ValueError("requires either 'source_table' or 'sql'")
        return AnalyzeResult(SPLITS)

    def eval(self, url: str, source_table: str = None, sql: str = None, auth_token: str = None, split_size: int = -1):
        # Here, unlike in read_remote, a table wins over a query.
        for s in http.plan(url, query_of(source_table, None if source_table else sql), auth_token, split_size or -1):
            yield list(s.endpoints), s.query_id, s.query, s.producer_id, s.split_size, s.query_checksum


def register(spark: SparkSession) -> None:
    spark.udtf.register("read_remote", udtf(ReadRemote))
    spark.udtf.register("remote_splits", udtf(RemoteSplits))
