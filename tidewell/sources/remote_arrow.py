"""The data source ``remote_arrow``: a query on a server as a DataFrame, one task for each split.

Options: ``url``, ``sql`` or ``source_table``, ``split`` (true or false), ``split_size``, ``auth_token``,
``columns`` (a JSON list: Spark tells Python sources no columns, so the caller prunes them here).
Filters that SQL text can say exactly are sent to the server; Spark applies the others afterwards.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from ..plans.predicates import Unsupported, literal, quoted
from . import http

OPTIONS = {"url", "sql", "source_table", "split", "split_size", "auth_token", "columns", "path"}
OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def query_of(source_table: str | None, sql: str | None) -> str:
    if not source_table and not sql:
        raise ValueError("requires either 'source_table' or 'sql'")
    if source_table and sql:
        raise ValueError("accepts either 'source_table' or 'sql', not both")
    return sql or f"SELECT * FROM {source_table}"


def filter_sql(f: Filter) -> str | None:
    """The filter as SQL text, or None."""
    if len(f.attribute if hasattr(f, "attribute") else ()) != 1:
        return None
    name = quoted(f.attribute[0])
    try:
        if type(f) in OPERATORS:
            return f"({name} {OPERATORS[type(f)]} {literal(f.value)})"
        if isinstance(f, IsNull):
            return f"({name} IS NULL)"
        if isinstance(f, IsNotNull):
            return f"({name} IS NOT NULL)"
        if isinstance(f, In) and f.value:
            return f"({name} IN ({', '.join(literal(v) for v in f.value)}))"
    except Unsupported:
        pass
    return None


@dataclass
class Part(InputPartition):
    query: str
    query_id: int


class RemoteArrow(DataSource):
    @classmethod
    def name(cls) -> str:
        return "remote_arrow"

    def __init__(self, options):
        super().__init__(options)
        if unknown := {k for k in options if k.lower() not in OPTIONS}:
            raise ValueError(f"unknown option {sorted(unknown)[0]!r}")
        self.url = options.get("url")
        if not self.url:
            raise ValueError("requires 'url'")
        self.query = query_of(options.get("source_table"), options.get("sql"))
        self.token = options.get("auth_token")
        if columns := json.loads(options.get("columns") or "[]"):
            self.query = f"SELECT {', '.join(map(quoted, columns))} FROM ({self.query}) AS _subq"

    def schema(self) -> StructType:
        found = http.schema(self.url, self.query, self.token)
        if not len(found):
            raise ValueError("the query has no columns")
        if len(set(found.names)) < len(found):
            raise ValueError("the query has several columns of one name")
        return from_arrow_schema(found)

    def reader(self, schema: StructType) -> RemoteReader:
        split = str(self.options.get("split", "false")).lower() == "true"
        return RemoteReader(self.url, self.query, self.token, split, int(self.options.get("split_size") or -1), schema.names)


class RemoteReader(DataSourceReader):
    def __init__(self, url: str, query: str, token: str | None, split: bool, split_size: int, names: list[str]):
        self.url, self.query, self.token, self.split, self.split_size, self.names = url, query, token, split, split_size, names
        self.filters: list[str] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if text := filter_sql(f):
                self.filters.append(text)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        query = self.query
        if self.filters:
            query = f"SELECT * FROM ({query}) AS _subq WHERE {' AND '.join(self.filters)}"
        if not self.split:
            return [Part(query, http.new_query_id())]
        found = http.plan(self.url, query, self.token, self.split_size)
        if not found:
            raise http.RemoteError("the server planned no splits")
        return [Part(s.query, http.new_query_id()) for s in found]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        for batch in http.batches(self.url, partition.query, self.token, partition.query_id):
            if batch.num_rows:
                yield batch.select(self.names)  # by name: a split may order its columns otherwise
