"""The facade: a remote relation, lazily filtered, projected and aggregated where its rows are.

A URL with ``http://`` or ``https://`` is a server that is sent SQL text; any other is a folder of Parquet,
where Catalyst does the same natively. What can't be sent runs in Spark on the rows fetched: all aggregates
of a query are sent, or none.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.aggregates import Agg, pushed_query
from ..plans.predicates import Expr, Unsupported, conjuncts, quoted
from ..sources import arrow_table, http, local, remote_arrow


def read_remote(spark: SparkSession, url: str, source_table: str | None = None, sql: str | None = None, split: bool = False, split_size: int | None = None, auth_token: str | None = None) -> RemoteRelation:
    """A relation from exactly one of ``source_table`` and ``sql``."""
    remote_arrow.query_of(source_table, sql)
    return RemoteRelation(spark, url, source_table, sql, bool(split), split_size, auth_token)


def remote_splits(spark: SparkSession, url: str, source_table: str | None = None, sql: str | None = None, auth_token: str | None = None, split_size: int | None = None) -> DataFrame:
    """The splits of a table or query; of both given, the table's."""
    if not source_table and not sql:
        raise ValueError("requires either 'source_table' or 'sql'")
    return read_remote(spark, url, source_table, None if source_table else sql, True, split_size, auth_token).splits()


@dataclass(frozen=True)
class RemoteRelation:
    spark: SparkSession
    url: str
    source_table: str | None
    sql: str | None
    split: bool = False
    split_size: int | None = None
    auth_token: str | None = None
    columns: tuple[str, ...] | None = None
    filters: tuple[Expr, ...] = ()

    @property
    def is_http(self) -> bool:
        return self.url.startswith(("http://", "https://"))

    @property
    def query(self) -> str:
        return remote_arrow.query_of(self.source_table, self.sql)

    def select(self, *columns: str) -> RemoteRelation:
        return replace(self, columns=columns)

    def where(self, predicate: Expr) -> RemoteRelation:
        return replace(self, filters=(*self.filters, *conjuncts(predicate)))

    def _sendable(self) -> tuple[list[Expr], list[Expr]]:
        """The filters a server is sent, and those left to Spark."""
        sent, kept = [], []
        for f in self.filters:
            try:
                f.sql()
                sent.append(f)
            except Unsupported:
                kept.append(f)
        return sent, kept

    def pushed_sql(self) -> str:
        """The text a server is sent for the rows."""
        sent, kept = self._sendable()
        if not sent and (self.columns is None or kept):
            return self.query
        cols = "*" if self.columns is None or kept else ", ".join(map(quoted, self.columns))
        return f"SELECT {cols} FROM ({self.query}) AS _subq" + (f" WHERE {' AND '.join(f.sql() for f in sent)}" if sent else "")

    def _fetch(self, query: str, split: bool) -> DataFrame:
        reader = self.spark.read.format("remote_arrow").option("url", self.url).option("sql", query).option("split", str(split).lower())
        if self.split_size:
            reader = reader.option("split_size", str(self.split_size))
        return (reader.option("auth_token", self.auth_token) if self.auth_token else reader).load()

    def _local(self) -> DataFrame:
        return local.table(self.spark, self.url, self.source_table) if self.source_table else local.query(self.spark, self.url, self.sql)

    def _rows(self) -> DataFrame:
        df = self._fetch(self.pushed_sql(), self.split) if self.is_http else self._local()
        for f in self._sendable()[1] if self.is_http else self.filters:
            df = df.where(f.column())
        return df

    def to_df(self) -> DataFrame:
        df = self._rows()
        return df if self.columns is None else df.select(*(F.col(quoted(c, "`")) for c in self.columns))

    def splits(self) -> DataFrame:
        if self.is_http:
            found = http.plan(self.url, self.pushed_sql(), self.auth_token, self.split_size or -1)
            return self.spark.createDataFrame([(list(s.endpoints), s.query_id, s.query, s.producer_id, s.split_size, s.query_checksum) for s in found], arrow_table.SPLITS)
        return local.plan_splits(self.spark, self.url, self.pushed_sql(), self._local(), self.split_size, bool(self.source_table) and not self.filters and self.columns is None)

    def estimated_bytes(self) -> int:
        """What Catalyst expects the relation to hold, by which it picks joins; a server's is the default for sources that don't say."""
        return local.size_bytes(self.to_df())

    def group_by(self, *keys: str) -> Grouped:
        return Grouped(self, keys)

    def agg(self, *aggs: Agg) -> DataFrame:
        return Grouped(self, ()).agg(*aggs)


@dataclass(frozen=True)
class Grouped:
    relation: RemoteRelation
    keys: tuple[str, ...]

    def agg(self, *aggs: Agg) -> DataFrame:
        r = self.relation
        keys = [F.col(quoted(k, "`")) for k in self.keys]
        if r.is_http:
            sent, kept = r._sendable()
            if not kept and all(a.mergeable if r.split else a.pushable for a in aggs):
                return self._sent(aggs, sent)
            wide = replace(r, columns=None)
            return wide._rows().groupBy(*keys).agg(*(a.column() for a in aggs))
        df = replace(r, columns=None)._rows()
        if not r.split or not all(a.mergeable for a in aggs) or not r.source_table:
            return df.groupBy(*keys).agg(*(a.column() for a in aggs))
        return self._by_split(aggs)

    def _sent(self, aggs: tuple[Agg, ...], sent: list[Expr]) -> DataFrame:
        r = self.relation
        if not r.split:
            found = r._fetch(pushed_query(r.query, list(aggs), list(self.keys), sent), False)
            return found.select(*(F.col(quoted(k, "`")) for k in self.keys), *(F.col(quoted(a.alias, "`")) for a in aggs))
        parts = [p for a in aggs for p in a.partials()]
        found = r._fetch(pushed_query(r.query, [p for _, p in parts], list(self.keys), sent, [n for n, _ in parts]), True)
        return found.groupBy(*(F.col(quoted(k, "`")) for k in self.keys)).agg(*(a.merged() for a in aggs))

    def _by_split(self, aggs: tuple[Agg, ...]) -> DataFrame:
        """Partial aggregates of each split in one pass over the files, then their merge."""
        r = self.relation
        df = local.table(r.spark, r.url, r.source_table)
        splits = local.split_count(df, r.split_size)
        df = local.with_split(df, local.split_rows(df, splits)) if splits > 1 else df.withColumn("split_id", F.lit("0"))
        for f in r.filters:
            df = df.where(f.column())
        keys = [F.col(quoted(k, "`")) for k in self.keys]
        partial = df.groupBy("split_id", *keys).agg(*(p.named(n).column() for a in aggs for n, p in a.partials()))
        return partial.groupBy(*keys).agg(*(a.merged() for a in aggs))
