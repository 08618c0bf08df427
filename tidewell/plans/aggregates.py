"""Aggregates, and how those of splits are merged into those of the whole."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import Col, Expr, Unsupported


@dataclass(frozen=True)
class Agg:
    """``kind`` over ``arg`` (none for count of rows), optionally distinct and of the rows where ``where`` holds."""

    kind: str
    arg: Expr | None = None
    name: str = ""
    distinct: bool = False
    where: Expr | None = None

    @property
    def alias(self) -> str:
        return self.name or f"{self.kind}_{self.arg.name if isinstance(self.arg, Col) else 'all' if self.arg is None else 'expr'}"

    def named(self, name: str) -> Agg:
        return Agg(self.kind, self.arg, name, self.distinct, self.where)

    @property
    def pushable(self) -> bool:
        """Whether a server can be sent it."""
        try:
            self.sql()
        except Unsupported:
            return False
        return self.kind in ("count", "sum", "min", "max", "avg") and self.where is None

    @property
    def mergeable(self) -> bool:
        """Whether results of splits can be merged."""
        return self.pushable and not self.distinct

    def sql(self) -> str:
        return f"{self.kind}({'DISTINCT ' if self.distinct else ''}{'*' if self.arg is None else self.arg.sql()})"

    def column(self) -> Column:
        value = F.lit(1) if self.arg is None else self.arg.column()
        if self.where is not None:
            value = F.when(self.where.column(), value)
        if self.distinct:
            if self.kind not in ("count", "sum", "avg", "min", "max"):
                raise Unsupported(f"{self.kind} of distinct values")
            out = {"count": F.count_distinct, "sum": F.sum_distinct, "min": F.min, "max": F.max}.get(self.kind, lambda v: F.sum_distinct(v) / F.count_distinct(v))(value)
        else:
            out = {"stddev": F.stddev, "list": F.collect_list}.get(self.kind, getattr(F, self.kind, None))(value)
        return out.alias(self.alias)

    def partials(self) -> list[tuple[str, Agg]]:
        """What each split computes: (column, aggregate)."""
        if self.kind == "avg":
            return [(f"{self.alias}__sum", Agg("sum", self.arg)), (f"{self.alias}__count", Agg("count", self.arg))]
        return [(f"{self.alias}__{self.kind}", self)]

    def merged(self) -> Column:
        """The whole's value from the splits' columns."""
        part = [F.col(f"`{n}`") for n, _ in self.partials()]
        if self.kind == "avg":
            total, n = F.sum(part[0]), F.sum(part[1])
            return F.when(n > 0, total.cast("double") / n).alias(self.alias)
        if self.kind == "count":
            return F.coalesce(F.sum(part[0]), F.lit(0)).cast("long").alias(self.alias)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](part[0]).alias(self.alias)


def _of(kind: str):
    def make(arg: Expr | str | None = None, name: str = "", distinct: bool = False, where: Expr | None = None) -> Agg:
        return Agg(kind, Col(arg) if isinstance(arg, str) else arg, name, distinct, where)

    return make


count, sum_, min_, max_, avg, stddev, list_ = (_of(k) for k in ("count", "sum", "min", "max", "avg", "stddev", "list"))


def count_distinct(arg: Expr | str, name: str = "") -> Agg:
    return Agg("count", Col(arg) if isinstance(arg, str) else arg, name or f"count_distinct_{arg if isinstance(arg, str) else 'expr'}", True)


def pushed_query(query: str, aggs: list[Agg], keys: list[str], where: list[Expr], names: list[str] | None = None) -> str:
    """``query`` aggregated, as text for a server."""
    from .predicates import quoted

    cols = [quoted(k) for k in keys] + [f"{a.sql()} AS {quoted(n)}" for a, n in zip(aggs, names or [a.alias for a in aggs])]
    text = f"SELECT {', '.join(cols)} FROM ({query}) AS _subq"
    if where:
        text += " WHERE " + " AND ".join(w.sql() for w in where)
    return text + (f" GROUP BY {', '.join(map(quoted, keys))}" if keys else "")
