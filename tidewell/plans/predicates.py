"""Predicates and expressions that become SQL text for a server or a Spark column for local data."""

from __future__ import annotations

import datetime
import decimal
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


class Unsupported(ValueError):
    """An expression that a server can't be sent."""


def quoted(name: str, quote: str = '"') -> str:
    return quote + name.replace(quote, quote * 2) + quote


def literal(value) -> str:
    """A typed SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        if value != value or value in (float("inf"), float("-inf")):
            return f"CAST('{value}' AS DOUBLE)"
        return f"CAST({value!r} AS DOUBLE)"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    raise Unsupported(f"a literal of type {type(value).__name__}")


class Expr:
    """An expression; comparisons and ``& | ~`` build larger ones."""

    __hash__ = object.__hash__

    def _with(self, op: str, other) -> Binary:
        return Binary(op, self, as_expr(other))

    def __eq__(self, other):
        return self._with("=", other)

    def __ne__(self, other):
        return self._with("<>", other)

    def __lt__(self, other):
        return self._with("<", other)

    def __le__(self, other):
        return self._with("<=", other)

    def __gt__(self, other):
        return self._with(">", other)

    def __ge__(self, other):
        return self._with(">=", other)

    def __add__(self, other):
        return self._with("+", other)

    def __sub__(self, other):
        return self._with("-", other)

    def __mul__(self, other):
        return self._with("*", other)

    def __truediv__(self, other):
        return self._with("/", other)

    def __and__(self, other):
        return self._with("AND", other)

    def __or__(self, other):
        return self._with("OR", other)

    def __invert__(self):
        return Not(self)

    def is_null(self) -> Expr:
        return IsNull(self, True)

    def is_not_null(self) -> Expr:
        return IsNull(self, False)

    def between(self, low, high) -> Expr:
        return (self >= low) & (self <= high)

    def cast(self, kind: str) -> Expr:
        return Cast(self, kind)

    def sql(self) -> str:
        raise Unsupported(type(self).__name__)

    def column(self) -> Column:
        raise NotImplementedError


@dataclass(eq=False)
class Col(Expr):
    name: str

    def sql(self) -> str:
        return quoted(self.name)

    def column(self) -> Column:
        return F.col(quoted(self.name, "`"))


@dataclass(eq=False)
class Lit(Expr):
    value: object

    def sql(self) -> str:
        return literal(self.value)

    def column(self) -> Column:
        return F.lit(self.value)


@dataclass(eq=False)
class Binary(Expr):
    op: str
    left: Expr
    right: Expr

    def sql(self) -> str:
        return f"({self.left.sql()} {self.op} {self.right.sql()})"

    def column(self) -> Column:
        a, b = self.left.column(), self.right.column()
        if self.op in ("AND", "OR"):
            return a & b if self.op == "AND" else a | b
        return {"=": a == b, "<>": a != b, "<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[self.op] if self.op[0] in "=<>" else {"+": a + b, "-": a - b, "*": a * b, "/": a / b}[self.op]


@dataclass(eq=False)
class Not(Expr):
    inner: Expr

    def sql(self) -> str:
        return f"(NOT {self.inner.sql()})"

    def column(self) -> Column:
        return ~self.inner.column()


@dataclass(eq=False)
class IsNull(Expr):
    inner: Expr
    null: bool

    def sql(self) -> str:
        return f"({self.inner.sql()} IS {'' if self.null else 'NOT '}NULL)"

    def column(self) -> Column:
        return self.inner.column().isNull() if self.null else self.inner.column().isNotNull()


@dataclass(eq=False)
class Cast(Expr):
    inner: Expr
    kind: str

    def sql(self) -> str:
        return f"CAST({self.inner.sql()} AS {self.kind})"

    def column(self) -> Column:
        return self.inner.column().cast(self.kind)


@dataclass(eq=False)
class Call(Expr):
    """A scalar function by name."""

    name: str
    args: tuple

    def sql(self) -> str:
        if not self.name.isidentifier():
            raise Unsupported(f"the function {self.name}")
        return f"{self.name}({', '.join(a.sql() for a in self.args)})"

    def column(self) -> Column:
        return F.call_function(self.name, *(a.column() for a in self.args))


@dataclass(eq=False)
class Local(Expr):
    """A Spark expression that no server is sent: its query runs on fetched rows."""

    text: str

    def column(self) -> Column:
        return F.expr(self.text)


def as_expr(value) -> Expr:
    return value if isinstance(value, Expr) else Lit(value)


def col(name: str) -> Col:
    return Col(name)


def conjuncts(e: Expr) -> list[Expr]:
    return conjuncts(e.left) + conjuncts(e.right) if isinstance(e, Binary) and e.op == "AND" else [e]
