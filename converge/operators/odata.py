"""OData filters and orders as Spark columns.

A filter is read by a small recursive-descent parser: `or` binds loosest, then `and`, then `not`. Comparisons are two-valued:
`ne` and `not` also match rows whose field is null. Predicates at the top level push down to the scan. With the schema of
the table, literals are read as the type of their column, and those that cannot be are refused when the filter is read.
"""

from __future__ import annotations

import re
import datetime
import decimal
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Literal = str | int | float | bool | decimal.Decimal | datetime.date | datetime.datetime

_TOKEN = re.compile(
    r"\s*(?:(?P<text>'(?:[^']|'')*')|(?P<punct>[(),])|(?P<word>[^\s(),']+))",
)
_COMPARE = {
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: ~c.eqNullSafe(v),
    "gt": lambda c, v: c > v,
    "ge": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "le": lambda c, v: c <= v,
}


@dataclass(frozen=True)
class Token:
    kind: str
    text: str
    start: int
    end: int


def tokens(expression: str) -> list[Token]:
    found, at = [], 0
    while at < len(expression.rstrip()):
        m = _TOKEN.match(expression, at)
        if not m:
            raise ValueError(f"cannot read the filter from {expression[at:]!r}")
        found.append(Token(m.lastgroup, m.group(m.lastgroup), *m.span(m.lastgroup)))
        at = m.end()
    return found


def literal(token: Token) -> Literal:
    """Quoted text, true or false, a whole number, a number with a point, or else the word itself."""
    if token.kind == "text":
        return token.text[1:-1].replace("''", "'")
    word = token.text
    if word.lower() in ("true", "false"):
        return word.lower() == "true"
    for number in (float,) if "." in word else (int,):
        try:
            return number(word)
        except ValueError:
            pass
    return word


def typed(token: Token, kind: T.DataType | None) -> Literal:
    """The literal as a value of the column's type, or as it is written if that is not known."""
    value = literal(token)
    if kind is None:
        return value
    text = value if token.kind == "text" else token.text
    try:
        if isinstance(kind, T.BooleanType):
            return {"true": True, "false": False}[text.lower()]
        if isinstance(kind, T.NumericType):
            number = decimal.Decimal(text)
            if not number.is_finite():
                raise ValueError
            # A whole number stays one, so that a comparison reaches the scan of a column of any numeric type.
            return int(number) if number == int(number) and not isinstance(kind, T.FractionalType) else number if isinstance(kind, T.DecimalType) else float(text)
        if isinstance(kind, T.DateType):
            return datetime.date.fromisoformat(text)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            at = datetime.datetime.fromisoformat(text)
            utc = at.astimezone(datetime.timezone.utc) if at.tzinfo else at.replace(tzinfo=datetime.timezone.utc)
            return utc.replace(tzinfo=None) if isinstance(kind, T.TimestampNTZType) else utc
    except (ValueError, KeyError, decimal.InvalidOperation):
        raise ValueError(f"{token.text} is no value of type {kind.simpleString()}") from None
    return text


class _Parser:
    def __init__(self, expression: str, fields: Mapping[str, str], schema: T.StructType | None = None) -> None:
        self.expression, self.fields = expression, fields
        self.kinds = {f.name: f.dataType for f in schema} if schema else {}
        self.left = tokens(expression)[::-1]
        if not self.left:
            raise ValueError("empty OData filter expression")

    def peek(self) -> Token | None:
        return self.left[-1] if self.left else None

    def take(self, text: str | None = None) -> Token:
        token = self.left.pop() if self.left else None
        if token is None or (text is not None and token.text.lower() != text):
            raise ValueError(f"unsupported OData filter expression: {self.expression}")
        return token

    def word(self, text: str) -> bool:
        token = self.peek()
        return token is not None and token.kind == "word" and token.text.lower() == text

    def column(self, name: str) -> Column:
        return F.col(mapped(name, self.fields))

    def any(self) -> Column:
        found = [self.all()]
        while self.word("or"):
            self.take()
            found.append(self.all())
        return reduce(lambda a, b: a | b, found)

    def all(self) -> Column:
        found = [self.one()]
        while self.word("and"):
            self.take()
            found.append(self.one())
        return reduce(lambda a, b: a & b, found)

    def one(self) -> Column:
        if self.word("not"):
            negation = self.take()
            if (after := self.peek()) is not None and after.kind == "punct" and after.text == "(" and after.start == negation.end:
                raise ValueError(f"unsupported OData filter expression: {self.expression}")
            # Under a negation a null comparison is false, not unknown.
            return ~F.coalesce(self.one(), F.lit(False))
        token = self.take()
        if token.text == "(":
            inside = self.any()
            self.take(")")
            return inside
        if token.text.lower() == "search.in":
            return self.member()
        if token.kind != "word" or not re.fullmatch(r"\w+", token.text):
            raise ValueError(f"unsupported OData filter expression: {self.expression}")
        operator = self.take().text.lower()
        if operator not in _COMPARE:
            raise ValueError(f"unsupported OData filter expression: {self.expression}")
        value = self.take()
        if value.kind == "punct":
            raise ValueError(f"unsupported OData filter expression: {self.expression}")
        return _COMPARE[operator](self.column(token.text), F.lit(self.value(token.text, value)))

    def value(self, name: str, token: Token) -> Literal:
        return typed(token, self.kinds.get(mapped(name, self.fields)))

    def member(self) -> Column:
        self.take("(")
        name = self.take().text
        column = self.column(name)
        self.take(",")
        listed = self.take()
        self.take(")")
        if listed.kind != "text":
            raise ValueError(f"unsupported OData filter expression: {self.expression}")
        listed = [Token("text", "'" + v.strip().replace("'", "''") + "'", 0, 0) for v in literal(listed).split(",") if v.strip()]
        return column.isin(*[self.value(name, v) for v in listed])


def mapped(name: str, fields: Mapping[str, str]) -> str:
    if name not in fields:
        raise ValueError(f"unknown OData field {name!r}; allowed fields: {sorted(fields)}")
    return fields[name]


def predicate(expression: str, fields: Mapping[str, str], schema: T.StructType | None = None) -> Column:
    """The filter as a column; schema: of the table that it is for, by which literals are read."""
    parser = _Parser(expression.strip(), fields, schema)
    found = parser.any()
    if parser.peek() is not None:
        raise ValueError(f"unsupported OData filter expression: {expression}")
    return found


def order(expression: str, fields: Mapping[str, str]) -> list[Column]:
    """Nulls come last in either direction."""
    found = []
    for clause in expression.split(","):
        name, *direction = clause.split()
        column = F.col(mapped(name, fields))
        found.append(column.desc_nulls_last() if direction and direction[0].lower() == "desc" else column.asc_nulls_last())
    return found


def facets(expression: str, fields: Mapping[str, str]) -> list[str]:
    return [mapped(name.strip(), fields) for name in expression.split(",")]
