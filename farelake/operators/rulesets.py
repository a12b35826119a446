"""Declarative rules as text, read into the columns of one aggregate.

    Rules = [
      RowCount > 0,
      IsComplete "fare_amount",
      ColumnValues "fare_amount" >= 0,
      ColumnValues "payment_type" between 1 and 6
    ]

Column names stand in double quotes, bounds are numbers, ``#`` begins a comment. A fault names its line and column.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cleaning import DROPOFF, PICKUP

#: The rules of the trip table.
TRIP_RULESET = f"""
Rules = [
  RowCount > 0,
  IsComplete "{PICKUP}",
  IsComplete "{DROPOFF}",
  ColumnValues "passenger_count" >= 0,
  ColumnValues "trip_distance" >= 0,
  ColumnValues "fare_amount" >= 0
]
"""

_COMPARE = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq, "!=": operator.ne}
_TOKEN = re.compile(r'\s+|#[^\n]*|(?P<name>[A-Za-z]\w*)|"(?P<column>[^"\n]+)"|(?P<number>-?\d+(?:\.\d+)?)|(?P<sign>>=|<=|!=|[<>=,\[\]])')


class Rule(NamedTuple):
    kind: str
    column: str | None = None
    test: str | None = None  # a comparison sign, or "between"
    bounds: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        return " ".join(x for x in (self.kind, self.column, self.test, " and ".join(self.bounds)) if x)

    def met(self, value: Column) -> Column:
        bounds = [F.lit(float(b) if "." in b else int(b)) for b in self.bounds]
        return value.between(*bounds) if self.test == "between" else _COMPARE[self.test](value, bounds[0])


class _Text:
    """The tokens of a ruleset, each with its place."""

    def __init__(self, text: str):
        self.text, self.at = text, 0
        self.tokens = [*self._split(text)]

    def _split(self, text: str) -> Iterator[tuple[str, str, int]]:
        at = 0
        while at < len(text):
            found = _TOKEN.match(text, at)
            if found is None:
                raise self.fault(f"unexpected character {text[at]!r}", at)
            if found.lastgroup:
                yield found.lastgroup, found[found.lastgroup], at
            at = found.end()
        yield "end", "the end", at

    def fault(self, message: str, at: int) -> ValueError:
        line, column = self.text.count("\n", 0, at) + 1, at - (self.text.rfind("\n", 0, at) + 1) + 1
        return ValueError(f"line {line}, column {column}: {message}")

    def take(self, *wanted: str, kind: str | None = None) -> str:
        """The next token, which must be one of ``wanted`` or of the given kind."""
        found, value, at = self.tokens[self.at]
        if value in wanted and found in ("name", "sign") or found == kind:
            self.at += 1
            return value
        names = {"column": "a column name in double quotes", "number": "a number", "end": "the end"}
        raise self.fault(f"expected {' or '.join([*wanted, *([names[kind]] if kind else [])])}, found {value}", at)


def parse_ruleset(text: str) -> list[Rule]:
    """The rules of a text; anything else than what the module describes is a ValueError with its place."""
    t, rules = _Text(text), []
    for sign in ("Rules", "=", "["):
        t.take(sign)
    while True:
        kind = t.take("RowCount", "IsComplete", "ColumnValues")
        column = None if kind == "RowCount" else t.take(kind="column")
        test, bounds = None, ()
        if kind != "IsComplete":
            test = t.take(*_COMPARE, "between")
            bounds = (t.take(kind="number"),)
            if test == "between":
                t.take("and")
                bounds += (t.take(kind="number"),)
        rules.append(Rule(kind, column, test, bounds))
        if t.take(",", "]") == "]":
            t.take(kind="end")
            return rules


def ruleset_eval(trips: DataFrame, ruleset: str = TRIP_RULESET) -> DataFrame:
    """Evaluate a ruleset in one aggregate: (rule, failing, outcome).

    ``failing`` counts rows, or is 1 for a table that misses a RowCount rule. A value that is NULL does not satisfy a
    ColumnValues rule. A column that the table lacks is an error.
    """
    rules, failing = parse_ruleset(ruleset), []
    for rule in rules:
        if rule.kind == "RowCount":
            failing.append(F.when(rule.met(F.count(F.lit(1))), 0).otherwise(1).cast("long"))
        elif rule.kind == "IsComplete":
            failing.append(F.count_if(trips[rule.column].isNull()))
        else:
            failing.append(F.count_if(~F.coalesce(rule.met(trips[rule.column]), F.lit(False))))
    labels = [rule.label for rule in rules]
    counts = trips.agg(*[c.alias(f"r{i}") for i, c in enumerate(failing)])
    named = F.array(*[F.struct(F.lit(label).alias("rule"), F.col(f"r{i}").alias("failing")) for i, label in enumerate(labels)])
    return counts.select(F.inline(named)).withColumn("outcome", F.when(F.col("failing") == 0, "Passed").otherwise("Failed"))
