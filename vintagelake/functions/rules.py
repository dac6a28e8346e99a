"""First-match rule tables rendered as native CASE expressions.

A rule is a conjunction of simple tests on named inputs plus an output
value; rules are evaluated in order and the first whose tests are all TRUE
wins (a test on a NULL input is never TRUE, exactly like SQL CASE).  The
same data renders to a Spark ``Column`` (``when`` chain, codegen'd) and to
an ANSI SQL ``CASE`` string used by the DuckDB oracle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# (input name, operator, operand); operators: < <= > >= = != in not_in
# between (inclusive pair), is_null, not_null
Test = tuple


@dataclass(frozen=True)
class Rule:
    tests: tuple
    value: Any

    @staticmethod
    def of(value: Any, *tests: Test) -> "Rule":
        return Rule(tuple(tests), value)


@dataclass(frozen=True)
class RuleTable:
    """Ordered rules plus the ELSE value (``None`` = no ELSE, i.e. NULL)."""

    name: str
    rules: tuple
    otherwise: Any = None
    output_type: str = "string"
    inputs: tuple = field(default_factory=tuple)
    # > 0: render consecutive rules sharing their first ``nest_prefix`` tests
    # as one guarded sub-CASE (smaller generated code, same first match)
    nest_prefix: int = 0

    def column(self, **inputs: Column | str) -> Column:
        return to_column(self, inputs)

    def sql(self, **inputs: str) -> str:
        return to_sql(self, inputs)


def _lit(v: Any) -> Column:
    return F.lit(v)


def _test_column(col: Column, op: str, operand: Any) -> Column:
    if op == "<":
        return col < _lit(operand)
    if op == "<=":
        return col <= _lit(operand)
    if op == ">":
        return col > _lit(operand)
    if op == ">=":
        return col >= _lit(operand)
    if op == "=":
        return col == _lit(operand)
    if op == "!=":
        return col != _lit(operand)
    if op == "in":
        return col.isin(list(operand))
    if op == "not_in":
        return ~col.isin(list(operand))
    if op == "between":
        lo, hi = operand
        return col.between(_lit(lo), _lit(hi))
    if op == "is_null":
        return col.isNull()
    if op == "not_null":
        return col.isNotNull()
    raise ValueError(f"unknown rule operator {op!r}")


def _resolve(inputs: Mapping[str, Column | str], name: str) -> Column:
    c = inputs.get(name, name)
    return F.col(c) if isinstance(c, str) else c


def _conj(tests, inputs) -> Column | None:
    cond = None
    for name, op, *rest in tests:
        t = _test_column(_resolve(inputs, name), op, rest[0] if rest else None)
        cond = t if cond is None else (cond & t)
    return cond


def _nested_column(table: RuleTable, inputs: Mapping[str, Column | str]) -> Column:
    """First match as ``coalesce`` over guarded groups.

    Flat first-match equals the first non-NULL group result because every
    rule value is non-NULL: a group whose guard holds but whose sub-rules all
    fail yields NULL and evaluation falls through to the next group, exactly
    like the flat CASE.
    """
    k = table.nest_prefix
    if any(r.value is None for r in table.rules):
        raise ValueError("nested rendering needs non-NULL rule values")
    groups: list[tuple[tuple, list]] = []
    for rule in table.rules:
        head, tail = rule.tests[:k], rule.tests[k:]
        if groups and groups[-1][0] == head:
            groups[-1][1].append((tail, rule.value))
        else:
            groups.append((head, [(tail, rule.value)]))
    parts = []
    for head, subs in groups:
        inner = None
        for tail, value in subs:
            cond = _conj(tail, inputs)
            if cond is None:
                cond = F.lit(True)
            inner = F.when(cond, _lit(value)) if inner is None else inner.when(cond, _lit(value))
        guard = _conj(head, inputs)
        parts.append(inner if guard is None else F.when(guard, inner))
    if table.otherwise is not None:
        parts.append(_lit(table.otherwise))
    return F.coalesce(*parts).cast(table.output_type)


def to_column(table: RuleTable, inputs: Mapping[str, Column | str]) -> Column:
    if table.nest_prefix:
        return _nested_column(table, inputs)
    expr = None
    for rule in table.rules:
        cond = None
        for name, op, *rest in rule.tests:
            t = _test_column(_resolve(inputs, name), op, rest[0] if rest else None)
            cond = t if cond is None else (cond & t)
        if cond is None:
            cond = F.lit(True)
        out = _lit(rule.value)
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    if expr is None:
        return F.lit(table.otherwise).cast(table.output_type)
    return expr.otherwise(_lit(table.otherwise)).cast(table.output_type)


def sql_literal(v: Any) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, Decimal)):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    s = str(v).replace("'", "''")
    return f"'{s}'"


def _test_sql(col: str, op: str, operand: Any) -> str:
    if op in ("<", "<=", ">", ">=", "="):
        return f"{col} {op} {sql_literal(operand)}"
    if op == "!=":
        return f"{col} <> {sql_literal(operand)}"
    if op == "in":
        return f"{col} IN ({', '.join(sql_literal(v) for v in operand)})"
    if op == "not_in":
        return f"{col} NOT IN ({', '.join(sql_literal(v) for v in operand)})"
    if op == "between":
        lo, hi = operand
        return f"{col} BETWEEN {sql_literal(lo)} AND {sql_literal(hi)}"
    if op == "is_null":
        return f"{col} IS NULL"
    if op == "not_null":
        return f"{col} IS NOT NULL"
    raise ValueError(op)


_SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}


def to_sql(table: RuleTable, inputs: Mapping[str, str]) -> str:
    parts = []
    for rule in table.rules:
        conds = [_test_sql(inputs.get(n, n), op, rest[0] if rest else None)
                 for n, op, *rest in rule.tests] or ["TRUE"]
        parts.append(f"WHEN {' AND '.join(conds)} THEN {sql_literal(rule.value)}")
    typ = _SQL_TYPES.get(table.output_type, table.output_type)
    if not parts:
        return f"CAST({sql_literal(table.otherwise)} AS {typ})"
    return f"CAST(CASE {' '.join(parts)} ELSE {sql_literal(table.otherwise)} END AS {typ})"


def ladder(name: str, input_name: str, cuts: Sequence[tuple[str, Any, Any]],
           otherwise: Any = None, guard: Sequence[Test] = (), output_type: str = "string") -> RuleTable:
    """Single-input ladder: ``cuts`` is a list of (operator, operand, value)."""
    rules = tuple(Rule(tuple(guard) + ((input_name, op, operand),), value)
                  for op, operand, value in cuts)
    return RuleTable(name, rules, otherwise, output_type, (input_name,))


def lookup(name: str, input_name: str, mapping: Sequence[tuple[Sequence[Any], Any]],
           otherwise: Any = None, output_type: str = "string") -> RuleTable:
    """Set-membership table: ``mapping`` is a list of (values, output)."""
    rules = tuple(Rule(((input_name, "in", tuple(vals)),), out) for vals, out in mapping)
    return RuleTable(name, rules, otherwise, output_type, (input_name,))


def concat(name: str, *tables: RuleTable, otherwise: Any = None) -> RuleTable:
    """Concatenate the rules of several tables (first match across all)."""
    rules = tuple(r for t in tables for r in t.rules)
    return RuleTable(name, rules, otherwise, tables[0].output_type if tables else "string")
