"""Quality rules as data, compiled to Spark expressions.

A declaration is a mapping, given in Python or in a YAML file, with any of ``required`` (columns that must be there),
``not_null``, ``logical`` (Spark SQL conditions), ``non_negative``, ``one_of``, ``unique`` (a key), ``late_logical``, and, for
the check of the rows' order, ``time`` (a column) and ``series`` (the columns within which it must ascend).
Row rules become counts of violations in one aggregate over the table, whatever their number; a unique rule is one more.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from importlib.resources.abc import Traversable
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class RuleError(ValueError):
    """A declaration of rules can't be used."""


@dataclass(frozen=True)
class Rule:
    """A row rule: ``violated`` makes the condition for a table's schema."""

    name: str
    violated: Any


def missing(schema: T.StructType, column: str) -> Column:
    """Null, or NaN where the column is floating: NaN is no null in Spark and larger than every number."""
    c = F.col(column)
    return c.isNull() | F.isnan(c) if isinstance(schema[column].dataType, (T.DoubleType, T.FloatType)) else c.isNull()


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _holds_not(expression: str) -> Column:
    """True where the expression is false; a comparison with a missing value is no violation, as missing values have their own rule."""
    return F.coalesce(~F.expr(expression), F.lit(False))


KINDS = {"required": list, "not_null": list, "logical": list, "non_negative": list, "one_of": dict, "unique": list, "late_logical": list, "time": str, "series": list}


def load_declaration(path: str | Traversable) -> dict[str, Any]:
    """The declaration in a YAML file's ``rules``; a RuleError for anything that no rule can be made of."""
    import yaml

    try:
        file = Path(path) if isinstance(path, str) else path
        rules = (yaml.safe_load(file.read_text(encoding="utf-8")) or {})["rules"]
    except (OSError, yaml.YAMLError, TypeError, KeyError) as e:
        raise RuleError(f"{path} declares no rules") from e
    for kind, given in rules.items():
        if not isinstance(given, KINDS.get(kind, ())):
            raise RuleError(f"{path}: {kind} is no kind of rule, or not a {KINDS[kind].__name__ if kind in KINDS else 'known one'}")
    return rules


def absent(df: DataFrame, declaration: dict[str, Any]) -> list[str]:
    """Columns that the declaration needs and df lacks."""
    needed = [*declaration.get("required", ()), *declaration.get("not_null", ()), *declaration.get("non_negative", ()), *declaration.get("one_of", ()), *declaration.get("unique", ())]
    needed += [*declaration.get("series", ()), *([declaration["time"]] if "time" in declaration else [])]
    return [c for c in dict.fromkeys(needed) if c not in df.columns]


def compile_rules(declaration: dict[str, Any]) -> list[Rule]:
    """Row rules in the order in which they are reported."""
    rules: list[Rule] = []
    if columns := declaration.get("not_null"):
        rules.append(Rule("missing_values", lambda s, columns=columns: _any([missing(s, c) for c in columns])))
    for text in declaration.get("logical", ()):
        rules.append(Rule(text, lambda s, text=text: _holds_not(text)))
    if columns := declaration.get("non_negative"):
        rules.append(Rule("negative_values", lambda s, columns=columns: _any([F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns])))
    for column, values in declaration.get("one_of", {}).items():
        rules.append(Rule(f"{column}_domain", lambda s, c=column, v=values: F.coalesce(~F.col(c).isin(*v), F.lit(False))))
    for text in declaration.get("late_logical", ()):
        rules.append(Rule(text, lambda s, text=text: _holds_not(text)))
    return rules


def counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: the number of rows, and of violations of each rule."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(r.violated(df.schema)).alias(r.name) for r in rules))


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def naming_violations(df: DataFrame) -> DataFrame:
    """Rows whose symbol isn't upper case or whose exchange isn't lower case; field names are checked on the driver."""
    bad = [f for f in df.columns if not f.replace("_", "").isalnum() or f != f.lower()]
    if bad:
        raise ValueError(f"field names aren't snake case: {', '.join(bad)}")
    return df.filter((F.col("symbol") != F.upper("symbol")) | (F.col("exchange") != F.lower("exchange")))
