"""The quality gate of candles and trades: a report, an exception for the first broken rule, a split into good and bad rows."""

from __future__ import annotations

from functools import reduce
from importlib.resources import files
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallow.operators.rules import Rule, RuleError, absent, compile_rules, counts, duplicate_keys, load_declaration
from tallow.schema import SERIES, TRADE_KEY  # noqa: F401

#: The rules of the datasets, as declared in the package's YAML files.
_FILES = files("tallow") / "declarations"
CANDLE_RULES = load_declaration(_FILES / "candles.yaml")
TRADE_RULES = load_declaration(_FILES / "trades.yaml")

#: Rows of a stretch of the input order; one row of each meets the others to compare the ends.
STRETCH = 100_000


class QualityError(ValueError):
    """A table breaks a rule."""

    def __init__(self, rule: str, message: str):
        super().__init__(message)
        self.rule = rule


def unsorted_rows(df: DataFrame, ordinal: str, scope: str = "series", time: str = "open_time", series: tuple[str, ...] = SERIES) -> DataFrame:
    """Rows whose time is before that of the row ahead of them in the input's order; ties pass.

    ``series`` compares within each series, ``frame`` neighbours whatever their series. Stretches of the order are
    checked side by side, and their first and last rows in one small window, so a long series is no hot group.
    """
    if scope not in ("series", "frame"):
        raise ValueError("scope is series or frame")
    keys = list(series) if scope == "series" else []
    part = df.withColumn("_stretch", F.floor(F.col(ordinal) / STRETCH))
    inside = part.withColumn("_ahead", F.lag(time).over(Window.partitionBy(*keys, "_stretch").orderBy(ordinal)))
    ends = part.groupBy(*keys, "_stretch").agg(F.min(ordinal).alias("_first"), F.max_by(time, ordinal).alias("_last"))
    seams = ends.select("_first", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_stretch")).alias("_seam")).filter("_seam IS NOT NULL")
    joined = inside.join(seams, F.col(ordinal) == F.col("_first"), "left").withColumn(f"previous_{time}", F.coalesce("_ahead", "_seam"))
    return joined.filter(F.col(time) < F.col(f"previous_{time}")).drop("_stretch", "_ahead", "_first", "_seam")


def _out_of_order(df: DataFrame, ordinal: str, scope: str, declaration: dict[str, Any]) -> DataFrame:
    if "time" not in declaration:
        raise RuleError("the order of rows can't be checked, as the declaration names no time")
    return unsorted_rows(df, ordinal, scope, declaration["time"], tuple(declaration.get("series", ())))


def check(df: DataFrame, ordinal: str | None = None, scope: str = "series", declaration: dict[str, Any] = CANDLE_RULES) -> list[tuple[str, int]]:
    """Violations of each rule, in the order in which the gate reports them: one aggregate, one count of duplicate keys.

    Their order is checked only where an ordinal column is given, as a DataFrame has no order of its own.
    """
    lacking = absent(df, declaration)
    if lacking:
        return [("missing_columns: " + ", ".join(lacking), len(lacking))]
    rules = compile_rules(declaration)
    found = counts(df, rules).first().asDict()
    late = declaration.get("late_logical", ())
    report = [("empty", int(found["rows"] == 0))]
    report += [(r.name, found[r.name]) for r in rules if r.name not in late]
    if declaration.get("unique"):
        report.append(("duplicate_keys", duplicate_keys(df, tuple(declaration["unique"])).count()))
    if ordinal:
        report.append(("unsorted_rows", _out_of_order(df, ordinal, scope, declaration).count()))
    return report + [(name, found[name]) for name in late]


def enforce(df: DataFrame, ordinal: str | None = None, scope: str = "series", declaration: dict[str, Any] = CANDLE_RULES) -> DataFrame:
    """df itself, or a QualityError for the first rule that it breaks."""
    for rule, n in check(df, ordinal, scope, declaration):
        if n:
            raise QualityError(rule.split(":")[0], f"rows break the rule {rule} ({n} times)")
    return df


def gate_report(df: DataFrame, ordinal: str | None = None, scope: str = "series", declaration: dict[str, Any] = CANDLE_RULES) -> DataFrame:
    """Rows (rule, violations) of the whole gate as one plan: absent columns, no rows, row rules, duplicate keys, order."""
    lacking = absent(df, declaration)
    head = df.sparkSession.createDataFrame([("missing_columns", len(lacking))], "rule string, violations long")
    if lacking:
        return head
    rules = compile_rules(declaration)
    one = counts(df, rules)
    pairs = [F.struct(F.lit("empty").alias("rule"), (F.col("rows") == 0).cast("long").alias("violations"))]
    pairs += [F.struct(F.lit(r.name).alias("rule"), F.col(f"`{r.name}`").alias("violations")) for r in rules]
    out = head.unionByName(one.select(F.inline(F.array(*pairs))))
    more = {}
    if declaration.get("unique"):
        more["duplicate_keys"] = duplicate_keys(df, tuple(declaration["unique"]))
    if ordinal:
        more["unsorted_rows"] = _out_of_order(df, ordinal, scope, declaration)
    for name, found in more.items():
        out = out.unionByName(found.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("violations")))
    return out


def row_rules(declaration: dict[str, Any] = CANDLE_RULES) -> list[Rule]:
    return compile_rules(declaration)


def broken_rules(df: DataFrame, declaration: dict[str, Any] = CANDLE_RULES) -> DataFrame:
    """df with ``broken``: the names of the row rules that a row breaks."""
    marks = [F.when(r.violated(df.schema), F.lit(r.name)) for r in row_rules(declaration)]
    return df.withColumn("broken", F.array_compact(F.array(*marks).cast("array<string>")))


def split(df: DataFrame, declaration: dict[str, Any] = CANDLE_RULES) -> tuple[DataFrame, DataFrame]:
    """Rows that break no row rule, and the others with ``broken``."""
    marked = broken_rules(df, declaration)
    return marked.filter(F.size("broken") == 0).drop("broken"), marked.filter(F.size("broken") > 0)


def violation_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows (rule, violations) without a driver round trip."""
    one = counts(df, rules)
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(f"`{r.name}`").alias("violations")) for r in rules]
    return one.select(F.inline(F.array(*pairs)))


def any_of(df: DataFrame, names: list[str], declaration: dict[str, Any] = CANDLE_RULES) -> DataFrame:
    """Rows that break any of the named row rules."""
    chosen = [r.violated(df.schema) for r in row_rules(declaration) if r.name in names]
    return df.filter(reduce(lambda a, b: a | b, chosen))
