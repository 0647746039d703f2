"""Faceted filters, the search language, sorting and export of the explorer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from evimap.functions import text as T
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FilterState:
    """Conjunctive facet filter; empty parts do not restrict."""

    contains: Mapping[str, str] = field(default_factory=dict)  # any of the |-separated columns has the text
    equals: Mapping[str, str] = field(default_factory=dict)
    flags: Mapping[str, bool] = field(default_factory=dict)
    blanks: Mapping[str, str] = field(default_factory=dict)  # what stands for a missing value

    def condition(self) -> Column:
        parts = [F.lit(True)]
        for columns, value in self.contains.items():
            parts.append(reduce(lambda a, b: a | b, (F.lower(F.coalesce(c, F.lit(""))).contains(value.lower()) for c in columns.split("|"))))
        for column, value in self.equals.items():
            c = F.col(column).cast("string")
            parts.append((F.coalesce(T.blank_to_null(c), F.lit(self.blanks[column])) if column in self.blanks else F.coalesce(c, F.lit(""))) == value)
        parts += [F.coalesce(F.col(c), F.lit(False)) == v for c, v in self.flags.items()]
        return reduce(lambda a, b: a & b, parts)


def search(query: str, fields: Mapping[str, str], everywhere: list[str], year: str, flag: Column) -> Column:
    """``field:value``, ``year:>N``, ``year:<N``, ``year:N``, ``placebo:yes|no``; anything else is looked for in all columns."""
    q = query.strip().lower()
    name, colon, value = q.partition(":")
    name, value = name.strip(), value.strip()
    if not q:
        return F.lit(True)
    if colon and name == "year":
        number = value.lstrip("<>=").strip()
        if number.isdigit():
            n = T.partial_year(F.col(year).cast("string"))
            out = n > int(number) if value[0] == ">" else n < int(number) if value[0] == "<" else n == int(number)
            return F.coalesce(out, F.lit(False))
    if colon and name == "placebo" and value in ("yes", "true", "no", "false"):
        return F.coalesce(flag, F.lit(False)) == (value in ("yes", "true"))
    if colon and name in fields:
        return F.lower(F.coalesce(F.col(fields[name]).cast("string"), F.lit(""))).contains(value)
    return F.lower(F.concat_ws(" ", *(F.col(c).cast("string") for c in everywhere))).contains(q)


def cross_filter(rows: DataFrame, chosen: Mapping[str, str], focus: Sequence[str] = (), conditions: str = "conditions") -> DataFrame:
    """Rows behind a chart: those with the chosen value in every chosen column (an item of it, where it is a list), compared
    without case, and with any of the focus words in the text of ``conditions``.  Empty choices do not restrict."""
    def has(column: str, value: str) -> Column:
        own = F.col(column)
        if rows.schema[column].dataType.typeName() == "array":
            own = F.transform(own, lambda x: F.lower(x.cast("string")))
            return F.coalesce(F.array_contains(own, value.lower()), F.lit(False))
        return F.coalesce(F.lower(own.cast("string")) == value.lower(), F.lit(False))

    keep = reduce(lambda a, b: a & b, (has(c, v) for c, v in chosen.items() if v), F.lit(True))
    if focus:
        text = F.col(conditions)
        text = F.array_join(text, " ") if rows.schema[conditions].dataType.typeName() == "array" else text
        keep &= reduce(lambda a, b: a | b, (F.lower(F.coalesce(text, F.lit(""))).contains(w.lower()) for w in focus))
    return rows.where(keep)


def sorted_page(rows: DataFrame, by: str, descending: bool, limit: int, tie: list[str], fallback: str = "") -> DataFrame:
    """The first rows in the order of a column, without case, missing values as ``fallback``; ties by key."""
    c = F.lower(F.coalesce(F.col(by), F.lit(fallback))) if rows.schema[by].dataType.typeName() == "string" else F.col(by)
    return rows.orderBy(c.desc() if descending else c.asc(), *tie).limit(limit)


def export(rows: DataFrame, columns: list[str], path: str, kind: str = "csv") -> None:
    """Selected columns as CSV, TSV or JSON; text that a spreadsheet would run is made safe."""
    out = rows.select(*(T.formula_safe(F.col(c)).alias(c) if rows.schema[c].dataType.typeName() == "string" and kind != "json" else F.col(c) for c in columns)).write.mode("overwrite")
    if kind == "json":
        out.json(path)
    else:
        out.option("header", True).option("sep", "\t" if kind == "tsv" else ",").option("escape", '"').csv(path)
