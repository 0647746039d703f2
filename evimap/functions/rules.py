"""Ordered text rules, compiled to columns."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from evimap.functions import defaults as D
from evimap.functions import text as T


@dataclass(frozen=True)
class RuleSet:
    """All rule tables that a map is derived with; each can be a caller's own."""

    keywords: Sequence[str] = field(default_factory=lambda: D.KEYWORDS)
    vetoes: Mapping[str, str] = field(default_factory=lambda: D.VETOES)
    categories: Sequence[tuple[str, Sequence[str]]] = field(default_factory=lambda: D.CATEGORIES)
    adjuncts: Sequence[str] = field(default_factory=lambda: D.ADJUNCTS)
    units: Sequence[tuple[str, str]] = field(default_factory=lambda: D.UNITS)
    change: str = D.PERCENT_OF_CHANGE
    category_units: Mapping[str, str] = field(default_factory=lambda: D.CATEGORY_UNITS)


def quoted(token: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", token)


def token_in(token: str, text: Column, vetoes: Mapping[str, str] = D.VETOES) -> Column:
    """Whether ``text`` (lower-cased, ASCII quotes) has the token.

    Up to three characters: as a whole part between delimiters; longer: at word
    boundaries.  A veto pattern anywhere in the text suppresses its token.
    """
    token = lowered(token)
    if not token:
        return F.lit(False)
    if len(token) <= 3:
        parts = F.split(F.translate(text, T.DELIMITERS, " " * len(T.DELIMITERS)), r"(?U)\s+")
        found = F.array_contains(parts, token)
    else:
        found = text.contains(token) & text.rlike(r"(?U)\b" + quoted(token) + r"\b")
    if token in vetoes:
        found &= ~text.rlike("(?iU)(?:" + vetoes[token] + ")")
    return F.coalesce(found, F.lit(False))


def ready(c: Column) -> Column:
    return F.lower(T.ascii_quotes(F.coalesce(c, F.lit(""))))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for the row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_word(c: str) -> bool:
    return c.isalnum() or unicodedata.category(c) in ("Mn", "Mc", "Me", "Pc")


def heads_of(token: str, tokens: Iterable[str]) -> list[str]:
    """Those of ``tokens`` that a text has wherever ``token`` starts: itself and what it begins with, up to a word boundary."""
    return [t for t in tokens if token.startswith(t) and (t == token or in_word(t[-1]) != in_word(token[len(t)]))]


def tokens_in(text: Column, tokens: Sequence[str], vetoes: Mapping[str, str] = D.VETOES) -> Column:
    """Array of the distinct ``tokens`` (lower case) found in ``text``, by the rules of ``token_in``, in their order.

    The text is split once for the short tokens and searched once for the long
    ones: at each word start one alternation, longest first, gives the longest
    token there, which stands for those it begins with.
    """
    tokens = list(dict.fromkeys(t for t in tokens if t))
    short, long = [t for t in tokens if len(t) <= 3], [t for t in tokens if len(t) > 3]
    found = []
    if short:
        parts = F.split(F.translate(text, T.DELIMITERS, " " * len(T.DELIMITERS)), r"(?U)\s+")
        found.append(F.array_intersect(strings(short), parts))
    if long:
        firsts = sorted({t[0] for t in long})
        by_first = ("|".join(quoted(t) for t in sorted((t for t in long if t[0] == c), key=len, reverse=True)) for c in firsts)
        pattern = "(?U)(?=[" + "".join(map(quoted, firsts)) + r"])\b(?=(" + "|".join(f"(?:{x})" for x in by_first) + r")\b)"
        hits = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
        heads = {t: heads_of(t, long) for t in long}
        whole = table(heads)
        found.append(F.flatten(F.transform(hits, lambda x: whole[x])) if any(len(x) > 1 for x in heads.values()) else hits)
    if not found:
        return strings([])
    every = found[0] if len(found) == 1 else F.concat(*found)
    ordered = F.coalesce(F.array_intersect(strings(tokens), every), strings([]))
    unsafe = [t for t in tokens if t in vetoes]
    if not unsafe:
        return ordered

    def kept(own: Column) -> Column:
        lost = F.array_compact(F.array(*(F.when(F.array_contains(own, t) & text.rlike("(?iU)(?:" + vetoes[t] + ")"), F.lit(t)) for t in unsafe)))
        return F.when(F.arrays_overlap(own, strings(unsafe)), F.array_except(own, lost)).otherwise(own)

    return let(ordered, kept)


def sql_text(value: str | int | Sequence[str]) -> str:
    """A constant in the words of SQL: one parsed text is far cheaper to build than a column for each item."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value) if isinstance(value, int) else f"cast(array({', '.join(map(sql_text, value))}) as array<string>)"


def strings(values: Iterable[str]) -> Column:
    return F.expr(sql_text(list(values)))


def table(values: Mapping[str, str | int | Sequence[str]]) -> Column:
    return F.expr(f"map({', '.join(f'{sql_text(k)}, {sql_text(v)}' for k, v in values.items())})")


def lowered(token: str) -> str:
    return token.translate(str.maketrans("‘’′", "'''")).lower()


def matches(text: Column, keywords: Sequence[str] = D.KEYWORDS, vetoes: Mapping[str, str] = D.VETOES) -> Column:
    """Array of the keywords found, in their order."""
    names: dict[str, list[str]] = {}
    for k in keywords:
        names.setdefault(lowered(k), []).append(k)
    names.pop("", None)
    if not names:
        return strings([])
    known = table(names)
    return let(ready(text), lambda low: F.flatten(F.transform(tokens_in(low, list(names), vetoes), lambda t: known[t])))


def first_rule(text: Column, rules: Sequence[tuple[str, Sequence[str]]], vetoes: Mapping[str, str] = D.VETOES) -> Column:
    """Name of the first rule with a token in ``text`` (already lower-cased), else null."""
    first: dict[str, int] = {}
    for i, (_, tokens) in enumerate(rules):
        for t in tokens:
            first.setdefault(lowered(t), i)
    first.pop("", None)
    if not first:
        return F.lit(None).cast("string")
    place = table(first)
    return F.get(strings(name for name, _ in rules), F.array_min(F.transform(tokens_in(text, list(first), vetoes), lambda t: place[t])))


def category(keyword: Column, text: Column, rules: Sequence[tuple[str, Sequence[str]]] = D.CATEGORIES, vetoes: Mapping[str, str] = D.VETOES) -> Column:
    """First rule that fits the keyword alone, then keyword and text together, else Unmapped."""
    alone = let(F.trim(ready(keyword)), lambda x: first_rule(x, rules, vetoes))
    both = let(F.trim(F.concat_ws(" ", ready(keyword), ready(text))), lambda x: first_rule(x, rules, vetoes))
    return F.coalesce(alone, both, F.lit("Unmapped"))


def unit(text: Column, patterns: Sequence[tuple[str, str]] = D.UNITS, change: str = D.PERCENT_OF_CHANGE) -> Column:
    """struct(raw, normal) of the first unit pattern, then of a percent sign outside a context of change; blank if none.

    One alternation tells the texts that have any unit; only these are searched pattern by pattern.
    """
    def pair(raw: str, name: str) -> Column:
        return F.struct(F.lit(raw).alias("raw"), F.lit(name).alias("normal"))

    def find(low: Column) -> Column:
        hits = (F.concat(F.lit(name + "\x01"), F.get(F.regexp_extract_all(low, F.lit(f"(?U)({p})"), F.lit(1)), F.lit(0))) for p, name in patterns)
        return let(F.coalesce(*hits), lambda h: F.when(h.isNotNull(), F.struct(F.substring_index(h, "\x01", -1).alias("raw"), F.substring_index(h, "\x01", 1).alias("normal"))))

    def decide(low: Column) -> Column:
        percent = (low.contains("%") | low.contains("percent")) & ~low.rlike("(?U)" + change)
        known = [F.when(low.rlike("(?U)" + "|".join(p for p, _ in patterns)), find(low))] if patterns else []
        return F.coalesce(*known, F.when(percent, pair("%", "%")), pair("", ""))

    return let(F.lower(F.coalesce(text, F.lit(""))), decide)


def fallback_unit(found: Column, name: Column, units: Mapping[str, str] = D.CATEGORY_UNITS) -> Column:
    """``found``, or where blank the unit that the category stands for, or ''."""
    return F.coalesce(T.blank_to_null(found), table(units)[name], F.lit(""))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(w) for w in words))


def classify_arm(text: Column, rules: Sequence[tuple[str, Sequence[str]]] = D.COMPARATORS) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(*(F.when(contains_any(low, words), F.lit(name)) for name, words in rules), F.lit("experimental"))


def is_placebo(text: Column, words: Sequence[str] = D.PLACEBO_WORDS) -> Column:
    return contains_any(F.lower(F.coalesce(text, F.lit(""))), words)


#: Phrase queries by name: groups of alternatives that all must be met.
NAMED_QUERIES: dict[str, Sequence[Sequence[str]]] = {}


def name_query(name: str, groups: Sequence[Sequence[str]]) -> None:
    NAMED_QUERIES[name] = groups


def tagged(rows, text: Column, names: Sequence[str] | None = None):
    """Rows once for each named query that their text meets, with its name as query_name."""
    wanted = list(NAMED_QUERIES) if names is None else list(names)
    hits = F.array_compact(F.array(*(F.when(phrase_query(text, NAMED_QUERIES[n]), F.lit(n)) for n in wanted)).cast("array<string>"))
    return rows.withColumn("query_name", F.explode(hits))


def phrase_query(text: Column, groups: Sequence[Sequence[str]]) -> Column:
    """(a or b ...) and (c or d ...): every group has a phrase in the text, as whole words."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a & b, (low.rlike(r"(?U)\b(?:" + "|".join(quoted(p.lower()) for p in g) + r")\b") for g in groups), F.lit(True))
