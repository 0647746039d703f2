"""Dictionaries kept as tables: terms found in texts by a join instead of one pattern built on the driver.

The rules are those of ``rules.matches``: terms of up to three characters are
whole parts between delimiters, longer ones stand at word boundaries, and a veto
pattern anywhere in the text suppresses its term.  A term is looked up under one
anchor that every text with the term has as well: the term itself where it is
short, else the rarest (in the texts) of its couples, which are two words and what
is between them, else its one word, else, without any, the whole gap between two
words.  Anchors of texts and terms meet in a join, whose small side Spark takes by
its size, and only terms that met are searched in a text.
"""

from __future__ import annotations

from collections.abc import Callable

from evimap.functions import rules as R
from evimap.functions import text as T
from evimap.operators.lineage import settle, stored
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EDGE = "\x01"
#: A word as (?U)\w+ knows it; the classes of Unicode are only asked for characters outside ASCII.
_WORD = r"(?U)[0-9A-Z_a-z[[^\x00-\x7F]&&[\w]]]+"


def _plain(c: Column) -> Column:
    return F.translate(R.ready(c), _EDGE, "\x02")


def _edged(c: Column) -> Column:
    """With a sign at every word boundary, so that one search for a text part sees the boundaries too."""
    return F.regexp_replace(c, _WORD, f"{_EDGE}$0{_EDGE}")


#: White space of Unicode, as the expressions with (?U) know it.
_SPACES = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _parts(c: Column) -> Column:
    """What is between delimiters and white space; some are empty."""
    of = T.DELIMITERS + _SPACES.replace(" ", "")
    return F.split(F.translate(c, of, " " * len(of)), " ")


def _pieces(c: Column, make: Callable[[Column, Column], Column]) -> Column:
    """``make`` of the words and of what is before, between and after them, from one search for their boundaries."""
    at = lambda p, i: F.filter(p, lambda x, k: k % 2 == i)
    halves = lambda p: F.struct(at(p, 1).alias("words"), at(p, 0).alias("gaps"))
    return R.let(R.let(F.split(_edged(c), _EDGE), halves), lambda t: make(t["words"], t["gaps"]))


def _couples(words: Column, gaps: Column, make: Callable[[Column], Column] = lambda x: x) -> Column:
    """``make`` of each word with the next one and what is between them."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    # whole arrays side by side: an array looked into from a lambda is made anew for each item
    heads = F.zip_with(F.slice(words, 1, n), F.slice(gaps, 2, n), lambda w, g: F.concat(w, g))
    return F.zip_with(heads, F.slice(words, 2, n), lambda h, w: make(F.concat(h, w)))


def _hash(prefix: str) -> Callable[[Column], Column]:
    return lambda x: F.xxhash64(F.lit(prefix), x)


def anchors(low: Column) -> Column:
    """Hashes of everything in a text that a term can be looked up under."""
    short = lambda s: F.transform(F.filter(_parts(s), lambda p: F.length(p).between(1, 3)), _hash("p"))
    long = lambda w, g: F.concat(F.transform(w, _hash("w")), _couples(w, g, _hash("c")), F.transform(F.filter(g, lambda x: F.length(x) > 3), _hash("g")))
    return R.let(low, lambda s: F.array_distinct(F.concat(short(s), _pieces(s, long))))


def places(terms: DataFrame, term: str) -> DataFrame:
    """term, low, places: the anchors that a text with the term has all of."""
    rows = terms.select(F.col(term).alias("term"), _plain(F.col(term)).alias("low")).where("low <> ''").distinct()
    one = lambda prefix: F.array(F.xxhash64(F.lit(prefix), F.col("low")))
    long = lambda w, g: F.when(F.size(w) > 1, F.array_distinct(_couples(w, g, _hash("c")))).when(F.size(w) > 0, F.transform(w, _hash("w"))).otherwise(one("g"))
    long = _pieces(F.col("low"), long)
    return rows.withColumn("places", F.when(F.length("low") <= 3, one("p")).otherwise(long))


def index(placed: DataFrame, seen: DataFrame) -> DataFrame:
    """anchor, term, low, edged of each term of ``places``; ``seen`` has the anchors of the texts and how many rows have each."""
    each = placed.select("term", "low", F.explode("places").alias("anchor"), F.size("places").alias("n")).join(seen, "anchor")
    # a term with a couple that no text has is nowhere
    rarest = each.groupBy("term", "low").agg(F.count("*").alias("met"), F.first("n").alias("n"), F.min(F.struct("texts", "anchor")).alias("x")).where("met = n")
    edge = F.lit(_EDGE)
    inner = F.regexp_replace(_edged(F.col("low")), f"^{_EDGE}|{_EDGE}$", "")
    # a word or a couple without anything around it is one of those of a text, or not in it
    whole = _pieces(F.col("low"), lambda w, g: (F.size(w).between(1, 2)) & (F.col("low") == F.array_join(F.flatten(F.zip_with(F.slice(w, 1, 2), F.concat(F.slice(g, 2, F.size(w) - 1), F.array(F.lit(""))), lambda x, y: F.array(x, y))), "")))
    return rarest.select("term", "low", F.col("x.anchor").alias("anchor"), F.when(F.length("low") > 3, F.concat(edge, inner, edge)).alias("edged"), whole.alias("whole"))


def mentions(texts: DataFrame, text: Column, terms: DataFrame, term: str = "term", vetoes: DataFrame | None = None) -> DataFrame:
    """The rows of ``texts``, once for each term that they have, in a column ``keyword``.

    ``vetoes`` has columns ``term`` and ``pattern``; patterns ignore case, and
    hold for every spelling of their term.  Null texts and null or empty terms
    have no part; terms that repeat count once.
    """
    placed = stored(places(terms, term))
    # of a text only the anchors that some term has go on; they are hashes, and one that two anchors share only adds terms to look for
    wanted = stored(placed.select(F.explode("places").alias("anchor")).distinct())
    rows = texts.withColumn("_id", F.xxhash64(_plain(text)))
    held = settle(rows.select("_id", F.explode(anchors(_plain(text))).alias("anchor")).join(wanted, "anchor", "left_semi"))
    seen = held.groupBy("anchor").agg(F.count("*").alias("texts"))
    met = held.join(stored(index(placed, seen)), "anchor").select("_id", "term", "low", "edged", "whole")
    # one row for each text with all terms to look for: equal texts share it, and a hash that two texts share only adds terms to look for
    met = met.groupBy("_id").agg(F.collect_set(F.struct("term", "low", "edged", "whole")).alias("_met"))
    rows = rows.join(met, "_id").withColumn("_low", _plain(text))
    of = lambda m: F.filter("_met", m)
    whole, part = (lambda m: m["edged"].isNotNull() & m["whole"]), (lambda m: m["edged"].isNull())
    # sets meet sets; only a term of more than two words, or with signs around it, is searched in the text
    have = lambda form, kind: R.let(F.array_intersect(F.transform(of(kind), lambda m: m["low"]), form), lambda lows: of(lambda m: kind(m) & F.array_contains(lows, m["low"])))
    wholes = F.when(F.exists("_met", whole), have(_pieces(F.col("_low"), lambda w, g: F.concat(w, _couples(w, g))), whole))
    parts = F.when(F.exists("_met", part), have(_parts(F.col("_low")), part))
    searched = lambda m: m["edged"].isNotNull() & ~m["whole"]
    others = F.when(F.exists("_met", searched), R.let(_edged(F.col("_low")), lambda e: of(lambda m: searched(m) & F.contains(e, m["edged"]))))
    none = F.array().cast("array<struct<term:string,low:string,edged:string,whole:boolean>>")
    found = F.concat(*(F.coalesce(x, none) for x in (wholes, parts, others)))
    rows = rows.withColumn("keyword", F.explode(F.transform(found, lambda m: m["term"])))
    if vetoes is not None:
        barred = vetoes.select(_plain(F.col("term")).alias("_term"), F.concat(F.lit("(?iU)(?:"), "pattern", F.lit(")")).alias("_bar")).groupBy("_term").agg(F.collect_set("_bar").alias("_bars"))
        rows = rows.withColumn("_term", _plain(F.col("keyword"))).join(barred, "_term", "left").where(F.col("_bars").isNull() | ~F.exists("_bars", lambda b: F.regexp_like(F.col("_low"), b)))
    return rows.select(*(F.col(f"`{c}`") for c in texts.columns), "keyword")
