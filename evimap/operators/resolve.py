"""Entity resolution of two sources: by id, by exact title, by blocked fuzzy title."""

from __future__ import annotations

from evimap.functions import text as T
from evimap.operators import edits, word_blocks
from evimap.operators.dedup import one_per_key
from evimap.operators.greedy import first_by_links
from evimap.operators.lineage import many, settle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_by_id(base: DataFrame, other: DataFrame, key: str, sources: str, fill: list[str]) -> DataFrame:
    """Add the other source's tags to matching rows and fill their blank columns; other rows of ``base`` stay as they are."""
    right = other.groupBy(key).agg(F.array_sort(F.collect_set(sources)).alias("_tags"), *(F.min(T.blank_to_null(F.col(c))).alias(f"_{c}") for c in fill))
    tags = F.array_sort(F.array_union(F.array(F.col(sources)), F.coalesce("_tags", F.array().cast("array<string>"))))
    changed = {sources: F.array_join(tags, ";")} | {c: F.coalesce(T.blank_to_null(F.col(c)), F.col(f"_{c}")) for c in fill}
    return base.join(right, key, "left").withColumns(changed).drop("_tags", *(f"_{c}" for c in fill))


def exact_title_matches(left: DataFrame, right: DataFrame, key_l: str, key_r: str, title_l: str, title_r: str) -> DataFrame:
    """(left key, smallest right key) where lower-cased, trimmed titles are equal."""
    a = left.select(F.col(key_l).alias("left_id"), F.lower(T.normal_space(F.col(title_l))).alias("t")).where("t <> ''")
    b = right.select(F.col(key_r).alias("right_id"), F.lower(T.normal_space(F.col(title_r))).alias("t")).where("t <> ''")
    return a.join(b.groupBy("t").agg(F.min("right_id").alias("right_id")), "t").select("left_id", "right_id")


def titles(df: DataFrame, key: str, title: str) -> DataFrame:
    """Distinct titles that have words of four letters or more, under their smallest id: title, id, w (in order), n (length)."""
    own = df.groupBy(F.lower(T.normal_space(F.col(title))).alias("title")).agg(F.min(key).alias("id"))
    return own.withColumns({"w": F.array_sort(T.title_words(F.col("title"))), "n": F.length("title")}).where(F.size("w") > 0)


def word_set_pairs(a: DataFrame, b: DataFrame, least_jaccard: float, shared_half: bool = True) -> DataFrame:
    """Pairs of distinct word sets of the titles of ``a`` and ``b`` that are alike enough: w_l, w_r, jaccard, apart (words of one side only).

    Titles of one word set meet once, however many they are.  Pairs are found in
    blocks of both sides (``word_blocks``), and only those that share enough by the
    hashes of their words look the words up.  A set counts as sharing enough from
    max(2, half of the left set's words) words on.
    """
    left = _word_sets(a)
    right = left if b is a else _word_sets(b)
    return _set_pairs(left, right, least_jaccard, shared_half).select("w_l", "w_r", "jaccard", "apart")


def _set_pairs(left: DataFrame, right: DataFrame, least_jaccard: float, shared_half: bool) -> DataFrame:
    words = lambda rows, side: rows.select(F.col("set").alias(f"set_{side}"), F.col("w").alias(f"w_{side}"))
    pairs = word_blocks.pairs(left, right, least_jaccard, shared_half).join(words(left, "l"), "set_l").join(words(right, "r"), "set_r")
    return _alike(pairs, least_jaccard, shared_half)


def _word_sets(x: DataFrame) -> DataFrame:
    """Distinct word sets under a number."""
    return settle(x.select("w").distinct().withColumn("set", F.monotonically_increasing_id()))


def _alike(pairs: DataFrame, least_jaccard: float, shared_half: bool) -> DataFrame:
    shared, n_l, n_r = F.size(F.array_intersect("w_l", "w_r")), F.size("w_l"), F.size("w_r")
    enough = shared >= F.greatest(F.lit(2), F.floor(n_l / 2)) if shared_half else F.lit(True)
    return pairs.where(enough).withColumns({"jaccard": shared / (n_l + n_r - shared), "apart": n_l + n_r - 2 * shared}).where(F.col("jaccard") >= least_jaccard)


def _sided(x: DataFrame, side: str) -> DataFrame:
    return x.select(*(F.col(c).alias(f"{c}_{side}") for c in ("title", "id", "w", "n")))


def _possible(pairs: DataFrame, floor: Column) -> DataFrame:
    """Pairs whose lengths and words allow an edit similarity of ``floor``, with the longer length and the limit of their distance."""
    longest = F.greatest("n_l", "n_r")
    limit = F.floor((1 - floor) * longest + 1e-9).cast("int")
    # one edit changes three words at most: two that it joins, and the one they become
    return pairs.withColumns({"longest": longest, "limit": limit}).where((F.abs(F.col("n_l") - F.col("n_r")) <= F.col("limit")) & (F.col("apart") <= 3 * F.col("limit")))


def _measured(pairs: DataFrame, floor: Column) -> DataFrame:
    """Pairs of titles with an edit similarity of at least ``floor``; the distance stops where it cannot be.

    Pairs are few bytes and much work, so they are dealt to a number of tasks that small files are not put together in.
    """
    pairs = _possible(pairs, floor).repartition(many(pairs.sparkSession), "title_l", "title_r")
    return edits.measured(pairs).withColumn("similarity", 1 - F.col("d") / F.col("longest")).drop("longest", "limit", "d")


def _with_titles(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of numbers (k_l, k_r) with the titles (k, title) of both sides."""
    text = lambda rows, side: rows.select(F.col("k").alias(f"k_{side}"), F.col("title").alias(f"title_{side}"))
    return pairs.join(text(left, "l"), "k_l").join(text(right, "r"), "k_r")


#: Titles of at most so many characters are looked up by what is left without one of them.
SHORT = 64


def one_edit_pairs(a: DataFrame, b: DataFrame, least_jaccard: float, shared_half: bool) -> DataFrame:
    """Pairs of short titles at an edit distance of 1, which meet in what is left of both without one character."""

    def rests(x: DataFrame, side: str, longest: int) -> DataFrame:
        less = F.transform(F.sequence(F.lit(1), F.col(f"n_{side}")), lambda i: F.concat(F.substring(f"title_{side}", F.lit(1), i - 1), F.substring(f"title_{side}", i + 1, F.col(f"n_{side}"))))
        return _sided(x, side).where(F.col(f"n_{side}") <= longest).withColumn("rest", F.explode(F.array_distinct(F.concat(F.array(f"title_{side}"), less))))

    pairs = rests(a, "l", SHORT).join(rests(b, "r", SHORT + 1), "rest").drop("rest").where("title_l <> title_r and levenshtein(title_l, title_r, 1) = 1")
    return _alike(pairs, least_jaccard, shared_half).distinct().withColumn("similarity", 1 - 1 / F.greatest("n_l", "n_r"))


def best_titles(left: DataFrame, right: DataFrame, key_l: str, key_r: str, title_l: str, title_r: str, least_jaccard: float, shared_half: bool, least_similarity: float = 0.0) -> DataFrame:
    """left_id, right_id, similarity: the most similar right title for each left row, ties to the smaller right id.

    Pairs that cannot win are not made.  A left title with an equal on the right
    is done; so is one with a neighbour at one edit (two edits can only be more
    similar on a title twice as long, which is more edits away).  The others first
    measure one title of the word set that is most like theirs, and then
    meet only titles that can be more similar than that by their lengths and words.
    """
    numbered = lambda x: settle(x.withColumn("k", F.monotonically_increasing_id()))
    a, b = numbered(titles(left, key_l, title_l)), numbered(titles(right, key_r, title_r))
    result = lambda x: x.select("title_l", F.col("id_r").alias("right_id"), "similarity")
    equal = _alike(_sided(a, "l").join(_sided(b, "r"), F.col("title_l") == F.col("title_r")), least_jaccard, shared_half).withColumn("similarity", F.lit(1.0))
    equal = settle(result(equal))
    rest = settle(a.join(equal.select(F.col("title_l").alias("title")), "title", "left_anti"))
    near = settle(result(one_edit_pairs(rest, b, least_jaccard, shared_half).where(F.col("similarity") >= least_similarity)))
    rest = settle(rest.join(near.select(F.col("title_l").alias("title")), "title", "left_anti"))
    sets_l, sets_r = _word_sets(rest), _word_sets(b)
    # from here on pairs are numbers; titles come to those that their lengths and words leave
    sets = settle(_set_pairs(sets_l, sets_r, least_jaccard, shared_half).select("set_l", "set_r", "jaccard", "apart"))
    theirs = settle(b.join(sets_r, "w").select(F.col("set").alias("set_r"), F.col("k").alias("k_r"), F.col("id").alias("id_r"), F.col("n").alias("n_r")))
    pilot = sets.groupBy("set_l").agg(F.max(F.struct("jaccard", "set_r")).alias("p")).select("set_l", F.col("p.set_r").alias("set_r"))
    pilot = pilot.join(theirs.groupBy("set_r").agg(F.min(F.struct("n_r", "k_r")).alias("p")), "set_r").select("set_l", "p.*")
    ours = rest.join(sets_l, "w").select(F.col("set").alias("set_l"), F.col("k").alias("k_l"), F.col("n").alias("n_l")).join(pilot, "set_l")
    pilots = _with_titles(ours.withColumn("limit", F.greatest("n_l", "n_r")), rest, b).repartition(many(b.sparkSession), "k_l")
    floor = F.greatest(F.lit(least_similarity), 1 - F.col("d") / F.col("limit"))
    ours = settle(edits.measured(pilots).select("set_l", "k_l", "n_l", floor.alias("floor")))
    can = _possible(ours.join(sets, "set_l").join(theirs, "set_r"), F.col("floor")).select("k_l", "k_r", "id_r", "n_l", "n_r", "apart", "floor")
    found = result(_measured(_with_titles(can, rest, b), F.col("floor")).where(F.col("similarity") >= least_similarity))
    best = one_per_key(equal.unionByName(near).unionByName(found), ["title_l"], -F.col("similarity"), F.col("right_id"))
    back = left.select(F.col(key_l).alias("left_id"), F.lower(T.normal_space(F.col(title_l))).alias("title_l"))
    return back.join(best, "title_l").select("left_id", "right_id", "similarity")


def fuzzy_title_matches(left: DataFrame, right: DataFrame, key_l: str, key_r: str, title_l: str, title_r: str, least_jaccard: float = 0.5, least_similarity: float = 0.85) -> DataFrame:
    """left_id, right_id, similarity: the most similar right title for each left title, ties to the smaller id."""
    return best_titles(left, right, key_l, key_r, title_l, title_r, least_jaccard, True, least_similarity)


def nearest_titles(left: DataFrame, right: DataFrame, key_l: str, key_r: str, title_l: str, title_r: str, least_jaccard: float = 0.2) -> DataFrame:
    """For each left row, the best edit similarity among right titles with a word Jaccard of at least ``least_jaccard``; no lower limit."""
    return best_titles(left, right, key_l, key_r, title_l, title_r, least_jaccard, False)


def known_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame, key_l: str, key_r: str, title_l: str, title_r: str) -> DataFrame:
    """Pairs (left_id, right_id) with the similarity of their titles."""
    a = left.select(F.col(key_l).alias("left_id"), F.lower(F.col(title_l)).alias("a"))
    b = right.select(F.col(key_r).alias("right_id"), F.lower(F.col(title_r)).alias("b"))
    return pairs.join(a, "left_id").join(b, "right_id").select("left_id", "right_id", T.edit_similarity(F.col("a"), F.col("b")).alias("similarity"))


def unmatched(new: DataFrame, crosswalk: DataFrame, key: str, base: DataFrame) -> DataFrame:
    """Rows of ``new`` that neither the crosswalk nor ``base`` knows, one for each key."""
    rest = new.join(crosswalk.select(F.col("left_id").alias(key)), key, "left_anti").join(base.select(key), key, "left_anti")
    return one_per_key(rest, [key])


def chained(new: DataFrame, key: str, title: str, order: Column | None = None, least_jaccard: float = 0.5, least_similarity: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """New records join the index as they come, so later ones with an equal or close title are the same study.

    Records come by ``order``, then key.  A title stays unless an earlier title
    that stays is close to it, as in ``fuzzy_title_matches``; a record of a title
    that goes belongs to the most similar title that stays and came before the
    record (ties to the earlier one).  Returns the rows that stay (the first
    of each title that does; rows without a title stay all) and the crosswalk
    left_id -> right_id of the others.
    """
    rows = settle(new.withColumn("_t", F.lower(T.normal_space(F.col(title)))).withColumn("_o", F.struct((F.lit(0) if order is None else order).alias("o"), F.col(key).alias("k"))))
    first = rows.where("_t <> ''").groupBy(F.col("_t").alias("title")).agg(F.min("_o").alias("o"))
    first = settle(first.withColumns({"w": F.array_sort(T.title_words(F.col("title"))), "n": F.length("title"), "k": F.monotonically_increasing_id()}))
    worded = first.where(F.size("w") > 0)
    sets = _word_sets(worded)
    pairs = _set_pairs(sets, sets, least_jaccard, True).select("set_l", "set_r", "apart")
    own = settle(worded.join(sets, "w").select("set", "k", "n", "o"))
    at = lambda side: own.select(*(F.col(c).alias(f"{c}_{side}") for c in own.columns))
    can = _possible(pairs.join(at("l"), "set_l").join(at("r"), "set_r").where("o_r < o_l"), F.lit(least_similarity)).select("k_l", "k_r", "o_r", "n_l", "n_r", "apart")
    close = _measured(_with_titles(can, first, first), F.lit(least_similarity)).where(F.col("similarity") >= least_similarity)
    close = settle(close.select("k_l", "k_r", "o_r", "similarity"))
    fate = settle(first_by_links(close.select(F.col("k_l").alias("later"), F.col("k_r").alias("earlier"))))
    first = first.select(F.col("title").alias("_t"), F.col("k").alias("_k"), "o")
    gone = settle(first.join(fate.where("not stays").select(F.col("node").alias("_k")), "_k", "left_semi"))
    owners = close.join(fate.where("stays").select(F.col("node").alias("k_r")), "k_r", "left_semi").withColumnRenamed("k_l", "_k")
    near = rows.join(gone.select("_t", "_k"), "_t").join(owners, "_k").where("o_r < _o")
    near = one_per_key(near.select(F.col(key).alias("left_id"), "_o", "similarity", "o_r"), ["left_id", "_o"], -F.col("similarity"), F.col("o_r")).select("left_id", F.col("o_r.k").alias("right_id"))
    gone = gone.select("_t")
    known = rows.join(first.select("_t", F.col("o.k").alias("right_id")).join(gone, "_t", "left_anti"), "_t", "left").join(gone.withColumn("_gone", F.lit(True)), "_t", "left")
    stays = known.where("_gone is null").where(F.col("right_id").isNull() | (F.col("right_id") == F.col(key)))
    links = known.where(F.col("right_id") != F.col(key)).select(F.col(key).alias("left_id"), "right_id")
    return one_per_key(stays.select(new.columns), [key]), links.unionByName(near).distinct()


def merge_sources(base: DataFrame, new: DataFrame, key: str, title: str, sources: str, fill: list[str]) -> tuple[DataFrame, DataFrame]:
    """The whole merge of a second source: by id, by exact title, by close title, then chained among the new ones.

    Returns the merged studies and the crosswalk (left_id, right_id) of the new
    source's ids.  Matched rows give their source tag and fill blank columns.
    The first way that matches a row counts; both sources, which every way reads,
    and matches, which everything after them depends on, are kept in the shared folder.
    """
    base, new = settle(base), settle(new)
    match = lambda df, rank: df.select("left_id", F.struct(F.lit(rank).alias("rank"), F.col("right_id")).alias("m"))
    by_id = new.join(base.select(key), key, "left_semi").select(F.col(key).alias("left_id"), F.col(key).alias("right_id"))
    ways = [by_id, exact_title_matches(new, base, key, key, title, title), fuzzy_title_matches(new, base, key, key, title, title)]
    every = match(ways[0], 0).unionByName(match(ways[1], 1)).unionByName(match(ways[2], 2))
    found = settle(every.groupBy("left_id").agg(F.min("m").alias("m")).select("left_id", "m.right_id"))
    rest = new.join(found.select(F.col("left_id").alias(key)), key, "left_anti")
    stays, links = chained(rest, key, title)
    links = settle(links)
    stays = settle(stays)
    tagged = new.join(found.withColumnRenamed("left_id", key), key).withColumn(key, F.col("right_id")).select(key, sources, *fill)
    more = new.join(links.withColumnRenamed("left_id", key), key).withColumn(key, F.col("right_id")).select(key, sources, *fill)
    merged = merge_by_id(base, tagged, key, sources, fill).unionByName(merge_by_id(stays, more, key, sources, fill), allowMissingColumns=True)
    return merged, found.unionByName(links).where("left_id <> right_id")


def remap(children: DataFrame, key: str, crosswalk: DataFrame, other: str | None = None) -> DataFrame:
    """Children under the id that the crosswalk (left_id, right_id) gives for ``key``, else for the ``other`` id column, else under their own."""
    to = crosswalk.groupBy("left_id").agg(F.min("right_id").alias("right_id"))
    out = children.join(to.withColumnRenamed("left_id", key).withColumnRenamed("right_id", "_a"), key, "left")
    found = [F.col("_a")]
    if other:
        out = out.join(to.withColumnRenamed("left_id", other).withColumnRenamed("right_id", "_b"), other, "left")
        found.append(F.col("_b"))
    return out.withColumn(key, F.coalesce(*found, F.col(key))).select(children.columns)


def union_first_wins(parts: list[DataFrame], keys: list[str], order: Column) -> DataFrame:
    """All parts, the first row of each key in the order of the parts, then of ``order``."""
    tagged = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)]
    out = tagged[0]
    for p in tagged[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return one_per_key(out, keys, F.col("_part"), order).drop("_part")


def sample_pairs(pairs: DataFrame, n: int, seed: str, *keys: str) -> DataFrame:
    """``n`` pairs in the order of a seeded hash of their keys."""
    return pairs.orderBy(F.md5(F.concat_ws("|", F.lit(seed), *keys)), *keys).limit(n)


def numbered(df: DataFrame, number: str, *order: Column) -> DataFrame:
    """Rows numbered in order, for review sheets (bounded samples)."""
    return df.withColumn(number, F.row_number().over(Window.orderBy(*order)))
