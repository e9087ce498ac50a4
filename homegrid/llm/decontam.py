"""Benchmark decontamination with a positional inverted index, in DataFrame functions alone.

The index is distributed by document: every task turns its documents into postings
(term, doc, position) for the terms of the test set, sorts them by term, and stores them, with
the document's length as the posting of term LENGTH. A window of the test set is looked up by
its rarest term first; every hit fixes the place where the window would begin, and the lists
of its other terms, shifted by their offsets, are intersected with those places, rarest first.
What is left are exact phrase matches. ``proximity_matches`` asks for the terms within a span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from homegrid.session import stored_copy

#: A word: no ASCII control, sign or space; A-Z count as letters and are lower-cased afterwards.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LENGTH = -1
#: Broadcast the distinct test terms or windows only up to so many rows; beyond it they are joined by shuffle.
SMALL = 200_000
#: What tells texts apart: doc_id, filled in where ``no_id`` says that it is null, so that null ids meet in joins, and a hash.
KEY = ["no_id", "doc_id", "version"]


def lowered(word: Column) -> Column:
    """A-Z to lower case, no other letter."""
    return F.when(word.rlike("[A-Z]"), F.translate(word, UPPER, LOWER)).otherwise(word)


def words_of(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))


def windows(items: DataFrame, width: int = 10) -> DataFrame:
    """(item_id, w, len, j, word): each window's words; an item of fewer words is one window."""
    words = items.where("item_id is not null").select("item_id", words_of("text").alias("words")).where(F.size("words") > 0)
    starts = words.select(
        "item_id", "words", F.least(F.size("words"), F.lit(width)).alias("len"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))).alias("w"),
    )
    return starts.select("item_id", "w", "len", F.posexplode(F.slice("words", F.col("w") + 1, F.col("len"))).alias("j", "raw")).select(
        "item_id", "w", "len", "j", lowered(F.col("raw")).alias("word")
    )


def own_id() -> Column:
    """doc_id as it was, from the columns of KEY."""
    return F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id")


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL else df


def positional_index(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """The stored postings (term, KEY, position) of ``terms`` (word, term), sorted by term within each file."""
    filled = F.coalesce(F.col("doc_id"), F.lit("0").cast(docs.schema["doc_id"].dataType)).alias("doc_id")
    tokens = docs.select(F.col("doc_id").isNull().alias("no_id"), filled, F.xxhash64(F.coalesce("text", F.lit(""))).alias("version"), words_of("text").alias("words"))
    rows = tokens.select(
        *KEY, F.posexplode(F.concat(F.array(F.lit(None).cast("string")), "words")).alias("at", "raw"), F.size("words").alias("n")
    ).select(*KEY, "at", "n", lowered(F.col("raw")).alias("word"))
    found = rows.join(_sized(terms, n_terms), "word", "left").where("term is not null or word is null")
    postings = found.select(
        F.coalesce("term", F.lit(LENGTH)).alias("term"), *KEY,
        F.when(F.col("word").isNull(), F.col("n")).otherwise(F.col("at") - 1).alias("position"),
    )
    return stored_copy(postings.sortWithinPartitions("term", *KEY, "position"), "postings")


def _ranked(windows_: DataFrame, frequency: DataFrame) -> DataFrame:
    """Each window's words with their place from rarest to most frequent."""
    order = Window.partitionBy("item_id", "w").orderBy("seen", "term", "j")
    known = windows_.join(frequency, "term", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    return known.withColumn("rank", F.row_number().over(order))


def phrase_matches(docs: DataFrame, items: DataFrame, width: int = 10) -> tuple[DataFrame, DataFrame]:
    """The postings, and (KEY, item_id, w, len, begin) for every occurrence of every window."""
    raw = stored_copy(windows(items, width), "windows")
    terms = stored_copy(raw.select("word").distinct().withColumn("term", F.row_number().over(Window.orderBy("word"))), "terms")
    n_terms = terms.count()
    index = positional_index(docs, terms, n_terms)
    lists = index.where(F.col("term") >= 0)
    frequency = lists.groupBy("term").agg(F.count("*").alias("seen"))
    # equal windows are looked up once
    spelled = raw.join(terms, "word").groupBy("item_id", "w", "len").agg(F.sort_array(F.collect_list(F.struct("j", "term"))).alias("x"))
    spelled = spelled.select("item_id", "w", "len", F.sha2(F.concat_ws(",", F.transform("x", lambda s: s.term.cast("string"))), 256).alias("phrase"), "x")
    phrases = spelled.dropDuplicates(["phrase"]).select(F.col("phrase").alias("item_id"), F.lit(0).alias("w"), "len", F.explode("x").alias("s"))
    ranked = stored_copy(_ranked(phrases.select("item_id", "w", "len", F.col("s.j").alias("j"), F.col("s.term").alias("term")), frequency), "ranked")
    n_windows = ranked.count()
    # a window with a term that no document has can't occur
    never = ranked.where("seen = 0").select("item_id").distinct()
    live = ranked.join(never, "item_id", "left_anti")
    seeds = live.where("rank = 1").select("term", F.col("item_id").alias("phrase"), "len", "j")
    places = lists.join(_sized(seeds, n_windows), "term").select(*KEY, "phrase", "len", (F.col("position") - F.col("j")).alias("begin"))
    places = stored_copy(places.where("begin >= 0"), "places")

    def kept(found: DataFrame, ranks: Column, others: DataFrame) -> DataFrame:
        """The places at whose offsets all terms of these ranks stand."""
        terms_ = live.where(ranks).select(F.col("item_id").alias("phrase"), "term", "j")
        asked = found.join(_sized(terms_, n_windows), "phrase").select(*KEY, "phrase", "len", "begin", "term", (F.col("begin") + F.col("j")).alias("position"))
        hits = asked.join(others, [*KEY, "term", "position"]).distinct()
        return hits.groupBy(*KEY, "phrase", "len", "begin").agg(F.count("*").alias("n"))

    # the second list leaves few places; the others are read for the documents of these alone
    second = live.where("rank = 2").select("term").distinct()
    twice = stored_copy(kept(places.where("len > 1"), F.col("rank") == 2, lists.join(_sized(second, n_windows), "term", "left_semi")).drop("n"), "twice")
    some = twice.where("len > 2").select(*KEY).distinct()
    rest = lists.join(_sized(some, some.count()), KEY, "left_semi")
    full = kept(twice.where("len > 2"), F.col("rank") > 2, rest).where(F.col("n") == F.col("len") - 2).drop("n")
    whole = full.unionByName(twice.where("len = 2")).unionByName(places.where("len = 1").distinct())
    return index, whole.join(spelled.select("item_id", "w", "phrase"), "phrase")


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """Per row of ``docs``: doc_id, version, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it is inside any occurrence of a window. Null texts have no words. Rows
    of one doc_id are told apart by a hash of their text (version); equal rows give equal
    results, once each; rows without an id are looked at like all others. A null item_id is left out.
    """
    index, found = phrase_matches(docs, items, width)
    found = stored_copy(found, "matches")
    spans = found.select(*KEY, "begin", "len").distinct()
    hit = spans.select(*KEY, F.explode(F.sequence("begin", F.col("begin") + F.col("len") - 1)).alias("at")).distinct().groupBy(*KEY).agg(
        F.count("*").alias("n_hit")
    )
    names = found.select(*KEY, F.col("item_id").cast("string").alias("item")).distinct().groupBy(*KEY).agg(
        F.count("*").alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256")
    )
    some = hit.join(names, KEY).select(*KEY, "n_hit", "n_items", "items_sha256")
    lengths = index.where(F.col("term") == LENGTH).select(*KEY, F.col("position").cast("long").alias("n_words"))
    none = F.sha2(F.lit(""), 256)
    return lengths.join(some, KEY, "left").select(
        own_id(), "version", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def proximity_matches(docs: DataFrame, items: DataFrame, span: int) -> DataFrame:
    """(doc_id, version, item_id, first, last): where all terms of an item lie within ``span`` words.

    Of each place the least windows are given, those that hold no smaller one. Around each posting
    of the item's rarest term every posting of its terms is tried as the start of a window, which
    ends where the last of the terms first stands. Items whose terms repeat need each term once.
    """
    words = windows(items, 1 << 30).select("item_id", "word").distinct()
    terms = stored_copy(words.select("word").distinct().withColumn("term", F.row_number().over(Window.orderBy("word"))), "terms")
    n_terms = terms.count()
    index = positional_index(docs, terms, n_terms).where(F.col("term") >= 0)
    wanted = words.join(terms, "word").join(index.groupBy("term").agg(F.count("*").alias("seen")), "term", "left")
    order = Window.partitionBy("item_id").orderBy(F.coalesce("seen", F.lit(0)), "term")
    ranked = stored_copy(wanted.withColumn("rank", F.row_number().over(order)).withColumn("many", F.count("*").over(Window.partitionBy("item_id"))), "ranked")
    seeds = ranked.where("rank = 1").select("term", "item_id", "many")
    places = index.join(seeds, "term").select(*KEY, "item_id", "many", F.col("position").alias("at"))
    asked = places.join(ranked.select("item_id", "term"), "item_id")
    other = index.withColumnRenamed("position", "p")
    near = asked.join(other, [*KEY, "term"]).where(F.abs(F.col("p") - F.col("at")) < span).distinct()
    seed = [*KEY, "item_id", "many", "at"]
    starts = near.where("p <= at").select(*seed, F.col("p").alias("first"))
    inside = starts.join(near, seed).where((F.col("p") >= F.col("first")) & (F.col("p") - F.col("first") < span))
    ends = inside.groupBy(*seed, "first", "term").agg(F.min("p").alias("p")).groupBy(*seed, "first").agg(F.count("*").alias("n"), F.max("p").alias("last"))
    return ends.where("n = many").groupBy(*KEY, "item_id", "last").agg(F.max("first").alias("first")).select(own_id(), "version", "item_id", "first", "last")


def keep_clean(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no window of the test set occurs, with all their columns."""
    _, found = phrase_matches(docs, items, width)
    hit = found.select(own_id().alias("_id"), F.col("version").alias("_version")).distinct()
    version = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_id"]) & (version == hit["_version"]), "left_anti")
