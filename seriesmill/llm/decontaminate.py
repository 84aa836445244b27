"""Benchmark passages in documents, by a positional inverted index.

The index holds (document, place, term) for every word of the documents that is a benchmark term. A
window is 10 consecutive words of an item, or a whole item that is shorter. Of each window the four rarest
terms by the index are looked up first: where the postings of any two of them, less the terms' offsets in the
item, meet, there is a possible alignment of item and document. As 8 of 10 words miss two at most, none is lost. The other postings of these documents, adjusted by
their offsets, are then intersected with the alignments; runs of 10 consecutive words are phrase matches,
and 8 of 10 words in their places are a proximity match.

All steps are DataFrame operations. The index is written to the shared folder; texts are not shuffled.

Defined cases: a null text has no words, as a document and as an item, and an item without words occurs
nowhere. Rows that repeat both doc_id and text get the same result each. A null item_id counts as an
empty one; items with the same id are one in counts. An empty benchmark leaves every document clean, an
empty table of documents gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seriesmill.llm.common import ascii_lower, documents_only, free_name, small, stored

WINDOW = 10
#: Words of a window in their places that make a proximity match.
NEAR = 8
#: Terms of a window that are looked up: so many that two are left where WINDOW - NEAR are missing.
SEEDS = WINDOW - NEAR + 2
#: What parts words; capitals become small letters afterwards, so they are no separators.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, hash, words): id and hash of the text stand for a document."""
    rows = documents_only(docs, id_column, text).toDF("id", "text")
    return rows.select("id", F.xxhash64("text").alias("hash"), _words(F.col("text")).alias("words"))


def item_words(benchmark: DataFrame, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_hash, n, off, term) for each word of the items."""
    rows = documents_only(benchmark, id_column, text).toDF("item", "text").dropDuplicates()
    rows = rows.select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"),
        F.xxhash64("text").alias("item_hash"),
        _words(F.col("text")).alias("words"),
    )
    return rows.select(
        "item", "item_hash", F.size("words").alias("n"), F.posexplode("words").alias("off", "term")
    ).withColumn("term", ascii_lower(F.col("term")))


def build_index(docs: DataFrame, terms: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (id, hash, pos, term) of the given terms over all documents, stored."""
    rows = _keyed(docs, id_column, text).select("id", "hash", F.posexplode("words").alias("pos", "word"))
    rows = rows.select("id", "hash", "pos", ascii_lower(F.col("word")).alias("term"))
    return stored(rows.join(small(terms), "term", "left_semi").select("id", "hash", "pos", "term"), "postings")


def _rarest(words: DataFrame, index: DataFrame) -> DataFrame:
    """(item, item_hash, seeds) for each window that can occur, if only nearly.

    ``seeds`` are (off, term) of its rarest terms, SEEDS at most.
    """
    times = index.groupBy("term").agg(F.count(F.lit(1)).alias("times"))
    first = F.greatest(F.col("off") - (WINDOW - 1), F.lit(0))
    last = F.least(F.col("off"), F.greatest(F.col("n") - WINDOW, F.lit(0)))
    found = F.when(F.col("times").isNotNull(), F.struct("times", "off", "term"))
    windows = (
        words.join(times, "term", "left")
        .withColumn("start", F.explode(F.sequence(first, last)))
        .groupBy("item", "item_hash", "start")
        .agg(F.array_sort(F.collect_list(found)).alias("found"), F.count(F.lit(1)).alias("size"))
        .where(F.size("found") >= F.when(F.col("size") == WINDOW, NEAR).otherwise(F.col("size")))
    )
    rarest = F.transform(F.slice("found", 1, SEEDS), lambda f: F.struct(f["off"].alias("off"), f["term"].alias("term")))
    return windows.select("item", "item_hash", rarest.alias("seeds")).distinct()


def _alignments(index: DataFrame, rarest: DataFrame) -> DataFrame:
    """Distinct (id, hash, item, item_hash, shift): the item's first word would be at place ``shift``.

    The postings of two of a window's rarest terms, less their offsets, must meet; the one of a window of one word
    is enough.
    """
    seeds = rarest.select("item", "item_hash", F.explode("seeds").alias("s")).select("item", "item_hash", "s.*")
    met = (
        index.join(small(stored(seeds.distinct(), "seeds")), "term")
        .select("id", "hash", "item", "item_hash", (F.col("pos") - F.col("off")).alias("shift"), "off")
        .groupBy("id", "hash", "item", "item_hash", "shift")
        .agg(F.collect_set("off").alias("offs"))
    )
    # an item has as many sets of offsets as windows, at most
    sets = rarest.groupBy("item", "item_hash").agg(
        F.collect_set(F.transform("seeds", lambda p: p["off"])).alias("sets")
    )
    sets = sets.withColumn("single", F.exists("sets", lambda o: F.size(o) == 1))
    # most have met one term only, and need no look at the sets
    possible = (F.size("offs") > 1) | F.col("single")
    enough = F.exists("sets", lambda o: F.size(F.array_intersect("offs", o)) >= F.least(F.size(o), F.lit(2)))
    return (
        met.join(small(stored(sets, "sets")), ["item", "item_hash"])
        .where(possible & enough)
        .select("id", "hash", "item", "item_hash", "shift")
    )


def matches(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id"
) -> DataFrame:
    """(id, hash, item, kind, start, length): where in a document which item's words occur.

    ``kind`` is phrase or proximity; of the latter, start and length span the matching words.
    """
    words = stored(item_words(benchmark, item_column, text), "items")
    terms = stored(words.select("term").distinct(), "terms")
    index = build_index(docs, terms, id_column, text)
    found = stored(_alignments(index, stored(_rarest(words, index), "rarest")), "alignments")
    holders = stored(found.select(F.col("id").alias("i"), F.col("hash").alias("h")).distinct(), "holders")
    held = index.join(
        small(holders), index["id"].eqNullSafe(F.col("i")) & (index["hash"] == F.col("h")), "left_semi"
    ).toDF("i", "h", "pos", "term")
    expected = found.join(small(words), ["item", "item_hash"]).withColumn("place", F.col("shift") + F.col("off"))
    matched = expected.join(
        held,
        expected["id"].eqNullSafe(held["i"])
        & (expected["hash"] == held["h"])
        & (expected["place"] == held["pos"])
        & (expected["term"] == held["term"]),
        "left_semi",
    )
    # an alignment has as many rows as its item has words, at most
    alignment = Window.partitionBy("id", "hash", "item", "item_hash", "shift").orderBy("off")
    ranked = matched.select(
        "id", "hash", "item", "item_hash", "shift", "n", "off",
        (F.col("off") - F.row_number().over(alignment)).alias("run"),
        F.count(F.lit(1)).over(alignment.rangeBetween(0, WINDOW - 1)).alias("ahead"),
        F.max("off").over(alignment.rangeBetween(0, WINDOW - 1)).alias("last"),
    )
    ranked = stored(ranked, "matched")
    runs = (
        ranked.groupBy("id", "hash", "item", "item_hash", "shift", "n", "run")
        .agg(F.count(F.lit(1)).alias("length"), F.min("off").alias("off"))
        .where(F.col("length") >= F.least(F.lit(WINDOW), "n"))
        .select("id", "hash", "item", F.lit("phrase").alias("kind"), (F.col("shift") + F.col("off")).alias("start"), "length")
    )
    near = ranked.where((F.col("ahead") >= NEAR) & (F.col("n") >= WINDOW)).select(
        "id", "hash", "item", F.lit("proximity").alias("kind"), (F.col("shift") + F.col("off")).alias("start"),
        (F.col("last") - F.col("off") + 1).cast("long").alias("length"),
    )
    return runs.union(near)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_column: str = "item_id"
) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items (sorted ids), n_near_items, contaminated."""
    found = stored(matches(docs, benchmark, id_column, text, item_column), "matches")
    phrases = found.where("kind = 'phrase'")
    places = phrases.select("id", "hash", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("pos"))
    hit = places.distinct().groupBy("id", "hash").agg(F.count(F.lit(1)).alias("n_hit"))
    items = found.groupBy("id", "hash").agg(
        F.array_sort(F.collect_set(F.when(F.col("kind") == "phrase", F.col("item")))).alias("items"),
        F.count_distinct("item").alias("n_near_items"),
    )
    result = stored(items.join(hit, [items["id"].eqNullSafe(hit["id"]), items["hash"] == hit["hash"]], "left").select(
        items["id"].alias("i"), items["hash"].alias("h"), "n_hit", "items", "n_near_items"
    ), "hits")
    rows = _keyed(docs, id_column, text).select("id", "hash", F.size("words").cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    return rows.join(small(result), rows["id"].eqNullSafe(F.col("i")) & (rows["hash"] == F.col("h")), "left").select(
        F.col("id").alias(id_column),
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.greatest(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near_items", zero).alias("n_near_items"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any phrase match, in the columns they have."""
    found = matches(docs, benchmark, id_column, text).where("kind = 'phrase'")
    bad = stored(found.select(F.col("id").alias("bad_id"), F.col("hash").alias("bad_hash")).distinct(), "contaminated")
    name = free_name(docs, "text_hash")
    rows = docs.withColumn(name, F.xxhash64(F.col(f"`{text}`")))
    on = rows[id_column].eqNullSafe(bad["bad_id"]) & (rows[name] == bad["bad_hash"])
    return rows.join(small(bad), on, "left_anti").drop(name)
