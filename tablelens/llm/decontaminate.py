"""Benchmark decontamination by a positional inverted index of the training texts.

The index holds a posting (doc_key, position, term) for each occurrence of a benchmark term; an empty
term after the last word keeps every document's length.  A benchmark window is found by its
rarest terms: the posting lists of its two rarest words, each moved back by the word's offset in the
window, are intersected first, and only the starts that both name are looked up for the other
words.  Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablelens.llm.common import text_key, texts
from tablelens.llm.urls import LOWER, UPPER
from tablelens.plans.runtime import fits_broadcast, join_sized, written

WINDOW = 10
#: Lists that are intersected before the others, and slots of the fixed-size filter on documents.
FIRST_LISTS = 2
SLOTS = 1 << 17
NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_az(text: str | Column) -> Column:
    """A-Z lower-cased and nothing else; plain ASCII takes the faster way."""
    column = F.col(text) if isinstance(text, str) else text
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(F.translate(column, UPPER, LOWER))


def words_of(text: str | Column) -> Column:
    return F.array_remove(F.split(lower_az(text), NOT_WORDS), "")


def windows_of(items: DataFrame, width: int, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, words) and which items hold them (window, item_id)."""
    words = items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), words_of(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (width - 1)))
    cut = words.filter(F.size("words") > 0).select("item_id", "words", F.explode(starts).alias("start"))
    cut = cut.select("item_id", F.slice("words", F.col("start"), F.lit(width)).alias("words"))
    held = written(cut.select("item_id", F.sha2(F.array_join("words", " ").cast("binary"), 256).alias("window"), "words").distinct(), "windows")
    return held.select("window", "words").distinct(), held.select("window", "item_id").distinct()


#: What tells documents apart in joins: a null id is none of the others.
OWNER = ["id", "no_id", "key"]


def owned(rows: DataFrame) -> DataFrame:
    return rows.withColumn("id", F.coalesce("doc_id", F.lit(0))).withColumn("no_id", F.col("doc_id").isNull())


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, key, position, term) of every occurrence of ``terms``, and a last one with term ''."""
    words = F.concat(words_of("text"), F.array(F.lit("")))
    exploded = docs.select("doc_id", "key", F.posexplode(words).alias("position", "term"))
    wanted = terms.select("term").union(terms.sparkSession.range(1).select(F.lit("").alias("term"))).distinct()
    return join_sized(exploded, wanted, "term", fits_broadcast(wanted)).select("doc_id", "key", "position", "term")


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, doc_id, window, start, width) of each occurrence of a window's exact word sequence."""
    terms = windows.select("window", F.size("words").alias("width"), F.posexplode("words").alias("offset", "term"))
    counts = written(index.filter("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("postings")), "counts")
    counted = terms.join(counts, "term", "left")
    # a window with a word that no document has cannot occur
    whole = counted.groupBy("window").agg(F.count("postings").alias("known"), F.count(F.lit(1)).alias("all")).filter("known = all").select("window")
    ranked = counted.join(whole, "window").withColumn("rank", F.row_number().over(Window.partitionBy("window").orderBy("postings", "offset")))
    ranked = written(ranked, "ranked")

    def starts(of: DataFrame) -> Column:
        return (F.col("position") - F.col("offset")).alias("start")

    rare = ranked.filter(F.col("rank") <= FIRST_LISTS).select("window", "width", "offset", "term", "rank")
    found = join_sized(index, rare, "term", fits_broadcast(rare)).select("doc_id", "key", "window", "width", "rank", starts(index)).filter("start >= 0")
    # which of the lists name the start, each once: a repeated row has every posting several times
    named = F.bit_count(F.bit_or(F.expr("shiftleft(1, rank - 1)")))
    both = found.groupBy("doc_id", "key", "window", "width", "start").agg(named.alias("hits"))
    candidates = written(both.filter(F.col("hits") >= F.least(F.col("width"), F.lit(FIRST_LISTS))).drop("hits"), "candidates")

    # only documents with candidates are looked at again: at most SLOTS numbers are broadcast
    slot = F.pmod(F.xxhash64("key"), F.lit(SLOTS)).cast("int")
    slots = candidates.select(slot.alias("slot")).distinct()
    near = index.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").drop("slot")
    others = ranked.filter(F.col("rank") > FIRST_LISTS).select("window", "offset", "term")
    asked = join_sized(candidates, others, "window", fits_broadcast(others)).withColumn("position", F.col("start") + F.col("offset"))
    asked = owned(asked).select(*OWNER, "window", "start", "position", "term")
    near = owned(near).select(*OWNER, "position", "term").distinct()
    agreed = asked.join(near, [*OWNER, "position", "term"]).groupBy(*OWNER, "window", "start").agg(F.count(F.lit(1)).alias("more"))
    short = candidates.filter(F.col("width") <= FIRST_LISTS)
    long = owned(candidates.filter(F.col("width") > FIRST_LISTS))
    long = long.join(agreed, [*OWNER, "window", "start"]).filter(F.col("more") >= F.col("width") - FIRST_LISTS)
    columns = ["doc_id", "key", "window", "start", "width"]
    return short.select(*columns).unionByName(long.select(*columns))


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """(doc_id, key, pair, first, second): positions of two terms at most ``within`` words apart.

    ``pairs`` holds (pair, left, right).  Positions are cut into blocks of ``within`` words, so a
    posting only meets those of its own and the next blocks.
    """
    cut = F.floor(F.col("position") / F.lit(within))
    side = index.select("doc_id", "key", "position", "term")
    left = side.join(pairs.select("pair", F.col("left").alias("term")), "term").withColumn("block", F.explode(F.array(cut - 1, cut, cut + 1)))
    right = side.join(pairs.select("pair", F.col("right").alias("term")), "term").withColumn("block", cut)
    left = left.select(F.col("doc_id").alias("id"), "key", "pair", "block", F.col("position").alias("first"))
    right = right.select("doc_id", "key", "pair", "block", F.col("position").alias("second"))
    joined = left.join(right, ["key", "pair", "block"]).filter(F.col("id").eqNullSafe(F.col("doc_id")))
    return joined.filter((F.abs(F.col("first") - F.col("second")) <= within) & (F.col("first") != F.col("second"))).select("doc_id", "key", "pair", "first", "second").distinct()


def build_index(docs: DataFrame, windows: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored postings of the windows' terms."""
    rows = texts(docs, doc_id, text).withColumn("key", text_key())
    return written(postings(rows, windows.select(F.explode("words").alias("term")).distinct()), "postings")


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: doc_id, key, n_words, n_hit, items (sorted array of item ids as strings).

    A window is ``width`` consecutive words of an item (an item of fewer words is one window); n_hit
    counts the document's words inside any occurrence of a window.  Null and empty texts have no
    words, items without words match nothing, repeated rows are answered each, and an empty table on
    either side gives no hits or no rows.
    """
    windows, holders = windows_of(items, width, item_id, item_text)
    index = build_index(docs, windows, doc_id, text)
    lengths = index.filter("term = ''").select("doc_id", "key", F.col("position").cast("long").alias("n_words"))
    matches = owned(written(phrase_matches(index.filter("term <> ''"), windows), "matches"))
    covered = matches.select(*OWNER, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("width") - 1)).alias("position"))
    hits = covered.distinct().groupBy(*OWNER).agg(F.count(F.lit(1)).alias("n_hit"))
    held = join_sized(matches.select(*OWNER, "window").distinct(), holders, "window", fits_broadcast(holders))
    # as many ids as the benchmark has items, at most
    named = held.select(*OWNER, "item_id").distinct().groupBy(*OWNER).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    found = hits.join(named, OWNER)
    return owned(lengths).join(found, OWNER, "left").select(
        "doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_benchmark(docs: DataFrame, items: DataFrame, width: int = WINDOW, doc_id: str = "doc_id", text: str = "text", **names: str) -> DataFrame:
    """The documents that hold no window of the benchmark, columns as they came."""
    found = contamination(docs, items, width, doc_id, text, **names).filter("n_hit > 0")
    lost = found.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    keyed = docs.withColumn("__text", text_key(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__key"))
    return keyed.join(lost, same, "left_anti").drop("__text")
