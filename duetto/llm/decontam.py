"""Benchmark passages in documents, by a prefix-filtered set join.

A window is a run of an item's words.  As a set it consists of its word shingles,
and a document contains the window only if it has every one of them; so one
shingle of a window, its rarest over all documents, is the whole necessary prefix
of the join.

One pass over the documents keeps the places of all shingles that any window has,
with the few words around each.  Their counts order the shingles by rarity.  Only
the places of the rarest shingle of a window become candidates; a candidate's start
and length must fit into the document, and its words must equal the window's.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duetto.llm.common import cut, repeated

WINDOW = 10             # words of a window; a shorter item is one window
SHINGLE = 5             # words of a shingle; a shorter window is one shingle
#: So many distinct shingles of windows, of 8 bytes each, are broadcast; beyond it
#: places and shingles meet by a shuffle.
MAX_BROADCAST = 1_000_000

#: The key of a row itself, which is no place of a shingle.
_ROW = 0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(low, _NOT_WORD, -1), "")


def _key(words: str, at: Column, k: int) -> Column:
    """The hash of the ``k`` words from place ``at``."""
    return F.xxhash64(*[F.get(F.col(words), at + j) for j in range(k)])


def windows_of(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, window``: the distinct windows of every item with a word."""
    n = F.size("words")
    wide = F.least(F.lit(size), n)
    return (items.select("item_id", words_of(F.col("text")).alias("words")).filter(n > 0)
            .select("item_id", "words", wide.alias("wide"),
                    F.explode(F.sequence(F.lit(0), n - wide)).alias("at"))
            .select("item_id", F.slice("words", F.col("at") + 1, F.col("wide")).alias("window"))
            .distinct())


def shingles_of(windows: DataFrame, widths: list[int], k: int = SHINGLE) -> DataFrame:
    """``window, o, key``: the shingles of every distinct window and their offsets."""
    n = F.size("window")
    wide = F.least(F.lit(k), n)
    each = (windows.select("window").distinct()
            .select("window", wide.alias("wide"), F.explode(F.sequence(F.lit(0), n - wide)).alias("o")))
    key = F.lit(None).cast("bigint")
    for w in widths:
        key = F.when(F.col("wide") == w, _key("window", F.col("o"), w)).otherwise(key)
    return each.select("window", "o", key.alias("key"))


def _around(words: str, p: Column, size: int) -> Column:
    """The words from which any window over place ``p`` can be cut."""
    low = F.greatest(p - (size - 1), F.lit(0))
    return F.slice(words, low + 1, p - low + size)


def shingle_places(docs: DataFrame, keys: DataFrame, widths: list[int], size: int = WINDOW) -> DataFrame:
    """``doc_id, th, n_words, p, key, around``: every place ``p`` of a shingle of
    ``keys(key)``, and one row with a null ``key`` for each row of ``docs``."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words"))
    n, p = F.size("words"), F.col("p")
    # The place after the last word stands for the row itself.
    each = texts.select("*", n.alias("n_words"), F.posexplode(F.array_append("words", "")).alias("p", "w")).drop("w")
    last = p == F.col("n_words")
    found = [F.when(p + w <= F.col("n_words"), _key("words", p, w)) for w in widths]
    own = ["doc_id", "th", F.col("n_words").cast("bigint").alias("n_words"), "p"]
    if keys.count() <= MAX_BROADCAST:
        table = F.broadcast(keys.select("key").unionByName(
            keys.sparkSession.range(1).select(F.lit(_ROW).cast("bigint").alias("key"))))
        kept = None
        for key in found:
            some = each.filter(~last) if kept is not None else each
            some = (some.withColumn("key", F.when(last, F.lit(_ROW).cast("bigint")).otherwise(key))
                    .join(table, "key", "left_semi")
                    .select(*own, F.when(~last, F.col("key")).alias("key"),
                            F.when(~last, _around("words", p, size)).alias("around")))
            kept = some if kept is None else kept.unionByName(some)
        return kept
    slim = each.select(*own, F.explode(F.array(*found)).alias("key")).filter("key is not null")
    met = slim.join(keys, "key", "left_semi")
    own_words = texts.groupBy("doc_id", "th").agg(F.first("words").alias("words"))
    placed = (met.alias("m").join(own_words.alias("t"), F.col("m.doc_id").eqNullSafe(F.col("t.doc_id"))
                                  & (F.col("m.th") == F.col("t.th")))
              .select("m.doc_id", "m.th", "m.n_words", "m.p", "m.key",
                      _around("words", p, size).alias("around")))
    rows = texts.select("doc_id", "th", n.cast("bigint").alias("n_words"), n.alias("p"),
                        F.lit(None).cast("bigint").alias("key"),
                        F.lit(None).cast("array<string>").alias("around"))
    return placed.unionByName(rows)


def window_hits(places: DataFrame, shingles: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, th, start, window``: every place of every window of ``shingles``."""
    rarity = places.filter("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # A window with a shingle that no document has occurs nowhere.
    prefix = (shingles.join(rarity, "key", "left").groupBy("window")
              .agg(F.min(F.struct("n", "key", "o")).alias("first"),
                   F.bool_and(F.col("n").isNotNull()).alias("all"))
              .filter("all").select("window", F.col("first.key").alias("key"), F.col("first.o").alias("o")))
    start, wide = F.col("p") - F.col("o"), F.size("window")
    low = F.greatest(F.col("p") - (size - 1), F.lit(0))
    return (places.join(prefix, "key").filter((start >= 0) & (start + wide <= F.col("n_words")))
            .filter(F.slice("around", F.when(start >= low, start - low + 1).otherwise(1), wide) == F.col("window"))
            .select("doc_id", "th", start.alias("start"), "window").distinct())


def find_leaks(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row
    of ``docs`` (``doc_id, text``); ``items`` has ``item_id, text``; further columns
    of either are ignored.

    A word is hit if it stands inside any place of a window.  Items are told by
    their id: texts that share an id are one item; those without an id hit words,
    but are neither counted nor listed.  Null and empty texts have no words; an
    item without words has no window.  Long texts are read whole, at about their
    own size in a task.  Repeated rows are each returned; windows that several items
    share count for each.  Without documents the result is empty, without items
    nothing is hit.
    """
    windows = cut(windows_of(items, size))
    widths = sorted(r["w"] for r in windows.select(
        F.least(F.lit(SHINGLE), F.size("window")).alias("w")).distinct().collect()) or [1]
    shingles = cut(shingles_of(windows, widths))
    places = cut(shingle_places(docs, cut(shingles.select("key").distinct()), widths, size))
    hits = cut(window_hits(places, shingles, size))
    me = ["doc_id", "th"]
    end = F.col("start") + F.col("wide")
    order = Window.partitionBy(*me).orderBy("start")
    before = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (hits.groupBy(*me, "start").agg(F.max(F.size("window")).alias("wide"))
               .select(*me, F.greatest(end - F.greatest("start", before), F.lit(0)).cast("bigint").alias("new"))
               .groupBy(*me).agg(F.sum("new").alias("n_hit")))
    listed = (hits.select(*me, "window").distinct().join(windows, "window")
              .groupBy(*me, "item_id").agg(F.lit(1).alias("one"))
              .groupBy(*me).agg(F.count("item_id").alias("n_items"),
                                F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("ids")))
    # Rows that share id and text are counted, judged once and returned as often.
    rows = places.filter("key is null").groupBy(*me, "n_words").agg(F.count(F.lit(1)).alias("copies"))
    parts = {"n_words": rows, "copies": rows, "n_hit": covered, "n_items": listed, "ids": listed}
    kinds = {"n_words": "bigint", "copies": "bigint", "n_hit": "bigint", "n_items": "bigint", "ids": "array<string>"}
    every = None
    for part in (rows, covered, listed):
        one = part.select(*me, *[F.col(c) if parts[c] is part else F.lit(None).cast(t).alias(c)
                                 for c, t in kinds.items()])
        every = one if every is None else every.unionByName(one)
    out = every.groupBy(*me).agg(*[F.max(c).alias(c) for c in kinds])
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return repeated(out, "copies").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
