"""Line dedup: a line that several documents have stays only in the last of them.

A line's key is the line without ASCII white space at its ends, A to Z in lower case; it is known by
a 128-bit hash. Keys of all documents are range-partitioned by hash and sorted by (document, largest
first, position): the first document met is the one that keeps the line, and every later occurrence
is dropped once three documents have been seen. What comes back is one compressed bitmap a document,
not text; texts are cut by the bitmap only where they are wanted.

Everything is built-in DataFrame functions. Keys that hold a 1024th of all lines or more (so at most
1024 of them) are not gathered by hash: their documents are counted with partial aggregates and the
small result is broadcast to their occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.sources.scratch import stage

#: Fewest code points of a key, and fewest documents, that make a line a repeated one.
LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3

#: A key is hot if it has at least one in so many of all occurrences (and not just a few thousand).
HOT_SHARE = 1024
HOT_LEAST = 4096

_WHITE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """`doc_id`, `version` (of the text), `position`, `high`, `low` (hash of the key) of all lines whose key is long enough."""
    key = F.translate("bare", _UPPER, _UPPER.lower())
    return (
        docs.where("doc_id is not null and text is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.posexplode(_lines("text")).alias("position", "line"))
        .select("doc_id", "version", "position", F.btrim("line", F.lit(_WHITE)).alias("bare"))
        .where(F.char_length("bare") >= least_length)
        .select("doc_id", "version", "position", F.xxhash64(key).alias("high"), F.xxhash64(F.lit(1), key).alias("low"))
    )


def hot_keys(keys: DataFrame) -> DataFrame:
    """The at most HOT_SHARE keys with that share of all occurrences, found through counts of hash ranges."""
    enough = max(-(-keys.count() // HOT_SHARE), HOT_LEAST)
    wide = F.shiftrightunsigned("high", 48).alias("range")
    ranges = keys.groupBy(wide).count().where(F.col("count") >= enough).select("range")
    within = keys.select("high", "low", wide).join(F.broadcast(ranges), "range", "left_semi")
    return within.groupBy("high", "low").count().where(F.col("count") >= enough).select("high", "low")


def dropped_lines(docs: DataFrame, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """`doc_id`, `version`, `position` of the lines that go."""
    keys = stage(line_keys(docs, least_length), "line-keys")
    hot = F.broadcast(stage(hot_keys(keys), "hot-lines"))

    key = Window.partitionBy("high", "low")
    in_order = (
        keys.join(hot, ["high", "low"], "left_anti")
        .repartitionByRange("high", "low")
        .sortWithinPartitions("high", "low", F.desc("doc_id"), "position")
    )
    met = in_order.withColumn("nth", F.dense_rank().over(key.orderBy(F.desc("doc_id"))))
    cold = met.withColumn("documents", F.max("nth").over(key)).where((F.col("nth") > 1) & (F.col("documents") >= least_documents))

    often = keys.join(hot, ["high", "low"], "left_semi")
    last = (
        often.select("high", "low", "doc_id").distinct().groupBy("high", "low")
        .agg(F.count(F.lit(1)).alias("documents"), F.max("doc_id").alias("last"))
        .where(F.col("documents") >= least_documents)
    )
    hot_ones = often.join(F.broadcast(last), ["high", "low"]).where("doc_id < last")
    return cold.select("doc_id", "version", "position").union(hot_ones.select("doc_id", "version", "position"))


def keep_bitmaps(docs: DataFrame, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """`doc_id`, `version`, `n_dropped`, `bitmap` of the documents that lose lines.

    A bitmap is a list of (`skip`, `keep`): so many words of 64 lines that all stay, then one word whose
    bit i says whether line i of it stays. After the last word all lines stay.

    Rows that repeat a doc_id are one document: it counts once, and all its texts keep their lines if it is the
    last. Rows with a null id count nowhere and lose nothing; null texts have one empty line.
    """
    bit = F.expr("shiftleft(1L, position % 64)")
    words = (
        dropped_lines(docs, least_length, least_documents)
        .repartition("doc_id", "version")
        .groupBy("doc_id", "version", F.floor(F.col("position") / 64).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("gone"))
    )
    whole = words.groupBy("doc_id", "version").agg(
        F.sum(F.bit_count("gone")).alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "gone"))).alias("words")
    )
    before = lambda i: F.when(i > 0, F.get("words", i - 1)["word"]).otherwise(F.lit(-1))
    pairs = F.transform("words", lambda w, i: F.struct((w["word"] - before(i) - 1).alias("skip"), F.bitwise_not(w["gone"]).alias("keep")))
    return whole.select("doc_id", "version", "n_dropped", pairs.alias("bitmap"))


def _kept(text: str, bitmap: str) -> Column:
    """The lines of `text` that the bitmap keeps, joined again."""
    word = lambda w: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(w["keep"], b) == 1)
    flags = F.flatten(F.transform(bitmap, lambda w: F.concat(F.array_repeat(F.lit(True), w["skip"] * 64), word(w))))
    marked = F.arrays_zip(_lines(text).alias("line"), flags.alias("stays"))
    stay = F.filter(marked, lambda x: x["line"].isNotNull() & F.coalesce(x["stays"], F.lit(True)))
    return F.array_join(F.transform(stay, lambda x: x["line"]), "\n")


def cut(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """`document` (the row as it was), `n_lines`, `n_dropped`, `kept` (its text without the dropped lines, null as empty)."""
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"),
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("version"),
    )
    known = rows.where("doc_id is not null").join(bitmaps, ["doc_id", "version"], "left")
    nameless = rows.where("doc_id is null").select("doc_id", "version", "document", "text", F.lit(None).cast("long").alias("n_dropped"), F.lit(None).cast(bitmaps.schema["bitmap"].dataType).alias("bitmap"))
    return known.unionByName(nameless).select(
        "document",
        F.size(_lines("text")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("bitmap").isNull(), F.coalesce("text", F.lit(""))).otherwise(_kept("text", "bitmap")).alias("kept"),
    )


def dedup_digests(docs: DataFrame, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """`doc_id`, `n_lines`, `n_dropped`, `kept_sha256` of every row."""
    own = docs.select("doc_id", "text")
    return cut(own, keep_bitmaps(own, least_length, least_documents)).select(
        "document.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )
