"""Document fingerprints from closed syncmers over words.

A k-mer is five words in a row and its inner substrings are the four pairs of
neighbours. It is an anchor if the smallest pair, by hash, is the first or the last:
that depends on the five words alone, so the same words give the same anchors in any
context, and one of every two k-mers is one. Anchors are matched by position: the
fingerprint lists, in order, a hash of each anchor, the next one and how many words lie
between their places, so that what two texts share are anchors in the same order at the
same distances, wherever they begin. Likenesses are of the fingerprints' lists, whole.
Everything is column expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duolect.llm.common import SPACES, whole
from duolect.session import materialize

WORDS = 5
BETWEEN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit(SPACES)), BETWEEN)


def anchors(text: Column) -> Column:
    """The closed syncmers of a text in order: an array of (place, hash).

    ``place`` counts words from zero. A text of one to four words is one anchor, and so is
    a longer one without a closed syncmer; one without words has none.
    """
    kind = "array<struct<place:int,hash:bigint>>"

    def of_words(words: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))
        return let(pairs, of_pairs)

    def of_pairs(pairs: Column) -> Column:
        def at(i: Column) -> Column:
            first, last = F.get(pairs, i), F.get(pairs, i + 3)
            edge = F.least(first, last) <= F.least(F.get(pairs, i + 1), F.get(pairs, i + 2))
            return F.when(edge, F.struct(i.alias("place"), F.xxhash64(first, F.get(pairs, i + 2), last).alias("hash")))

        return F.array_compact(F.transform(F.sequence(F.lit(0), F.size(pairs) - 4), at)).cast(kind)

    def choose(words: Column) -> Column:
        short = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(words).alias("hash"))).cast(kind)
        return (F.when(F.size(words) >= WORDS, let(of_words(words), lambda found: F.when(F.size(found) > 0, found).otherwise(short)))
                .when(F.get(words, F.lit(0)) != "", short).otherwise(F.array().cast(kind)))

    return let(_words(whole(text)), choose)


def marks(text: Column) -> Column:
    """The distinct hashes of neighbouring anchors and their distance, in order; a lone anchor is one by itself."""
    def linked(found: Column) -> Column:
        def link(at: Column, i: Column) -> Column:
            after = F.get(found, i + 1)
            return F.when(after.isNotNull(), F.xxhash64(at["hash"], after["place"] - at["place"], after["hash"]))

        return F.when(F.size(found) == 1, F.transform(found, lambda x: x["hash"])).otherwise(
            F.array_distinct(F.array_compact(F.transform(found, link))))

    return let(anchors(text), linked)


def as_text(marks: Column) -> Column:
    """Sixteen hex digits for each mark, one after another."""
    return F.array_join(F.transform(marks, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """Share of common marks of two texts' fingerprints: 0 to 1, 1 for two without any."""
    def of_shared(shared: Column) -> Column:
        both = F.size(one) + F.size(other) - shared
        return F.when(both == 0, F.lit(1.0)).otherwise(shared / both)

    return let(F.size(F.array_intersect(one, other)), of_shared).cast("double")


def _keyed(docs: DataFrame) -> DataFrame:
    """The id as a text that is never null, and the text's hash: together a document's key."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("key"),
                       F.xxhash64(whole("text")).alias("text_hash"), whole("text").alias("text"))


def ring(keys: DataFrame) -> DataFrame:
    """Each document's neighbours in order of doc_id, the first following the last.

    Gives doc_id, key, text_hash, n_chars and of both neighbours key and hash, and the
    previous one's n_chars. Keys are dealt out by range; a window looks within a range,
    and one row of each range, no more than there are partitions, ties them together.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_hash")]
    ranges = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    own = F.struct("key", "text_hash", "n_chars")
    ranged = materialize(keys.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "ring-ranges")
    within = Window.partitionBy("part").orderBy(*order)
    ends = ranged.groupBy("part").agg(
        F.min_by(own, F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("low"),
        F.max_by(own, F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "text_hash")).alias("high"))
    across, everything = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tied = ends.select("part", F.coalesce(F.lead("low").over(across), F.first("low").over(everything)).alias("after"),
                       F.coalesce(F.lag("high").over(across), F.last("high").over(everything)).alias("before"))
    rows = ranged.withColumn("next", F.lead(own).over(within)).withColumn("last", F.lag(own).over(within)).join(tied, "part")
    return rows.select("doc_id", "key", "text_hash", "n_chars", F.coalesce("next", "after").alias("next"),
                       F.coalesce("last", "before").alias("last"))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint every document, an edit of it, and compare.

    The edit replaces the last quarter of the code points (rounded down) by as many, or
    all, of the next document's first; documents follow each other by doc_id, a null id
    last, then by a hash of the text, and the first follows the last. Gives doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and
    next_id, the next document's id.

    Null texts count as empty; an empty text has an empty fingerprint, as like to
    another empty one as can be. Rows that repeat both id and text are one document and
    give one row. Other columns are not read, and an empty table gives no rows.
    """
    keyed = _keyed(docs)
    keys = materialize(keyed.select("doc_id", "key", "text_hash", F.length("text").cast("long").alias("n_chars")), "syncmer-keys")
    distinct = keys.distinct()
    around = materialize(ring(distinct).drop("doc_id"), "syncmer-ring")
    if distinct.count() < keys.count():
        keyed = keyed.dropDuplicates(["key", "text_hash"])
    joined = keyed.join(around, ["key", "text_hash"])
    # What a document gives to the one before it. Both sides of the join below read the
    # same columns, so that they share one shuffle of the text.
    given = joined.select(F.col("last.key").alias("key"), F.col("last.text_hash").alias("text_hash"),
                          F.substring("text", F.lit(1), F.floor(F.col("last.n_chars") / 4).cast("int")).alias("head"),
                          marks(F.col("text")).alias("next_marks"), F.col("doc_id").alias("next_id"))
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    rows = joined.join(given, ["key", "text_hash"]).select(
        "doc_id", "n_chars", "next_id", "next_marks", marks(F.col("text")).alias("marks"),
        F.concat(F.substring("text", F.lit(1), kept), "head").alias("edited"))
    rows = rows.withColumns({"edited_marks": marks(F.col("edited")), "edited_sha256": F.sha2("edited", 256)})
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("marks")).alias("fingerprint"),
                       as_text(F.col("edited_marks")).alias("edited_fingerprint"),
                       likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
                       likeness(F.col("marks"), F.col("next_marks")).alias("near_next"), "next_id")
