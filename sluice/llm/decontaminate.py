"""Benchmark decontamination: short test items inside long documents.

Containment search with MinHash sketches.  Items are split by size (their number of
different five-word shingles, in powers of two).  The sketch of an item is the smallest
hashes of its shingles, one more than a document may lack: a document that contains
80 per cent of an item must hold one of them, whatever the document's length, so no find is
lost.  All items of a size class share the sketch length of its largest size.  Documents that
have fewer shingles than the class needs are left out.  Candidates are then verified on the
shingles themselves, word for word.

Words are runs of letters and digits in lower case.  Only DataFrame functions are used.

Defined results: null and empty texts, and items and documents of fewer than five words, match
nothing; items with equal texts are found each; a row repeated with its id gives one find;
rows without an id are found under a null id; an empty table gives no finds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import prepare, staged, text_key

WORDS = 5
CONTAINMENT = 0.8
#: Up to what a side is broadcast: rows of sketches (24 bytes each), candidate ids (8 bytes
#: each), bytes of the items' shingles.
BROADCAST_SKETCHES = 1_000_000
BROADCAST_PAIRS = 1_000_000
BROADCAST_ITEMS = 64 << 20


def words_of(text: Column) -> Column:
    spaced = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_remove(F.coalesce(spaced, F.array().cast("array<string>")), "")


def _windows(words: Column, of, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(words) - (size - 1))
    return F.when(F.size(words) >= size, F.transform(starts, of))


def shingle_hashes(words: Column, size: int = WORDS) -> Column:
    return _windows(words, lambda i: F.xxhash64(*(F.element_at(words, i + k) for k in range(size))), size)


def shingles(words: Column, size: int = WORDS) -> Column:
    return _windows(words, lambda i: F.concat_ws(" ", F.slice(words, i, size)), size)


def needed(n: Column, containment: float) -> Column:
    """How many of ``n`` shingles must be found.  In thousandths, so that no float is rounded up."""
    return F.ceil(n * round(containment * 1000) / F.lit(1000)).cast("long")


def sketches(items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """item_id, size_class, least (shingles a document must have) and each hash of the sketch."""
    n = F.size("hashes").cast("long")
    largest = (F.lit(2) * F.pow(F.lit(2.0), F.col("size_class")) - 1).cast("long")
    smallest = F.pow(F.lit(2.0), F.col("size_class")).cast("long")
    return (
        items.select("item_id", F.array_sort(F.array_distinct(shingle_hashes(F.col("words")))).alias("hashes"))
        .filter(F.size("hashes") > 0)
        .withColumn("size_class", F.floor(F.log2(n)))
        .withColumn("length", F.least(n, largest - needed(largest, containment) + 1).cast("int"))
        .select(
            "item_id",
            "size_class",
            needed(smallest, containment).alias("least"),
            F.explode(F.slice("hashes", F.lit(1), F.col("length"))).alias("hash"),
        )
    )


def _small(df: DataFrame, most: int, size: Column | None = None) -> DataFrame:
    """Broadcast a staged table of ``most`` rows, or sizes of rows, at most; a larger one is shuffled."""
    held = df.agg(F.count("*") if size is None else F.sum(size)).first()[0] or 0
    return F.broadcast(df) if held <= most else df


def contaminated(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """doc_id, item_id, matched, item_shingles, containment for every find.

    Each text without an id is a document of its own; texts of one id are one document.
    """
    own_id = F.col(id_col).cast("long")
    # Only rows without an id need their text to be told apart.
    key = F.struct(own_id.alias("id"), F.when(own_id.isNull(), text_key(F.col(text_col))).alias("text_key"))
    narrow = docs.select(key.alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    found = _finds(spark, narrow, benchmark, item_col, item_text_col, containment)
    return found.withColumn("doc_id", F.col("doc_id.id"))


def _finds(
    spark: SparkSession, narrow: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, containment: float
) -> DataFrame:
    """Finds for doc_id, of any type, and words."""
    prepare(spark)
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"), words_of(F.col(item_text_col)).alias("words")
    )
    whole = items.select("item_id", F.array_distinct(shingles(F.col("words"))).alias("item")).filter(F.size("item") > 0)
    whole = staged(spark, whole, "items")
    sketch = staged(spark, sketches(items, containment), "sketches")
    hashed = narrow.select(
        "doc_id",
        (F.size("words") - (WORDS - 1)).alias("doc_shingles"),
        F.explode(shingle_hashes(F.col("words"))).alias("hash"),
    )
    met = hashed.join(_small(sketch, BROADCAST_SKETCHES), "hash").filter("doc_shingles >= least")
    pairs = staged(spark, met.groupBy("doc_id", "item_id").agg(F.max("size_class").alias("size_class")), "pairs")
    some = pairs.groupBy("doc_id").agg(F.collect_set("item_id").alias("item_ids"))
    some = staged(spark, some.withColumnRenamed("doc_id", "some_id"), "candidates")
    chosen = narrow.join(
        _small(some, BROADCAST_PAIRS, F.size("item_ids")), F.col("doc_id").eqNullSafe(F.col("some_id"))
    ).select("doc_id", F.explode("item_ids").alias("item_id"), shingles(F.col("words")).alias("own"))
    found = chosen.join(_small(whole, BROADCAST_ITEMS, F.octet_length(F.concat_ws(" ", "item"))), "item_id").select(
        "doc_id",
        "item_id",
        F.size(F.array_intersect("item", "own")).cast("long").alias("matched"),
        F.size("item").cast("long").alias("item_shingles"),
    )
    return (
        found.filter(F.col("matched") >= needed(F.col("item_shingles"), containment))
        .groupBy("doc_id", "item_id")
        .agg(F.max("matched").alias("matched"), F.max("item_shingles").alias("item_shingles"))
        .withColumn("containment", F.col("matched") / F.col("item_shingles"))
    )


def drop_contaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose own text has no find, with all their columns, whatever their id."""
    narrow = docs.select(text_key(F.col(text_col)).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    found = _finds(spark, narrow, benchmark, "item_id", "text", CONTAINMENT)
    gone = staged(spark, found.select(F.col("doc_id").alias("gone_key")).distinct(), "contaminated")
    gone = _small(gone, BROADCAST_PAIRS)
    # The row stands in a struct, so that its columns may have any names.
    held = docs.select(text_key(F.col(text_col)).alias("own_key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return held.join(gone, F.col("own_key") == F.col("gone_key"), "left_anti").select("row.*")
