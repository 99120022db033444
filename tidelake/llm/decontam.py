"""Benchmark decontamination: short test items found inside long documents.

Words are runs other than ``[\\x20\\x09-\\x0D]``, with A-Z lower-cased; a set holds the
distinct five-word shingles, or the whole sequence if there are fewer words. An item is
found where at least 0.8 of its shingles are in a document.

The search is size-partitioned: an item of i shingles has to share o = ceil(0.8 i) of
them, so that its partition, given by i, keeps the i - o + 1 smallest hashes of the set
as MinHash sketch: a document without any of them misses too many. A sketch is
compared only with documents of at least o shingles. Unlike bands of a signature of the
whole document, whose minima seldom come from a short passage, this loses nothing.
Candidates are then counted over the shingles themselves.

Null and empty texts have no shingles and match nothing. Rows of one key are looked at
one by one, the best counts; repeated rows change nothing. Empty tables give no rows.
Other columns are left out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.tables import ROW, keyed, row_hash, written

SHINGLE_WORDS = 5
CONTAINMENT_PERCENT = 80


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lowered, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def _windows(items: Column, whole: Column, window) -> Column:
    """One value for each five words, the whole for fewer, nothing for none."""
    starts = F.sequence(F.lit(0), F.size(items) - SHINGLE_WORDS)
    return (
        F.when(F.size(items) >= SHINGLE_WORDS, F.transform(starts, window))
        .when(F.size(items) > 0, F.array(whole))
        .otherwise(F.array().cast("array<string>"))
    )


def with_shingles(df: DataFrame) -> DataFrame:
    """``df`` with the distinct ``shingles`` of its ``text`` as texts."""
    with_words = df.withColumn("words", words(F.col("text")))
    w = F.col("words")
    found = _windows(w, F.array_join(w, " "), lambda i: F.array_join(F.slice(w, i + 1, SHINGLE_WORDS), " "))
    return with_words.withColumn("shingles", F.array_distinct(found)).drop("words")


def with_hashes(df: DataFrame) -> DataFrame:
    """``df`` with ``hashes``, a hash of each shingle of its ``text``, repeats included."""
    with_words = df.withColumn("word_hashes", F.transform(words(F.col("text")), lambda word: F.xxhash64(word)))
    h = F.col("word_hashes")
    starts = F.sequence(F.lit(0), F.size(h) - SHINGLE_WORDS)
    found = (
        F.when(
            F.size(h) >= SHINGLE_WORDS,
            F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(SHINGLE_WORDS)))),
        )
        # Fewer words: null stands in for the missing ones, which xxhash64 skips.
        .when(F.size(h) > 0, F.array(F.xxhash64(*(F.get(h, F.lit(k)) for k in range(SHINGLE_WORDS)))))
        .otherwise(F.array().cast("array<long>"))
    )
    return with_words.withColumn("hashes", found).drop("word_hashes")


def needed(size: Column) -> Column:
    """ceil(0.8 size) in whole numbers."""
    return F.floor((size * CONTAINMENT_PERCENT + 99) / 100).cast("int")


def sketches(items: DataFrame) -> DataFrame:
    """hash, item_id and needed: the smallest hashes of each item, as many as its size asks for."""
    sized = with_hashes(items).select("item_id", F.array_sort(F.array_distinct("hashes")).alias("hashes"))
    size = F.size("hashes")
    return (
        sized.withColumn("needed", needed(size))
        .filter(size > 0)
        .select("item_id", "needed", F.explode(F.slice("hashes", F.lit(1), size - F.col("needed") + 1)).alias("hash"))
    )


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_shared, containment for each item found."""
    docs = keyed(documents, key, text)
    items = keyed(benchmark, item_key, item_text, ("item_id", "text"))
    # Written, so that the planner knows their sizes and broadcasts only what is small.
    sketch = written(sketches(items), "sketches")
    # The outer form, as the other one adds a filter that would be pushed below and repeat the hashing.
    hashed = with_hashes(docs).select("doc_id", F.size("hashes").alias("n"), F.explode_outer("hashes").alias("hash"))
    candidates = written(
        hashed.join(sketch, (hashed["hash"] == sketch["hash"]) & (hashed["n"] >= sketch["needed"]))
        .select("doc_id", "item_id")
        .distinct(),
        "candidates",
    )
    item_sets = with_shingles(items).select(
        F.col("item_id").alias("of_item"), F.col("shingles").alias("item_shingles")
    )
    # The null key is a key like others.
    # In structs, as null is an id like others.
    wanted = candidates.groupBy(F.col("doc_id").alias("of_doc")).agg(
        F.collect_set(F.struct("item_id")).alias("found_items")
    )
    in_docs = with_shingles(docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["of_doc"])))
    pairs = in_docs.select("doc_id", "shingles", F.explode_outer("found_items").alias("found")).join(
        item_sets, F.col("found.item_id").eqNullSafe(F.col("of_item"))
    )
    shared = F.size(F.array_intersect("shingles", "item_shingles"))
    counted = pairs.select("doc_id", F.col("of_item").alias("item_id"), F.size("item_shingles").alias("n_shingles"), shared.alias("n_shared"))
    return (
        counted.filter(F.col("n_shared") >= needed(F.col("n_shingles")))
        .groupBy("doc_id", "item_id", "n_shingles")
        .agg(F.max("n_shared").alias("n_shared"))
        .select(
            "doc_id",
            "item_id",
            F.col("n_shingles").cast("long").alias("n_shingles"),
            F.col("n_shared").cast("long").alias("n_shared"),
            (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
        )
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with all their columns.

    Decides by row, as ids may be null or repeat.
    """
    rows = documents.withColumn(ROW, row_hash("doc_id", "text"))
    found = contaminated(rows, benchmark, key=ROW).select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(found, ROW, "left_anti").select(documents.columns)
