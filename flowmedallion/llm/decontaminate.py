"""Benchmark decontamination: containment search for short test items in long documents.

A test item is contained in a document if at least 0.8 of the item's distinct five-word
shingles occur there.  Items are partitioned by size (powers of two of their number of
shingles).  In a partition every item is sketched by its smallest shingle hashes, as in
MinHash; the sketch is so long that an item of that size cannot lose all the hashes it may
lack: with n shingles at most floor(0.2 n) are missing, so a sketch of k hashes is hit
k - floor(0.2 n) times at least.  Documents meet the sketched hashes alone; a document and an item
that share that many of them are a candidate pair.  Only documents of candidates are read again,
and a pair is verified by the exact count of shared shingles, compared as text.  No pair is
lost, however long the document is.

Words are runs of letters, marks and digits, lower-cased.  With ``short_items``, the one shingle of
an item of one to four words is all of its words, which a document then holds in a row; without, such
items are never found.  Nor are null and empty texts.  Rows of one id and text
count once.  Only DataFrame functions are used.  The items' hashes are broadcast while
their counted number is at most BROADCAST_ROWS; above that the same joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmedallion.llm.components import store

WIDTH = 5
CONTAINED = 0.8
BREAK = r"[^\p{L}\p{M}\p{N}]+"
BROADCAST_ROWS = 300_000


def shingles(words: Column, width: int = WIDTH) -> Column:
    """All runs of ``width`` words, joined by spaces; null for shorter arrays."""
    places = F.sequence(F.lit(1), F.size(words) - (width - 1))
    return F.when(F.size(words) >= width, F.transform(places, lambda i: F.concat_ws(" ", F.slice(words, i, width))))


def words_of(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_words", F.array_remove(F.split(F.lower(F.col(text)), BREAK), ""))


def item_shingles(
    items: DataFrame, item_id: str = "item_id", text: str = "text", contained: float = CONTAINED, short_items: bool = False
) -> DataFrame:
    """One row for each item and distinct shingle: its hash, its rank among the item's hashes, whether it
    belongs to the sketch, the item's size n, the hits needed in the sketch (lead) and overall (need)."""
    texts = words_of(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")), "text")
    all_words = F.when(F.lit(short_items) & (F.size("_words") > 0), F.array(F.array_join("_words", " ")))
    ranked = (
        texts.select("item_id", F.explode(F.coalesce(shingles(F.col("_words")), all_words)).alias("shingle"))
        .distinct()
        .groupBy("item_id")
        .agg(F.array_sort(F.collect_list(F.struct(F.xxhash64("shingle").alias("hash"), "shingle"))).alias("all"))
        .select("item_id", F.size("all").alias("n"), F.posexplode("all"))
    )
    lacking = F.floor(F.col("n") * (1 - contained) + 1e-9)
    upper = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1
    length = F.least(F.col("n").cast("long"), F.floor(upper * (1 - contained) + 1e-9) + 1)
    return ranked.select(
        "item_id", "n", "pos", (F.col("pos") < length).alias("sketched"), (length - lacking).alias("lead"),
        (F.col("n") - lacking).alias("need"), F.col("col.hash").alias("hash"), F.col("col.shingle").alias("shingle"),
    )


def row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def bounded(df: DataFrame) -> DataFrame:
    """The stored frame, to be broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    short_items: bool = False,
) -> DataFrame:
    """``doc_id, key, item_id, n_shingles, n_found, containment`` for every contained item; key is row_key."""
    known, _ = store(item_shingles(items, item_id, item_text, short_items=short_items), "items")
    widths = [WIDTH]
    if short_items:  # at most four more
        sizes = words_of(items.select(F.col(f"`{item_text}`").alias("text")), "text").select(F.size("_words").alias("n"))
        widths += sorted(r.n for r in sizes.filter((F.col("n") > 0) & (F.col("n") < WIDTH)).distinct().collect())
    every = [F.coalesce(shingles(F.col("_words"), width), F.array().cast("array<string>")) for width in widths]
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(f"`{text}`").alias("text"))

    def own_shingles(rows: DataFrame, *more: str) -> DataFrame:
        return words_of(rows, "text").select("doc_id", "key", *more, F.explode(F.concat(*every) if len(every) > 1 else every[0]).alias("own"))

    sketch = known.filter("sketched").select("item_id", "pos", "lead", "hash")
    hits = own_shingles(texts).select("doc_id", "key", F.xxhash64("own").alias("own_hash")).join(
        bounded(sketch), F.col("own_hash") == F.col("hash")
    )
    candidates, _ = store(
        hits.groupBy("doc_id", "key", "item_id", "lead")
        .agg(F.size(F.collect_set("pos")).alias("hits"))
        .filter("hits >= lead")
        .select("doc_id", "key", "item_id"),
        "candidates",
    )
    leaky = candidates.groupBy(F.col("doc_id").alias("own_id"), F.col("key").alias("own_key")).agg(F.collect_set(F.struct("item_id")).alias("items"))
    again = texts.join(leaky, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key")))
    # one row for each id and text; an id in a struct is kept in the set even if it is null
    pairs = own_shingles(again.dropDuplicates(["doc_id", "key"]), "items")
    found = pairs.join(bounded(known.select("item_id", "pos", "n", "need", "shingle")), F.col("own") == F.col("shingle"))
    return (
        found.filter(F.array_contains("items", F.struct("item_id")))
        .groupBy("doc_id", "key", "item_id", "n", "need")
        .agg(F.size(F.collect_set("pos")).alias("found"))
        .filter("found >= need")
        .select(
            "doc_id", "key", "item_id", F.col("n").cast("long").alias("n_shingles"), F.col("found").cast("long").alias("n_found"),
            (F.col("found") / F.col("n")).alias("containment"),
        )
    )


def keep_clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that contain no test item, with the columns they had."""
    leaks = contained_items(docs, items, doc_id, text).select(F.col("doc_id").alias("leak_id"), F.col("key").alias("leak_key")).distinct()
    quoted = [F.col(f"`{c}`") for c in docs.columns]
    packed = docs.select(F.struct(*quoted).alias("row"), F.col(f"`{doc_id}`").alias("own_id"), row_key(doc_id, text).alias("key"))
    same = (F.col("key") == F.col("leak_key")) & F.col("own_id").eqNullSafe(F.col("leak_id"))
    return packed.join(leaks, same, "left_anti").select("row.*")
