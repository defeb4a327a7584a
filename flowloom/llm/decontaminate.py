"""Benchmark decontamination by item-sized windows: shingle places, exact verification, SimHash distance.

A window is a run of words of a document as long as a benchmark item, or the whole of a
shorter document. Its similarity is the weighted Jaccard similarity of the word shingles
(weight: how often a shingle stands there). A window of similarity s shares at least
2s / (1 + s) of as many shingles as it and the item have on average, so only documents with
so many places of an item's shingles are looked at, and there every window that can be the
first most similar one (`best_window`), wherever the shared shingles stand in the item. The
window found and the item are fingerprinted: a 64-bit SimHash over the words, whose distance
is given and rules nothing out. `within_radius` searches fingerprints where shingles are not at hand.

Words are lower-cased runs of letters and digits, shingles have `k` of them; a text
of fewer words is one shingle, so a short item is found only as a whole document.
DataFrame operations only. Texts are never shuffled unless the table of passing documents
is over Spark's broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.session import settle

LANE = 0x0001000100010001  # four counters of 16 bits


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles_of(words: Column, k: int = 5) -> Column:
    """Hash of every k words in a row; of all words where there are fewer; none of no words."""
    def hashed(ws: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(ws) - k, F.lit(0)))
        return F.transform(places, lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(k)]))

    # bound as a variable of its own, the words of a text are split once and not once a place
    once = F.transform(F.filter(F.array(words), lambda ws: F.size(ws) > 0), hashed)
    return F.coalesce(F.get(once, F.lit(0)), F.array().cast("array<bigint>"))


def with_simhash(rows: DataFrame, key: list[str], words: str = "words") -> DataFrame:
    """(key..., n_words, fingerprint): bit b is set where most words of the row have bit b in their hash."""
    each = rows.select(*key, F.size(words).alias("n_words"), F.explode(words).alias("w")).withColumn("h", F.xxhash64("w"))
    lanes = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(LANE))).alias(f"lane{j}") for j in range(16)]
    counted = each.groupBy(*key, "n_words").agg(*lanes)
    bits = None
    for j in range(16):
        for lane in range(4):
            often = F.shiftrightunsigned(F.col(f"lane{j}"), 16 * lane).bitwiseAND(F.lit(0xFFFF)) * 2 > F.col("n_words")
            bit = F.when(often, F.shiftleft(F.lit(1).cast("long"), 16 * lane + j)).otherwise(F.lit(0).cast("long"))
            bits = bit if bits is None else bits.bitwiseOR(bit)
    return counted.select(*key, "n_words", bits.alias("fingerprint"))


def hamming_blocks(fingerprint: Column, radius: int) -> Column:
    """Array of (block, bits): radius + 1 blocks, as even as can be."""
    edges = [round(64 * b / (radius + 1)) for b in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fingerprint, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits"))
        for b, (lo, hi) in enumerate(zip(edges, edges[1:]))])


def within_radius(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """All pairs (key, start, item, n_words, distance) of equal length whose fingerprints differ in at most `radius` bits."""
    def cut(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("at", F.explode(hamming_blocks(F.col(name), radius))).select("*", "at.block", "at.bits").drop("at")

    pairs = cut(windows, "fingerprint").join(cut(items.withColumnRenamed("fingerprint", "print"), "print"), ["n_words", "block", "bits"])
    apart = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("print"))).alias("distance")
    return pairs.select("key", "start", "item", "n_words", apart).filter(F.col("distance") <= radius).distinct()


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", similarity: float = 0.8, k: int = 5) -> DataFrame:
    """One row per document id and item it holds: doc_id, item_id, start, n_words, distance, similarity.

    start counts words from 0; of several windows the most similar one is given, the first of
    these. A document shorter than an item is one window. Null or empty texts and items hold
    nothing and are held by nothing; repeated rows give one row; a null id is a row's id like
    any other; an empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col)).alias("key"))
    items = settle(benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text_col)).alias("words")).distinct()
                   .filter(F.size("words") > 0).withColumn("item_key", F.xxhash64("item", "words"))
                   .withColumn("shingles", shingles_of(F.col("words"), k)), "leak-items")
    of_items = (items.select("item_key", F.size("shingles").alias("wanted"), F.size("words").alias("n_words"), F.explode("shingles").alias("shingle"))
                .groupBy("item_key", "wanted", "n_words", "shingle").agg(F.count("*").cast("int").alias("times")))
    # where a document holds shingles of an item; `before` is the same shingle's place `times` earlier
    held = rows.select("key", shingles_of(words_of(F.col("text")), k).alias("all")).withColumn("held", F.size("all"))
    met = (held.select("key", "held", F.posexplode("all").alias("at", "shingle")).join(settle(of_items, "leak-shingles"), "shingle")
           .groupBy("key", "held", "item_key", "wanted", "n_words", "times", "shingle").agg(F.array_sort(F.collect_set("at")).alias("at")))
    marks = F.transform("at", lambda x, i: F.struct(x.alias("at"), F.coalesce(F.get("at", i - F.col("times")), F.lit(-1)).alias("before")))
    pairs = settle(met.groupBy("key", "held", "item_key", "wanted", "n_words").agg(F.array_sort(F.flatten(F.collect_list(marks))).alias("marks"))
                   .withColumn("have", F.least("wanted", "held"))
                   .withColumn("need", F.greatest(F.lit(1), F.ceil(similarity * (F.col("wanted") + F.col("have")) / (1 + similarity) - 1e-9)).cast("int"))
                   .filter(F.size("marks") >= F.col("need")), "leak-pairs")
    like = (pairs.withColumn("best", best_window()).filter(F.col("best").isNotNull())
            .withColumn("similarity", F.col("best.both") / (F.col("wanted") + F.col("have") - F.col("best.both"))).filter(F.col("similarity") >= similarity)
            .select("key", "item_key", "similarity", (-F.col("best.back")).alias("start"), (F.col("n_words") - F.col("wanted") + F.col("have")).alias("n_words")))
    like = settle(like, "leak-windows")
    texts = settle(rows.join(like.select("key").distinct(), "key").groupBy("key").agg(F.first("id").alias("id"), F.first("text").alias("text"))
                   .select("key", "id", words_of(F.col("text")).alias("all")), "leak-texts")
    windows = like.join(texts, "key").select("key", "item_key", F.slice("all", F.col("start") + 1, F.col("n_words")).alias("words"))
    prints = with_simhash(windows, ["key", "item_key"]).drop("n_words")
    item_prints = with_simhash(items, ["item_key"]).select("item_key", F.col("fingerprint").alias("print"))
    apart = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("print"))).alias("distance")
    distances = prints.join(item_prints, "item_key").select("key", "item_key", apart)
    best = like.join(distances, ["key", "item_key"]).withColumn("best", F.struct("start", "n_words", "distance", "similarity"))
    named = best.join(texts.select("key", "id"), "key").join(items.select("item_key", F.col("item").alias("item_id")), "item_key")
    return named.groupBy(F.col("id").alias(id_col), F.col("item_id").alias(item_col)).agg(
        F.max_by("best", F.struct("best.similarity", -F.col("best.start"))).alias("best")).select(id_col, item_col, "best.*")


def best_window() -> Column:
    """(both, -start) of the most similar window of `wanted` shingles, the first of these; null where none holds `need` marks.

    The first best window ends with a mark or starts the document: one place further left
    would else hold as many. A mark counts where fewer than `times` of its shingle stand before it
    in the window, so `both` is the sum over shingles of the smaller of both counts.
    """
    marks, wanted = F.col("marks"), F.col("wanted")

    def ending(mark: Column, i: Column) -> Column:
        start = F.greatest(mark["at"] - wanted + 1, F.lit(0))
        inside = F.slice(marks, F.greatest(i - wanted + 2, F.lit(1)), F.least(wanted, i + 1))
        both = F.size(F.filter(inside, lambda m: (m["at"] >= start) & (m["before"] < start)))
        return F.when(F.get(marks, i - F.col("need") + 1)["at"] >= start, F.struct(both.alias("both"), (-start).alias("back")))

    return F.array_max(F.transform(marks, ending))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how: object) -> DataFrame:
    """The rows of `docs`, with all their columns, whose id holds no benchmark item."""
    leaks = settle(find_leaks(docs, benchmark, id_col=id_col, **how).select(F.col(id_col).alias("leaking_id")).distinct(), "leaks")
    return docs.join(leaks, docs[id_col].eqNullSafe(leaks["leaking_id"]), "left_anti")
