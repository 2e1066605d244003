"""Benchmark decontamination over a distributed positional inverted index.

Words are lower-cased (A to Z) runs of digits, letters and non-ASCII characters. A window is
13 consecutive words of a benchmark item; an item of fewer, but some, is one window.

1. The document frequency of every benchmark word is counted over all documents.
2. For each window the two rarest words are its probe; the words that probe any window of
   an item, with their positions in it, are the item's posting keys.
3. Documents are exploded into postings (word, document, position), kept only for posting keys.
   A posting at position p of a key at position q of an item lies on the diagonal p - q;
   postings of one (document, item, diagonal) meet, which intersects the lists at their
   offsets. A diagonal stays when it holds both probe words of some window.
4. Only on those diagonals the words of the document and of the item are compared: 13 equal
   words in a row are a phrase match.

A proximity match (``near_matches``) is a window of which 10 words or more stand in the document at
offsets that differ by at most ``SLOP`` from one diagonal, so that words may be altered, inserted or left out.
Its probe are the 5 rarest words of the window: at most 3 are wrong, so 2 of them agree. A posting
counts for every diagonal within ``SLOP`` of its own, a diagonal stays when it holds 2 probe words of some
window, and there all windows are compared. No match is lost.

Everything is DataFrame expressions. Keys of the joins are words or documents; a word held
by a third of all documents is only a posting key where a window has nothing rarer. The
posting keys are broadcast up to ``BROADCAST_ROWS`` rows; beyond, the join shuffles and
adaptive execution splits what is skewed.

Defined cases: a null text has no words and an item without words no window; an item with a
null id marks words but is not counted or listed; repeated items count once, repeated
document rows get a result each; an empty benchmark finds nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import boxed, small_side, unboxed

WINDOW = 13
#: Equal words that make a proximity match in a full window; shorter items need three quarters.
NEAR_WORDS = 10
#: Rarest words of a window that probe for a proximity match, and how many of them must agree.
NEAR_PROBES, NEAR_AGREE = 5, 2
#: Offset by which a word of a proximity match may stand off its diagonal.
SLOP = 1
BROADCAST_ROWS = 1_000_000
#: A document is contaminated when this many times its hit words reach its words.
CONTAMINATED_RATIO = 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, _words); equal (doc_id, text) share a key."""
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_key"), words(F.col("text")).alias("_words"))


def _items(benchmark: DataFrame) -> DataFrame:
    """Distinct items with words: _item (key), item_id (string), _item_words, _window."""
    split = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("_item_words"))
    return (
        split.filter(F.size("_item_words") > 0)
        .distinct()
        .withColumn("_item", F.md5(F.to_json(F.struct("item_id", "_item_words"))))
        .withColumn("_window", F.least(F.lit(WINDOW), F.size("_item_words")))
    )


def probes(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Items with ``_pairs``: for each window the positions of its two rarest words; and ``_rarest``:
    for each window those of its ``NEAR_PROBES`` rarest."""
    items = _items(benchmark)
    placed = items.select("_item", F.posexplode("_item_words").alias("_q", "_word"))
    vocabulary = placed.select("_word").distinct().persist()
    try:
        counted = (
            docs.select(F.explode(F.array_distinct(words(F.col("text")))).alias("_word"))
            .join(small_side(vocabulary, vocabulary.count(), BROADCAST_ROWS), "_word", "left_semi")
            .groupBy("_word")
            .agg(F.count(F.lit(1)).alias("_df"))
        )
        ranked = (
            placed.join(counted, "_word", "left")
            .groupBy("_item")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_q"), F.coalesce("_df", F.lit(0)).alias("_df")))).alias("_ranked"))
        )
        ranked = materialize(ranked, "probe-words")
    finally:
        vocabulary.unpersist()
    first = F.sequence(F.lit(0), F.size("_item_words") - F.col("_window"))

    def rarest(s: Column) -> Column:
        own = F.slice("_ranked", s + 1, F.col("_window"))
        by_df = F.array_sort(F.transform(own, lambda r: F.struct(r["_df"].alias("df"), r["_q"].alias("q"))))
        return F.transform(F.slice(by_df, 1, NEAR_PROBES), lambda r: r["q"])

    pair = lambda p: F.struct(p[0].alias("a"), F.coalesce(F.get(p, F.lit(1)), p[0]).alias("b"))
    return (
        items.join(ranked, "_item")
        .withColumn("_rarest", F.array_distinct(F.transform(first, rarest)))
        .withColumn("_pairs", F.array_distinct(F.transform("_rarest", pair)))
        .drop("_ranked")
    )


def candidate_diagonals(docs: DataFrame, probed: DataFrame, n_keys: int) -> DataFrame:
    """(doc_id, _key, _item, _diagonal) where both probe words of some window agree."""
    keys = probed.select(
        "_item",
        "_item_words",
        F.explode(F.array_distinct(F.flatten(F.transform("_pairs", lambda p: F.array(p["a"], p["b"]))))).alias("_q"),
    ).select("_item", "_q", F.get("_item_words", F.col("_q")).alias("_word"))
    postings = docs.select("doc_id", "_key", F.posexplode("_words").alias("_p", "_word"))
    met = (
        postings.join(small_side(keys, n_keys, BROADCAST_ROWS), "_word")
        .groupBy("doc_id", "_key", "_item", (F.col("_p") - F.col("_q")).alias("_diagonal"))
        .agg(F.collect_set("_q").alias("_at"))
    )
    both = F.exists("_pairs", lambda p: F.array_contains("_at", p["a"]) & F.array_contains("_at", p["b"]))
    return (
        met.join(small_side(probed.select("_item", "item_id", "_item_words", "_window", "_pairs"), n_keys, BROADCAST_ROWS), "_item")
        .filter(both)
        .select("doc_id", "_key", "_item", "item_id", "_item_words", "_window", "_diagonal")
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and items
    (sorted array of item ids) by phrase matches."""
    probed = materialize(probes(docs, benchmark), "probes")
    n_keys = probed.agg(F.sum(F.size("_item_words"))).first()[0] or 0
    keyed = _keyed(docs)
    found = (
        candidate_diagonals(keyed, probed, n_keys)
        .groupBy("doc_id", "_key")
        .agg(F.collect_list(F.struct("item_id", "_item_words", "_window", "_diagonal")).alias("_candidates"))
        .withColumnRenamed("doc_id", "_doc")
        .withColumnRenamed("_key", "_found_key")
    )
    joined = keyed.join(found, (F.col("_key") == F.col("_found_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    n_words = F.size("_words")

    def compare(c: Column) -> Column:
        item, diagonal = c["_item_words"], c["_diagonal"]
        first = F.greatest(F.lit(0), -diagonal)
        length = F.greatest(F.lit(0), F.least(F.size(item), n_words - diagonal) - first)
        equal = F.zip_with(
            F.slice("_words", diagonal + first + 1, length), F.slice(item, first + 1, length), lambda a, b: a == b
        )
        return F.struct(
            c["item_id"].alias("item_id"), c["_window"].alias("w"), (diagonal + first).alias("at"), equal.alias("equal")
        )

    def agreement(c: Column) -> Column:
        starts = F.when(F.size(c["equal"]) >= c["w"], F.sequence(F.lit(0), F.size(c["equal"]) - c["w"])).otherwise(
            F.array().cast("array<int>")
        )
        agreed = F.transform(starts, lambda s: F.size(F.filter(F.slice(c["equal"], s + 1, c["w"]), lambda e: e)))
        hits = F.filter(F.arrays_zip(starts.alias("s"), agreed.alias("n")), lambda x: x["n"] == c["w"])
        return F.struct(
            c["item_id"].alias("item_id"),
            F.flatten(F.transform(hits, lambda x: F.sequence(c["at"] + x["s"], c["at"] + x["s"] + c["w"] - 1))).alias("hit"),
        )

    checked = F.transform(F.transform("_candidates", compare), agreement)
    ids = lambda keep: F.array_sort(F.array_distinct(F.filter(F.transform(F.filter("_checked", keep), lambda c: c["item_id"]), F.isnotnull)))
    empty = F.array().cast("array<string>")
    out = joined.select(
        "doc_id",
        n_words.cast("long").alias("n_words"),
        F.coalesce(checked, F.array().cast("array<struct<item_id:string,hit:array<int>>>")).alias("_checked"),
    ).select(
        "doc_id",
        "n_words",
        F.size(F.array_distinct(F.flatten(F.transform("_checked", lambda c: c["hit"])))).cast("long").alias("n_hit"),
        F.coalesce(ids(lambda c: F.size(c["hit"]) > 0), empty).alias("items"),
    )
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (CONTAMINATED_RATIO * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "items",
    )


def near_diagonals(docs: DataFrame, probed: DataFrame, n_keys: int) -> DataFrame:
    """(doc_id, _key, item_id, _item_words, _window, _diagonal) where enough probe words of some window agree within ``SLOP``."""
    least = F.least(F.lit(NEAR_AGREE), F.col("_window")).alias("_least")
    keys = probed.select("_item", "_item_words", least, F.explode(F.array_distinct(F.flatten("_rarest"))).alias("_q")).select(
        "_item", "_q", "_least", F.get("_item_words", F.col("_q")).alias("_word")
    )
    postings = docs.select("doc_id", "_key", F.posexplode("_words").alias("_p", "_word"))
    diagonal = F.col("_p") - F.col("_q")
    met = (
        postings.join(small_side(keys, n_keys, BROADCAST_ROWS), "_word")
        .select("doc_id", "_key", "_item", "_q", "_least", F.explode(F.sequence(diagonal - SLOP, diagonal + SLOP)).alias("_diagonal"))
        .groupBy("doc_id", "_key", "_item", "_least", "_diagonal")
        .agg(F.collect_set("_q").alias("_at"))
        .filter(F.size("_at") >= F.col("_least"))
    )
    enough = F.exists("_rarest", lambda r: F.size(F.array_intersect(r, "_at")) >= F.least(F.lit(NEAR_AGREE), F.size(r)))
    return (
        met.join(small_side(probed.select("_item", "item_id", "_item_words", "_window", "_rarest"), n_keys, BROADCAST_ROWS), "_item")
        .filter(enough)
        .select("doc_id", "_key", "item_id", "_item_words", "_window", "_diagonal")
    )


def near_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_near and near_items (sorted array of item ids) by proximity matches."""
    probed = materialize(probes(docs, benchmark), "probes")
    n_keys = probed.agg(F.sum(F.size("_item_words"))).first()[0] or 0
    keyed = _keyed(docs)
    found = (
        near_diagonals(keyed, probed, n_keys)
        .groupBy(F.col("doc_id").alias("_doc"), F.col("_key").alias("_found_key"))
        .agg(F.collect_list(F.struct("item_id", "_item_words", "_window", "_diagonal")).alias("_candidates"))
    )
    joined = keyed.join(found, (F.col("_key") == F.col("_found_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")

    def near(c: Column) -> Column:
        item, w = c["_item_words"], c["_window"]
        stands = lambda x, q: F.exists(
            F.sequence(F.lit(-SLOP), F.lit(SLOP)), lambda d: F.coalesce(F.get("_words", c["_diagonal"] + q + d) == x, F.lit(False))
        )
        agreed = F.transform(item, lambda x, q: stands(x, q).cast("int"))
        starts = F.sequence(F.lit(0), F.size(item) - w)
        count = lambda s: F.aggregate(F.slice(agreed, s + 1, w), F.lit(0), lambda a, x: a + x)
        return F.exists(starts, lambda s: count(s) >= F.ceil(w * F.lit(NEAR_WORDS) / F.lit(WINDOW)))

    ids = F.transform(F.filter("_candidates", lambda c: c["item_id"].isNotNull() & near(c)), lambda c: c["item_id"])
    items = F.coalesce(F.array_sort(F.array_distinct(ids)), F.array().cast("array<string>"))
    return joined.select("doc_id", items.alias("near_items")).select("doc_id", F.size("near_items").cast("long").alias("n_near"), "near_items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns as they came."""
    bad = contamination(docs, benchmark).filter("contaminated").select("doc_id").distinct()
    known = bad.withColumnRenamed("doc_id", "_bad")
    return unboxed(boxed(docs, "doc_id").join(known, F.col("doc_id").eqNullSafe(F.col("_bad")), "left_anti"))
