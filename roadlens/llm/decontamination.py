"""Benchmark passages in documents, by a prefix-filtered set join in DataFrame functions alone.

A benchmark item is cut into windows of 13 words (a shorter item is one window). A window is a set of word shingles,
each with its place. It is contained in a document only if all its shingles are, so one shingle is prefix enough: the
rarest in the corpus. Rarity is counted over all documents, for the shingles of the benchmark; the same pass keeps
where they are. Prefix shingles meet these places; the place of the shingle in the window bounds where the window may
start (not before the document) and end (not behind it), and only what passes is verified, word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.shared import Kept
from roadlens.operators.sizing import broadcast_if_small

WINDOW = 13
SHINGLE = 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words once A-Z are lower case; the second form parts them in texts as they are.
_GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_GAPS_ANY_CASE = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, with only A-Z lower-cased; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _GAPS), "")


def _folded(text: Column) -> Column:
    """The same words, with all letters lower-cased: faster, and equal words stay equal, so it does for candidates."""
    return F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), _GAPS_ANY_CASE), ""), F.lower)


def _shingle(w: Column, i: Column, width: int) -> Column:
    """Hash of ``width`` words from the i-th (from 0)."""
    return F.xxhash64(*[F.get(w, i + k) for k in range(width)])


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; inside a lambda the optimizer may put its expression in each step."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shingles(w: Column, width: int) -> Column:
    """Places and hashes of all shingles of a word array, and the number of words."""

    def of(w: Column) -> Column:
        last = F.size(w) - width
        places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        one = lambda i: F.struct(i.alias("place"), _shingle(w, i, width).alias("shingle"), F.size(w).alias("n_words"))
        return F.transform(places, one)

    return _once(w, of)


def windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window, its words), and which items have them. Items without words have none."""
    w = words(F.col("text"))
    cut = F.when(F.size("w") <= size, F.array(F.col("w"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size("w") - size), lambda i: F.slice("w", i + 1, size))
    )
    rows = benchmark.select("item_id", w.alias("w")).where(F.size("w") > 0).select("item_id", F.explode(cut).alias("w"))
    keyed = rows.select("item_id", "w", F.md5(F.array_join("w", " ")).alias("window"))
    return keyed.groupBy("window").agg(F.first("w").alias("w")), keyed.select("window", "item_id").distinct()


def _hit_words(found: Column) -> Column:
    """Words within windows (start, n): those of each window, by start, that lie behind all before."""
    step = lambda a, x: F.struct(
        F.greatest(a["end"], x["start"] + x["n"]).alias("end"),
        (a["hit"] + F.greatest(F.lit(0), x["start"] + x["n"] - F.greatest(a["end"], x["start"]))).alias("hit"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit"))
    return F.aggregate(F.array_sort(found), zero, step, lambda a: a["hit"].cast("long"))


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``documents``: doc_id, n_words, n_hit, n_items, items (ids as text, sorted) and contaminated.

    Contaminated is n_hit > 0 and 20 * n_hit >= n_words. Null, empty and wordless texts have no words and no hits;
    items that are null or wordless have no windows; repeated items count by their ids, repeated rows give repeated
    results, a null doc_id is judged by its own text; a null item_id hits words but is no item; empty tables give no
    rows or no hits; further columns are not read.
    """
    kept = Kept(documents.sparkSession, "decontamination")
    distinct, items = windows(benchmark.select("item_id", "text"), size)
    distinct, items = kept.keep(distinct, "windows"), kept.keep(items, "items")
    width = F.least(F.size("w"), F.lit(shingle))
    widths = sorted(r[0] for r in distinct.select(width).distinct().collect())  # at most ``shingle`` small numbers
    # rows that are alike have the same key; whatever meets by it is verified on the row's own text
    keyed = documents.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")

    parts, places = [], []
    for k in widths:
        own = distinct.where(width == k).select("window", F.transform("w", F.lower).alias("w"), F.size("w").alias("n"))
        cut = own.select("window", "n", F.inline(_shingles(F.col("w"), k))).drop("n_words")
        parts.append(cut.withColumn("width", F.lit(k)))
        wanted = broadcast_if_small(parts[-1].select("shingle").distinct())
        of_docs = keyed.select("row", F.inline(_shingles(_folded(F.col("text")), k)))
        places.append(of_docs.join(wanted, "shingle").withColumn("width", F.lit(k)))
    if parts:
        seen = kept.keep(_union(places), "places")
        rarity = seen.groupBy("width", "shingle").agg(F.count("*").alias("times"))
        # a shingle that no document has rules out its window
        order = Window.partitionBy("window").orderBy(F.coalesce("times", F.lit(0)), "shingle", "place")
        prefix = (
            _union(parts).join(rarity, ["width", "shingle"], "left")
            .withColumn("rank", F.row_number().over(order))
            .where("rank = 1 and times is not null")
            .select("window", "n", "width", "shingle", F.col("place").alias("offset"))
        )
        start = F.col("place") - F.col("offset")
        met = seen.join(prefix, ["width", "shingle"]).where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
        met = met.select("row", "window", start.alias("start")).join(distinct, "window")
        wanted = met.groupBy("row").agg(F.collect_set(F.struct("start", "window", "w")).alias("candidates"))
    else:
        wanted = keyed.select("row", F.lit(None).cast("array<struct<start:int,window:string,w:array<string>>>").alias("candidates")).limit(0)

    def found(exact: Column) -> Column:
        true = F.filter("candidates", lambda c: F.slice(exact, c["start"] + 1, F.size(c["w"])) == c["w"])
        return F.transform(true, lambda c: F.struct(c["start"].alias("start"), F.size(c["w"]).alias("n"), c["window"].alias("window")))

    hits = F.when(F.col("candidates").isNotNull(), _once(words(F.col("text")), found))
    n_words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), _GAPS_ANY_CASE), ""))
    verified = (
        keyed.join(wanted, "row", "left")
        .select("doc_id", n_words.cast("long").alias("n_words"), F.coalesce(hits, F.array().cast("array<struct<start:int,n:int,window:string>>")).alias("found"))
        .select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "n_words",
            _once(F.col("found"), _hit_words).alias("n_hit"),
            _once(F.col("found"), lambda f: F.array_distinct(f["window"])).alias("windows"),
        )
    )
    verified = kept.keep(verified, "verified")
    kept.drop("places")
    named = (
        verified.select("row", F.explode("windows").alias("window"))
        .join(items.where("item_id is not null"), "window")
        .select("row", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    dirty = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return verified.join(named, "row", "left").select(
        "doc_id", "n_words", "n_hit",
        F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), dirty.alias("contaminated"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
