"""Shards of equal row counts that keep equal texts together, by balanced label propagation in DataFrame functions.

The graph links documents with equal texts; a group of copies stands for its links, so no pairs are made. Documents
start on shards by hash; a large group fills one shard after the other, and the rest is drawn by the room that is left.
In each round a group's documents want to go where most of it already
is; joins bring the votes to the documents, and a shard takes in only so many as its capacity leaves room for, chosen by
hash, groups as a whole. The last round takes in all that is still on several shards.

A document's shard is its label. Only what the labels are over the exact law moves on, to the shards that lack rows:
documents without links first, then smaller groups as a whole, and of large groups only if nothing else is left. What
moves is a run of each label's order and goes to runs of places, so no more than ``shards`` - 1 smaller groups are split.
Positions come from ranks within a bucket, counts of the buckets within their prefix, and counts of the prefixes, whose
number is fixed; the number of buckets grows with the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.shared import Kept

SHARDS = 8
ROUNDS = 5
SLACK = 0.03
#: Groups with more documents are dealt to several buckets when positions are counted.
HOT = 2000
#: Prefixes are cut into so many buckets that one has about so many documents.
BUCKET_ROWS = 20_000
_PREFIXES = 256
_PREFIX = ("label", "zone", "prefix")
_BUCKET = (*_PREFIX, "sub", "hot", "part")


def _fraction(*columns) -> Column:
    """A repeatable number in [0, 1) of some columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1_000_000)) / F.lit(1_000_000)


def _propagated(linked: DataFrame, loads: dict[int, int], shards: int, rounds: int, slack: float, kept: Kept) -> DataFrame:
    """New labels of the linked documents (row, grp, n, label) after the rounds. ``loads``: other documents per shard."""
    state = linked
    for i in range(rounds):
        votes = state.groupBy("grp", "label").agg(F.count("*").alias("votes"))
        most = votes.groupBy("grp").agg(F.max(F.struct("votes", F.xxhash64("grp", "label"), "label")).alias("most"))
        # kept apart, so that the joins can split the rows of a large group
        wish = kept.keep(most.select("grp", F.col("most.label").alias("wish")), f"wish-{i}")
        if i == rounds - 1:
            # no room was left for these; documents without links make it when the exact law is settled
            whole = kept.keep(state.join(wish, "grp").select("row", "grp", "n", F.col("wish").alias("label")), "whole")
            if i:
                kept.drop(f"round-{i - 1}")
            return whole
        flow = votes.join(wish, "grp").groupBy("label", "wish").agg(F.sum("votes").alias("n")).collect()  # shards^2 rows
        here, out, into = dict(loads), dict.fromkeys(range(shards), 0), dict.fromkeys(range(shards), 0)
        for r in flow:
            here[r["label"]] = here.get(r["label"], 0) + r["n"]
            if r["label"] != r["wish"]:
                out[r["label"]] += r["n"]
                into[r["wish"]] += r["n"]
        if not any(into.values()):
            break
        capacity = sum(here.values()) / shards * (1 + slack)
        # what leaves makes room as well, as far as it is let in elsewhere; eight passes over shards^2 numbers settle it
        share = dict.fromkeys(range(shards), 1.0)
        for _ in range(8):
            left = {s: sum(r["n"] * share[r["wish"]] for r in flow if r["label"] == s != r["wish"]) for s in share}
            share = {s: min(1.0, max(0.0, capacity - here.get(s, 0) + left[s]) / into[s]) if into[s] else 0.0 for s in share}
        quota = F.element_at(F.array(*[F.lit(share[s]) for s in range(shards)]), F.col("wish") + 1)
        draw = _fraction(F.lit(i), "grp")
        moved = state.join(wish, "grp").withColumn("label", F.when(draw < quota, F.col("wish")).otherwise(F.col("label")))
        state = kept.keep(moved.select("row", "grp", "n", "label"), f"round-{i}")
        if i:
            kept.drop(f"round-{i - 1}")
    return state


def _ranked(labelled: DataFrame, total: int, shards: int, kept: Kept) -> tuple[DataFrame, dict[int, int]]:
    """Add ``rank``, the position from 0 in the order (label, zone, prefix, bucket, group), and keep the counts by label."""
    hot = F.coalesce(F.col("n") > HOT, F.lit(False))
    place = F.when(F.col("n").isNotNull(), F.xxhash64("grp")).otherwise(F.xxhash64("row"))
    buckets = max(1, -(-total // (shards * _PREFIXES * BUCKET_ROWS)))
    placed = kept.keep(
        labelled.select(
            "*",
            # what comes first in a label moves first
            F.when(F.col("n").isNull(), 0).when(F.col("large"), 2).otherwise(1).alias("zone"),
            F.pmod(place, F.lit(_PREFIXES)).alias("prefix"),
            F.pmod(F.floor(place / _PREFIXES), F.lit(buckets)).alias("sub"),
            F.when(hot, F.col("grp")).otherwise("").alias("hot"),
            F.when(hot, F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / HOT))).otherwise(F.lit(0)).cast("long").alias("part"),
        ),
        "placed",
    )
    counts = kept.keep(placed.groupBy(*_BUCKET).agg(F.count("*").alias("rows")), "counts")
    earlier = lambda window: F.coalesce(F.sum("rows").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # at most shards * 3 * _PREFIXES rows
    prefixes = counts.groupBy(*_PREFIX).agg(F.sum("rows").alias("rows"))
    prefixes = prefixes.select(*_PREFIX, earlier(Window.orderBy(*_PREFIX)).alias("base"))
    within = earlier(Window.partitionBy(*_PREFIX).orderBy("sub", "hot", "part")).alias("within")
    before = (F.col("base") + F.col("within")).alias("before")
    offsets = kept.keep(counts.select(*_BUCKET, within).join(prefixes, list(_PREFIX)).select(*_BUCKET, before), "offsets")
    inside = F.row_number().over(Window.partitionBy(*_BUCKET).orderBy(F.coalesce("grp", F.lit("")), "row")) - 1
    sizes = counts.groupBy("label").agg(F.sum("rows").alias("rows")).collect()  # shards rows
    ranked = placed.withColumn("inside", inside).join(offsets, list(_BUCKET)).withColumn("rank", F.col("before") + F.col("inside"))
    return ranked, {r["label"]: r["rows"] for r in sizes}


def _settled(sizes: dict[int, int], total: int, shards: int) -> tuple[Column, Column]:
    """Shard and slot by label and rank: what a label has over its even size goes to the shards that lack rows, in order."""
    have = [sizes.get(s, 0) for s in range(shards)]
    fuller = sorted(range(shards), key=lambda s: -have[s])[: total % shards]  # these keep a row more
    even = [total // shards + (s in fuller) for s in range(shards)]
    over, lacks = [max(0, h - e) for h, e in zip(have, even)], [max(0, e - h) for h, e in zip(have, even)]
    at = lambda values: F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("label") + 1)
    place = F.col("rank") - at([sum(have[:s]) for s in range(shards)])
    moves, index = place < at(over), at([sum(over[:s]) for s in range(shards)]) + place
    shard, slot = F.col("label"), place - at(over)
    for s in range(shards):
        begin = sum(lacks[:s])
        here = moves & (index >= begin) & (index < begin + lacks[s])
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, index - begin + have[s]).otherwise(slot)
    return shard.cast("int"), slot.cast("long")


def _first_labels(large: list, total: int, shards: int) -> Column:
    """The shard a document starts on. Large groups lie side by side on a line of even shards; others fill what is left."""
    even, at, draw = total / shards, 0, _fraction(F.lit(0), "row")
    room, label = [even] * shards, None
    for g in large:
        for s in range(int(at / even), min(int((at + g["n"]) / even), shards - 1) + 1):
            until = min(at + g["n"], (s + 1) * even)
            room[s] -= max(0.0, until - max(at, s * even))
            here = (F.col("grp") == g["grp"]) & (draw < (until - at) / g["n"])
            label = F.when(here, s) if label is None else label.when(here, s)
        at += g["n"]
    room = [max(0.0, r) for r in room]
    for s in range(shards - 1):
        here = draw < sum(room[: s + 1]) / (sum(room) or 1)
        label = F.when(here, s) if label is None else label.when(here, s)
    return label.otherwise(shards - 1).cast("int")


def sharded(documents: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """doc_id, size, text_crc32, law (`rows`), shard, slot and grown_shard (null under this law) of every row.

    Row counts of the shards differ by one at most. Null texts have size 1, the checksum of nothing and no links; empty
    texts are equal texts. Rows that repeat a doc_id or a whole row are documents of their own; a null doc_id stays
    null; an empty table gives no rows; further columns are not read.
    """
    kept = Kept(documents.sparkSession, "sharding")
    base = kept.keep(
        documents.select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
            F.md5(F.col("text").cast("binary")).alias("grp"),
        ),
        "documents",
    )
    total = base.count()
    groups = kept.keep(base.where("grp is not null").groupBy("grp").agg(F.count("*").alias("n")).where("n > 1"), "groups")
    # groups that fill a good part of a shard: fewer than 8 * shards
    big = groups.where(F.col("n") > total / shards / 8).orderBy(F.desc("n"), "grp").collect()
    large = F.coalesce(F.col("n") > total / shards / 8, F.lit(False))
    joined = base.select("row", "grp").join(groups, "grp", "left").withColumn("label", _first_labels(big, total, shards))
    joined = kept.keep(joined, "labelled")
    still = joined.where(F.col("n").isNull() | large)
    still = still.select("row", F.when(F.col("n").isNotNull(), F.col("grp")).alias("grp"), "n", "label")
    loads = {r["label"]: r["n"] for r in still.groupBy("label").agg(F.count("*").alias("n")).collect()}  # shards rows
    linked = _propagated(joined.where(F.col("n").isNotNull() & ~large).select("row", "grp", "n", "label"), loads, shards, rounds, slack, kept)
    labelled = linked.withColumn("large", F.lit(False)).unionByName(still.withColumn("large", F.col("n").isNotNull()))
    ranked, sizes = _ranked(labelled, total, shards, kept)
    shard, slot = _settled(sizes, total, shards)
    return (
        ranked.select("row", shard.alias("shard"), slot.alias("slot"))
        .join(base, "row")
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
    )
