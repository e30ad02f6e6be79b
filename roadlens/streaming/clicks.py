"""Ad clicks and active users.

Two queries share the work. The first counts each click record per interval and appends the valid ones to files. The
second reads those files, keeps the running totals, and adds users above the threshold to the blacklist. Totals and
blacklist are tables of one log, and a batch adds to both in one commit: batch k leaves out the users listed before it
and may list new ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadlens.operators import clicks as ops
from roadlens.schema import BLACKLIST, CLICKS
from roadlens.sinks import store
from roadlens.sinks.log import Log, Table
from roadlens.streaming.common import ONCE, per_batch, to_files

COUNTS = T.StructType(
    [T.StructField("window_start", T.TimestampType()), *CLICKS, T.StructField("n", T.LongType())]
)
TOTAL_KEYS = ops.TOTAL_KEYS
TOTALS = T.StructType(
    [
        *(CLICKS[k] for k in TOTAL_KEYS), T.StructField("event_day", T.TimestampType()),
        T.StructField("clicked_count", T.LongType()),
    ]
)


def click_log(spark: SparkSession, path: str) -> Log:
    """Totals by day of the event, and the blacklist."""
    return Log(spark, path, {"totals": Table(TOTALS, (*TOTAL_KEYS, "event_day")), "users": Table(BLACKLIST, ("user_id",))})


def add_to_blacklist(spark: SparkSession, path: str, users: DataFrame) -> None:
    """List users from outside the stream."""
    log = click_log(spark, path)
    log.commit({"users": log.write("users", users.select("user_id").distinct())})


def create_blacklist(spark: SparkSession, path: str, users: DataFrame | None = None) -> None:
    """List the users known from the start; a log that is there stays as it is."""
    if users is not None and click_log(spark, path).last().number < 0:
        add_to_blacklist(spark, path, users)


def blacklist(spark: SparkSession, path: str) -> DataFrame:
    """The listed users as of now."""
    return click_log(spark, path).read("users")


def _listed(batch: DataFrame, blacklist_path: str, reader: str, batch_id: int) -> DataFrame:
    """The users listed when a reader's batch first ran."""
    log = click_log(batch.sparkSession, blacklist_path)
    return log.read("users", log.seen_by(reader, batch_id))


def start_filter(records: DataFrame, blacklist_path: str, path: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Records of users that are not listed. Every batch takes the blacklist as it is then, also if it runs again."""
    store.create(records.sparkSession, path, records.schema)
    store.claim(records.sparkSession, path, checkpoint)

    def keep(batch: DataFrame, batch_id: int) -> None:
        listed = _listed(batch, blacklist_path, path, batch_id)
        store.put(ops.without_blacklisted(batch, listed).select(*batch.columns), path, batch_id)

    return per_batch(records, keep, checkpoint, trigger=trigger)


def start_valid_clicks(
    clicks: DataFrame, path: str, checkpoint: str, batch: str = "10 seconds", max_repeat: int = 1,
    delay: str = "1 minute", trigger: dict = ONCE,
) -> StreamingQuery:
    """Append the click records that were not repeated within their interval."""
    counts = ops.click_counts(clicks.withWatermark("event_ts", delay), batch)
    return to_files(ops.valid_clicks(counts, max_repeat), path, checkpoint, trigger)


def read_valid_clicks(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.readStream.schema(COUNTS).options(**options).parquet(path)


def start_totals(
    valid: DataFrame, path: str, checkpoint: str, threshold: int = 50, trigger: dict = ONCE, delay: str = "1 day"
) -> StreamingQuery:
    """Keep the totals per day, user and ad in a log, and list users above the threshold there.

    The state holds the counts of the days of events that the watermark has not passed; a batch gives out those it
    changed. A click's own day may differ from the day of its event, so a total is the sum over days of events, and the
    log has the others of these. Leaving listed users out after the counting is the same as before it, because every
    count belongs to one user.
    """
    click_log(valid.sparkSession, path).claim(store.run_of(valid.sparkSession, checkpoint))

    def update(batch: DataFrame, batch_id: int) -> None:
        log = click_log(batch.sparkSession, path)
        if log.done(batch_id):  # only the state is behind
            batch.write.format("noop").mode("overwrite").save()
            return
        listed, added = log.read("users"), {}
        added["totals"] = log.write("totals", ops.without_blacklisted(batch, listed))
        changed = log.at("totals", added["totals"])
        low, high = changed.agg(F.min("click_date"), F.max("click_date")).first()
        if low is not None:
            earlier = log.read("totals", where=F.col("click_date").between(low, high))
            earlier = earlier.join(changed, [*TOTAL_KEYS, "event_day"], "left_anti").join(changed, list(TOTAL_KEYS), "left_semi")
            totals = ops.summed(changed.unionByName(earlier))
            added["users"] = log.write("users", ops.new_blacklist(totals, threshold, listed))
        log.commit(added, batch_id)

    rows = ops.day_totals(valid.withWatermark("window_start", delay))
    return per_batch(rows, update, checkpoint, "update", trigger)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    return ops.summed(click_log(spark, path).read("totals"))


def start_active_users(
    records: DataFrame, path: str, checkpoint: str, window: str = "10 seconds", delay: str = "1 minute",
    trigger: dict = ONCE, blacklist_path: str | None = None,
) -> StreamingQuery:
    """Append each user once per interval when the watermark has passed it; operators.clicks.count_users counts them.

    With a blacklist, which is read again for every batch, users listed by then are left out and ``path`` is a store.
    """
    rows = ops.user_windows(records.withWatermark("event_ts", delay), window)
    if blacklist_path is None:
        return to_files(rows, path, checkpoint, trigger)
    store.create(records.sparkSession, path, rows.schema)
    store.claim(records.sparkSession, path, checkpoint)

    def keep(batch: DataFrame, batch_id: int) -> None:
        listed = _listed(batch, blacklist_path, path, batch_id)
        store.put(ops.without_blacklisted(batch, listed).select(*batch.columns), path, batch_id)

    return per_batch(rows, keep, checkpoint, trigger=trigger)


def start_user_sketches(
    records: DataFrame, path: str, checkpoint: str, window: str = "10 seconds", delay: str = "1 minute",
    trigger: dict = ONCE, blacklist: DataFrame | None = None,
) -> StreamingQuery:
    """Append one sketch of the users per interval; the state has a row per interval and not per user.

    ``operators.clicks.count_sketched_users`` counts them, also over longer windows. A blacklist is as of the start.
    """
    rows = records.withWatermark("event_ts", delay)
    if blacklist is not None:
        rows = ops.without_blacklisted(rows, blacklist)
    return to_files(ops.user_sketches(rows, window), path, checkpoint, trigger)
