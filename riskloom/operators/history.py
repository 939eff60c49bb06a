"""What a customer did just before each transaction.

Two facts per row: how many other transactions of the customer fall in the
trailing N seconds (both ends included), and where and when the previous
transaction took place.

Trailing counts are differences of two running counts. A sliding frame would
recount its whole content for every row; running counts cost the same however
dense a burst is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.clock import MICROS, NO_TIME, event_position
from riskloom.operators.heat import Heat, Split, measure_heat, split_by_heat
from riskloom.session import written

# Trailing widths in seconds of the profile and of the score.
PROFILE_BURSTS = {"burst_5min": 300, "burst_15min": 900, "burst_1hr": 3600}
SCORE_BURSTS = {"current_burst_5min": 300}

_PREVIOUS = {
    "prev_lat": "latitude",
    "prev_lon": "longitude",
    "prev_country": "country",
    "prev_ts": "transaction_timestamp",
}

_START = Window.unboundedPreceding


def burst_counts(
    txns: DataFrame, bursts: Mapping[str, int] = PROFILE_BURSTS, heat: Heat | None = None
) -> DataFrame:
    """Add one trailing count per entry of ``bursts`` (column -> seconds)."""
    split = split_by_heat(txns, heat or measure_heat(txns))
    return attach_history(split, bursts, previous=False).merged()


def previous_transaction(txns: DataFrame, heat: Heat | None = None) -> DataFrame:
    """Add place and time of the customer's previous transaction.

    Equal timestamps are ordered by transaction_id.
    """
    split = split_by_heat(txns, heat or measure_heat(txns))
    return attach_history(split, {}, previous=True).merged()


def attach_history(split: Split, bursts: Mapping[str, int], previous: bool, more: Mapping[str, str] | None = None) -> Split:
    """``more`` names further columns of the previous row to take along (new -> old)."""
    heat = split.heat
    return split.map(
        lambda rows: plain_history(rows, bursts, previous, more),
        lambda rows: spread_history(rows, bursts, previous, heat.chunks(1 + len(bursts)), heat.short, more=more),
    )


def plain_history(rows: DataFrame, bursts: Mapping[str, int], previous: bool, more: Mapping[str, str] | None = None) -> DataFrame:
    out = rows.withColumn("_at", event_position(F.col("transaction_timestamp")))
    by_time = Window.partitionBy("customer_id").orderBy("_at")
    if previous:
        # first, so that its sort also serves the shorter order of the counts
        one_by_one = Window.partitionBy("customer_id").orderBy("_at", "transaction_id")
        taken = _PREVIOUS | dict(more or {})
        out = out.withColumns({new: F.lag(old).over(one_by_one) for new, old in taken.items()})
    if bursts:
        so_far = F.count(F.lit(1)).over(by_time.rangeBetween(_START, Window.currentRow))

        def left_behind(seconds: int) -> Column:
            return F.count(F.lit(1)).over(by_time.rangeBetween(_START, -seconds * MICROS - 1))

        out = out.withColumns({name: so_far - left_behind(s) - 1 for name, s in bursts.items()})
    return out.drop("_at")


def spread_history(
    rows: DataFrame,
    bursts: Mapping[str, int],
    previous: bool,
    chunks: int,
    few: bool = True,
    weight: str | None = None,
    more: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same columns by a parallel prefix scan, however dense a customer's rows are.

    Events are the rows and, per width, copies of them moved forward by the width: a
    copy at a time says that a row has left the window there. They are dealt by range of
    (customer, time, id) into ``chunks``, even where all have the same time. Each chunk
    keeps running counts and the last place seen; its totals, one record per chunk and
    customer, are summed up over the chunks before and carried forward to its rows. A
    time that goes on in later chunks gets their rows of that time from the same
    records. The chunks are written to the work folder, so both uses see the same ones.

    ``few``: there are few enough customers to broadcast the records. ``weight`` names a
    multiplicity column for rows that were pre-counted.
    """
    taken = _PREVIOUS | dict(more or {}) if previous else {}
    place = F.struct(*[F.col(old).alias(new) for new, old in taken.items()]) if previous else F.lit(None)
    base = rows.select(
        # never NULL, so that joins and windows agree on the partitioning
        F.coalesce(F.concat(F.lit("="), "customer_id"), F.lit("")).alias("_who"),
        event_position(F.col("transaction_timestamp")).alias("_at"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("_n"),
        (F.lit(None).cast("string") if weight else F.col("transaction_id")).alias("_tie"),
        # tells copies of a row apart, so that they can be dealt to several chunks
        F.monotonically_increasing_id().alias("_copy"),
        place.alias("_place"),
        F.struct(*rows.columns).alias("_row"),
    )
    events = base.withColumn("_shift", F.explode(F.array(*[F.lit(s) for s in (0, *bursts.values())])))
    real = F.col("_shift") == 0
    events = events.where(real | (F.col("_at") < NO_TIME)).withColumns(
        {
            "_at": F.col("_at") + F.col("_shift").cast("long") * MICROS,
            "_place": F.when(real, F.col("_place")),
            "_row": F.when(real, F.col("_row")),
        }
    )
    # a copy that arrives just when a row happens is after it: both ends count
    order = ("_at", "_shift", "_tie", "_copy")
    dealt = events.repartitionByRange(chunks, "_who", *order).withColumn("_chunk", F.spark_partition_id())

    chunk = Window.partitionBy("_chunk", "_who")
    one_by_one = chunk.orderBy(*order)
    so_far = one_by_one.rowsBetween(_START, Window.currentRow)

    def running(shift: int) -> Column:
        return F.sum(F.when(F.col("_shift") == shift, F.col("_n")).otherwise(0)).over(so_far)

    local = dealt.withColumns(
        {
            "_rows": running(0),
            **{f"_gone_{s}": running(s) for s in bursts.values()},
            "_seen": F.last("_place", ignorenulls=True).over(one_by_one.rowsBetween(_START, -1)),
            "_first_at": F.min(F.when(real, F.col("_at"))).over(so_far),
            "_last_at": F.max(F.when(real, F.col("_at"))).over(so_far),
            "_end": F.lead("_chunk").over(one_by_one).isNull(),
        }
    )
    by_time = chunk.orderBy("_at").rangeBetween(_START, Window.currentRow)
    local = local.withColumn("_own", F.sum(F.when(real, F.col("_n")).otherwise(0)).over(by_time))
    local = local.withColumn("_at_first", F.min(F.when(real, F.col("_own"))).over(so_far))
    local = written(local.where(real | F.col("_end")), "chunks")
    carried = _carried(local.where("_end"), [f"_gone_{s}" for s in bursts.values()])
    out = local.where(real).drop("_first_at", "_last_at", "_at_first", "_rows")
    out = out.join(F.broadcast(carried) if few else carried, ["_chunk", "_who"])
    until = F.col("_own") + F.col("_before") + F.when(F.col("_at") == F.col("_last_at"), F.col("_later")).otherwise(0)
    columns = ["_row.*"]
    if previous:
        nearest = F.coalesce(F.col("_seen"), F.col("_place_before"))
        columns += [nearest[name].alias(name) for name in taken]
    columns += [
        (until - F.col(f"_gone_{s}") - F.col(f"_gone_{s}_before") - 1).alias(name) for name, s in bursts.items()
    ]
    return out.select(*columns)


def _carried(ends: DataFrame, gone: list[str]) -> DataFrame:
    """What each chunk gets from the others of its customer; ``ends`` has its totals."""
    by_chunk = Window.partitionBy("_who").orderBy("_chunk")
    before = by_chunk.rowsBetween(_START, -1)
    # chunks that begin with the same time, from the last one on
    following = Window.partitionBy("_who", "_first_at").orderBy(F.col("_chunk").desc()).rowsBetween(_START, -1)
    records = ends.select(
        "_chunk",
        "_who",
        "_first_at",
        "_last_at",
        "_at_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        *[F.coalesce(F.sum(g).over(before), F.lit(0)).alias(f"{g}_before") for g in gone],
        F.last(F.coalesce("_place", "_seen"), ignorenulls=True).over(before).alias("_place_before"),
        F.coalesce(F.sum("_at_first").over(following), F.lit(0)).alias("_follow"),
    )
    begun = records.where(F.col("_first_at").isNotNull()).groupBy(F.col("_who").alias("_w"), F.col("_first_at").alias("_f"))
    begun = begun.agg(F.sum("_at_first").alias("_all"))
    same = (F.col("_who") == F.col("_w")) & (F.col("_last_at") == F.col("_f"))
    # a chunk of one time is itself among those that begin with it
    later = F.when(F.col("_first_at") == F.col("_last_at"), F.col("_follow")).otherwise(F.coalesce("_all", F.lit(0)))
    return records.join(begun, same, "left").select(
        "_chunk", "_who", "_last_at", "_before", *[f"{g}_before" for g in gone], "_place_before", later.alias("_later")
    )
