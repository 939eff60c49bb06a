"""Daily states of customers, from which a profile of any look-back merges exactly.

One row per customer, day and counted value (amount, country, city, hour, device), one
per customer and day with counts and exact sums, and one with burst records. Counts and
sums add up, records are maxima: states of rows that arrive later stand beside those of
the rows before and merge with them, and nothing that was written is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.clock import MICROS, epoch_micros
from riskloom.functions.rules import is_night
from riskloom.operators.heat import Heat, Split, measure_heat, split_by_heat
from riskloom.operators.history import PROFILE_BURSTS, attach_history
from riskloom.params import RiskParams
from riskloom.session import written

KEY, DAY = "customer_id", "transaction_date"
WIDTHS = tuple(PROFILE_BURSTS.values())
ATTRIBUTES = ("amount", "country", "city", "hour", "device")
# what is known of a row that others may come after
PLACE = ("transaction_timestamp", "transaction_id", "country", "latitude", "longitude")

_PLACE_TYPE = T.StructType(
    [
        T.StructField("transaction_timestamp", T.TimestampNTZType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)
ROWS_PER_TASK = 200_000  # that are counted together; each becomes one row per attribute
_MAXIMA = [f"{kind}_{w}" for kind in ("record", "late") for w in WIDTHS]
_EARLY = [f"early_{w}" for w in WIDTHS]
_SUMS = ("n", "amounts", "total", "nights", *_EARLY)

STATE_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField(DAY, T.DateType()),
        T.StructField("part", T.StringType()),  # day, burst or an attribute
        T.StructField("value", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("n", T.LongType()),  # rows
        T.StructField("amounts", T.LongType()),  # rows with an amount
        T.StructField("total", T.DecimalType(28, 2)),
        T.StructField("squares", T.DecimalType(38, 4)),
        T.StructField("nights", T.LongType()),
        T.StructField("last", _PLACE_TYPE),  # the latest row
        *[T.StructField(name, T.LongType()) for name in _EARLY + _MAXIMA],
    ]
)


def _since_midnight(ts: Column) -> Column:
    return epoch_micros(ts) % (86_400 * MICROS)


def pieces_of(n: int) -> int:
    """So many tasks keep each one near ``ROWS_PER_TASK`` rows."""
    return max(1, -(-n // ROWS_PER_TASK))


def count_states(
    rows: DataFrame,
    p: RiskParams = RiskParams(),
    keys: tuple[str, ...] = (KEY, DAY),
    attributes: tuple[str, ...] = ATTRIBUTES,
    heat: Heat | None = None,
    n: int | None = None,
) -> DataFrame:
    """The parts that add up, of ``rows`` (``n`` of them, if that is known).

    Rows are dealt before each becomes one per attribute, so a task holds a bounded number
    of them whatever the size of the files. Those of ordinary customers go by customer and
    day, and their groups are whole where they are; those of hot ones (of all, if ``heat``
    is not given) go by id and are pre-aggregated before a second shuffle. The latest row,
    which no hash table can hold, is found apart from the values; without days among the
    ``keys`` it is not asked for, and one pass serves all.
    """
    ts, amount, none = F.col("transaction_timestamp"), F.col("amount"), F.lit(None)
    pieces = pieces_of(rows.count() if n is None else n)
    values = {
        "country": F.col("country"),
        "city": F.col("city"),
        # two digits, so that text order is hour order
        "hour": F.lpad(F.hour(ts).cast("string"), 2, "0"),
        "device": F.col("device_id"),
    }
    of_day = {"_amount": amount, "_night": is_night(ts, p), "_time": _since_midnight(ts)}

    def part(name: str, value: Column, of_amount: Column, *more: Column) -> Column:
        return F.struct(F.lit(name).alias("part"), value.cast("string").alias("value"), of_amount.cast("decimal(18,2)").alias("amount"), *more)

    def of_attributes(*more: Column) -> list[Column]:
        return [part(a, none, amount, *more) if a == "amount" else part(a, values[a], none, *more) for a in attributes]

    day = part("day", none, none, *[c.alias(name) for name, c in of_day.items()])
    sums = [
        F.count("*").alias("n"),
        F.count("_amount").alias("amounts"),
        F.sum("_amount").alias("total"),
        F.try_sum(F.try_multiply("_amount", "_amount")).alias("squares"),
        F.count_if("_night").alias("nights"),
        *[F.count_if(F.col("_time") < w * MICROS).alias(f"early_{w}") for w in WIDTHS],
    ]
    by_value = (*keys, "part", "value", "amount")
    narrow = (KEY, DAY, "transaction_id", "transaction_timestamp", "amount", "country", "city", "device_id")

    def counted(some: DataFrame, *by: str) -> DataFrame:
        if DAY not in keys:
            absent = [F.when(F.lit(False), c).alias(name) for name, c in of_day.items()]
            wide = some.select(*narrow).repartition(pieces, *by).select(*keys, DAY, F.inline(F.array(day, *of_attributes(*absent))))
            return wide.groupBy(*by_value).agg(*sums, F.max(DAY).alias(DAY))
        own = some.select(KEY, DAY, "amount", *PLACE).repartition(pieces, *by)
        own = own.select(*keys, F.inline(F.array(day)), F.struct(*PLACE).alias("_place"))
        own = own.groupBy(*by_value).agg(*sums, F.max("_place").alias("last"))
        wide = some.select(*narrow).repartition(pieces, *by).select(*keys, F.inline(F.array(*of_attributes())))
        return own.unionByName(wide.groupBy(*by_value).agg(F.count("*").alias("n")), allowMissingColumns=True)

    by_id = (KEY, DAY, "transaction_id")
    if heat is None:
        return counted(rows, *by_id)
    return split_by_heat(rows, heat).map(lambda some: counted(some, *keys), lambda some: counted(some, *by_id)).merged()


def burst_states(split: Split, days: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """Burst records per customer and day of ``days`` (customer, day; all if not given);
    the rows (about ``n``, if that is known) must hold what lies up to an hour before
    those days.

    record: the greatest count of the day's rows; late: of those that look back no
    further than midnight. With the number of rows earlier in the day (``early``) the
    latter gives the record of a day before which nothing counts.
    """
    # nothing else travels with the rows
    split = split.map(*[lambda rows: rows.select(KEY, DAY, "transaction_timestamp", "transaction_id")] * 2)
    if n is not None:
        split = split.map(lambda rows: rows.repartition(pieces_of(n), KEY), lambda rows: rows)
    counted = attach_history(split, PROFILE_BURSTS, previous=False).merged().where(F.col(DAY).isNotNull())
    time = _since_midnight(F.col("transaction_timestamp"))
    records = [F.max(name).alias(f"record_{w}") for name, w in PROFILE_BURSTS.items()]
    records += [F.max(F.when(time >= w * MICROS, F.col(name))).alias(f"late_{w}") for name, w in PROFILE_BURSTS.items()]
    found = counted.groupBy(KEY, DAY).agg(*records)
    if days is not None:
        wanted = days.select(F.col(KEY).alias("_k"), F.col(DAY).alias("_d")).distinct()
        found = found.join(wanted, F.col(KEY).eqNullSafe(F.col("_k")) & (F.col(DAY) == F.col("_d")), "left_semi")
    return found.withColumn("part", F.lit("burst"))


def daily_states(rows: DataFrame, p: RiskParams = RiskParams(), heat: Heat | None = None) -> DataFrame:
    """All states of ``rows``."""
    # each part reads the rows: they are derived once, without what no state needs
    rows = written(rows.select(KEY, DAY, "amount", "city", "device_id", *PLACE), "counted")
    heat, n = heat or measure_heat(rows), rows.count()
    bursts = burst_states(split_by_heat(rows, heat), n=n)
    return as_states(count_states(rows, p, heat=heat, n=n)).unionByName(as_states(bursts))


def customer_days(states: DataFrame) -> DataFrame:
    """(customer, day, n, last): number of rows and the latest one."""
    return states.where(F.col("part") == "day").groupBy(KEY, DAY).agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def as_states(rows: DataFrame) -> DataFrame:
    """All columns of a state; those that a part does not have are null."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in STATE_SCHEMA])


def merged_states(states: DataFrame, keys: tuple[str, ...] = (KEY, DAY)) -> DataFrame:
    """One row per key and value."""
    return states.groupBy(*keys, "part", "value", "amount").agg(
        *[F.sum(name).alias(name) for name in _SUMS],
        F.try_sum("squares").alias("squares"),
        # a struct, which no hash table can hold: the profile goes without
        *([F.max("last").alias("last")] if "last" in states.columns else []),
        *[F.max(name).alias(name) for name in _MAXIMA],
        *([] if DAY in keys else [F.max(DAY).alias(DAY)]),
    )


def combined_states(states: DataFrame) -> DataFrame:
    """What a merged folder of states keeps."""
    return as_states(merged_states(states))


def opening_day_alone(states: DataFrame, first_day: object) -> DataFrame:
    """Burst records as if nothing had happened before ``first_day``."""
    opening = F.col(DAY) == F.lit(first_day)
    columns = {}
    for w in WIDTHS:
        columns[f"record_{w}"] = F.when(~opening, F.col(f"record_{w}"))
        columns[f"late_{w}"] = F.when(opening, F.col(f"late_{w}"))
        columns[f"early_{w}"] = F.when(opening, F.col(f"early_{w}"))
    return states.withColumns(columns)


# -- summaries of merged states, one row per customer --------------------------


def _of(name: str, value: Column) -> Column:
    return F.when((F.col("part") == name) & F.col("value").isNotNull(), value)


def _most_frequent(name: str) -> Column:
    """Value with the highest count, the lowest one on ties."""
    return F.min(_of(name, F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))))["v"]


def deviation(n: Column, total: Column, squares: Column, otherwise: Column) -> Column:
    """Sample standard deviation from exact decimal sums, so that the order of the rows
    does not show; sums beyond 38 digits leave it to ``otherwise``."""
    spread = F.try_subtract(F.try_multiply(n.cast("decimal(18,0)"), squares), F.try_multiply(total, total))
    exact = F.sqrt(spread.cast("double") / n / (n - 1))
    return F.when(n > 1, F.coalesce(exact, otherwise))


def spending_summary(p: RiskParams) -> list[Column]:
    n, amounts = F.sum(F.when(F.col("part") == "day", F.col("n"))), F.sum("amounts")
    total = F.sum("total").cast("decimal(28,2)")
    value = F.when(F.col("part") == "amount", F.col("amount").cast("double"))
    rough = F.sqrt((F.sum(F.col("n") * value * value) - F.pow(F.sum(F.col("n") * value), 2) / amounts) / (amounts - 1))
    return [
        (total.cast("double") / F.nullif(amounts, F.lit(0))).alias("avg_amount"),
        deviation(amounts, total, F.try_sum("squares"), rough).alias("stddev_amount"),
        n.alias("txn_count_90d"),
        total.alias("total_spend_90d"),
        (n / F.lit(float(p.baseline_lookback_days))).alias("avg_daily_txns"),
        F.max(F.when(F.col("part") == "day", F.col(DAY))).alias("last_txn_date"),
    ]


def geography_summary(p: RiskParams) -> list[Column]:
    n = F.col("n")
    elsewhere = F.coalesce(F.sum(_of("country", n)) - F.max(_of("country", n)), F.lit(0))
    return [
        _most_frequent("country").alias("home_country"),
        _most_frequent("city").alias("home_city"),
        F.count(_of("country", F.lit(1))).alias("countries_visited"),
        (elsewhere / F.sum(F.when(F.col("part") == "country", n))).alias("cross_border_rate"),
    ]


def timing_summary(p: RiskParams) -> list[Column]:
    rows = F.sum(F.when(F.col("part") == "day", F.col("n")))
    return [_most_frequent("hour").cast("int").alias("typical_hour"), (F.sum("nights") / rows).alias("late_night_rate")]


def device_summary(p: RiskParams) -> list[Column]:
    return [F.count(_of("device", F.lit(1))).alias("device_count_90d"), _most_frequent("device").alias("primary_device")]


def velocity_summary(p: RiskParams) -> list[Column]:
    def record(w: int) -> Column:
        early = F.sum(f"early_{w}")
        return F.greatest(F.max(f"record_{w}"), F.max(f"late_{w}"), F.when(early > 0, early - 1))

    return [record(w).alias(name) for name, w in zip(RECORDS, WIDTHS, strict=True)]


# Profile columns of the burst records, by rising width.
RECORDS = ("historical_max_5min", "historical_max_15min", "historical_max_1hr")

# The quantiles kept in the profile.
QUANTILES = {
    "p25_amount": 0.25,
    "median_amount": 0.5,
    "p75_amount": 0.75,
    "p95_amount": 0.95,
    "p99_amount": 0.99,
}


def quantile_summary() -> Column:
    """All quantiles as an array, for customers whose amounts fit into one group."""
    amount = F.col("part") == "amount"
    return F.percentile(F.when(amount, F.col("amount").cast("double")), list(QUANTILES.values()), F.when(amount, F.col("n")).otherwise(F.lit(0))).alias("_quantiles")


def spread_quantiles(states: DataFrame) -> DataFrame:
    """Exact interpolated quantiles of amount from counts of its values.

    Buckets follow the logarithm of the amount, so there are at most some ten
    thousand per customer, and one holds the distinct values within 0.1 %.
    """
    amount = F.col("amount").cast("double")
    counts = states.where((F.col("part") == "amount") & F.col("amount").isNotNull()).select(
        F.coalesce(F.concat(F.lit("="), KEY), F.lit("")).alias("_who"),
        KEY,
        amount.alias("_value"),
        F.col("n").alias("_n"),
        F.floor(F.signum(amount) * F.log1p(F.abs(amount)) * 1000).alias("_bucket"),
    )
    by_bucket = Window.partitionBy("_who").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = (
        counts.groupBy("_who", "_bucket")
        .agg(F.sum("_n").alias("_size"))
        .select(
            "_who",
            "_bucket",
            (F.sum("_size").over(by_bucket) - F.col("_size")).alias("_below"),
            F.sum("_size").over(Window.partitionBy("_who")).alias("_total"),
        )
    )
    in_bucket = Window.partitionBy("_who", "_bucket").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        counts.join(buckets, ["_who", "_bucket"])
        .withColumn("_end", F.col("_below") + F.sum("_n").over(in_bucket))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def at_rank(rank: Column) -> Column:
        here = (F.col("_start") <= rank) & (rank < F.col("_end"))
        return F.max(F.when(here, F.col("_value")))

    found = []
    for name, q in QUANTILES.items():
        position = F.lit(q) * (F.col("_total") - 1)
        found += [at_rank(F.floor(position)).alias(f"_lo_{name}"), at_rank(F.ceil(position)).alias(f"_hi_{name}")]
    picked = ranked.groupBy(KEY).agg(F.max("_total").alias("_total"), *found)

    def interpolated(name: str, q: float) -> Column:
        position = F.lit(q) * (F.col("_total") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        mixed = (F.ceil(position) - position) * lo + (position - F.floor(position)) * hi
        return F.when(lo == hi, lo).otherwise(mixed).alias(name)

    return picked.select(KEY, *[interpolated(name, q) for name, q in QUANTILES.items()])
