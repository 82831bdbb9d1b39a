"""What each transaction's user did before: rank, totals, sliding sums, gaps.

Users with few transactions are windowed as a whole. What lies in a sliding frame is there a difference of two running
sums, which whole billionths keep exact, so a user's cost follows its rows and not what the frame holds. A busy user (and the rows without a user count as one)
may hold a large part of the table, so a window over all its transactions is out of the question. Those are
first added up per second and then windowed by day: a day has at most 86,400 seconds and a user at most one
row per day of the calendar, whatever the number of transactions. A sliding sum of k days is then the current
day so far, plus k-1 whole days, plus the end of day -k; its cost does not depend on how many rows the frame
holds.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.functions.rounding import two_decimals
from basketflow.operators.joins import MAX_BROADCAST_ROWS, broadcast_if_small, keyed_lookup
from basketflow.operators.ordering import (
    MAX_GROUP_ROWS,
    oversized_groups,
    rows_before,
    rows_before_by_sort,
)
from basketflow.settings import Scoring
from basketflow.shared import as_table

# Transactions up to which a user is windowed as a whole; a sliding frame then never holds more rows than this.
MAX_USER_ROWS = 1_000

DAY = 86_400
# Amounts are added up in these units where sums are subtracted again; all of a user must fit a long.
UNITS = 10**9
MAX_UNITS = 9 * 10**18
# Stands for a missing date: far before any real second, so such rows sort first and meet no other frame.
UNDATED = -(10**15)

SECOND = ["user_key", "event_sec"]
SO_FAR = (Window.unboundedPreceding, Window.currentRow)
BEFORE = (Window.unboundedPreceding, -1)


def _day(second: Column) -> Column:
    return F.floor(second / DAY)


def _dated(second: Column) -> Column:
    return F.when(second != UNDATED, second)


def _user_key() -> Column:
    return F.concat(F.lit("user "), "user_id")


def with_user_second(transactions: DataFrame) -> DataFrame:
    """Add the grouping keys, neither of which is ever null."""
    return transactions.withColumns(
        {
            "user_key": F.coalesce(_user_key(), F.lit("none")),
            "event_sec": F.coalesce(F.unix_seconds("transaction_date"), F.lit(UNDATED)),
        }
    )


# Both ways below add the same columns: n_earlier, previous_sec, sliding_amount, active_days, user_rows, user_mean.


def past_by_user(keyed: DataFrame, window_days: int) -> DataFrame:
    """For users with few transactions: one shuffle, one sort, running frames only.

    A day is in the frame if it is the row's own or its last row is neither later than the day before nor gone.
    """
    user = Window.partitionBy("user_key")
    timeline = user.orderBy("event_sec", "transaction_id")
    seconds = user.orderBy("event_sec")
    now, gone = seconds.rangeBetween(*SO_FAR), seconds.rangeBetween(Window.unboundedPreceding, -window_days * DAY - 1)

    def within(value: Column) -> Column:
        return F.sum(value).over(now) - F.coalesce(F.sum(value).over(gone), F.lit(0))

    following = F.lead("event_sec").over(timeline)
    last_of_day = (F.col("event_sec") != UNDATED) & F.coalesce(_day(following) != _day(F.col("event_sec")), F.lit(True))
    units = (F.col("amount").try_cast("decimal(18,9)") * UNITS).cast("long")
    marked = keyed.withColumns(
        {
            "n_earlier": F.row_number().over(timeline).cast("long") - 1,
            "previous_sec": _dated(F.lag("event_sec").over(timeline)),
            "user_rows": F.count("*").over(user),
            "user_mean": F.avg("amount").over(user),
            "units": F.coalesce(units, F.lit(0)),
            "has_amount": F.col("amount").isNotNull().cast("long"),
            "ended_day": last_of_day.cast("long"),
        }
    )
    ended_before = F.coalesce(F.sum("ended_day").over(timeline.rowsBetween(*BEFORE)), F.lit(0))
    ended_and_gone = F.coalesce(F.sum("ended_day").over(gone), F.lit(0))
    return marked.select(
        *keyed.columns,
        "n_earlier",
        "previous_sec",
        F.when(within(F.col("has_amount")) > 0, within(F.col("units")) / F.lit(float(UNITS))).alias("sliding_amount"),
        F.when(F.col("event_sec") == UNDATED, 0).otherwise(1 + ended_before - ended_and_gone).cast("int").alias("active_days"),
        "user_rows",
        "user_mean",
    )


def past_by_day(keyed: DataFrame, window_days: int, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """For users with any number of transactions."""
    seconds = as_table(user_seconds(keyed), "user_seconds")
    return placed(keyed, seconds, second_measures(seconds, user_days(seconds), window_days), max_group_rows)


def placed(keyed: DataFrame, seconds: DataFrame, measures: DataFrame, max_group_rows: int) -> DataFrame:
    """Rows with the measures of their second, told apart within it by ``transaction_id``. ``seconds`` is a table."""
    by_id = [F.col("transaction_id")]
    big = oversized_groups(seconds, SECOND, "n", max_group_rows)
    if big is None:
        rows = rows_before(keyed, SECOND, by_id, "n_same_second").join(measures, SECOND)
    else:
        # Seconds that one user fills with too many rows, for instance all those without a date.
        big = broadcast_if_small(as_table(big, "crowded_seconds"), enabled=True)
        usual = rows_before(keyed.join(big, SECOND, "left_anti"), SECOND, by_id, "n_same_second")
        crowded = rows_before_by_sort(keyed.join(big, SECOND, "left_semi"), SECOND, by_id, "n_same_second")
        # as many rows as there are crowded seconds; beyond the bound the skewed join is split by Spark
        crowded_measures = broadcast_if_small(
            as_table(measures.join(big, SECOND, "left_semi"), "crowded_measures"), enabled=True
        )
        rows = usual.join(measures, SECOND).unionByName(crowded.join(crowded_measures, SECOND))

    previous = F.when(F.col("n_same_second") > 0, F.col("event_sec")).otherwise(F.col("second_before"))
    return rows.select(
        *keyed.columns,
        (F.col("n_before") + F.col("n_same_second")).alias("n_earlier"),
        _dated(previous).alias("previous_sec"),
        "sliding_amount",
        "active_days",
        "user_rows",
        "user_mean",
    )


def user_seconds(keyed: DataFrame) -> DataFrame:
    """Number of transactions per user and second, how many have an amount, and the sum of those."""
    return keyed.groupBy(*SECOND).agg(
        F.count("*").alias("n"),
        F.count("amount").alias("n_amounts"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("amount"),
    )


def with_day(seconds: DataFrame) -> DataFrame:
    return seconds.withColumn("day", _day(F.col("event_sec")))


def user_days(seconds: DataFrame) -> DataFrame:
    """The same per user and day, and the last second of each."""
    return (
        with_day(seconds)
        .groupBy("user_key", "day")
        .agg(
            F.sum("n").alias("n"),
            F.sum("n_amounts").alias("n_amounts"),
            F.sum("amount").alias("amount"),
            F.max("event_sec").alias("last_sec"),
        )
    )


def day_measures(days: DataFrame, window_days: int) -> DataFrame:
    """Per user and day: what lies before the day, in the days the frame covers, and in total."""
    user = Window.partitionBy("user_key")
    calendar = user.orderBy("day")
    edge = calendar.rangeBetween(-window_days, -window_days)
    if window_days > 1:
        whole = calendar.rangeBetween(1 - window_days, -1)
        whole_amount, whole_amounts = F.sum("amount").over(whole), F.sum("n_amounts").over(whole)
        whole_active = F.count("*").over(whole)
    else:
        whole_amount, whole_amounts, whole_active = F.lit(0.0), F.lit(0), F.lit(0)
    return days.select(
        "user_key",
        "day",
        F.coalesce(F.sum("n").over(calendar.rowsBetween(*BEFORE)), F.lit(0)).alias("n_before_day"),
        F.lag("last_sec").over(calendar).alias("last_sec_before_day"),
        F.coalesce(whole_amount, F.lit(0.0)).alias("whole_amount"),
        F.coalesce(whole_amounts, F.lit(0)).alias("whole_amounts"),
        whole_active.alias("whole_active"),
        F.max("last_sec").over(edge).alias("edge_last_sec"),
        F.sum("n").over(user).alias("user_rows"),
        F.sum("amount").over(user).alias("user_amount"),
        F.sum("n_amounts").over(user).alias("user_amounts"),
    )


def second_measures(seconds: DataFrame, days: DataFrame, window_days: int) -> DataFrame:
    """Per user and second: rows and second before it, sliding amount, active days, user totals.

    ``days`` are all days of the users. ``seconds`` may be those of some days and of the days whose end is in their frames.
    """
    span = window_days * DAY
    none = F.lit(0).cast("long")
    arriving = seconds.select(
        *SECOND,
        "n",
        "n_amounts",
        "amount",
        none.alias("n_leaving"),
        F.lit(0.0).alias("leaving"),
        F.lit(True).alias("arrives"),
    )
    # The same amounts moved to the day on which they leave the frame, at their own time of day.
    leaving = seconds.select(
        "user_key",
        (F.col("event_sec") + span).alias("event_sec"),
        none.alias("n"),
        none.alias("n_amounts"),
        F.lit(0.0).alias("amount"),
        F.col("n_amounts").alias("n_leaving"),
        F.col("amount").alias("leaving"),
        F.lit(False).alias("arrives"),
    )
    day = Window.partitionBy("user_key", "day")
    rising = day.orderBy("event_sec")
    falling = day.orderBy(F.desc("event_sec"))
    in_day = (
        with_day(arriving.unionByName(leaving))
        .select(
            "user_key",
            "day",
            "event_sec",
            "arrives",
            F.coalesce(F.sum("n").over(rising.rowsBetween(*BEFORE)), F.lit(0)).alias("n_before_in_day"),
            F.max(F.when(F.col("arrives"), F.col("event_sec"))).over(rising.rowsBetween(*BEFORE)).alias("sec_in_day"),
            F.sum("amount").over(rising.rowsBetween(*SO_FAR)).alias("day_so_far"),
            F.sum("leaving").over(falling.rangeBetween(*SO_FAR)).alias("not_yet_left"),
            F.sum("n_amounts").over(rising.rowsBetween(*SO_FAR)).alias("amounts_so_far"),
            F.sum("n_leaving").over(falling.rangeBetween(*SO_FAR)).alias("amounts_not_yet_left"),
        )
        .where("arrives")
    )
    in_edge = F.coalesce(F.col("edge_last_sec") >= F.col("event_sec") - span, F.lit(False))
    amounts = F.col("amounts_so_far") + F.col("whole_amounts") + F.col("amounts_not_yet_left")
    sliding = F.col("day_so_far") + F.col("whole_amount") + F.col("not_yet_left")
    return in_day.join(day_measures(days, window_days), ["user_key", "day"]).select(
        *SECOND,
        (F.col("n_before_day") + F.col("n_before_in_day")).alias("n_before"),
        F.coalesce("sec_in_day", "last_sec_before_day").alias("second_before"),
        F.when(amounts > 0, sliding).alias("sliding_amount"),
        F.when(F.col("event_sec") == UNDATED, 0)
        .otherwise(1 + F.col("whole_active") + in_edge.cast("int"))
        .cast("int")
        .alias("active_days"),
        "user_rows",
        F.try_divide("user_amount", "user_amounts").alias("user_mean"),
    )


def with_past(
    keyed: DataFrame, window_days: int, max_user_rows: int, max_group_rows: int, users: DataFrame | None = None
) -> DataFrame:
    """Each user by the way that suits the number of its transactions, and those with amounts beyond the exact sums by day.

    The largest of the busy users, as many as may be broadcast, are set apart before anything is shuffled. Other
    busy users, if there are that many, are told from quiet ones by a join on the user, which the windows of the
    quiet ones go on from; none of them has more than its share of the rows divided by that number.
    """
    few, many = set_apart(keyed, max_user_rows)
    quiet = of_quiet(few, window_days, users)
    return quiet if many is None else quiet.unionByName(of_busy(many, window_days, max_group_rows, users))


def set_apart(keyed: DataFrame, max_user_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of quiet users, and those of busy ones or None if there are none; see :func:`with_past`."""
    sizes = keyed.groupBy("user_key").agg(F.count("*").alias("n"), F.max(F.abs("amount")).alias("largest"))
    # NaN is more than any number
    large = F.coalesce(F.col("largest") * UNITS * max(max_user_rows, 1) > MAX_UNITS, F.lit(False))
    busy = as_table(sizes.where((F.col("n") > max_user_rows) | large).drop("largest"), "busy_users")
    count = busy.count()
    if count == 0:
        return keyed, None
    largest, names = busy.select("user_key"), busy.select("user_key")
    if count > MAX_BROADCAST_ROWS:
        largest = as_table(busy.orderBy(F.desc("n"), "user_key").limit(MAX_BROADCAST_ROWS).select("user_key"), "largest")
    few = keyed.join(F.broadcast(largest), "user_key", "left_anti")
    many = keyed.join(F.broadcast(largest), "user_key", "left_semi")
    if count > MAX_BROADCAST_ROWS:
        names = names.hint("merge")  # keeps the partitioning by user for the windows
        many = many.unionByName(few.join(names, "user_key", "left_semi"))
        few = few.join(names, "user_key", "left_anti")
    return few, many


def of_quiet(keyed: DataFrame, window_days: int, users: DataFrame | None) -> DataFrame:
    """The users' attributes are joined by the key the windows are partitioned by: no second shuffle."""
    past = past_by_user(keyed, window_days)
    return past if users is None else past.join(users, "user_key", "left")


def of_busy(keyed: DataFrame, window_days: int, max_group_rows: int, users: DataFrame | None) -> DataFrame:
    past = past_by_day(keyed, window_days, max_group_rows)
    return past if users is None else keyed_lookup(past, users, "user_key")


def with_history(
    transactions: DataFrame,
    scoring: Scoring = Scoring(),
    max_user_rows: int = MAX_USER_ROWS,
    max_group_rows: int = MAX_GROUP_ROWS,
    users: DataFrame | None = None,
) -> DataFrame:
    """Add the per-user columns to transactions that have a ``transaction_date`` (null allowed).

    Rank, previous purchase and means follow (transaction_date, transaction_id), missing dates first.
    ``user_mean`` and ``delay_minutes`` are left unrounded for scoring. Sums and means leave out missing amounts and
    are null where a frame has none. ``users``, with ``user_id`` and columns to attach, is joined on the way.
    Users are counted before the plan is made, so calling this runs a job over the keys.
    """
    attached = [] if users is None else [name for name in users.columns if name != "user_id"]
    if users is not None:
        users = keyed_users(users, attached)
    past = with_past(with_user_second(transactions), scoring.window_days, max_user_rows, max_group_rows, users)
    return history_columns(past, [*transactions.columns], scoring, attached)


def keyed_users(users: DataFrame, attached: list[str]) -> DataFrame:
    """Users by the key of their transactions."""
    return users.where(F.col("user_id").isNotNull()).select(_user_key().alias("user_key"), *attached)


def history_columns(past: DataFrame, own: list[str], scoring: Scoring, attached: list[str] | None = None) -> DataFrame:
    """The columns of :func:`with_history` from what lies before each row."""
    now, before = _dated(F.col("event_sec")), F.col("previous_sec")
    return past.select(
        *own,
        (F.col("n_earlier") + 1).alias("transaction_rank"),
        F.col("user_rows").alias("total_transactions_user"),
        two_decimals(F.col("sliding_amount")).alias("montant_cumule_7j"),
        (F.col("active_days") >= scoring.active_days).cast("int").alias("is_active_user"),
        (_day(now) - _day(before)).cast("int").alias("jours_depuis_achat_precedent"),
        ((now - before) / F.lit(60.0)).alias("delay_minutes"),
        "user_mean",
        *(attached or []),
    )
