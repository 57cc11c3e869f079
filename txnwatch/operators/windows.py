"""Rolling features per account.

Evaluating the frames on the rows themselves would sort a whole account in one task and add up every frame
anew for every row. Instead:

* Rows are first reduced to one per (account, second), the finest step the frames can tell apart.
* Those are spread over 28-day blocks that overlap by the longest frame (7 days), so a task holds at most 35
  days of seconds of an account, whatever the account's share of the table.
* Within a block each second enters a frame when it happens and leaves it one second after the frame's length.
  A frame's value is then a running sum over entries and exits: one pass, however long the frame. Sums of
  money run over exact decimals, so that what enters leaves without a trace: one for amounts below 10 ** 17 and one
  for larger ones, which doubles hold as whole numbers. Amounts that are not numbers, or not finite, are counted and
  make the frame's sum so too. Finite amounts from 10 ** 30 stop the job.
* Results are joined back by (account, second). Ties within a second count in the order (timestamp, txn_id). Rows
  without an account form one account.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.blocks import spread_over_blocks
from ..functions.columns import floor_div

DAY = 86400
BLOCK = 28 * DAY
WEEK, HOUR, TWO_DAYS = 7 * DAY, 3600, 2 * DAY

FEATURES = [
    "txn_count_same_day", "txn_count_7d", "txn_count_1h", "amount_sum_1h", "cash_dep_count_48h", "cash_sum_48h",
]


# What each feature adds up, and how long a second stays in its frame.
FRAMES = {
    "txn_count_7d": ("n", WEEK),
    "txn_count_1h": ("n", HOUR),
    "amount_sum_1h": ("amount", HOUR),
    "cash_dep_count_48h": ("cash_n", TWO_DAYS),
    "cash_sum_48h": ("cash_amount", TWO_DAYS),
}
MONEY, LARGE_MONEY = "decimal(28,10)", "decimal(31,0)"
LARGE, TOO_LARGE = 1e17, 1e30
NOT_A_NUMBER = 1 << 32  # counts of NaN above, of infinities below


def _money(amount, name: str) -> list:
    """Sums of an amount's exact parts, and how many are NaN or infinite."""
    size = F.abs(amount)
    finite = ~F.isnan(amount) & (size < float("inf"))
    large = F.when(size >= TOO_LARGE, F.raise_error(F.lit("an amount of 10 ** 30 or more")).cast("double")).otherwise(amount)
    odd = F.when(F.isnan(amount), F.lit(NOT_A_NUMBER)).when(size == float("inf"), F.lit(1)).otherwise(F.lit(0))
    return [
        F.coalesce(F.sum(F.when(size < LARGE, amount).cast(MONEY)), F.lit(0)).alias(name),
        F.coalesce(F.sum(F.when(finite & (size >= LARGE), large).cast(LARGE_MONEY)), F.lit(0)).alias(f"{name}_large"),
        F.coalesce(F.sum(odd.cast("long")), F.lit(0)).alias(f"{name}_odd"),
    ]


def _per_second(t: DataFrame) -> DataFrame:
    return t.groupBy("account_id", F.unix_seconds("txn_timestamp").alias("sec")).agg(
        F.count("txn_id").alias("n"),
        *_money(F.col("amount"), "amount"),
        F.coalesce(F.sum("is_cash"), F.lit(0)).alias("cash_n"),
        *_money(F.when(F.col("is_cash") == 1, F.col("amount")), "cash_amount"),
    )


def _parts(value: str) -> list[str]:
    return [value, f"{value}_large", f"{value}_odd"] if value.endswith("amount") else [value]


def frames(t: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """The rolling features per (account, second); the same-day count is that of earlier seconds."""
    wanted = list(wanted or FEATURES)
    rolling = {name: FRAMES[name] for name in wanted if name in FRAMES}
    lengths = sorted({length for _, length in rolling.values()})
    values = sorted({part for value, _ in rolling.values() for part in _parts(value)})
    # one shuffle for both windows below, before rows are multiplied
    spread = spread_over_blocks(_per_second(t), "sec", BLOCK, before=max(lengths, default=0)).repartition("account_id", "block")
    same_day = Window.partitionBy("account_id", "block", floor_div(F.col("sec"), DAY)).orderBy("sec")
    earlier = F.sum("n").over(same_day.rowsBetween(Window.unboundedPreceding, -1))
    spread = spread.select("account_id", "block", "sec", "own", *values, *(
        [F.coalesce(earlier, F.lit(0)).alias("txn_count_same_day")] if "txn_count_same_day" in wanted else []))
    if not rolling:
        return spread.filter("own").select("account_id", "sec", *wanted)

    # `leaves` is 0 where a second enters and the frame's length where it leaves that frame
    moments = F.array(
        F.struct(F.col("sec").alias("at"), F.lit(0).alias("leaves")),
        *[F.struct((F.col("sec") + (length + 1)).alias("at"), F.lit(length).alias("leaves")) for length in lengths])
    moves = spread.withColumn("moment", F.explode(moments)).select("*", "moment.*").drop("moment").filter(
        F.col("at") < (F.col("block") + 1) * BLOCK)
    running = Window.partitionBy("account_id", "block").orderBy("at", F.desc("leaves")).rowsBetween(
        Window.unboundedPreceding, 0)

    def summed(value: str, length: int):
        change = F.when(F.col("leaves") == 0, F.col(value)).when(F.col("leaves") == length, -F.col(value)).otherwise(0)
        return F.sum(change).over(running)

    def total(value: str, length: int):
        parts = [summed(part, length) for part in _parts(value)]
        if len(parts) == 1:
            return parts[0]
        exact, large, odd = parts
        finite = exact.cast("double") + large.cast("double")
        return F.when(odd == 0, finite).when(odd >= NOT_A_NUMBER, float("nan")).otherwise(float("inf"))

    built = {name: total(*spec) for name, spec in rolling.items()}
    return (
        moves.select("account_id", "sec", "own", "leaves", *[built.get(w, F.col(w)).alias(w) for w in wanted])
        .filter("own and leaves = 0").drop("own", "leaves")
    )


def attach(t: DataFrame, per_second: DataFrame) -> DataFrame:
    """Rows with everything ``per_second`` holds for their account and second. This is the one shuffle of the
    full rows, and (account, second) spreads even a single account over all tasks."""
    rows = t.withColumn("sec", F.unix_seconds("txn_timestamp"))
    counts_day = "txn_count_same_day" in per_second.columns
    if counts_day:
        within = Window.partitionBy("account_id", "sec").orderBy("txn_timestamp", "txn_id")
        rows = rows.withColumn("_within", F.count("txn_id").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    frames_ = per_second.withColumnsRenamed({"account_id": "_account", "sec": "_sec"})
    out = rows.join(frames_, rows["account_id"].eqNullSafe(frames_["_account"]) & (rows["sec"] == frames_["_sec"]))
    if counts_day:
        out = out.withColumn("txn_count_same_day", F.col("txn_count_same_day") + F.col("_within"))
    return out.select(*t.columns, *[c for c in per_second.columns if c not in ("account_id", "sec")])


def window_features(t: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Silver rows plus the rolling features asked for (all six by default)."""
    return attach(t, frames(t, wanted))


def _single(name: str):
    def feature(t: DataFrame) -> DataFrame:
        return window_features(t, [name]).select("txn_id", "account_id", "txn_timestamp", name)

    feature.__name__ = f"win_{name}"
    return feature


win_txn_count_same_day = _single("txn_count_same_day")
win_txn_count_7d = _single("txn_count_7d")
win_txn_count_1h = _single("txn_count_1h")
win_amount_sum_1h = _single("amount_sum_1h")
win_cash_dep_count_48h = _single("cash_dep_count_48h")
win_cash_sum_48h = _single("cash_sum_48h")
