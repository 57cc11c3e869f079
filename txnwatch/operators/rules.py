"""Detection rules on silver transactions. Each takes ``as_of`` and ``lookback`` and returns hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import floor_div, is_night, recent, severity_rank

# Message formats
STRUCTURING_TEXT = "STRUCTURING: %s made %d sub-threshold txns totaling %.2f"
VELOCITY_TEXT = "VELOCITY: %s had %d txns in 1 hour, total %.2f"
SMURFING_TEXT = "SMURFING: %s made %d small cash deposits totaling %.2f"
DORMANT_TEXT = "DORMANT SPIKE: %s inactive %d days, moved %.2f"
CASH_TEXT = "CASH NIGHT: %s deposited %.2f at hour %d"
LISTED_TEXT = "%s: %s | amount %.2f | list: %s"

HIT_COLUMNS = ["rule_id", "pattern_type", "severity", "account_id", "customer_id", "txn_id", "amount", "alert_msg",
               "event_ts"]


def _tags(pattern, rule, severity: str, message: str, *args: Column) -> dict[str, Column]:
    """The columns every hit carries."""
    return {
        "pattern_type": F.lit(pattern) if isinstance(pattern, str) else pattern,
        "rule_id": F.lit(rule) if isinstance(rule, str) else rule,
        "severity": F.lit(severity),
        "alert_msg": F.format_string(message, *args),
    }


def rule_structuring(t: DataFrame, lo=8000, hi=9999, min_count=3, bin="1 day", as_of=None, lookback=None) -> DataFrame:
    """Many amounts just under the threshold on one account in one day."""
    hits = (
        recent(t, lookback, as_of)
        .filter(F.col("amount").between(lo, hi))
        .groupBy("account_id", "customer_id", F.window("timestamp", bin).alias("bin"))
        .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount"),
             F.min("timestamp").alias("first_txn"), F.max("timestamp").alias("last_txn"))
        .filter(F.col("txn_count") >= min_count)
    )
    return hits.withColumns(_tags(
        "STRUCTURING", "RULE-001", "HIGH", STRUCTURING_TEXT,
        F.col("account_id"), F.col("txn_count"), F.col("total_amount"),
    )).select("account_id", "customer_id", "txn_count", "total_amount", "pattern_type", "rule_id", "severity",
              "alert_msg", "first_txn", "last_txn")


def _dormant_tags() -> dict[str, Column]:
    return _tags("DORMANT_SPIKE", "RULE-004", "HIGH", DORMANT_TEXT, F.col("account_id"), F.col("days_inactive"), F.col("amount"))


def _dormant(t, a, min_amount, min_inactive, as_of, lookback):
    idle = a.filter(F.col("days_inactive") > min_inactive).select("account_id", "days_inactive")
    hits = recent(t, lookback, as_of).filter(F.col("amount") > min_amount).join(idle, "account_id")
    return hits.withColumns(_dormant_tags())


def rule_dormant_spike(t, a, min_amount=50000, min_inactive=180, as_of=None, lookback=None) -> DataFrame:
    """A long idle account moves a large amount."""
    return _dormant(t, a, min_amount, min_inactive, as_of, lookback).select(
        "account_id", "customer_id", "amount", "days_inactive", "pattern_type", "rule_id", "severity", "alert_msg",
        "timestamp")


def rule_high_velocity(t: DataFrame, max_count=5, bin="1 hour", as_of=None, lookback=None) -> DataFrame:
    """More transactions in an hour than a person makes."""
    hits = (
        recent(t, lookback, as_of)
        .groupBy("account_id", F.window("timestamp", bin).alias("bin"))
        .agg(F.count(F.lit(1)).alias("txn_count_1h"), F.sum("amount").alias("amount_sum_1h"))
        .filter(F.col("txn_count_1h") > max_count)
    )
    return hits.withColumns(_tags(
        "HIGH_VELOCITY", "RULE-006", "MEDIUM", VELOCITY_TEXT,
        F.col("account_id"), F.col("txn_count_1h"), F.col("amount_sum_1h"),
    )).select("account_id", "txn_count_1h", "amount_sum_1h", "pattern_type", "rule_id", "severity", "alert_msg",
              F.col("bin.start").alias("timestamp"))


def rule_smurfing(t: DataFrame, max_amount=7500, min_count=7, bin="2 days", as_of=None, lookback=None) -> DataFrame:
    """Many small cash deposits within two days."""
    hits = (
        recent(t, lookback, as_of)
        .filter((F.col("txn_type") == "CASH_DEP") & (F.col("amount") < max_amount))
        .groupBy("account_id", F.window("timestamp", bin).alias("bin"))
        .agg(F.count(F.lit(1)).alias("dep_count"), F.sum("amount").alias("dep_total"))
        .filter(F.col("dep_count") >= min_count)
    )
    return hits.withColumns(_tags(
        "SMURFING", "RULE-009", "HIGH", SMURFING_TEXT,
        F.col("account_id"), F.col("dep_count"), F.col("dep_total"),
    )).select("account_id", "dep_count", "dep_total", "pattern_type", "rule_id", "severity", "alert_msg",
              F.col("bin.start").alias("timestamp"))


def _cash_night_tags(hour: Column) -> dict[str, Column]:
    return _tags("CASH_INTENSIVE", "RULE-005", "HIGH", CASH_TEXT, F.col("account_id"), F.col("amount"), hour)


def _cash_night(t, min_amount, night, as_of, lookback):
    hits = (
        recent(t, lookback, as_of)
        .filter((F.col("txn_type") == "CASH_DEP") & (F.col("amount") > min_amount))
        .withColumn("hour", F.hour("timestamp"))
        .filter(is_night(F.col("hour"), *night))
    )
    return hits.withColumns(_cash_night_tags(F.col("hour")))


def rule_cash_intensive(t, min_amount=25000, night=(22, 5), as_of=None, lookback=None) -> DataFrame:
    """A large cash deposit at night."""
    return _cash_night(t, min_amount, night, as_of, lookback).select(
        "account_id", "customer_id", "amount", "hour", "pattern_type", "rule_id", "severity", "alert_msg", "timestamp")


def _is_listed() -> Column:
    return F.col("watchlist_match") != "NONE"


def _is_pep() -> Column:
    return F.col("pep_flag") == "Y"


def _listed_people(c: DataFrame) -> DataFrame:
    return c.withColumn("watchlist_match", F.coalesce("watchlist_match", F.lit("NONE"))).filter(
        _is_listed() | _is_pep()).select("customer_id", "watchlist_match", "pep_flag")


def _watchlist_tags() -> dict[str, Column]:
    listed = _is_listed()
    return _tags(
        F.when(listed, "WATCHLIST_HIT").otherwise("PEP_LARGE_TXN"),
        F.when(listed, "RULE-008").otherwise("RULE-007"),
        "CRITICAL", LISTED_TEXT,
        F.when(listed, "WATCHLIST").otherwise("PEP"), F.col("customer_id"), F.col("amount"), F.col("watchlist_match"),
    )


def _watchlist(t, c, min_amount, pep_amount, as_of, lookback):
    hits = (
        recent(t, lookback, as_of).filter(F.col("amount") > min_amount)
        .join(_listed_people(c), "customer_id")
        .filter(_is_listed() | (_is_pep() & (F.col("amount") > pep_amount)))
    )
    return hits.withColumns(_watchlist_tags())


def rule_watchlist_pep(t, c, min_amount=5000, pep_amount=100000, as_of=None, lookback=None) -> DataFrame:
    """A listed customer moves money, or a politically exposed one moves a lot."""
    return _watchlist(t, c, min_amount, pep_amount, as_of, lookback).select(
        "account_id", "customer_id", "amount", "watchlist_match", "pep_flag", "pattern_type", "rule_id", "severity",
        "alert_msg", "timestamp")


def rule_live_flags(f: DataFrame, lookback: str = "65 seconds", as_of=None) -> DataFrame:
    """New undecided flags that need eyes now, worst first."""
    live = recent(f, lookback, as_of, ts="created_at").filter(
        F.col("severity").isin("CRITICAL", "HIGH") & (F.col("analyst_decision") == "PENDING"))
    return live.select(
        "flag_id", "txn_id", "account_id", "customer_id", "pattern_type", "rule_id", "ml_score", "severity",
        "created_at", "notes",
    ).orderBy(severity_rank(F.col("severity")), F.desc("ml_score"), "flag_id")


def _bin_start(seconds: int) -> Column:
    """The start of the bin that a row falls in, in seconds since the epoch."""
    return floor_div(F.unix_seconds("timestamp"), seconds) * seconds


def _binned_hits(t: DataFrame) -> DataFrame:
    """Hits of the three rules over bins from one scan and one aggregate: a row is tagged with each (rule, bin) it feeds."""
    amount, nobody = F.col("amount"), F.lit(None).cast("string")

    def tag(fits: Column, rule: str, customer: Column, seconds: int) -> Column:
        return F.when(fits, F.struct(F.lit(rule).alias("rule_id"), customer.alias("customer_id"),
                                     _bin_start(seconds).alias("bin_start")))

    tags = F.array_compact(F.array(
        tag(amount.between(8000, 9999), "RULE-001", F.col("customer_id"), 86400),
        tag(F.lit(True), "RULE-006", nobody, 3600),
        tag((F.col("txn_type") == "CASH_DEP") & (amount < 7500), "RULE-009", nobody, 2 * 86400)))
    bins = t.filter(F.col("timestamp").isNotNull()).select("account_id", "amount", "timestamp", F.explode(tags).alias("tag")).groupBy(
        "account_id", "tag.rule_id", "tag.customer_id", "tag.bin_start").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.max("timestamp").alias("last_txn"))
    rule, start = F.col("rule_id"), F.timestamp_seconds("bin_start")

    def message(text: str) -> Column:
        return F.format_string(text, F.col("account_id"), F.col("n"), F.col("amount"))

    return bins.filter(((rule == "RULE-001") & (F.col("n") >= 3)) | ((rule == "RULE-006") & (F.col("n") > 5))
                       | ((rule == "RULE-009") & (F.col("n") >= 7))).select(
        "rule_id",
        F.when(rule == "RULE-001", "STRUCTURING").when(rule == "RULE-006", "HIGH_VELOCITY").otherwise("SMURFING").alias("pattern_type"),
        F.when(rule == "RULE-006", "MEDIUM").otherwise("HIGH").alias("severity"), "account_id", "customer_id",
        nobody.alias("txn_id"), "amount",
        F.when(rule == "RULE-001", message(STRUCTURING_TEXT)).when(rule == "RULE-006", message(VELOCITY_TEXT))
        .otherwise(message(SMURFING_TEXT)).alias("alert_msg"),
        F.when(rule == "RULE-001", F.col("last_txn")).otherwise(start).alias("event_ts"))


def _row_hits(t: DataFrame, a: DataFrame, c: DataFrame) -> DataFrame:
    """Hits of the rules that look at one row, from one scan: idle owners and listed people are joined beside, then each row
    gives a hit per rule that fits it."""
    amount, hour = F.col("amount"), F.hour("timestamp")
    idle = a.filter(F.col("days_inactive") > 180).select("account_id", "days_inactive")
    rows = t.filter(amount > 5000).select("account_id", "customer_id", "txn_id", "amount", "txn_type", "timestamp")
    rows = rows.join(idle, "account_id", "left").join(_listed_people(c), "customer_id", "left")
    hits = F.array_compact(F.array(*[F.when(fits, F.struct(*[v.alias(k) for k, v in tags.items()])) for fits, tags in (
        ((amount > 50000) & F.col("days_inactive").isNotNull(), _dormant_tags()),
        ((F.col("txn_type") == "CASH_DEP") & (amount > 25000) & is_night(hour, 22, 5), _cash_night_tags(hour)),
        (_is_listed() | (_is_pep() & (amount > 100000)), _watchlist_tags()))]))
    return rows.withColumn("hit", F.explode(hits)).withColumn("event_ts", F.col("timestamp")).select(
        *[F.col(f"hit.{n}" if n in ("rule_id", "pattern_type", "severity", "alert_msg") else n).alias(n) for n in HIT_COLUMNS])


def all_rule_hits(t: DataFrame, a: DataFrame, c: DataFrame, as_of=None, lookback=None) -> DataFrame:
    """Hits of every transaction rule in one shape. The rules over bins share a scan and an aggregate, those that look at one
    row share another scan; layering and circular flows, a hit for
    every pair of legs, read the columns and rows they need. ``a`` and ``c`` hold a key once."""
    from .circular import rule_circular_flow
    from .layering import rule_layering_mule

    def shape(hits: DataFrame, amount: Column) -> DataFrame:
        built = {"amount": amount, "event_ts": F.lit(None).cast("timestamp")}
        for name in ("customer_id", "txn_id"):
            if name not in hits.columns:
                built[name] = F.lit(None).cast("string")
        return hits.select(*[built.get(n, F.col(n)).alias(n) for n in HIT_COLUMNS])

    now = recent(t, lookback, as_of)
    layering = rule_layering_mule(t, as_of=as_of, lookback=lookback)
    return _binned_hits(now).unionByName(_row_hits(now, a, c)).unionByName(
        shape(layering, F.col("total_in"))).unionByName(shape(rule_circular_flow(t, pairs=True), F.col("amount")))


def explain_rule(hits: DataFrame, r: DataFrame) -> DataFrame:
    """Hits with the catalogue's wording of why the rule exists."""
    return hits.join(r.select("rule_id", "condition_summary", "rationale"), "rule_id")
