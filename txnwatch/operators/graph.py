"""The money-flow graph as vertex and edge tables, and patterns over it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .flow import flow_features
from ..fixed import MONEY_IN, MONEY_OUT

_union = lambda parts: reduce(DataFrame.unionByName, parts)


def _vertices(df: DataFrame, key: str, kind: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.lit(kind).alias("type"))


def graph_vertices(a, c, t, f, w) -> DataFrame:
    return _union([
        _vertices(a, "account_id", "Account"), _vertices(c, "customer_id", "Customer"),
        _vertices(t, "txn_id", "Transaction"), _vertices(f, "flag_id", "SuspiciousEvent"),
        _vertices(w, "entry_id", "WatchlistEntry"),
    ])


def _edges(df: DataFrame, src: str, dst: str, kind: str) -> DataFrame:
    ends = df.filter(F.col(src).isNotNull() & F.col(dst).isNotNull())
    return ends.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.lit(kind).alias("edge"))


def edges_owns(a: DataFrame) -> DataFrame:
    return _edges(a, "customer_id", "account_id", "OWNS")


def edges_has(t: DataFrame) -> DataFrame:
    return _edges(t, "account_id", "txn_id", "HAS")


def edges_sends_to(t: DataFrame) -> DataFrame:
    return _edges(t, "txn_id", "counterparty_account", "SENDS_TO")


def edges_triggers(t: DataFrame, f: DataFrame) -> DataFrame:
    """Flags of known transactions."""
    return _edges(f.join(t.select("txn_id"), "txn_id", "left_semi"), "txn_id", "flag_id", "TRIGGERS")


def edges_matches(c: DataFrame, w: DataFrame) -> DataFrame:
    """Watchlist entries that name a customer."""
    named = w.join(c.select(F.col("customer_id").alias("entity_id")), "entity_id", "left_semi")
    return _edges(named, "entity_id", "entry_id", "MATCHES")


def graph_edges(a, c, t, f, w) -> DataFrame:
    return _union([edges_owns(a), edges_has(t), edges_sends_to(t), edges_triggers(t, f), edges_matches(c, w)])


def graph_mule_hubs(t: DataFrame, min_senders: int = 3, max_receivers: int = 3) -> DataFrame:
    """Accounts collecting from many and paying to few."""
    flow = flow_features(t)
    return flow.filter(
        (F.col("distinct_senders") >= min_senders) & F.col("distinct_receivers").between(1, max_receivers)
    ).select("account_id", "distinct_senders", "distinct_receivers", "total_in", "total_out")


def graph_pass_through(t: DataFrame, min_amount: float = 50000, min_ratio: float = 0.9) -> DataFrame:
    """Accounts where a large sum came in and nearly as much left on the same day."""
    into, out = F.col("txn_type").isin(MONEY_IN), F.col("txn_type").isin(MONEY_OUT)
    per_day = t.filter(into | out).groupBy("account_id", "txn_date").agg(
        F.sum(F.when(into, F.col("amount"))).alias("total_in"),
        F.sum(F.when(out, F.col("amount"))).alias("total_out"))
    return per_day.filter(
        (F.col("total_in") >= min_amount) & (F.col("total_out") >= F.col("total_in") * min_ratio))


def graph_watchlist_reach(t: DataFrame, a: DataFrame, c: DataFrame) -> DataFrame:
    """Accounts one transfer away from an account of a watchlisted customer, in either direction."""
    listed = c.filter(F.coalesce("watchlist_match", F.lit("NONE")) != "NONE").select("customer_id")
    watched = a.join(listed, "customer_id", "left_semi").select(F.col("account_id").alias("watched"))
    # parties of each transfer, once per pair of accounts
    pairs = t.filter(F.col("counterparty_account").isNotNull()).select(
        "account_id", "counterparty_account").distinct()
    ways = pairs.select(F.explode(F.array(
        F.struct(F.col("account_id").alias("account_id"), F.col("counterparty_account").alias("watched")),
        F.struct(F.col("counterparty_account").alias("account_id"), F.col("account_id").alias("watched")),
    )).alias("way")).select("way.*").distinct()
    return ways.join(watched, "watched", "left_semi").filter(F.col("account_id") != F.col("watched")).select(
        "account_id", "watched")
