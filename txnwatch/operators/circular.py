"""Round-tripping: a large wire from A to B answered 30 to 365 days later.

The two legs meet on (A, B). The day range is cut into blocks and the amounts into octaves, and both join the key, so one
busy pair of accounts is spread over many tasks. The result has one row per first leg, with the number of its answers and the
earliest one, and no pair of legs is ever formed: a task sorts the answers of one key by time and by amount, and a rank
index over both counts those within a leg's days and amounts. Keys with more than ``LIMIT`` answers are split; counts add up
and the earliest of the earliest is the earliest. With ``pairs`` every answer of a leg gets a row of its own: legs that were
found to have answers meet them in a join on the same key.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..fixed import WIRES
from ..functions.columns import floor_div, recent
from ..functions.ranges import count_and_first, first_true

BLOCK_DAYS = 112
LIMIT = 200_000
DAY_MICROS = 86_400_000_000
KEYS = ["a", "b", "block", "octave", "chunk"]
ANSWER = "struct<at:timestamp,amount:double,customer:string,country:string,account:string,sender:string,txn_id:string>"


def _day(ts: Column) -> Column:
    return F.datediff(ts, F.lit("1970-01-01").cast("date")).cast("long")


def _large_wires(t: DataFrame, min_amount, types=WIRES) -> DataFrame:
    return t.filter(F.col("txn_type").isin(types) & (F.col("amount") > min_amount))


def _octave(amount: Column) -> Column:
    return F.floor(F.log2(amount)).cast("int")


def _first_legs(legs: DataFrame, day: str, amount: str, days, ratio) -> DataFrame:
    """One row per block of days and octave of amounts in which an answer could lie. ``ratio`` bounds answer
    over amount before rounding."""
    blocks = F.sequence(
        floor_div(F.col(day) + F.lit(days[0]), BLOCK_DAYS), floor_div(F.col(day) + F.lit(days[1]), BLOCK_DAYS))
    low, high = max(ratio[0] - 0.01, 1e-6), ratio[1] + 0.01
    octaves = F.sequence(_octave(F.col(amount) * low), _octave(F.col(amount) * high))
    return legs.withColumn("block", F.explode(blocks)).withColumn("octave", F.explode(octaves))


def _answers(legs: DataFrame, day: str, amount: str) -> DataFrame:
    return legs.withColumns({"block2": floor_div(F.col(day), BLOCK_DAYS), "octave2": _octave(F.col(amount))})


def _bounds(ratio, digits: int) -> tuple[float, float]:
    """What rounds into ``ratio``: from the first number to below the second."""
    half = Decimal(5).scaleb(-digits - 1)
    return float(Decimal(str(ratio[0])) - half), float(Decimal(str(ratio[1])) + half)


def find_answers(first: DataFrame, second: DataFrame, days, ratio, factor: float, digits: int, need_customer: bool = True,
                 limit: int | None = None) -> DataFrame:
    """For each first leg with answers: ``leg``, ``n_answers`` and ``answer``, the earliest (ties: least amount, customer, ...).

    ``first`` has leg, a, b, customer, at, amount; ``second`` answers from b to a with ``info``, the struct of ``ANSWER``. An
    answer is later, ``days`` away, of another customer (``need_customer`` false: or of an unnamed one), and
    round(factor * its amount / amount, digits) lies within ``ratio``.
    """
    first = first.withColumn("day", _day(F.col("at")))
    spread = _first_legs(first, "day", "amount", days, (ratio[0] / factor, ratio[1] / factor)).drop("day")
    back = second.select("a", "b", "info", floor_div(_day(F.col("info.at")), BLOCK_DAYS).alias("block"),
                         _octave(F.col("info.amount")).alias("octave"))
    key = KEYS[:-1]
    sizes = back.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / (limit or LIMIT)).cast("int").alias("chunks"))
    spread = spread.join(sizes, key).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    several = sizes.where("chunks > 1").withColumnsRenamed({k: f"_{k}" for k in key})  # at most one per ``limit`` answers
    met = back.join(several, [F.col(k) == F.col(f"_{k}") for k in key], "left")
    back = met.select(*key, "info", F.coalesce(F.pmod(F.xxhash64("info"), F.col("chunks")), F.lit(0)).cast("int").alias("chunk"))
    low, high = _bounds(ratio, digits)

    def look(legs, answers):
        import pyarrow as pa

        fields = [(f.name, f.type) for f in answers.schema.field("info").type]
        out_type = pa.schema([("leg", pa.string()), ("n_answers", pa.int64()), ("answer", pa.struct(fields))])
        if not answers.num_rows or not legs.num_rows:
            return out_type.empty_table()
        info = _sorted(answers.column("info").combine_chunks())
        at = info.field("at").cast(pa.int64()).to_numpy(zero_copy_only=False)
        amount, customer = info.field("amount").to_numpy(zero_copy_only=False), np.array(info.field("customer").to_pylist(), object)
        t = legs.column("at").cast(pa.int64()).to_numpy()
        size, own = legs.column("amount").to_numpy(), np.array(legs.column("customer").to_pylist(), object)
        day = t // DAY_MICROS
        start, stop = np.maximum(t + 1, (day + days[0]) * DAY_MICROS), (day + days[1] + 1) * DAY_MICROS
        n, first_of = np.zeros(len(t), np.int64), np.full(len(t), -1)
        named = np.array([c is not None for c in customer], bool)
        shared = set(customer[named]) & set(own)
        kinds = np.array([-1 if c is None else 1 if c in shared else 0 for c in own])
        # who asks, and which answers may count for them: legs of customers that answer nothing here share one index
        asked = [(kinds == 0, named if need_customer else np.ones(len(at), bool))]
        asked += [(own == c, (customer != c) & (named | (not need_customer))) for c in sorted(shared)]
        if not need_customer:
            asked.append((kinds == -1, ~named))
        for who, which in asked:
            q, p = np.flatnonzero(who), np.flatnonzero(which)
            if not len(q) or not len(p):
                continue
            order = np.argsort(amount[p], kind="stable")
            ascending, mine = amount[p][order], size[q]
            ratio_at = lambda k: ascending[k] * factor / mine  # noqa: B023, E731
            lo = first_true(len(p), lambda k: ratio_at(k) >= low, len(q))  # noqa: B023
            hi = first_true(len(p), lambda k: ratio_at(k) >= high, len(q))  # noqa: B023
            n[q], found = count_and_first(at[p], order, start[q], stop[q], lo, hi)
            first_of[q] = np.where(found >= 0, p[np.maximum(found, 0)], -1)
        hit = np.flatnonzero(n)
        return pa.Table.from_arrays([legs.column("leg").take(pa.array(hit)), pa.array(n[hit]), info.take(pa.array(first_of[hit]))],
                                    schema=out_type)

    found = spread.select(*KEYS, "leg", "customer", "at", "amount").groupBy(*KEYS).cogroup(back.groupBy(*KEYS)).applyInArrow(
        look, f"leg string, n_answers long, answer {ANSWER}")
    return merge_answers(found)


def list_answers(legs: DataFrame, second: DataFrame, days, ratio, factor: float, digits: int, need_customer: bool = True) -> DataFrame:
    """The rows of ``legs`` (as ``first`` of ``find_answers``, with whatever columns beside) once per answer, as ``answer``."""
    spread = _first_legs(legs.withColumn("day", _day(F.col("at"))), "day", "amount", days, (ratio[0] / factor, ratio[1] / factor))
    back = second.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("info").alias("answer"),
                         floor_div(_day(F.col("info.at")), BLOCK_DAYS).alias("block2"), _octave(F.col("info.amount")).alias("octave2"))
    other = F.col("customer") != F.col("answer.customer")
    if not need_customer:
        other = other | F.col("answer.customer").isNull()
    size = F.col("answer.amount") * factor / F.col("amount")
    low, high = _bounds(ratio, digits)
    met = spread.join(
        back,
        (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")) & (F.col("block") == F.col("block2"))
        & (F.col("octave") == F.col("octave2")) & (F.col("answer.at") > F.col("at")) & other
        & (_day(F.col("answer.at")) - F.col("day")).between(*days) & (size >= low) & (size < high))
    return met.select(*legs.columns, "answer")


def _with_counts(legs: DataFrame, found: DataFrame) -> DataFrame:
    """The legs that have answers, with their number."""
    counts = found.select(F.col("leg").alias("_leg"), "n_answers")
    return legs.join(counts, F.col("leg").eqNullSafe(F.col("_leg"))).drop("_leg")


def _sorted(info):
    """The answers by time, then by the other fields, nulls first as in Spark."""
    import pyarrow as pa
    import pyarrow.compute as pc

    names = [f.name for f in info.type]
    table = pa.Table.from_arrays([info.field(k) for k in range(len(names))], names=names)
    order = pc.sort_indices(table, sort_keys=[(name, "ascending") for name in names], null_placement="at_start")
    return pa.StructArray.from_arrays([c.combine_chunks() for c in table.take(order).columns], names)


def merge_answers(found: DataFrame, *also: str) -> DataFrame:
    """Counts of parts of the answers put together."""
    return found.groupBy("leg", *also).agg(F.sum("n_answers").alias("n_answers"), F.min("answer").alias("answer"))


def _info(at: str, customer, country, account: str, sender: str) -> Column:
    return F.struct(F.col(at).alias("at"), F.col("amount"), customer.cast("string").alias("customer"), country.cast("string").alias("country"),
                    F.col(account).alias("account"), F.col(sender).alias("sender"), F.col("txn_id")).alias("info")


def rule_circular_flow(
    t: DataFrame, min_amount=200000, days=(30, 365), pct=(70, 130), critical=1000000, as_of=None, lookback=None,
    ts: str = "timestamp", pairs: bool = False,
) -> DataFrame:
    """Any large wire of A with B that has an answer, any of B with A by a different customer: one row, with the number of
    answers and the earliest; with ``pairs`` one row for each answer. Rows without an id are told apart by nothing else, so ids
    have to be unique."""
    wires = recent(t, lookback, as_of, ts)
    found = circular_answers(wires, wires, min_amount, days, pct, ts)
    if not pairs:
        return describe_circles(wires, found, min_amount, critical, ts)
    legs = _with_counts(rule_legs(wires, min_amount, ts), found)
    return _described(list_answers(legs, _rule_answers(wires, min_amount, ts), days, pct, 100.0, 1), critical)


def rule_legs(t: DataFrame, min_amount=200000, ts: str = "timestamp") -> DataFrame:
    """First legs of the rule, ``leg`` being the txn_id."""
    return _large_wires(t, min_amount).select(
        F.col("txn_id").alias("leg"), F.col("account_id").alias("a"), F.col("counterparty_account").alias("b"),
        F.col("customer_id").alias("customer"), F.col(ts).alias("at"), "amount", "country")


def _rule_answers(t: DataFrame, min_amount, ts: str) -> DataFrame:
    return _large_wires(t, min_amount).select(
        F.col("counterparty_account").alias("a"), F.col("account_id").alias("b"),
        _info(ts, F.col("customer_id"), F.col("country"), "account_id", "counterparty_account"))


def circular_answers(
    first_legs: DataFrame, second_legs: DataFrame, min_amount=200000, days=(30, 365), pct=(70, 130), ts: str = "timestamp",
) -> DataFrame:
    """The answers of the rule, ``leg`` being the txn_id of the first one; both legs may come from different tables. Counts of
    parts of either table add up (``merge_answers``)."""
    first = rule_legs(first_legs, min_amount, ts).drop("country")
    return find_answers(first, _rule_answers(second_legs, min_amount, ts), days, pct, 100.0, 1)


def circular_pairs(
    first_legs: DataFrame, second_legs: DataFrame, min_amount=200000, days=(30, 365), pct=(70, 130), ts: str = "timestamp",
) -> DataFrame:
    """The same with a row for every answer. Pairs of parts of either table are all pairs, once each."""
    return list_answers(rule_legs(first_legs, min_amount, ts), _rule_answers(second_legs, min_amount, ts), days, pct, 100.0, 1)


def describe_circles(t: DataFrame, found: DataFrame, min_amount=200000, critical=1000000, ts: str = "timestamp") -> DataFrame:
    """First legs with what was found for them, as the rule reports it."""
    return _described(rule_legs(t, min_amount, ts).join(found, "leg"), critical)


def describe_pairs(pairs: DataFrame, found: DataFrame, critical=1000000) -> DataFrame:
    """Pairs of ``circular_pairs`` with the number of answers of their first legs, as the rule reports them."""
    return _described(_with_counts(pairs, found), critical)


def _described(legs: DataFrame, critical) -> DataFrame:
    gap = _day(F.col("answer.at")) - _day(F.col("at"))
    return legs.select(
        F.col("a").alias("account_id"), F.col("customer").alias("customer_id"), F.col("b").alias("counterparty_account"),
        F.col("answer.customer").alias("customer_id2"), "amount", F.col("answer.amount").alias("amount2"),
        F.round(F.col("answer.amount") * 100.0 / F.col("amount"), 1).alias("return_ratio"), gap.cast("int").alias("days_gap"),
        "country", F.col("answer.country").alias("country2"), "n_answers", F.col("leg").alias("txn_id"),
        F.lit("CIRCULAR_FLOW").alias("pattern_type"), F.lit("RULE-011").alias("rule_id"),
        F.when(F.col("amount") > critical, "CRITICAL").otherwise("HIGH").alias("severity"),
        F.format_string(
            "ROUND-TRIP: %s (%s) sent %.2f -> got back %.2f from different customer %s in %d days",
            F.col("a"), F.col("customer"), F.col("amount"), F.col("answer.amount"), F.col("answer.customer"),
            gap).alias("alert_msg"),
    )


_OUT = {"account_id": "sender", "customer_id": "sender_cust", "counterparty_account": "receiver",
        "amount": "out_amount", "txn_timestamp": "out_time", "txn_id": "out_txn_id"}
_BACK = {"account_id": "recv_acct", "customer_id": "recv_cust", "counterparty_account": "from_acct",
         "amount": "in_amount", "txn_timestamp": "in_time", "txn_id": "in_txn_id"}


def _out_legs(g: DataFrame, min_amount) -> DataFrame:
    legs = _large_wires(g, min_amount, ["WIRE_OUT"])
    return legs.select(*[F.col(k).alias(v) for k, v in _OUT.items()]).withColumn("out_day", _day(F.col("out_time")))


def _back_legs(g: DataFrame, min_amount, mode: str) -> DataFrame:
    """Legs that answer. ``reference``: B's WIRE_IN from A. ``return``: B's WIRE_OUT to A, or A's WIRE_IN
    from B, written from B's side."""
    if mode == "reference":
        legs = _large_wires(g, min_amount, ["WIRE_IN"])
        legs = legs.select(*[F.col(k).alias(v) for k, v in _BACK.items()])
    else:
        sent = _large_wires(g, min_amount, ["WIRE_OUT"]).select(*[F.col(k).alias(v) for k, v in _BACK.items()])
        swapped = {**_BACK, "account_id": "from_acct", "counterparty_account": "recv_acct", "customer_id": None}
        received = _large_wires(g, min_amount, ["WIRE_IN"]).select(
            *[F.col(k).alias(v) for k, v in swapped.items() if v], F.lit(None).cast("string").alias("recv_cust"))
        legs = sent.unionByName(received)
    return legs.withColumn("in_day", _day(F.col("in_time")))


def _is_circle(days, ratio, need_customer: bool) -> Column:
    other = F.col("sender_cust") != F.col("recv_cust")
    if not need_customer:  # the receiving side's own row may name no customer for B
        other = other | F.col("recv_cust").isNull()
    return (
        (F.col("sender") == F.col("from_acct"))
        & (F.col("receiver") == F.col("recv_acct"))
        & (F.col("block") == F.col("block2"))
        & (F.col("octave") == F.col("octave2"))
        & (F.col("in_time") > F.col("out_time"))
        & other
        & (F.col("in_day") - F.col("out_day")).between(*days)
        & F.round(F.col("in_amount") / F.col("out_amount"), 2).between(*ratio)
    )


def circular_flow_nb(
    g: DataFrame, min_amount=200000, days=(30, 365), ratio=(0.7, 1.3), mode="reference", pairs: bool = False,
) -> DataFrame:
    """A's WIRE_OUT to B that was answered, once each, with the number of answers and the earliest of them; with ``pairs`` once
    for each answer."""
    legs = _out_legs(g, min_amount)
    first = legs.select(F.col("out_txn_id").alias("leg"), F.col("sender").alias("a"), F.col("receiver").alias("b"),
                        F.col("sender_cust").alias("customer"), F.col("out_time").alias("at"), F.col("out_amount").alias("amount"))
    back = _back_legs(g, min_amount, mode).withColumnsRenamed({"in_amount": "amount", "in_txn_id": "txn_id"})
    second = back.select(F.col("from_acct").alias("a"), F.col("recv_acct").alias("b"),
                         _info("in_time", F.col("recv_cust"), F.lit(None), "recv_acct", "from_acct"))
    found = find_answers(first, second, days, ratio, 1.0, 2, mode == "reference")
    if pairs:
        rows = list_answers(_with_counts(first, found), second, days, ratio, 1.0, 2, mode == "reference")
    else:
        rows = first.join(found, "leg")
    out = {"a": "sender", "customer": "sender_cust", "b": "receiver", "amount": "out_amount", "at": "out_time", "leg": "out_txn_id"}
    of = {"account": "recv_acct", "customer": "recv_cust", "sender": "from_acct", "amount": "in_amount", "at": "in_time", "txn_id": "in_txn_id"}
    return rows.select(
        *[F.col(k).alias(v) for k, v in out.items()], *[F.col(f"answer.{k}").alias(v) for k, v in of.items()],
        (_day(F.col("answer.at")) - _day(F.col("at"))).cast("int").alias("days_gap"),
        F.round(F.col("answer.amount") / F.col("amount"), 2).alias("return_ratio"), "n_answers")


def circular_out_legs(g: DataFrame, min_amount=200000, days=(30, 365), ratio=(0.7, 1.3), mode="reference") -> DataFrame:
    """The outgoing legs that have an answer, once each. No pair is formed: a semi-join stops at the first
    answer, and answers that no leg can tell apart (same parties, day and amount) are merged beforehand."""
    out = _first_legs(_out_legs(g, min_amount), "out_day", "out_amount", days, ratio)
    back = _answers(_back_legs(g, min_amount, mode), "in_day", "in_amount")
    back = back.groupBy("recv_acct", "recv_cust", "from_acct", "in_amount", "in_day", "block2", "octave2").agg(
        F.max("in_time").alias("in_time"))
    found = out.join(back, _is_circle(days, ratio, mode == "reference"), "left_semi")
    return found.drop("block", "octave", "out_day").dropDuplicates(["out_txn_id"])
