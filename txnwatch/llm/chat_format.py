"""Chat formatting in budgeted windows, DataFrame functions only.

Every turn has a token cost. The running sum of costs in a conversation puts a turn in span ``before div budget``, so
spans end between turns. Each span becomes one training example: the conversation's system turn, the last turns of the
span before within ``history`` tokens, then the span's own turns. Loss covers the assistant texts of the span's own
turns only; a repeated turn is context.

Template: ``<s>role\\ntext</s>`` per turn. ``&``, ``<`` and ``[`` in texts, and line ends in roles, are written as
character references, so no text can hold a mark and every text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import staged

# What stands for the characters the template reserves; "&" comes first and is undone last
REFERENCES = {"&": "&amp;", "<": "&lt;", "[": "&#91;"}
ROLE_REFERENCES = {**REFERENCES, "\n": "&#10;"}
OPEN, CLOSE = "<s>", "</s>"
WORD = r"[^\x20\x09-\x0D]+"


def escape(text: Column, references: dict[str, str] = REFERENCES) -> Column:
    for plain, written in references.items():
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, references: dict[str, str] = REFERENCES) -> Column:
    for plain, written in reversed(references.items()):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def prefix_sums(turns: DataFrame, block_bits: int = 6) -> DataFrame:
    """``before``: cost of all earlier turns of the conversation, ``place``: how many there are.

    Sums are taken within blocks of 64 turn numbers and then over blocks, and over blocks of blocks, so that a
    conversation with a third of all turns is spread over many tasks.
    """
    keyed = turns.withColumns({
        f"b{level}": F.shiftright(F.coalesce("turn", F.lit(-(1 << 62))), level * block_bits) for level in (1, 2)})
    inner = Window.partitionBy("conv_id", "b1").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.withColumns({"in_cost": F.coalesce(F.sum("cost").over(inner), F.lit(0)),
                              "in_rows": F.count(F.lit(1)).over(inner)})
    small = keyed.groupBy("conv_id", "b2", "b1").agg(F.sum("cost").alias("c"), F.count(F.lit(1)).alias("n"))
    middle = Window.partitionBy("conv_id", "b2").orderBy("b1").rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumns({"m_cost": F.coalesce(F.sum("c").over(middle), F.lit(0)),
                               "m_rows": F.coalesce(F.sum("n").over(middle), F.lit(0))})
    large = small.groupBy("conv_id", "b2").agg(F.sum("c").alias("c2"), F.sum("n").alias("n2"))
    outer = Window.partitionBy("conv_id").orderBy("b2").rowsBetween(Window.unboundedPreceding, -1)
    large = large.withColumns({"o_cost": F.coalesce(F.sum("c2").over(outer), F.lit(0)),
                               "o_rows": F.coalesce(F.sum("n2").over(outer), F.lit(0))})
    starts = _join(small, large.drop("c2", "n2"), "conv_id", "b2").select(
        "conv_id", "b1", (F.col("m_cost") + F.col("o_cost")).alias("s_cost"), (F.col("m_rows") + F.col("o_rows")).alias("s_rows"))
    return _join(rows, starts, "conv_id", "b1").withColumns({
        "before": F.col("in_cost") + F.col("s_cost"), "place": F.col("in_rows") + F.col("s_rows")}).drop(
        "in_cost", "in_rows", "s_cost", "s_rows", "b1", "b2")


def _join(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join in which null keys meet."""
    r = right.withColumnsRenamed({k: f"r_{k}" for k in keys})
    on = [left[k].eqNullSafe(r[f"r_{k}"]) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(r, cond).drop(*[f"r_{k}" for k in keys])


def chat_windows(conversations: DataFrame, budget: int = 512, history: int = 64, overhead: int = 4) -> DataFrame:
    """Training examples: conv_id, span, n_own, n_context, ``text`` and ``loss``, the [start, end) code points of text
    under the loss mask, as an array of structs.

    A turn costs its words plus ``overhead``. A turn longer than the budget is an example of its own and stays whole.
    Null texts and roles are empty; rows with a null conv_id form one conversation; a null turn comes first; rows with
    equal turn numbers go by role, then text, and repeated rows are turns of their own. Only the four named columns of
    the input are read. No rows give no examples. Turn numbers need not be gapless.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.withColumn("cost", F.regexp_count("text", F.lit(WORD)).cast("long") + overhead)
    turns = staged(prefix_sums(turns).withColumn("span", F.floor(F.col("before") / budget)), "turns")

    # history: what lies within reach of the start of the next span of the conversation
    ends = turns.groupBy("conv_id", "span").agg(F.max(F.col("before") + F.col("cost")).alias("end"))
    carried = _join(turns, ends, "conv_id", "span").where(F.col("end") - F.col("before") <= history)
    follows = ends.select("conv_id", F.col("end").alias("begin")).join(
        turns.select(F.col("conv_id").alias("c"), F.col("before").alias("b"), F.col("span").alias("next")),
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("begin") == F.col("b"))).select("conv_id", "begin", "next")
    context = carried.join(follows.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")) & (
        F.col("end") == F.col("begin"))).where(~((F.col("place") == 0) & (F.col("role") == "system")))
    context = context.select("conv_id", F.col("next").alias("span"), "place", "role", "text", F.lit(False).alias("own"))

    system = turns.where("place = 0 and role = 'system'")
    later = ends.where("span > 0").select("conv_id", "span").join(
        system.select(F.col("conv_id").alias("c"), "place", "role", "text", F.col("span").alias("first")),
        F.col("conv_id").eqNullSafe(F.col("c"))).where("span > first").select(
        "conv_id", "span", "place", "role", "text", F.lit(False).alias("own"))
    own = turns.select("conv_id", "span", "place", "role", "text", F.lit(True).alias("own"))

    parts = own.unionByName(context).unionByName(later)
    body = escape(F.col("text"))
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_REFERENCES), F.lit("\n"))
    parts = parts.select(
        "conv_id", "span", "own", F.struct("place", "own", "role", head.alias("head"), body.alias("body")).alias("part"))
    grouped = parts.groupBy("conv_id", "span").agg(
        F.array_sort(F.collect_list("part")).alias("parts"), F.count(F.when(F.col("own"), 1)).alias("n_own"),
        F.count(F.when(~F.col("own"), 1)).alias("n_context"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["head"])
        end = start + F.length(part["body"])
        under = part["own"] & (part["role"] == "assistant")
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(CLOSE)).alias("at"), F.when(under, F.concat(state["loss"], span)).otherwise(
            state["loss"]).alias("loss"))

    return grouped.select(
        "conv_id", "span", "n_own", "n_context",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("text"),
        F.aggregate("parts", zero, step, lambda s: s["loss"]).alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """The turns of each example from its text alone: conv_id, span, n_context, turns (array of role, text)."""
    marked = F.filter(F.split("text", CLOSE, -1), lambda x: F.length(x) > 0)
    turn = lambda x: F.struct(
        unescape(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), "\n", 1), ROLE_REFERENCES).alias("role"),
        unescape(F.substr(x, _after(x))).alias("text"))
    return windows.withColumn("turns", F.transform(marked, turn))


def _after(x: Column) -> Column:
    """The place after the first line end, where the text of a turn starts."""
    return F.length(F.substring_index(x, "\n", 1)) + F.lit(2)


def digest(windows: DataFrame) -> DataFrame:
    """What a conversation's examples hold, read back from their texts and loss spans: one row per conversation."""
    back = read_back(windows)
    masked = F.transform("loss", lambda s: unescape(F.substr(F.col("text"), (s["start"] + 1).cast("int"), (
        s["end"] - s["start"]).cast("int"))))
    own = F.slice("turns", (F.col("n_context") + 1).cast("int"), F.greatest(F.size("turns"), F.lit(1)))
    each = back.select("conv_id", F.length("text").cast("long").alias("chars"), F.struct(
        "span", F.array_join(F.transform(own, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias(
            "turns"), F.array_join(masked, "").alias("loss"), "n_own").alias("piece"))
    per = each.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("piece")).alias("pieces"), F.sum("chars").alias("formatted_chars"))
    whole = lambda field: F.array_join(F.transform("pieces", lambda p: p[field]), "")
    return per.select(
        "conv_id", F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["n_own"]).alias("n_turns"),
        F.sha2(whole("turns"), 256).alias("turns_sha256"), F.length(whole("loss")).cast("long").alias("loss_chars"),
        F.sha2(whole("loss"), 256).alias("loss_sha256"), "formatted_chars")
