"""Sharding by balanced label propagation, DataFrame functions only.

Documents with equal texts are linked. The link graph is a set of cliques, so what a document sees of its neighbours
is the histogram of its group over the shards. The state is one row per (group, shard) with a count: a step is a few
joins and aggregates over that table, and a group with a third of all documents is at most ``shards`` rows of it.

Each step every group prefers the shard that holds most of it among those with room; documents elsewhere ask to move
there, and a quota per shard (its even share minus the linked documents it holds, plus those that leave it in the same
step) decides what part of the asked moves is granted; steps go on until the number of documents apart from their group no
longer falls. Documents without links fill what is left. Sizes are made exact at the end: documents are laid out by shard
with linked ones in the middle, group by group, and cut into runs whose lengths differ by one at most. A border is crossed
by unlinked documents or, where those are too few, by one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import groups_for, staged


def unit(*cols: Column | str) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


def granted(asks: list[list[float]], room: list[float]) -> list[float]:
    """For every shard the part of the moves asked into it that can be granted at once: its room plus what leaves it by the
    grants of the others. ``asks[s][t]``: documents that ask to go from s to t. The largest such parts, found from above."""
    shards = range(len(room))
    inflow = [sum(asks[s][t] for s in shards) for t in shards]
    part = [1.0] * len(room)
    while True:
        outflow = [sum(asks[s][t] * part[t] for t in shards) for s in shards]
        new = [min(part[t], max(0.0, room[t] + outflow[t]) / inflow[t]) if inflow[t] > 0 else part[t] for t in shards]
        done = max(o - n for o, n in zip(part, new)) < 1e-6
        part = new
        if done:
            return part


def propagate(groups: DataFrame, n_rows: int, shards: int, patience: int = 4) -> DataFrame:
    """``groups``: one row per (grp, shard) with its count n. The same after balanced propagation, which ends when no
    document is apart from most of its group, or the number of those has not fallen for ``patience`` steps."""
    share = n_rows / shards
    lump = groups.groupBy("grp").agg(F.sum("n").alias("n")).where(F.col("n") <= share / 4).agg(F.max("n")).first()[0] or 0
    state, least, idle, turn = groups, None, 0, 0
    by_shard = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), F.col(at) + 1)
    while True:
        linked = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        left = [float(share - linked.get(s, 0)) for s in range(shards)]
        room = by_shard(left, "shard")
        # in turns: the fullest shard, which takes in what it gives up, and the fullest shard with room, to which groups also
        # flee from shards that hold too much; all shards with room are open to a group whose own shards have none
        swap = turn % 2 == 0
        open_shards = [s for s in range(shards) if left[s] >= 1]
        spare = F.element_at(F.array(*map(F.lit, open_shards)), (F.floor(unit("grp", F.lit(turn)) * len(open_shards)) + 1).cast(
            "int")) if open_shards else F.lit(None).cast("int")
        wanted = state.groupBy("grp").agg(
            F.max(F.when(F.lit(swap) | (room >= 1), F.struct("n", F.pmod(F.xxhash64("grp", "shard"), F.lit(1000)).alias("tie"), "shard"))).alias("best"),
            F.count(F.lit(1)).alias("spread"), F.max("n").alias("top"), F.sum("n").alias("all")).select(
                "grp", "all", F.coalesce("best.shard", spare).alias("to"), F.coalesce("best.n", F.lit(0)).alias("there"), "spread", "top")
        over = by_shard([max(0.0, -left[s]) / max(linked.get(s, 1), 1) for s in range(shards)], "shard")
        # groups of up to a quarter of a share stay, move and flee as one; of larger ones what is with most of them stays, and
        # only those that no shard can hold give way where a shard holds too much
        small = F.col("all") <= share / 4
        part = F.when(F.col("to").isNull() | (F.col("to") == F.col("shard")), 0.0).when(
            (F.col("spread") > 1) & (small | (F.col("n") <= F.col("there"))), 1.0).when(
            small | (F.col("all") > share), over).otherwise(0.0)
        asks = staged(state.join(wanted, "grp").withColumn("ask", part * F.col("n")), "asks")
        table = [[0.0] * shards for _ in range(shards)]
        apart = 0.0
        for r in asks.groupBy("shard", "to").agg(F.sum("ask").alias("a"), F.sum(F.col("n") - F.col("top") / F.col("spread")).alias("c")).collect():
            apart += r["c"]
            if r["to"] is not None:
                table[r["shard"]][r["to"]] += r["a"]
        apart = round(apart)
        idle = 0 if least is None or apart < least else idle + 1
        least = apart if least is None else min(least, apart)
        if not apart or idle >= patience:
            return state
        # linked documents may outgrow a share a little: groups lie side by side at the end, so a border cuts one at most
        slack = [share / 32 + lump if swap else lump if x >= 1 else 0.0 for x in left]
        quota = F.coalesce(by_shard(granted(table, [x + y for x, y in zip(left, slack)]), "to"), F.lit(0.0))
        moved = F.when(~small, F.least(F.ceil(F.col("ask") * quota), F.col("n"))).otherwise(
            F.when(unit("grp", F.lit(turn + 7)) < quota * F.col("ask") / F.col("n"), F.col("n")).otherwise(0))
        moves = asks.withColumn("moved", moved.cast("long"))
        state = staged(moves.select("grp", "shard", (F.col("n") - F.col("moved")).alias("n")).unionByName(
            moves.where("moved > 0").select("grp", F.col("to").alias("shard"), F.col("moved").alias("n"))).groupBy("grp", "shard").agg(
            F.sum("n").alias("n")).where("n > 0"), "state")
        turn += 1


def ranked(rows: DataFrame, keys: list[str], cells: Column, order: list[str], cell: Column | None = None) -> DataFrame:
    """``rows`` with ``rank``, their place from 0 among rows of equal keys, and ``position``, their place in the order of
    ``keys``.

    ``cells`` tells into how many cells, by a hash of ``order``, the rows of a key are dealt, if ``cell`` does not name the
    cell itself. The cells' counts are summed up in order, and only the rank within a cell needs its rows together. The keys
    have few values."""
    celled = rows.withColumn("cell", F.pmod(F.xxhash64(*order), cells).cast("int") if cell is None else cell)
    counts = celled.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("c"))
    blocks = counts.groupBy(*keys).agg(F.sum("c").alias("t"))
    above = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("base", F.coalesce(F.sum("t").over(above), F.lit(0))).drop("t")
    within = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("skip", F.coalesce(F.sum("c").over(within), F.lit(0))).drop("c").join(blocks, keys)
    own = Window.partitionBy(*keys, "cell").orderBy(*order)
    return celled.withColumn("n", F.row_number().over(own) - 1).join(counts, [*keys, "cell"]).withColumns({
        "rank": F.col("skip") + F.col("n"), "position": F.col("base") + F.col("skip") + F.col("n")}).drop("n", "base", "skip", "cell")


def shard_documents(docs: DataFrame, shards: int = 8, patience: int = 4, id_col: str = "doc_id", text_col: str = "text",
                    cell_rows: int = 4096) -> DataFrame:
    """One row per document: ``id_col``, size, text_crc32, law, shard, slot, grown_shard.

    Law ``rows``: the counts of any two shards differ by one at most. Documents with equal texts are linked, null texts
    with empty ones. A null text has size 1 and checksum 0. Null ids and repeated rows are documents like others. With
    fewer documents than shards some shards are empty; no documents give no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    nodes = staged(docs.select(
        F.col(id_col).alias("doc"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("grp")).withColumn("uid", F.monotonically_increasing_id()), "nodes")
    n_rows = nodes.count()
    first = F.floor(unit("uid", "grp") * shards).cast("int")
    copies = nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    start = nodes.join(copies.select("grp"), "grp", "left_semi").groupBy("grp", first.alias("shard")).agg(
        F.count(F.lit(1)).alias("n"))
    state = propagate(staged(start, "start"), n_rows, shards, patience)

    # a group's shares as running fractions; a document falls in one of them by a hash of its own
    parts = state.groupBy("grp").agg(F.sum("n").alias("all"), F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("by"))
    zero = F.struct(F.lit(0).cast("long").alias("up"), F.array().cast("array<struct<top:double,shard:int>>").alias("tops"))
    tops = F.aggregate("by", zero, lambda s, x: F.struct((s["up"] + x["n"]).alias("up"), F.concat(s["tops"], F.array(F.struct(
        ((s["up"] + x["n"]) / F.col("all")).alias("top"), x["shard"].alias("shard")))).alias("tops")), lambda s: s["tops"])
    parts = parts.select("grp", "all", tops.alias("tops"))
    linked = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    free = [max(0.0, n_rows / shards - linked.get(s, 0)) for s in range(shards)]
    total, up, bounds = sum(free) or 1.0, 0.0, []
    for x in free:
        up += x / total
        bounds.append(up)
    u = unit("uid", F.lit(3))
    alone = sum((F.when(u >= b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    mine = F.element_at(F.filter("tops", lambda x: (x["top"] > unit("uid", F.lit(5))) | (x["top"] >= 1)), 1)["shard"]
    labelled = nodes.join(parts, "grp", "left").select(
        "doc", "size", "crc", "uid", "grp", F.coalesce(mine, alone).cast("int").alias("label"), F.coalesce("all", F.lit(1)).alias("all"),
        F.when(F.col("tops").isNotNull(), 1).when(unit("uid", F.lit(9)) < 0.5, 0).otherwise(2).alias("section"))
    # a group has a cell to itself or shares one with others; only a group larger than a cell is dealt into several
    cells = groups_for(n_rows, cell_rows)
    cell = F.struct(F.pmod(F.xxhash64("grp"), F.lit(cells)).alias("hash"), F.when(F.col("all") > cell_rows, F.col("grp")).alias("large"),
                    F.when(F.col("all") > cell_rows, F.pmod(F.xxhash64("uid"), F.ceil(F.col("all") / cell_rows))).alias("deal"))
    laid = ranked(labelled, ["label", "section"], F.lit(cells), ["grp", "uid"], cell)
    small, larger = divmod(n_rows, shards)
    border = larger * (small + 1)
    pos = F.col("position")
    shard = F.when(pos < border, F.floor(pos / (small + 1))).otherwise(F.floor((pos - border) / max(small, 1)) + larger)
    begin = F.when(pos < border, shard * (small + 1)).otherwise(border + (shard - larger) * small)
    return laid.select(
        F.col("doc").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        (pos - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "grp")
