"""Balanced label propagation: documents that are linked move to one shard, sizes stay even.

Links are groups (a document names its group, here the digest of its text; all
documents of a group are linked with each other). Documents are first
dealt out in the order of a hash, which fills every shard to its quota. In each
round a document wants to go to the shard that holds most of its neighbours and
could take them; the moves granted between shards (swaps among them) obey the row quotas, so that all shards end with row counts that differ
by one at most. Documents without links have no neighbours: they make room and
fill what the linked ones leave.

Documents of one group have the same neighbours, so the state of the
propagation is one row per (group, shard) with a count, pre-aggregated on the
map side: a group with a third of all rows is ``shards`` rows. No pair of
documents is ever written down. A group larger than a shard gets as many home
shards as it needs. Which moves are granted is decided from the shards x shards
matrix of wishes (the only thing the driver sees); inside one cell the largest
gains go first.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weeklens.llm.common import column, number_within, stage

SHARDS = 40
ROUNDS = 12


def _pick(values, index: Column) -> Column:
    """values[index] for a short list indexed by a shard number."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), index + 1)


def granted_moves(wishes: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Largest moves (elementwise at most ``wishes``) after which no shard exceeds its room.

    Arrivals into overfull shards are cut: first those from shards that can keep them, then larger cells first,
    and last those that come from a shard which is over its quota already (negative room), so that it can
    empty. A cut arrival stays where it was, which may overfill that shard, so this goes on until all fit or
    nothing is left to cut: a shard with negative room that its departures do not empty gets no arrivals. It
    ends as every step but the last grants less.
    """
    moves = wishes.copy()
    crowded = np.asarray(room) < 0

    def take(j, i, amount):
        amount = min(amount, int(moves[i, j]))
        moves[i, j] -= amount
        over[i] += amount
        over[j] -= amount

    while True:
        granted = int(moves.sum())
        over = moves.sum(axis=0) - moves.sum(axis=1) - room
        for j in np.flatnonzero(over > 0):
            for i in np.argsort(over, kind="stable"):
                if over[i] < 0 < over[j]:
                    take(j, i, min(int(over[j]), -int(over[i])))
            for origins in (np.flatnonzero(~crowded), np.flatnonzero(crowded)):
                cells = moves[origins, j]
                part = min(max(0, int(over[j])), int(cells.sum()))
                if not part:
                    continue
                for i, share in zip(origins, cells * part // int(cells.sum())):
                    take(j, i, int(share))
                    part -= int(share)
                for i in origins[np.argsort(-moves[origins, j], kind="stable")]:
                    share = min(part, int(moves[i, j]))
                    take(j, i, share)
                    part -= share
        if int(moves.sum()) == granted:
            return moves


def _staying(state: DataFrame, largest: int) -> dict:
    """Documents per shard that have no better place: a group's largest part, or as many of its parts as it
    needs shards."""
    group = Window.partitionBy("g")
    s = (state.withColumn("parts", F.ceil(F.sum("n").over(group) / max(1, largest)))
         .withColumn("rank", F.row_number().over(group.orderBy(F.desc("n"), F.xxhash64("g", "shard")))))
    return {r.shard: r.n for r in s.filter("rank <= parts").groupBy("shard").agg(F.sum("n").alias("n")).collect()}


def _wishes(state: DataFrame, room) -> DataFrame:
    """(g, i, j, x, gain): x documents of group g want to go from shard i to j, where shard j could take
    ``room[j]`` more besides those that stay there."""
    group = Window.partitionBy("g")
    free = F.greatest(_pick(room, F.col("shard")), F.lit(0))
    s = (state.withColumn("total", F.sum("n").over(group))
         .withColumn("could", F.least("total", F.col("n") + free))
         .withColumn("rank", F.row_number().over(group.orderBy(F.desc("could"), F.desc("n"),
                                                               F.xxhash64("g", "shard")))))
    earlier = group.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("before", F.coalesce(F.sum("could").over(earlier), F.lit(0)))
    s = s.withColumn("home", F.col("before") < F.col("total"))
    s = s.withColumn("spare", F.when(F.col("home"), F.greatest(
        F.least("could", F.col("total") - F.col("before")) - F.col("n"), F.lit(0))).otherwise(0))
    s = s.withColumn("moving", F.when(F.col("home"), 0).otherwise(F.col("n")))
    s = (s.withColumn("s0", F.coalesce(F.sum("spare").over(earlier), F.lit(0)))
         .withColumn("m0", F.coalesce(F.sum("moving").over(earlier), F.lit(0))))
    to = s.filter("spare > 0").select("g", F.col("shard").alias("j"), F.col("n").alias("nj"), "s0",
                                      (F.col("s0") + F.col("spare")).alias("s1"))
    away = s.filter("moving > 0").select("g", F.col("shard").alias("i"), F.col("n").alias("ni"), "m0",
                                         (F.col("m0") + F.col("moving")).alias("m1"))
    # at most shards rows of a group on either side
    x = F.least("s1", "m1") - F.greatest("s0", "m0")
    return (to.join(away, "g").withColumn("x", x).filter("x > 0")
            .select("g", "i", "j", "x", (F.col("nj") + 1 - F.col("ni")).alias("gain")))


def evened(state: DataFrame, room: np.ndarray) -> DataFrame:
    """``state`` with what overfull shards (negative room) hold beyond their quota dealt out to shards with
    room, the least linked parts first. Without room for all, the last ones stay."""
    excess, free = np.maximum(-room, 0), np.maximum(room, 0)
    start, ends = np.cumsum(excess) - excess, np.cumsum(free)
    # the parts that leave and the free places lie on one line; where they meet, a part finds its new shard
    places = F.array(*[F.struct(F.lit(i).alias("j"), F.lit(int(e - f)).alias("a"), F.lit(int(e)).alias("b"))
                       for i, (e, f) in enumerate(zip(ends, free))])
    line = Window.partitionBy("shard").orderBy("n", F.xxhash64("g"), "g").rowsBetween(Window.unboundedPreceding, -1)
    over = state.filter(_pick(excess, F.col("shard")) > 0)
    away = (over.withColumn("a", F.coalesce(F.sum("n").over(line), F.lit(0)))
            .withColumn("b", F.least(F.col("a") + F.col("n"), _pick(excess, F.col("shard")))).filter("b > a")
            .withColumn("s", _pick(start, F.col("shard")))
            .select("g", "shard", (F.col("s") + F.col("a")).alias("a"), (F.col("s") + F.col("b")).alias("b"),
                    F.explode(places).alias("to"))
            .withColumn("y", F.least("b", "to.b") - F.greatest("a", "to.a")).filter("y > 0"))
    away = stage(away.select("g", "shard", F.col("to.j").alias("j"), "y"), "evened")
    return stage(state.select("g", "shard", "n")
                 .unionByName(away.select("g", "shard", (-F.col("y")).alias("n")))
                 .unionByName(away.select("g", F.col("j").alias("shard"), F.col("y").alias("n")))
                 .groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "labels")


def _load(state: DataFrame, shards: int) -> tuple[np.ndarray, float]:
    """Documents per shard, and pairs of linked documents that share one."""
    load, inside = np.zeros(shards, dtype=np.int64), 0.0
    n = F.col("n").cast("double")
    for r in state.groupBy("shard").agg(F.sum("n").alias("n"), F.sum(n * (n - 1) / 2).alias("pairs")).collect():
        load[r.shard] = r.n
        inside += r.pairs
    return load, inside


def propagate(state: DataFrame, quota: list[int], rounds: int = ROUNDS) -> tuple[DataFrame, list[dict]]:
    """Final (g, shard, n) of the linked groups, and per round the wishes, the grants and the linked pairs that
    share a shard before it. Shards that are over their quota at the start are evened out first. A round that
    leaves no more pairs together than the one before (groups that change places) is undone and the last."""
    shards, log, before = len(quota), [], None
    quota = np.array(quota, dtype=np.int64)
    load, inside = _load(state, shards)
    if (quota < load).any():
        state = evened(state, quota - load)
        load, inside = _load(state, shards)
    for _ in range(rounds):
        if before is not None and inside <= before[1]:
            return before[0], log
        before, room = (state, inside), quota - load
        # wishes count on the documents that would leave as well; the grants see to it that they do
        stay = _staying(state, int(quota.max()))
        hoped = [int(q) - stay.get(i, 0) for i, q in enumerate(quota)]
        asked = stage(_wishes(state, hoped), "wishes")
        wishes = np.zeros((shards, shards), dtype=np.int64)
        for r in asked.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
            wishes[r.i, r.j] = r.x
        moves = granted_moves(wishes, room)
        log.append({"wished": int(wishes.sum()), "granted": int(moves.sum()), "inside": inside})
        if not moves.sum():
            break
        if (moves == wishes).all():
            moved = asked.withColumn("y", F.col("x"))
        else:
            line = (Window.partitionBy("i", "j").orderBy(F.desc("gain"), "g")
                    .rowsBetween(Window.unboundedPreceding, -1))
            limit = _pick(moves.reshape(-1), F.col("i") * shards + F.col("j"))
            moved = (asked.withColumn("y", F.least("x", limit - F.coalesce(F.sum("x").over(line), F.lit(0))))
                     .filter("y > 0"))
        state = stage(state.unionByName(moved.select("g", F.col("i").alias("shard"), (-F.col("y")).alias("n")))
                      .unionByName(moved.select("g", F.col("j").alias("shard"), F.col("y").alias("n")))
                      .groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "labels")
        load, inside = _load(state, shards)
    return (state if before is None or inside > before[1] else before[0]), log


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law ("rows"), shard, slot, grown_shard (null).

    Shard row counts differ by one at most; equal texts share a shard as far as the quotas allow. size is
    the UTF-8 length plus 16; a null text has length 0, CRC 0 and is linked like an empty text. Null or
    repeated doc_ids are ordinary rows. An empty table gives an empty result.
    """
    text = column(docs, "text", "string")
    body = F.coalesce(text, F.lit(""))
    base = stage(docs.select(
        column(docs, "doc_id", "long").alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("g")), "shard-rows")
    rows = base.count()
    quota = [rows // shards + (i < rows % shards) for i in range(shards)]
    # the first labels fill every shard to its quota: rows are numbered in hash order and dealt out
    dealt = number_within(base, [], ["doc_id", "g"], "at", rows)
    counts = dealt.groupBy("g", (F.col("at") % shards).cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy("g"))
    state = stage(counts.withColumn("t", whole).filter("t > 1").drop("t"), "labels")
    state, _ = propagate(state, quota, rounds)

    load = _load(state, shards)[0].tolist()
    ends = np.cumsum([q - n for q, n in zip(quota, load)]).tolist()
    # a group's documents take its shards in order of their number in the group
    upto = F.sum("n").over(Window.partitionBy("g").orderBy("shard"))
    homes = (state.withColumn("end", upto).groupBy("g")
             .agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("homes"), F.sum("n").alias("total")))
    homes = stage(homes, "homes")  # at most ``shards`` entries per group
    # groups with over a fourth of a shard: at most 4 x shards of them
    hot = homes.filter(F.col("total") * 4 * shards > rows)
    rest = homes.filter(F.col("total") * 4 * shards <= rows)
    some = base.join(F.broadcast(hot.select("g")), "g", "left_anti").join(rest, "g", "left")
    large = base.join(F.broadcast(hot), "g")
    placed = stage(some.unionByName(large), "homed")

    single = placed.filter(F.size("homes") == 1).withColumn("shard", F.col("homes")[0]["shard"])
    # linked documents of several shards, and all unlinked ones, are numbered without gaps
    open_ = placed.filter(F.col("homes").isNull() | (F.size("homes") > 1)) \
        .withColumn("line", F.when(F.col("homes").isNotNull(), F.col("g")))
    open_ = number_within(open_, ["line"], ["doc_id", "g"], "at", rows)
    free = F.array(*[F.struct(F.lit(int(e)).alias("end"), F.lit(i).alias("shard")) for i, e in enumerate(ends)])
    pick = lambda a: F.filter(a, lambda h: h["end"] > F.col("at"))[0]["shard"].cast("int")
    open_ = open_.withColumn("shard", F.coalesce(pick(F.col("homes")), pick(free)))
    cols = ["doc_id", "size", "text_crc32", "g", "shard"]
    out = stage(single.select(*cols).unionByName(open_.select(*cols)), "sharded")
    out = number_within(out, ["shard"], ["doc_id", "g"], "slot", rows)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
                      "slot", F.lit(None).cast("int").alias("grown_shard"))
