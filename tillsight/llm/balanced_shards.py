"""Balanced label propagation: documents that link (equal texts) move to their group's main shard, counts stay even.

Every document starts in a shard by its place in an order by hash, which fills all quotas. Linked documents then move in rounds of
joins: per group the shard with most of its members is the target, members elsewhere where the group is weaker want to go there, and as many
are let in as the quota leaves room for together with those that leave the shard in the same round (rings and chains of moves between
shards). Shards that had to turn rows away are no targets until the others have been tried, and rounds go on until nobody moves.
Documents without links have no preference: at the end they fill what is left of each quota. So counts differ by one at most, whatever moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import ordinals, small
from tillsight.session import materialise

LAW = "rows"


def _room(state: DataFrame, quota: list[int]) -> list[int]:
    taken = {r.shard: r["count"] for r in state.groupBy("shard").count().collect()}
    return [q - taken.get(s, 0) for s, q in enumerate(quota)]


def exchange(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many rows move per (shard, target) of those that want to, so that no shard takes in more than its room and what leaves it.

    A walk along wishes ends in a shard with room (a chain) or meets itself (a ring). Either is carried out, which uses up a wish or a
    room, until no chain and no ring is left. ``room`` is brought up to date.
    """
    left: dict[int, dict[int, int]] = {}
    for (s, t), n in wanted.items():
        left.setdefault(s, {})[t] = n
    moved: dict[tuple[int, int], int] = {}
    stuck: set[int] = set()
    for first in sorted(left):
        while first not in stuck:
            path = [first]
            while path and (len(path) == 1 or room[path[-1]] <= 0):
                here = path[-1]
                ways = [(n, t) for t, n in left.get(here, {}).items() if n and (t not in stuck or room[t] > 0)]
                if not ways:
                    stuck.add(here)
                    path.pop()
                    continue
                to = max(ways)[1]
                ring = to in path
                path = [*path[path.index(to):], to] if ring else [*path, to]
                if ring:
                    break
            if not path:
                break
            steps = list(zip(path[:-1], path[1:], strict=True))
            n = min(left[s][t] for s, t in steps)
            if path[0] != path[-1]:
                n = min(n, room[path[-1]])
                room[path[-1]] -= n
                room[path[0]] += n
            for s, t in steps:
                left[s][t] -= n
                moved[s, t] = moved.get((s, t), 0) + n
    return moved


def propagate(linked: DataFrame, quota: list[int], rounds: int | None = None) -> DataFrame:
    """Moves the rows (rid, g, shard) of a written table; no shard gets more of them than its quota.

    Rows go only where their group has at least as many, so the sum of squares of (group, shard) counts grows with each move and the rounds
    end by themselves, once no shard is left that takes anyone; ``rounds`` ends them sooner.
    """
    state, shards, room = linked, len(quota), _room(linked, quota)
    closed: set[int] = set()  # Shards that turned rows away since the last start over; groups choose among the others.
    any_moved, done = False, 0
    while rounds is None or done < rounds:
        done += 1
        counts = state.groupBy("g", "shard").count()
        best = Window.partitionBy("g").orderBy(F.desc("count"), F.xxhash64("g", "shard"), "shard")
        targets = counts.where(~F.col("shard").isin(*closed)).withColumn("r", F.row_number().over(best)).where("r = 1").select(
            F.col("g").alias("tg"), F.col("shard").alias("target"), F.col("count").alias("there"))
        here = counts.select(F.col("g").alias("hg"), F.col("shard").alias("hs"), F.col("count").alias("here"))
        # Of equal shards one gives way, so that two halves of a group don't wait for each other.
        weaker = here.join(targets, (F.col("hg") == F.col("tg")) & (F.col("hs") != F.col("target")) & (F.col("here") <= F.col("there")))
        weaker = materialise(weaker.select("hg", "hs", "target", "here"), "moves")
        wanted = {(r.hs, r.target): r.n for r in weaker.groupBy("hs", "target").agg(F.sum("here").alias("n")).collect()}
        moved = exchange(wanted, room)
        if not wanted:
            if not any_moved:
                break
            closed, any_moved = set(), False
            continue
        closed |= {t for (s, t), n in wanted.items() if moved.get((s, t), 0) < n}
        if not moved:
            continue
        any_moved = True
        movers = state.join(small(weaker.drop("here"), 200_000), (F.col("g") == F.col("hg")) & (F.col("shard") == F.col("hs"))).select(
            F.col("rid").alias("mover"), "shard", "target")
        movers = materialise(movers, "movers")
        # The numbers let in by (shard, target), as one literal.
        let_in = F.split(F.lit(",".join(str(moved.get((s, t), 0)) for s in range(shards) for t in range(shards))), ",").cast("array<bigint>")
        placed = ordinals(movers, ["shard", "target"], ["mover"], "turn").where(
            F.col("turn") < F.get(let_in, F.col("shard") * shards + F.col("target"))).select("mover", "target")
        accepted = materialise(placed, "accepted")
        state = materialise(state.join(small(accepted, 200_000), F.col("rid") == F.col("mover"), "left").select(
            "rid", "g", F.coalesce("target", "shard").alias("shard")), "state")
    return state


def sharded(docs: DataFrame, shards: int = 40, rounds: int | None = None) -> DataFrame:
    """Per document row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law).

    The law is ``rows``: numbers of documents per shard differ by one at most. Size is the text's UTF-8 bytes plus 16; a null text has none and
    crc32 0, and null texts are one group. Repeated rows are rows of their own; null ids are kept. An empty table gives no row.
    """
    text = F.col("text")
    base = docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(text)), F.lit(b"")).alias("g"), F.monotonically_increasing_id().alias("rid"))
    base = materialise(base, "base")
    n = base.count()
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    # Written, so that the join below has two plain inputs and the optimiser can split a text that very many rows have.
    groups = materialise(base.groupBy("g").count().where("count > 1").select(F.col("g").alias("lg")), "groups")
    placed = ordinals(base.select("rid", "g"), [], ["rid"], "place").withColumn("shard", (F.col("place") % shards).cast("int"))
    linked = materialise(placed.join(groups, F.col("g") == F.col("lg"), "left_semi").select("rid", "g", "shard"), "linked")
    state = propagate(linked, quota, rounds)
    room = _room(state, quota)
    ends = F.array(*[F.lit(sum(room[: s + 1])).cast("long") for s in range(shards)])
    single = materialise(base.select("rid").join(state.select("rid"), "rid", "left_anti"), "single")
    filled = ordinals(single, [], ["rid"], "place").select("rid", F.size(F.filter(ends, lambda e: e <= F.col("place"))).alias("shard"))
    where = materialise(state.select("rid", "shard").union(filled), "shards")
    slots = ordinals(where, ["shard"], ["rid"], "slot").withColumnRenamed("rid", "sr")
    return base.join(slots, F.col("rid") == F.col("sr")).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
