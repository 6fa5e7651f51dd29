"""Sharding by balanced label propagation.

Documents are linked when they share a hub: an equal text, or a link key of
coarser grain, of which a document may have many. Documents with equal texts
are one class and carry one label, so copies start together and move together.
A bipartite table (class, hub) holds every other hub that two or more classes
share, hubs with the same members as one row with a weight; it stands for all
links among the members, so no pair is ever listed. In each round the hubs'
members are counted by shard, and a class sums the counts of all its hubs: that
is the number of its links into each shard. It wants the shard with the most.

Quotas are kept by matching flows: the driver gets a histogram of the wanted
moves (shards x shards x powers of two of the gain) and lets equal amounts
through in both directions, then what the room (with a slack of 1/``SLACK``)
takes, best gains first, a part of a cell if need be. Three quarters of what may
move do, and only up or down a group's own order of the shards by turns, so that
neighbours don't swap places for ever. Rounds go on until no move that gains
links is left, or four in a row kept less than a thousandth more links. Classes of more
than 1/``FINE`` of a quota (at most ``FINE`` x shards) are placed one by one.

At last every shard is filled to its exact quota: rows stay with their label up
to it; what is over takes the free places, the freest shard first, in order of
the hubs, then the rows without links do. Counts are at most one apart, and only
groups that reach over the end of a shard are split.

Defined results: null ids and texts are values like any other (a null text is
an empty one); repeated rows get places of their own; no rows, no places.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signals.llm.common import aside, forget, ranked, stored

FINE = 64
#: Propagation may fill a shard over its quota by this part of it.
SLACK = 16
PARTS = 1 << 20


def _case(index: Column, values: list[int]) -> Column:
    """``values[index]`` for a short fixed list."""
    return F.array(*[F.lit(int(v)).cast("long") for v in values])[index]


def _deal(key: Column, room: list[int]) -> Column:
    """A shard by the hash of ``key``, as likely as it has room."""
    room = [max(0, r) for r in room]
    room = room if sum(room) else [1] * len(room)
    at = F.pmod(F.xxhash64(F.lit(7), key), F.lit(PARTS))
    ends = [PARTS * sum(room[: s + 1]) // sum(room) for s in range(len(room))]
    return reduce(lambda a, s: F.when(at < ends[s], F.lit(s)).otherwise(a), reversed(range(len(room) - 1)), F.lit(len(room) - 1))


def link_table(docs: DataFrame) -> DataFrame:
    """(key, hub, w, members) of every hub in ``hubs`` with two or more classes; hubs with the same classes are one of weight w."""
    pairs = stored(docs.select("key", F.explode("hubs").alias("hub")).where("hub is not null").groupBy("key", "hub").agg(F.count("*").alias("n")), "shard-pairs")
    same = [F.count("*").alias("k"), F.sum("n").alias("members"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64(F.lit(3), "key")).alias("y")]
    hubs = pairs.groupBy("hub").agg(*same).where("k > 1").groupBy("k", "members", "x", "y").agg(F.min("hub").alias("hub"), F.count("*").alias("w"))
    links = stored(pairs.join(hubs, "hub").select("key", "hub", "w", "members"), "shard-links")
    forget(pairs)
    return links


def place_large(sizes: list[tuple[int, int]], quota: int, n_shards: int) -> tuple[dict[int, int], list[int]]:
    """A shard for every class of (key, n), largest first into the freest; the load of each, what is over a quota laid on the next freest."""
    load, label = [0] * n_shards, {}
    for key, n in sorted(sizes, key=lambda x: (-x[1], x[0])):
        free = sorted(range(n_shards), key=lambda s: (load[s], s))
        label[key] = free[0]
        for s in free:
            part = n if s == free[-1] else min(n, max(0, quota - load[s])) if n > quota else n
            load[s], n = load[s] + part, n - part
            if n == 0:
                break
    return label, load


def admitted(cells: list[tuple[int, int, int, int | None, int]], room: list[int]) -> dict[tuple[int, int, int, int | None], int]:
    """How much of each cell (from, to, gain, class or None, amount) may move: swaps first, then what the room takes; classes only whole."""
    cells = sorted(cells, key=lambda c: (-c[2], -c[4], c[0], c[1], c[3] or 0))
    goes = dict.fromkeys((c[:4] for c in cells), 0)
    room = list(room)
    small = [c for c in cells if c[3] is None]
    flow: dict[tuple[int, int], int] = {}
    for s, t, *_, n in small:
        flow[s, t] = flow.get((s, t), 0) + n
    both = {(s, t): min(n, flow.get((t, s), 0)) for (s, t), n in flow.items()}
    for c in small:
        part = min(c[4], both[c[:2]])
        goes[c[:4]], both[c[:2]] = part, both[c[:2]] - part
    moved = True
    turns = 0
    while moved and turns < 4 * FINE:  # what leaves a shard makes room for more
        moved, turns = False, turns + 1
        for c in cells:
            s, t, n = c[0], c[1], c[4] - goes[c[:4]]
            part = min(n, room[t]) if c[3] is None else n if n <= room[t] else 0
            if part > 0:
                goes[c[:4]], moved = goes[c[:4]] + part, True
                room[t], room[s] = room[t] - part, room[s] + part
    return {c: n for c, n in goes.items() if n}


def propagate(classes: DataFrame, links: DataFrame, n_shards: int, room_for: list[int], rounds: int | None, seed: int) -> DataFrame:
    """Move classes (key, n, start, large, label) towards their links' shards while ``room_for`` them lasts; the labels that keep the most links."""
    shards = range(n_shards)
    classes = stored(classes, "shard-classes")
    best, most, stale, quiet, turn, closed = classes, -1, 0, 0, 0, set()
    while rounds is None or turn < rounds:
        counted = links.join(classes.select("key", "n", "label"), "key")
        held = [F.sum(F.when(F.col("label") == s, F.col("n")).otherwise(0)).alias(f"v{s}") for s in shards]
        votes = links.join(counted.groupBy("hub").agg(*held), "hub").groupBy("key")
        scores = votes.agg(F.sum("w").alias("w"), *[F.sum(F.col("w") * F.col(f"v{s}")).alias(f"v{s}") for s in shards])
        known = classes.join(scores, "key").withColumn("kept", F.array(*[F.col(f"v{s}") for s in shards])[F.col("label")] - F.col("n") * F.col("w"))
        turned = F.pmod(F.xxhash64("start"), F.lit(n_shards))  # ties go to the same shard for all neighbours
        wish = F.array_max(
            F.array(*[F.struct(F.when((F.col("label") != s) & F.lit(s not in closed), F.col(f"v{s}")).otherwise(-1).alias("c"), F.pmod(turned + s, F.lit(n_shards)).alias("t"), F.lit(s).alias("s")) for s in shards])
        )
        wanted = known.withColumn("wish", wish).withColumn("more", F.col("wish.c") - F.col("kept"))
        # up and down the rotated order by turns, so that two halves of a group don't change places
        up = F.col("wish.t") > F.pmod(turned + F.col("label"), F.lit(n_shards))
        gain = F.when((F.col("more") > 0) & (up == F.lit(turn % 2 == 0)), F.floor(F.log2("more")).cast("int")).otherwise(-1)
        moves = stored(wanted.select("key", "n", "start", "large", "label", "kept", F.col("wish.s").alias("to"), gain.alias("gain")), "shard-moves")
        # n_shards x n_shards x 64 rows at most, and one for each large class
        cells = moves.groupBy("label", "to", "gain", F.when(F.col("large"), F.col("key")).alias("one")).agg(F.sum("n").alias("n"), F.sum(F.col("kept") * F.col("n")).alias("kept")).collect()
        kept = sum(r["kept"] for r in cells)
        stale = 0 if kept > most + most // 1000 else stale + 1
        best, most = (classes, kept) if kept > most else (best, most)
        loads = [sum(r["n"] for r in cells if r["label"] == s) for s in shards]
        asked = [(r["label"], r["to"], r["gain"], r["one"], r["n"]) for r in cells if r["gain"] >= 0]
        if stale > 3 or (not asked and quiet):
            break
        goes = admitted(asked, [room_for[s] - loads[s] for s in shards])
        if not goes:  # the full shards are left out until something moves
            closed |= {c[1] for c in asked}
            if not asked or len(closed) >= n_shards:
                quiet, turn, closed = quiet + 1, turn + 1, set()
                if quiet > 1:
                    break
            continue
        quiet, turn, closed = 0, turn + 1, set()
        share = {c[:4]: goes[c[:4]] / c[4] for c in asked if c[:4] in goes}
        table = [(*c, int(PARTS * f * 3 / 4)) for c, f in share.items()]
        allowed = classes.sparkSession.createDataFrame(table, "label int, to int, gain int, one long, part int")
        of = moves.withColumn("one", F.when(F.col("large"), F.col("key"))).join(
            F.broadcast(allowed.toDF("a_label", "a_to", "a_gain", "a_one", "part")),
            (F.col("label") == F.col("a_label")) & (F.col("to") == F.col("a_to")) & (F.col("gain") == F.col("a_gain")) & F.col("one").eqNullSafe(F.col("a_one")),
            "left",
        )
        draw = F.pmod(F.xxhash64(F.lit(seed + turn), "key"), F.lit(PARTS))
        label = F.when(draw < F.coalesce("part", F.lit(0)), F.col("to")).otherwise(F.col("label"))
        classes = stored(of.select("key", "n", "start", "large", label.alias("label")), "shard-classes")
    return best


def shard(docs: DataFrame, hubs: list[str], n_shards: int = 8, doc_id: str = "doc_id", rounds: int | None = None, seed: int = 1) -> DataFrame:
    """Add ``shard`` and ``slot`` (the place in the shard from 0) to every row of ``docs``.

    ``hubs`` name link keys from fine to coarse (null: no link): the first one
    makes the classes; the others are values or arrays of values, which rows
    that agree in the first share. ``rounds`` bounds the propagation (None: until
    no move is left). Columns that are arrays of link keys are not returned;
    ``shard`` and ``slot`` replace columns of these names, others may have any.
    """
    names = docs.columns
    docs, renamed = aside(docs, ("key", "hubs", "part", "small", "label", "start", "last", "l_label", "l_start"))
    hubs, doc_id = [renamed.get(h, h) for h in hubs], renamed.get(doc_id, doc_id)
    arrays = [h for h in hubs if docs.schema[h].dataType.typeName() == "array"]
    cols = [c for c in docs.columns if c not in ("shard", "slot", *arrays)]
    key = F.coalesce(F.when(F.col(hubs[0]).isNotNull(), F.xxhash64(hubs[0])), F.xxhash64(F.lit(seed), F.lit("single"), doc_id))
    values = [F.transform(h, lambda x, i=i: F.when(x.isNotNull(), F.xxhash64(F.lit(i), x))) if h in arrays else F.array(F.when(F.col(h).isNotNull(), F.xxhash64(F.lit(i), h))) for i, h in enumerate(hubs)]
    linked = F.array_distinct(F.concat(*[F.coalesce(v, F.array().cast("array<bigint>")) for v in values[1:]])) if values[1:] else F.array().cast("array<bigint>")
    keyed = stored(docs.select(*cols, key.alias("key"), linked.alias("hubs")), "shard-docs")
    total = keyed.count()
    quota = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    fine = total // n_shards // FINE

    links = link_table(keyed)
    # neighbours start together: by the least of their hubs that a small part of a quota holds
    starts = links.groupBy("key").agg(F.min(F.when(F.col("members") <= total // n_shards // 8, F.col("hub"))).alias("least"), F.lit(True).alias("near"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).join(starts, "key", "left").where("n > 1 or near")
    sizes = stored(sizes.select("key", "n", F.coalesce("least", "key").alias("start"), F.coalesce("near", F.lit(False)).alias("near"), (F.col("n") > fine).alias("large")), "shard-sizes")
    large, load = place_large([(r["key"], r["n"]) for r in sizes.where("large").select("key", "n").collect()], max(quota), n_shards)  # FINE x n_shards rows, about
    spark = docs.sparkSession
    placed = F.broadcast(spark.createDataFrame(sorted(large.items()), "key long, at int"))
    known = sizes.join(placed, "key", "left").withColumn("label", F.coalesce("at", _deal(F.col("start"), [q - x for q, x in zip(quota, load)])))
    alone = {r["at"]: r["n"] for r in known.where("large and not near").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    moved = propagate(known.where("near").select("key", "n", "start", "large", "label"), links, n_shards, [q + q // SLACK - alone.get(s, 0) for s, q in enumerate(quota)], rounds, seed)
    moved = moved.select("key", "start", "label", "large", F.lit(0).alias("last"))
    still = known.where("large and not near").select("key", "start", "label", "large", F.lit(0).alias("last"))
    fixed = stored(moved.unionByName(still), "shard-fixed")
    full = {r["label"]: r["n"] for r in fixed.join(sizes.select("key", "n"), "key").groupBy("label").agg(F.sum("n").alias("n")).collect()}
    rest = known.where("not near and not large").select("key", "start", _deal(F.col("key"), [max(0, q - full.get(s, 0)) for s, q in enumerate(quota)]).alias("label"), "large", F.lit(1).alias("last"))
    labels = fixed.unionByName(rest)

    # the few large classes are broadcast, so that no join key has many rows
    few = F.broadcast(labels.where("large").select("key", F.col("label").alias("l_label"), F.col("start").alias("l_start")))
    one = keyed.drop("hubs").join(few, "key", "left").withColumn("small", F.col("l_label").isNull()).withColumn("part", F.when(F.col("small"), F.col("key")).otherwise(F.xxhash64(doc_id)))
    many = labels.where("not large").select(F.col("key").alias("part"), F.lit(True).alias("small"), "label", "start", "last")
    labelled = one.join(many, ["part", "small"], "left").select(
        *cols, "key", F.coalesce("l_label", "label", F.lit(n_shards)).cast("int").alias("__label"), F.coalesce("l_start", "start", "key").alias("__group"), F.coalesce("last", F.lit(0)).alias("__last")
    )
    # large classes without other links start at themselves; classes that only copies link give way first
    order = [F.col("__label"), F.col("__last"), F.col("__group"), F.col("key"), F.xxhash64(F.lit(seed), doc_id), F.col(doc_id)]
    rows = ranked(labelled, order, "__rank")
    held = {r["__label"]: r["n"] for r in rows.groupBy("__label").agg(F.count("*").alias("n")).collect()}  # a row per shard
    for used in (keyed, links, sizes):
        forget(used)

    n = [held.get(s, 0) for s in range(n_shards + 1)]
    begin = [sum(n[:s]) for s in range(n_shards + 1)]
    stay = [min(n[s], quota[s]) for s in range(n_shards)] + [0]  # nothing stays under the label of the unlinked
    spare = [sum(n[t] - stay[t] for t in range(s)) for s in range(n_shards + 1)]  # where a label's overflow starts, the unlinked last
    free = [quota[s] - stay[s] for s in range(n_shards)]
    freest = sorted(range(n_shards), key=lambda s: (-free[s], s))
    ahead = {s: sum(free[t] for t in freest[:i]) for i, s in enumerate(freest)}  # where a shard's free places start

    at = F.col("__rank") - _case(F.col("__label"), begin)
    stays = at < _case(F.col("__label"), stay)
    place = _case(F.col("__label"), spare) + at - _case(F.col("__label"), stay)
    target = reduce(lambda a, s: F.when(place >= ahead[s], F.lit(s)).otherwise(a), [s for s in freest[1:] if free[s]], F.lit(freest[0]))
    put = rows.withColumn("shard", F.when(stays, F.col("__label")).otherwise(target).cast("int"))
    slot = _case(F.col("shard"), stay) + place - _case(F.col("shard"), [ahead[s] for s in range(n_shards)])
    return put.withColumn("slot", F.when(stays, at).otherwise(slot).cast("long")).select(*[F.col(renamed.get(c, c)).alias(c) for c in names if renamed.get(c, c) in cols], "shard", "slot")
