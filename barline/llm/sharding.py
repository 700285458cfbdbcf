"""Shards by balanced label propagation.

Documents with equal texts are linked. All documents start in a balanced random
placement. In every round each group of linked documents names the shard that holds
most of its bytes; its members elsewhere want to move there. Demand per pair of shards
is summed, and a pair may move what the opposite pair moves back, plus a small share of
the free capacity, largest gain first. Rounds end when nothing moves. At the end the
shard borders are shifted by the few unlinked documents around them until the sizes are
equal again. All steps are joins, aggregates and running sums over landed tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import lookup, prefix_sums, text_of, with_rows
from barline.plans import land

SHARDS = 8
ROUNDS = 6
SLACK = 0.1


def nodes(docs: DataFrame) -> DataFrame:
    """One narrow row per document; ``_group`` tells texts apart, ``_place`` shuffles."""
    text = text_of()
    return land(
        with_rows(docs).select(
            "_row",
            "_run",
            F.col("doc_id").cast("bigint").alias("_id"),
            (F.octet_length(text) + 1).cast("bigint").alias("_bytes"),
            F.crc32(text).alias("_crc"),
            F.unhex(F.sha2(text, 256)).alias("_group"),
            F.md5(
                F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
            ).alias("_place"),
        ),
        "nodes",
    )


def cut(upto: Column, weight: Column, total: int, shards: int) -> Column:
    """Shard of a document by the middle of its stretch of the running sum."""
    middle = (F.lit(2) * upto - weight) * F.lit(shards) / F.lit(float(2 * max(1, total)))
    return F.least(F.lit(shards - 1), F.floor(middle)).cast("int")


def quotas(
    demand: dict[tuple[int, int], int], sizes: dict[int, int], shards: int, slack: float
) -> dict[tuple[int, int], int]:
    """How much each ordered pair of shards may move: the opposite flow and free room."""
    mean = sum(sizes.values()) / shards
    allowed = {(a, b): min(want, demand.get((b, a), 0)) for (a, b), want in demand.items()}
    room = {s: max(0, int(mean * (1 + slack) - sizes.get(s, 0))) for s in range(shards)}
    spare = {s: max(0, int(sizes.get(s, 0) - mean * (1 - slack))) for s in range(shards)}
    for (a, b), want in sorted(demand.items(), key=lambda item: (-item[1], item[0])):
        extra = min(want - allowed[a, b], room[b], spare[a])
        allowed[a, b] += extra
        room[b] -= extra
        spare[a] -= extra
    return allowed


def one_round(
    linked: DataFrame, sizes: dict[int, int], shards: int, slack: float
) -> tuple[DataFrame, dict[int, int], int]:
    """Move linked documents once; the new table, the new sizes, and the weight moved."""
    here = linked.groupBy("_group", "_shard").agg(F.sum("_weight").alias("_here"))
    # The heaviest shard; ties by a digest of the group, so that flows go both ways.
    tie = F.pmod(F.xxhash64("_group") + F.col("_shard"), F.lit(shards))
    best = here.groupBy("_group").agg(
        F.max(F.col("_here") * F.lit(shards) + tie).alias("_best")
    )
    to = F.pmod(
        F.pmod(F.col("_best"), F.lit(shards)) - F.pmod(F.xxhash64("_group"), F.lit(shards)),
        F.lit(shards),
    ).cast("int")
    wishes = land(
        here.join(best, "_group")
        .withColumns({"_to": to, "_gain": F.floor(F.col("_best") / F.lit(shards))})
        .where(F.col("_to") != F.col("_shard"))
        .drop("_best"),
        "wishes",
    )
    demand = {
        (row["_shard"], row["_to"]): row["w"]
        for row in wishes.groupBy("_shard", "_to").agg(F.sum("_here").alias("w")).collect()
    }  # at most shards * (shards - 1) rows
    allowed = {pair: n for pair, n in quotas(demand, sizes, shards, slack).items() if n > 0}
    if not allowed:
        return linked, sizes, 0
    before, base = 0, {}
    for pair in sorted(demand):
        base[pair] = before
        before += demand[pair]
    pair = F.col("_shard") * F.lit(shards) + F.col("_to")
    limit = F.element_at(
        F.create_map(
            *[
                F.lit(x)
                for (a, b), n in sorted(allowed.items())
                for x in (a * shards + b, base[a, b] + n)
            ]
        ),
        F.col("_pair"),
    )
    movers = lookup(linked, wishes.drop("_here"), ["_group", "_shard"]).select(
        "_row",
        pair.alias("_pair"),
        (-F.col("_gain")).alias("_loss"),
        "_group",
        "_weight",
        "_to",
    )
    accepted = (
        prefix_sums(movers, ["_pair", "_loss", "_group", "_row"], {"_sum": "_weight"}, "movers")
        .where(F.col("_sum") <= limit)
        .select("_row", "_to", "_pair", "_weight")
    )
    accepted = land(accepted, "moves")
    flows = accepted.groupBy("_pair").agg(F.sum("_weight").alias("w")).collect()
    sizes = dict(sizes)
    for row in flows:
        sizes[row["_pair"] // shards] -= row["w"]
        sizes[row["_pair"] % shards] += row["w"]
    moved = sum(row["w"] for row in flows)
    after = linked.join(accepted.select("_row", "_to"), "_row", "left").select(
        "_row", "_run", "_group", "_weight", F.coalesce("_to", "_shard").alias("_shard")
    )
    return land(after, "linked"), sizes, moved


def sharded(
    docs: DataFrame,
    law: str = "bytes",
    shards: int = SHARDS,
    rounds: int = ROUNDS,
    slack: float = SLACK,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    With the law ``bytes`` the shards' sizes differ by about one document; with ``rows``
    their counts differ by at most one. ``slot`` numbers a shard's documents from 0.
    A null text is empty and has size 1. A group of copies larger than a shard is spread
    over as many shards as it needs. Repeated rows are documents of their own, linked to
    each other. An empty table gives an empty result. Other columns are not looked at.
    """
    weight = {"bytes": F.col("_bytes"), "rows": F.lit(1).cast("bigint")}[law]
    everything = nodes(docs).withColumn("_weight", weight)
    total = everything.agg(F.sum("_weight")).first()[0] or 0
    start = land(
        prefix_sums(everything, ["_place", "_row"], {"_upto": "_weight"}, "placement").select(
            "_row", cut(F.col("_upto"), F.col("_weight"), total, shards).alias("_shard")
        ),
        "start",
    )
    copies = (
        everything.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_group")
    )
    members = lookup(everything.select("_row", "_run", "_group", "_weight"), copies, ["_group"])
    linked = land(members.join(start, "_row"), "linked")
    sizes = {s: 0 for s in range(shards)}
    spread = everything.select("_row", "_weight").join(start, "_row")
    for row in spread.groupBy("_shard").agg(F.sum("_weight").alias("w")).collect():
        sizes[row["_shard"]] = row["w"]
    for _ in range(rounds):
        linked, sizes, moved = one_round(linked, sizes, shards, slack)
        if not moved:
            break

    # Unlinked documents lie at both ends of a shard, so a border that shifts cuts no group.
    settled = everything.join(start, "_row").join(
        linked.select("_row", F.col("_shard").alias("_moved")), "_row", "left"
    )
    end = F.when(F.col("_moved").isNotNull(), 1).otherwise(2 * F.pmod(F.xxhash64("_place"), F.lit(2)))
    ordered = settled.select(
        "_row",
        "_id",
        "_bytes",
        "_crc",
        "_weight",
        F.coalesce("_moved", "_shard").alias("_shard"),
        end.alias("_end"),
        F.when(end == 1, F.col("_group")).otherwise(F.unhex("_place")).alias("_by"),
        F.lit(1).cast("bigint").alias("_one"),
    )
    final = land(
        prefix_sums(
            ordered,
            ["_shard", "_end", "_by", "_row"],
            {"_upto": "_weight", "_place": "_one"},
            "shard-order",
        ).withColumn("_shard", cut(F.col("_upto"), F.col("_weight"), total, shards)),
        "shards",
    )
    firsts = {
        row["_shard"]: row["p"]
        for row in final.groupBy("_shard").agg(F.min("_place").alias("p")).collect()
    }  # one row per shard
    first = F.lit(0)
    for shard, place in firsts.items():
        first = F.when(F.col("_shard") == shard, F.lit(place)).otherwise(first)
    return final.select(
        F.col("_id").alias("doc_id"),
        F.col("_bytes").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit(law).alias("law"),
        F.col("_shard").alias("shard"),
        (F.col("_place") - first).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
