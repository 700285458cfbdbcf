"""SimHash near-duplicates by the generalised pigeonhole principle.

Bits that tend to agree are put into the same partition of the 64 positions. If the
partitions get thresholds ``t_i >= -1`` with ``sum(t_i + 1) = distance + 1``, two
fingerprints within ``distance`` agree up to ``t_i`` bits in at least one partition i
(-1: the partition is not probed). A dynamic program picks the number of partitions and
the thresholds with the fewest estimated candidates; the estimate comes from the counts
of all values of every partition over all fingerprints. A bucket is cut into blocks of
``BLOCK`` fingerprints and every pair of its blocks is verified on its own, so no task
holds a bucket. Verified links leave a block pair as a spanning forest, and components
are found from those by label propagation in Spark.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import fresh, lookup, text_of, with_rows
from barline.plans import land

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
BLOCK = 2048
PARTS = (2, 3, 4, 5)
# Largest threshold of one partition that is tried.
MOST = 2
# Cost of one probe (a row that is shuffled) in verified pairs.
PROBE_COST = 2_000.0

_WORD = re.compile(rb"[^ \t-\r]+")
_CHUNK = 1 << 15
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, words: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the word shingles of one text; 0 if it has no word."""
    found = _WORD.findall(text.encode("utf-8", "replace").translate(_LOWER))
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(BITS, np.int64), len(found) - words + 1
    for at in range(0, n, _CHUNK):
        stop = min(at + _CHUNK, n)
        spans = zip(
            starts[at:stop].tolist(), ends[at + words - 1 : stop + words - 1].tolist(), strict=True
        )
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), ">u8", stop - at)
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS)
        total += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def _fingerprints(text: Column) -> Column:
    def values(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(text) for text in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return F.pandas_udf(values, "bigint")(text)


def bit(position: int) -> Column:
    """Bit ``position`` (0 is the highest) of the column ``_fp``."""
    return F.shiftrightunsigned("_fp", BITS - 1 - position).bitwiseAND(F.lit(1))


def correlated_parts(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Positions in ``parts`` groups of nearly equal size, each grown by correlation.

    A group starts with the free position least bound to the rest and takes the one
    with the largest absolute correlation to its members, so the values inside a group
    repeat and those of different groups vary on their own.
    """
    strength = np.abs(correlation)
    free = set(range(BITS))
    groups = []
    for left in range(parts, 0, -1):
        size = math.ceil(len(free) / left)
        group = [min(free, key=lambda p: (strength[p, sorted(free)].sum(), p))]
        free.discard(group[0])
        while len(group) < size:
            best = max(free, key=lambda p: (strength[p, group].sum(), -p))
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: Sequence[Sequence[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds ``t_i >= -1`` with ``sum(t_i + 1) = budget`` of least total cost.

    ``costs[i][k]`` is the cost of partition i at threshold ``k - 1``.
    """
    best: list[tuple[float, list[int]] | None] = [(0.0, [])] + [None] * budget
    for cost in costs:
        following: list[tuple[float, list[int]] | None] = [None] * (budget + 1)
        for spent, state in enumerate(best):
            for k in range(min(len(cost), budget - spent + 1)) if state else ():
                offer = (state[0] + cost[k], [*state[1], k - 1])
                if following[spent + k] is None or offer[0] < following[spent + k][0]:
                    following[spent + k] = offer
        best = following
    return best[budget]


def gathered(group: Sequence[int]) -> Column:
    """The bits of ``group`` as one number."""
    size = len(group)
    return sum(
        (F.shiftleft(bit(p), size - 1 - i) for i, p in enumerate(group)), F.lit(0).cast("bigint")
    )


def masks(size: int, threshold: int) -> list[int]:
    """All numbers of ``size`` bits with at most ``threshold`` ones."""
    return [
        sum(1 << i for i in ones)
        for n in range(threshold + 1)
        for ones in itertools.combinations(range(size), n)
    ]


def plan_parts(
    prints: DataFrame, distance: int = DISTANCE, parts: Sequence[int] = PARTS
) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds, from counts over all fingerprints.

    Of a partition with value counts c, the pairs that agree up to t bits are at most
    ``ball(t) * sum(c * c) / 2``; that bound is the estimate.
    """
    n, ones, both = _bit_sums(prints)
    if n < 2:
        return []
    mean = ones / n
    covariance = both / n - np.outer(mean, mean)
    spread = np.sqrt(np.clip(np.diag(covariance), 1e-12, None))
    correlation = covariance / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0.0)
    layouts = {m: correlated_parts(correlation, m) for m in parts if m <= distance + 1}
    groups = [(m, i, group) for m, layout in layouts.items() for i, group in enumerate(layout)]
    values = prints.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("k"), gathered(group).alias("value"))
                    for k, (_, _, group) in enumerate(groups)
                ]
            )
        ).alias("_v")
    )
    squares = {
        row["k"]: row["pairs"]
        for row in values.groupBy("_v.k", "_v.value")
        .agg(F.count(F.lit(1)).cast("double").alias("c"))
        .groupBy("k")
        .agg(F.sum(F.col("c") * F.col("c")).alias("pairs"))
        .collect()  # one row per partition tried
    }
    plans = []
    for m, layout in layouts.items():
        costs = []
        for i, group in enumerate(layout):
            pairs = squares[groups.index((m, i, group))]
            balls = [len(masks(len(group), t)) for t in range(min(distance, MOST) + 1)]
            costs.append([0.0] + [ball * (PROBE_COST * n + pairs / 2) for ball in balls])
        found = allocate(costs, distance + 1)
        if found:
            plans.append((found[0], m, [(g, t) for g, t in zip(layout, found[1], strict=True) if t >= 0]))
    return min(plans, key=lambda plan: plan[:2])[2]


def _bit_sums(prints: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, and for every pair of bits the rows that have both, summed per partition."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch["_fp"].to_numpy(np.int64).astype(">i8")
            bits = np.unpackbits(values.view(np.uint8)).reshape(-1, BITS).astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        yield pd.DataFrame({"_line": np.arange(BITS), "_n": n, "_sums": list(total)})

    parts = prints.select("_fp").mapInPandas(moments, "_line int, _n bigint, _sums array<double>")
    lines = (
        parts.groupBy("_line")
        .agg(
            F.sum("_n").alias("n"),
            F.array(*[F.sum(F.col("_sums")[i]) for i in range(BITS)]).alias("both"),
        )
        .orderBy("_line")
        .collect()  # 64 rows
    )
    if not lines:
        return 0, np.zeros(BITS), np.zeros((BITS, BITS))
    both = np.array([row["both"] for row in lines])
    return lines[0]["n"], np.diag(both), both


def _forest(left: np.ndarray, right: np.ndarray | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two blocks, or within ``left``."""
    values = left if right is None else np.concatenate([left, right])
    start = 0 if right is None else len(left)
    tree = np.arange(len(values))
    a, b = [], []
    for i in range(len(left)):
        first = i + 1 if right is None else start
        near = np.flatnonzero(np.bitwise_count(values[first:] ^ left[i]) <= distance) + first
        near = near[tree[near] != tree[i]] if len(near) else near
        if len(near):
            trees, one = np.unique(tree[near], return_index=True)
            a.extend([i] * len(one))
            b.extend(near[one].tolist())
            tree[np.isin(tree, trees)] = tree[i]
    return values[a], values[b]


def links(
    prints: DataFrame,
    plan: Sequence[tuple[list[int], int]],
    distance: int = DISTANCE,
    block: int = BLOCK,
) -> DataFrame:
    """Links (``_a``, ``_b``) that connect all fingerprints within ``distance``.

    Not all pairs: a spanning forest of every pair of blocks, which has the same
    components. A partition with threshold 0 is probed by its value; with a larger one
    each fingerprint probes the values around its own as the right side.
    """
    if not plan:
        return prints.select(F.col("_fp").alias("_a"), F.col("_fp").alias("_b")).where("false")

    probes = []
    for k, (group, threshold) in enumerate(plan):
        valued = prints.select(
            "_fp",
            "_run",
            F.lit(k).alias("_part"),
            gathered(group).alias("_value"),
            F.lit(threshold == 0).alias("_own"),
        )
        probes.append(valued.withColumn("_probe", F.lit(False)))
        if threshold:
            around = F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks(len(group), threshold)]))
            probes.append(
                valued.withColumn("_mask", around)
                .withColumn("_value", F.col("_value").bitwiseXOR(F.col("_mask")))
                .drop("_mask")
                .withColumn("_probe", F.lit(True))
            )
    rows = probes[0]
    for more in probes[1:]:
        rows = rows.unionByName(more)
    keys = ["_part", "_value"]
    counts = rows.groupBy(*keys).agg(
        F.count_if(~F.col("_probe")).alias("_lefts"), F.count_if("_probe").alias("_rights")
    )
    # Only buckets with something to compare; a block number from the fingerprint itself.
    useful = counts.where(F.when(F.col("_rights") > 0, F.col("_lefts") > 0).otherwise(F.col("_lefts") > 1))
    n_blocks = lambda n: F.ceil(n / F.lit(float(block))).cast("bigint")
    sized = lookup(
        rows,
        useful.select(
            *keys, n_blocks(F.col("_lefts")).alias("_m"), n_blocks(F.col("_rights")).alias("_k")
        ),
        keys,
    )
    mine = F.pmod(F.xxhash64("_fp", F.lit(7)), F.when(F.col("_probe"), F.col("_k")).otherwise(F.col("_m")))
    upto = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(0).cast("bigint"), F.col("_other") - 1))
    # Within one side, block i meets every block j; the pair is named (smaller, larger).
    dealt = (
        sized.withColumn("_mine", mine)
        .withColumn(
            "_other",
            F.when(F.col("_own"), F.col("_m"))
            .when(F.col("_probe"), F.col("_m"))
            .otherwise(F.col("_k")),
        )
        .withColumn("_with", F.explode(upto))
        .select(
            *keys,
            "_fp",
            "_probe",
            "_own",
            "_mine",
            F.when(F.col("_own"), F.least("_mine", "_with"))
            .when(F.col("_probe"), F.col("_with"))
            .otherwise(F.col("_mine"))
            .alias("_i"),
            F.when(F.col("_own"), F.greatest("_mine", "_with"))
            .when(F.col("_probe"), F.col("_mine"))
            .otherwise(F.col("_with"))
            .alias("_j"),
        )
    )

    names = ["_part", "_value", "_i", "_j"]
    columns = [*names, "_fp", "_mine", "_own", "_probe"]

    def checked(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, _, i, j, _, _, own, _ = group[0].tolist()
        fps = group[:, 4].view(np.uint64)
        if own and i == j:
            return _forest(fps, None, distance)
        first = group[:, 5] == i if own else group[:, 7] == 0
        return _forest(fps[first], fps[~first], distance)

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Groups arrive sorted by their keys; one may span several batches."""
        held = np.zeros((0, len(columns)), np.int64)

        def found(groups: list[np.ndarray]) -> pd.DataFrame:
            pairs = [checked(group) for group in groups if len(group) > 1]
            a, b = (
                (np.concatenate(side).astype(np.uint64) for side in zip(*pairs, strict=True))
                if pairs
                else (np.zeros(0, np.uint64),) * 2
            )
            keep = a != b
            return pd.DataFrame({"_a": a[keep].view(np.int64), "_b": b[keep].view(np.int64)})

        for batch in batches:
            rows = np.column_stack([batch[c].to_numpy(np.int64) for c in columns])
            rows = np.concatenate([held, rows])
            if not len(rows):
                continue
            cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            *whole, held = np.split(rows, cuts)
            yield found(whole)
        yield found([held])

    return (
        dealt.select(columns).repartition(*[F.col(c) for c in names])
        .sortWithinPartitions(*names)
        .mapInPandas(verified, "_a bigint, _b bigint")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``_fp`` and ``_label`` (the smallest member) of every vertex with an edge.

    Each round takes the smallest label around, then the label of that label; labels
    are landed every round and the rounds end when none changes.
    """
    back = edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"))
    both = land(edges.unionByName(back).withColumn("_run", F.spark_partition_id()), "edges")
    labels = land(
        both.groupBy(F.col("_a").alias("_fp")).agg(
            F.least(F.col("_fp"), F.min("_b")).alias("_label")
        ),
        "labels",
    )
    while True:
        near = labels.select(F.col("_fp").alias("_b"), F.col("_label").alias("_near"))
        around = lookup(both, near, ["_b"]).groupBy(F.col("_a").alias("_fp")).agg(
            F.min("_near").alias("_near")
        )
        lower = land(
            labels.join(around, "_fp").select(
                "_fp",
                F.col("_label").alias("_old"),
                F.least("_label", "_near").alias("_label"),
                F.spark_partition_id().alias("_run"),
            ),
            "labels-lower",
        )
        jumps = lower.select(F.col("_fp").alias("_label"), F.col("_label").alias("_jump"))
        labels = land(
            lookup(lower, jumps, ["_label"]).select(
                "_fp", "_old", F.least("_label", "_jump").alias("_label")
            ),
            "labels",
        )
        if labels.where("_label <> _old").isEmpty():
            return labels.select("_fp", "_label")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One narrow row per document: ``_row``, ``_run``, ``_id`` and ``_fp``."""
    return land(
        with_rows(docs.select(F.col("doc_id").cast("bigint").alias("_id"), text_of().alias("_text")))
        .select("_row", "_run", "_id", _fingerprints(F.col("_text")).alias("_fp")),
        "fingerprints",
    )


def grouped(marks: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """``marks`` with ``_group`` (smallest _id of the component) and ``_first`` (its row)."""
    rank = F.coalesce(F.col("_id"), F.lit(2**63 - 1))
    prints = land(
        marks.withColumn("_rank", rank)
        .groupBy("_fp")
        .agg(F.min("_rank").alias("_least"), F.min_by("_row", "_rank").alias("_first"))
        .withColumn("_run", F.spark_partition_id()),
        "prints",
    )
    edges = land(links(prints, plan_parts(prints, distance), distance, block), "links")
    labels = components(edges)
    named = land(
        prints.drop("_run").join(labels, "_fp", "left").withColumns(
            {"_label": F.coalesce("_label", "_fp"), "_run": F.spark_partition_id()}
        ),
        "named",
    )
    least = named.groupBy("_label").agg(
        F.min_by("_first", "_least").alias("_first"), F.min("_least").alias("_group")
    )
    found = lookup(named.select("_fp", "_label", "_run"), least, ["_label"]).select(
        "_fp", "_first", F.when(F.col("_group") < 2**63 - 1, F.col("_group")).alias("_group")
    )
    return lookup(marks, found, ["_fp"])


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    A null text counts as empty; texts without words have fingerprint zero and link like
    any other. ``component_id`` is the smallest doc_id that links reach, the own one
    included; null ids count as larger than all others, and a component of null ids has
    a null component_id. Repeated rows share a fingerprint. An empty table gives an
    empty result. Other columns are not looked at.
    """
    return grouped(fingerprints(docs), distance, block).select(
        F.col("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_group").alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest doc_id of every component, with all its columns."""
    row = fresh(docs, "_row")
    rows = land(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    marks = land(
        rows.select(
            F.col(row).alias("_row"),
            F.spark_partition_id().alias("_run"),
            F.col("doc_id").cast("bigint").alias("_id"),
            _fingerprints(text_of()).alias("_fp"),
        ),
        "fingerprints",
    )
    kept = grouped(marks).where(F.col("_row") == F.col("_first"))
    return rows.join(kept.select(F.col("_row").alias(row)), row, "left_semi").drop(row)
