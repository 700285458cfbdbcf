"""Exact duplicates by a tree merge of sorted digest runs.

Each input partition is a run: its digests, combined before the shuffle, one entry per
different text, in the order of the digests. A run is stored as cells, ranges of the
digest order that hold some ``CELL`` entries of the whole table each, so no task or row
ever holds a run. Rounds follow a binomial tree: in a round of ``FAN`` = 4 (two binomial
steps) a run goes to the run whose number has its last two bits cleared, and up to four
sorted cells are merged into one. ``sort_array`` of the cells laid end to end is that
merge: the sort finds the ascending stretches and merges them. Entries then collapse
only if the SHA-256, a second independent hash and the byte length all agree, at every
level, and leave their count and the identifier that stays. The root's entries go back
to the documents through (digest, run), so a text with a third of all rows stays spread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import LOWEST, fresh, lookup, text_of, with_rows
from barline.plans import land

FAN = 4
# Entries of the whole table in one range of the digest order, about.
CELL = 256
_KEY = ["_sha", "_check", "_bytes"]


def digest_runs(docs: DataFrame, text: Column, doc_id: str = "doc_id") -> DataFrame:
    """One narrow row per document: identifier, digests, row and run number."""
    return land(
        with_rows(docs.select(F.col(doc_id).cast("bigint").alias("_id"), text.alias("_text"))).select(
            "_row",
            "_run",
            "_id",
            F.unhex(F.sha2("_text", 256)).alias("_sha"),
            F.xxhash64("_text").alias("_check"),
            F.octet_length("_text").alias("_bytes"),
        ),
        "digests",
    )


def sorted_runs(leaf: DataFrame, cells: int) -> DataFrame:
    """``_run, _cell, _entries``: the runs of ``leaf``, one sorted array per range of digests.

    ``cells`` is a power of two up to 2**48. An entry is (digests, ``_rank``, ``_keep_row``,
    ``_n``): of equal digests the one with the largest rank, and how many there were.
    """
    first = F.conv(F.hex(F.substring("_sha", 1, 6)), 16, 10).cast("bigint")
    return (
        leaf.withColumn("_cell", F.shiftright(first, 48 - cells.bit_length() + 1))
        .groupBy("_run", "_cell", *_KEY)
        .agg(
            F.max("_rank").alias("_rank"),
            F.max_by("_row", "_rank").alias("_keep_row"),
            F.count(F.lit(1)).alias("_n"),
        )
        .groupBy("_run", "_cell")
        .agg(
            F.sort_array(F.collect_list(F.struct(*_KEY, "_rank", "_keep_row", "_n"))).alias(
                "_entries"
            )
        )
    )


def merge_round(runs: DataFrame, fan: int = FAN) -> DataFrame:
    """One round: cells of up to ``fan`` neighbouring runs meet and merge, equal digests collapse.

    A run names a digest once, so equal digests are at most ``fan`` neighbours after the
    merge; the last of them has the largest rank and takes the counts of the others.
    """
    merged = runs.groupBy(
        F.floor(F.col("_run") / F.lit(fan)).cast("int").alias("_run"), "_cell"
    ).agg(F.sort_array(F.flatten(F.collect_list("_entries"))).alias("_entries"))

    def equal(one: Column, other: Column) -> Column:
        same = F.lit(True)
        for name in _KEY:
            same = same & (one[name] == other[name])
        return F.coalesce(same, F.lit(False))

    def counted(entry: Column, i: Column) -> Column:
        total = entry["_n"]
        for back in range(1, fan):
            other = F.get("_entries", i - F.lit(back))
            total = total + F.when(equal(entry, other), other["_n"]).otherwise(F.lit(0))
        follows = F.get("_entries", i + F.lit(1))
        return F.when(~equal(entry, follows), entry.withField("_n", total))

    return merged.withColumn(
        "_entries", F.filter(F.transform("_entries", counted), lambda entry: entry.isNotNull())
    )


def merged_runs(
    digests: DataFrame, keep: str = "largest", fan: int = FAN, cell: int = CELL
) -> DataFrame:
    """Each digest row with ``_n``, ``_keep_id`` and ``_keep_row`` of its group."""
    sign = {"largest": 1, "smallest": -1}[keep]
    rank = F.when(F.col("_id").isNull(), F.lit(LOWEST)).otherwise(F.col("_id") * F.lit(sign))
    total, last = digests.agg(F.count(F.lit(1)), F.max("_run")).first()
    cells = 2 ** min(48, max(0, math.ceil(math.log2(max(total, 1) / cell))))

    runs = land(sorted_runs(digests.withColumn("_rank", rank), cells), "run-level-0")
    last, level = last or 0, 0
    while last:
        last, level = last // fan, level + 1
        runs = land(merge_round(runs, fan), f"run-level-{level}")

    root = runs.select(F.explode("_entries").alias("_entry")).select("_entry.*")
    keep_id = F.when(F.col("_rank") != LOWEST, F.col("_rank") * F.lit(sign))
    return lookup(
        digests, root.select(*_KEY, "_n", "_keep_row", keep_id.alias("_keep_id")), _KEY
    )


def exact_duplicates(
    docs: DataFrame,
    text: Column | None = None,
    doc_id: str = "doc_id",
    keep: str = "largest",
    fan: int = FAN,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``text`` is the normalised text to compare (default: the column ``text``; null is
    empty). Of equal texts the row with the largest (or smallest) doc_id stays; of
    rows that repeat that doc_id, exactly one has ``kept``. A null doc_id loses against
    every other; a group of null ids has a null keep_id and one kept row. An empty
    table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    digests = digest_runs(docs, text_of() if text is None else text, doc_id)
    return merged_runs(digests, keep, fan).select(
        F.col("_id").alias("doc_id"),
        F.col("_keep_id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_keep_row")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The documents that stay, with all their columns."""
    row = fresh(docs, "_row")
    rows = land(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    digests = land(
        rows.select(
            F.col(row).alias("_row"),
            F.spark_partition_id().alias("_run"),
            F.col("doc_id").cast("bigint").alias("_id"),
            F.unhex(F.sha2(text_of(), 256)).alias("_sha"),
            F.xxhash64(text_of()).alias("_check"),
            F.octet_length(text_of()).alias("_bytes"),
        ),
        "digests",
    )
    kept = merged_runs(digests, keep).where(F.col("_row") == F.col("_keep_row"))
    return rows.join(kept.select(F.col("_row").alias(row)), row, "left_semi").drop(row)


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
