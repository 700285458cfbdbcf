"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of shuffled documents. A document's virtual finish time is the
source's words up to and including it, divided by the source's target. Up to
``REPEATS`` passes over a queue may be served. All copies are sorted globally by finish
time and cut off where their words reach the budget, so every source is served in
proportion to its weight at every moment and ends within a document of its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import WORD, fresh, lookup, prefix_sums, text_of
from barline.plans import land

WEIGHTS = (5, 2, 1)
REPEATS = 3
_SOURCE = ["_none", "_source"]


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = REPEATS
) -> DataFrame:
    """Per source: words, words of the sources before it, and target.

    Sources in code point order, null last, get ``weights`` in turn. A target stops at
    ``repeats`` times the source's words and the excess goes to the others by weight:
    the targets are ``min(limit, level * weight)``, with the level found from running
    sums over the sources in the order in which they reach their limit.
    """
    ranked = prefix_sums(
        sizes.groupBy(*_SOURCE).agg(F.sum("_size").alias("_words")).withColumn("_one", F.lit(1)),
        _SOURCE,
        {"_rank": "_one", "_upto": "_words"},
        "source-ranks",
    ).drop("_part", "_one")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    limited = ranked.withColumns(
        {"_weight": weight, "_limit": F.col("_words") * F.lit(repeats)}
    ).withColumn("_reach", F.col("_limit") / F.col("_weight"))
    ordered = prefix_sums(
        limited,
        ["_reach", *_SOURCE],
        {"_limits": "_limit", "_weights": "_weight"},
        "source-levels",
    ).drop("_part")
    total = ordered.agg(F.sum("_words"), F.sum("_weight")).first()
    words, heft = total[0] or 0, total[1] or 1
    level = (F.lit(words) - (F.col("_limits") - F.col("_limit"))) / (
        F.lit(heft) - (F.col("_weights") - F.col("_weight"))
    )
    first = (
        ordered.withColumn("_level", level)
        .where(F.col("_level") <= F.col("_reach"))
        .agg(F.min_by("_level", "_weights"))
        .first()[0]
    )
    return ordered.select(
        *_SOURCE,
        "_words",
        (F.col("_upto") - F.col("_words")).alias("_base"),
        F.least(
            F.col("_limit").cast("double"), F.lit(float(first or 0.0)) * F.col("_weight")
        ).alias("_target"),
    )


def queued(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    budget: int | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Each document with ``_copies``, the number of times the mix takes it.

    ``docs`` has the columns doc_id, text and source, and those named in ``extra``.
    """
    sizes = land(
        docs.select(
            *extra,
            F.col("doc_id").cast("bigint").alias("_id"),
            F.col("source").isNull().alias("_none"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
            word_count(text_of()).alias("_size"),
            F.md5(
                F.concat(
                    F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_of()
                )
            ).alias("_shuffle"),
        ),
        "sizes",
    )
    targets = land(source_targets(sizes, weights, repeats), "targets")
    if budget is None:
        budget = targets.agg(F.sum("_words")).first()[0] or 0
    order = [*_SOURCE, "_shuffle", "_size"]
    placed = prefix_sums(sizes, order, {"_upto": "_size"}, "queues")
    served = land(
        lookup(placed, targets, _SOURCE, "_part")
        .withColumn("_served", F.col("_upto") - F.col("_base"))
        .drop("_upto", "_base", "_part"),
        "served",
    )

    def finish(copy: Column | int) -> Column:
        copy = copy if isinstance(copy, Column) else F.lit(copy)
        return (copy * F.col("_words") + F.col("_served")) / F.nullif(F.col("_target"), F.lit(0.0))

    copies = (
        served.where(F.col("_size") > 0)
        .withColumn("_copy", F.explode(F.array(*[F.lit(i) for i in range(repeats)])))
        .where(F.col("_copy") * F.col("_words") + F.col("_served") - F.col("_size") < F.col("_target"))
        .select(finish(F.col("_copy")).alias("_finish"), "_shuffle", "_copy", "_size")
    )
    last = (
        prefix_sums(copies, ["_finish", "_shuffle", "_copy"], {"_sum": "_size"}, "finish-times")
        .where(F.col("_sum") <= F.lit(budget))
        .agg(F.max_by(F.struct("_finish", "_shuffle", "_copy"), "_sum"))
        .first()[0]
    )
    if last is None:
        taken = F.lit(0)
    else:
        cut = [F.lit(x) for x in last]
        taken = sum(
            F.when(
                (F.col("_size") > 0)
                & (F.col("_served") + F.lit(i) * F.col("_words") - F.col("_size") < F.col("_target"))
                & (
                    (finish(i) < cut[0])
                    | (finish(i) == cut[0])
                    & (
                        (F.col("_shuffle") < cut[1])
                        | (F.col("_shuffle") == cut[1]) & (F.lit(i) <= cut[2])
                    )
                ),
                1,
            ).otherwise(0)
            for i in range(repeats)
        )
    return served.withColumn("_copies", taken)


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS,
    budget: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words).

    ``budget`` defaults to the words of all documents. A null text has no words, a null
    source is a source of its own and the last one. Documents without words are never
    taken. The shuffle is by a digest of id and text, so reruns agree; rows that repeat
    both are next to each other and share their fate at the cut. An empty table gives
    an empty result.
    """
    return queued(docs, weights, repeats, budget).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).cast("bigint").alias("taken"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents the mix takes, each as often as it takes it, with all columns."""
    row, times = fresh(docs, "_row"), fresh(docs, "_times")
    rows = land(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    sizes = rows.select(F.col(row).alias("_row"), "doc_id", "text", "source")
    kept = queued(sizes, extra=["_row"]).where("_copies > 0")
    kept = kept.select(F.col("_row").alias(row), F.col("_copies").alias(times))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # array_repeat holds as many values as the mix takes the document, REPEATS at most.
    copies = F.explode(F.array_repeat(F.lit(0), F.col(times))).alias(fresh(docs, "_copy"))
    return rows.join(kept, row).select(*columns, copies).select(*columns)


def mix_sql(documents: str = "documents") -> str:
    """DuckDB: the words of each source, targets, finish times and the cut, as CTEs.

    The last CTE, ``mix``, has every document with its number of copies.
    """
    return f"""
sized AS (
  SELECT *, source IS NULL AS _none, coalesce(source, '') AS _source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS _size,
         md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS _shuffle
  FROM {documents}
), source_words AS (
  SELECT _none, _source, CAST(sum(_size) AS BIGINT) AS _words FROM sized GROUP BY ALL
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY _none, _source) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS _weight
  FROM source_words
), levels AS (
  SELECT *, 3 * _words / _weight AS _reach,
         ((SELECT CAST(sum(_words) AS DOUBLE) FROM weighed)
            - (sum(3 * _words) OVER w - 3 * _words))
         / ((SELECT CAST(sum(_weight) AS DOUBLE) FROM weighed) - (sum(_weight) OVER w - _weight)) AS _level
  FROM weighed
  WINDOW w AS (ORDER BY 3 * _words / _weight, _none, _source ROWS UNBOUNDED PRECEDING)
), targets AS (
  SELECT _none, _source, _words,
         least(CAST(3 * _words AS DOUBLE),
               (SELECT arg_min(_level, (_reach, _none, _source)) FROM levels WHERE _level <= _reach)
               * _weight) AS _target
  FROM levels
), served AS (
  SELECT s.*, t._words, t._target,
         sum(s._size) OVER (PARTITION BY s._none, s._source ORDER BY s._shuffle, s._size
                            ROWS UNBOUNDED PRECEDING) AS _served
  FROM sized s JOIN targets t USING (_none, _source)
), copies AS (
  SELECT *, (e * CAST(_words AS DOUBLE) + _served) / _target AS _finish
  FROM served, range(3) AS passes(e)
  WHERE _size > 0 AND e * _words + _served - _size < _target
), cut AS (
  SELECT *, sum(_size) OVER (ORDER BY _finish, _shuffle, e ROWS UNBOUNDED PRECEDING) AS _sum
  FROM copies
), mix AS (
  SELECT s.*, coalesce(c._copies, 0) AS _copies
  FROM served s LEFT JOIN (
    SELECT doc_id, count(*) AS _copies FROM cut
    WHERE _sum <= (SELECT sum(_words) FROM targets) GROUP BY doc_id
  ) c ON s.doc_id IS NOT DISTINCT FROM c.doc_id
)"""


ORACLE = f"""
WITH {mix_sql()}
SELECT doc_id, _size AS size, _words AS source_size, _target AS target,
       CAST(_size * _copies AS BIGINT) AS taken
FROM mix
"""
