"""Quality rules as a learned decision list.

Statistics of whole texts are plain column expressions. The list is learned from
labelled statistics by sequential covering: a rule grows by the condition with the
largest information gain for low quality, is pruned on rows it did not see, and the rows
it covers leave before the next rule grows. Thresholds are quantiles over all documents.
Every step is one aggregate; the driver sees counts per feature and bin only. The
result is an ordered ``CASE`` expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.common import SPACE, WORD, text_of
from barline.plans import land

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
MAX_RULES = 8
MAX_CONDITIONS = 3
QUANTILES = 40
# A rule joins the list if, on the rows kept back, this share of what it covers is bad.
PRECISION = 0.9

Condition = tuple[str, str, float]
Rule = tuple[Condition, ...]


def repeated_words(window: int = WINDOW) -> Column:
    """Words covered by windows that occur at least twice, from the column ``_windows``.

    ``_windows`` has a 64-bit hash of each window. Only texts with a repeated hash are
    sorted; the sorted (hash, place) pairs next to an equal one give the covered places.
    """
    pairs = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(sorted_pairs: Column) -> Column:
        last = F.size(sorted_pairs) - 1
        equal = lambda a, b: F.get(sorted_pairs, a)["h"] == F.get(sorted_pairs, b)["h"]
        hits = F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.when(
                F.coalesce(equal(k, k - 1), F.lit(False)) | F.coalesce(equal(k, k + 1), F.lit(False)),
                F.get(sorted_pairs, k)["i"],
            ),
        )
        places = F.array_sort(F.array_compact(hits))
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda done, place: F.struct(
                (done["n"] + place + window - F.greatest(done["end"], place)).alias("n"),
                (place + window).alias("end"),
            ),
            lambda done: done["n"],
        )

    found = F.transform(F.array(pairs), covered)[0]
    return F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), found).otherwise(0)


def text_statistics(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` that start with an underscore, and the statistics."""
    own = [c for c in docs.columns if c.startswith("_")]
    words = docs.select(*own, (text_of() if text is None else text).alias("_text")).withColumn(
        "_words", F.array_remove(F.split("_text", SPACE), "")
    )
    hashed = words.withColumns(
        {
            "_lines": F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)),
            "_windows": F.when(
                F.size("_words") > WINDOW,
                F.transform(
                    F.sequence(F.lit(1), F.size("_words") - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice("_words", i, F.lit(WINDOW))),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    )
    without = lambda chars: F.length(F.regexp_replace("_text", chars, ""))
    return hashed.select(
        *own,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        (F.length("_text") - without("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words().cast("bigint").alias("n_repeat_words"),
        F.size(F.array_distinct("_words")).cast("bigint").alias("n_distinct_words"),
        (F.length("_text") - without("[A-Z]")).cast("bigint").alias("n_upper"),
        (F.length("_text") - without("[!?]")).cast("bigint").alias("n_stress"),
    )


def features() -> dict[str, Column]:
    """Ratios the conditions are about; zero for a text without words."""
    share = lambda part, whole: F.coalesce(
        F.col(part) / F.nullif(F.col(whole).cast("double"), F.lit(0.0)), F.lit(0.0)
    )
    return {
        "mean_word_chars": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_lines": F.col("n_dup_lines").cast("double"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "stress_share": share("n_stress", "word_chars"),
        "words": F.col("n_words").cast("double"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED) * F.col("n_words")
    )


def holds(rule: Rule) -> Column:
    """The rule as a conjunction over the feature columns."""
    values = features()
    out = F.lit(True)
    for name, sign, threshold in rule:
        one = values[name] <= F.lit(threshold) if sign == "<=" else values[name] > F.lit(threshold)
        out = out & one
    return out


def verdict(rules: Sequence[Rule]) -> Column:
    """The ordered list as one expression: true where no rule holds."""
    if not rules:
        return F.lit(True)
    chain = F.when(holds(rules[0]), F.lit(False))
    for rule in rules[1:]:
        chain = chain.when(holds(rule), F.lit(False))
    return chain.otherwise(F.lit(True))


def _best_condition(
    rows: DataFrame, cuts: dict[str, list[float]]
) -> tuple[Condition | None, int, int]:
    """The condition of largest gain on ``rows``, and what it covers: bad, good rows."""
    if not any(cuts.values()):
        return None, 0, 0
    values = features()
    placed = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                sum((F.when(values[name] > F.lit(t), 1).otherwise(0) for t in found), F.lit(0)).alias("bin"),
            )
            for name, found in cuts.items()
            if found
        ]
    )
    counts = (
        rows.select("_bad", F.explode(placed).alias("_f"))
        .groupBy("_f.name", "_f.bin")
        .agg(F.sum("_bad").alias("bad"), F.sum(1 - F.col("_bad")).alias("good"))
        .collect()  # features x bins
    )
    by: dict[str, dict[int, tuple[int, int]]] = {}
    for row in counts:
        by.setdefault(row["name"], {})[row["bin"]] = (row["bad"], row["good"])
    best: tuple[float, Condition | None, int, int] = (0.0, None, 0, 0)
    for name in cuts:
        bins = by.get(name, {})
        bad_all, good_all = (sum(x[i] for x in bins.values()) for i in (0, 1))
        if not bad_all or not good_all:
            continue
        prior = math.log2(bad_all / (bad_all + good_all))
        bad = good = 0
        for i, threshold in enumerate(cuts[name]):
            more = bins.get(i, (0, 0))
            bad, good = bad + more[0], good + more[1]
            for sign, p, n in (("<=", bad, good), (">", bad_all - bad, good_all - good)):
                if p:
                    gain = p * (math.log2(p / (p + n)) - prior)
                    if gain > best[0] + 1e-9:
                        best = (gain, (name, sign, threshold), p, n)
    return best[1:]


def learn(
    stats: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    max_rules: int = MAX_RULES,
    max_conditions: int = MAX_CONDITIONS,
    precision: float = PRECISION,
) -> list[Rule]:
    """Rules that single out low quality, in order.

    ``stats`` has ``_id`` and the statistics. Two thirds of the labelled rows grow the
    rules, a third prunes them. Rows that the base rule already drops do not count.
    A doc_id with several labels is bad if most of them are 0.
    """
    values = features()
    quantiles = [i / QUANTILES for i in range(1, QUANTILES)]
    found = stats.where(~base_failed()).agg(
        *[F.percentile_approx(value, quantiles, 1000).alias(name) for name, value in values.items()]
    ).first()
    cuts = {name: sorted(set(found[name] or [])) for name in values}
    answers = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("_id"))
        .agg(F.when(F.avg(label) < 0.5, 1).otherwise(0).alias("_bad"))
    )
    rows = land(
        stats.where(~base_failed())
        .join(answers, "_id")
        .withColumn("_prune", F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(3)) == 0),
        "labelled",
    )
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows.where(verdict(rules))
        rule: Rule = ()
        grow = left.where(~F.col("_prune"))
        while len(rule) < max_conditions:
            condition, _, good = _best_condition(grow.where(holds(rule)), cuts)
            if condition is None:
                break
            rule = (*rule, condition)
            if not good:
                break
        if not rule:
            break
        prefixes = [rule[: i + 1] for i in range(len(rule))]
        kept_back = left.where("_prune").agg(
            *[
                F.sum(F.when(holds(prefix), F.col("_bad") if bad else 1 - F.col("_bad")).otherwise(0)).alias(f"{kind}{i}")
                for i, prefix in enumerate(prefixes)
                for kind, bad in (("bad", True), ("good", False))
            ]
        ).first()
        worth = [(kept_back[f"bad{i}"] or 0, kept_back[f"good{i}"] or 0) for i in range(len(prefixes))]
        score = lambda i: (worth[i][0] - worth[i][1]) / max(1, sum(worth[i]))  # noqa: E731, B023
        best = max(range(len(prefixes)), key=lambda i: (score(i), -i))
        bad, good = worth[best]
        if not bad or bad / (bad + good) < precision:
            break
        rules.append(prefixes[best])
    return rules


def judged(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and further counts.

    A null text has no words and fails the base rule. Without labels the list is empty
    and only the base rule decides. Repeated rows get equal verdicts. An empty table
    gives an empty result. Other columns are not looked at.
    """
    stats = land(
        text_statistics(docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text")),
        "text-statistics",
    )
    rules = learn(stats, labels, **settings)
    return stats.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(rules)).alias("kept"),
        "n_distinct_words",
        "n_upper",
        "n_stress",
    )
