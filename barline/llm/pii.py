"""Personal data: base patterns, and boosted selection of further candidates.

Base spans follow fixed patterns and checks (Luhn, octets, digit counts) and always
stay. Wider patterns of high recall propose overlapping candidates on top. Gradient
boosted trees learn from candidates that hold a base span of their kind, and from ones
that are no such data (wrong counts of digits, dates, lists, spans of another kind, numbers
that neither a check digit nor their form nor a word before vouches for); the
others, in formats the base patterns do not know, are what the trees decide about and
train nothing. So features leave out the marks by which base patterns tell formats. Per
kind, the threshold is the lowest probability from which at least ``PRECISION`` of the
candidates kept back hold a base span, halfway to the next one below; a rule decides where there is none. Candidates
above it that touch no base span, or hold a smaller one of their kind, are added, the
most likely one of each overlapping cluster. Everything is column
expressions, windows over the matches of one document, and Spark's own boosted trees.

A match and the text around it come from splitting and extracting by the same pattern;
possessive quantifiers and look-behinds keep the patterns linear in the text.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.common import text_of, with_rows
from barline.plans import land

KINDS = ("email", "ip", "card", "phone")

# Base patterns. A look-behind starts a match at the first character that can, and \G
# allows a start right after the match before.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Patterns of high recall. Digits inside a longer word, a hexadecimal key say, are none.
LOOSE = {
    "email": (
        r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?)"
        r"[\p{L}0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[\p{L}0-9-]++)++"
    ),
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:[.,]\x20?[0-9]{1,3}){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[\x20.-]{0,2}[0-9]){11,18}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])",
}
# What a text must contain for its patterns to be tried at all.
GUARD = {
    "email": lambda text: text.contains("@") | text.contains("at]") | text.contains("at)"),
    "ip": lambda text: F.col("_digits"),
    "card": lambda text: F.col("_digits"),
    "phone": lambda text: F.col("_digits"),
}

BEFORE, AFTER = 24, 12
PRECISION = 0.95
TREES, DEPTH = 8, 3
# Candidates the trees are fitted on at most, and the smallest number worth a fit.
SAMPLE, FEWEST = 200_000, 50
BINS = 50


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def value(i: Column) -> Column:
        digit = F.substr(number, F.length(number) - i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(0), F.length(number) - 1)
    return F.aggregate(places, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """The check of a base match."""
    number = digits(match)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(
            F.split(match, r"\."),
            lambda p: (F.length(part(p)) <= 3)
            & (F.coalesce(F.substr(part(p), F.lit(1), F.lit(3)).try_cast("int"), F.lit(0)) <= 255),
        )
    if kind == "card":
        return F.when(F.length(number).between(16, 19), luhn(number)).otherwise(False)
    return F.length(number).between(8, 15)


def matches(docs: DataFrame) -> DataFrame:
    """Per document, all matches of all patterns in text order of each pattern.

    Lands ``_row``, ``_id`` and ``_found``: kind, whether loose, number, match, length of
    the text since the match before, and the text around it.
    """
    texts = with_rows(
        docs.select(F.col("doc_id").cast("bigint").alias("_id"), text_of().alias("_text"))
    ).withColumn("_digits", F.col("_text").rlike("[0-9]"))
    patterns = [(kind, False, BASE[kind]) for kind in KINDS] + [
        (kind, True, LOOSE[kind]) for kind in KINDS
    ]
    none = F.array().cast("array<string>")
    pieces = {}
    for n, (kind, _, pattern) in enumerate(patterns):
        guard = GUARD[kind](F.col("_text"))
        pieces[f"_m{n}"] = F.when(
            guard, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
        ).otherwise(none)
    extracted = texts.withColumns(pieces)
    gaps = extracted.withColumns(
        {
            f"_g{n}": F.when(F.size(f"_m{n}") > 0, F.split("_text", pattern, -1)).otherwise(none)
            for n, (_, _, pattern) in enumerate(patterns)
        }
    )

    def described(n: int, kind: str, loose: bool) -> Column:
        gap = F.col(f"_g{n}")
        return F.transform(
            f"_m{n}",
            lambda m, i: F.struct(
                F.lit(kind).alias("kind"),
                F.lit(loose).alias("loose"),
                i.alias("i"),
                m.alias("match"),
                F.length(F.get(gap, i)).alias("gap"),
                F.right(F.get(gap, i), F.lit(BEFORE)).alias("before"),
                F.left(F.get(gap, i + 1), F.lit(AFTER)).alias("after"),
            ),
        )

    found = F.flatten(F.array(*[described(n, k, x) for n, (k, x, _) in enumerate(patterns)]))
    return land(gaps.select("_row", "_id", found.alias("_found")), "matches")


def spans(found: DataFrame) -> DataFrame:
    """One row per match with its place in code points; failing base matches are gone."""
    rows = found.select("_row", F.explode("_found").alias("_f")).select("_row", "_f.*")
    order = (
        Window.partitionBy("_row", "kind", "loose")
        .orderBy("i")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    size = F.length("match")
    placed = rows.withColumn("end", F.sum(F.col("gap") + size).over(order)).withColumn(
        "start", F.col("end") - size
    )
    valid = F.lit(False)
    for kind in KINDS:
        valid = F.when(F.col("kind") == kind, passes(kind, F.col("match"))).otherwise(valid)
    return land(placed.where(F.col("loose") | valid).drop("gap", "i"), "spans")


def touched(rows: DataFrame, keys: list[str]) -> Column:
    """Whether a base span of the same ``keys`` overlaps the span of the row."""
    by = Window.partitionBy(*keys).orderBy("start", "end")
    base = ~F.col("loose")
    reach = F.max(F.when(base, F.col("end"))).over(
        by.rowsBetween(Window.unboundedPreceding, 0)
    )
    following = F.min(F.when(base, F.col("start"))).over(
        by.rowsBetween(0, Window.unboundedFollowing)
    )
    return F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(
        following < F.col("end"), F.lit(False)
    )


def larger(rows: DataFrame) -> Column:
    """Whether the span of a row holds a smaller base span of its kind, and cuts none."""
    by = Window.partitionBy("_row", "kind").orderBy("start", F.desc("end"))
    base = ~F.col("loose")
    inner = F.min(F.when(base, F.struct("start", "end"))).over(
        by.rowsBetween(0, Window.unboundedFollowing)
    )
    reach = F.max(F.when(base, F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, 0))
    same = (inner["start"] == F.col("start")) & (inner["end"] == F.col("end"))
    return (
        F.coalesce((inner["end"] <= F.col("end")) & ~same, F.lit(False))
        & ~F.coalesce(reach > F.col("start"), F.lit(False))
    )


# Words that vouch for the number after them.
CARD_WORDS = r"(?i)(?:card|visa|mastercard|amex|pay|credit|debit)"
PHONE_WORDS = r"(?i)(?:tel|phone|fax|call|mobile|contact|dial)"
IP_WORDS = r"(?i)(?:\bip|addr|host|server)"


def vouched() -> Column:
    """Whether more than its digits speaks for a number: a check digit, the form of an
    international or bracketed number, or a word before."""
    match, kind, before = F.col("match"), F.col("kind"), F.col("before")
    return (
        F.when(kind == "card", before.rlike(CARD_WORDS) | luhn(digits(match)))
        .when(kind == "phone", before.rlike(PHONE_WORDS) | match.rlike(r"^(?:\+|00|\()"))
        .when(kind == "ip", ~match.contains(",") | before.rlike(IP_WORDS))
        .otherwise(True)
    )


def plain(match: Column) -> Column:
    """A match without the marks of its format: words and numbers with blanks between."""
    written = F.regexp_replace(match, r"\x20?[\[(](?:at|dot)[\])]\x20?", " ")
    return F.trim(F.regexp_replace(written, r"[^\p{L}0-9]+", " "))


def fails() -> Column:
    """Whether a candidate cannot be data of its kind, in whatever format."""
    match, kind = F.col("match"), F.col("kind")
    count = F.length(digits(match))
    dotted = F.regexp_replace(match, ",", ".")
    listed = match.rlike(r"[.,]\x20") | (match.contains(",") & (match.contains(".") | (count < 7)))
    date = match.rlike(
        r"^(?:(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2})$"
    )
    octets = match.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$") & passes("ip", match)
    return (
        F.when(kind == "ip", listed | ~passes("ip", dotted) | ~vouched())
        .when(kind == "card", F.when(count.between(16, 19), ~vouched()).otherwise(True))
        .when(kind == "phone", ~count.between(8, 15) | date | octets | ~vouched())
        .otherwise(False)
    )


def by_rule() -> Column:
    """The decision where no trees or no threshold of a kind are to be had."""
    number, before, kind = digits(F.col("match")), F.col("before"), F.col("kind")
    return (
        F.when(kind == "card", number.rlike("^[2-6]") & vouched())
        .when(kind == "phone", before.rlike(PHONE_WORDS))
        .otherwise(True)
    )


def features() -> dict[str, Column]:
    """Content and context of a candidate, without the marks of its format."""
    match, before, after = plain(F.col("match")), F.col("before"), F.col("after")
    last = F.right(before, F.lit(1))
    number = digits(match)
    count = lambda chars: F.length(match) - F.length(F.regexp_replace(match, chars, ""))
    flag = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    first = F.coalesce(F.left(number, F.lit(1)).try_cast("int"), F.lit(-1))
    return {
        **{f"is_{kind}": flag(F.col("kind") == kind) for kind in KINDS},
        "digits": F.length(number),
        "letters": count(r"\p{L}"),
        "groups": F.size(F.split(match, "[^0-9]+")),
        "first_digit": F.when(F.col("kind") == "card", first).otherwise(-1),
        "long_part": F.array_max(F.transform(F.split(match, "[^0-9]+"), lambda p: F.length(p))),
        "after_blank": flag(last.rlike(r"\s") | (F.length(before) == 0)),
        "after_word": flag(last.rlike(r"[\p{L}0-9]")),
        "after_mark": flag(last.rlike("[=:\"']")),
        "before_word": flag(after.rlike(r"^[\p{L}0-9]")),
        "before_mark": flag(after.rlike("^[\"'=/]")),
        "named": flag(before.rlike("(?i)(mail|tel|phone|fax|call|card|visa|iban|ip|addr|contact)")),
        "vouched": flag(vouched()),
        "secret": flag(before.rlike("(?i)(token|key|secret|hash|sha|id)\\W*$")),
    }


def added(all_spans: DataFrame, precision: float = PRECISION) -> DataFrame:
    """The candidates to redact beyond the base spans: ``_row``, kind, start, end."""
    values = {name: value.cast("double") for name, value in features().items()}
    marked = all_spans.withColumns(
        {
            "_same": touched(all_spans, ["_row", "kind"]),
            "_any": touched(all_spans, ["_row"]),
            "_more": larger(all_spans),
        }
    ).where("loose")
    candidates = land(
        marked.withColumns(
            {
                **values,
                "_fails": fails(),
                "_rule": by_rule(),
                # Null: a candidate to decide about.
                "label": F.when(F.col("_same"), 1.0).when(F.col("_any") | fails(), 0.0),
                "_fold": F.pmod(F.xxhash64("_row", "start", "end"), F.lit(1_000_000)),
            }
        ).drop("before", "after"),
        "candidates",
    )
    known = candidates.where("label IS NOT NULL")
    n, hits = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    train = known.where(F.col("_fold") < F.lit(int(min(700_000, 1e6 * SAMPLE / max(1, n)))))
    present = train.agg(F.min("label"), F.max("label")).first()
    columns = ["_row", "kind", "start", "end", "label", "_any", "_more", "_fails", "_rule", "_fold"]
    if n < FEWEST or present[0] == present[1]:
        scored = candidates.select(*columns, F.lit(1.0).alias("_p"))
        return _chosen(scored, {})
    assembler = VectorAssembler(inputCols=list(values), outputCol="_x")
    trees = GBTClassifier(
        featuresCol="_x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7
    ).fit(assembler.transform(train))
    scored = land(
        trees.transform(assembler.transform(candidates)).select(
            *columns, vector_to_array("probability")[1].alias("_p")
        ),
        "scored",
    )
    bins = (
        scored.where((F.col("_fold") >= 700_000) & F.col("label").isNotNull())
        .groupBy("kind", F.floor(F.col("_p") * BINS).alias("bin"))
        .agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("rows"))
        .collect()  # at most kinds x (BINS + 1) rows
    )
    thresholds = {}
    for kind in KINDS:
        hits = rows = 0.0
        held = sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"])
        for k, row in enumerate(held):
            hits, rows = hits + row["hits"], rows + row["rows"]
            if hits / rows >= precision:
                # Halfway to the next bin below that has candidates, or even odds.
                low = row["bin"]
                below = (low + held[k + 1]["bin"] + 1) / 2 if k + 1 < len(held) else min(low, BINS / 2)
                thresholds[kind] = below / BINS
    return _chosen(scored, thresholds)


def _chosen(scored: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """The most likely candidate of each cluster, by threshold or else by the rule."""
    taken = F.col("_rule")
    for kind, threshold in thresholds.items():
        taken = F.when(F.col("kind") == kind, F.col("_p") >= threshold).otherwise(taken)
    likely = scored.where(taken & ~F.col("_fails") & (~F.col("_any") | F.col("_more")))
    by = Window.partitionBy("_row").orderBy("start", "end", "kind")
    gap = F.col("start") >= F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    clusters = likely.withColumn("_new", F.when(gap, 1).otherwise(0)).withColumn(
        "_cluster", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))
    )
    best = Window.partitionBy("_row", "_cluster").orderBy(F.desc("_p"), "start", F.desc("end"), "kind")
    return (
        clusters.withColumn("_place", F.row_number().over(best))
        .where("_place = 1")
        .select("_row", "kind", "start", "end")
    )


def _joined(condition: Column) -> Column:
    """``kind:start:end`` of the collected spans by kind as listed, then start."""
    picked = F.array_sort(F.collect_list(F.when(condition, F.struct("k", "start", "end", "kind"))))
    return F.array_join(
        F.transform(
            picked,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans.

    A null text counts as empty; a document without a span has counts of zero, the
    digest of the empty string and an empty ``spans``. Repeated rows get a row each. With
    fewer than ``FEWEST`` candidates to learn from, or only one class of them, a rule on
    format and context decides what is added. An empty table gives an
    empty result. Other columns are not looked at.
    """
    found = matches(docs)
    every = spans(found.where(F.size("_found") > 0))
    more = added(every, precision)
    both = every.where("not loose").select("_row", "kind", "start", "end", F.lit(True).alias("_base"))
    both = both.unionByName(more.withColumn("_base", F.lit(False)))
    order = F.lit(0)
    for k, kind in enumerate(KINDS):
        order = F.when(F.col("kind") == kind, F.lit(k)).otherwise(order)
    per_doc = (
        both.withColumn("k", order)
        .groupBy("_row")
        .agg(
            *[F.count_if(F.col("_base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
            _joined(F.col("_base")).alias("_base_spans"),
            _joined(F.lit(True)).alias("spans"),
        )
    )
    empty = F.lit("")
    return (
        found.select("_row", "_id")
        .join(per_doc, "_row", "left")
        .select(
            F.col("_id").alias("doc_id"),
            *[F.coalesce(f"n_{kind}", F.lit(0).cast("bigint")).alias(f"n_{kind}") for kind in KINDS],
            F.sha2(F.coalesce("_base_spans", empty), 256).alias("base_sha256"),
            F.coalesce("spans", empty).alias("spans"),
        )
    )
