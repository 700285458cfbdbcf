"""Every query by name: ``(session, data folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline import sources, streaming
from barline.operators import (
    cube,
    fx,
    incremental,
    indicators,
    labels,
    ledger,
    measures,
    model,
    regime,
    samples,
    sequence,
)
from barline.plans import asof_join, land
from barline.plans.landing import new_path
from workload import tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

AS_OF = "2001-08-02"
MONEY = ("gross_money", "fee_money", "interest_money", "borrow_money", "total_cost", "net_money")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, *exact: str) -> DataFrame:
    """Doubles to 6 decimals (money to cents); columns in ``exact`` as they are."""

    def value(name: str, kind: str) -> Column:
        if kind != "double" or name in exact:
            return F.col(name)
        return F.round(name, 2 if name in MONEY else 6).alias(name)

    return df.select(*[value(name, kind) for name, kind in df.dtypes])


# --- sources ----------------------------------------------------------------------


@query
def ohlcv_bars(spark, folder):
    return tables.bars(spark, folder)


@query
def ohlcv_bars_wide(spark, folder):
    return tables.wide_bars(spark, folder)


@query
def hourly_bars(spark, folder):
    return tables.hourly_bars(spark, folder)


@query
def fx_rates(spark, folder):
    return tables.rates(spark, folder)


@query
def lookback_filter(spark, folder):
    return sources.lookback(tables.bars(spark, folder), AS_OF)


@query
def universe_filter(spark, folder):
    enabled = tables.assets(spark, folder).where("enabled and asset_class = 'equity'")
    return sources.in_universe(tables.bars(spark, folder), enabled)


@query
def concat_bars(spark, folder):
    """Local and foreign bars as two feeds, the second in another column order."""
    both = tables.bars(spark, folder)
    local = both.where(F.col("ticker").ilike("%.MX"))
    foreign = both.where(~F.col("ticker").ilike("%.MX"))
    return sources.concat_bars(local, foreign.select(*reversed(foreign.columns)))


@query
def distinct_tickers(spark, folder):
    return sources.distinct_tickers(tables.bars(spark, folder))


@query
def asset_dim(spark, folder):
    return tables.assets(spark, folder)


@query
def duplicate_bar_keys(spark, folder):
    """Quality check on the raw trades' key: days on which a part traded more than once."""
    items = tables.table(spark, folder, "lineitem").select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("dt")
    )
    return sources.duplicate_keys(items, "l_partkey", "dt")


@query
def vendor_csv_bars(spark, folder):
    """Bars through vendor files: a CSV folder per ticker, one read with its ticker as a constant."""
    path, one = new_path(spark, "vendor"), "ECONOMY"
    headers = {new: old for old, new in sources.VENDOR_HEADERS.items()}
    bars = tables.staged_bars(spark, folder).withColumnsRenamed(headers)
    bars.write.option("header", True).partitionBy("ticker").csv(path)
    schema = "Date date, " + ", ".join(
        f"`{name}` double" for name in sources.VENDOR_HEADERS if name != "Date"
    )
    whole = sources.read_bars(spark, path, "csv", f"{schema}, ticker string", header="true")
    alone = sources.read_bars(
        spark, f"{path}/ticker={one}", "csv", schema, ticker=one, header="true"
    )
    return sources.concat_bars(whole.where(F.col("ticker") != one), alone)


@query
def replaced_table(spark, folder):
    """A table written twice through the replace sink and read back."""
    bars, path = tables.staged_bars(spark, folder), new_path(spark, "replaced")
    sources.replace_table(sources.lookback(bars, AS_OF), path)
    sources.replace_table(bars, path)
    return sources.read_table(spark, path)


@query
def snapshot_table(spark, folder):
    """A table replaced three times through its pointer, the last time from itself."""
    bars, path = tables.staged_bars(spark, folder), new_path(spark, "snapshots")
    sources.replace_snapshot(sources.lookback(bars, AS_OF), path)
    sources.replace_snapshot(bars, path)
    sources.replace_snapshot(sources.read_snapshot(spark, path), path)
    return sources.read_snapshot(spark, path)


# --- currency ---------------------------------------------------------------------


def _bars_and_rates(spark, folder):
    return tables.staged_bars(spark, folder), tables.staged_rates(spark, folder)


@query
def fx_inner_join(spark, folder):
    return fx.fx_join(*_bars_and_rates(spark, folder))


@query
def fx_one_step_fill(spark, folder):
    filled = fx.fx_fill(*_bars_and_rates(spark, folder))
    return filled.select("ticker", "dt", "fx_close")


def _asof(spark, folder, staleness: int | None) -> DataFrame:
    bars, rates = _bars_and_rates(spark, folder)
    return fx.fx_asof(bars, rates, staleness).select("ticker", "dt", "fx_close", "fx_close_at")


@query
def fx_asof_1(spark, folder):
    """The last known rate, at most a day old."""
    return _asof(spark, folder, 1)


@query
def fx_asof_3(spark, folder):
    return _asof(spark, folder, 3)


@query
def fx_asof(spark, folder):
    return _asof(spark, folder, None)


@query
def benchmark_asof(spark, folder):
    """For every bar of the wide universe the last close of its part type, at most 5 days old,
    the day itself left out of half of the types' bars."""
    wide = tables.staged_bars(spark, folder, wide=True)
    kind = F.substring_index("ticker", "-", -1)
    types = tables.staged_bars(spark, folder).where(F.unix_date("dt") % 2 == 0)
    closes = types.select(
        F.regexp_replace("ticker", "(?i)\\.mx$", "").alias("kind"), "dt", F.col("close").alias("bm_close")
    )
    asked = wide.select("ticker", kind.alias("kind"), "dt", "close")
    return asof_join(asked, closes, ["kind"], "dt", "bm_close", staleness=5, bucket=256)


@query
def fx_convert(spark, folder):
    priced = fx.fx_convert(fx.fx_fill(*_bars_and_rates(spark, folder)))
    return priced.select("ticker", "dt", *fx.PRICES, "volume")


# --- features ---------------------------------------------------------------------


def _indicators(spark, folder, *names: str) -> DataFrame:
    table = indicators.indicator_table(*_bars_and_rates(spark, folder))
    return rounded(table.select("ticker", "dt", *names))


@query
def log_returns(spark, folder):
    return _indicators(spark, folder, "log_ret")


@query
def moving_avgs(spark, folder):
    return _indicators(spark, folder, "ma_20", "ma_10")


@query
def rolling_vol(spark, folder):
    return _indicators(spark, folder, "rv_20", "rv_10")


@query
def volume_z(spark, folder):
    return _indicators(spark, folder, "vol_z_20", "vol_z_10")


@query
def true_range(spark, folder):
    return _indicators(spark, folder, "tr")


@query
def atr_norm(spark, folder):
    return _indicators(spark, folder, "atr_20", "atr_10", "atr_n_20", "atr_n_10")


@query
def rsi_norm(spark, folder):
    return _indicators(spark, folder, "rsi_n_20", "rsi_n_10")


@query
def dir_movement(spark, folder):
    return _indicators(spark, folder, "dm_pos", "dm_neg")


@query
def di(spark, folder):
    return _indicators(spark, folder, "di_pos_20", "di_pos_10", "di_neg_20", "di_neg_10")


@query
def dx(spark, folder):
    return _indicators(spark, folder, "dx_20", "dx_10")


@query
def adx_norm(spark, folder):
    return _indicators(spark, folder, "adx_n_20", "adx_n_10")


@query
def master_features(spark, folder):
    table = indicators.master_features(*_bars_and_rates(spark, folder))
    return rounded(table.drop("rn", "n", "next_ret"))


@query
def master_features_wide(spark, folder):
    table = indicators.master_features(
        tables.staged_bars(spark, folder, wide=True), tables.staged_rates(spark, folder)
    )
    return rounded(table.drop("rn", "n", "next_ret"))


@query
def bars_with_nan(spark, folder):
    """Vendor bars with NaN in place of some closes and volumes: NaN counts as missing."""
    bars, rates = _bars_and_rates(spark, folder)
    day, nan = F.unix_date("dt"), F.lit(float("nan"))
    holes = {
        "close": F.when(day % 41 == 0, nan).otherwise(F.col("close")),
        "volume": F.when(day % 67 == 0, nan).otherwise(F.col("volume").cast("double")),
    }
    vendor = sources.canonical_bars(bars.withColumns(holes))
    table = indicators.master_features(vendor, rates)
    return rounded(table.drop("rn", "n", "next_ret"))


@query
def repeated_bar_keys(spark, folder):
    """Quality check on bars from two feeds: keys that both of them have."""
    bars = tables.staged_bars(spark, folder)
    feeds = sources.concat_bars(bars, bars.where(F.unix_date("dt") % 29 == 0))
    return sources.duplicate_keys(feeds, "ticker", "dt")


@query
def master_features_incremental(spark, folder):
    """The table of features after two updates: bars of the first years, some of them late or
    wrong, then the rest with what was late and corrections of what was wrong."""
    bars, rates = _bars_and_rates(spark, folder)
    day, path = F.unix_date("dt"), new_path(spark, "incremental")
    wrong = F.when(day % 97 == 0, F.lit(1.25)).otherwise(F.lit(1.0))
    early = bars.where((F.col("dt") < "1996-01-01") & (day % 13 != 5)).withColumns(
        {c: F.col(c) * wrong for c in ("high", "close")}
    )
    incremental.update_features(path, early, rates)
    changed = bars.where((F.col("dt") >= "1996-01-01") | (day % 13 == 5) | (day % 97 == 0))
    incremental.update_features(path, bars, rates, changed)
    return rounded(incremental.read_features(spark, path).drop("next_ret"))


@query
def master_features_corrected(spark, folder):
    """Days of one ticker come in wrong and are corrected: its neighbourhood alone is renewed."""
    bars, rates = _bars_and_rates(spark, folder)
    days, path = F.col("dt").between("1995-03-01", "1995-03-20"), new_path(spark, "corrected")
    hit = days & (F.col("ticker") == "ECONOMY")
    first = bars.withColumns({c: F.when(hit, F.col(c) * 2).otherwise(F.col(c)) for c in ("low", "close")})
    incremental.update_features(path, first, rates)
    incremental.update_features(path, bars, rates, bars.where(hit))
    return rounded(incremental.read_features(spark, path).drop("next_ret"))


@query
def master_features_layout(spark, folder):
    """The features from bars laid out for them; no row is shuffled."""
    table = sources.layout_features(tables.staged_layout(spark, folder))
    return rounded(table.drop("rn", "n", "next_ret"))


@query
def master_features_slice(spark, folder):
    """The features of one asset class, from the lanes of its tickers alone."""
    equity = tables.staged_assets(spark, folder).where("asset_class = 'equity'")
    part = sources.in_lanes(tables.staged_layout(spark, folder), equity)
    return rounded(sources.layout_features(part).drop("rn", "n", "next_ret"))


@query
def ticker_history(spark, folder):
    features = tables.staged_features(spark, folder)
    columns = ["ticker", "dt", *indicators.feature_columns(), "rn"]
    return rounded(sources.ticker_history(features, "ECONOMY", columns))


# --- regime and labels ------------------------------------------------------------


@query
def vol_regime(spark, folder):
    return rounded(regime.volatility_regime(tables.staged_features(spark, folder)))


def _labels(spark, folder) -> DataFrame:
    return labels.label_rows(tables.staged_features(spark, folder))


@query
def regime_features(spark, folder):
    """Warm rows with the chosen window's feature set."""
    return rounded(
        _labels(spark, folder).select(
            "ticker", "dt", "rn", "win", "log_ret", *indicators.FAMILIES
        )
    )


@query
def ma5_baseline(spark, folder):
    return rounded(_labels(spark, folder).select("ticker", "dt", "ma5"))


@query
def label_band(spark, folder):
    return rounded(
        _labels(spark, folder).groupBy("ticker").agg(F.max("band").alias("band"))
    )


@query
def label_classes(spark, folder):
    return _labels(spark, folder).select("ticker", "dt", "label")


@query
def label_next(spark, folder):
    return _labels(spark, folder).select("ticker", "dt", "label", "label_next")


# --- samples ----------------------------------------------------------------------


@query
def chrono_split(spark, folder):
    return labels.chrono_split(_labels(spark, folder)).select(
        "ticker", "dt", "split", "split_rn", "split_n", "label_next"
    )


@query
def scaler_stats(spark, folder):
    return rounded(
        samples.scaler_stats(tables.staged_split(spark, folder)).drop("clean_n")
    )


def _scaled(spark, folder) -> DataFrame:
    split = tables.staged_split(spark, folder)
    return samples.scaled_features(split, samples.scaler_stats(split))


@query
def scaled_features(spark, folder):
    return rounded(
        _scaled(spark, folder).select("ticker", "dt", "split", *samples.SAMPLE_FEATURES)
    )


@query
def sequence_samples(spark, folder):
    """Each sample by its key, target, length, first and last return, and sum of all values."""
    rows = samples.sequence_samples(_scaled(spark, folder))
    total = F.aggregate(F.flatten("x"), F.lit(0.0), lambda acc, value: acc + value)
    return rounded(
        rows.select(
            "ticker",
            "split",
            "dt",
            "y",
            F.size("x").alias("x_rows"),
            F.element_at("x", 1)[0].alias("first_ret"),
            F.element_at("x", -1)[0].alias("last_ret"),
            total.alias("x_sum"),
        )
    )


@query
def class_weights(spark, folder):
    return rounded(samples.class_weights(samples.sequence_samples(_scaled(spark, folder))))


# --- ledger -----------------------------------------------------------------------


def _scored(spark, folder) -> DataFrame:
    return tables.arithmetic_scores(
        ledger.evaluation_rows(tables.staged_split(spark, folder))
    )


@query
def positions(spark, folder):
    return ledger.positions(_scored(spark, folder)).select("ticker", "dt", "pos")


@query
def leverage(spark, folder):
    return ledger.positions(_scored(spark, folder)).select("ticker", "dt", "lev")


@query
def cost_columns(spark, folder):
    costs = ledger.cost_columns(ledger.positions(_scored(spark, folder)))
    return costs.select(
        "ticker", "dt", *[F.round(c, 9).alias(c) for c in ("fee", "interest", "borrow")]
    )


@query
def strategy_fact(spark, folder):
    return rounded(ledger.strategy_fact(_scored(spark, folder)).drop("rn", "n"))


@query
def strategy_fact_wide(spark, folder):
    split = tables.staged_split(spark, folder, wide=True)
    scored = tables.arithmetic_scores(ledger.evaluation_rows(split))
    return rounded(ledger.strategy_fact(scored).drop("rn", "n"))


# --- measures ---------------------------------------------------------------------


def _star(spark, folder) -> tuple[DataFrame, DataFrame]:
    return tables.staged_fact(spark, folder), tables.staged_assets(spark, folder)


@query
def kpi_scorecard(spark, folder):
    return rounded(measures.kpi_scorecard(*_star(spark, folder)))


@query
def kpi_scorecard_equity(spark, folder):
    """The scorecard under a slicer."""
    return rounded(measures.kpi_scorecard(*_star(spark, folder), where="asset_class = 'equity'"))


@query
def kpi_scorecard_orphans(spark, folder):
    """The dimension lacks a traded asset; without a slicer nothing of the fact is lost."""
    fact, dim = _star(spark, folder)
    return rounded(measures.kpi_scorecard(fact, dim.where("ticker <> 'ECONOMY'")))


@query
def directional_accuracy(spark, folder):
    return rounded(measures.directional_accuracy(*_star(spark, folder)))


@query
def equity_curve(spark, folder):
    return rounded(measures.equity_curve(*_star(spark, folder)))


@query
def latest_signal(spark, folder):
    return measures.latest_signal(tables.staged_fact(spark, folder))


@query
def latest_signal_equity(spark, folder):
    """The signal panel under a slicer."""
    fact, dim = _star(spark, folder)
    return measures.latest_signal(fact, dim=dim, where="asset_class = 'equity'")


@query
def perf_by_asset(spark, folder):
    return rounded(measures.perf_by_asset(*_star(spark, folder)))


# Days of the date slicer.
RANGE = (date(2000, 6, 14), date(2001, 5, 9))


def _cube(spark, folder) -> tuple[str, DataFrame]:
    fact, dim = _star(spark, folder)
    path = new_path(spark, "cube")
    cube.store_cube(fact, path)
    return path, dim


@query
def kpi_scorecard_range(spark, folder):
    """The scorecard under a date slicer that cuts its first and last month."""
    path, dim = _cube(spark, folder)
    return rounded(cube.kpi_scorecard_between(spark, path, dim, *RANGE))


@query
def perf_by_asset_range(spark, folder):
    path, dim = _cube(spark, folder)
    return rounded(cube.perf_by_asset_between(spark, path, dim, *RANGE))


@query
def perf_by_asset_since(spark, folder):
    """From a day to the last one, over whole months but the first."""
    path, dim = _cube(spark, folder)
    return rounded(cube.perf_by_asset_between(spark, path, dim, RANGE[0]))


@query
def alpha_by_class(spark, folder):
    return rounded(measures.alpha_by_class(*_star(spark, folder)))


@query
def leverage_curve(spark, folder):
    return rounded(measures.leverage_curve(*_star(spark, folder)))


@query
def position_tally(spark, folder):
    return measures.position_tally(*_star(spark, folder))


@query
def cost_impact(spark, folder):
    return rounded(measures.cost_impact(*_star(spark, folder)))


@query
def best_asset(spark, folder):
    return rounded(measures.best_asset(*_star(spark, folder)))


# --- model ------------------------------------------------------------------------


def _samples(spark, folder) -> DataFrame:
    return tables.staged(
        spark, folder, "samples", lambda: samples.sequence_samples(_scaled(spark, folder))
    )


@query
def model_scores_pooled(spark, folder):
    rows = _samples(spark, folder)
    return model.pooled_scores(rows, samples.class_weights(rows))


@query
def model_scores_per_ticker(spark, folder):
    return model.ticker_scores(_samples(spark, folder))


@query
def class_moments(spark, folder):
    """Counts, sums and products per ticker and class that the discriminants are solved from."""
    moments, d = F.col("moments"), F.col("d")
    last = d - F.lit(len(samples.SAMPLE_FEATURES))
    return rounded(
        model.class_moments(_samples(spark, folder))
        .withColumn("d", ((F.sqrt(8 * F.size("moments") + 1) - 3) / 2).cast("int"))
        .select(
            "ticker",
            "y",
            F.get(moments, F.lit(0)).cast("bigint").alias("n"),
            F.get(moments, F.lit(1)).alias("sum_first"),
            F.get(moments, last + 1).alias("sum_last"),
            F.get(moments, d + 1).alias("square_first"),
            F.get(moments, d + 1 + last).alias("cross_last"),
        )
    )


@query
def model_score_rows(spark, folder):
    """Every test sample has three scores between 0 and 1 that add up to 1."""
    scores = model.ticker_scores(_samples(spark, folder))
    return scores.select(
        "ticker",
        "dt",
        F.round(sum((F.col(s) for s in model.SCORES), F.lit(0.0)), 6).alias("total"),
        F.forall(F.array(*model.SCORES), lambda p: p.between(0, 1)).alias("in_range"),
    )


@query
def recurrent_states(spark, folder):
    """A state of two numbers for every sample."""
    state = F.col("state")
    return rounded(
        sequence.recurrent_states(_samples(spark, folder), 2).select(
            "ticker", "split", "dt", state[0].alias("state_0"), state[1].alias("state_1")
        )
    )


@query
def walk_forward_folds(spark, folder):
    """What each fold learns from and what it is validated on."""
    per_part = (
        sequence.walk_forward(_samples(spark, folder))
        .groupBy("win", "stretch", "first_fold")
        .agg(F.count(F.lit(1)).alias("n"), F.min("dt").alias("first"), F.max("dt").alias("last"))
    )
    folds = F.sequence(F.lit(1), F.lit(sequence.FOLDS))
    learns, judged = F.col("first_fold") <= F.col("fold"), F.col("stretch") == F.col("fold")
    return (
        per_part.withColumn("fold", F.explode(folds))
        .groupBy("win", "fold")
        .agg(
            F.coalesce(F.sum(F.when(learns, F.col("n"))), F.lit(0)).alias("train_rows"),
            F.max(F.when(learns, F.col("last"))).alias("last_train_dt"),
            F.sum(F.when(judged, F.col("n"))).alias("valid_rows"),
            F.min(F.when(judged, F.col("first"))).alias("first_valid_dt"),
            F.max(F.when(judged, F.col("last"))).alias("last_valid_dt"),
        )
        .where(F.col("valid_rows") > 0)
    )


@query
def fold_losses(spark, folder):
    """The losses of a readout of the last return, for every fold and ridge."""
    rows = sequence.walk_forward(_samples(spark, folder)).withColumn(
        "features", F.array(F.element_at("x", -1)[0])
    )
    return rounded(sequence.fold_losses(sequence.fold_products(rows)))


@query
def sequence_scores_small(spark, folder):
    """Scores by a state of one number: states, folds, choice of the ridge, fit and scores."""
    return rounded(sequence.sequence_scores(_samples(spark, folder), width=1))


@query
def model_scores_sequence(spark, folder):
    return sequence.sequence_scores(_samples(spark, folder))


@query
def model_strategy_fact(spark, folder):
    """The whole chain from bars to the ledger of a fitted model."""
    scores = model_scores_pooled(spark, folder)
    evaluation = ledger.evaluation_rows(tables.staged_split(spark, folder))
    return ledger.strategy_fact(ledger.with_scores(evaluation, scores)).drop("rn", "n")


# --- streams ----------------------------------------------------------------------


@query
def stream_ingest_bars(spark, folder):
    """Bar files as a stream, appended to another table."""
    bars, path = tables.staged_bars(spark, folder), new_path(spark, "bar-files")
    bars.write.parquet(path)
    stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 4).parquet(path)
    out, checkpoint = new_path(spark, "ingest"), new_path(spark, "ingest-state")
    streaming.ingest_bars(stream, out, checkpoint)
    return spark.read.schema(bars.schema).parquet(out)


@query
def stream_hourly_bars(spark, folder):
    """All events in files of mixed times, one file per batch; must equal the batch bars."""
    events = tables.table(spark, folder, "events")
    path = new_path(spark, "events")
    events.repartition(8, F.xxhash64("event_id")).write.parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out, checkpoint = new_path(spark, "stream-bars"), new_path(spark, "stream-bars-state")
    ticks = tables.event_ticks(stream.withColumn("ts", F.col("ts").cast("timestamp")))
    streaming.run_available(ticks, streaming.bar_parts(out), checkpoint, mode="append")
    bars = streaming.merged_bars(spark, out)
    return bars.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _event_files(spark, folder, files: int) -> DataFrame:
    """The events as a stream of files of mixed times, one file per batch, in order."""
    events = tables.table(spark, folder, "events")
    path, mark = new_path(spark, "events"), F.col("event_id") % files
    for i in range(files):
        events.where(mark == i).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return tables.event_ticks(stream.withColumn("ts", F.col("ts").cast("timestamp")))


@query
def stream_compacted_bars(spark, folder):
    """Bars of ten batches, their parts merged in levels; must equal the batch bars."""
    out, checkpoint = new_path(spark, "compacted"), new_path(spark, "compacted-state")
    ticks = _event_files(spark, folder, 10)
    streaming.run_available(ticks, streaming.compacting_parts(out), checkpoint, mode="append")
    bars = streaming.compacted_bars(spark, out)
    return bars.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_late_account(spark, folder):
    """Per batch the trades given, kept and put aside, a day behind the watermark or more."""
    out, aside = new_path(spark, "kept-bars"), new_path(spark, "late-trades")
    split = streaming.late_aside(aside, "1 day", streaming.compacting_parts(out))
    streaming.run_available(
        _event_files(spark, folder, 5), split, new_path(spark, "late-state"), mode="append"
    )
    return streaming.account(spark, aside)


@query
def stream_bars_with_late(spark, folder):
    """The kept bars with the late trades merged in; must equal the batch bars."""
    out, aside = new_path(spark, "kept-bars"), new_path(spark, "late-trades")
    write = streaming.compacting_parts(out)
    split = streaming.late_aside(aside, "1 day", write)
    streaming.run_available(
        _event_files(spark, folder, 5), split, new_path(spark, "late-state"), mode="append"
    )
    write(streaming.late_rows(spark, aside), 5)  # as one more batch
    bars = streaming.compacted_bars(spark, out)
    return bars.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_latest_signal(spark, folder):
    """The fact as a file stream, two files per batch; must equal the batch signals."""
    fact, path = tables.staged_fact(spark, folder), new_path(spark, "fact-files")
    fact.write.parquet(path)
    stream = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", 2).parquet(path)
    out, checkpoint = new_path(spark, "stream-signals"), new_path(spark, "stream-signals-state")
    streaming.run_available(stream, streaming.keep_latest_signals(out), checkpoint, mode="append")
    return streaming.signals(spark, out)


@query
def stream_master_features(spark, folder):
    """Converted bars in six files, days out of order by up to a third of a year, a file per
    batch; must equal the features of all bars at once."""
    bars, rates = _bars_and_rates(spark, folder)
    converted = fx.fx_convert(fx.fx_fill(bars, rates)).select(*streaming.BAR)
    path, files = new_path(spark, "bar-files"), 6
    day = F.unix_date("dt") - F.unix_date(F.lit("1992-01-01").cast("date"))
    place = F.floor((day + F.pmod(F.xxhash64("ticker", "dt"), F.lit(120))) / F.lit(600))
    numbered = land(converted.withColumn("_file", F.least(F.lit(files - 1), place)), "numbered-bars")
    for i in range(files):  # one after the other, as they come in
        numbered.where(F.col("_file") == i).drop("_file").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(converted.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out, checkpoint = new_path(spark, "stream-features"), new_path(spark, "stream-features-state")
    streaming.run_available(stream, streaming.keep_features(out), checkpoint, mode="append")
    return rounded(streaming.streamed_features(spark, out).drop("next_ret"))


# --- long series: the same operators with small blocks -------------------------------


@query
def master_features_split(spark, folder):
    """Every ticker cut into blocks of 500 bars; must equal the features of whole series."""
    table = indicators.master_features(*_bars_and_rates(spark, folder), block_rows=500)
    return rounded(table.drop("rn", "n", "next_ret"))


@query
def label_next_split(spark, folder):
    features = tables.staged_features(spark, folder)
    return labels.label_rows(features, block_rows=300).select("ticker", "dt", "label", "label_next")


@query
def strategy_fact_split(spark, folder):
    return rounded(ledger.strategy_fact(_scored(spark, folder), block_rows=64).drop("rn", "n"))
