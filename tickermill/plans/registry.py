"""Named queries over a folder of input tables: `name -> f(spark, folder) -> DataFrame`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickermill import schemas
from tickermill.functions import categories, formatting, guards
from tickermill.functions.coercion import conform
from tickermill.operators import magic, peers, scoring
from tickermill.operators.dedup import not_yet_ingested
from tickermill.plans import derive, evolution, lake, medallion, price_reports, reports, runs
from tickermill.session import scratch_path, stored
from tickermill.sources import catalog, landing, tables
from tickermill.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]

# The `_split` queries deal small tables into so many value ranges that most groups are cut, as large
# groups are in large tables.
SPLIT = {"ranges": 64}
# Files of a run that is stored by ticker.
BUCKETS = 8


def _stored(name: str) -> Query:
    return lambda spark, folder: tables.read_table(spark, name, lake.warehouse(spark, folder))


def _newest(name: str) -> Query:
    return lambda spark, folder: tables.latest_partition(spark, name, lake.warehouse(spark, folder))


def _prices(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(derive.ticks(spark, folder))


def _on(report: Callable[..., DataFrame], *inputs: Query) -> Query:
    return lambda spark, folder: report(*[read(spark, folder) for read in inputs])


def _settled(df: DataFrame) -> DataFrame:
    """Float sums over a series, rounded past the digits that depend on summation order."""
    return df.withColumns(
        {
            "liquidez_2meses": F.round("liquidez_2meses", 2),
            "volatilidade_anualizada": F.round("volatilidade_anualizada", 9),
        }
    )


SILVER, GOLD = _stored(schemas.SILVER), _stored(schemas.GOLD)
SILVER_RUN, GOLD_RUN = _newest(schemas.SILVER), _newest(schemas.GOLD)


# --- price feed ---------------------------------------------------------------------------

def price_sample(spark: SparkSession, folder: str) -> DataFrame:
    ticks = derive.ticks(spark, folder).orderBy("event_id")
    return price_reports.sample_rows(ticks)


# --- guards, coercion, categories ---------------------------------------------------------

def numeric_guards(spark: SparkSession, folder: str) -> DataFrame:
    """Every guard over every line item, with junk, zero and NaN mixed in."""
    line = derive.load(spark, folder, "lineitem")
    text = (
        F.when(F.col("l_linenumber") == 1, "abc")
        .when(F.col("l_linenumber") == 2, "NaN")
        .when(F.col("l_linenumber") == 3, "-Infinity")
        .when(F.col("l_linenumber") == 4, "true")
        .otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("string")))
    )
    n = line.select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax", guards.number(text).alias("numero")
    )
    c = F.col
    return n.select(
        "l_orderkey",
        "l_linenumber",
        "numero",
        guards.safe_divide(c("numero"), c("l_discount")).alias("razao"),
        guards.safe_multiply(c("numero"), F.lit(1e308)).alias("produto"),
        guards.first_valid(c("numero"), c("l_tax")).alias("primeiro"),
        guards.sane("liq_corrente", c("numero") + c("l_linenumber")).alias("limitado"),
    )


def coerced_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items squeezed into the price layout: numbers to text, text to numbers, truncation."""
    line = derive.load(spark, folder, "lineitem")
    return conform(
        line.select(
            F.col("l_orderkey").alias("ticker"),
            F.when(F.col("l_linenumber") == 1, "x")
            .otherwise(F.col("l_extendedprice").cast("string"))
            .alias("abertura"),
            (F.col("l_quantity") > 25).alias("maxima"),
            F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("minima"),
            (F.col("l_quantity") * -1.9).alias("volume"),
            (F.col("l_extendedprice") * 1000).alias("evento_ts"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("data_pregao"),
            F.lit("dropped").alias("not_in_layout"),
        ),
        schemas.PRICES,
    )


def asset_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Class, financial sector and display labels per derived asset."""
    a = derive.assets(spark, folder)
    volatility = F.col("f_returnOnEquity") * 3
    return a.select(
        "symbol",
        "data_coleta",
        categories.asset_class(F.col("ticker")).alias("classe_ativo"),
        categories.is_financial(F.col("sector"), F.col("industry")).alias("setor_financeiro"),
        categories.size_bucket(F.col("k_marketCap")).alias("porte"),
        categories.risk_bucket(volatility).alias("perfil_risco"),
        formatting.heat_level(F.col("f_currentRatio") * 25).alias("faixa"),
        formatting.margin_class(F.col("r_earningsPerShare")).alias("classe_margem"),
    )


def display_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts and shares as the dashboard writes them, from thousands to billions."""
    line = derive.load(spark, folder, "lineitem")
    quantity = F.col("l_quantity").cast("double")
    amount = (
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double"))
        .when(F.col("l_linenumber") == 2, quantity * 1e6 + 1e5)
        .when(F.col("l_linenumber") == 3, -(quantity * 1e9 + 2e8))
        .otherwise(quantity * 1234)
    )
    return line.select(
        "l_orderkey",
        "l_linenumber",
        formatting.fixed_label(quantity * 1234, 1, " un").alias("fixo"),
        formatting.percent_label(F.when(F.col("l_tax") > 0, F.col("l_discount"))).alias("parcela"),
        formatting.compact_label(amount).alias("valor"),
    )


# --- bronze and silver --------------------------------------------------------------------

def bronze_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Newest collections of stored envelopes, chosen without their payloads."""
    bronze = medallion.stored_bronze_rows(lake.collected(spark, folder))
    return bronze.select(
        "ticker",
        "http_status",
        "modulos_solicitados",
        "fonte",
        "coletado_em",
        "data_coleta",
        F.get_json_object("payload_json", "$.regularMarketPrice").try_cast("double").alias("preco"),
    )


def raw_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes around payloads, every fifth fetch failed."""
    supplier = derive.load(spark, folder, "supplier")
    fetched = F.col("s_suppkey") % 5 != 0
    payload = F.struct(F.col("s_name").alias("symbol"), F.col("s_nationkey").alias("sector"))
    rows = supplier.select(
        *landing.envelope(
            F.concat(F.lit("S"), F.col("s_suppkey")),
            F.when(fetched, payload),
            F.lit("brapi"),
            F.when(fetched, 200).otherwise(401),
            F.lit("2026-10-01"),
            F.lit("2026-10-01T08:00:00"),
        )
    )
    symbol = F.get_json_object("payload_json", "$.symbol")
    return rows.withColumn("simbolo", symbol).drop("payload_json")


def bronze_partition(spark: SparkSession, folder: str) -> DataFrame:
    """One run of bronze, read by its partition."""
    root = lake.warehouse(spark, folder)
    dates = tables.partition_values(spark, schemas.BRONZE, root)
    run = tables.read_partition(spark, schemas.BRONZE, "data_coleta", dates[len(dates) // 2], root)
    return _bronze_summary(run)


def silver_indicators(spark: SparkSession, folder: str) -> DataFrame:
    return _settled(medallion.silver_rows(_stored(schemas.BRONZE)(spark, folder)))


def silver_prices(spark: SparkSession, folder: str) -> DataFrame:
    return medallion.series_rows(_stored(schemas.BRONZE)(spark, folder))


def parsed_series(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows from the parsed payloads."""
    return medallion.series_of(lake.parsed(spark, folder))


def run_day(spark: SparkSession, folder: str) -> DataFrame:
    """The second newest run made anew by one call, after a later one, and read through its catalog tables."""
    root, database = scratch_path(spark, "runs"), f"runs_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    dates = tables.partition_values(spark, schemas.BRONZE, lake.warehouse(spark, folder))
    envelopes = lake.collected(spark, folder).where(F.col("data_coleta").isin(dates[-2:]))
    for date in (dates[-1], dates[-2]):
        runs.run_day(spark, envelopes, root, date, database)
    return reports.run_census(spark.table(schemas.qualified(schemas.GOLD, database)))


# --- peers and scores ---------------------------------------------------------------------

def peer_groups(spark: SparkSession, folder: str) -> DataFrame:
    return peers.choose_groups(SILVER(spark, folder)).select(
        "data_coleta", "ticker", "fonte", "grupo_usado", "n_grupo"
    )


def _midranks(**limits: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = peers.with_groups(SILVER(spark, folder))
        names = F.array(*[F.lit(name) for name in scoring.BANDS])
        return peers.midranks(rows, scoring.DIRECTIONS, scoring.ROW_ID, **limits).select(
            *scoring.ROW_ID,
            F.get(names, F.col("metrica").cast("int")).alias("metrica"),
            "n_valores",
            "percentil",
        )

    return query


def _magic_positions(**limits: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = peers.with_groups(SILVER(spark, folder))
        names = F.array(*[F.lit(name) for name in magic.RANKED])
        return magic.dense_positions(rows, scoring.ROW_ID, **limits).select(
            *scoring.ROW_ID,
            F.get(names, F.col("metrica").cast("int")).alias("metrica"),
            F.col("posicao_densa").cast("long").alias("posicao_densa"),
        )

    return query


def _gold(**limits: int) -> Query:
    return lambda spark, folder: _settled(medallion.gold_rows(SILVER(spark, folder), **limits))


# --- sources, sinks, catalog --------------------------------------------------------------

def ingest_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes of tickers and dates that bronze lacks when only earlier runs are stored."""
    bronze = _stored(schemas.BRONZE)(spark, folder).select("ticker", "data_coleta")
    dates = tables.partition_values(spark, schemas.BRONZE, lake.warehouse(spark, folder))
    earlier = bronze.where(F.col("data_coleta") < dates[len(dates) // 2])
    return not_yet_ingested(bronze, earlier, schemas.key_columns(schemas.BRONZE))


def landing_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes written as raw JSON, replayed into a bronze of their own, counted per run."""
    zone, root = scratch_path(spark, "landing"), scratch_path(spark, "replayed")
    landing.write_landing(lake.collected(spark, folder), zone)
    feeds.load_bronze(spark, landing.REPLAY, zone, root)
    return _bronze_summary(tables.read_table(spark, schemas.BRONZE, root))


def _bronze_summary(bronze: DataFrame) -> DataFrame:
    price = F.get_json_object("payload_json", "$.regularMarketPrice").cast("decimal(18,2)")
    return bronze.groupBy("data_coleta").agg(
        F.count("*").alias("linhas"),
        F.count("payload_json").alias("com_payload"),
        F.max("coletado_em").alias("ultima_coleta"),
        F.sum(price).cast("double").alias("soma_precos"),
    )


def tick_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks as JSON files, streamed into the partitioned price table, twice; then read back."""
    inbox, path = scratch_path(spark, "tick_inbox"), scratch_path(spark, "tick_table")
    offsets = scratch_path(spark, "tick_offsets")
    ticks = derive.ticks(spark, folder)
    text = F.col("event_id") % 7 == 0  # volumes that are text: whole numbers count, others are no volume
    volume = F.concat("volume", F.when(F.col("event_id") % 2 == 0, F.lit(".5")).otherwise(F.lit("")))
    ticks.where(~text).drop("event_id").write.json(inbox)
    ticks.where(text).withColumn("volume", volume).drop("event_id").write.mode("append").json(inbox)
    for _ in range(2):
        feeds.append_ticks(spark, inbox, path, offsets).awaitTermination()
    stored = tables.read_table(spark, schemas.PRICES, "", path)
    return stored.groupBy("data_pregao").agg(
        F.count("*").alias("qtd_eventos"),
        F.sum("volume").alias("volume_total"),
        F.max("fechamento").alias("maior_fechamento"),
        F.count_distinct("ticker").alias("tickers"),
    )


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A feed in which every tenth line is cut short: accepted ticks and rejected lines counted."""
    inbox, path = scratch_path(spark, "mixed_inbox"), scratch_path(spark, "mixed_table")
    rejects = scratch_path(spark, "rejects")
    ticks = derive.ticks(spark, folder)
    line = F.to_json(F.struct(*[c for c in ticks.columns if c != "event_id"]))
    short = F.substring(line, 1, 20)
    mixed = ticks.select(F.when(F.col("event_id") % 10 == 0, short).otherwise(line).alias("value"))
    mixed.write.text(inbox)
    feeds.append_ticks(spark, inbox, path, scratch_path(spark, "offsets")).awaitTermination()
    feeds.quarantine(
        spark, inbox, schemas.PRICES, rejects, scratch_path(spark, "offsets")
    ).awaitTermination()
    accepted = tables.read_table(spark, schemas.PRICES, "", path).select(F.lit("aceita").alias("linha"))
    refused = spark.read.schema("linha string").json(rejects).select(F.lit("rejeitada").alias("linha"))
    return accepted.unionByName(refused).groupBy("linha").agg(F.count("*").alias("n"))


def latest_with_dateless(spark: SparkSession, folder: str) -> DataFrame:
    """Newest run of a table that also has rows without a run date."""
    root = scratch_path(spark, "dateless")
    silver = SILVER(spark, folder)
    dateless = silver.where(F.col("fonte") == "sintetico").withColumn("data_coleta", F.lit(None))
    tables.write_table(silver.unionByName(dateless), schemas.SILVER, root)
    newest = tables.latest_partition(spark, schemas.SILVER, root)
    return newest.groupBy("data_coleta", "fonte").agg(F.count("*").alias("linhas"))


# Envelopes in a compressed text file, which one task reads.
FILE_ENVELOPES = 20_000


def _write_inbox(envelopes: DataFrame, inbox: str, files: int = 1) -> None:
    """Envelopes as compressed JSON files from the tasks that hold them, at least so many files."""
    most = min(FILE_ENVELOPES, max(1, -(-envelopes.count() // files)))
    envelopes.write.mode("append").option("maxRecordsPerFile", most).json(inbox, compression="gzip")


def envelope_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes as JSON files, taken in by several micro-batches and merged into bronze once."""
    inbox, root = scratch_path(spark, "envelope_inbox"), scratch_path(spark, "streamed")
    batch = lake.collected(spark, folder)
    _write_inbox(batch, inbox, files=3)
    written = len(spark.read.text(inbox).inputFiles())
    feeds.ingest_envelopes(
        spark, inbox, root, scratch_path(spark, "envelope_offsets"), files_per_batch=max(2, -(-2 * written // 3))
    ).awaitTermination()
    feeds.compact_envelopes(spark, root)
    return _bronze_summary(tables.read_table(spark, schemas.BRONZE, root))


def envelope_state(spark: SparkSession, folder: str) -> DataFrame:
    """The newest envelopes held in a state store: first collections, then later and repeated ones after a
    restart, read together with what is stored."""
    inbox, root = scratch_path(spark, "state_inbox"), scratch_path(spark, "state_bronze")
    offsets = scratch_path(spark, "state_offsets")
    rows = lake.collected(spark, folder)
    late = F.col("coletado_em").endswith("T18:00:00+00:00")
    for part in (rows.where(late & (F.length("ticker") % 2 == 0)), rows.where(~late), rows):
        _write_inbox(part, inbox)
        # Run dates are years apart in this data; none of them may be too late.
        feeds.ingest_newest_envelopes(spark, inbox, root, offsets, delay="4000 days").awaitTermination()
    return _bronze_summary(feeds.current_envelopes(spark, root))


def partition_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """Gold written again for its two newest runs, as new versions that the catalog points to: same rows,
    older runs untouched."""
    root, database = scratch_path(spark, "rewritten"), f"rewritten_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    gold = GOLD(spark, folder)
    tables.write_table(gold, schemas.GOLD, root)
    catalog.register_table(spark, schemas.GOLD, root, database)
    dates = catalog.registered_values(spark, schemas.GOLD, database)
    catalog.replace_partitions(gold.where(F.col("data_referencia").isin(dates[-2:])), schemas.GOLD, root, database)
    return reports.run_census(spark.table(schemas.qualified(schemas.GOLD, database)))


def series_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Runs that cover different tickers of the same sessions, older ones merged under a newer one."""
    root = scratch_path(spark, "upserted")
    bronze = _stored(schemas.BRONZE)(spark, folder)
    rows = stored(medallion.series_rows(bronze), "series")
    part = F.pmod(F.length("ticker"), F.lit(2))
    newest = rows.agg(F.max("data_coleta")).first()[0]
    late = F.col("data_coleta") == newest
    for piece in (late & (part == 0), late & (part == 1), ~late, late & (part == 1)):
        tables.upsert_table(
            rows.where(piece), schemas.SERIES, root, newest=medallion.newest_run_first()
        )
    return tables.read_table(spark, schemas.SERIES, root)


def _database(spark: SparkSession, folder: str) -> str:
    # One database per application and folder: a shared catalog may know older locations.
    *_, app, digest = lake.scratch(spark, folder, "").rstrip("/").split("/")
    database = f"lake_{digest}_{app}".replace("-", "_")
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {database} "
        f"LOCATION '{lake.scratch(spark, folder, 'database')}'"
    )
    return database


def _registered(spark: SparkSession, folder: str) -> str:
    """Database with the stored layers registered as external tables."""
    root, database = lake.warehouse(spark, folder), _database(spark, folder)
    for name in (schemas.SILVER, schemas.GOLD):
        catalog.register_table(spark, name, root, database)
    return database


def _by_ticker(name: str) -> Query:
    """The newest run of a layer, stored by ticker when it is first asked for."""

    def read(spark: SparkSession, folder: str) -> DataFrame:
        root, database = lake.warehouse(spark, folder), _database(spark, folder)
        run = tables.partition_values(spark, name, root)[-1]
        if not spark.catalog.tableExists(schemas.bucketed(name, database)):
            newest = tables.latest_partition(spark, name, root)
            catalog.store_bucketed_run(newest, name, root, run, BUCKETS, database)
        return catalog.read_bucketed_run(spark, name, run, database)

    return read


SILVER_BY_TICKER, GOLD_BY_TICKER = _by_ticker(schemas.SILVER), _by_ticker(schemas.GOLD)


def catalog_census(spark: SparkSession, folder: str) -> DataFrame:
    """The run census as SQL text over the registered table."""
    gold = schemas.qualified(schemas.GOLD, _registered(spark, folder))
    return spark.sql(
        f"""SELECT data_referencia, COUNT(*) AS ativos, COUNT(score_final) AS com_score,
                   COUNT(*) FILTER (WHERE fonte = 'brapi') AS dados_reais,
                   COUNT(*) FILTER (WHERE fonte = 'sintetico') AS dados_sinteticos
            FROM {gold} GROUP BY data_referencia"""
    )


def screener_view(spark: SparkSession, folder: str) -> DataFrame:
    """The screener view as SQL over the registered tables."""
    catalog.create_screener_view(spark, _registered(spark, folder), temporary=True)
    return _settled_screener(spark.table(schemas.SCREENER_VIEW))


def _settled_screener(df: DataFrame) -> DataFrame:
    return df.withColumn("Liq.2meses", F.round("`Liq.2meses`", 2))


def screener_listing(spark: SparkSession, folder: str) -> DataFrame:
    rows = catalog.screener(SILVER_BY_TICKER(spark, folder), GOLD_BY_TICKER(spark, folder))
    return reports.screener_listing(_settled_screener(rows))


# --- reports ------------------------------------------------------------------------------

def dashboard_extract(spark: SparkSession, folder: str) -> DataFrame:
    rows = reports.dashboard_extract(GOLD_BY_TICKER(spark, folder), SILVER_BY_TICKER(spark, folder))
    return rows.withColumn("liquidez_2meses", F.round("liquidez_2meses", 2))


def series_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Only sessions that the real source has delivered count as real."""
    real = _stored(schemas.SERIES)(spark, folder).where(F.col("fonte") == "brapi")
    real = real.withColumn("ticker", F.upper(guards.strip(F.col("ticker"))))
    return reports.series_coverage(real, derive.ticks(spark, folder))


def score_changes(spark: SparkSession, folder: str) -> DataFrame:
    """All runs of gold merged one by one; the first comes last, so those after it are brought up to date."""
    gold, root = GOLD(spark, folder), scratch_path(spark, "evolution")
    dates = tables.partition_values(spark, schemas.GOLD, lake.warehouse(spark, folder))
    for date in [*dates[1:], *dates[:1]]:
        evolution.merge_run(gold.where(F.col("data_referencia") == date), root, date)
    return evolution.score_evolution(spark, root)


QUERIES: dict[str, Query] = {
    "price_sample": price_sample,
    "events_per_day": _prices(price_reports.events_per_day),
    "last_close": _prices(price_reports.last_close),
    "intraday_moves": _prices(price_reports.intraday_moves),
    "period_stats": _prices(price_reports.period_stats),
    "peak_volume_day": _prices(price_reports.peak_volume_day),
    "numeric_guards": numeric_guards,
    "coerced_rows": coerced_rows,
    "asset_categories": asset_categories,
    "display_labels": display_labels,
    "raw_envelopes": raw_envelopes,
    "bronze_partition": bronze_partition,
    "bronze_latest": bronze_latest,
    "silver_indicators": silver_indicators,
    "silver_prices": silver_prices,
    "run_day": run_day,
    "peer_groups": peer_groups,
    "peer_midranks": _midranks(),
    "peer_midranks_split": _midranks(**SPLIT),
    "magic_positions": _magic_positions(),
    "magic_positions_split": _magic_positions(**SPLIT),
    "gold_scores": _gold(),
    "gold_scores_split": _gold(**SPLIT),
    "ingest_guard": ingest_guard,
    "landing_replay": landing_replay,
    "tick_stream": tick_stream,
    "envelope_stream": envelope_stream,
    "envelope_state": envelope_state,
    "rejected_lines": rejected_lines,
    "latest_with_dateless": latest_with_dateless,
    "partition_rewrite": partition_rewrite,
    "series_upsert": series_upsert,
    "catalog_census": catalog_census,
    "screener_view": screener_view,
    "run_census": _on(reports.run_census, GOLD),
    "ranking": _on(reports.ranking, GOLD_RUN),
    "best_per_sector": _on(reports.best_per_sector, GOLD_RUN),
    "screener_listing": screener_listing,
    "grade_distribution": _on(reports.grade_distribution, GOLD_RUN),
    "indicator_coverage": _on(reports.indicator_coverage, SILVER_RUN),
    "provenance": _on(reports.provenance, SILVER_RUN),
    "below_graham": _on(reports.below_graham, GOLD_RUN),
    "below_bazin": _on(reports.below_bazin, GOLD_RUN),
    "magic_formula_best": _on(reports.magic_formula_best, GOLD_BY_TICKER, SILVER_BY_TICKER),
    "flag_screen": _on(reports.flag_screen, GOLD_RUN),
    "score_evolution": _on(reports.score_evolution, GOLD),
    "score_changes": score_changes,
    "idempotency_check": _on(reports.idempotency_check, SILVER),
    "silver_summary": _on(reports.silver_summary, SILVER, parsed_series),
    "series_coverage": series_coverage,
    "dashboard_extract": dashboard_extract,
    "dashboard_kpis": _on(reports.dashboard_kpis, dashboard_extract),
    "signal_counts": _on(reports.signal_counts, dashboard_extract),
    "dashboard_heatmap": _on(reports.dashboard_heatmap, dashboard_extract),
}
