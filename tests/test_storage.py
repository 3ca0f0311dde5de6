"""Schemas, tables, landing, catalog and streams on temporary folders."""

import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickermill import schemas
from tickermill.plans import evolution, medallion, reports
from tickermill.sources import catalog, deltas, landing, tables
from tickermill.streaming import feeds

ENVELOPE_DDL = schemas.ddl(schemas.BRONZE)


def envelopes(spark, rows):
    return spark.createDataFrame(
        [(t, p, 200, "m", "brapi", at, day) for t, p, at, day in rows], ENVELOPE_DDL
    )


def prices(spark, rows):
    return spark.createDataFrame(
        [(t, float(v), float(v), float(v), float(v), None, 1, "2026-10-01", "brapi", d) for t, v, d in rows],
        schemas.ddl(schemas.SERIES),
    )


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- schemas ------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(schemas.TABLES))
def test_registry_invariants(name):
    columns = schemas.columns(name)
    assert len(columns) == len(set(columns))
    assert columns[-1:] == schemas.partition_columns(name)
    assert columns[:-1] == schemas.data_columns(name)
    assert [part.split()[0] for part in schemas.ddl(name).split(", ")] == columns
    assert schemas.location(name, "/lake/warehouse").endswith(f"/warehouse/{name}/")
    assert f"LOCATION '{schemas.location(name, "/lake/warehouse")}'" in schemas.create_table_sql(name, "/lake/warehouse")


def test_registry_sizes_and_errors():
    sizes = {name: len(schemas.columns(name)) for name in schemas.TABLES}
    assert list(sizes.values()) == [8, 7, 59, 10, 37]
    with pytest.raises(KeyError, match="not registered"):
        schemas.ddl("missing")
    with pytest.raises(ValueError, match="logical type"):
        schemas.declare("t", [("a", "date")], None)


def test_price_table_ddl():
    assert schemas.ddl(schemas.PRICES) == (
        "ticker STRING, abertura DOUBLE, maxima DOUBLE, minima DOUBLE, fechamento DOUBLE, "
        "volume BIGINT, evento_ts STRING, data_pregao STRING"
    )
    assert "PARTITIONED BY (data_pregao)" in schemas.create_table_sql(schemas.PRICES, "/lake")


# --- tables -------------------------------------------------------------------------------

def test_partition_overwrite_is_idempotent(spark, tmp_path):
    root = str(tmp_path)
    first = envelopes(spark, [("A3", "{}", "t1", "2026-10-01"), ("A3", "{}", "t1", "2026-10-08")])
    assert tables.write_table(first, schemas.BRONZE, root) == 2
    second = envelopes(spark, [("B3", "{}", "t2", "2026-10-08")])
    for _ in range(2):
        assert tables.write_table(second, schemas.BRONZE, root) == 1
    stored = tables.read_table(spark, schemas.BRONZE, root)
    assert stored.schema["data_coleta"].dataType.simpleString() == "string"
    assert rows_of(stored, "ticker", "data_coleta") == [("A3", "2026-10-01"), ("B3", "2026-10-08")]
    assert tables.partition_values(spark, schemas.BRONZE, root) == ["2026-10-01", "2026-10-08"]
    assert rows_of(tables.latest_partition(spark, schemas.BRONZE, root), "ticker") == [("B3",)]
    one = tables.read_partition(spark, schemas.BRONZE, "data_coleta", "2026-10-01", root)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_coleta" in plan and rows_of(one, "ticker") == [("A3",)]


def test_latest_partition_ignores_rows_without_a_date(spark, tmp_path):
    root = str(tmp_path)
    rows = [("A3", "{}", "t", "2026-10-01"), ("B3", "{}", "t", None), ("C3", "{}", "t", "2026-10-02T08:00")]
    tables.write_table(envelopes(spark, rows), schemas.BRONZE, root)
    assert tables.partition_values(spark, schemas.BRONZE, root) == ["2026-10-01", "2026-10-02T08:00"]
    assert rows_of(tables.latest_partition(spark, schemas.BRONZE, root), "ticker") == [("C3",)]


def test_merging_reads_touched_partitions_only(spark, tmp_path):
    root = str(tmp_path)
    days = [("A3", "{}", "t", f"2026-10-0{k}") for k in range(1, 6)]
    tables.write_table(envelopes(spark, days), schemas.BRONZE, root)
    kept = tables.touched_rows(envelopes(spark, [("B3", "{}", "t", "2026-10-03")]), schemas.BRONZE, root)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "data_coleta" in plan.split("PartitionFilters: [")[1] and "2026-10-03" in plan
    assert rows_of(kept, "data_coleta") == [("2026-10-03",)]


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from tickermill.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="share"):
        shared_dir(cluster)


def test_session_factory_sets_what_results_rest_on(spark):
    from tickermill.session import RESULT_SETTINGS, create_session

    before = {key: spark.conf.get(key) for key in (*RESULT_SETTINGS, "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        made = create_session("factory", **{"spark.sql.shuffle.partitions": "7"})
        assert made.sparkContext.applicationId == spark.sparkContext.applicationId
        for key, value in {**RESULT_SETTINGS, "spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "7"}.items():
            assert made.conf.get(key) == value
        assert made.sql("SELECT CAST(TIMESTAMP_SECONDS(0) AS STRING)").first()[0] == "1970-01-01 00:00:00"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_stored_tables_are_cleared_with_the_application_only(spark, tmp_path, monkeypatch):
    from tickermill import session

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    (tmp_path / "other").mkdir()
    assert session.stored(spark.range(3), "numbers").count() == 3
    assert list(tmp_path.glob("tickermill/*/numbers-*"))
    assert session.clear_scratch(spark)
    assert not list(tmp_path.glob("tickermill/*/*")) and (tmp_path / "other").exists()


def shuffle_mb(spark):
    """Size of the shuffle files that this session keeps, once what is being deleted is gone."""
    import time

    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    time.sleep(1)
    files = [Path(f) for f in blocks.getAllFiles().mkString("\n").splitlines() if "/shuffle_" in f and f.endswith(".data")]
    return sum(f.stat().st_size for f in files if f.exists()) / 1e6


def test_a_write_keeps_neither_its_shuffle_files_nor_tables_between_steps(spark, tmp_path, monkeypatch):
    from tickermill import session

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    before, codec = shuffle_mb(spark), spark.conf.get("spark.sql.parquet.compression.codec")
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with session.temporary_tables(spark):
        table = session.stored(counts, "counts")
        (folder,) = tmp_path.glob("tickermill/*/counts-*")
        assert table.count() == 7 and list(folder.glob("*.zstd.parquet"))
    assert not folder.exists() and spark.conf.get("spark.sql.parquet.compression.codec") == codec
    many = spark.range(200_000).select(F.sha1(F.col("id").cast("string")).alias("ticker"), F.lit("d1").alias("data_coleta"))
    assert tables.write_table(many, schemas.BRONZE, str(tmp_path)) == 200_000
    assert shuffle_mb(spark) < before + 1  # 8 MB of digests went through the shuffle
    with pytest.raises(ValueError), session.temporary_tables(spark):
        kept = session.stored(counts, "kept")
        raise ValueError  # what a failed step has stored stays
    assert kept.count() == 7


def test_a_table_stored_alone_outlives_what_it_was_made_from(spark, tmp_path, monkeypatch):
    from tickermill import session

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    left = lambda: sorted(f.name.split("-")[0] for f in tmp_path.glob("tickermill/*/*"))
    with session.temporary_tables(spark):
        table = session.stored_alone(spark, lambda: session.stored(spark.range(3), "source").where("id > 0"), "answers")
        assert left() == ["answers"] and table.count() == 2
    assert left() == []


def test_writing_nothing_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    tables.write_table(envelopes(spark, [("A3", "{}", "t", "2026-10-01")]), schemas.BRONZE, root)
    assert tables.write_table(envelopes(spark, []), schemas.BRONZE, root) == 0
    assert tables.read_table(spark, schemas.BRONZE, root).count() == 1


def test_upsert_keeps_other_tickers_of_the_same_day(spark, tmp_path):
    root = str(tmp_path)
    days = ("2026-10-01", "2026-10-02", "2026-10-03")
    tables.upsert_table(prices(spark, [("A3", 1, days[0]), ("A3", 1, days[1])]), schemas.SERIES, root)
    new = prices(spark, [("B3", 2, days[1]), ("A3", 3, days[1]), ("B3", 2, days[2])])
    for _ in range(2):
        tables.upsert_table(new, schemas.SERIES, root)
        stored = tables.read_table(spark, schemas.SERIES, root)
        assert rows_of(stored, "ticker", "data_pregao", "fechamento") == [
            ("A3", days[0], 1.0), ("A3", days[1], 3.0), ("B3", days[1], 2.0), ("B3", days[2], 2.0),
        ]


def test_bronze_keeps_the_newest_collection(spark):
    rows = [("A3", "old", "2026-10-01T08", "d"), ("A3", "new", "2026-10-01T18", "d"),
            ("A3", "none", None, "d"), ("B3", "x", None, "d")]
    out = medallion.bronze_rows(envelopes(spark, rows))
    assert rows_of(out, "ticker", "payload_json") == [("A3", "new"), ("B3", "x")]


def test_top_per_key_limits_before_the_shuffle(spark):
    df = medallion.bronze_rows(envelopes(spark, [("A3", "x", "t", "d")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[partial:] and "Partial" in plan[partial:]


def test_stored_envelopes_are_chosen_without_their_payloads(spark, tmp_path, monkeypatch):
    import random

    from tickermill.operators import dedup

    rng = random.Random(5)
    some = lambda *values: rng.choice(values)
    rows = [
        (some("A3", "B3", "C3", None), some("p1", "p2", None, ""), some(200, 401, None), some("m", None),
         some("brapi", "x", None), some("t1", "t2", "", None), some("d1", "d2", None))
        for _ in range(300)
    ] + [("D3", "same", 200, "m", "brapi", "t", "d1")] * 50
    df = spark.createDataFrame(rows, ENVELOPE_DDL)
    path = str(tmp_path / "files")
    df.repartition(5).write.parquet(path)
    plans = []

    def watched(frame, purpose):
        plans.append((purpose, frame._jdf.queryExecution().executedPlan().toString()))
        return session_stored(frame, purpose)

    session_stored = dedup.stored
    monkeypatch.setattr(dedup, "stored", watched)
    files = spark.read.schema(schemas.struct(schemas.BRONZE)).parquet(path)
    found = medallion.stored_bronze_rows(files).collect()
    # One row per key, equal to a plain choice over whole rows; ties end in rows that are equal.
    order = lambda v: (v is not None, v if v is not None else "")
    digest = lambda t: None if t is None else hashlib.sha256(t.encode()).hexdigest()
    best = {}
    for r in rows:
        value = (r[5] or "", (r[2] is not None, r[2] or 0), *map(order, (digest(r[1]), r[4], r[3], r[5])))
        if (r[0], r[6]) not in best or value > best[r[0], r[6]][0]:
            best[r[0], r[6]] = (value, r)
    assert sorted(map(repr, map(tuple, found))) == sorted(repr(r) for _, r in best.values())
    assert sorted(map(repr, map(tuple, medallion.bronze_rows(df).select(*schemas.columns(schemas.BRONZE)).collect()))) == sorted(
        repr(r) for _, r in best.values()
    )
    # What decides without payloads reads none; where rows tie, digests are made before anything is shuffled.
    assert [purpose for purpose, _ in plans] == ["double", "tied", "equal", "superseded"]
    assert not any("payload_json" in plan for purpose, plan in plans if purpose in ("double", "tied"))
    for _, plan in plans:
        assert not any("payload_json" in line for line in plan.splitlines() if "Exchange" in line)


def test_many_rows_that_lose_send_no_payload_through_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "files")
    rows = spark.range(70_000).select(
        F.concat(F.lit("T"), F.col("id") % 50_000).alias("ticker"), F.concat(F.lit("p"), "id").alias("payload_json"),
        F.lit(200).alias("http_status"), F.lit("m").alias("modulos_solicitados"), F.lit("brapi").alias("fonte"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("coletado_em"), F.lit("d").alias("data_coleta"),
    )
    rows.coalesce(1).write.parquet(path)
    files = spark.read.schema(schemas.struct(schemas.BRONZE)).parquet(path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        chosen = medallion.stored_bronze_rows(files)
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        found = chosen.select((F.substring("payload_json", 2, 9).cast("int")).alias("id"))
        # Of 20,000 tickers that come twice the earlier row loses, beyond one bitmap of the file.
        assert found.agg(F.count("*"), F.min("id"), F.sum("id")).first() == (50_000, 20_000, sum(range(20_000, 70_000)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_envelopes_without_rivals_are_not_compared(spark, tmp_path):
    path = str(tmp_path / "files")
    envelopes(spark, [("A3", "x", "t1", "d"), ("B3", "y", "t1", "d"), ("B3", "z", "t2", "d")]).write.parquet(path)
    files = spark.read.schema(schemas.struct(schemas.BRONZE)).parquet(path)
    assert rows_of(medallion.stored_bronze_rows(files), "ticker", "payload_json") == [("A3", "x"), ("B3", "z")]
    assert medallion.stored_bronze_rows(files.where("ticker = 'none'")).count() == 0


# --- landing ------------------------------------------------------------------------------

def test_landing_round_trip_and_source_switch(spark, tmp_path):
    zone, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    rows = [("A3", '{"symbol": "A3"}', "t1", "2026-10-01"), ("A3", "{}", "t0", "2026-10-01"),
            ("B3", None, "t1", "2026-10-02")]
    landing.write_landing(envelopes(spark, rows), zone)
    landing.write_landing(envelopes(spark, rows[2:]), zone)
    assert landing.read_landing(spark, zone).count() == 3
    assert rows_of(landing.read_landing(spark, zone, "2026-10-02"), "ticker", "payload_json") == [("B3", None)]
    feeds.load_bronze(spark, " Replay ", zone, root)
    stored = tables.read_table(spark, schemas.BRONZE, root)
    assert rows_of(stored.where("payload_json IS NOT NULL"), "ticker", "payload_json") == [
        ("A3", '{"symbol": "A3"}')
    ]
    with pytest.raises(ValueError, match="unknown input"):
        feeds.load_bronze(spark, "queue", zone, root)


def test_envelope_and_guard(spark):
    df = spark.createDataFrame([("A3", ("x",)), ("B3", None)], "t string, p struct<symbol:string>")
    lit = F.lit
    out = df.select(*landing.envelope(F.col("t"), F.col("p"), lit("brapi"), lit(200), lit("d"), lit("now")))
    assert rows_of(out, "ticker", "payload_json") == [("A3", '{"symbol":"x"}'), ("B3", None)]
    assert out.columns == schemas.columns(schemas.BRONZE)
    assert rows_of(landing.only_new(out, out.where("ticker = 'A3'")), "ticker") == [("B3",)]


# --- streams ------------------------------------------------------------------------------

def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def tick(ticker, volume, day="2026-10-01"):
    return {"ticker": ticker, "abertura": 1.5, "fechamento": "2.5", "volume": volume,
            "evento_ts": f"{day}T12:00:00", "data_pregao": day, "other": 1}


def test_tick_stream_appends_once(spark, tmp_path):
    inbox, path, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")
    write_lines(inbox, "1.json", [tick("A3", 5), "{broken", tick("B3", 31859600.0)])

    def run():
        feeds.append_ticks(spark, str(inbox), path, offsets).awaitTermination()
        return tables.read_table(spark, schemas.PRICES, "", path)

    assert rows_of(run(), "ticker", "volume", "fechamento") == [("A3", 5, 2.5), ("B3", 31859600, 2.5)]
    assert run().count() == 2
    write_lines(inbox, "2.json", [tick("C3", 1)])
    assert run().count() == 3


def test_envelope_stream_merges_batches(spark, tmp_path):
    inbox, root, offsets = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "offsets")

    def message(ticker, text, at):
        return {"ticker": ticker, "payload_json": text, "http_status": 200, "fonte": "brapi",
                "coletado_em": at, "data_coleta": "2026-10-01"}

    write_lines(inbox, "1.json", [message("A3", "new", "t2"), message("B3", "b", "t1")])
    feeds.ingest_envelopes(spark, str(inbox), root, offsets, 1).awaitTermination()
    write_lines(inbox, "2.json", [message("A3", "old", "t1"), "oops"])
    write_lines(inbox, "3.json", [message("B3", "b2", "t2"), message("C3", "c", None)])
    for step in range(2):
        feeds.ingest_envelopes(spark, str(inbox), root, offsets, 1).awaitTermination()
        if step:
            assert len(deltas.pending(spark, schemas.BRONZE, root)) == 3
            assert feeds.compact_envelopes(spark, root) == 3 and feeds.compact_envelopes(spark, root) == 0
            assert deltas.pending(spark, schemas.BRONZE, root) == []
        stored = feeds.current_envelopes(spark, root)
        assert rows_of(stored, "ticker", "payload_json", "http_status") == [
            ("A3", "new", 200), ("B3", "b2", 200), ("C3", "c", 200),
        ]


def folder_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_a_batch_writes_only_what_it_brings(spark, tmp_path):
    root = str(tmp_path)
    day = envelopes(spark, [(f"T{k}", "p" * 500 + str(k * k), "t1", "2026-10-01") for k in range(3000)])
    tables.write_table(day, schemas.BRONZE, root)
    one = envelopes(spark, [("T5", "newer", "t2", "2026-10-01"), ("T6", "older", "t0", "2026-10-01")])
    for _ in range(2):  # a repeated batch replaces itself
        deltas.append_delta(one, schemas.BRONZE, root, "a-1")
    written = folder_bytes(tmp_path / "bronze_fundamentos_delta")
    assert 0 < written < folder_bytes(tmp_path / "bronze_fundamentos") / 5
    for read in (feeds.current_envelopes, lambda s, r: (feeds.compact_envelopes(s, r), tables.read_table(s, schemas.BRONZE, r))[1]):
        now = read(spark, root)
        assert now.count() == 3000
        assert rows_of(now.where("ticker in ('T5', 'T6')"), "ticker", "coletado_em") == [("T5", "t2"), ("T6", "t1")]


def test_newest_envelopes_in_the_state_store(spark, tmp_path):
    inbox, root, offsets = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "offsets")

    def message(ticker, text, at, day="2026-10-01"):
        return {"ticker": ticker, "payload_json": text, "http_status": 200, "coletado_em": at, "data_coleta": day}

    def take(name, *lines):
        write_lines(inbox, name, list(lines))
        feeds.ingest_newest_envelopes(spark, str(inbox), root, offsets, "2 days").awaitTermination()
        return rows_of(feeds.current_envelopes(spark, root), "ticker", "payload_json", "data_coleta")

    first = take("1.json", message("A3", "new", "t2"), message("A3", "old", "t1"), message("B3", None, None), "{broken")
    assert first == [("A3", "new", "2026-10-01"), ("B3", None, "2026-10-01")]
    size = folder_bytes(tmp_path / "lake")
    # Restarted: repeated and older collections change nothing; a newer one wins.
    assert take("2.json", message("A3", "new", "t2"), message("A3", "older", "t0"), message("B3", "b", "t1")) == [
        ("A3", "new", "2026-10-01"), ("B3", "b", "2026-10-01"),
    ]
    assert folder_bytes(tmp_path / "lake") > size
    take("3.json", message("C3", "c", "t", "2026-10-09"))
    # The first day's state is gone: what comes for it now is too late.
    last = take("4.json", message("A3", "too late", "t9"), message("C3", "c2", "t2", "2026-10-09"))
    assert last == [("A3", "new", "2026-10-01"), ("B3", "b", "2026-10-01"), ("C3", "c2", "2026-10-09")]


def test_an_inbox_is_written_densely_by_the_tasks_that_hold_the_rows(spark, tmp_path):
    from tickermill.plans import registry

    rows = envelopes(spark, [(f"T{k}", "p" * 200, "t1", "2026-10-01") for k in range(100)]).coalesce(1)
    inbox = str(tmp_path / "in")
    registry._write_inbox(rows, inbox, files=3)
    files = list((tmp_path / "in").glob("*.json.gz"))
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 100 * 200 / 5
    stored = spark.read.schema(ENVELOPE_DDL).json(inbox)
    assert rows_of(stored, *rows.columns) == rows_of(rows, *rows.columns)


def test_state_is_held_densely_and_older_checkpoints_go_on(spark, tmp_path, monkeypatch):
    inbox, root = tmp_path / "in", str(tmp_path / "lake")
    lines = [{"ticker": f"T{k}", "payload_json": "p" * 100, "coletado_em": "t1", "data_coleta": "2026-10-01"} for k in range(50)]
    write_lines(inbox, "1.json", lines)

    def take(offsets, codec):
        monkeypatch.setattr(feeds, "STATE_CODEC", codec)
        feeds.ingest_newest_envelopes(spark, str(inbox), root, str(tmp_path / offsets)).awaitTermination()
        return {f.read_bytes()[:4] == bytes.fromhex("28b52ffd") for f in (tmp_path / offsets / "state").rglob("*.delta")}

    assert take("old", "lz4") == {False} and take("new", feeds.STATE_CODEC) == {False}
    monkeypatch.undo()
    assert take("dense", feeds.STATE_CODEC) == {True}
    write_lines(inbox, "2.json", [lines[0] | {"payload_json": "later", "coletado_em": "t2"}])
    assert take("old", feeds.STATE_CODEC) == {False}
    now = feeds.current_envelopes(spark, root)
    assert now.count() == 50 and rows_of(now.where("ticker = 'T0'"), "payload_json") == [("later",)]


def test_number_text_in_integer_columns(spark, tmp_path):
    volumes = [5, 31859600.0, "7", " 8 ", "1.5", "abc", 1.9, -1.9, True, None, [1], 9007199254740993]
    write_lines(tmp_path / "in", "1.json", [tick(f"T{k:02d}", v) for k, v in enumerate(volumes)])
    path = str(tmp_path / "out")
    feeds.append_ticks(spark, str(tmp_path / "in"), path, str(tmp_path / "c")).awaitTermination()
    got = [v for _, v in rows_of(tables.read_table(spark, schemas.PRICES, "", path), "ticker", "volume")]
    assert got == [5, 31859600, 7, 8, None, None, 1, -1, 1, None, None, 9007199254740993]


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    write_lines(tmp_path / "in", "1.json", [tick("A3", 5), "{broken"])
    stream = feeds._json_stream(spark, str(tmp_path / "in"), schemas.PRICES, 10)
    query = feeds.malformed(stream).writeStream.format("memory").queryName("bad").trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    assert [r.linha for r in spark.table("bad").collect()] == ["{broken"]


def test_malformed_landing_lines_never_reach_bronze(spark, tmp_path):
    day = tmp_path / "landing" / "data_coleta=2026-10-01"
    day.mkdir(parents=True)
    write_lines(day, "1.json", [{"ticker": "A3", "payload_json": "{}", "fonte": "brapi"}, "{broken"])
    zone = str(tmp_path / "landing")
    assert rows_of(landing.read_landing(spark, zone), "ticker", "data_coleta") == [("A3", "2026-10-01")]
    assert rows_of(landing.rejected_lines(spark, zone), "linha", "data_coleta") == [("{broken", "2026-10-01")]


def test_rejects_of_the_envelope_stream_are_stored(spark, tmp_path):
    inbox = tmp_path / "in"
    good = {"ticker": "A3", "payload_json": "p", "coletado_em": "t1", "data_coleta": "2026-10-01"}
    write_lines(inbox, "1.json", [good, "{broken"])
    rejects = str(tmp_path / "rejects")
    feeds.ingest_envelopes(
        spark, str(inbox), str(tmp_path / "lake"), str(tmp_path / "c"), rejects=rejects
    ).awaitTermination()
    assert [r.linha for r in spark.read.json(rejects).collect()] == ["{broken"]


# --- catalog ------------------------------------------------------------------------------

def test_catalog_and_view(spark, tmp_path, universe):
    from conftest import asset

    root = str(tmp_path / "lake")
    spark.sql(f"CREATE DATABASE market LOCATION '{tmp_path / 'db'}'")
    silver = universe([asset("A3", data_coleta="2026-10-01"), asset("A3", data_coleta="2026-10-08"),
                       asset("B3", data_coleta="2026-10-08")])
    tables.write_table(silver, schemas.SILVER, root)
    tables.write_table(medallion.gold_rows(silver).where("ticker = 'A3'"), schemas.GOLD, root)
    for name in (schemas.SILVER, schemas.GOLD):
        catalog.register_table(spark, name, root, "market")
    catalog.create_screener_view(spark, "market")
    view = spark.table(f"market.{schemas.SCREENER_VIEW}")
    assert len(view.columns) == 30 and view.columns[2] == "P/L" and view.columns[-1] == "Fonte"
    assert rows_of(view, "Papel", "`P/L`", "Nota") == sorted(
        [("A3", 9.0, view.where("Papel = 'A3'").first()["Nota"]), ("B3", 9.0, None)]
    )
    # A partition written later appears after the next registration.
    tables.write_table(silver.withColumn("data_coleta", F.lit("2026-10-15")), schemas.SILVER, root)
    catalog.register_table(spark, schemas.SILVER, root, "market")
    assert spark.sql(f"SHOW PARTITIONS market.{schemas.SILVER}").count() == 3
    latest = reports.latest(tables.read_table(spark, schemas.SILVER, root), "data_coleta")
    assert rows_of(latest.select("data_coleta").distinct(), "data_coleta") == [("2026-10-15",)]
    check = reports.idempotency_check(tables.read_table(spark, schemas.SILVER, root)).collect()
    assert [(r.linhas, r.tickers) for r in check] == [(3, 2), (2, 2), (1, 1)]


def test_partitions_are_replaced_at_once(spark, tmp_path, monkeypatch):
    root, name = str(tmp_path / "lake"), schemas.BRONZE
    spark.sql(f"CREATE DATABASE swapped LOCATION '{tmp_path / 'db'}'")
    days = ["2026-10-01", "2026-10-02", "2026-10-03 it's"]
    tables.write_table(envelopes(spark, [("A3", "old", "t", day) for day in days]), name, root)
    catalog.register_table(spark, name, root, "swapped")
    table = lambda: rows_of(spark.table(schemas.qualified(name, "swapped")), "payload_json", "data_coleta")
    old = [("old", day) for day in days]
    assert table() == old
    new = envelopes(spark, [("A3", "new", "t", day) for day in days[1:]])

    # The job fails when one partition is written and the other is not: the old rows are read.
    broken = new.withColumn("payload_json", F.expr("IF(data_coleta LIKE '%03%', raise_error('disk gone'), payload_json)"))
    with pytest.raises(Exception, match="disk gone"):
        catalog.replace_partitions(broken.coalesce(1), name, root, "swapped")
    assert table() == old

    # It stops when all files are written, but the catalog has been told of none, or of one, of the partitions.
    point, told = catalog._point, []

    def stops(limit):
        def run(*arguments):
            if len(told) == limit:
                raise RuntimeError("driver gone")
            told.append(1)
            point(*arguments)

        return run

    for limit, seen in ((0, old), (1, [("new", days[1]), ("old", days[0]), ("old", days[2])])):
        monkeypatch.setattr(catalog, "_point", stops(limit))
        with pytest.raises(RuntimeError, match="driver gone"):
            catalog.replace_partitions(new, name, root, "swapped")
        spark.catalog.refreshTable(schemas.qualified(name, "swapped"))
        assert table() == seen

    monkeypatch.setattr(catalog, "_point", point)
    assert catalog.replace_partitions(new, name, root, "swapped") == 2
    assert catalog.replace_partitions(new.limit(0), name, root, "swapped") == 0
    done = [("new", days[1]), ("new", days[2]), ("old", days[0])]
    assert table() == done
    # A new day, and cleaning up, which keeps what the catalog points to.
    catalog.replace_partitions(envelopes(spark, [("A3", "more", "t", "2026-10-09")]), name, root, "swapped")
    assert catalog.drop_versions(spark, name, root, "swapped") > 2
    assert catalog.drop_versions(spark, name, root, "swapped") == 0
    assert table() == sorted([*done, ("more", "2026-10-09")])


def test_only_touched_partitions_are_registered(spark, tmp_path):
    root, name = str(tmp_path / "lake"), schemas.BRONZE
    spark.sql(f"CREATE DATABASE touched LOCATION '{tmp_path / 'db'}'")
    tables.write_table(envelopes(spark, [("A3", "x", "t", f"2026-10-0{k}") for k in range(1, 4)]), name, root)
    catalog.register_table(spark, name, root, "touched", touched=["2026-10-02"])
    assert catalog.registered_values(spark, name, "touched") == ["2026-10-02"]
    assert spark.table(schemas.qualified(name, "touched")).count() == 1
    catalog.register_table(spark, name, root, "touched", touched=[])
    catalog.register_table(spark, name, root, "touched")
    assert len(catalog.registered_values(spark, name, "touched")) == 3


def test_the_view_reads_one_partition(spark, tmp_path, universe):
    from conftest import asset

    root = str(tmp_path / "lake")
    spark.sql(f"CREATE DATABASE viewed LOCATION '{tmp_path / 'db'}'")
    silver = universe([asset("A3", data_coleta=f"2026-10-0{k}") for k in range(1, 6)])
    tables.write_table(silver, schemas.SILVER, root)
    tables.write_table(medallion.gold_rows(silver), schemas.GOLD, root)
    for name in (schemas.SILVER, schemas.GOLD):
        catalog.register_table(spark, name, root, "viewed")
    catalog.create_screener_view(spark, "viewed")
    view = spark.table(f"viewed.{schemas.SCREENER_VIEW}")
    assert view.count() == 1
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(data_coleta") == 1 and "2026-10-05" in plan and "max(" not in plan


def test_runs_stored_by_ticker_are_joined_without_a_shuffle(spark, tmp_path, universe):
    from conftest import asset

    root = str(tmp_path / "lake")
    spark.sql(f"CREATE DATABASE by_ticker LOCATION '{tmp_path / 'db'}'")
    days = ("2026-10-01", "2026-10-08")
    silver = universe([asset(f"T{k}", data_coleta=day, roe=0.01 * k) for day in days for k in range(1, 30)])
    tables.write_table(silver, schemas.SILVER, root)
    silver = tables.read_table(spark, schemas.SILVER, root)
    tables.write_table(medallion.gold_rows(silver), schemas.GOLD, root)
    gold = tables.read_table(spark, schemas.GOLD, root)
    for day in (*days, days[1]):  # a run stored again replaces itself
        catalog.store_bucketed_run(silver, schemas.SILVER, root, day, 4, "by_ticker")
        catalog.store_bucketed_run(gold, schemas.GOLD, root, day, 4, "by_ticker")
    assert spark.table(schemas.bucketed(schemas.SILVER, "by_ticker")).count() == 58
    run = {name: catalog.read_bucketed_run(spark, name, days[1], "by_ticker") for name in (schemas.SILVER, schemas.GOLD)}
    plain = {name: tables.latest_partition(spark, name, root) for name in run}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for runs too large to be broadcast
    try:
        for report in (
            lambda i, g: reports.dashboard_extract(g, i),
            lambda i, g: reports.magic_formula_best(g, i),
            lambda i, g: reports.screener_listing(catalog.screener(i, g)),
        ):
            joined = report(run[schemas.SILVER], run[schemas.GOLD])
            assert joined.collect() == report(plain[schemas.SILVER], plain[schemas.GOLD]).collect()
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
            assert "Exchange hashpartitioning" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with pytest.raises(ValueError, match="positive"):
        schemas.create_bucketed_sql(schemas.GOLD, root, 0)


# --- runs ---------------------------------------------------------------------------------

def quote_text(quote, **changes):
    from conftest import daily_points

    return json.dumps({**quote, "historicalDataPrice": daily_points(30), **changes})


def test_one_call_makes_a_run(spark, tmp_path, quote):
    from tickermill.plans import runs

    root = str(tmp_path / "lake")
    spark.sql(f"CREATE DATABASE daily LOCATION '{tmp_path / 'db'}'")
    text = quote_text(quote)
    rows = [("PETR4", text, "t1", "2026-10-01"), ("PETR4 ", "{}", "t0", "2026-10-01"), ("B3SA3", None, "t1", None),
            ("VALE3", text, "t1", "2026-10-02")]
    made = envelopes(spark, rows)
    first = runs.run_day(spark, made, root, "2026-10-01", "daily", buckets=2)
    assert (first.envelopes, first.rows, first.eligible, first.sessions) == (3, 2, 1, 30)
    assert first.scored == sum(n for grade, n in first.grades.items() if grade != "SD") == 1
    assert list(first.grades) == ["A", "B", "C", "D", "E", "SD"] and first.grades["SD"] == 1
    table = lambda name: spark.table(schemas.qualified(name, "daily"))
    assert rows_of(table(schemas.GOLD), "ticker") == [("B3SA3",), ("PETR4",)]
    assert table(schemas.SERIES).count() == 30
    assert catalog.read_bucketed_run(spark, schemas.GOLD, "2026-10-01", "daily").count() == 2
    # The same again, and the next day: earlier runs stay, the view shows the newest.
    assert runs.run_day(spark, made, root, "2026-10-01", "daily") == first
    runs.run_day(spark, made, root, "2026-10-02", "daily")
    assert rows_of(table(schemas.SILVER), "ticker", "data_coleta") == [
        ("B3SA3", "2026-10-01"), ("B3SA3", "2026-10-02"), ("PETR4", "2026-10-01"), ("VALE3", "2026-10-02"),
    ]
    assert rows_of(spark.table(f"daily.{schemas.SCREENER_VIEW}"), "Papel") == [("B3SA3",), ("VALE3",)]
    assert runs.run_day(spark, made, root, "2026-11-01").rows == 1  # only the dateless envelope
    assert runs.run_day(spark, made.where("ticker = 'none'"), root, "2026-12-01") == runs.RunSummary("2026-12-01")


def test_both_outputs_come_from_one_parse(spark, quote):
    rows = [("PETR4", quote_text(quote), "t1", "2026-10-01"), (" petr4", "{}", "t2", "2026-10-01"), ("X3", "oops", "t", None)]
    bronze = envelopes(spark, rows)
    parsed, sessions = medallion.parsed(bronze, "2026-10-05")
    assert sessions == 30
    for made, plain in (
        (medallion.silver_of(parsed), medallion.silver_rows(bronze, "2026-10-05")),
        (medallion.series_of(parsed), medallion.series_rows(bronze, "2026-10-05")),
    ):
        assert sorted(map(str, made.collect())) == sorted(map(str, plain.collect()))
        assert "from_json" not in made._jdf.queryExecution().executedPlan().toString()


def test_made_up_prices_never_replace_real_ones(spark, tmp_path):
    root, day = str(tmp_path), "2026-10-01"

    def run(source, run_date, price):
        rows = prices(spark, [("A3", price, day)]).withColumns({"fonte": F.lit(source), "data_coleta": F.lit(run_date)})
        tables.upsert_table(rows, schemas.SERIES, root, newest=medallion.newest_run_first())
        return rows_of(tables.read_table(spark, schemas.SERIES, root), "fonte", "fechamento")

    assert run("sintetico", "2026-10-02", 1) == [("sintetico", 1.0)]
    assert run("brapi", "2026-10-01", 2) == [("brapi", 2.0)]  # real, though older
    assert run("sintetico", "2026-10-09", 3) == [("brapi", 2.0)]
    assert run("brapi", "2026-10-03", 4) == [("brapi", 4.0)]


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 1), (3, 0, 2, 1), (2, 3, 1, 0)])
def test_score_changes_equal_the_full_window_for_every_order_of_runs(spark, tmp_path, order):
    dates = [f"2026-10-0{k}" for k in range(1, 5)]
    scores = {
        "A3": (50.04, 61.0, 61.0, 40.0), "B3": (None, 20.0, None, 70.5), "C3": (10.0, None, None, None), "D3": (None, None, 5.0, 9.0),
    }
    rows = [(t, s, "B", d) for t, own in scores.items() for s, d in zip(own, dates)]
    gold = spark.createDataFrame(rows, "ticker string, score_final double, nota string, data_referencia string")
    root = str(tmp_path)
    assert evolution.score_evolution(spark, root).collect() == [] and evolution.runs(spark, root) == []
    for done, k in enumerate(order, 1):
        evolution.merge_run(gold.where(F.col("data_referencia") == dates[k]), root, dates[k])
        merged = [dates[j] for j in order[:done]]
        assert evolution.runs(spark, root) == sorted(set(merged))
    assert evolution.score_evolution(spark, root).collect() == reports.score_evolution(gold).collect()


def test_score_changes_forget_what_a_repeated_run_no_longer_has(spark, tmp_path):
    schema, root = "ticker string, score_final double, nota string", str(tmp_path)
    merge = lambda rows, date: evolution.merge_run(spark.createDataFrame(rows, schema), root, date)
    found = lambda: [(r.ticker, r.data_referencia, r.variacao) for r in evolution.score_evolution(spark, root).collect()]
    merge([("A3", 10.0, "C"), (None, 1.0, "C")], "2026-10-01")
    merge([("A3", 20.0, "C")], "2026-10-02")
    merge([("A3", 50.0, "C"), (None, 4.0, "C")], "2026-10-03")
    assert found() == [(None, "2026-10-03", 3.0), (None, "2026-10-01", None), ("A3", "2026-10-03", 30.0),
                       ("A3", "2026-10-02", 10.0), ("A3", "2026-10-01", None)]
    merge([], "2026-10-02")
    assert ("A3", "2026-10-03", 40.0) in found() and len(found()) == 4
    plan = evolution.score_evolution(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
