"""Pipelines, sources and sinks."""

import pytest
from pyspark.sql import functions as F

from agencylens.operators.latest import latest_per_key
from agencylens.operators.ledger import ledger_by_entity_period
from agencylens.operators.population import entity_population, restrict_to
from agencylens.operators.transitions import with_arrears_roll, with_required_payment, with_segment_transitions
from agencylens.plans import batch, check, dataset, funnels, history, incremental
from agencylens.sources import catalog, codes, naming, sinks
from agencylens.verification import queries, views


def inputs(spark, small):
    return batch.Inputs(
        views.calendar(spark, small), views.snapshot(spark, small), views.ledger(spark, small),
        views.agency_segments(spark, small), views.agency_master(spark, small), views.SNAPSHOT_ORDER, views.LEDGER_ORDER,
    )


def test_history_equals_operators_and_joins(spark, small):
    """The one-aggregation form gives what population join, last record and ledger join give."""
    snapshot, ledger = views.snapshot(spark, small), views.ledger(spark, small)
    start = 199701
    members = entity_population(snapshot, start, queries.LEGAL)
    last = latest_per_key(restrict_to(snapshot.where(F.col("period") >= start), members), ("entity_id", "period"), *views.SNAPSHOT_ORDER)
    moved = with_segment_transitions(with_arrears_roll(with_required_payment(last)), queries.LEGAL)
    recovered = ledger_by_entity_period(restrict_to(ledger.where(F.col("period") >= start), members), *views.LEDGER_ORDER)
    joined = history.with_outcome_flags(moved.join(recovered, ["entity_id", "period"]))
    ours = history.history_base(snapshot, ledger, start, queries.LEGAL, views.SNAPSHOT_ORDER, views.LEDGER_ORDER)
    expected = joined.select(*ours.columns)
    assert ours.count() == expected.count() > 0
    assert ours.exceptAll(expected).count() == 0


def test_as_of_period_hides_the_future(spark, small):
    args = (views.snapshot(spark, small), views.ledger(spark, small), 199701, queries.LEGAL, views.SNAPSHOT_ORDER, views.LEDGER_ORDER)
    capped = history.history_base(*args, as_of_period=199804)
    assert capped.agg(F.max("period")).first()[0] == 199804
    assert capped.where("period = 199804 AND with_next_arrears = 1").count() == 0


def _first_cut(plan):
    """Lines of the plan above and below the lowest aggregation of the sources' rows."""
    lines = plan.splitlines()
    lowest = max(i for i, line in enumerate(lines) if "partial_max(struct" in line or "partial_max(_record" in line)
    return "\n".join(lines[:lowest]), "\n".join(lines[lowest:])


def test_sources_are_restricted_before_they_are_aggregated(spark, small, plan_of):
    for name, sources in (("history_base", 2), ("period_funnel", 3), ("contact_funnel", 3)):
        above, below = _first_cut(plan_of(queries.registered()[name](spark, small)))
        assert below.count("LeftSemi") == sources and "LeftSemi" not in above, name


def test_history_with_prefilter_is_the_same(spark, small):
    args = (views.snapshot(spark, small), views.ledger(spark, small), 199901, queries.LEGAL, views.SNAPSHOT_ORDER, views.LEDGER_ORDER)
    plain, filtered = history.history_base(*args), history.history_base(*args, prefilter_bits=1 << 16)
    assert plain.schema == filtered.schema and plain.exceptAll(filtered).count() == 0 and filtered.exceptAll(plain).count() == 0


def test_contact_funnel_looks_back_over_the_turn_of_the_year(spark):
    snapshot = spark.createDataFrame(
        [("a", p, 3, 1, 40, 2, 1, p) for p in (202552, 202601)],
        "entity_id string, period int, segment int, arrears int, last_payment int, last_arrears_payment int, opened_at int, record_id int",
    ).withColumn("updated_at", F.lit(1))
    visits = spark.createDataFrame([], "entity_id string, period int, visit_code int, result_code int, agent_lat string, agent_lon string, client_lat string, client_lon string, start_ms long, end_ms long")
    payments = spark.createDataFrame([], "entity_id string, period int, capital int, interest int")
    clients = spark.createDataFrame([("a",)], "entity_id string")
    funnel = lambda **k: funnels.contact_funnel(snapshot, visits, payments, codes.code_map(spark), clients, 202601, 202601, **k).first()
    assert funnel(look_back=202552)["required_payment_total"] == 42 and funnel()["required_payment_total"] == 0
    assert funnels.contact_funnel(snapshot, visits, payments, codes.code_map(spark), clients, 202601, 202601, only_non_current=True).count() == 0


def test_building_the_data_set_starts_no_job(spark, small):
    spark.sparkContext.setJobGroup("build", "build")
    try:
        batch.get_dataset(inputs(spark, small), 200101, 199902, 199901, queries.LEGAL, queries.AS_OF_MS)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_cut_points_are_evaluated_in_the_plan(spark, small, plan_of):
    labelled = queries.registered()["outlier_null"](spark, small)
    assert "Subquery" in plan_of(labelled)


def test_batch_run_saves_both_tables(spark, small):
    spark.sql("DROP TABLE IF EXISTS run_history")
    batch.run_batch(inputs(spark, small), 200101, queries.LEGAL, queries.AS_OF_MS, "run", n_periods=8, scored_table="run_scored")
    start, look_back = batch.period_bounds(views.calendar(spark, small), 200101, 8)
    assert (start, look_back) == (199902, 199901)
    stored = spark.table("run_history")
    assert [r[0] for r in stored.select("period").distinct().orderBy("period").collect()][0] == start
    assert spark.table("run").count() == spark.table("run_scored").count() > 0
    assert {"rank", "band", "score_final"} <= set(spark.table("run_scored").columns)
    assert sorted(t.name for t in spark.catalog.listTables() if t.name.startswith("run")) == ["run", "run_history", "run_scored"]
    pruned = stored.where("period = 200001")
    assert "PartitionFilters: [isnotnull(period" in pruned._jdf.queryExecution().executedPlan().toString()


def test_batch_run_raises(spark, small):
    with pytest.raises(ValueError):
        batch.run_batch(inputs(spark, small), 199502, queries.LEGAL, queries.AS_OF_MS, "never", n_periods=8)


def test_a_failed_batch_run_leaves_the_former_tables(spark, small, monkeypatch):
    for name in ("kept", "kept_history", "kept_scored"):
        sinks.save_table(spark.range(3), name)
    before = {t.name for t in spark.catalog.listTables()}
    run = lambda: batch.run_batch(inputs(spark, small), 200101, queries.LEGAL, queries.AS_OF_MS, "kept", n_periods=8, scored_table="kept_scored", metrics={"none": batch.Metric(1, 1)})
    with pytest.raises(ValueError, match="active metrics"):  # after history and data set are written
        run()
    assert {t.name for t in spark.catalog.listTables()} == before
    assert [spark.table(n).count() for n in ("kept", "kept_history", "kept_scored")] == [3, 3, 3]


def test_batch_run_takes_the_scoring(spark, small):
    metrics = {"pct_clients_paid": batch.Metric(1, 1)}
    run = lambda **k: batch.run_batch(inputs(spark, small), 200101, queries.LEGAL, queries.AS_OF_MS, "by_paid", 8, "by_paid_scored", metrics, **k)
    run(orientation="higher_is_better", method="split")
    scored = spark.table("by_paid_scored").where("pct_clients_paid IS NOT NULL")
    assert {c for c in scored.columns if c.startswith("score_")} == {"score_pct_clients_paid_pct", "score_final"}
    by_segment = scored.groupBy("segment").agg(F.max_by("pct_clients_paid", "score_final").alias("of_best"), F.max("pct_clients_paid").alias("best")).collect()
    assert by_segment and all(r["of_best"] == r["best"] for r in by_segment)


def test_split_scores_read_stored_rows_and_broadcast_none_of_them(spark, small, plan_of):
    """The plan once held the history 36 times, and the driver every rank."""
    plan = plan_of(queries.registered()["agency_score_split"](spark, small))
    assert "lineitem" not in plan and plan.count("FileScan") <= 12
    merged = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(merged) == 2 and "BroadcastExchange" in plan


def test_tables_come_back_if_one_cannot_be_named(spark):
    for name in ("one", "two"):
        sinks.save_table(spark.range(1), name)
    staged = {name: sinks.stage_table(spark.range(5), name) for name in ("one", "two")}
    with pytest.raises(Exception):
        sinks.publish_tables(spark, staged | {"three": "not_there"})
    assert spark.table("one").count() == spark.table("two").count() == 1
    assert not [t.name for t in spark.catalog.listTables() if "__former" in t.name or t.name == "three"]
    for beside in staged.values():
        sinks.drop_table(spark, beside)


def test_a_table_can_be_saved_from_itself(spark):
    sinks.save_table(spark.range(4), "default.own")
    sinks.save_table(spark.table("own").where("id > 0"), "default.own")
    assert spark.table("own").count() == 3
    failing = spark.range(2).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):
        sinks.save_table(failing, "default.own")
    assert spark.table("own").count() == 3 and not spark.catalog.tableExists("own__staged")


def test_partitions_of_any_value_follow_their_table(spark):
    rows = [(1, "a b", 1), (2, "it's", 2), (3, "x/y=%", 3), (4, None, 4), (5, "ñ\\", None)]
    df = spark.createDataFrame(rows, "v int, p string, q int")
    for _ in range(2):
        sinks.save_table(df, "valued", partition_by=("p", "q"))
        assert sorted(map(tuple, spark.table("valued").select("v", "p", "q").collect())) == rows


def test_replacing_partitions_changes_no_option_and_keeps_the_rest_on_failure(spark):
    mode = "spark.sql.sources.partitionOverwriteMode"
    df = spark.createDataFrame([(1, 10), (2, 20)], "v int, p int")
    sinks.save_table(df, "by_p", partition_by=("p",))
    before = spark.conf.get(mode)
    sinks.save_table(spark.createDataFrame([(30, 3), (10, 5)], "p int, v int"), "by_p", ("p",), keep_other_partitions=True)
    assert spark.conf.get(mode) == before
    assert sorted(map(tuple, spark.table("by_p").select("p", "v").collect())) == [(10, 5), (20, 2), (30, 3)]
    failing = df.withColumn("v", F.when(F.col("p") == 20, F.raise_error(F.lit("no")).cast("int")).otherwise(9))
    with pytest.raises(Exception, match="no"):
        sinks.save_table(failing, "by_p", ("p",), keep_other_partitions=True)
    assert sorted(map(tuple, spark.table("by_p").select("p", "v").collect())) == [(10, 5), (20, 2), (30, 3)]
    sinks.save_table(df, "plain")
    with pytest.raises(ValueError, match="no partitions"):
        sinks.save_table(df, "plain", keep_other_partitions=True)


def test_save_table_replaces_all_or_single_partitions(spark):
    df = spark.createDataFrame([(1, 10), (2, 20)], "v int, p int")
    sinks.save_table(df, "parted", partition_by=("p",))
    sinks.save_table(df.where("p = 10").withColumn("v", F.lit(7)), "parted", ("p",), keep_other_partitions=True)
    assert sorted(map(tuple, spark.table("parted").select("v", "p").collect())) == [(2, 20), (7, 10)]
    sinks.save_table(df.where("p = 10"), "parted", ("p",))
    assert spark.table("parted").count() == 1


def test_bucketed_table_groups_without_a_shuffle(spark, plan_of):
    sinks.save_table(spark.range(100).withColumn("entity_id", F.col("id").cast("string")), "bucketed", bucket_by=(4, "entity_id"))
    assert "Exchange" not in plan_of(spark.table("bucketed").groupBy("entity_id").count())


def test_csv_export(spark, tmp_path):
    sinks.export_csv(spark.range(3), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 3


def test_code_map_from_json(spark, tmp_path):
    path = tmp_path / "codes.json"
    path.write_text('{"x": {"1": [0, 5]}}')
    assert sorted(map(tuple, codes.code_map_from_json(spark, str(path)).collect())) == [(1, 0, "x"), (1, 5, "x")]


def test_catalog_adapters(spark):
    key = "1 fipais, 2 ficanal, 3 fisucursal, 4 fifolio"
    few = ["segment", "arrears", "balance"]
    snapshot = catalog.snapshot(spark.sql(f"SELECT {key}, 202601 fisemana, 5 fitipodepto, 3 fisematrasomax, 9.5 fnsaldocte"), only=few)
    assert snapshot.select("entity_id", "period", "segment", "arrears", "folio").first() == ("1-2-3-4", 202601, 5, 3, 4)
    ledger = spark.sql(f"SELECT {key}, 2026 fianio, 1 fisemana, 7 fidespid, 'PLAN ACTIVO' fcplan UNION ALL SELECT {key}, 2025, 50, 7, 'x'")
    assert [tuple(r) for r in catalog.ledger(ledger, 202601, only=["agency", "plan"]).select("entity_id", "period", "plan").collect()] == [("1-2-3-4", 202601, "PLAN ACTIVO")]
    customer_key = "1 fipaiscu, 2 ficanalcu, 3 fisucursalcu, 4 fifoliocu"
    visit = spark.sql(f"SELECT {customer_key}, 202601 fisemana, 9 fivisitaid, 'MTk=' fclatitudgps")
    decoded = catalog.visits(visit, {"agent_lat": lambda c: F.unbase64(c).cast("string")}, only=["visit_code", "agent_lat"])
    assert decoded.select("entity_id", "visit_code", "agent_lat").first() == ("1-2-3-4", 9, "19")
    days = catalog.day_calendar(spark.sql("SELECT 2026 nanioekt, 3 nsemanaekt, date'2026-01-15' nfecha"))
    assert days.first()["period"] == 202603
    limits = catalog.week_limits(spark.sql("SELECT 2026 fianioproceso, 3 fisemproceso, 0L fcfecinicial, 86400000L fcfectermino"))
    assert str(limits.first()["end_date"]) == "1970-01-02"
    assert catalog.agency_segments(spark.sql("SELECT 1L fidespid, 5 fitipodepto UNION ALL SELECT 1L, 7"), [5], only=[]).count() == 1


KEYS = {"fipais": 1, "ficanal": 2, "fisucursal": 3, "fifolio": 4}
ADAPTERS = {
    # adapter: source columns of the key and the period, columns it maps, arguments, period
    "agency_master": ({}, catalog.AGENCY_MASTER, {}, None),
    "recoveries": ({**{k + "cu": v for k, v in KEYS.items()}, "fianioproceso": 2026, "fisemproceso": 3}, catalog.RECOVERIES, {"start_period": 202603}, 202603),
    "recoveries_by_own_period": ({**{k + "cu": v for k, v in KEYS.items()}, "fisemana": 202605}, catalog.RECOVERIES, {"departments": [7], "start_period": 202605}, 202605),
    "management_results": (KEYS, catalog.MANAGEMENT_RESULTS, {}, None),
    "cash_payments": ({**KEYS, "fianio": 2026, "fisemana": 3}, catalog.CASH, {"start_period": 202601}, 202603),
    "segment_changes": (KEYS, catalog.SEGMENT_CHANGES, {}, 7),
    "balances": (dict(zip(catalog.BALANCE_KEY, KEYS.values())), catalog.BALANCES, {}, None),
    "flat_key_balances": ({}, catalog.FLAT_KEY_BALANCES, {}, 7),
}


@pytest.mark.parametrize("name", ADAPTERS)
def test_adapter_takes_every_column_or_says_what_is_missing(spark, name):
    key, names, arguments, period = ADAPTERS[name]
    source = {**{c: 7 for c in names}, **key, "unused": 0}
    table = spark.createDataFrame([tuple(source.values())], list(source))
    got = getattr(catalog, name)(table, **arguments)
    row = got.first().asDict()
    assert set(names.values()) <= set(row) and "unused" not in row
    assert all(row[n] == 7 for s, n in names.items() if s not in key)
    assert period is None or row["period"] == period
    if key and "entity_id" in row:
        assert row["entity_id"] == "1-2-3-4" and row["folio"] == 4
    with pytest.raises(ValueError, match=list(names)[-1]):
        getattr(catalog, name)(table.drop(list(names)[-1]), **arguments).first()


def test_established_names(spark):
    df = spark.range(1).select(F.lit(1).alias("agency"), F.lit(2.0).alias("efficiency"), F.lit(3.0).alias("score_efficiency_pct"))
    assert naming.established_names(df, naming.DATASET).columns == ["fidespid", "eficiencia", "score_eficiencia_pct"]


def test_dataset_check(spark, small):
    base = dataset.agency_base(views.agency_segments(spark, small), views.agency_master(spark, small), queries.ALL_SEGMENTS)
    report = check.check_dataset(base)
    assert report.totals.first()["n_rows"] == 50
    assert report.profile.count() == len(base.columns)
    assert report.frequencies.select("column").distinct().count() == len(check.CHECKED_COLUMNS)


def _updated(spark, name, before, after, periods, changed_from, looked_back=199901):
    """A history stored from the former sources, the same brought up to date, and what was written for it."""
    schema = "entity_id string, period int, segment int, arrears int, balance int, last_payment int, last_arrears_payment int, n_actions int, n_actions_unpaid int, record_id int"
    entry = "entity_id string, period int, agency int, plan string, capital int, interest int, auto_charge int, captation int, manager int, entry_id int"

    def sources(rows):
        snapshot = spark.createDataFrame([(e, p, s, 1 + p % 3, 100, 5, p % 7, 1, 0, i) for i, (e, p, s, _) in enumerate(rows)], schema)
        ledger = spark.createDataFrame([(e, p, 7, None, paid, 0, 0, 0, 1, i) for i, (e, p, _, paid) in enumerate(rows) if paid is not None], entry)
        return snapshot, ledger

    orders = (["record_id"], []), (["entry_id"], [])
    first, pivot = periods
    whole = lambda rows, upto: history.history_base(*sources(rows), looked_back, (5,), *orders).where(F.col("period").between(first, upto))
    sinks.save_table(whole(before, pivot), name, partition_by=("period",))
    held = _files(spark, name)
    written = incremental.update_history(name, *sources(after), first, pivot, looked_back, (5,), *orders, changed_from)
    assert {f for f in held if f[0] not in written} == {f for f in _files(spark, name) if f[0] not in written}
    full, got = whole(after, pivot), spark.table(name)
    assert got.select(*full.columns).exceptAll(full).count() == full.exceptAll(got.select(*full.columns)).count() == 0
    return written, full


def _files(spark, name):
    return {tuple(r) for r in spark.table(name).select("period", "_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}


def test_history_is_updated_where_something_changed(spark):
    former = [(f"e{i}", p, 5, 10) for i in range(6) for p in range(199901, 199905)]
    former += [("gap", 199902, 5, 3), ("late", 199901, 1, 2), ("late", 199902, 1, 2), ("none", 199903, 1, 1), ("null", 199902, None, 1)]
    new = [(f"e{i}", 200001, 5, 10) for i in range(6)]
    later = lambda rows: _updated(spark, "kept_history_1", former, former + rows, (199902, 200001), 200001)
    assert later(new)[0] == [199904, 200001]  # the new period, and the one before it for what follows
    assert later([*new, ("gap", 200001, 5, 1)])[0] == [199902, 199904, 200001]
    assert later([("late", 200001, 5, 1)])[0] == [199902, 200001]  # belongs to the population from now on, with all its periods
    assert later([("new", 200001, 5, 1)])[0] == [200001]
    assert later([("null", 200001, 5, 1)])[0] == [199902, 200001]
    assert later([])[0] == []


def test_written_are_the_new_period_and_the_one_before(spark):
    former = [(f"e{i}", p, 5, 10) for i in range(6) for p in range(199901, 199905)]
    rows = [(f"e{i}", 200001, 5, 10) for i in range(6)]
    written, _ = _updated(spark, "kept_history_2", former, former + rows, (199902, 200001), 200001)
    assert written == [199904, 200001]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_history_2_")]


def test_replaced_records_and_periods_that_end_up_empty(spark):
    former = [(f"e{i}", p, 5, 10) for i in range(4) for p in (199901, 199902, 199903)]
    replaced = [(e, p, 1 if p == 199903 else s, paid) for e, p, s, paid in former]  # same records, another segment
    assert _updated(spark, "kept_history_3", former, replaced, (199902, 199903), 199903)[0] == [199902, 199903]
    gone = [(e, p, s, None if p == 199903 else paid) for e, p, s, paid in former]  # no ledger rows any more
    written, full = _updated(spark, "kept_history_4", former, gone, (199902, 199903), 199903)
    assert written == [199902, 199903] and {r[0] for r in full.select("period").distinct().collect()} == {199902}
    lost = [(e, p, 1 if p == 199903 else s, paid) for e, p, s, paid in [("x", 199902, 1, 1), ("x", 199903, 5, 1), *former]]
    assert _updated(spark, "kept_history_5", [("x", 199902, 1, 1), ("x", 199903, 5, 1), *former], lost, (199902, 199903), 199903)[0] == [199902, 199903]


def test_update_needs_a_history_of_the_same_start(spark, small):
    args = inputs(spark, small), queries.LEGAL, queries.AS_OF_MS
    batch.run_batch(args[0], 200004, *args[1:], "moved", n_periods=8)
    with pytest.raises(ValueError, match="begins at"):
        batch.run_batch(args[0], 200101, *args[1:], "moved", n_periods=8, changed_from=200101)
    with pytest.raises(ValueError, match="look-back"):
        incremental.update_history("moved_history", args[0].snapshot, args[0].ledger, 199902, 200101, 199901, queries.LEGAL, views.SNAPSHOT_ORDER, views.LEDGER_ORDER, 199901)
    batch.run_batch(args[0], 200101, *args[1:], "moved", n_periods=9, changed_from=200101)
    batch.run_batch(args[0], 200101, *args[1:], "whole", n_periods=9)
    for name in ("", "_history"):
        assert spark.table("moved" + name).exceptAll(spark.table("whole" + name)).count() == 0
        assert spark.table("moved" + name).count() == spark.table("whole" + name).count() > 0


def test_partitions_are_replaced_as_a_whole(spark):
    rows = spark.range(12).selectExpr("id", "CAST(id % 3 AS INT) AS part")
    sinks.save_table(rows, "parted", partition_by=("part",))
    sinks.replace_partitions(spark.sql("SELECT 99L AS id, 1 AS part"), "parted", {"part": [1, 2]})
    assert sorted(map(tuple, spark.table("parted").collect())) == [(0, 0), (3, 0), (6, 0), (9, 0), (99, 1)]
    with pytest.raises(ValueError, match="other partitions"):
        sinks.replace_partitions(spark.sql("SELECT 1L AS id, 5 AS part"), "parted", {"part": [1]})


def test_managers_are_counted_without_an_aggregation_of_their_own(spark, plan_of):
    snapshot = spark.createDataFrame(
        [(e, 199902, 5, 1, 100, 5, 1, 1, 0, i) for i, e in enumerate("abcd")],
        "entity_id string, period int, segment int, arrears int, balance int, last_payment int, last_arrears_payment int, n_actions int, n_actions_unpaid int, record_id int",
    )
    managers = [("a", 1), ("a", 1), ("a", 2), ("a", None), ("b", None), ("b", None), ("c", 3), ("c", 3)]
    ledger = spark.createDataFrame(
        [(e, 199902, 7, None, 1, 0, 0, 0, m, i) for i, (e, m) in enumerate(managers)],
        "entity_id string, period int, agency int, plan string, capital int, interest int, auto_charge int, captation int, manager int, entry_id int",
    )
    built = history.history_base(snapshot, ledger, 199901, (5,), (["record_id"], []), (["entry_id"], []))
    assert {(r["entity_id"], r["n_managers"]) for r in built.collect()} == {("a", 2), ("b", 0), ("c", 1)}
    assert dict(built.dtypes)["n_managers"] == "bigint"
    planned = plan_of(built).split("== Initial Plan ==")[-1]
    assert planned.count("SortAggregate") == 2  # the partial one and the final one


def test_only_rows_that_alter_are_computed_again(spark, monkeypatch):
    given = {}

    def watched(snapshot, ledger, *args, **named):
        given["snapshot"] = sorted((r["entity_id"], r["period"]) for r in snapshot.select("entity_id", "period").collect())
        given["ledger"] = sorted((r["entity_id"], r["period"]) for r in ledger.select("entity_id", "period").collect())
        return history.history_base(snapshot, ledger, *args, **named)

    monkeypatch.setattr(incremental, "history_base", watched)
    former = [("a", p, 5 if p == 199902 else 1, 10) for p in (199901, 199902, 199903, 199904)]
    former += [("quiet", p, 5, 10) for p in (199901, 199902, 199904)] + [("late", p, 1, 10) for p in (199902, 199903)]
    new = [("a", 200001, 1, 10), ("late", 200001, 5, 10)]
    written, full = _updated(spark, "kept_history_6", former, former + new, (199902, 200001), 200001)
    assert written == [199902, 199903, 199904, 200001] and full.count() == 9
    late = [("late", 199902), ("late", 199903), ("late", 200001)]
    # "a" belongs by a period that is not read again; one more before its last is read for what that takes from it
    assert given == {"snapshot": [("a", 199903), ("a", 199904), ("a", 200001), *late], "ledger": [("a", 199904), ("a", 200001), *late]}
