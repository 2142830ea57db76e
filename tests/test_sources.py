from __future__ import annotations

import dataclasses
import datetime
import json
from types import SimpleNamespace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coverbay.operators import quality
from coverbay.operators.star import build_star
from coverbay.plans import refresh, views
from coverbay.schemas import RAW, STAR
from coverbay.sources import folders, parameters, raw, warehouse
from tests.tables import calendar_rows, money, row_set, star_table
from tests.test_quality import CLEAN_RAW, CLEAN_STAR, raw_tables, spark_star

D = datetime.date


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def write_text(root, name, text):
    with open(f"{root}/{name}.csv", "w") as file:
        file.write(text)


CLAIM_HEADER = ",".join(RAW["claims"].names)


def test_csv_round_trip_keeps_values_and_nulls(spark, root):
    rows = [("E1", "Operating, misc", None, 'say "hi"', 20240101, Decimal("1.50")), ("E2", None, "NY", "NE", None, None)]
    table = star_table(spark, "fact_expenses", rows)
    raw.write_csv(table, root, "fact_expenses")
    back = raw.read_star_csv(spark, root, "fact_expenses")
    assert back.schema.names == STAR["fact_expenses"].names
    assert row_set(back) == row_set(table)


def test_columns_are_read_by_name_and_extra_ones_stay_text(spark, root):
    write_text(root, "taxes", "tax_rate,note,tax_id,tax_base,policy_id,state_code,tax_amount\n0.0350,x,1,100.5,P1,NY,3.5\n")
    row = raw.read_raw(spark, root, "taxes").first()
    assert (row.tax_id, row.tax_rate, row.tax_base, row.note) == (1, Decimal("0.0350"), Decimal("100.500000"), "x")


def test_optional_column_may_be_absent(spark, root):
    write_text(root, "claims", f"{CLAIM_HEADER}\nK1,P1,2024-01-01,2024-01-02,Theft,1,1,1,Paid\n")
    assert "fraud_flag" not in raw.read_raw(spark, root, "claims").columns
    write_text(root, "claims", f"{CLAIM_HEADER},fraud_flag\nK1,P1,2024-01-01,,Theft,1,1,1,Paid,T\n")
    row = raw.read_raw(spark, root, "claims").first()
    assert (row.fraud_flag, row.report_date) == ("T", None)


def test_missing_empty_and_malformed_files(spark, root):
    with pytest.raises(raw.MissingTable):
        raw.read_raw(spark, root, "claims")
    write_text(root, "claims", CLAIM_HEADER + "\n")
    with pytest.raises(raw.EmptyTable):
        raw.read_raw(spark, root, "claims")
    write_text(root, "claims", f"{CLAIM_HEADER}\nK1,P1,someday,2024-01-02,Theft,1,1,1,Paid\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|someday"):
        raw.read_raw(spark, root, "claims").collect()
    row = raw.read_raw_for_report(spark, root, "claims").cache().first()
    assert row.incident_date is None and row.claim_id == "K1" and "someday" in row[raw.CORRUPT]
    assert raw.missing_files(spark, root, list(RAW)) == ["clients", "policies", "expenses", "taxes"]
    with pytest.raises(raw.MissingTable, match="clients, policies"):
        raw.read_all_raw(spark, root)


def test_row_counts(spark):
    counts = raw.row_counts(raw_tables(spark, CLEAN_RAW))
    assert row_set(counts) == [("claims", 1), ("clients", 1), ("expenses", 1), ("policies", 5), ("taxes", 1)]


def test_parameters_document(spark, root):
    document = {
        "meta": {"version": "4.0"},
        "organization": {"states": [{"state_code": "NY", "region_code": "NE", "market_tier": "Tier 1"}]},
        "products": {"Life": {"Basic": {"base_monthly_premium": 60, "target_loss_ratio": 0.5}}, "Auto": {"Full": {"base_monthly_premium": 300.5}}},
        "claims": {
            "baseline_frequency": {"Life": 0.01},
            "seasonality_by_month": {"1": 0.9, "12": 1.1},
            "climate_sensitivity_by_state": {"NY": 1.5},
            "default_climate_factor": 1.25,
        },
    }
    path = f"{root}/config.json"
    with open(path, "w") as file:
        json.dump(document, file, indent=2)
    read = parameters.read_parameters(spark, path)
    assert row_set(read.states) == [("NY", "NE", "Tier 1")]
    assert row_set(read.plans) == [("Auto", "Full", Decimal("300.50")), ("Life", "Basic", Decimal("60.00"))]
    assert row_set(read.baseline) == [("Life", Decimal("0.0100"))]
    assert row_set(read.seasonality) == [(1, Decimal("0.9000")), (12, Decimal("1.1000"))]
    assert row_set(read.climate) == [("NY", Decimal("1.5000"))]
    assert Decimal(read.default_climate) == Decimal("1.25")
    assert read.tax_rates.count() == 3


def write_json(root, document):
    path = f"{root}/part.json"
    with open(path, "w") as file:
        json.dump(document, file, indent=2)
    return path


@pytest.mark.parametrize(
    "part, changed",
    [
        ({}, set()),
        ({"claims": {"baseline_frequency": {"Boat": 0.5}}}, {"baseline"}),
        ({"claims": {"seasonality_by_month": {"1": 0.5}}}, {"seasonality"}),
        ({"claims": {"climate_sensitivity_by_state": {"ZZ": 2}, "default_climate_factor": 1.5}}, {"climate", "default_climate"}),
        ({"organization": {"states": [{"state_code": "ZZ", "region_code": "Z", "market_tier": "Tier 1"}]}}, {"states"}),
        ({"products": {"Boat": {"Small": {"base_monthly_premium": 7}}}}, {"plans"}),
        ({"time": {"start_date": "2020-01-01", "end_date": "2021-12-31", "years": [2020, 2021]}}, {"window", "years"}),
        ({"portfolio": {"avg_policies_per_client": 2.5}}, {"policies_per_client"}),
        ({"portfolio": {"by_year": {"2020": {"active_clients": 5, "estimated_policies": 8}}}}, {"targets"}),
    ],
)
def test_parts_that_a_document_lacks_keep_their_defaults(spark, root, part, changed):
    read = parameters.read_parameters(spark, write_json(root, part))
    defaults = parameters.default_parameters(spark)
    plain = lambda value: row_set(value) if hasattr(value, "schema") else value
    names = [field.name for field in dataclasses.fields(defaults)]
    assert {n for n in names if plain(getattr(read, n)) != plain(getattr(defaults, n))} == changed
    if "targets" in changed:
        assert read.targets == {2020: (5, 8)}
    if "window" in changed:
        assert read.window == ("2020-01-01", "2021-12-31") and read.years == (2020, 2021)


def test_default_parameters(spark):
    defaults = parameters.default_parameters(spark)
    counts = [t.count() for t in (defaults.states, defaults.plans, defaults.seasonality, defaults.climate)]
    assert counts == [18, 9, 12, 18]


def test_warehouse_publishes_only_what_passes(spark, root):
    assert warehouse.published_version(spark, root) == 0
    with pytest.raises(warehouse.NothingPublished):
        warehouse.read_warehouse(spark, root)

    star = spark_star(spark, CLEAN_STAR)
    assert warehouse.load_warehouse(spark, star, root) == 1
    loaded = warehouse.read_warehouse(spark, root)
    for name, table in star.items():
        assert loaded[name].schema.names == STAR[name].names
        assert row_set(loaded[name]) == row_set(table), name

    for name, view in views.build_views(star).items():
        assert row_set(warehouse.read_view(spark, root, name)) == row_set(view), name
    states = warehouse.read_risk_states(spark, root)
    assert row_set(views.risk_of_states(states)) == row_set(views.risk_daily(star))
    # the join with the headers is stored, so the view of stored tables shuffles no policy
    plan = views.risk_daily(loaded, distinct=False)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(policy_id" not in plan and "dim_policies" not in plan
    rules = [row.rule_id for row in warehouse.quality_report(spark, root, 1).collect()]
    assert len(rules) == len(set(rules)) and {"V-TM2", "V-D8", "V-L9", "V-L10.risk_daily", "V-L11"} <= set(rules)

    bad = {**star, "fact_taxes": star_table(spark, "fact_taxes", [*CLEAN_STAR["fact_taxes"], *CLEAN_STAR["fact_taxes"]])}
    with pytest.raises(quality.QualityGateFailed, match="V-D1.fact_taxes"):
        warehouse.load_warehouse(spark, bad, root)
    assert warehouse.published_version(spark, root) == 1
    assert warehouse.read_warehouse(spark, root)["fact_taxes"].count() == 1
    failed = warehouse.quality_report(spark, root, 2).where("NOT passed")
    assert row_set(failed, "rule_id", "violations") == [("V-D1.fact_taxes", 1)]

    # a rerun replaces the whole data set
    fewer = {**star, "fact_claims": star["fact_claims"].withColumn("claim_type", F.lit("Death"))}
    assert warehouse.load_warehouse(spark, fewer, root) == 2
    assert row_set(warehouse.read_warehouse(spark, root)["fact_claims"], "claim_type") == [("Death",)]


def test_two_loads_never_share_a_version(spark, root):
    assert [warehouse.claim_version(spark, root) for _ in range(2)] == [1, 2]
    warehouse.release_version(spark, root, 1)
    assert warehouse.claim_version(spark, root) == 1


def test_old_versions_go(spark, root):
    star = spark_star(spark, CLEAN_STAR)
    for _ in range(3):
        warehouse.load_warehouse(spark, star, root, keep=2)
    assert folders.names(spark, f"{root}/versions") == ["2", "3"]
    assert warehouse.read_warehouse(spark, root)["fact_taxes"].count() == 1
    years = folders.names(spark, f"{root}/versions/3/views/risk_daily")
    assert any(name.startswith("year=") for name in years)


def test_a_load_that_runs_for_long_keeps_its_folder_and_raises_in_the_end(spark, root):
    star = spark_star(spark, CLEAN_STAR)
    slow = warehouse.claim_version(spark, root)
    warehouse.write_table(star["dim_time"], warehouse.table_path(root, slow, "dim_time"), "dim_time")
    published = [warehouse.load_warehouse(spark, star, root, keep=2) for _ in range(4)]
    assert published == [2, 3, 4, 5]
    assert folders.names(spark, f"{root}/versions") == ["1", "4", "5"]
    assert warehouse.published_versions(spark, root) == [4, 5]  # the list is as short as what is kept
    with pytest.raises(warehouse.LateLoad, match="version 5"):
        warehouse.load_warehouse(spark, star, root, version=slow)
    assert warehouse.published_versions(spark, root) == [4, 5]
    assert warehouse.claim_version(spark, root) == 6


def test_what_a_crashed_load_left_goes_when_its_lease_has_run_out(spark, root):
    star = spark_star(spark, CLEAN_STAR)
    crashed = warehouse.claim_version(spark, root)
    warehouse.write_table(star["dim_time"], warehouse.table_path(root, crashed, "dim_time"), "dim_time")
    for _ in range(2):
        warehouse.load_warehouse(spark, star, root)
    warehouse.drop_old_versions(spark, root, 1)
    assert folders.names(spark, f"{root}/versions") == ["1", "3"]
    warehouse.drop_old_versions(spark, root, 1, lease_ms=-1)
    assert folders.names(spark, f"{root}/versions") == ["3"] and folders.names(spark, f"{root}/claims") == ["3"]
    with pytest.raises(warehouse.LateLoad, match="claim of version 1 is gone"):
        warehouse.publish(spark, root, crashed)


def test_storage_is_held_against_the_manifest(spark, root):
    star = spark_star(spark, CLEAN_STAR)
    version = warehouse.load_warehouse(spark, star, root)
    assert warehouse.verify_version(spark, root, version).where("NOT passed").count() == 0
    folders.delete(spark, warehouse.table_path(root, version, "dim_state"))
    folders.delete(spark, warehouse.view_path(root, version, "risk_daily"))
    star["fact_taxes"].unionAll(star["fact_taxes"]).write.mode("overwrite").parquet(warehouse.table_path(root, version, "fact_taxes"))
    star["dim_products"].drop("plan_name").write.mode("overwrite").parquet(warehouse.table_path(root, version, "dim_products"))
    failed = warehouse.verify_version(spark, root, version).where("NOT passed")
    assert row_set(failed, "rule_id", "violations") == row_set(
        spark.createDataFrame(
            [("V-L11", 2), ("V-L12.dim_state", None), ("V-L12.risk_daily", None), ("V-L12.fact_taxes", 1), ("V-L12.dim_products", None)],
            "rule_id string, violations bigint",
        )
    )


def test_a_failing_view_is_a_failed_rule(spark):
    star = spark_star(spark, CLEAN_STAR)
    built = views.build_views(star)
    broken = spark.range(1).select(F.raise_error(F.lit("no view")).alias("x"))
    report = quality.check_views(spark, star, {**built, "risk_daily": broken})
    rows = {row.rule_id: (row.severity, row.violations, row.passed) for row in report.collect()}
    assert rows["V-L10.risk_daily"] == ("FAIL", None, False)
    assert rows["V-L10.claims_loss"] == ("WARN", 0, True)


def test_refresh_reports_missing_files_and_lines_that_do_not_parse(spark, root):
    for name, table in raw_tables(spark, CLEAN_RAW).items():
        if name == "claims":
            table = table.withColumn("claim_amount_paid", F.lit("much"))
        if name != "taxes":
            raw.write_csv(table, f"{root}/raw", name)
    with pytest.raises(quality.QualityGateFailed, match="V-R1"):
        refresh.refresh_warehouse(spark, f"{root}/raw", f"{root}/warehouse")
    report = {row.rule_id: row.violations for row in warehouse.raw_report(spark, f"{root}/warehouse", 1).collect()}
    assert report["V-R1"] == 1 and report["V-R2.taxes"] is None
    assert report["V-R3.claims"] == len(CLEAN_RAW["claims"]) and report["V-R3.clients"] == 0


def test_refresh_from_raw_files(spark, root):
    tables = raw_tables(spark, CLEAN_RAW)
    for name, table in tables.items():
        raw.write_csv(table, f"{root}/raw", name)
    version = refresh.refresh_warehouse(spark, f"{root}/raw", f"{root}/warehouse")
    loaded = warehouse.read_warehouse(spark, f"{root}/warehouse")
    direct = build_star(tables)
    assert version == 1
    assert warehouse.raw_report(spark, f"{root}/warehouse", 1).where("rule_id = 'V-K7'").count() == 1
    assert folders.names(spark, f"{root}/warehouse/staging") == []
    for name in STAR:
        assert row_set(loaded[name]) == row_set(direct[name]), name
    assert row_set(views.exec_portfolio(loaded)) == row_set(views.exec_portfolio(direct))


def test_staging_uses_the_shared_folder_of_the_cluster():
    cluster = SimpleNamespace(conf=SimpleNamespace(get={"spark.checkpoint.dir": "hdfs:///shared/"}.get))
    assert refresh.staging_folder(cluster, "/w").startswith("hdfs:///shared/raw-")
    unnamed = SimpleNamespace(conf=SimpleNamespace(get={}.get))
    assert refresh.staging_folder(unnamed, "/w").startswith("/w/staging/raw-")


def test_refresh_stops_at_the_raw_gate(spark, root):
    rows = {**CLEAN_RAW, "taxes": CLEAN_RAW["taxes"] * 2}
    for name, table in raw_tables(spark, rows).items():
        raw.write_csv(table, f"{root}/raw", name)
    with pytest.raises(quality.QualityGateFailed, match="V-T2"):
        refresh.refresh_warehouse(spark, f"{root}/raw", f"{root}/warehouse")
    assert warehouse.published_version(spark, f"{root}/warehouse") == 0


def test_catalog_presence(spark):
    star_table(spark, "dim_time", calendar_rows(D(2024, 1, 1), D(2024, 1, 1))).createOrReplaceTempView("dim_time_here")
    assert warehouse.missing_from_catalog(spark, ["dim_time_here", "not_there"]) == ["not_there"]


def test_policies_are_partitioned_by_year_and_a_large_year_is_split(spark, root):
    years = [2024 if i % 10 else 2023 for i in range(3000)]
    rows = [
        (f"P{i}", "A", "NY", "NE", 20240101, None, year, 1, "Active", money(5), money(1), money(12))
        for i, year in enumerate(years)
    ]
    table = star_table(spark, "fact_policies", rows)

    def files_per_year(folder):
        warehouse.write_table(table, f"{root}/{folder}", "fact_policies")
        written = spark.read.schema(STAR["fact_policies"]).parquet(f"{root}/{folder}")
        assert row_set(written, "policy_id") == row_set(table, "policy_id")
        files = written.select("policy_year", F.input_file_name().alias("f")).distinct()
        return dict(files.groupBy("policy_year").count().collect())

    assert files_per_year("small") == {2023: 1, 2024: 1}
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    try:
        assert files_per_year("large")[2024] > 1
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
