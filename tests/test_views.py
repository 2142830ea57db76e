"""The views against their definition, run by DuckDB with a plain BETWEEN join on every day."""

from __future__ import annotations

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from coverbay import oracles
from coverbay.operators.inforce import BadCalendar, Calendar
from coverbay.plans import views
from coverbay.schemas import STAR
from coverbay.sources.parameters import literal_table
from tests.tables import calendar_rows, money, random_star_rows, row_set, spark_star, star_table

D = datetime.date

SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "date": "DATE", "boolean": "BOOLEAN"}


def duck(rows):
    con = duckdb.connect()
    for name, table in rows.items():
        columns = ", ".join(
            f'"{f.name}" {SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())}' for f in STAR[name]
        )
        con.execute(f"CREATE TABLE {name} ({columns})")
        if table:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(STAR[name]))})", table)
    for view, text in oracles._VIEWS.items():
        con.execute(f"CREATE VIEW {view} AS {text}")
    return con


def same(view, con, name):
    """Compare with the oracle's own final select, which starts from the views."""
    select = oracles.ORACLES[name].rsplit("\nSELECT", 1)[-1]
    result = con.execute("SELECT" + select)
    names = [c[0] for c in result.description]
    theirs = sorted(result.fetchall(), key=lambda r: [(v is not None, str(v)) for v in r])
    mine = row_set(
        view.select([F.col(f.name).cast("double") if f.dataType.typeName() == "decimal" else f.name for f in view.schema]).select(names)
    )
    assert mine == theirs
    return len(mine)


@pytest.fixture(scope="module", params=[1, 2, 3])
def both(request, spark):
    rows = random_star_rows(request.param)
    star = {name: df.cache() for name, df in spark_star(spark, rows).items()}
    yield star, duck(rows)
    for df in star.values():
        df.unpersist()


@pytest.mark.parametrize("name", ["exec_portfolio", "claims_loss", "operations_daily", "risk_daily"])
def test_view_equals_definition(both, name):
    star, con = both
    assert same(views.BUILDERS[name](star), con, name) > 20


def test_variants_equal_definition(both):
    star, con = both
    for name in ("operations_daily_equivalent", "risk_daily_threshold"):
        same(getattr(views, name)(star), con, name)


def test_month_variants_equal_definition(both):
    star, con = both
    for name in ("exec_portfolio_month_once", "claims_loss_true_exposure"):
        body = oracles.ORACLES[name]
        select = body[body.rindex(oracles._VIEWS["vw_risk_7"]) + len(oracles._VIEWS["vw_risk_7"]) + 1 :].strip()
        result = con.execute(select)
        names = [c[0] for c in result.description]
        theirs = sorted(result.fetchall(), key=lambda r: [(v is not None, str(v)) for v in r])
        view = getattr(views, name)(star)
        mine = row_set(view.select([F.col(f.name).cast("double") if f.dataType.typeName() == "decimal" else f.name for f in view.schema]).select(names))
        assert mine == theirs, name


def test_calendar_of_a_year_equals_filter(both):
    star, _ = both
    dim_time = star["dim_time"]
    whole = views.operations_daily(star)
    cut = Calendar(D(2024, 3, 5), D(2024, 4, 2))
    expected = whole.where(F.col("day_date").between(cut.first_day, cut.last_day))
    assert row_set(views.operations_daily(star, cut)) == row_set(expected)
    assert Calendar.of(dim_time).of_year(2024) == Calendar.of(dim_time)
    outside = Calendar.of(dim_time).of_year(2031)
    assert outside.is_empty()
    for build in views.BUILDERS.values():
        assert build(star, outside).collect() == []


def test_same_result_under_other_partitioning(both, spark):
    star, _ = both
    before = row_set(views.risk_daily(star))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, adaptive in (("1", "true"), ("50", "false")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            assert row_set(views.risk_daily(star)) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def fact(id_, start, end, product="AUTO_FULL", score=5, premium=10):
    return (id_, product, "NY", "NE", start, end, start // 10000, start // 100 % 100, "Active", money(score), money(premium), money(premium and premium * 12))


def small_star(spark, facts, headers=(), claims=()):
    return spark_star(
        spark,
        {
            "dim_time": calendar_rows(D(2024, 1, 1), D(2024, 3, 31)),
            "dim_products": [("AUTO_FULL", "Auto", "Full")],
            "dim_policies": list(headers),
            "fact_policies": facts,
            "fact_claims": list(claims),
        },
    )


def test_premium_counts_once_per_day_in_the_month(spark):
    star = small_star(spark, [fact("P1", 20240130, 20240202), fact("P2", 20240115, None)])
    assert row_set(views.exec_portfolio(star), "year_month", "active_policies", "total_monthly_premium") == [
        ("2024-01", 2, money("30.00")), ("2024-02", 1, money("20.00")),
    ]
    assert row_set(views.exec_portfolio_month_once(star), "year_month", "active_policies", "total_monthly_premium") == [
        ("2024-01", 2, money("20.00")), ("2024-02", 1, money("10.00")),
    ]


def test_open_ended_policy_stays_in_the_daily_views(spark):
    star = small_star(spark, [fact("P1", 20240329, None), fact("P2", 20231201, 20240102), fact("P3", 20240330, 20240330)])
    columns = ("day_date", "active_policies", "policies_started", "policies_ended")
    assert row_set(views.operations_daily(star), *columns) == [
        (D(2024, 1, 1), 1, 0, 0), (D(2024, 1, 2), 1, 0, 1),
        (D(2024, 3, 29), 1, 1, 0), (D(2024, 3, 30), 2, 1, 1), (D(2024, 3, 31), 1, 0, 0),
    ]


def test_premium_repeats_per_claim(spark):
    def claim(id_, day, policy="P1"):
        return (id_, policy, "X", "X", "ZZ", "ZZ", "Theft", "Paid", False, day, day, None, None, money(5), money(5), money(5))

    star = small_star(
        spark,
        [fact("P1", 20240101, None), fact("P2", 20240101, None, premium=0)],
        claims=[claim("K1", 20240210), claim("K2", 20240211), claim("K3", 20250101), claim("K4", 20240310, "P2")],
    )
    view = views.claims_loss(star)
    columns = ("year_month", "exposed_policies", "claim_count", "total_premium", "claim_frequency", "claim_severity", "loss_ratio")
    assert row_set(view, *columns) == [
        ("2024-02", 1, 2, money("240.00"), 2.0, 5.0, 10 / 240), ("2024-03", 1, 1, money("0.00"), 1.0, 5.0, None),
    ]


def test_empty_facts_give_empty_views(spark):
    star = small_star(spark, [])
    assert all(view.isEmpty() for view in views.build_views(star).values())


def test_calendar_must_have_one_row_per_day(spark):
    rows = calendar_rows(D(2024, 1, 1), D(2024, 1, 5))
    assert Calendar.of(star_table(spark, "dim_time", rows)) == Calendar(D(2024, 1, 1), D(2024, 1, 5))
    wrong_month = [(*rows[0][:3], 7, *rows[0][4:]), *rows[1:]]
    for bad in (rows[:2] + rows[3:], rows + rows[:1], [], wrong_month):
        with pytest.raises(BadCalendar):
            Calendar.of(star_table(spark, "dim_time", bad))


def test_views_answer_sql(spark):
    star = small_star(spark, [fact("P1", 20240101, 20240103)], headers=[("P1", "N1", "C1", "NY", "NE", None)])
    names = views.register_views(star)
    assert names == ["vw_dash_exec_portfolio", "vw_dash_claims_loss", "vw_dash_operations_daily", "vw_dash_risk_daily"]
    row = spark.sql("SELECT sum(active_policies), max(avg_risk_score), sum(renewal_policies) FROM vw_dash_risk_daily").first()
    assert tuple(row) == (3, 5.0, 0)


def test_wanted_literal_tables_have_a_known_size(spark):
    table = literal_table(spark, "a b", [("x", 1), ("y", 2)])
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", params=[4, 5])
def repeated(request, spark):
    """Ids that repeat with equal, overlapping and touching terms, in one segment and over several; NULL ids."""
    rows = random_star_rows(request.param, policies=220)

    def shared(id_):
        number = int(id_[1:])
        return None if number % 29 == 0 else f"P{number % 9}"

    rows["fact_policies"] = [(shared(r[0]), *r[1:]) for r in rows["fact_policies"]]
    rows["fact_policies"] += rows["fact_policies"][:20]
    rows["dim_policies"] = [(f"P{i % 9}", *r[1:]) for i, r in enumerate(rows["dim_policies"][:14])]
    rows["fact_claims"] = [
        (None if i % 31 == 0 else f"K{i % 70}", f"P{i % 11}", *r[2:]) for i, r in enumerate(rows["fact_claims"])
    ]
    star = {name: df.cache() for name, df in spark_star(spark, rows).items()}
    yield star, duck(rows)
    for df in star.values():
        df.unpersist()


@pytest.mark.parametrize("name", ["exec_portfolio", "claims_loss", "operations_daily", "risk_daily"])
def test_repeated_ids_count_once(repeated, name):
    star, con = repeated
    assert same(views.BUILDERS[name](star), con, name) > 20


def shuffled_rows(df):
    """Rows that the exchanges of ``df`` wrote, after it ran without adaptive execution."""
    df.collect()
    plans, rows = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        node = plans.pop()
        if node.nodeName() == "Exchange":
            rows += node.metrics().apply("shuffleRecordsWritten").value()
        plans += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def test_claims_of_a_policy_in_many_segments_are_few_rows(spark):
    """Its claims would be 30,000 rows if each met each segment; the last bit of a word counts too."""
    states = [None, *[f"S{i:03d}" for i in range(149)]]
    facts = [("P1", "AUTO_FULL", state, *fact("P1", 20240101, 20241231)[3:]) for state in states]
    facts.append(("P2", "AUTO_FULL", "S007", *facts[0][3:]))
    claim = ("X", "X", "ZZ", "ZZ", "Theft", "Paid", False, 20240210, 20240210, None, None, *[money(5)] * 3)
    claims = [(f"K{i}", "P1", *claim) for i in range(200)] + [("K0", "P2", *claim), ("K900", "P2", *claim), (None, "P2", *claim)]
    star = small_star(spark, facts, claims=claims)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        view = views.claims_loss(star)
        assert shuffled_rows(view) < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    found = row_set(view, "state_code", "exposed_policies", "claim_count", "total_losses", "total_premium")
    both = ("S007", 2, 201, money("1015.00"), money(120 * 203))
    alone = [(state, 1, 200, money("1000.00"), money(120 * 200)) for state in states if state != "S007"]
    assert found == sorted([*alone, both], key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("by", [[], ["line_of_business"], ["state_code", "region_code"], ["product_key"]])
def test_repeated_ids_count_once_over_years_and_coarser_segments(repeated, by):
    star, _ = repeated
    calendar = Calendar.of(star["dim_time"])
    lines = {r.product_key: r.line_of_business for r in star["dim_products"].collect()}
    held, exposed, counted = {}, {}, {}
    for policy in star["fact_policies"].collect():
        values = {**policy.asDict(), "line_of_business": lines.get(policy.product_key)}
        held.setdefault(policy.policy_id, set()).add(tuple(values[name] for name in by))
    first, last = calendar.key_range()
    for claim in star["fact_claims"].collect():
        if first <= claim.incident_date_key <= last:
            for segment in held.get(claim.policy_id, ()) if claim.policy_id else ():
                exposed.setdefault(segment, set()).add(claim.policy_id)
                counted.setdefault(segment, set()).update({claim.claim_id} - {None})
    expected = [(*segment, len(ids), len(counted[segment])) for segment, ids in exposed.items()]
    view = views.claims_over(star, by, "year", calendar)
    assert row_set(view, *by, "exposed_policies", "claim_count") == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])


def test_counting_ids_or_rows_is_the_same_where_ids_are_unique(both):
    star, _ = both
    for name, build in views.BUILDERS.items():
        assert row_set(build(star, distinct=True)) == row_set(build(star, distinct=False)), name
