"""Partition selection (W1-W4, J6, O2, R3) against brute force on a small index."""

import itertools

from cellkpi.operators import select as sel


def _store(spark):
    rows = []
    # market A: two days, newest day has one hour; market B: one day, 5 hours
    for d, h in [("2024-01-04", "20"), ("2024-01-04", "21"), ("2024-01-04", "22"), ("2024-01-05", "01")]:
        rows.append(("f", d, "A", h, 1.0))
    for h in ["03", "04", "05", "06", "07"]:
        rows.append(("f", "2024-01-03", "B", h, 1.0))
    rows.append(("g", "2024-01-05", "A", "09", 1.0))
    return spark.createDataFrame(rows, "pk_ft string, pk_date string, pk_market string, pk_hr string, v double")


def _brute(rows, n):
    out = set()
    key = lambda r: (r[0], r[2])
    for k, grp in itertools.groupby(sorted(rows, key=key), key=key):
        parts = sorted({(r[1], r[3]) for r in grp}, reverse=True)[:n]
        out |= {(k[0], d, k[1], h) for d, h in parts}
    return out


def test_latest_hours_matches_brute_force(spark):
    st = _store(spark)
    rows = [tuple(r) for r in st.collect()]
    for n in (1, 2, 3, 4, 10):
        got = {(r.pk_ft, r.pk_date, r.pk_market, r.pk_hr) for r in sel.latest_hours(st, n).collect()}
        assert got == _brute(rows, n)
    # across dates: market A's newest day has one hour, the next two come from the day before
    a = sorted((r.pk_date, r.pk_hr) for r in sel.latest_hours(st, 3).where("pk_ft='f' and pk_market='A'").collect())
    assert a == [("2024-01-04", "21"), ("2024-01-04", "22"), ("2024-01-05", "01")]


def test_latest_day_dates_and_semi(spark):
    st = _store(spark)
    ld = sel.latest_hours_latest_day(st, 3).where("pk_ft='f' and pk_market='A'").collect()
    assert [(r.pk_date, r.pk_hr) for r in ld] == [("2024-01-05", "01")]
    lm = {(r.pk_ft, r.pk_market): r.latest_date for r in sel.latest_date_per_market(st).collect()}
    assert lm[("f", "B")] == "2024-01-03"
    assert sel.latest_date_overall(st).first().latest_date == "2024-01-05"
    mh = {(r.pk_date, r.pk_market): r.max_hr for r in sel.max_hour_across_families(st).collect()}
    assert mh[("2024-01-05", "A")] == "09"
    assert [r.pk_date for r in sel.latest_dates(st, 2).collect()] == ["2024-01-05", "2024-01-04"]
    assert sel.rows_in_latest_dates(st, 1).count() == 2


def test_restrict_to_is_semi_join_with_broadcast(spark):
    st = _store(spark)
    r = sel.restrict_to(st, sel.latest_hours(st, 2))
    assert r.count() == 2 + 2 + 1
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_freshness_gate(spark):
    st = _store(spark)
    g = {(r.pk_ft, r.pk_market): r.is_fresh for r in sel.fresh_markets(st, "2024-01-07", 3).collect()}
    assert g == {("f", "A"): True, ("f", "B"): False, ("g", "A"): True}
    assert all(r.is_fresh for r in sel.fresh_markets(st, "2030-01-01", -1).collect())


def test_round_half_away_matches_sql_rounding(spark):
    import duckdb
    from cellkpi.functions.scalars import round_half_away
    vals = [1.23455, -1.23455, 2.5e-5, -2.5e-5, 0.00004999, 123456.78915, 1e16 + 2.0, float("nan"), None, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.y for r in df.select(round_half_away("x", 4).alias("y")).collect()]
    con = duckdb.connect()
    exp = [con.execute("SELECT round(CAST(? AS DOUBLE), 4)", [v]).fetchall()[0][0] if v is not None else None
           for v in vals]
    for g, e, v in zip(got, exp, vals):
        if v is None:
            assert g is None
        elif v != v:
            assert g != g                                  # NaN passes through
        else:
            assert g == e, (v, g, e)


def test_cluster_sizing_profile_uses_real_runtime_settings(spark):
    from cellkpi.session import CLUSTER_CONF
    for k in CLUSTER_CONF:
        assert spark.conf.isModifiable(k), k          # an SQL setting Spark knows and lets a session change
