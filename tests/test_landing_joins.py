"""What grows with the data is neither broadcast nor joined once a year when vintages land."""

SF_DIR = "/root/testdata/sf0.001"


def test_customers_are_not_broadcast(spark):
    from suite import landing_data

    plan = landing_data.raw_deaths(spark, SF_DIR, (2012,))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1


def test_years_land_from_one_join(spark, monkeypatch):
    from suite import landing_data

    calls, orders = [], landing_data._orders
    monkeypatch.setattr(landing_data, "_orders", lambda s, d, years: (calls.append(years), orders(s, d, years))[1])
    monkeypatch.setattr(landing_data, "_landed", {})
    folder = landing_data.landing_folder(spark, SF_DIR)
    assert len(calls) == 1
    years = landing_data.landed_years(spark, SF_DIR)
    for y in years:
        landed = spark.read.parquet(f"{folder}/{y}-deaths.parquet")
        whole = landing_data.raw_deaths(spark, SF_DIR, (y,))
        assert landed.columns == whole.columns and landed.exceptAll(whole).count() == 0 == whole.exceptAll(landed).count()
