"""The driver contract, and a cross-section of registered queries against their SQL."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tools.check import check, database

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = (
    "harmonize_orders", "title_case", "apply_labels", "variable_profile", "numeric_describe",
    "frequency_table", "crosstab_sparse", "histogram_30", "kde_by_group", "iqr_outliers",
    "chi2_many_cells", "kruskal_continuous", "prop_z_test", "cluster_profile", "silhouette_exact",
)


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="generated tables are not here")
class TestQueries:
    def test_entry(self, spark):
        df = contract.entry(spark)
        assert df.columns == ["_year", "n"]
        assert df.count() == 7

    @pytest.mark.parametrize("name", SAMPLE)
    def test_matches_sql(self, spark, name):
        state, note = check(spark, database(SF_DIR), name, SF_DIR)
        assert state == "OK", note

    @pytest.mark.parametrize("name", ["dataset_overview_all", "overview_by_period"])
    def test_whole_overviews_match_sql(self, spark, name):
        state, note = check(spark, database(SF_DIR), name, SF_DIR)
        assert state == "OK", note

    def test_landed_years_follow_the_data(self, spark, monkeypatch):
        """Orders of years that no generation was written for land as well."""
        from pyspark.sql import functions as F

        from suite import landing_data, q_ingest

        whole = landing_data.table

        def older(spark, sf_dir, name):
            df = whole(spark, sf_dir, name)
            if name != "orders":
                return df
            date = "CAST(o_orderdate - make_interval(CASE year(o_orderdate) WHEN 1995 THEN 2 ELSE 0 END) AS timestamp_ntz)"
            return df.withColumn("o_orderdate", F.expr(date))

        monkeypatch.setattr(landing_data, "table", older)
        got = q_ingest._harmonised(spark, SF_DIR).groupBy("_year").count().collect()
        assert {r["_year"] for r in got} == {2010, *range(2013, 2019)}
        assert sum(r["count"] for r in got) == whole(spark, SF_DIR, "orders").count()
