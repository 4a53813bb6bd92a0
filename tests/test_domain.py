"""Derived tables that start from those that exist."""

from readloom.jobs import domain

SF = "/root/testdata/sf0.001"


def test_tables_start_from_stored_ones(spark):
    sites, glen = domain.table(spark, SF, "sites").limit(0), spark.createDataFrame([(5000,)], "g long")
    have = {"sites": sites.localCheckpoint(), "glen": glen}
    for name in ("indels", "regions", "transcripts", "known"):
        assert "documents" not in domain.table(spark, SF, name, have.get)._jdf.queryExecution().toString(), name
    assert domain.table(spark, SF, "indels", have.get).columns == domain.table(spark, SF, "indels").columns
