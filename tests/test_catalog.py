import pytest
from pyspark.sql import types as T

from loanbook.sources import SCHEMAS, conform, load_parquet, load_warehouse
from workload.staging import TABLES


def test_every_table_has_a_derivation(spark):
    assert set(SCHEMAS) == set(TABLES)
    for ddl in SCHEMAS.values():
        names = T.StructType.fromDDL(ddl).fieldNames()
        assert len(names) == len(set(names))


def test_conform_casts_text_booleans_and_drops_the_rest(spark):
    raw = spark.createDataFrame(
        [("l", "a", "c", "2024-03-01", "5.00", "TRUE", 3, "x")],
        "loan_id string, account_id string, customer_id string, benchmark_date string, "
        "daily_rate string, in_repayment string, days_elapsed long, other string",
    )
    found = conform(raw, "metered_days")
    assert found.schema.simpleString() == T.StructType.fromDDL(SCHEMAS["metered_days"]).simpleString()
    assert found.first().in_repayment is True


def test_conform_names_missing_columns(spark):
    with pytest.raises(ValueError, match="sender"):
        conform(spark.createDataFrame([("1",)], "id string"), "payments")


def test_stored_tables_come_back(spark, tmp_path):
    spark.createDataFrame([("1", "+2")], "id string, sender string").write.parquet(
        str(tmp_path / "payments.parquet")
    )
    assert load_parquet(spark, str(tmp_path), ["payments"])["payments"].count() == 1


def test_catalog_tables_are_found_by_the_callers_names(spark):
    spark.createDataFrame([("1", "+2")], "id string, sender string").createOrReplaceTempView("paid_in")
    found = load_warehouse(spark, {"payments": "paid_in"}, ["payments"])
    assert [tuple(r) for r in found["payments"].collect()] == [("1", "+2")]
    with pytest.raises(ValueError, match="persons"):
        load_warehouse(spark, {"payments": "paid_in"}, ["payments", "persons"])


def test_zoned_timestamps_need_a_session_in_utc(spark):
    name = next(n for n, ddl in SCHEMAS.items() if "timestamp" in ddl)
    ddl = SCHEMAS[name].replace("timestamp_ntz", "timestamp")
    raw = spark.createDataFrame([], ddl)
    assert conform(raw, name).columns
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Africa/Lusaka")
    try:
        with pytest.raises(ValueError, match="UTC"):
            conform(raw, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
