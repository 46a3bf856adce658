from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.values import (bitmap_table_name, camel_name, check_date, date_token, epoch_millis, rule_key, rule_value,
                                       spark_type, to_tag_type, value_key, wide_table_name)
from tagweave.operators.tag import bind_date


def test_value_types():
    assert spark_type("1") == T.LongType()
    assert spark_type("2") == T.DecimalType(16, 2)
    assert spark_type("3") == T.StringType()
    assert spark_type("4") == T.StringType()
    with pytest.raises(ValueError):
        spark_type("9")
    assert bitmap_table_name("4") == "user_tag_value_date"
    with pytest.raises(ValueError):
        bitmap_table_name("0")


def test_date_tokens():
    assert date_token("2021-07-01") == "20210701"
    assert wide_table_name("2021-07-01") == "up_tag_merge_20210701"


def test_bind_date_both_forms_and_prefix():
    sql = "a < '$dt' and b < '${dt}' and c = '$dt_end'"
    assert bind_date(sql, "2000-01-01") == "a < '2000-01-01' and b < '2000-01-01' and c = '2000-01-01_end'"
    with pytest.raises(ValueError):
        bind_date("x", "2000-01-01' or 1=1 --")


def test_camel_name():
    assert camel_name("tag_code") == "tagCode"
    assert camel_name("c_custkey") == "cCustkey"
    assert camel_name("TAG_VALUE_TYPE") == "tagValueType"
    assert camel_name("id") == "id"


def test_rule_value_rounds_and_rejects(spark):
    df = spark.createDataFrame([("1.237", "1.235", "35", "M", None)], "a string, b string, n string, s string, z string")
    row = df.select(rule_value(F.col("a"), "2").alias("d"), rule_value(F.col("b"), "2").alias("e"),
                    rule_value(F.col("n"), "1").alias("n"), rule_value(F.col("s"), "3").alias("s"),
                    rule_value(F.col("z"), "1").alias("z")).first()
    assert row.d == Decimal("1.24") and row.e == Decimal("1.24")
    assert row.n == 35 and row.s == "M" and row.z is None
    for text, code in (("12345678901234567.00", "2"), ("abc", "1"), ("1_000", "1"), ("1.5", "1")):
        bad = spark.createDataFrame([(text,)], "v string").select(rule_value(F.col("v"), code))
        with pytest.raises(Exception, match="not a number"):
            bad.collect()


def test_to_tag_type_rules(spark):
    df = spark.createDataFrame([(1.237,), (None,)], "v double")
    out = df.select(to_tag_type(F.col("v"), T.DoubleType(), "2").alias("x")).collect()
    assert [r.x for r in out] == [Decimal("1.24"), None]
    big = spark.createDataFrame([(1e20,)], "v double")
    with pytest.raises(Exception, match="out of range"):
        big.select(to_tag_type(F.col("v"), T.DoubleType(), "2")).collect()
    with pytest.raises(TypeError):
        to_tag_type(F.col("v"), T.StringType(), "1")
    # anything -> string, dates to yyyy-MM-dd
    d = spark.sql("select timestamp_ntz'2020-03-04 10:00:00' as t")
    assert d.select(to_tag_type(F.col("t"), d.schema["t"].dataType, "4")).first()[0] == "2020-03-04"


def test_rule_key_converts_rule_side(spark):
    df = spark.createDataFrame([(0,), (1,)], "q int")
    hits = df.filter(F.col("q") == rule_key("0", T.IntegerType())).count()
    bad = df.filter(F.col("q") == rule_key("zero", T.IntegerType())).count()
    assert hits == 1 and bad == 0


def test_epoch_millis_second_precision(spark):
    df = spark.sql("select timestamp_ntz'1970-01-01 00:00:01.750' as t")
    assert df.select(epoch_millis("t")).first()[0] == 1000


def test_rules_compare_in_a_wide_type(spark):
    whole = spark.createDataFrame([(1,), (2,)], "q bigint")
    assert whole.filter(value_key(F.col("q"), T.LongType()) == rule_key("1.0", T.LongType())).count() == 1
    assert whole.filter(value_key(F.col("q"), T.LongType()) == rule_key("1.7", T.LongType())).count() == 0
    money = T.DecimalType(10, 2)
    cents = spark.createDataFrame([(Decimal("1.00"),)], T.StructType([T.StructField("q", money)]))
    assert cents.filter(value_key(F.col("q"), money) == rule_key("1.004", money)).count() == 0
    assert cents.filter(value_key(F.col("q"), money) == rule_key("1", money)).count() == 1


def test_epoch_millis_of_an_instant_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        row = spark.sql("select timestamp'1970-01-01 00:00:00Z' as t, timestamp_ntz'1970-01-01 00:00:01' as n").select(
            epoch_millis("t").alias("t"), epoch_millis("n").alias("n")).first()
        assert row.t == 0 and row.n == 1000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_check_date():
    assert check_date("2000-01-01") == "2000-01-01"
    for bad in ("20000101", "2000-01-01\n", "2000-1-1", "", None):
        with pytest.raises(ValueError):
            check_date(bad)
