"""Wide results whose joins carry keys and numbers only."""

import re

import pytest

from larkspur.registry import callables

MEDIUM = "/root/testdata/sf0.01"
LATE = "order_item_id order_detail_id e_mail phone_number net_amount subtotal truck_brand_name primary_city order_tax_amount last_name".split()


def exchanged(df) -> list[str]:
    """The columns each exchange of rows of the large tables takes in."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)
    return [re.sub(r"#\d+L?", "", columns) for columns in found]


@pytest.fixture
def sorted_joins(spark):
    """Large tables are shuffled, as they are at size; the smallest are broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "20KB")
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("name", ["orders_wide", "join_star_wide", "fact_sales"])
def test_derived_columns_are_not_shuffled(spark, sorted_joins, name):
    inputs = exchanged(callables()[name](spark, MEDIUM))
    assert any("order_id" in columns for columns in inputs)
    assert not [c for columns in inputs for c in columns.split(", ") if c in LATE]
