"""Registered queries against their SQL, and all of them on the smallest tables."""

import pytest

from delayscope.llm import queries
from verification.check import connect, difference


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, small, name):
    assert difference(queries.QUERIES[name](spark, small), connect(small), queries.SQL[name]) is None


def test_every_document_has_its_row(spark, small):
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    for name in ("op1_exact_dedup", "op6_near_dedup", "op7_substring_dedup"):
        found = queries.QUERIES[name](spark, small)
        assert found.select("doc_id").distinct().count() == found.count() == n


def test_chats_of_the_table_and_the_added_one(spark, small):
    found = queries.QUERIES["op10_chat_format"](spark, small)
    conversations = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id").distinct().count()
    assert found.count() == conversations + 1
    (added,) = found.filter("conv_id = -7").collect()
    assert (added["n_turns"], added["loss_chars"]) == (2, len(queries.CONTROL_TEXT))
