import hashlib
import uuid

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmark.functions import (
    display_number,
    labelled,
    parse,
    safe_divide,
    stable_id63,
    stable_uuid5,
    surrogate_key,
    to_date,
    to_double,
    to_timestamp,
)

parts = st.lists(st.tuples(st.text(max_size=12), st.text(max_size=12)), min_size=1, max_size=20)
quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@given(parts)
@quick
def test_ids_equal_their_definitions(spark, pairs):
    frame = spark.createDataFrame(pairs, "a string, b string").select(
        "a",
        "b",
        stable_id63(F.col("a"), F.col("b")).alias("id"),
        stable_uuid5(F.col("a"), F.col("b")).alias("guid"),
    )
    for row in frame.collect():
        name = f"{row.a}::{row.b}"
        top = int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big") % 2**63
        assert row.id == (top or 1)
        assert row.guid == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def test_id_of_a_missing_part_is_null(spark):
    missing = F.lit(None).cast("string")
    assert one(spark, stable_id63(F.lit("a"), missing)) is None
    assert one(spark, stable_uuid5(missing, F.lit("a"))) is None
    with pytest.raises(ValueError):
        stable_id63()


def test_surrogate_key(spark):
    assert one(spark, surrogate_key(F.lit("EMEA"))) == hashlib.md5(b"EMEA").hexdigest()
    assert one(spark, surrogate_key(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_text_is_null_in_every_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = spark.range(1).select(
            to_double(F.lit("abc")).alias("a"),
            to_double(F.lit(" 1.5 ")).alias("b"),
            to_timestamp(F.lit("2026-13-01")).alias("c"),
            to_date(F.lit("2026-06-31")).alias("d"),
            safe_divide(F.lit(1.0), F.lit(0.0)).alias("e"),
            safe_divide(F.lit(None).cast("double"), F.lit(2.0)).alias("f"),
        )
        assert tuple(row.first()) == (None, 1.5, None, None, None, None)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_labels(spark):
    frame = spark.createDataFrame([("A",), ("Z",), (None,)], "c string")
    assert rows_of(frame.select(labelled(F.col("c"), {"A": "Alpha", "B": "Beta"}))) == [("Alpha",), ("Z",), (None,)]
    assert rows_of(frame.select(labelled(F.col("c"), {}))) == [("A",), ("Z",), (None,)]


def test_display(spark):
    assert one(spark, display_number(F.lit(1234567.5), "#,##0.00")) == "1,234,567.50"
    assert one(spark, display_number(F.lit(1234.0), "#,##0")) == "1,234"
    assert one(spark, display_number(F.lit(0.12345), "#,##0.000")) == "0.123"
    with pytest.raises(ValueError):
        display_number(F.lit(1), "0.0")


def test_parse_rejects_types_it_has_no_rule_for(spark):
    with pytest.raises(TypeError):
        parse(F.col("x"), T.StringType(), T.BinaryType())


def test_ids_that_different_parts_share(spark):
    from voltmark.functions import ambiguous_ids

    rows = [("a::b", "c"), ("a", "b::c"), ("a", "b::c"), ("x", "y"), ("x", "y"), (None, "z"), ("z", None), ("a", "b"), ("", "::"), ("::", "")]
    df = spark.createDataFrame(rows, "p string, q string").repartition(3)
    found = ambiguous_ids(df, ["p", "q"])
    assert sorted((tuple(r.first), tuple(r.second), r.cause) for r in found.collect()) == [
        (("", "::"), ("::", ""), "separator"),
        (("a", "b::c"), ("a::b", "c"), "separator"),
    ]
    # An id of four values has true collisions.
    crowded = ambiguous_ids(df, ["p", "q"], make=lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(1)))
    assert [r.cause for r in crowded.collect()] == ["hash"]
    assert ambiguous_ids(df.limit(0), ["p"]).collect() == []
