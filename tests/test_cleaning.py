from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakemarts.operators import cleaning
from lakemarts.operators.dedup import dedup_by_hash, dedup_by_key

EMPTY_DIGEST = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def values(df):
    return [tuple(row) for row in df.collect()]


def test_names_are_stripped_and_lowered(spark):
    df = spark.createDataFrame([(1, "x")], "` Customer_ID\t` int, `EMAIL` string")
    assert cleaning.clean_names(df).columns == ["customer_id", "email"]


def test_names_with_dots_survive(spark):
    df = spark.createDataFrame([(" x ", " y ")], "`A.b` string, `c``d` string")
    assert values(cleaning.clean_columns(df)) == [("x", "y")]


def test_colliding_names_fail_early(spark):
    df = spark.createDataFrame([(1, 2)], "`a` int, ` A` int")
    with pytest.raises(ValueError, match="collide.*'a'"):
        cleaning.clean_names(df)


def test_trim_takes_spaces_only(spark):
    df = spark.createDataFrame([("  Bob   ", 1), ("\tBob", 2), (None, 3)], "name string, n int")
    assert values(cleaning.trim_strings(df)) == [("Bob", 1), ("\tBob", 2), (None, 3)]


def test_personal_columns_by_part_of_name(spark):
    df = spark.createDataFrame(
        [],
        "email_opt_in string, businessname string, merchant_name string,"
        "card_number_masked string, date_of_birth date",
    )
    assert cleaning.pii_columns(df) == ["email_opt_in", "businessname"]


def test_mask(spark):
    rows = [("",), (None,), ("Bob",), ("BOB",)]
    df = spark.createDataFrame(rows, "first_name string")
    blank, null, bob, upper = [r[0] for r in values(cleaning.mask_pii(df))]
    assert blank == EMPTY_DIGEST
    assert null is None
    assert bob == hashlib.sha256(b"Bob").hexdigest()
    assert upper == hashlib.sha256(b"BOB").hexdigest() != bob


def test_mask_with_salt(spark):
    df = spark.createDataFrame([("Bob",), (None,)], "first_name string")
    salted = values(cleaning.mask_pii(df, salt="pepper"))
    assert salted == [(hashlib.sha256(b"pepperBob").hexdigest(),), (None,)]


@pytest.mark.parametrize("kind", ["int", "boolean", "date", "double"])
def test_personal_column_that_is_no_text(spark, kind):
    df = spark.createDataFrame([], f"ssn {kind}")
    with pytest.raises(ValueError, match="ssn"):
        cleaning.clean_table(df)


def test_blank_becomes_null_after_trim(spark):
    df = spark.createDataFrame([("   ",), ("",), ("x",)], "city string")
    assert sorted(values(cleaning.clean_columns(df)), key=repr) == [("x",), (None,), (None,)]


def test_blank_personal_value_is_hashed_unless_told_otherwise(spark):
    df = spark.createDataFrame([("   ",)], "email string")
    assert values(cleaning.clean_columns(df)) == [(EMPTY_DIGEST,)]
    assert values(cleaning.clean_columns(df, blank_pii="null")) == [(None,)]
    with pytest.raises(ValueError, match="blank_pii"):
        cleaning.clean_columns(df, blank_pii="drop")


def test_dedup_equalities(spark):
    nan = float("nan")
    rows = [(None, None), (None, None), ("a", nan), ("a", nan), ("b", 0.0), ("b", -0.0)]
    assert cleaning.dedup_rows(spark.createDataFrame(rows, "k string, x double")).count() == 3


def test_dedup_after_trim(spark):
    df = spark.createDataFrame([("a ", 1), ("a", 1), ("a", 2)], "city string, n int")
    assert sorted(values(cleaning.clean_table(df))) == [("a", 1), ("a", 2)]


def test_cleaning_is_one_projection(spark):
    df = spark.createDataFrame([("a", "b", 1)], "email string, city string, n int")
    plan = cleaning.clean_columns(df)._jdf.queryExecution().analyzed().toString()
    # Renaming and cleaning; no projection per column.
    assert plan.count("Project") <= 2


# --- dedup by way of a key ----------------------------------------------------

COPIES = [
    (1, "a"), (1, "a "), (1, "b"), (2, "a"), (3, "x"), (3, "x"),
    (None, "n"), (None, "n"), (None, "m"), (4, None),
]


@pytest.mark.parametrize("limit, share", [(0, 1.0), (2, 1.0), (1_000_000, 0.1), (1_000_000, 1.0)])
def test_dedup_by_key_equals_dedup(spark, limit, share):
    df = spark.createDataFrame(COPIES, "id int, city string")
    quick = dedup_by_key(df, "id", cleaning.clean_columns, limit, share)
    assert sorted(values(quick), key=repr) == sorted(values(cleaning.clean_table(df)), key=repr)


def test_dedup_by_key_compares_only_repeated_keys(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id AS STRING) AS city")
    kept = dedup_by_key(df.union(df.where("id < 5")), "id", cleaning.clean_columns)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    assert kept.count() == 1000


def test_replayed_batch_is_found_by_its_block(spark):
    """More repeated keys than may be broadcast, but all in one run of keys."""
    batch = 1 << 16
    df = spark.range(20 * batch).selectExpr("id", "CAST(id % 9 AS STRING) AS city")
    replayed = df.union(df.where(f"id >= {3 * batch} AND id < {3 * batch} + 500"))
    kept = dedup_by_key(replayed, "id", cleaning.clean_columns, broadcast_keys=10)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "shiftright" in plan
    assert kept.count() == 20 * batch
    spread = df.union(df.where(f"id % {batch} = 7"))
    kept = dedup_by_key(spread, "id", cleaning.clean_columns, broadcast_keys=10)
    assert "LeftAnti" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() == 20 * batch


def test_blocks_of_negative_and_null_keys(spark):
    rows = [(-1, "a"), (-1, "a"), (-65_537, "b"), (None, "c"), (None, "c"), (0, "d"), (0, "d")]
    df = spark.createDataFrame(rows, "id int, city string")
    kept = dedup_by_key(df, "id", broadcast_keys=2, worth_splitting=1.0)
    assert sorted(values(kept), key=repr) == sorted(set(rows), key=repr)


def test_dedup_by_unique_key_shuffles_nothing(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id AS STRING) AS city")
    kept = dedup_by_key(df, "id", cleaning.clean_columns)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 1000


@pytest.mark.parametrize("limit, share", [(0, 1.0), (1_000_000, 0.1), (1_000_000, 1.0)])
def test_dedup_by_hash_equals_dedup(spark, limit, share):
    nan = float("nan")
    rows = [("a", 0.0), ("a", -0.0), ("b", nan), ("b", nan), (None, None), (None, None), ("c", 1.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    kept = dedup_by_hash(df, limit, share)
    assert kept.count() == cleaning.dedup_rows(df).count() == 5
    single = df.where("k = 'c' OR k IS NULL AND x = 1")
    assert sorted(values(dedup_by_hash(single)), key=repr) == sorted(values(single), key=repr)


def test_rows_of_repeated_keys_are_not_shuffled_whole(spark):
    """Every key occurs twice, no row does: hashes are counted, the rows stay where they are."""
    df = spark.range(2000).selectExpr("id % 1000 AS id", "cast(id AS string) AS city")
    kept = dedup_by_key(df, "id", cleaning.clean_columns)
    assert kept.count() == 2000
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_dedup_by_key_needs_an_integer(spark):
    with pytest.raises(ValueError, match="city"):
        dedup_by_key(spark.createDataFrame([("a",)], "city string"), "city")


CELL = st.one_of(st.none(), st.sampled_from(["", " ", "a", " a", "A", "b ", "\tb"]))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.integers(0, 4), CELL, CELL), min_size=1, max_size=15))
def test_clean_table_properties(spark, rows):
    df = spark.createDataFrame(rows, "id int, city string, country string")
    once = cleaning.clean_table(df)
    got = values(once)
    blank = {None, ""}
    expected = {
        (n, *[None if c is None or c.strip(" ") in blank else c.strip(" ") for c in cells])
        for n, *cells in rows
    }
    assert set(got) == expected and len(got) == len(expected)
    # Without personal columns, cleaning again changes nothing.
    assert sorted(values(cleaning.clean_table(once)), key=repr) == sorted(got, key=repr)
    quick = dedup_by_key(df, "id", cleaning.clean_columns, worth_splitting=1.0)
    assert sorted(values(quick), key=repr) == sorted(got, key=repr)
