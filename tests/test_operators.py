"""Clean rules, de-duplication, keys, upsert, marks: property-style checks."""

import datetime as dt
import random

from pyspark.sql import functions as F

from strata import spec
from strata.operators import clean as C
from strata.operators import dedup as D
from strata.operators import incremental as I
from strata.operators import keys as K
from strata.operators.upsert import delete_all, delete_where, upsert, upsert_columns
from strata.operators.window import rolling_mean, rolling_mean_window


def rows(df, order=None):
    return sorted(tuple(r) for r in df.collect())


def test_rule_order_matters_and_compiles_to_one_filter(spark):
    df = spark.createDataFrame([(0.001,), (0.006,), (None,)], "p double")
    out = C.apply_rules(df, [C.NotNull(("p",)), C.Round("p", 2), C.Positive(("p",))])
    assert rows(out) == [(0.01,)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") == 1


def test_clean_rules_idempotent(spark):
    df = spark.createDataFrame([(" us/eastern ", " ibm ", 1.005)], "tz string, sym string, p double")
    rules = [C.Initcap("tz"), C.Upper("sym"), C.Round("p", 2), C.Positive(("p",))]
    once = C.apply_rules(df, rules)
    twice = C.apply_rules(once, rules)
    assert rows(once) == rows(twice) == [("Us/eastern", "IBM", 1.01)]


def test_filter_positive_null_fails_and_empty_is_noop(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "c int")
    assert rows(C.filter_positive(df, "c")) == [(1,)]
    assert C.filter_positive(df) is df


def test_dedup_latest_matches_window_form_with_ties_and_nulls(spark):
    random.seed(7)
    data = [(random.randint(0, 5), random.choice([None, 1, 2, 3]), random.randint(0, 3)) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, ts int, v int")
    a = D.dedup_latest(df, ["k"], ["ts"])
    b = D.dedup_latest_window(df, ["k"], "ts")
    assert rows(a) == rows(b)
    # NULL order value loses against any non-NULL one
    assert all(r.ts is not None for r in a.collect())


def test_dedup_latest_is_partial_aggregate(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"), F.lit("x").alias("v"))
    plan = D.dedup_latest(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_dup_key_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    assert rows(D.dup_key_report(df, ["a", "b"])) == [(1, 1, 2)]


def test_hash_key_null_differs_from_empty(spark):
    df = spark.createDataFrame([("FFR", None), ("FFR", "")], "code string, name string")
    keys = [r.k for r in df.select(K.hash_key_expr(["code", "name"]).alias("k")).collect()]
    assert len(set(keys)) == 2


def test_numeric_keys_unique_across_batches(spark):
    a = K.with_numeric_key(spark.range(100).repartition(4), "sk")
    b = K.with_numeric_key(spark.range(100).repartition(3), "sk", K.next_key_start(a, "sk"))
    both = a.unionByName(b)
    assert both.select("sk").distinct().count() == 200


def test_upsert_semantics_idempotence_and_null_keys(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, None, 20), (3, "c", 30)], "k int, n string, v int")
    s = spark.createDataFrame([(2, None, 21), (4, "d", 40), (4, "d", 41)], "k int, n string, v int")
    once = upsert(t, s, ["k", "n"], newest="v")
    assert rows(once) == [(1, "a", 10), (2, None, 21), (3, "c", 30), (4, "d", 41)]
    assert rows(upsert(once, s, ["k", "n"], newest="v")) == rows(once)
    # reference '=' semantics: the NULL key part never matches -> duplicate
    strict = upsert(t, s, ["k", "n"], null_safe=False, newest="v")
    assert strict.filter("k = 2").count() == 2
    # initial load (no table yet)
    assert rows(upsert(None, s, ["k", "n"], newest="v")) == [(2, None, 21), (4, "d", 41)]


def test_upsert_disjoint_batches_commute(spark):
    t = spark.createDataFrame([(1, 0)], "k int, v int")
    a = spark.createDataFrame([(2, 1)], "k int, v int")
    b = spark.createDataFrame([(3, 2), (1, 5)], "k int, v int")
    assert rows(upsert(upsert(t, a, ["k"]), b, ["k"])) == rows(upsert(upsert(t, b, ["k"]), a, ["k"]))


def test_upsert_columns_updates_only_listed(spark):
    led = spark.createDataFrame([("f1", dt.datetime(2024, 1, 1), "keep")], "filename string, processed_time timestamp, note string")
    upd = spark.createDataFrame([("f1", dt.datetime(2024, 2, 1), "new"), ("f2", dt.datetime(2024, 2, 1), "ins")],
                                "filename string, processed_time timestamp, note string")
    out = {r.filename: r for r in upsert_columns(led, upd, ["filename"], ["processed_time"]).collect()}
    assert out["f1"].processed_time == dt.datetime(2024, 2, 1) and out["f1"].note == "keep"
    assert out["f2"].note == "ins"


def test_delete_where_keeps_null_predicate_rows(spark):
    df = spark.createDataFrame([("R",), ("A",), (None,)], "f string")
    assert {r.f for r in delete_where(df, F.col("f") == "R").collect()} == {"A", None}
    assert delete_all(df).count() == 0 and delete_all(df).columns == ["f"]


def test_marks_commit_skip_null_and_reset(spark):
    marks = I.commit_marks(I.empty_marks(spark), "gold", {"ffr": dt.datetime(2024, 1, 2), "inflation": None})
    assert I.mark_value(marks, "gold", "ffr") == dt.datetime(2024, 1, 2)
    assert I.mark_value(marks, "gold", "inflation") == I.DEFAULT_MARK  # X10: untouched
    marks = I.commit_marks(marks, "gold", {"ffr": dt.datetime(2024, 1, 3)})
    assert marks.count() == 1 and I.mark_value(marks, "gold", "ffr") == dt.datetime(2024, 1, 3)
    assert I.reset_mark(marks, "gold").count() == 0


def test_mark_boundary_inclusive_vs_exclusive(spark):
    m = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (m,), (dt.datetime(2024, 1, 3),)], "ts timestamp")
    assert I.incremental(df, "ts", m, True).count() == 2
    assert I.incremental(df, "ts", m, False).count() == 1


def test_unprocessed_files_null_time_counts_as_unprocessed(spark):
    cand = spark.createDataFrame([("a",), ("b",), ("c",)], "filename string")
    led = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", None)], "filename string, processed_time timestamp")
    assert rows(I.unprocessed_files(cand, led)) == [("b",), ("c",)]


def test_rolling_mean_chunked_equals_plain_window_on_hot_key(spark):
    random.seed(3)
    start = dt.date(2020, 1, 1)
    data = [("HOT", start + dt.timedelta(days=i), float(random.randint(1, 100))) for i in range(700)]
    data += [("COLD", start + dt.timedelta(days=i), float(i)) for i in range(0, 60, 3)]
    df = spark.createDataFrame(data, "symbol string, date date, close double")
    for n in (1, 5, 40):
        chunked = rolling_mean(df, ["symbol"], ["date"], "close", n, "sma", chunk_rows=50)
        plain = rolling_mean_window(df, ["symbol"], "date", "close", n, "sma")
        a = {(r.symbol, r.date): r.sma for r in chunked.collect()}
        b = {(r.symbol, r.date): r.sma for r in plain.collect()}
        assert a.keys() == b.keys()
        assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_entity_specs_keys_are_in_contracts():
    for e in spec.ENTITIES.values():
        names = {f.name for f in e.contract.fields}
        assert set(e.keys) <= names


def test_rolling_mean_keeps_rows_with_a_null_order(spark):
    from strata.operators.window import rolling_mean, rolling_mean_window

    rows = [("a", None, 1.0), ("a", dt.datetime(2024, 1, 1), 2.0), ("a", dt.datetime(2024, 2, 1), 4.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    one = rolling_mean(df, ["k"], ["t"], "v", 2, "m", full_only=False)
    two = rolling_mean_window(df, ["k"], "t", "v", 2, "m", full_only=False)
    assert sorted((r.v, r.m) for r in one.collect()) == sorted((r.v, r.m) for r in two.collect()) == [(1.0, 1.0), (2.0, 1.5), (4.0, 3.0)]
