"""Findings of round 3: all labelled rows are learned from, and upserts,
deletes and landing files grow no faster than their input."""

import os
import uuid
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.sources import tables as TB


def stored(spark, stem):
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_r3")
    return f"strata_r3.{stem}_{uuid.uuid4().hex[:8]}"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def never(*_, **__):
    raise AssertionError("not needed")


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """a word that only a few, very long or late texts hold is learned."""
    from strata.llm import toxicity

    rng = np.random.default_rng(8)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    texts, y = [], []
    for i in range(900):
        ws = list(rng.choice(vocabulary, int(rng.integers(5, 40))))
        if i % 4 == 0:
            ws.insert(int(rng.integers(0, len(ws))), "zorkle")
        texts.append(" ".join(ws))
        y.append(int(i % 4 == 0))
    for i in range(900, 960):
        texts.append("vexing " + " ".join(rng.choice(vocabulary, 3200)))
        y.append(1)
    assert min(len(t) for t in texts[900:]) > 20_000
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    held = [i for i in range(960) if zlib.crc32(str(i).encode()) % 3 == 1]
    trained = []
    for shard in (toxicity.SHARD_ROWS, 150):
        monkeypatch.setattr(toxicity, "SHARD_ROWS", shard)
        got = {r["doc_id"]: r for r in toxicity.report(docs, labels).collect()}
        assert np.mean([got[i]["predicted"] == y[i] for i in held]) > 0.97
        assert np.mean([got[i]["predicted"] for i in held if i >= 900]) > 0.9
        trained.append({i: r["score"] for i, r in got.items()})
    assert trained[1] == {r["doc_id"]: r["score"] for r in toxicity.report(docs, labels).collect()}


def test_buckets_are_bounded(spark, monkeypatch):
    """the number of folders does not grow with the table for ever."""
    assert TB.buckets_for(10**9, 10) <= 1024
    monkeypatch.setattr(TB, "MAX_BUCKETS", 8)
    name = stored(spark, "bounded")
    make = lambda n, v: spark.range(n).selectExpr("id AS k", f"{v} AS v")
    for n, v in ((300, 0), (500, 1)):
        TB.upsert_table(spark, name, make(n, v), ["k"], bucket_rows=5)
        assert TB._Layout(spark, name).buckets == 8
    assert rows(spark.table(name), "k", "v") == rows(make(500, 1), "k", "v")


@pytest.mark.parametrize("null_safe", [True, False])
def test_a_bucketed_upsert_shuffles_rows_once(spark, monkeypatch, null_safe):
    """no second shuffle for the write, the same rows."""
    name = stored(spark, "once")
    make = lambda *r: spark.createDataFrame(list(r), "k int, s string, v int")
    first = [(i, None if i % 3 else "x", 0) for i in range(300)]
    TB.upsert_table(spark, name, make(*first), ["k", "s"], bucket_rows=20)
    TB.append_table(spark, name, make((6, "x", 9)))  # a key stored twice
    monkeypatch.setattr(TB, "_rebalanced", never)
    TB.upsert_table(spark, name, make((4, None, 1), (6, "x", 1), (999, "y", 1)), ["k", "s"], bucket_rows=500, null_safe=null_safe)
    want = [r for r in first if r[:2] != (6, "x") and (r[:2] != (4, None) or not null_safe)] + [(4, None, 1), (6, "x", 1), (999, "y", 1)]
    assert rows(spark.table(name), "k", "s", "v") == sorted(want, key=str)


def test_deletes_and_moves_write_rows_once(spark, monkeypatch):
    """no staged copy of the touched partitions."""
    monkeypatch.setattr(TB, "write_snapshot", never)
    name = stored(spark, "moves")
    make = lambda *r: spark.createDataFrame(list(r), "k int, p string, v int")
    TB.upsert_table(spark, name, make((1, "a", 0), (2, "b", 0), (3, None, 0), (4, "b", 0), (5, "it's", 0)), ["k"], ["p"])
    TB.upsert_table(spark, name, make((1, "b", 1), (3, "c", 1)), ["k"])
    assert rows(spark.table(name), "k", "p", "v") == [(1, "b", 1), (2, "b", 0), (3, "c", 1), (4, "b", 0), (5, "it's", 0)]
    assert len(spark.sql(f"SHOW PARTITIONS {TB._generation(spark, name)}").collect()) == 3
    TB.delete_where_table(spark, name, (F.col("p") == "it's") | (F.col("k") == 4) | (F.col("v") > F.lit(None).cast("int")))
    assert rows(spark.table(name), "k") == [(1,), (2,), (3,)]
    TB.delete_where_table(spark, name, "v >= 0")
    assert spark.table(name).count() == 0
    TB.upsert_table(spark, name, make((1, None, 2)), ["k"])
    assert rows(spark.table(name), "k", "p", "v") == [(1, None, 2)]


def test_landing_files_are_compressed(spark, tmp_dir):
    """Repetitive JSON lines are not written plain."""
    from strata.plans import analogs as A

    docs = spark.createDataFrame([("one", '{"a": "1"}'), ("two", '{"a": "2"}')], "object string, doc string")
    path = A.write_landing(docs, os.path.join(tmp_dir, "land"))
    files = [f for _, _, fs in os.walk(path) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert rows(spark.read.option("recursiveFileLookup", "true").text(path), "value") == [('{"a": "1"}',), ('{"a": "2"}',)]
