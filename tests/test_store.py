"""Stores and batch folders: whole batches only, replays, compaction beside a stream."""

import os

import pytest
from pyspark.sql import functions as F

from clickflow import schemas
from clickflow.sinks import Store, docs_store, upsert_docs, write_batch
from clickflow.streaming import apps
from clickflow.streaming.run import drain
from conftest import rows

SCHEMA = "id long, dt string"


def batch(spark, *ids):
    return spark.createDataFrame([(i, f"d{i % 3}") for i in ids], SCHEMA)


@pytest.mark.parametrize("partition", [None, "dt"])
def test_batches_replays_and_compaction(spark, scratch, partition):
    s = Store(spark, scratch, SCHEMA, partition)
    assert s.read().count() == 0 and s.compact() == 0
    assert s.append(batch(spark, 1, 2), 0) and s.append(batch(spark, 3), 1)
    assert s.append(batch(spark), 2)                       # an empty batch counts too
    assert not s.append(batch(spark, 3), 1)
    assert rows(s.read(), ["id", "batch_id"]) == [(1, 0), (2, 0), (3, 1)]
    assert rows(s.read(before=1), ["id"]) == [(1,), (2,)]
    before = s.read()                                      # planned, not read yet
    assert s.compact() == 1 and s.compact() == 1
    assert not s.append(batch(spark, 3), 1) and not s.append(batch(spark), 2)
    s.append(batch(spark, 4), 3)
    assert rows(before, ["id"]) == [(1,), (2,), (3,)]      # a reader of the old version
    assert rows(s.read(), ["id", "batch_id"]) == [(1, 0), (2, 0), (3, 1), (4, 3)]
    assert rows(s.read(before=1), ["id"]) == [(1,), (2,)]
    if partition:
        only = s.read(values=["d1"])
        assert rows(only, ["id"]) == [(1,), (4,)]
        assert all("dt=d1" in f for f in only.inputFiles())
        assert s.read(values=["nowhere"]).count() == 0 and s.read(values=[]).count() == 0


def test_a_half_written_batch_is_not_read(spark, scratch):
    s = Store(spark, scratch, SCHEMA, "dt")
    s.append(batch(spark, 1), 0)
    # a crash after some files of batch 1
    (batch(spark, 2).withColumn("batch_id", F.lit(1).cast("long")).write.mode("append")
     .partitionBy("dt", "batch_id").parquet(f"{scratch}/gen=0"))
    assert rows(s.read(), ["id"]) == [(1,)]
    s.compact()
    assert rows(s.read(), ["id"]) == [(1,)]
    s.append(batch(spark, 2, 4), 1)
    assert rows(s.read(), ["id"]) == [(1,), (2,), (4,)]


def test_reader_between_the_base_and_its_pointer(spark, scratch, monkeypatch):
    s = Store(spark, scratch, SCHEMA)
    s.append(batch(spark, 1, 2), 0)
    seen = []
    put = s._put

    def look_first(name, text):
        seen.append(rows(Store(spark, scratch, SCHEMA).read(), ["id"]))
        s2 = Store(spark, scratch, SCHEMA)
        s2.append(batch(spark, 9), 7)                      # the stream goes on meanwhile
        put(name, text)

    monkeypatch.setattr(s, "_put", look_first)
    s.compact()
    monkeypatch.undo()
    assert seen == [[(1,), (2,)]]
    assert rows(s.read(), ["id"]) == [(1,), (2,), (9,)]
    s.compact()
    assert rows(s.read(), ["id"]) == [(1,), (2,), (9,)]


def test_a_writer_overtaken_by_two_compactions(spark, scratch, monkeypatch):
    s = Store(spark, scratch, SCHEMA)
    s.append(batch(spark, 1), 0)
    slow, old = Store(spark, scratch, SCHEMA), s.version()
    for i in (1, 2):
        s.compact()
        s.append(batch(spark, 10 + i), i)
    assert s.version()[0] == 2
    real, calls = slow.version, []
    monkeypatch.setattr(slow, "version", lambda: (calls.append(1), old if len(calls) == 1 else real())[1])
    slow.append(batch(spark, 5), 3)
    assert {r.id for r in s.read().collect()} == {1, 5, 11, 12} and s.read().count() == 4


def test_listing_stays_bounded(spark, scratch):
    """200 micro-batches with a compaction every 20."""
    s = Store(spark, scratch, SCHEMA)
    listed = []
    for n in range(200):
        s.append(spark.range(n, n + 1).select("id", F.lit("d").alias("dt")), n)
        if n % 20 == 19:
            s.compact()
        if n % 20 in (18, 19):
            listed.append(len({os.path.dirname(f) for f in s.read().inputFiles()}))
    assert max(listed) <= 45
    assert s.read().count() == 200 and len(s.folders()) <= 3


def test_documents_are_compacted_beside_the_stream(spark, scratch):
    schema = "id string, dt string, hr string"
    b = [[("a", "1", "0"), ("b", "1", "0")], [("b", "1", "9"), ("c", "2", "0")], [("a", "1", "5"), ("d", "2", "1")]]
    for i, x in enumerate(b):
        df = spark.createDataFrame(x, schema)
        upsert_docs(df, scratch, i)
        docs_store(spark, scratch, df.schema).compact()
        upsert_docs(df, scratch, i)                        # a replay of the compacted batch
    got = docs_store(spark, scratch, df.schema).read()
    assert rows(got, ["id", "dt", "hr"]) == [("a", "1", "0"), ("b", "1", "0"), ("c", "2", "0"), ("d", "2", "1")]


def test_a_replayed_batch_is_counted_once(spark, scratch):
    """A stream over a folder of batches: written, counted, written again as
    after a crash, counted."""
    clicks = spark.createDataFrame([(1, 1, "P", "C", 1_000, 1), (2, 1, "P", "C", 1_001, 2)], schemas.AD_CLICK)
    last = spark.createDataFrame([(0, 0, "Z", "Z", 4_102_444_800, 3)], schemas.AD_CLICK)

    def count():
        drain(apps.ad_province_app(spark, scratch, trigger="availableNow", name="replayed_clicks"))

    write_batch(clicks, f"{scratch}/passed", 0)
    count()
    write_batch(clicks, f"{scratch}/passed", 0)
    count()
    write_batch(last, f"{scratch}/passed", 1)
    count()
    got = spark.read.parquet(f"{scratch}/by_province").where("province = 'P'")
    assert {r["count"] for r in got.collect()} == {2}


def test_a_failed_write_leaves_no_batch(spark, scratch):
    bad = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise("x").alias("v"))
    with pytest.raises(Exception):
        write_batch(bad, scratch, 0)
    assert not os.path.exists(f"{scratch}/batch_id=0")
    write_batch(spark.range(3), scratch, 0)
    assert spark.read.parquet(scratch).count() == 3
