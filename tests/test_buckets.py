"""Merging change logs into a bucketed table."""

from __future__ import annotations

import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketlens.operators import changes
from basketlens.sinks.buckets import BucketTable

LOG = "id INT, name STRING, n STRING, __lsn BIGINT, __deleted BOOLEAN, extra STRING"
TABLE = "id BIGINT, name STRING, n INT"


def log(spark, *events):
    return spark.createDataFrame([(i, name, n, lsn, gone, "x") for i, name, n, lsn, gone in events], LOG)


def files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    start = spark.createDataFrame([(i, f"old {i}", i) for i in range(100)], TABLE)
    return BucketTable.create(start, str(tmp_path / "t"), ["id"], 16)


def test_changed_rows_are_replaced_and_others_stay(spark, table):
    done = table.merge(log(spark, (3, "new", "33", 5, False), (3, "older", "1", 4, False), (7, None, None, 6, True), (500, "added", "5", 7, False),
                           (None, "no key", "1", 8, False), (8, "bad number", "eight", 9, False)))
    assert 1 <= len(done.touched) <= 4 and done.version == 1
    want = [(i, f"old {i}", i) for i in range(100) if i not in (3, 7, 8)] + [(3, "new", 33), (8, "bad number", None), (500, "added", 5)]
    assert rows(BucketTable(spark, table.path).read()) == rows(table.read()) == sorted(want, key=repr)
    assert table.read().schema.simpleString() == "struct<id:bigint,name:string,n:int>"


def test_untouched_buckets_are_not_read_or_written(spark, table, monkeypatch):
    before = files(table.path)
    read = []
    plainly = BucketTable._rows

    def watched(self, only=None):
        df = plainly(self, only)
        read.extend(df.inputFiles())
        return df

    monkeypatch.setattr(BucketTable, "_rows", watched)
    done = table.merge(log(spark, (3, "new", "33", 5, False), (3, "newer", "34", 6, False)))
    assert len(done.touched) == 1
    assert read and all(f"bucket={done.touched[0]}/" in f for f in read)
    after = files(table.path)
    assert {f: after[f] for f in before} == before
    assert all(f"version=1/bucket={done.touched[0]}/" in f for f in set(after) - set(before))


def test_a_failed_merge_keeps_the_table(spark, table, monkeypatch):
    whole = rows(table.read())
    broken = log(spark, *[(i, "new", "1", 5, False) for i in range(50)]).withColumn(
        "name", F.when(F.col("id") == 49, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        table.merge(broken)
    assert rows(BucketTable(spark, table.path).read()) == whole
    # Also when all rows are written, but the commit is not.
    saved, spark_frame = [], type(spark).createDataFrame

    def fail(self, data, schema=None, **more):
        if isinstance(schema, str) and schema.startswith("bucket INT"):
            saved.append(data)
            raise RuntimeError("no commit")
        return spark_frame(self, data, schema, **more)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", fail)
        with pytest.raises(RuntimeError, match="no commit"):
            table.merge(log(spark, (1, "new", "1", 5, False), (2, "x", "1", 6, True)))
    again = BucketTable(spark, table.path)
    assert saved and again.version == 0 and rows(again.read()) == whole
    assert again.merge(log(spark, (4, "next", "4", 7, False))).version == 1  # what the failed merge left is not taken in
    assert rows(again.read()) == sorted([r for r in whole if r[0] != 4] + [(4, "next", 4)], key=repr)


def test_repeated_and_older_logs(spark, table):
    new = log(spark, (3, "new", "1", 10, False), (5, None, None, 11, True))
    table.merge(new)
    once = rows(table.read())
    table.merge(new)
    table.merge(log(spark, (3, "older", "0", 9, False)))
    assert rows(table.read()) == once


def test_buckets_that_empty_and_fill(spark, table):
    table.merge(log(spark, *[(i, None, None, i, True) for i in range(100)]))
    assert table.read().count() == 0 and rows(BucketTable(spark, table.path).read()) == []
    assert table.merge(log(spark, (None, "x", "1", 1, False))).touched == ()
    table.merge(log(spark, (5, "back", "5", 200, False)))
    assert rows(table.read()) == [(5, "back", 5)]
    gone = table.drop_unused(lambda folder: None)
    assert gone and not any(f"version={table.held[b]}/bucket={b}" in f for b in table.held for f in gone)
    empty = BucketTable.create(spark.createDataFrame([], TABLE), f"{table.path}-2", ["id"], 4)
    assert empty.read().count() == 0
    empty.merge(log(spark, (1, "a", "1", 1, False)))
    assert rows(empty.read()) == [(1, "a", 1)]
    with pytest.raises(FileExistsError):
        BucketTable.create(spark.createDataFrame([], TABLE), f"{table.path}-2", ["id"], 4)
    with pytest.raises(FileNotFoundError):
        BucketTable(spark, f"{table.path}-3")


def test_rows_of_some_keys_come_from_their_buckets(spark, table):
    found = table.of_keys(spark.createDataFrame([(3,), (3,), (1000,)], "id INT"))
    assert rows(found) == [(3, "old 3", 3)]
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}) <= 2


def test_many_merges_equal_one_replay(spark, tmp_path):
    r = random.Random(4)
    start = spark.createDataFrame([(a, b, "s") for a in range(6) for b in range(5)] + [(None, 1, "no key"), (None, 1, "no key")], "a INT, b INT, v STRING")
    events = [(r.randrange(9), r.randrange(6), f"v{k}", k, r.random() < 0.3) for k in range(90)]
    table = BucketTable.create(start, str(tmp_path / "t"), ["a", "b"], 5)
    schema = "a INT, b INT, v STRING, __lsn BIGINT, __deleted BOOLEAN"
    for k in range(0, 90, 30):
        table.merge(spark.createDataFrame(events[k : k + 30], schema))
    keyed = start.where("a IS NOT NULL")
    want = changes.apply_changes(keyed, spark.createDataFrame(events, schema), ["a", "b"]).unionByName(start.where("a IS NULL"))
    assert rows(table.read()) == rows(want)


def test_a_stream_keeps_a_table(spark, tmp_path):
    import json

    from basketlens.schemas import TABLES
    from basketlens.streaming import apps

    columns = [f for f in TABLES["customers"].fields if f.name in ("customer_id", "first_name")]
    start = spark.createDataFrame([(1, "Ida"), (2, "Bo")], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns))
    BucketTable.create(start, str(tmp_path / "t"), ["customer_id"], 4)
    (tmp_path / "topic").mkdir()
    for k, (op, key, name) in enumerate((("u", 1, "Ada"), ("c", 3, "Cy"), ("d", 2, None))):
        payload = {"customer_id": key, "first_name": name, "__op": op, "__table": "customers", "__lsn": k, "__deleted": str(op == "d").lower()}
        (tmp_path / "topic" / f"{k}.txt").write_text(json.dumps({"payload": payload}) + "\n")
    messages = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "topic"))
    apps.keep_table(messages, "customers", str(tmp_path / "t"), str(tmp_path / "check")).awaitTermination()
    assert rows(BucketTable(spark, str(tmp_path / "t")).read()) == [(1, "Ada"), (3, "Cy")]
