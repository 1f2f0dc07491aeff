"""The table of the jobs over many batches: bounded folders, pinned readers, several writers, failures."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from random import Random

import pytest
from pyspark.sql import functions as F, types as T

from tillstream.streaming import jobs, sinks, store
from tillstream.streaming.sinks import KeyedTable

SCHEMA = T.StructType([
    T.StructField("dt", T.StringType()), T.StructField("id", T.StringType()), T.StructField("v", T.LongType())])


@pytest.fixture
def table(tmp_path):
    return KeyedTable(str(tmp_path / "t"), ("id",), "dt", ("v",), fan=4, retain=0)


@pytest.fixture
def make(spark):
    return lambda data: spark.createDataFrame(data, SCHEMA).coalesce(1)


def found(df):
    return sorted(map(tuple, df.collect()))


def folders(spark, table):
    return [n for n in store.names(spark, table.path) if n.startswith("_folder=")]


@pytest.mark.parametrize("earliest", [False, True])
def test_many_batches_keep_a_bounded_number_of_folders(spark, table, make, earliest):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        table, rng, want, most = replace(table, earliest=earliest), Random(1), {}, 0
        for batch in range(70 if not earliest else 20):
            data = [(f"d{rng.randrange(3)}", f"k{k}", rng.randrange(1000)) for k in rng.sample(range(9), 2)]
            table.write_batch(make(data), batch)
            for dt, k, v in data:
                old = want.get((dt, k))
                want[dt, k] = min(v, old) if earliest and old is not None else v
            most = max(most, len(folders(spark, table)))
        assert found(table.read(spark, SCHEMA)) == sorted((*k, v) for k, v in want.items())
        records = table.version(spark)
        assert len(records) == len(folders(spark, table)) == len(store.names(spark, f"{table.path}/_log"))
        assert most <= 4 * 4 + 1 and max(r.level for r in records) >= (2 if earliest is False else 1)
        assert all(len(r.replaces) <= 4 * 4 for r in records)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_reader_sees_one_version_during_merges(spark, table, make):
    table = replace(table, retain=60)
    for batch in range(3):
        table.write_batch(make([("d", "a", batch), ("d", f"b{batch}", 0)]), batch)
    version = table.version(spark)
    before = table.read(spark, SCHEMA)
    for batch in range(3, 9):
        table.write_batch(make([("d", "a", 100 + batch)]), batch)
    want = [("d", "a", 2), ("d", "b0", 0), ("d", "b1", 0), ("d", "b2", 0)]
    assert found(before) == want and found(table.read(spark, SCHEMA, version=version)) == want
    assert ("d", "a", 108) in found(table.read(spark, SCHEMA))
    replace(table, retain=0).clean(spark)
    assert len(folders(spark, table)) == len(table.version(spark)) < 9


def test_writers_that_start_at_once_keep_their_rows(spark, table, make):
    table = replace(table, retain=60)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda w: [table.of_writer(f"w{w}").write_batch(make([("d", f"{w}-{b}", b)]), b) for b in range(5)], range(4)))
    assert found(table.read(spark, SCHEMA)) == sorted(("d", f"{w}-{b}", b) for w in range(4) for b in range(5))


def test_rows_become_visible_with_the_record(spark, table, make, monkeypatch):
    table.write_batch(make([("d", "a", 1)]), 0)
    with monkeypatch.context() as patch:
        patch.setattr(sinks.store, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.write_batch(make([("d", "a", 2), ("d", "x", 2)]), 1)
    assert found(table.read(spark, SCHEMA)) == [("d", "a", 1)]
    table.write_batch(make([("d", "a", 3)]), 1)
    table.write_batch(make([("d", "a", 4)]), 1)  # a replay of a finished batch
    assert found(table.read(spark, SCHEMA)) == [("d", "a", 3)]


def test_odd_partitions_and_empty_batches(spark, table, make):
    data = [("a b/c%", "k", 1), (None, "k", 2), ("", "k2", 3), ("x=y", None, 4)]
    table.write_batch(make(data[:2]), 0)
    table.write_batch(make([]), 1)
    table.write_batch(make(data[2:]), 2)
    table.write_batch(make([]), 3)  # the fourth folder: merged
    assert [r.level for r in table.version(spark)] == [1]
    assert {r[2] for r in found(table.read(spark, SCHEMA).select(F.coalesce("dt", F.lit("")), F.coalesce("id", F.lit("")), "v"))} == {1, 2, 3, 4}
    assert found(table.read(spark, SCHEMA, ["a b/c%"])) == [("a b/c%", "k", 1)]
    assert found(table.read(spark, SCHEMA, ["x=y"])) == [("x=y", None, 4)]
    assert found(table.read(spark, SCHEMA, [])) == []


def test_files_read_per_lookup_do_not_grow_with_the_history(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        root = str(tmp_path)
        user = lambda i, level: (str(i), f"n{i}", str(level), None, "F")
        kinds = "id string, login_name string, user_level string, birthday date, gender string"
        jobs.load_users(spark.createDataFrame([user(i, 0) for i in range(300)], kinds), root)
        table = replace(jobs.user_table(root).of_writer("changes"), fan=4, retain=0)
        changes = lambda b: spark.createDataFrame([user(i, b) for i in range(b % 7, 300, 7)], kinds).withColumns({
            "bucket": jobs.bucket_of("id"), "arrival": F.lit(b).cast("timestamp")})
        ids = spark.createDataFrame([("3",), ("4",), (None,), ("none",)], "id string")
        files = []
        for b in range(1, 12):
            table.write_batch(changes(b), b)
            buckets = jobs._buckets(ids, "id", jobs.Settings())
            files.append(len(table.read(spark, jobs.USER_TABLE, buckets).inputFiles()))
        levels = {r.id: r.user_level for r in jobs.users_of(spark, root, ids).collect()}
        assert levels == {"3": "10", "4": "11"}
        # At most the folders of each level, and of these the buckets of the ids.
        assert max(files) <= 3 * 4 * 3 and files[-1] <= max(files[:5]) + 3
        jobs.load_users(spark.createDataFrame([user(3, 99), user(1000, 1)], kinds), root, load=1)
        ids = spark.createDataFrame([("3",), ("1000",)], "id string")
        assert {r.id: r.user_level for r in jobs.users_of(spark, root, ids).collect()} == {"3": "10", "1000": "1"}
        base = lambda s, wanted: wanted.selectExpr("id", "id as login_name", "'b' as user_level", "cast(null as date) as birthday", "'F' as gender")
        more = spark.createDataFrame([("3",), ("new",)], "id string")
        assert {r.id: r.user_level for r in jobs.users_of(spark, root, more, base=base).collect()} == {"3": "10", "new": "b"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_first_days_move_and_a_day_reads_its_own_folder(spark, tmp_path):
    root, settings = str(tmp_path), jobs.Settings(buckets=2)
    by_day, by_device = jobs.first_seen_table(root, settings), jobs.device_table(root, settings)
    write = jobs.first_seen_writer(root, settings, by_day.write_batch, by_device.write_batch)
    visits = lambda *rows: spark.createDataFrame(list(rows), "mid string, logdate string")
    first = [("a", "d2"), ("a", "d3"), ("b", "d2"), (None, "d1"), ("c", None)]
    write(visits(*first), 0)
    assert [jobs.new_devices(spark, root, d, settings).first().n for d in ("d1", "d2", "d3")] == [0, 2, 0]
    write(visits(("a", "d1"), ("b", "d3"), ("c", "d3")), 1)
    write(visits(("a", "d1"), ("b", "d3"), ("c", "d3")), 1)
    write(visits(("a", "d2")), 2)
    assert [jobs.new_devices(spark, root, d, settings).first().n for d in ("d1", "d2", "d3")] == [1, 1, 1]
    files = jobs.new_devices(spark, root, "d2", settings).inputFiles()
    assert files and all("/dt=d2/" in f for f in files)
