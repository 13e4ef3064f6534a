import datetime
import json
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.plans import catalog, maintenance, metrics, upkeep
from larkspur.sources.lake import CommitConflict, LakeTable, SnapshotExpired, TableRecreated
from larkspur.streaming import gauges, include, ingest, lag


@pytest.fixture
def table(spark, tmp_path):
    return LakeTable(spark, f"file://{tmp_path}/t")


def test_append_evolve_replay(spark, table):
    a = spark.createDataFrame([("click", 1), ("view", 2)], "event string, n int")
    assert table.append(a, "k1") == 2
    assert table.append(a, "k1") == 0
    assert table.append(spark.createDataFrame([("x", 2**40, True)], "event string, n long, extra boolean"), "k2") == 1
    got = {tuple(r) for r in table.read().select("event", "n", "extra").collect()}
    assert got == {("click", 1, None), ("view", 2, None), ("x", 2**40, True)}
    assert table.read(version=1).count() == 2 and "_inserted_at" in table.read().columns


def test_partitioned_write_and_pruning(spark, table):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "n long, team long")
    table.create(df.schema, spec="team", sort=("n",))
    table.append(df, "k")
    values = sorted(f["values"][0] for f in table.snapshot().files.values())
    assert set(values) == {"0", "1", "2"}
    assert table.read(keep_file=lambda f: f["values"] == ["1"]).count() == 10
    with pytest.raises(ValueError):
        table.create(df.schema, spec="bucket(n, 4)")


def test_conflicts(spark, table):
    df = spark.createDataFrame([(1,)], "n long")
    table.append(df, "a")
    basis = table.snapshot()
    table.append(df, "b")
    with pytest.raises(CommitConflict):
        table._commit(basis, {"add": []})
    with pytest.raises(TableRecreated):
        table.append(df, "c", table_uuid="other")
    with pytest.raises(CommitConflict):
        table.replace(["data/none"], [])


def test_compact_and_expire(spark, table):
    for k in "abcd":
        table.append(spark.createDataFrame([(ord(k),)], "n long").coalesce(1), k)
    before = sorted(table.snapshot().files)
    assert table.compact([before]) == 1
    assert len(table.snapshot().files) == 1 and table.read().count() == 4
    assert table.read(version=4).count() == 4
    assert sorted(maintenance.expire(table)) == before
    assert table.read().count() == 4
    c = catalog.from_table(table)
    assert metrics.data_files(c).first()["rows"] == 4
    good, bad = metrics.run(c, {"data_files": metrics.data_files, "broken": lambda c: c.snapshot.select("none")})
    assert set(good) == {"data_files"} and set(bad) == {"broken"}


def test_empty_batch_and_sort(spark, table):
    table.append(spark.createDataFrame([], "a long"), "k")
    assert table.read().count() == 0
    assert table.ensure_sort(("a",)) and not table.ensure_sort(("a",))


def test_stream_is_exactly_once(spark, table, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(i, f'{{"id":{i},"t":"{"a" if i % 2 else "b"}"}}') for i in range(20)], "seq long, value string").write.parquet(str(src))
    for _ in range(2):
        stream = spark.readStream.schema("seq long, value string").parquet(str(src))
        ingest.ingest(spark, stream, ingest.LakeSink(table), ingest.Steps(keep=("t", ["a"])), str(tmp_path / "cp"))
    assert table.read().count() == 10


def test_retry_and_small_rules():
    calls, slept = [], []

    def write():
        calls.append(1)
        if len(calls) < 3:
            raise CommitConflict("x")
        return 7

    assert ingest.write_with_retry(write, lambda: None, sleep=slept.append) == 7 and len(slept) == 2
    with pytest.raises(CommitConflict):
        ingest.write_with_retry(lambda: (_ for _ in ()).throw(CommitConflict("x")), lambda: None, attempts=2, sleep=slept.append)
    assert lag.flush_trigger(10, 1, 0, 10, 60) == "size" and lag.flush_trigger(1, 1, 61, 10, 60) == "time" and lag.flush_trigger(99, 0, 99, 10, 60) is None
    assert lag.final_flush(0, True) == "none" and lag.final_flush(1, True) == "skip" and lag.final_flush(1, False) == "flush"
    assert lag.consume_timeout(-1) == 0.1 and lag.consume_timeout(99) == 60
    assert lag.backoff(10) == 30 and lag.backoff(0, retry_after=40) == 40
    assert lag.adaptive_batch_size(1000, 50, 100) == 500 and lag.adaptive_batch_size(1000, 100, 100) == 10
    assert lag.classify(CommitConflict("x")) == "commit_contention" and lag.classify(OSError("x")) == "write_retry"
    assert ingest.flush_key("t", "q", [("a", 1, 0, 5)]) != ingest.flush_key("t", "q", [("a", 1, 0, 6)])


def polled(state, *polls):
    return [state.answer(p) for p in polls]


def test_polled_allowlist():
    s = include.State([1, 2, 3], pins=[9])
    assert polled(s, [], ["x"], [1, "x"]) == [(0, 0, "empty"), (0, 0, "type_flip"), (0, 0, "type_flip")]
    assert polled(s, [1, 2, 3, 4], [1, 2, 3], [1, 2, 3], [1, 2, 3, 4], [1, 2, 3], [1, 2, 3], [1, 2, 3]) == [(1, 0, None), *[(0, 0, None)] * 5, (0, 1, None)]
    assert set(s.numbers) == {1, 2, 3, 9}
    # absences add up; only what three polls in a row lack would go, and more than half of what is governed may not
    assert polled(s, [7], [7, 8], [], [6]) == [(1, 0, None), (1, 0, None), (0, 0, "empty"), (1, 0, "bulk_removal")]
    # the refused poll counted as none: one absence more is refused anew, until fewer are to go
    assert {v for v, n in s.numbers.items() if n == 2} == {1, 2, 3} and polled(s, [6, 7, 8]) == [(0, 3, None)]
    assert polled(include.State([1, 2], need=1), [1], [5]) == [(0, 1, None), (1, 1, None)]
    assert polled(include.State([], pins=[4], need=1), []) == [(0, 0, None)] and polled(include.State([], need=1), []) == [(0, 0, "empty")]
    # pins that a poll names are governed by it, others are not
    assert polled(include.State([1, 2, 3], [10, 11], 1), [3, 10, 11]) == [(0, 2, None)]
    assert polled(include.State([1, 2, 3], [10, 11], 1), [3]) == [(0, 0, "bulk_removal")]
    assert include.difference(include.State([1], [5]), [1, 2]) == (1, 0) and include.difference(include.State([1, 3], [5]), [1]) == (0, 1)
    with pytest.raises(ValueError):
        include.State([1], need=0)


def test_allowlist_of_a_stream_equals_the_replay(spark, tmp_path):
    rng = random.Random(3)
    rows, want = [], []
    for key in range(4):
        state = include.State([1, 2, 3], [0], 2)
        for seq in range(30):
            values = sorted(rng.sample(range(8), rng.randint(0, 5)))
            rows += [(key, seq, v) for v in values] or [(key, seq, None)]
            added, removed, refused = state.answer(values)
            want.append((key, seq, len(state.numbers), added, removed, refused))
    df = spark.createDataFrame(rows, "set long, seq long, value long")
    assert sorted(map(tuple, include.replay(df.repartition(3), [1, 2, 3], [0], 2).collect())) == want and {w[-1] for w in want} == {None, "empty", "bulk_removal"}
    for i in range(3):  # a micro-batch each
        df.where(F.floor(F.col("seq") / 10) == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/polls")
    files = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/polls")
    followed = include.follow(files, [1, 2, 3], [0], 2).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
    followed.awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == want


def test_retention_rules(spark):
    leaf = maintenance.leaf_time(F.lit("2024"), F.lit("2"), F.lit("31"), F.lit("1"))
    cut = maintenance.retention_cutoff(F.lit("2024-03-10 05:30:00").cast("timestamp"), 1)
    r = spark.range(1).select(leaf.alias("leaf"), cut.cast("string").alias("cut")).first()
    assert r["leaf"] is None and r["cut"] == "2024-03-03 05:00:00"
    assert maintenance.halving(8, True, 3, 64) == (4, 0) and maintenance.halving(8, False, 9, 64) == (16, 0)


def test_retries_wait_as_asked_and_stop_at_permanent_errors():
    waits, failed, todo = [], {}, [ingest.SinkError("busy", retry_after=7.0), CommitConflict("x"), None]

    def write():
        e = todo.pop(0)
        if e:
            raise e
        return 5

    assert ingest.write_with_retry(write, lambda: None, sleep=waits.append, failed=failed) == 5
    assert waits[0] == 7.0 and 1.0 <= waits[1] <= 1.25 and failed == {"write_retry": 1, "commit_contention": 1}
    todo = [ingest.SinkError("400", label="bad_request", permanent=True)]
    with pytest.raises(ingest.SinkError):
        ingest.write_with_retry(write, lambda: None, sleep=waits.append, failed=failed)
    assert len(waits) == 2 and failed["bad_request"] == 1


def test_variant_columns_take_nulls(spark, table):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.VariantType(), False)])
    with pytest.raises(ValueError, match="v"):
        table.create(schema)


def test_manifest_and_lock(tmp_path):
    path = f"{tmp_path}/m.json"
    for leaves in ([{"leaf": 1}], []):
        maintenance.write_manifest(path, leaves)
        assert json.load(open(path)) == {"leaves": leaves}
    with maintenance.AdvisoryLock(f"{tmp_path}/lock"):
        with pytest.raises(FileExistsError), maintenance.AdvisoryLock(f"{tmp_path}/lock"):
            pass
    with maintenance.AdvisoryLock(f"{tmp_path}/lock"):
        pass


def test_partitions_that_a_reader_has_not_passed_stay(spark, table):
    rows = spark.sql("SELECT id AS event_id, timestamp'2024-01-01 05:00:00' + make_interval(0, 0, 0, cast(id AS int)) AS ts FROM range(6) UNION ALL SELECT 9, NULL")
    table.create(rows.schema, spec="day(ts)")
    table.append(rows, "a")
    cut = datetime.datetime(2024, 1, 5)
    cursors = spark.sql("SELECT timestamp'2024-01-03 12:00:00' AS position UNION ALL SELECT NULL")
    assert maintenance.drop_partitions(table, "ts", cut, cursors) == 2
    assert sorted(r[0] for r in table.read().select("event_id").collect()) == [2, 3, 4, 5, 9]
    assert maintenance.drop_partitions(table, "ts", cut) == 2 and maintenance.drop_partitions(table, "ts", cut) == 0
    assert sorted(r[0] for r in table.read().select("event_id").collect()) == [4, 5, 9]


def test_checkpoints_of_the_log_give_the_same_snapshots(spark, table, monkeypatch):
    from larkspur.sources import lake

    monkeypatch.setattr(lake, "CHECKPOINT", 3)
    table.create(T.StructType([T.StructField("n", T.LongType())]), sort=("n",))
    for i in range(7):
        table.append(spark.range(i, i + 1).select(F.col("id").alias("n"), *([F.lit("x").alias("extra")] if i == 4 else [])), f"k{i}")
    folds = [n for n in table.files.names("_log") if n.endswith(".fold")]
    with_folds = [table.snapshot(v) for v in range(8)]
    table.files.fs.create(table.files.path("_log/00000000000000000007.fold"), True).close()  # a broken one is passed over
    assert table.snapshot(7) == with_folds[7] and len(folds) == 2
    for n in [*folds, "00000000000000000007.fold"]:
        table.files.delete(f"_log/{n}")
    assert [table.snapshot(v) for v in range(8)] == with_folds
    assert table.append(spark.range(1).select(F.col("id").alias("n")), "k3") == 0
    assert sorted(r["n"] for r in table.read().collect()) == list(range(7)) and sorted(r["n"] for r in table.read(3).collect()) == [0, 1, 2]


# commits, expiry, merging ----------------------------------------------------------------


def between(t, act):
    """Has ``act`` run once between the staging of the next append and its commit."""
    stage = t._stage

    def staged(*a):
        out = stage(*a)
        t._stage = stage
        act()
        return out

    t._stage = staged


def n_files(t):
    return maintenance.listing(t.spark, f"{t.root}/data").count()


def test_crossed_appends_write_once_unless_the_layout_changed(spark, table):
    one = lambda n, **more: spark.createDataFrame([(n, *more.values())], ", ".join(["n long", *(f"{k} long" for k in more)])).coalesce(1)
    table.append(one(0), "start")
    other = LakeTable(spark, table.root)
    between(table, lambda: other.append(one(1), "b"))
    assert table.append(one(2), "a") == 1 and (table.counts["rebased"], table.counts["rebuilt"]) == (1, 0) and n_files(table) == 3
    between(table, lambda: other.append(one(3, extra=7), "c"))
    assert table.append(one(4), "d") == 1 and (table.counts["rebased"], table.counts["rebuilt"]) == (1, 1) and n_files(table) == 5
    between(table, lambda: other._commit(other.snapshot(), {"spec": "n"}))
    assert table.append(one(5), "e") == 1 and table.counts["rebuilt"] == 2
    assert [f["values"] for f in table.snapshot().files.values() if f["spec"] == "n"] == [["5"]]
    # the same flush by another process, while this one stages: accepted, and its upload goes
    between(table, lambda: other.append(one(6), "f"))
    assert table.append(one(6), "f") == 0 and table.counts["already_published"] == 1
    assert sorted(r["n"] for r in table.read().collect()) == list(range(7)) and n_files(table) == 7


def test_versions_are_whole_or_not_there(spark, table, monkeypatch):
    table.append(spark.range(3).select(F.col("id").alias("n")), "a")
    write = type(table.files).write

    def cut_off(self, name, text):
        write(self, name, text[: len(text) // 2])
        raise OSError("gone")

    monkeypatch.setattr(type(table.files), "write", cut_off)
    with pytest.raises(OSError):
        table._commit(table.snapshot(), {"add": []})
    monkeypatch.undo()
    assert LakeTable(spark, table.root).snapshot().version == 1 and table.append(spark.range(2).select(F.col("id").alias("n")), "b") == 2
    assert not table.files.put_new("_log/00000000000000000002.json", "{}") and table.read().count() == 5


def test_versions_expire_in_the_log(spark, table):
    for i in range(4):
        table.append(spark.range(i, i + 1).select(F.col("id").alias("n")).coalesce(1), f"k{i}")
    files = sorted(table.snapshot().files)
    assert table.compact([files[:2]]) == 1
    assert maintenance.expire(table, keep_last=2, batch=2) == []  # version 4 still sees every file
    assert table.snapshot().oldest == 4 and table.read(4).count() == 4 and table.versions() == [4, 5, 6, 7]
    assert maintenance.expire(table, keep_last=2) == [] and table.snapshot().version == 7
    for v in range(4):
        with pytest.raises(SnapshotExpired, match=f"version {v} "):
            table.read(v)
    table.append(spark.range(9, 10).select(F.col("id").alias("n")).coalesce(1), "k9")
    assert maintenance.expire(table, keep_last=2, purge=False) == [] and sorted(table.snapshot().queue) == files[:2]
    assert set(files[:2]) <= table.present(files)
    assert maintenance.purge_queue(table) == files[:2] and not table.snapshot().queue and maintenance.expire(table, keep_last=9) == []
    assert not set(files[:2]) & table.present(files)
    assert table.append(spark.range(1).select(F.col("id").alias("n")), "k1") == 0  # keys outlive their versions
    fresh = LakeTable(spark, table.root)
    assert sorted(r["n"] for r in fresh.read().collect()) == [0, 1, 2, 3, 9] and fresh.read(5).count() == 4
    assert sorted(f[0] for f in fresh.file_rows() if f[2] is None) == sorted(fresh.snapshot().files)
    now = fresh._commit_at(fresh.versions()[0])["time"]
    assert maintenance.expire(fresh, before=now - 1) == [] and fresh.snapshot().oldest == 5


def test_cleanup_below_a_root_that_holds_data_folders(spark, tmp_path):
    t = LakeTable(spark, f"file://{tmp_path}/data/lake")
    t.append(spark.range(4).select(F.col("id").alias("n")), "a")
    spark.range(5).coalesce(1).write.parquet(f"{t.root}/data/stray x/data")
    soon = F.current_timestamp() + F.expr("INTERVAL 1 HOUR")
    assert maintenance.cleanup(t, F.current_timestamp() - F.expr("INTERVAL 1 HOUR")).count() == 0
    got = [r["path"] for r in maintenance.cleanup(t, soon).collect()]
    assert len(got) == 1 and got[0].startswith("data/stray x/data/part-") and t.read().count() == 4
    assert maintenance.cleanup(t, soon).count() == 0


def test_a_lost_or_broken_file_leaves_all_other_groups_merged(spark, table):
    df = spark.range(40).select(F.col("id").alias("n"), (F.col("id") % 4).alias("team"))
    table.create(df.schema, spec="team", sort=("n",))
    for k in range(3):
        table.append(df.where(F.col("n") % 3 == k).coalesce(1), f"k{k}")
    groups = {}
    for p, f in table.snapshot().files.items():
        groups.setdefault(f["values"][0], []).append(p)
    table.delete_files([groups["0"][0]])
    table.files.write(groups["1"][0], "no parquet at all")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    assert table.compact([groups[k] for k in "0123"]) == 2 and table.counts["groups_left"] <= 2
    live = table.snapshot().files
    assert {k: sum(f["values"] == [k] for f in live.values()) for k in "0123"} == {"0": 3, "1": 3, "2": 1, "3": 1}
    assert table.read(keep_file=lambda f: f["values"] in (["2"], ["3"])).count() == 20
    merged = table.read(keep_file=lambda f: f["values"] == ["2"]).collect()
    assert [r["n"] for r in merged] == sorted(r["n"] for r in merged) and jobs >= 0


def test_merging_never_takes_the_rows_to_the_driver(spark, table):
    for k in "ab":
        table.append(spark.range(1000).coalesce(1), k)
    s = table.snapshot()
    rows, _ = table._dealt(s, {0: sorted(s.files)})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan  # the list of files is built, not the files' rows


def test_a_task_without_rows_leaves_no_stray(spark, table):
    rows = spark.range(0, 100, 1, 4)
    table.append(rows.where("id >= 50"), "a")  # the first task has no row
    table.append(rows.where("id < 0"), "b")
    soon = F.current_timestamp() + F.expr("INTERVAL 1 HOUR")
    assert upkeep.findings(table, soon).isEmpty() and maintenance.cleanup(table, soon).isEmpty() and table.read().count() == 50


def test_folder_names_differ_for_all_values(spark):
    from larkspur.operators import partition

    values = [None, "", "_", "__HIVE_DEFAULT_PARTITION__", "~", "a", "_a", "x" * 121, "x" * 122, "~" + "x" * 300]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(partition.folder_name(F.col("v"))).collect()]
    assert len(set(got)) == len(values) and got[0] is None and all(0 < len(g) < 130 and g != "__HIVE_DEFAULT_PARTITION__" for g in got[1:])


def test_leaves_under_old_specs_rot_and_size(spark, table):
    rows = spark.sql("SELECT id AS n, timestamp'2024-01-01 05:00:00' + make_dt_interval(cast(id AS int)) AS ts FROM range(6)")
    table.create(rows.schema, spec="month(ts)")
    table.append(rows.where("n = 0"), "old")
    table._commit(table.snapshot(), {"spec": "day(ts)"})
    table.append(rows, "new")
    table.append(rows.where("n = 1"), "more")
    table.append(rows.where("n = 1"), "most")
    table.append(rows.selectExpr("n", "cast(NULL AS timestamp) AS ts").limit(1), "none")
    cut = datetime.datetime(2024, 1, 4)
    got = {(r["leaf"], r["state"], r["oversized"]) for r in maintenance.leaves(table, "ts", cut, datetime.datetime(2024, 1, 5), most_files=2).collect()}
    assert got == {("648", "old_spec", False), ("", "rot", False), ("19723", "droppable", False), ("19724", "droppable", True), ("19725", "droppable", False), ("19726", "young", False), ("19727", "floor", False), ("19728", "floor", False)}
    plan = maintenance.drop_leaves(table, "ts", cut)
    assert [x["leaf"] for x in plan] == ["19723", "19724", "19725"] and table.read().count() == 10
    assert maintenance.drop_leaves(table, "ts", cut, dry_run=False) == plan and maintenance.drop_leaves(table, "ts", cut, dry_run=False) == []
    assert [c["dropped"]["leaf"] for c in table.commits() if "dropped" in c] == ["19723", "19724", "19725"]
    assert table.read().count() == 10 - 5


def test_leaf_bounds_of_every_grain():
    from larkspur.operators.partition import parse_spec

    at = lambda spec, *v: maintenance.leaf_bounds(list(v), parse_spec(spec), "ts")
    d = datetime.datetime
    assert at("year(ts)", "54") == (d(2024, 1, 1), d(2025, 1, 1)) and at("month(ts)", "659") == (d(2024, 12, 1), d(2025, 1, 1))
    assert at("team, day(ts)", "x", "19723") == (d(2024, 1, 1), d(2024, 1, 2)) and at("hour(ts)", "1") == (d(1970, 1, 1, 1), d(1970, 1, 1, 2))
    assert at("year, month", "2024", "12") == (d(2024, 12, 1), d(2025, 1, 1)) and at("year", "2024") == (d(2024, 1, 1), d(2025, 1, 1))
    assert at("year, month, day, hour", "2024", "2", "29", "23") == (d(2024, 2, 29, 23), d(2024, 3, 1))
    assert at("year, month, day", "2023", "2", "29") is None and at("day(ts)", "x") is None and at("team", "a") is None and at("day(ts)", None) is None


def test_repair_checks_before_it_commits(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n long, kind string")
    tables = {}
    for name in ("good", "bad"):
        t = tables[name] = LakeTable(spark, f"file://{tmp_path}/{name}")
        t.create(df.schema, spec="kind")
        t.append(df, "k")
    good, bad = tables.values()
    good.change(lambda s: {"values": {p: ["wrong", "many"] for p in s.files}})
    assert len(maintenance.broken_values(good)) == 3
    spark.createDataFrame([(8, "x"), (9, "y")], "n long, kind string").coalesce(1).write.parquet(f"{bad.root}/data/mixed")
    mixed = next(n for n in bad.files.names("data/mixed") if n.endswith(".parquet"))
    bad._commit(bad.snapshot(), {"add": [{"path": f"data/mixed/{mixed}", "bytes": 1, "rows": 2, "values": [], "stats": {}}]})
    before = bad.snapshot()
    changed, failed = maintenance.repair_all(tables)
    assert changed == {"good": 3} and failed["bad"].startswith("CorruptFile") and bad.snapshot() == before
    assert sorted(str(f["values"][0]) for f in good.snapshot().files.values()) == ["None", "a", "b"]
    assert maintenance.repair_values(good) == 0
    with pytest.raises(maintenance.RepairFailed):
        maintenance.repair_all({"bad": bad})


def test_inline_tables_go_in_pages(spark):
    names = [(i % 3, i, f"t_{i}") for i in range(30)] + [(0, 99, "no name"), (1, 98, "t_full")]
    empty = lambda s: spark.createDataFrame([], s)
    c = catalog.Catalog(
        snapshot=spark.createDataFrame([(5, 0.0, 0)], "snapshot_id long, snapshot_time double, schema_version long"), data_file=None, delete_file=None, file_partition_value=None, file_column_stats=None, scheduled=None,
        lake_table=spark.createDataFrame([(2, 0, "live", 1, None)], "table_id long, schema_id long, table_name string, begin_snapshot long, end_snapshot long"), lake_schema=None, table_stats=None,
        inlined=spark.createDataFrame(names, "table_id long, schema_version long, table_name string"), metadata=None,
    )
    calls = []

    def drop(some):
        calls.append(len(some))
        if len(some) > 2 or any(x[2] == "t_4" for x in some):
            raise RuntimeError("out of locks")

    went, sizes = maintenance.drop_inlined(c, drop, page=8, batch=4, rows_of=spark.createDataFrame([("t_full", 3)], "table_name string, n long"))
    assert {x[1] for x in went} == {i for i in range(30) if i % 3 < 2} - {4} and sizes == calls and calls[:2] == [4, 2]
    c.snapshot = empty("snapshot_id long, snapshot_time double, schema_version long")
    with pytest.raises(ValueError, match="no snapshot"):
        maintenance.drop_inlined(c, drop)


def test_inline_tables_are_found_once_for_all_pages(spark, monkeypatch):
    empty = None
    c = catalog.Catalog(
        snapshot=spark.createDataFrame([(5, 0.0, 0)], "snapshot_id long, snapshot_time double, schema_version long"), data_file=empty, delete_file=empty, file_partition_value=empty, file_column_stats=empty, scheduled=empty,
        lake_table=spark.createDataFrame([(2, 0, "live", 1, None)], "table_id long, schema_id long, table_name string, begin_snapshot long, end_snapshot long"), lake_schema=empty, table_stats=empty,
        inlined=spark.range(60).selectExpr("id % 3 AS table_id", "id div 6 AS schema_version", "concat('t_', id) AS table_name"), metadata=empty,
    )
    asked = []
    monkeypatch.setattr(maintenance, "keyset_page", lambda *a: asked.append(a))  # no query a page
    pages = [went for went, _ in maintenance.inlined_drops(c, lambda some: None, page=7, batch=4)]
    went = [x for p in pages for x in p]
    # ids that two tables share may stand on both sides of a page's end
    assert not asked and {len(p) for p in pages[:-1]} == {7} and went == sorted(went, key=lambda x: x[:2]) and len({x[2] for x in went}) == 40


# streams -----------------------------------------------------------------------------------


def test_flush_keys_tell_checkpoints_apart(spark, table, tmp_path):
    src = f"{tmp_path}/in"
    rows = spark.createDataFrame([(i, f'{{"id":{i}}}') for i in range(10)], "seq long, value string")
    rows.coalesce(1).write.parquet(src)

    def run(at):
        stream = spark.readStream.schema("seq long, value string").parquet(src)
        return ingest.ingest(spark, stream, ingest.LakeSink(table), ingest.Steps(), f"{tmp_path}/{at}", name="one name")

    assert run("cp1").written == 10 and run("cp2").written == 10 and run("cp1").batches == 0
    # the last batch of a checkpoint runs again, as after a crash before it was acknowledged
    table.files.fs.delete(table.files.jvm.org.apache.hadoop.fs.Path(f"{tmp_path}/cp1/commits/0"), True)
    table.files.fs.delete(table.files.jvm.org.apache.hadoop.fs.Path(f"{tmp_path}/cp1/commits/.0.crc"), True)
    again = run("cp1")
    assert (again.batches, again.replays, again.written) == (1, 1, 0) and table.read().count() == 20
    rows.coalesce(1).write.mode("append").parquet(src)
    assert run("cp2").written == 10 and table.read().count() == 30


def test_a_batch_without_any_record_makes_no_table(spark, table, tmp_path):
    spark.createDataFrame([(1, "{bad")], "seq long, value string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("seq long, value string").parquet(f"{tmp_path}/in")
    c = ingest.ingest(spark, stream, ingest.LakeSink(table), ingest.Steps(), f"{tmp_path}/cp")
    assert c.written == 0 and not table.versions() and c.flushes == {"final": 1}


# upkeep, gauges, pushing -------------------------------------------------------------------


def test_upkeep_holds_one_lock_and_drains_the_queue(spark, table):
    for i in range(3):
        table.append(spark.range(i, i + 1).select(F.col("id").alias("n")).coalesce(1), f"k{i}")
    with upkeep.TableLock(table):
        with pytest.raises(upkeep.Busy):
            upkeep.maintain(table)
    with upkeep.TableLock(table, stale=-1.0):  # of a run that died
        with upkeep.TableLock(table, stale=-1.0) as other, other:
            pass
    first = sorted(table.snapshot().files)
    table.compact([first])
    maintenance.expire(table, purge=False)
    assert sorted(table.snapshot().queue) == first
    table.delete_files(first[:1])
    assert upkeep.drain(table) == {"healed": 1, "purged": 2} and upkeep.findings(table).isEmpty()
    live = list(table.snapshot().files)
    table.change(lambda s: {"queue": [{"path": "data/none"}]})
    table.delete_files(live)
    with pytest.raises(upkeep.NotDrained):
        upkeep.drain(table)
    assert {tuple(r) for r in upkeep.findings(table).collect()} == {("missing", live[0]), ("queued_gone", "data/none")}
    steps = {name: error for name, _, error in upkeep.maintain(table, only=("drain", "fold"))}
    assert steps["drain"].startswith("NotDrained") and steps["fold"] is None


def test_columns_that_cannot_be_stored_leave_the_others(spark, table):
    df = spark.sql("SELECT 1 AS n, NULL AS nothing, make_interval(1) AS span, struct(NULL AS x) AS deep, 'a' AS t, 2 AS `bad name`")
    assert table.append(df, "k") == 1 and table.read().columns == ["n", "t", "_inserted_at"]
    assert table.counts["unsafe_field_name"] == 1 and table.counts["columns_skipped"] == 3
    assert table._commit_at(1)["message"] == "1 rows in 1 files of 0 partitions, zstd-3"


def test_companions_degrade_to_their_text(spark, table, monkeypatch):
    rows = spark.sql("SELECT 1 AS n, '{}' AS props, 'no variant' AS props_variant")
    table.append(rows, "a")
    batch = spark.sql("""SELECT 2 AS n, '{"k":1}' AS props, parse_json('{"k":1}') AS props_variant""")
    assert table.append(batch, "b") == 1 and table.counts["companion_degraded"] == 1
    assert {tuple(r) for r in table.read().select("n", "props", "props_variant").collect()} == {(1, "{}", "no variant"), (2, '{"k":1}', None)}
    other = LakeTable(spark, f"{table.root}-2")
    sink, append = ingest.LakeSink(other), other.append

    def refuse(df, *a, **k):
        if "v_variant" in df.columns:
            raise RuntimeError("[VARIANT_SIZE_LIMIT] too large")
        return append(df, *a, **k)

    monkeypatch.setattr(other, "append", refuse)
    assert sink.write(spark.sql("SELECT 'x' AS v, parse_json('1') AS v_variant"), "k", "from here") == 1 and sink.counts["variant_fallback"] == 1
    assert other.read().columns == ["v", "_inserted_at"] and other._commit_at(1)["message"].endswith("; from here")
    with pytest.raises(RuntimeError):
        monkeypatch.setattr(other, "append", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("else")))
        sink.write(spark.sql("SELECT parse_json('1') AS v_variant"), "k2")


def test_ranges_are_told_up_to_a_limit():
    ranges = [("b", 1, 0, 5), ("a", 2, "-", "7"), ("a", 0, 3, 4)]
    assert ingest.ranges_text(ranges) == "a: 0 from 3 to 4, 2 from - to 7; b: 1 from 0 to 5"
    many = ingest.ranges_text([("t", p, 0, 9) for p in range(500)], 200)
    assert many.endswith("more") and len(many) < 240 and int(many.split()[-2]) + many.count("from") == 500


def test_counters_and_metrics_are_pushed(spark):
    import http.server
    import threading

    c = ingest.Counters(written=3, batches=1)
    c.take({"consumed": 5, "bytes": 70, "json_parse": 2}, 3)
    c.ended("final")
    text = {r["line"] for r in metrics.exposition(gauges.counters(spark, c)).collect()}
    assert {"written_total 6.0", 'skipped_total{reason="json_parse"} 2.0', 'flushes_total{trigger="final"} 1.0', "healthy 1.0"} <= text
    got = []

    class Gateway(http.server.BaseHTTPRequestHandler):
        def do_PUT(self):
            got.append(self.rfile.read(int(self.headers["Content-Length"])).decode())
            self.send_response(500 if self.path == "/bad" else 202)
            self.end_headers()

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Gateway)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    assert metrics.push(metrics.exposition(gauges.counters(spark, c)), f"{url}/metrics/job/x") == 202 and set(got[0].splitlines()) == text
    with pytest.raises(OSError):
        metrics.push(metrics.exposition(gauges.counters(spark, c)), f"{url}/bad")
    server.shutdown()


def test_user_metrics_win_over_built_in_ones(spark, table):
    table.append(spark.range(3).select(F.col("id").alias("n")).coalesce(1), "k")
    c = catalog.from_table(table)
    queries = metrics.merge([{"name": "data_files", "sql": "SELECT count(*) AS n FROM data_file"}, {"name": "own", "sql": "SELECT 7 AS n", "interval_minutes": 5}], ["catalog"])
    assert "catalog" not in queries and queries["own"](c).first()["n"] == 7 and queries["data_files"](c).columns == ["n"]
    for bad in ({"name": "Own", "sql": "x"}, {"name": "a", "sql": "x", "interval_minutes": True}, {"name": "a", "sql": "x", "interval_minutes": 0}, {"name": "a"}):
        with pytest.raises(ValueError):
            metrics.merge([bad])


def test_catalog_of_a_trimmed_log(spark, table):
    for i in range(4):
        table.append(spark.range(i + 1).select(F.col("id").alias("n")).coalesce(1), f"k{i}")
    old = sorted(table.snapshot().files)
    table.compact([old[:2]])
    maintenance.expire(table, keep_last=2, purge=False)
    c = catalog.from_table(table)
    rows = {(r["path"], r["begin_snapshot"], r["end_snapshot"]) for r in c.data_file.collect()}
    assert rows == {(f[0], f[1], f[2]) for f in table.file_rows()} and len(rows) == 5
    assert metrics.data_files(c).first()["rows"] == 10 and c.table_stats.first()["record_count"] == 10


def test_a_running_ingest_is_finished_with_a_final_flush(spark, table, tmp_path):
    rows = spark.createDataFrame([(i, f'{{"id":{i}}}') for i in range(10)], "seq long, value string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("seq long, value string").parquet(f"{tmp_path}/in")
    q = ingest.ingest(spark, stream, ingest.LakeSink(table), ingest.Steps(), f"{tmp_path}/cp", name="running", once=False, flush_seconds=3600)
    c, until = q.larkspur_counters, time.monotonic() + 60
    while not c.flushes and time.monotonic() < until:
        time.sleep(0.1)
    assert c.written == 10 and c.flushes == {"time": 1} and c.healthy() and not c.healthy(-1.0)
    rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    rest = ingest.finish(q)
    assert not q.isActive and rest.flushes == {"final": 1} and rest.written == 10 and table.read().count() == 20


def test_groups_and_destinations():
    from larkspur.streaming import config

    assert config.load({"GROUP_ID": "g-1", "LAST_DESTINATION": "lake"}).destination == "lake"
    for bad in ({"GROUP_ID": "a b"}, {"DESTINATION": "none"}, {"DESTINATION": "log", "PARTITION_BY": "a"}, {"LAST_DESTINATION": "log"}, {"RETRY_ATTEMPTS": "50"}):
        with pytest.raises(config.ConfigError):
            config.load(bad)


def _catalog_of(spark, table, files: str, values: str):
    import dataclasses

    return dataclasses.replace(catalog.from_table(table), data_file=spark.sql(files), file_partition_value=spark.sql(values))


def test_partition_values_move_once_whether_or_not_the_files_fit_a_broadcast(spark, table):
    import re

    table.append(spark.createDataFrame([(1,)], "n long"), "k")
    files = "SELECT id AS data_file_id, id % 3 AS table_id, cast(NULL AS bigint) AS end_snapshot, concat('p', id) AS path, id AS file_size_bytes FROM range(100)"
    c = _catalog_of(spark, table, files, "SELECT id div 2 AS data_file_id, id div 2 % 3 AS table_id, id % 2 AS partition_key_index, cast(id % 5 AS string) AS partition_value FROM range(200)")
    for most in ("-1", "10485760"):
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        try:
            for df in (metrics.mergeable_files_per_band(c), metrics.files_per_partition_top20(c), maintenance.compaction_bins(c)):
                keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\), (\w+)", df._jdf.queryExecution().executedPlan().toString())
                assert [k for k, why in keys if why == "REPARTITION_BY_COL" and k.startswith("data_file_id")] and not [k for k, _ in keys if "data_file_id" in k and "table_id" in k], keys
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_partitions_of_odd_values(spark, table):
    """Ids of several tables, values without an id, null and empty values, several values of a key, files without values and files of one id."""
    table.append(spark.createDataFrame([(1,)], "n long"), "k")
    files = "SELECT * FROM VALUES (1L, 1L, 'a'), (1L, 2L, 'b'), (2L, 1L, 'c'), (3L, 1L, 'd'), (4L, 1L, 'e'), (NULL, 1L, 'f'), (1L, 1L, 'g'), (5L, 9L, 'h'), (6L, 1L, 'i') AS t(data_file_id, table_id, path)"
    values = (
        "SELECT * FROM VALUES (1L, 1L, 1L, 'y'), (1L, 1L, 0L, 'x'), (1L, 2L, 0L, 'z'), (2L, 1L, 0L, NULL), (3L, 1L, 0L, ''), (NULL, 1L, 0L, 'n'), (5L, 1L, 0L, 'other'), "
        "(6L, 1L, 2L, 'b'), (6L, 1L, 2L, 'a'), (6L, 1L, 1L, NULL), (6L, NULL, 0L, 'no'), (6L, 1L, 10L, 'z') AS t(data_file_id, table_id, partition_key_index, partition_value)"
    )
    c = _catalog_of(spark, table, files, values)
    want = {"a": "x/y", "b": "z", "c": None, "d": "", "e": None, "f": None, "g": "x/y", "h": None, "i": "a/b/z"}
    assert {r["path"]: r["partition"] for r in metrics.with_partition(c, c.data_file).collect()} == want
    named = {r["path"]: r["partition"] for r in metrics.with_partition(c, c.data_file, "inner").collect()}
    assert named == {k: v for k, v in want.items() if k in "abcdgi"}
