import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from larkspur.sources import messages
from larkspur.sources.lake import CommitConflict, LakeTable
from larkspur.streaming import config, include, ingest, service


def log_of(spark, root, rows, first=0):
    values = [(i % 2, first + i // 2, json.dumps(r) if isinstance(r, dict) else r) for i, r in enumerate(rows)]
    messages.append(spark.createDataFrame(values, "partition int, offset long, value string"), root, "in", segment=3)


def go(spark, root, **env):
    return service.run(spark, config.load(env), root, "in", env.pop("TARGET", f"{root}/table"), f"{root}/state")


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}"


def test_files_of_a_log_go_by_messages_and_not_by_segments(spark, root):
    rows = lambda a, b: spark.range(a, b).selectExpr("cast(id % 2 AS int) AS partition", "id div 2 AS offset", "cast(id AS string) AS value")
    messages.append(rows(0, 2000), root, "in", segment=5)
    messages.append(rows(2000, 2200), root, "in", segment=5)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{root}/in").count()
    assert files <= 2 * 2 * (messages.FILES + 1)
    got = messages.read(spark, root, "in")
    assert got.count() == 2200 and got.where("offset * 2 + partition <> cast(value AS bigint)").isEmpty()


@pytest.mark.parametrize(
    "bad",
    [
        {"ON_INVALID": "drop"}, {"NON_FINITE": "maybe"}, {"INCLUDE_EVERY": "0"}, {"INCLUDE_TIMEOUT": "soon"}, {"VARIANT_COLUMNS": "a", "DECLARED_VARIANTS": "a"},
        {"INCLUDE_URL": "u"}, {"INCLUDE_URL": "u", "KEEP_FIELD": "a", "INCLUDE_SHADOW": "true"}, {"DESTINATION": "log", "DECLARED_VARIANTS": "a"},
    ],
)
def test_settings_refused(bad):
    with pytest.raises(config.ConfigError):
        config.load(bad)
    assert config.load({"INCLUDE_URL": "u", "KEEP_FIELD": "a"}).keep == ("a", ())


def test_a_table_gets_the_layout_of_the_settings(spark, root):
    log_of(spark, root, [{"id": i, "kind": "ab"[i % 2], "doc": {"k": i}, "raw": "{bad" if i == 3 else "[1]"} for i in range(10)])
    env = {"PARTITION_BY": "kind", "SORT_COLUMNS": "id", "VARIANT_COLUMNS": "doc", "DECLARED_VARIANTS": "raw", "CODEC": "snappy", "KEEP_FIELD": "kind", "KEEP_VALUES": "a,b"}
    c = go(spark, root, **env)
    t = LakeTable(spark, f"{root}/table")
    kinds = dict(t.read().dtypes)
    assert (t.snapshot().spec, t.snapshot().sort) == ("kind", ("id",)) and kinds["doc_variant"] == kinds["raw"] == "variant" and c.written == 10
    assert t.read().where("raw IS NULL").count() == 1 and go(spark, root, **env).written == 0 and t.read().count() == 10
    with pytest.raises(Exception, match="partitioned"):  # another spec than the table's
        log_of(spark, root, [{"id": 1, "kind": "a"}] * 2, first=5)
        go(spark, root, **env | {"PARTITION_BY": "id"})


def test_invalid_declared_variants_can_stop_an_ingest(spark, root):
    log_of(spark, root, [{"raw": "{bad"}, {"raw": "1"}])
    with pytest.raises(Exception, match="MALFORMED_RECORD|parse_json|JSON"):
        go(spark, root, DECLARED_VARIANTS="raw", ON_INVALID="raise")


def test_replicas_share_the_partitions(spark, root):
    log_of(spark, root, [{"id": i} for i in range(9)])
    got = [go(spark, root, REPLICAS="2", HOSTNAME=f"x-{i}").written for i in (0, 1, 0)]
    assert got == [5, 4, 0] and LakeTable(spark, f"{root}/table").read().count() == 9


def test_latest_is_settled_at_the_first_start(spark, root):
    log_of(spark, root, [{"id": i} for i in range(7)])
    assert go(spark, root, OFFSET_RESET="latest").written == 0
    messages.append(spark.createDataFrame([(0, 4, '{"id":100}'), (1, 3, '{"id":101}'), (7, 0, '{"id":102}')], "partition int, offset long, value string"), root, "in", segment=3)
    assert go(spark, root, OFFSET_RESET="earliest").written == 3
    assert sorted(r["id"] for r in LakeTable(spark, f"{root}/table").read().collect()) == [100, 101, 102]
    assert go(spark, root, GROUP_ID="other").written == 10


def test_a_group_keeps_its_destination(spark, root):
    log_of(spark, root, [{"id": 1}])
    go(spark, root)
    for change in ({"DESTINATION": "log"}, {"TARGET": f"{root}/elsewhere"}):
        with pytest.raises(config.ConfigError, match="positions"):
            go(spark, root, **change)
    assert go(spark, root, DESTINATION="log", GROUP_ID="g", TARGET=f"{root}/out").written == 1


def test_a_producer_that_dies_between_commit_and_moves(spark, root):
    df = spark.createDataFrame([(f"v{i}",) for i in range(8)], "value string").repartition(3)
    one, other = (messages.Producer(spark, root, "out", 2) for _ in range(2))
    finish, one._finish = one._finish, lambda commit: (_ for _ in ()).throw(OSError("dead")) if commit["key"] else None
    with pytest.raises(OSError, match="dead"):
        one.append(df, "k1")
    one._finish = finish
    assert other.append(df, "k2") == 8 and one.append(df, "k1") == 0 and other.append(df, "k2") == 0
    got = messages.read(spark, root, "out")
    assert got.count() == 16 and got.select("partition", "offset").distinct().count() == 16
    assert {(r["partition"], r["high"]) for r in messages.watermarks(spark, root, "out").collect()} == {(r["partition"], r["n"]) for r in got.groupBy("partition").count().withColumnRenamed("count", "n").collect()}


def test_producers_that_cross_and_follow_an_older_log(spark, root):
    log_of(spark, root, ["a", "b", "c"])
    one, other = (messages.Producer(spark, root, "in", 2) for _ in range(2))
    newest = one._newest

    def late():
        got = newest()
        one._newest = newest
        other.append(spark.createDataFrame([("d",)], "value string").coalesce(1), "k0")
        return got

    one._newest = late
    assert one.append(spark.createDataFrame([("e",), ("f",)], "value string").repartition(2), "k1") == 2
    got = messages.read(spark, root, "in")
    assert sorted(r["value"] for r in got.collect()) == list("abcdef") and got.select("partition", "offset").distinct().count() == 6
    assert one.append(spark.createDataFrame([], "value string"), "none") == 0 and one.append(spark.createDataFrame([], "value string"), "none") == 0


def test_allowlist():
    now, slept, bodies = [0.0], [], ["oops", '["a","b"]', "[1,2]", "{}", "[]", '["b","c"]', '["b","c"]']

    def sleep(s):
        slept.append(s)
        now[0] += s

    a = include.Allowlist(["a"], lambda: bodies.pop(0), need=2, every=10, clock=lambda: now[0], sleep=sleep)
    assert slept == [0.5] and set(a.values()) == {"a", "b"} and len(bodies) == 5
    for want in ({"a", "b"}, {"a", "b"}, {"a", "b"}, {"a", "b", "c"}):  # another kind, no array, nothing, one more
        now[0] += 10
        assert set(a.values()) == want
    assert a.counts == {"failed": 2, "added": 2, "removed": 0, "accepted": 2, "type_flip": 1, "empty": 1}
    shadow = include.Allowlist(["a", "x"], lambda: '["a","b","c"]', shadow=True, clock=lambda: now[0])
    assert shadow.values() == ["a", "x"] and shadow.gap == (2, 1)
    down = lambda: (_ for _ in ()).throw(OSError())
    assert include.Allowlist(["a"], down, shadow=True).values() == ["a"]
    with pytest.raises(include.NoValues):
        include.Allowlist([], down, startup=3, clock=lambda: now[0], sleep=sleep)
    for body in ('[1,"a"]', "[true]", "[null]", "[1.5]", '"a"'):
        with pytest.raises(ValueError):
            include.values_of(body)
    assert include.values_of("[2,1,2]") == [2, 1] and include.Allowlist([1, 2]).values() == [1, 2]


def test_allowed_values_over_http_change_between_batches(spark, root):
    asked, answers = [], ['["a"]', '["a","b"]']

    class Endpoint(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.headers.get("X-Key"))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(answers[min(len(asked), 2) - 1].encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Endpoint)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        env = {"KEEP_FIELD": "k", "INCLUDE_URL": f"http://127.0.0.1:{server.server_port}/v", "INCLUDE_HEADER": "X-Key", "INCLUDE_TOKEN": "t"}
        log_of(spark, root, [{"k": "a"}, {"k": "b"}])
        first = go(spark, root, **env)
        log_of(spark, root, [{"k": "a"}, {"k": "b"}], first=1)
        second = go(spark, root, **env)
    finally:
        server.shutdown()
    assert (first.written, second.written) == (1, 2) and asked == ["t", "t"]
    assert first.include["added"] == 1 and second.include["added"] == 2 and first.skipped["filter_excluded"] == 1


def test_no_attempt_that_the_deadline_has_no_room_for():
    now = [0.0]

    def write():
        now[0] += 100
        raise CommitConflict("x")

    for timeout, calls in ((0.0, 5), (30.0, 3)):  # after 300 s another might take 30 + 150
        now[0], failed = 0.0, {}
        with pytest.raises(CommitConflict):
            ingest.write_with_retry(write, lambda: None, attempts=9, deadline=450, sleep=lambda s: None, clock=lambda: now[0], failed=failed, timeout=timeout)
        assert failed == {"commit_contention": calls}
