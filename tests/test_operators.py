import datetime

import lz4_frames  # noqa: F401  (helper beside the tests)
import pytest
from pyspark.sql import functions as F

from larkspur.functions import coerce, transforms
from larkspur.operators import evolve, filters, infer, partition, presort, variants
from larkspur.sources import frames

CANON = "0123e567-e89b-12d3-a456-426614174000"
HEX = CANON.replace("-", "")


def column(df, name="v"):
    return [r[name] for r in df.collect()]


@pytest.mark.parametrize("text", [CANON, CANON.upper(), HEX, HEX.upper(), "{" + CANON + "}", "{" + HEX + "}", "urn:uuid:" + CANON])
def test_uuid_accepted(spark, text):
    df = coerce.pin(spark.createDataFrame([(text,)], "v string"), [("v", "uuid")])
    assert column(df) == [CANON] and df.schema["v"].metadata == {"logical": "uuid"}


@pytest.mark.parametrize("text", ["", "urn:" + CANON, "URN:UUID:" + CANON, "0x" + HEX[:30], HEX[:30], HEX + "0", HEX[:31] + "g", " " + CANON, CANON[:8] + CANON[9:], "x uuid:" + CANON, "{" + CANON])
def test_uuid_refused(spark, text):
    assert column(coerce.pin(spark.createDataFrame([(text,)], "v string"), [("v", "uuid")])) == [None]


@pytest.mark.parametrize(
    "target,cases",
    [
        ("bigint", {"12": 12, "-3": -3, " 12": None, "+5": None, "0x1F": 31, "1.5": None, "9223372036854775808": None, "": None}),
        ("double", {"1.5": 1.5, " 1": None, "1d": None, "-2e3": -2000.0}),
        ("boolean", {"true": True, "FALSE": False, "t": None, "yes": None, "1": True, "0": False}),
        (
            "timestamptz",
            {
                "2024-01-01": datetime.datetime(2024, 1, 1), "2024-01-01 10": datetime.datetime(2024, 1, 1, 10), "2024-01-01T10:00:00.123456": datetime.datetime(2024, 1, 1, 10, 0, 0, 123456),
                "2024-01-01T10:00:00Z": None, "2024-01-01T10:00:00+02:00": None, "2024": None, "2024-1-1": None, "10:00": None, "2024-01-01 10:00:00.1234567": None, "2024-02-31": None,
            },
        ),
    ],
)
def test_text_casts(spark, target, cases):
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "v string")
    assert column(coerce.pin(df, [("v", target)])) == [*cases.values(), None]


def test_number_casts(spark):
    df = spark.createDataFrame([(1.5, 2.0), (2.0, 1e20), (float("nan"), 0.25)], "a double, b double")
    out = coerce.pin(df, [("a", "bigint"), ("b", "varchar"), ("none", "double")]).collect()
    assert [tuple(r) for r in out] == [(None, "2"), (2, "1e+20"), (None, "0.25")]
    micros = coerce.pin(spark.createDataFrame([(1_000_000,)], "v long"), [("v", "timestamptz")])
    assert column(micros) == [datetime.datetime(1970, 1, 1, 0, 0, 1)]
    assert coerce.pin_failures(df, [("a", "bigint")]).first()["a"] == 2


def test_keep_fails_closed_and_drop_fails_open(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, 1.5), (3, "007", 2.5)], "i int, s string, d double")
    assert column(filters.keep(df, "i", ["1", 3]), "i") == [1, 3]
    assert column(filters.keep(df, "s", [7]), "i") == []
    assert column(filters.keep(df, "s", ["007"]), "i") == [3]
    for field, values in (("absent", [1]), ("d", [0.5]), ("i", ["x"]), ("i", [2**40])):
        assert filters.keep(df, field, values).count() == 0
        assert filters.drop(df, field, values).count() == 3
    assert column(filters.drop(df, "s", ["a"]), "i") == [2, 3]
    assert filters.keep_counts(df, "s", ["a"]).first().asDict() == {"total": 3, "kept": 1, "filter_field_missing": 1, "filter_excluded": 1, "filter_value_invalid": 0}
    assert filters.keep_counts(df, "absent", ["a"]).first()["filter_field_missing"] == 3


def test_infer_is_order_dependent(spark):
    def kinds(*values):
        rows = spark.createDataFrame([(i, f'{{"x":{v}}}') for i, v in enumerate(values)], "seq long, value string")
        return infer.infer(infer.parse(rows), "seq")[0], [r["x"] for r in infer.convert(rows, "seq").orderBy("seq").collect()]

    assert kinds("1", "1.5") == (infer.Key("x", "long", True), ["1", "1.5"])
    assert kinds("1.5", "1") == (infer.Key("x", "double", False), [1.5, 1.0])
    assert kinds("null", "true", '"a"') == (infer.Key("x", "boolean", True), [None, "True", "a"])
    assert kinds("50", '"51-200"')[1] == ["50", "51-200"]
    assert kinds("null")[1] == [None]


def test_json_text_and_skips(spark):
    rows = spark.createDataFrame([(0, '{"a":{"k": [1, 2]},"b":true,"c":2.0}'), (1, "[1]"), (2, "{'a':1}"), (3, '{"a":1} x'), (4, None), (5, "")], "seq long, value string")
    assert infer.skipped(rows).first()["json_parse"] == 4
    r = infer.convert(rows, "seq", json_text=["b"]).first()
    assert (r["a"], r["b"]) == ('{"k":[1,2]}', "true")


def test_lz4_frames(spark):
    good = lz4_frames.frame(b'{"a":1}')
    data = [(0, good), (1, b'{"a":2}'), (2, good[:-3]), (3, bytes.fromhex("04224d18")), (4, None)]
    out = frames.decode(spark.createDataFrame(data, "seq long, value binary")).orderBy("seq").collect()
    assert [None if r["value"] is None else bytes(r["value"]) for r in out][:2] == [b'{"a":1}', b'{"a":2}']
    assert out[3]["value"] in (None, bytearray(b"")) and out[4]["value"] is None


def test_broken_frames_leave_no_memory_behind():
    def resident():
        with open("/proc/self/statm", encoding="ascii") as f:
            return int(f.read().split()[1]) * 4096

    broken = lz4_frames.frame(b"click")[:12]
    assert [frames.open_frame(broken) for _ in range(100)] == [None] * 100
    before = resident()
    for _ in range(5000):
        frames.open_frame(broken)
    assert resident() - before < 5 << 20


def test_frames_are_read_in_steps_and_handed_on_in_runs(spark, monkeypatch):
    texts = [bytes([65 + i % 7]) * n for i, n in enumerate([0, 1, frames.STEP - 1, frames.STEP, frames.STEP + 1, 3 * frames.STEP, 500_000])]
    packed = [lz4_frames.frame(t) for t in texts]
    assert [frames.open_frame(p) for p in packed] == texts
    monkeypatch.setattr(frames, "MOST", 400_000)
    assert frames.open_frame(packed[-1]) is None and frames.open_frame(packed[-2]) == texts[-2]
    monkeypatch.undo()
    monkeypatch.setattr(frames, "HANDED", 100_000)
    runs = list(frames._runs(frames.pa.array(packed)))
    assert [v for _, r in runs for v in r] == texts and len(runs) > 2 and [f for f, _ in runs] == [sum(len(r) for _, r in runs[:i]) for i in range(len(runs))]


def test_presort(spark):
    df = spark.createDataFrame([(0, 2.0), (1, None), (2, float("nan")), (3, 2.0)], "seq long, v double").coalesce(1)
    assert column(presort.presort(df, ["v"], "seq"), "seq") == [0, 3, 2, 1]
    assert presort.sort_keys(df, ["v", "none"])[1] == "field_missing"
    assert presort.sort_keys(df.select(F.array("v").alias("v")), ["v"])[1] == "unsortable_type"


def test_partition_spec():
    spec = partition.parse_spec("team, month(ts), bucket(u, 16)")
    assert [(f.kind, f.column, f.buckets) for f in spec] == [("identity", "team", None), ("month", "ts", None), ("bucket", "u", 16)]
    for bad in ("", "a,,b", "bucket(u)", "bucket(u, 0)", "week(ts)", "a, a", "day(ts, 3)", "a)"):
        with pytest.raises(ValueError):
            partition.parse_spec(bad)


def test_transforms_and_bucket(spark):
    t = F.col("t")
    df = spark.createDataFrame([(datetime.datetime(1969, 12, 31, 23, 30), 34, "iceberg")], "t timestamp, n long, s string")
    r = df.select(transforms.year(t), transforms.month(t), transforms.day(t), transforms.hour(t), transforms.murmur3_long(F.col("n")).alias("h"), transforms.bucket_text(F.col("s"), 1 << 30).alias("b")).first()
    assert tuple(r)[:4] == (-1, -1, -1, -1)
    assert r["h"] == 2017239379  # published test value of the hash over 34L
    assert r["b"] == (1210000089 & 0x7FFFFFFF) % (1 << 30)  # and over "iceberg"


def murmur3_bytes(data: bytes) -> int:
    def scramble(k: int) -> int:
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        return k * 0x1B873593 & 0xFFFFFFFF

    h, whole = 0, len(data) // 4 * 4
    for i in range(0, whole, 4):
        h ^= scramble(int.from_bytes(data[i : i + 4], "little"))
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    if whole < len(data):
        h ^= scramble(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def test_bucket_of_texts(spark):
    texts = [None, "", "a", "ab", "abc", "abcd", "abcde", "\x00\x00", "é", "日本語テキスト", "\U0001F600 z", "x" * 1001, "y" * 70_003, *(f"team-{i}" * (i % 5) for i in range(200))]
    want = [None if x is None else (murmur3_bytes(x.encode()) & 0x7FFFFFFF) % 1000 for x in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    assert [r["b"] for r in df.select("i", transforms.bucket_text(F.col("s"), 1000).alias("b")).orderBy("i").collect()] == want
    for one in (["é"], [""], []):  # few rows
        assert transforms.murmur3_texts([x.encode() for x in one]).tolist() == [murmur3_bytes(x.encode()) for x in one]
    assert df.where("s is null").select(transforms.bucket_text(F.col("s"), 7)).first()[0] is None


def test_variants(spark):
    df = spark.createDataFrame([('{"a":18446744073709551615,"s":"9223372036854775999"}',), ("{bad",), ("",), (None,), ("null",)], "p string")
    out = variants.dual_write(df.withColumn("P_variant", F.lit(1)), ["p"], guard=True)
    assert out.columns == ["p", "p_variant"]
    assert out.select(F.to_json("p_variant").alias("v")).first()["v"] == '{"a":"18446744073709551615","s":"9223372036854775999"}'
    assert variants.outcomes(df, "p").first().asDict() == {"encoded": 2, "sql_null": 2, "variant_null": 1, "invalid": 1}
    assert variants.first_invalid(df, "p", ["p"]).first()["p"] == "{bad"


def test_evolution(spark):
    live = spark.createDataFrame([], "n int, team long, name string").schema
    batch = spark.createDataFrame([], "N long, team boolean, extra double, `bad-name` string").schema
    schema, added, widened, skipped = evolve.plan(live, batch)
    assert (added, widened, skipped) == (["extra"], ["n"], ["team", "bad-name"])
    assert schema["n"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        evolve.check_reserved(["a", "_inserted_at"], "transform")
    with pytest.raises(TypeError):
        evolve.concat([spark.range(1), spark.createDataFrame([("x",)], "id string")])
    assert evolve.concat([spark.range(1), spark.createDataFrame([("x",)], "s string")]).count() == 2
