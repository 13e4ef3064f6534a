import pytest

from larkspur.streaming import config

GOOD = {"KEEP_FIELD": "team_id", "KEEP_VALUES": "1, 2,2", "TYPED_COLUMNS": "ts:timestamptz,id:uuid,id:uuid", "PARTITION_BY": "team_id, day(ts)", "HOSTNAME": "pod-1", "REPLICAS": "3"}


def test_good():
    c = config.load(GOOD)
    assert c.keep == ("team_id", (1, 2)) and c.typed == (("ts", "timestamptz"), ("id", "uuid")) and c.ordinal == 1
    assert [f.name for f in c.partition] == ["team_id", "ts_day"] and config.load({}).keep is None
    assert config.filter_of("a", "1,x", ()) == ("a", ("1", "x"))


@pytest.mark.parametrize(
    "change",
    [
        {"KEEP_VALUES": ""}, {"KEEP_FIELD": "a b"}, {"TYPED_COLUMNS": "id:uuid,id:bigint"}, {"TYPED_COLUMNS": "id:blob"}, {"TYPED_COLUMNS": "team_id:uuid"},
        {"VARIANT_COLUMNS": "p_variant"}, {"OFFSET_RESET": "error"}, {"CODEC": "gzip"}, {"CODEC": "snappy", "CODEC_LEVEL": "3"}, {"CODEC_LEVEL": "10"},
        {"INCLUDE_SHADOW": "true"}, {"INCLUDE_URL": "u", "INCLUDE_TOKEN": "t"}, {"INCLUDE_URL": "u", "INCLUDE_POLLS": "0"}, {"INCLUDE_SHADOW": "maybe"},
        {"HOSTNAME": "pod-3"}, {"HOSTNAME": "pod"}, {"PARTITION_BY": "week(ts)"}, {"SORT_COLUMNS": "a;b"}, {"FLUSH_SECONDS": "0"},
    ],
)
def test_refused(change):
    with pytest.raises(config.ConfigError):
        config.load(GOOD | change)


def test_ladders():
    assert config.retry_ladder(5, 0.5, 30, 30) < config.LIVENESS and config.attempt_reserve(30, 40) == 90
    with pytest.raises(config.ConfigError):
        config.retry_ladder(20, 1, 30, 30)
