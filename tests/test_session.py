"""Session helpers: sizes, checkpoint folders."""

import pytest

from duetto import session as S


def test_byte_sizes_with_units():
    assert [S.byte_size(x) for x in ("100", "100b", "100KB", "1g", " 2 mb", "-1")] == [
        100, 100, 102_400, 1 << 30, 2 << 20, -1]
    with pytest.raises(ValueError):
        S.byte_size("ten")


def test_broadcast_budget_follows_the_setting(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        for text, want in (("100KB", 102_400), ("-1", 0)):
            spark.conf.set(key, text)
            assert S.broadcast_budget(spark) == want
    finally:
        spark.conf.set(key, before)


def test_a_cluster_without_a_checkpoint_folder_is_an_error(monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

    monkeypatch.setattr(S, "checkpoint_dir", lambda spark: None)
    with pytest.raises(RuntimeError):
        S.ensure_checkpoint_dir(Session())
