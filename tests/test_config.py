import pytest

from plumbline.plans import config
from plumbline.spec import ReconSpec


def saved(spark, **options):
    return config.spec_rows(spark, "db.s.orders", "ext.s.orders", ReconSpec(**options), user="me")


def test_saved_options_come_back(spark):
    spec = ReconSpec(keys=["id"], exclude=["x"], where="y > 1", rename={"a": "b"})
    cfg = config.spec_rows(spark, "db.s.orders", "ext.s.orders", spec, user="me")
    got = ReconSpec.from_options(config.config_load(cfg, " DB.S.Orders", "ME", {}))
    assert (got.keys, got.exclude, got.where, got.rename) == (("id",), ("x",), "y > 1", {"a": "b"})


def test_passed_options_win_and_unknown_ones_are_skipped(spark):
    extra = spark.createDataFrame(
        [("db.s.orders", "ext.s.orders", "old_option", "str", "1", "me")], config.CONFIG_SCHEMA)
    cfg = saved(spark, keys=["id"], where="a").unionByName(extra)
    got = config.config_load(cfg, "db.s.orders", "me", {"where": "b"})
    assert got["where"] == "b" and "old_option" not in got and got["keys"] == ["id"]


def test_other_users_and_tables_are_not_seen(spark):
    cfg = saved(spark, keys=["id"])
    assert config.config_load(cfg, "db.s.orders", "you", {}) == {}
    assert config.config_load(cfg, "db.s.other", "me", {}) == {}


def test_saving_again_updates(spark):
    both = config.config_save(saved(spark, where="a"), saved(spark, where="b"))
    assert both.count() == saved(spark).count()
    assert config.config_load(both, "db.s.orders", "me", {})["where"] == "b"


def test_blob_keys_become_rows(spark):
    cfg = saved(spark, keys=["id"]).filter("arg_name = 'cfg_json'")
    out = config.config_json_to_rows(cfg, ["keys", "absent"])
    assert {r.arg_name: r.arg_val for r in out.collect() if r.arg_name != "cfg_json"} == {
        "keys": '["id"]'}


def test_migrating_twice_is_an_error(spark):
    with pytest.raises(ValueError, match="long form"):
        config.config_migrate(saved(spark))


def test_current_user_is_stamped(spark):
    rows = config.spec_rows(spark, "a", "b", ReconSpec())
    assert rows.filter("user_id = current_user()").count() == rows.count()
