import pytest

from sparkfolio import session


class _SC:
    def __init__(self, current):
        self.current, self.set_to, self.master = current, None, "local[2]"

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.set_to = d
        self.current = "file:" + d


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class _Spark:
    def __init__(self, current, conf_value):
        self.sparkContext, self.conf = _SC(current), _Conf(conf_value)


def test_existing_checkpoint_dir_is_kept():
    s = _Spark("hdfs://shared/ckpt/x", None)
    assert session.ensure_checkpoint_dir(s) == "hdfs://shared/ckpt/x" and s.sparkContext.set_to is None


def test_configured_dir_used_when_context_has_none():
    s = _Spark(None, "/shared/ckpt")
    session.ensure_checkpoint_dir(s)
    assert s.sparkContext.set_to == "/shared/ckpt"


def test_local_dir_only_when_unset():
    s = _Spark(None, None)
    session.ensure_checkpoint_dir(s)
    assert s.sparkContext.set_to and "sparkfolio-ckpt-" in s.sparkContext.set_to


def test_a_cluster_must_name_shared_storage():
    s = _Spark(None, None)
    s.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(s)


def test_scratch_paths_are_unique_in_the_runs_folder(spark):
    a, b = session.scratch_path(spark, "t"), session.scratch_path(spark, "t")
    assert a != b and a.startswith(f"{session.run_folder(spark)}/t-") and spark.sparkContext.applicationId in a


def test_a_scope_leaves_nothing(spark, sf_small):
    from sparkfolio.plans.queries import QUERIES
    from sparkfolio.sources.paths import folders, path_exists
    base = session.run_folder(spark)
    before = {n for n, _ in folders(spark, base)}
    for name in ("daily_rank_split", "scan_json_drift", "sink_self_overwrite", "landing_new_only"):
        with session.scratch_scope(spark) as made:
            assert QUERIES[name](spark, sf_small).count() > 0
            assert made
            kept = session.hold(made[0])
        assert path_exists(spark, kept) and {n for n, _ in folders(spark, base)} - before == {kept.rsplit("/", 1)[1]}
        assert session.release(spark, kept) and {n for n, _ in folders(spark, base)} == before


def test_scopes_nest_and_end_after_errors(spark):
    from sparkfolio.sources.paths import path_exists
    with session.scratch_scope(spark):
        outer = session.stored(spark.range(3))
        with pytest.raises(ValueError), session.scratch_scope(spark) as inner:
            session.checkpoint(spark.range(3))
            raise ValueError
        assert not path_exists(spark, inner[0]) and outer.count() == 3


def test_old_folders_of_dead_runs_go(spark):
    import os
    import time
    from pathlib import Path
    root = Path(session.ensure_checkpoint_dir(spark).removeprefix("file:"))
    old, young, other = root / "sparkfolio-run-dead", root / "sparkfolio-run-young", root / "unrelated"
    for p in (old, young, other):
        (p / "x").mkdir(parents=True)
    for p in (old, other):
        os.utime(p, (time.time() - 80 * 3600,) * 2)
    assert session.clean_scratch(spark) == ["sparkfolio-run-dead"]
    assert not old.exists() and young.exists() and other.exists()
