from pathlib import Path

import pytest

from assay import session
from assay.session import noted, remove, shared_folder, stage, stage_alone


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, **conf):
        self.conf = Conf({key.replace("__", "."): value for key, value in conf.items()})


def test_the_configured_folder_is_used(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    far = Session(spark__master="yarn", spark__checkpoint__dir="hdfs://name/shared/")
    assert session.shared_folder(far) == "hdfs://name/shared"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session(spark__master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.shared_folder(Session())


def test_a_local_session_makes_its_own():
    local = Session(spark__master="local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_tuning_sets_runtime_settings():
    tuned = session.tune(Session())
    assert tuned.conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_staged_rows_are_fixed(spark):
    from pyspark.sql import functions as F

    df = spark.range(100).select("id", F.rand().alias("r"))
    staged = session.stage(df, "test")
    assert sorted(staged.collect()) == sorted(staged.collect())
    assert staged.dtypes == df.dtypes


def test_what_was_staged_on_the_way_goes(spark):
    def make():
        return stage(stage(spark.range(5), "one").where("id > 1"), "two").where("id > 2")

    with noted() as paths:
        kept = stage_alone(make, "three")
    assert kept.count() == 2 and len(paths) == 1 and "three" in paths[0]
    left = [p.name for p in Path(shared_folder(spark)).glob("assay-*")]
    assert not [n for n in left if n.startswith(("assay-one", "assay-two"))]
    remove(spark, paths[0])
