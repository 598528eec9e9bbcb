from types import SimpleNamespace

import pytest

from trisect.session import scratch_path, scratch_run, shared_folder


def session(setting=None, chosen=None, master="local[2]"):
    """A stand-in with just the two settings the folder depends on."""
    context = SimpleNamespace(master=master, chosen=chosen)
    context.getCheckpointDir = lambda: context.chosen
    context.setCheckpointDir = lambda folder: setattr(context, "chosen", folder)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default), sparkContext=context)


def test_the_setting_of_the_session_is_used():
    spark = session("hdfs:///shared", master="yarn")
    assert shared_folder(spark) == "hdfs:///shared" == spark.sparkContext.chosen
    assert shared_folder(session(chosen="/given", master="yarn")) == "/given"


def test_only_a_local_master_goes_without():
    spark = session()
    assert shared_folder(spark) == spark.sparkContext.chosen == shared_folder(spark)
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://local:7077"):
        with pytest.raises(ValueError):
            shared_folder(session(master=master))
    for master in ("local", "local[*]", "local[4,2]"):
        assert shared_folder(session(master=master))


def test_a_run_deletes_its_tables(spark):
    def table(name):
        path = scratch_path(spark, name)
        spark.range(3).write.parquet(path)
        return path

    outside = table("before")
    with scratch_run(spark) as folder:
        inside = table("inside")
        assert inside.startswith(folder) and spark.read.parquet(inside).count() == 3
        with scratch_run(spark):
            inner = table("inner")
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(inner)
        assert spark.read.parquet(inside).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(inside)
    with pytest.raises(RuntimeError), scratch_run(spark):
        lost = table("lost")
        raise RuntimeError("a failing job")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(lost)
    assert spark.read.parquet(outside).count() == 3 and not scratch_path(spark, "after").startswith(folder)
