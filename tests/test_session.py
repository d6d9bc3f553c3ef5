import os
from types import SimpleNamespace

import pytest

from newstide.session import release, work_folder


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_folders_are_fresh_and_below_the_shared_folder():
    first, second = (work_folder(session("yarn", "/shared/"), "x") for _ in range(2))
    assert first != second and first.startswith("/shared/x-")


def test_only_a_local_session_may_use_a_temporary_folder():
    assert work_folder(session("local[2]"), "x") != work_folder(session("local[2]"), "x")
    with pytest.raises(ValueError):
        work_folder(session("yarn"), "x")


def test_released_folders_are_gone(spark):
    folder = work_folder(spark, "release")
    spark.range(3).write.parquet(folder)
    assert spark.read.parquet(folder).count() == 3
    release(spark)
    assert not os.path.exists(folder)
    release(spark)
