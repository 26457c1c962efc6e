from __future__ import annotations

import glob

import pytest

from tessera.llm import common


def folders(spark) -> set[str]:
    return set(glob.glob(common.prepare(spark).removeprefix("file://") + "/*"))


def test_what_is_made_inside_goes(spark):
    before = folders(spark)
    path = common.fresh_path(spark, "kept")
    with common.scratch(spark):
        middle = common.saved(spark.range(5), "middle")
        out = common.keep(middle, "out", path)
        assert len(folders(spark) - before) == 2
    assert folders(spark) - before == {path.removeprefix("file://")} and out.count() == 5
    since = common._made.index(path)
    common.clean_up(spark, since)
    assert folders(spark) == before


def test_a_failure_leaves_nothing(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), common.scratch(spark):
        common.saved(spark.range(5))
        1 / 0  # noqa: B018
    assert folders(spark) == before


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return None if key == "spark.checkpoint.dir" else "2000"

    class NoDirectory:
        def isDefined(self):
            return False

    class Scala:
        def getCheckpointDir(self):
            return NoDirectory()

    class Java:
        def sc(self):
            return Scala()

    class Context:
        environment: dict = {}
        applicationId, master, _jsc = spark.sparkContext.applicationId, "spark://somewhere:7077", Java()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.prepare(Session())


def test_workers_get_the_package(spark):
    import pyarrow as pa

    def run(batches):
        import tessera.llm.common as there

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([there.__file__] * b.num_rows)], names=["path"])

    common.prepare(spark)
    assert any(f.endswith(".zip") for f in spark.sparkContext._python_includes)
    assert spark.range(1).mapInArrow(run, "path string").first()["path"]
