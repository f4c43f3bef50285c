import glob

import pytest

from tillstone import session as S


def test_cut_frames_live_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    frame = S.cut_lineage(spark.range(10).toDF("n"))
    assert S.shared_dir(spark) == named and glob.glob(f"{named}/tillstone-*/cut-*")
    assert frame.count() == 10 and frame.dtypes == [("n", "bigint")]
    assert "Range" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_empty_frames_can_be_cut(spark):
    assert S.cut_lineage(spark.createDataFrame([], "a INT, b STRING")).collect() == []


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Fake:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_dir(Fake())
