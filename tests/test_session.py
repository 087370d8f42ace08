"""The shared scratch folder."""

import pathlib

import pytest
from matchmill import session as M


def test_cuts_are_written_to_the_shared_folder(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(M, "shared_dir", lambda _: str(tmp_path))
    assert M.scratch_path(spark, "x").startswith(f"{tmp_path}/matchmill/{spark.sparkContext.applicationId}/x-")
    cut = M.cut_lineage(spark.range(10), "ten")
    assert cut.count() == 10 and cut.inputFiles()[0].startswith(f"file://{tmp_path}")
    assert any(pathlib.Path(tmp_path).rglob("*.parquet"))
    M.clear_scratch(spark)
    assert not any(pathlib.Path(tmp_path).rglob("*.parquet"))


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf({k.replace("__", "."): v for k, v in conf.items()})


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        M.shared_dir(_Session(spark__master="yarn"))
    assert M.shared_dir(_Session(spark__master="yarn", spark__checkpoint__dir="hdfs:///c/")) == "hdfs:///c"
    local = _Session(spark__master="local[2]")
    assert M.shared_dir(local) == M.shared_dir(local)


def test_a_written_cut_leaves_no_shuffle_files(spark):
    import time

    from matchmill.session import cut_lineage, discard

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    rows = spark.range(100_000).repartition(3, "id")
    cut = cut_lineage(rows, "freed")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert cut.count() == rows.count() == 100_000  # the rows can be shuffled again
    folder = cut.inputFiles()[0].rpartition("/")[0].partition(":")[2]
    discard(cut)
    assert not pathlib.Path("/" + folder.lstrip("/")).exists()
