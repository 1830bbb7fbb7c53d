"""Shared folders and file access."""

import pytest

from quayside import session
from quayside.sources import files


class _Session:
    """Just the settings `shared_root` looks at."""

    def __init__(self, named=None, current=None, master="local[2]"):
        self.master, self.named, self.current, self.sparkContext = master, named, current, self
        self.conf = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_shared_root():
    assert session.shared_root(_Session("hdfs://c/x/")) == "hdfs://c/x"
    assert session.shared_root(_Session(None, "/mnt/shared")) == "/mnt/shared"
    own = _Session()
    assert session.shared_root(own) == own.current == session.shared_root(own)
    for master in ("spark://host:7077", "local-cluster[3,2,1024]", "yarn"):  # no folder of one machine there
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_root(_Session(master=master))


def test_new_folders_differ(spark):
    assert session.new_folder(spark, "a") != session.new_folder(spark, "a")


def test_files(tmp_path):
    folder = tmp_path / "quayside" / "x"
    for path in (f"{folder}/a.gz", f"file:{folder}/b", f"file://{folder}/c"):
        files.write_bytes(path, b"data")
        with files.open_seekable(path) as f:
            assert f.read() == b"data"
    files.remove_folder(str(folder))
    assert not folder.exists()
    with pytest.warns(UserWarning, match="not removed"):
        files.remove_folder(str(folder))
    with pytest.raises(ValueError):
        files.remove_folder(str(tmp_path / "other"))


def test_settings_are_on(spark):
    assert all(spark.conf.get(k) == v for k, v in session.RUNTIME_CONF.items())


def test_whole_texts_are_decoded_some_rows_at_a_time(spark, tmp_path):
    spark.range(4096).selectExpr("repeat('word ', 100) AS text").coalesce(1).write.parquet(str(tmp_path / "texts"))
    df = spark.read.parquet(str(tmp_path / "texts")).select("text")
    assert len(df.collect()) == 4096
    to_rows = df._jdf.queryExecution().executedPlan().children().head()  # below the generated method
    assert to_rows.metrics().apply("numInputBatches").value() >= 8
