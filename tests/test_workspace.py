import pytest

from tickerpulse.workspace import as_table, scratch_path, scratch_root


class Session:
    """Only the configuration of a session."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_shared_folder_comes_from_the_session():
    assert scratch_root(Session(spark_checkpoint_dir="s3a://b/c/")) == "s3a://b/c"
    first, second = (scratch_path(Session(spark_checkpoint_dir="/x"), "t") for _ in range(2))
    assert first.startswith("/x/tickerpulse/t-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        scratch_root(Session(spark_master="yarn"))


def test_a_local_session_gets_one_folder():
    local = Session(spark_master="local[4]")
    assert scratch_root(local) == scratch_root(local)


def test_stored_table_keeps_schema_and_rows(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, None)], "id long, words array<string>")
    stored = as_table(df, "t")
    assert stored.schema == df.schema
    assert sorted(stored.collect()) == sorted(df.collect())
