"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "tickerpulse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the settings every job here relies on.

    Executor count, cores and memory belong to ``spark-submit``.  The number of shuffle
    partitions is only an upper bound for batch work (AQE merges small ones), so on a cluster
    leave it unset here and size it with the data.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Articles are long: keep the batches sent to Python scorers moderate.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
