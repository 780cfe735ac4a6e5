"""Session defaults for running outside a managed cluster."""

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "vitals", **conf) -> SparkSession:
    """A local session as used by tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def drop_shuffles(spark: SparkSession) -> None:
    """Has the driver's collector run: Spark deletes the files of a shuffle once the collector finds that nothing refers to it.

    For the beginning of steps that need room on disk; a job that has just
    ended is still referred to for a moment.
    """
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession) -> str | None:
    """Folder all executors reach, as the cluster names it; None when unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
