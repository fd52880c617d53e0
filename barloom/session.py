"""Session construction, and the settings this library relies on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Runtime settings every operator is written for. Dates are UTC dates, bad
# arithmetic raises instead of wrapping, and the shuffle is re-planned from
# measured sizes: small partitions are merged, hot ones are split.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    *,
    path_style: bool = True,
    tls: bool = False,
) -> dict[str, str]:
    """S3A settings; the connector itself comes from the user's classpath."""
    scheme = "https" if tls else "http"
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": f"{scheme}://{endpoint}",
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }


def delta_conf() -> dict[str, str]:
    """Extension and catalog for ``fmt="delta"`` when its jar is present."""
    return {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    }


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with ``RUNTIME_CONF``; ``conf`` adds to it or overrides it."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set ``RUNTIME_CONF`` on a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark
