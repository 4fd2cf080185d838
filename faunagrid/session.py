"""Spark sessions and settings for the engine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

#: Results do not depend on these but for the time zone and ANSI errors.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def create(master: str | None = None, app: str = "faunagrid", settings: Mapping[str, str] | None = None) -> SparkSession:
    """A session with the engine's settings and others."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | dict(settings or {}))
    return (builder.master(master) if master else builder).getOrCreate()


def read_anonymously(spark: SparkSession, bucket: str, region: str | None = None) -> None:
    """Lets one s3a bucket be read without credentials (the S3A connector must be on the class path)."""
    spark.conf.set(f"fs.s3a.bucket.{bucket}.aws.credentials.provider", "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider")
    if region:
        spark.conf.set(f"fs.s3a.bucket.{bucket}.endpoint.region", region)
