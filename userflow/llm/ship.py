"""The package for Python workers that start without it on their path."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

import userflow

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors once for each application, as ``--py-files``
    would: functions of it run there whatever folder the workers start in."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        home = os.path.dirname(os.path.dirname(os.path.abspath(userflow.__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="userflow-"), "userflow-package")
        context.addPyFile(shutil.make_archive(archive, "zip", home, "userflow"))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, for functions of this package."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
