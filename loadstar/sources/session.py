"""Where a session keeps shared files, and the star it works on."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import SparkSession

from loadstar.sources.orders_star import derive_star
from loadstar.sources.warehouse import read_star, write_star
from loadstar.star import Star

_stars: dict[tuple[str, str], Star] = {}


def named_folder(spark: SparkSession) -> str | None:
    """The folder every executor can reach, where the cluster names one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else None


def shared_folder(spark: SparkSession) -> str:
    """The named folder, or in a local session a temporary one.

    Only a local session, where driver and tasks share one machine, may use a
    temporary folder.
    """
    folder = named_folder(spark)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder or tempfile.mkdtemp(prefix="loadstar-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def session_star(spark: SparkSession, path: str) -> Star:
    """The star over the tables in ``path``.

    Where the cluster names a shared folder, the star is written there once per
    application, partitioned by month, and every query reads that table: the
    wide joins run once instead of once per query, and a lost executor costs a
    re-read, not a rebuild. Elsewhere the star stays part of each plan.
    """
    key = (spark.sparkContext.applicationId, path)
    if key not in _stars:
        if named_folder(spark):
            digest = hashlib.sha256(path.encode()).hexdigest()[:12]
            target = new_folder(spark, f"star-{digest}")
            write_star(derive_star(spark, path, by_month=True), target)
            _stars[key] = read_star(spark, target)
        else:
            _stars[key] = derive_star(spark, path)
    return _stars[key]
