"""Where jobs may write: the shared folder the cluster names, never a folder of one machine."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. A local-mode session without one gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="footfall-")
        atexit.register(shutil.rmtree, _LOCAL_ROOTS[app], ignore_errors=True)
    return _LOCAL_ROOTS[app]


def application_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/footfall/{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A folder no earlier job has used."""
    return f"{application_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def side_by_side(work: Callable, items: Iterable, at_once: int = 4) -> list:
    """``work`` on every item, a few Spark jobs at a time: one job's last tasks leave cores the next can use."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(work, items))
