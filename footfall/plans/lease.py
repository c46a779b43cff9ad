"""One load at a time: a lease on a warehouse, a file that only one job can create."""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import SparkSession

from footfall.sources import tables

_FILE = "_lease/current.json"


class Busy(RuntimeError):
    """Another load holds the lease."""


class Lost(RuntimeError):
    """The lease went to another load, which has discarded what this one wrote."""


def acquire(spark: SparkSession, root: str, owner: str, seconds: float) -> str:
    """Take the lease; the token that proves it.

    One that has not been renewed for ``seconds`` belongs to a load that died and is taken over, and so is that of an
    earlier attempt of the same ``owner``, which its scheduler starts again only once it is over.
    """
    path, token = f"{root}/{_FILE}", uuid4().hex
    text = json.dumps({"owner": owner, "token": token})
    while not tables.create_once(spark, path, text):
        holder, age = holds(spark, root), tables.age(spark, path)
        if age is None:
            continue  # given back just now
        if holder.get("owner") != owner and age < seconds:
            raise Busy(f"load {holder.get('owner')} runs; its lease is {age:.0f} s old")
        tables.delete(spark, path)
    if holds(spark, root).get("token") != token:
        raise Busy("another load took the lease over at the same time")
    return token


def holds(spark: SparkSession, root: str) -> dict:
    """Owner and token of the lease, empty where nobody holds it."""
    try:
        return json.loads(tables.text_of(spark, f"{root}/{_FILE}") or "{}")
    except ValueError:  # its writer died over it
        return {}


def renew(spark: SparkSession, root: str, token: str) -> None:
    """Prove the lease and make it new; ``Lost`` if another load has it."""
    if holds(spark, root).get("token") != token:
        raise Lost("the lease has gone to another load")
    tables.touch(spark, f"{root}/{_FILE}")


def release(spark: SparkSession, root: str, token: str) -> None:
    if holds(spark, root).get("token") == token:
        tables.delete(spark, f"{root}/{_FILE}")
