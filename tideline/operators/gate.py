"""Writes that are published only if what was measured on the way allows it."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation

from tideline import storage


class Gate(NamedTuple):
    """A metric's name, its aggregate over the rows written, and the largest value that lets the batch pass (null counts as 0)."""

    name: str
    metric: Column
    limit: float


class Verdict(NamedTuple):
    published: bool
    metrics: dict[str, float | None]
    failed: list[str]


def gated_write(rows: DataFrame, path: str, gates: list[Gate]) -> Verdict:
    """Write rows beside their place and rename them into it if no metric passes its limit.

    The metrics are observed by the write itself: there is no second scan, and what is judged is what was written. A batch that
    fails stays unpublished, under <path>__rejected-<id>, for inspection; an earlier batch at the path makes this an error.
    """
    spark = rows.sparkSession
    if storage.exists(spark, path):
        raise FileExistsError(path)
    aside = f"{path}__staged-{uuid.uuid4().hex}"
    seen = Observation()
    rows.observe(seen, *[g.metric.alias(g.name) for g in gates]).write.parquet(aside)
    metrics = dict(seen.get)
    failed = [g.name for g in gates if (metrics[g.name] or 0) > g.limit]
    storage.move(spark, aside, aside.replace("__staged-", "__rejected-") if failed else path)
    return Verdict(not failed, metrics, failed)
