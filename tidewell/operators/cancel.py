"""Cancelling: work under a tag, and a guard that stops what fails or is interrupted, and nothing else."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from ..sources import http


@contextmanager
def cancellable(spark: SparkSession, tag: str | None = None):
    """Jobs started within run under the tag that this gives; an exception interrupts them."""
    tag = tag or f"tidewell-{uuid.uuid4().hex}"
    spark.addTag(tag)
    try:
        yield tag
    except BaseException:
        spark.interruptTag(tag)
        raise
    finally:
        spark.removeTag(tag)


@contextmanager
def remote_query(url: str, query: str, token: str | None = None):
    """An id for a server's query; the server is told to cancel it only if the block fails."""
    query_id = http.new_query_id()
    try:
        yield query_id
    except BaseException:
        http.cancel(url, query, query_id, token)
        raise
