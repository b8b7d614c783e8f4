"""A time limit around Spark actions."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import SparkSession

from partloom.errors import QueryTimeout
from partloom.sources.storage import inheriting

TEN_MINUTES = timedelta(minutes=10)


@contextmanager
def time_limit(spark: SparkSession, timeout: timedelta | None):
    """Cancel every job the block starts once ``timeout`` has passed, and raise QueryTimeout.

    The limit holds for the block as a whole: one that ends well, but late, is an error, too.
    """
    if timeout is None:
        yield
        return
    context = spark.sparkContext
    tag = f"limit-{uuid.uuid4().hex}"
    done = threading.Event()
    expired = threading.Event()

    def watch():
        if done.wait(timeout.total_seconds()):
            return
        expired.set()
        # Again and again: the block may be between two jobs.
        while True:
            context.cancelJobsWithTag(tag)
            if done.wait(0.5):
                return

    watcher = threading.Thread(target=watch, daemon=True)
    context.addJobTag(tag)
    watcher.start()
    try:
        yield
        if expired.is_set():
            raise QueryTimeout(f"not done after {timeout}")
    except QueryTimeout:
        raise
    except Exception as error:
        if expired.is_set():
            raise QueryTimeout(f"cancelled after {timeout}") from error
        raise
    finally:
        done.set()
        watcher.join()
        context.removeJobTag(tag)


#: Seconds that a call may take to end once its jobs are cancelled.
GRACE = 0.5


def limited(spark: SparkSession, timeout: timedelta | None, call: Callable):
    """What ``call`` returns, or QueryTimeout soon after ``timeout`` whatever it is at.

    Jobs are cancelled. Phases of the driver's own, such as analysis, a listing or a call to a catalog,
    know no cancelling: the thread that is in one is left behind, and any job it comes to start is
    cancelled as well.
    """
    if timeout is None:
        return call()
    told: list = []

    def run():
        try:
            with time_limit(spark, timeout):
                told.append((call(), None))
        except BaseException as error:  # noqa: BLE001
            told.append((None, error))

    worker = threading.Thread(target=inheriting(spark, run), daemon=True)
    worker.start()
    worker.join(timeout.total_seconds())
    if worker.is_alive():
        worker.join(GRACE)
    if not told:
        raise QueryTimeout(f"not done after {timeout}, and left behind in a phase that cannot be cancelled")
    result, error = told[0]
    if error is not None:
        raise error
    return result
