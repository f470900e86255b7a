"""Submitting independent Spark jobs side by side."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(*jobs: Callable[[], object]) -> list:
    """Results in order; the first failure is raised once all have ended.

    One table's last tasks then no longer leave the cluster idle for the next.
    Job group, pool and other local properties of the caller hold for all.
    """
    # A thread that was started here has no active session of its own.
    session = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    inherit = inheritable_thread_target(session)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inherit(job)) for job in jobs]
    return [job.result() for job in running]
