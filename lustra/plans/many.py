"""One cleansing recipe format applied to many tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from lustra.operators.silver import SilverSpec, build_silver


class TablesFailed(RuntimeError):
    """What went wrong, by table."""

    def __init__(self, errors: dict[str, Exception]):
        self.errors = dict(sorted(errors.items()))
        super().__init__("; ".join(f"{name}: {error}" for name, error in self.errors.items()))


@dataclass(frozen=True)
class TableJob:
    """A source table and its recipe."""

    name: str
    spec: SilverSpec


def plan_silver(jobs: Iterable[TableJob], read: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """The silver frame of every table; nothing runs yet."""
    return {job.name: build_silver(read(job.name), job.spec) for job in jobs}


def run_silver(
    jobs: Iterable[TableJob],
    read: Callable[[str], DataFrame],
    write: Callable[[str, DataFrame], None],
    at_once: int = 8,
) -> None:
    """Build and write every table, a few Spark jobs side by side.

    Small tables leave executors idle when written one by one. Every table is tried;
    those that fail, in planning or writing, are raised together at the end.
    """
    failed: dict[str, Exception] = {}

    def one(job: TableJob) -> None:
        try:
            write(job.name, build_silver(read(job.name), job.spec))
        except Exception as error:
            failed[job.name] = error

    with ThreadPoolExecutor(at_once) as pool:
        # the target carries the caller's job group and local properties into the thread
        list(pool.map(inheritable_thread_target(SparkSession.active())(one), jobs))
    if failed:
        raise TablesFailed(failed)
