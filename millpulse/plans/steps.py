"""Independent Spark jobs of one session side by side, by their real dependencies.

Each step runs in a thread of its own that inherits the session's properties and
a scheduler pool named after it (pools share the executors where
``spark.scheduler.mode`` is FAIR).  Spark plans and runs the jobs; this only waits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Step = tuple[Sequence[str], Callable[[dict], object]]


class StepsFailed(RuntimeError):
    """Some steps failed: ``errors`` by step, ``done`` results of the others, ``skipped`` their dependants."""

    def __init__(self, errors: dict[str, BaseException], done: dict, skipped: list[str]):
        super().__init__("; ".join(f"{k}: {v}" for k, v in errors.items()) + (f" (not run: {', '.join(skipped)})" if skipped else ""))
        self.errors, self.done, self.skipped = errors, done, skipped


def run_steps(spark: SparkSession, steps: dict[str, Step], at_once: int = 4) -> dict:
    """Results by step.  A step gets the results so far, those it depends on among them.

    A failing step stops its dependants only; the others finish before ``StepsFailed``.
    """
    order = TopologicalSorter({name: needs for name, (needs, _) in steps.items()})
    order.prepare()
    done: dict = {}
    errors: dict[str, BaseException] = {}

    def run(name: str):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        spark.sparkContext.setLocalProperty("spark.job.description", name)
        return steps[name][1](done)

    with ThreadPoolExecutor(at_once) as threads:
        running = {}
        while order.is_active():
            for name in order.get_ready():
                running[threads.submit(inheritable_thread_target(spark)(run), name)] = name
            if not running:
                break  # only dependants of failed steps are left
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if (error := future.exception()) is not None:
                    errors[name] = error
                else:
                    done[name] = future.result()
                    order.done(name)
    if errors:
        raise StepsFailed(errors, done, [n for n in steps if n not in done and n not in errors])
    return done
