"""Run independent jobs of one session at the same time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Jobs submitted at once. Spark shares its executors among them; more threads only hold more plans.
AT_ONCE = 4

# Fixed value: the local property that names a job's scheduler pool.
_POOL = "spark.scheduler.pool"


def run_at_once(
    spark: SparkSession,
    steps: Mapping[str, Callable[[dict], object]],
    after: Mapping[str, Sequence[str]] | None = None,
    at_once: int = AT_ONCE,
) -> dict[str, object]:
    """Run all steps, each when those it comes `after` are done, and return their results by name.

    A step gets the results so far. Each runs in a thread with the session's local properties, in a pool
    of its own, which lets small steps pass large ones where the cluster schedules fairly. The first failure
    cancels what runs, starts nothing more, and is raised.
    """
    after = after or {}
    unknown = [name for names in after.values() for name in names if name not in steps]
    if unknown:
        raise ValueError(f"no such step: {', '.join(unknown)}")
    context, mark = spark.sparkContext, f"at_once_{uuid.uuid4().hex}"
    done: dict[str, object] = {}
    waiting = list(steps)
    running: dict[Future, str] = {}

    def run(name: str) -> object:
        context.setLocalProperty(_POOL, name)
        context.addJobTag(mark)
        return steps[name](dict(done))

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        while waiting or running:
            ready = [n for n in waiting if all(needed in done for needed in after.get(n, ()))]
            if not ready and not running:
                raise ValueError(f"steps wait for each other: {', '.join(waiting)}")
            for name in ready:
                waiting.remove(name)
                # What is staged in a thread belongs to the scope that is open here.
                running[pool.submit(copy_context().run, inheritable_thread_target(spark)(run), name)] = name
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            failed = next((f for f in ended if f.exception()), None)
            if failed:
                for other in running:
                    other.cancel()
                context.cancelJobsWithTag(mark)
                # A step between two jobs has none to cancel; the next one it starts is cancelled, too.
                while not all(f.done() for f in running):
                    wait(running, timeout=0.2)
                    context.cancelJobsWithTag(mark)
                raise failed.exception()
            for future in ended:
                done[running.pop(future)] = future.result()
    return done
