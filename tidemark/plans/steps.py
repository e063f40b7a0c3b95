"""The pipeline's steps: names, inputs, outputs, groups; run in order, each after a check of its inputs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark.sources.readers import exists


@dataclass(frozen=True)
class Step:
    name: str
    run: Callable[[SparkSession], None]
    inputs: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()
    group: str = "all"


@dataclass
class Report:
    done: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)


def chosen(steps: Sequence[Step], requested: Iterable[str]) -> list[Step]:
    """Steps by name or group, in their own order; an unknown name is an error."""
    wanted = {x for r in requested for x in r.split(",") if x}
    known = {s.name for s in steps} | {s.group for s in steps} | {"all"}
    if wanted - known:
        raise ValueError("unknown steps: " + ", ".join(sorted(wanted - known)))
    return [s for s in steps if "all" in wanted or s.name in wanted or s.group in wanted]


def missing_inputs(spark: SparkSession, step: Step) -> list[str]:
    return [p for p in step.inputs if not exists(spark, p)]


def run(spark: SparkSession, steps: Sequence[Step], continue_on_error: bool = False) -> Report:
    report = Report()
    for step in steps:
        gone = missing_inputs(spark, step)
        try:
            if gone:
                raise FileNotFoundError(", ".join(gone))
            step.run(spark)
            report.done.append(step.name)
        except Exception as e:
            report.failed[step.name] = str(e)
            if not continue_on_error:
                raise
    return report
