"""Configured jobs: inputs, operators, validations and targets from one definition."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from brookweave.registry import run_pipeline
from brookweave.sources import readers, sinks
from brookweave.sources import tables as tables_


@dataclass(frozen=True)
class Output:
    name: str
    input_name: str | None = None
    input_names: Sequence[str] = ()
    transformations: Sequence[Mapping[str, Any]] = ()
    validations: Sequence[Mapping[str, Any]] = ()
    target: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.input_name and not self.input_names:
            raise ValueError("an output needs input_name or input_names")
        if "kind" in self.target:
            tables_.check_target(self.target)


@dataclass(frozen=True)
class Job:
    inputs: Sequence[readers.Input]
    outputs: Sequence[Output]
    params: Mapping[str, Any] = field(default_factory=dict)
    cob_date: str | None = None


def parse(config: str | Mapping[str, Any]) -> Job:
    raw = json.loads(config) if isinstance(config, str) else config

    def one(i: Mapping[str, Any]) -> readers.Input:
        i = dict(i)
        i["serde"] = readers.Serde(**i.get("serde", {}))
        i["partition"] = readers.Partition(**i.get("partition", {}))
        return readers.Input(**i)

    return Job([one(i) for i in raw["input"]], [Output(**o) for o in raw["output"]], raw.get("params", {}), raw.get("cob_date"))


def run(spark: SparkSession, job: Job, tables: Mapping[str, DataFrame] | None = None, write: bool = True) -> dict[str, DataFrame]:
    """Runs every output; returns its frame by name. ``write=False`` leaves the targets alone."""
    out = {}
    for o in job.outputs:
        names = [o.input_name] if o.input_name else list(o.input_names)
        specs = [i for i in job.inputs if i.name in names]
        if len(specs) != len(names):
            raise ValueError(f"output {o.name} needs the inputs {names}")
        frames = {k: v for k, v in readers.read_all(spark, specs).items() if v is not None}
        if not frames:
            continue
        df = frames[names[0]] if names[0] in frames else next(iter(frames.values()))
        context = {"tables": {**frames, **(tables or {})}, "cob_date": job.cob_date, **job.params}
        out[o.name] = run_pipeline(df, o.transformations, o.validations, {k: v for k, v in context.items() if v is not None})
        if write and o.target:
            if "kind" in o.target:
                tables_.merge_output(spark, out[o.name], o.target)
            else:
                sinks.write_files(out[o.name], **o.target)
    return out
