"""Chains of filters, pluggable models and tools: plain functions over DataFrames with typed settings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[DataFrame, "Valves"], DataFrame]


@dataclass(frozen=True)
class Valves:
    """Settings of a filter; a user's override its own."""

    priority: int = 0
    options: dict[str, object] = field(default_factory=dict)

    def of(self, user: dict[str, object] | None) -> Valves:
        return replace(self, options={**self.options, **(user or {})})


@dataclass(frozen=True)
class Filter:
    id: str
    valves: Valves = Valves()
    inlet: Step | None = None
    outlet: Step | None = None
    everywhere: bool = False
    active: bool = True


def chosen(filters: list[Filter], ids: set[str]) -> list[Filter]:
    """Active filters that are global or named, by priority, then id."""
    return sorted((f for f in filters if f.active and (f.everywhere or f.id in ids)), key=lambda f: (f.valves.priority, f.id))


def run(df: DataFrame, filters: list[Filter], stage: str, user: dict[str, dict] | None = None) -> DataFrame:
    """The stage ("inlet" or "outlet") of each filter in turn; each extends the plan and nothing runs yet."""
    for f in filters:
        step = getattr(f, stage)
        if step:
            df = step(df, f.valves.of((user or {}).get(f.id)))
    return df


@dataclass(frozen=True)
class Model:
    """A vectorised function of one text column under a name; a manifold is several."""

    id: str
    run: Callable[[pd.Series], pd.Series]
    returns: str = "string"

    def __call__(self, column: Column) -> Column:
        return F.pandas_udf(self.run, self.returns)(column)


def route(df: DataFrame, models: list[Model], name: str, prompt: str, out: str = "reply") -> DataFrame:
    """Each row through the model that its `name` column asks for; null where there is none."""
    reply = F.lit(None).cast(models[0].returns if models else "string")
    for m in models:
        reply = F.when(F.col(name) == m.id, m(F.col(prompt))).otherwise(reply)
    return df.withColumn(out, reply)


@dataclass(frozen=True)
class Tool:
    """A function that returns a DataFrame, with the JSON schema of its arguments."""

    name: str
    run: Callable[..., DataFrame]
    parameters: dict[str, str] = field(default_factory=dict)

    def spec(self) -> dict:
        return {"name": self.name, "parameters": {"type": "object", "properties": {k: {"type": v} for k, v in self.parameters.items()}, "required": list(self.parameters)}}

    def __call__(self, **arguments: object) -> DataFrame:
        lacking = set(self.parameters) - set(arguments)
        if lacking:
            raise ValueError(f"missing arguments: {sorted(lacking)}")
        return self.run(**arguments)
