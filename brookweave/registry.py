"""Named operators and pipelines of them.

A pipeline is a list of ``{"name": ..., parameter: ...}``. An operator is a function ``(df, **parameters) -> df``;
parameters that a step does not give keep their default, unknown ones are refused before anything is planned.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame

_OPERATORS: dict[str, Callable[..., DataFrame]] = {}
_RULES: dict[str, Callable[..., DataFrame]] = {}
_SYNONYMS: dict[str, Mapping[str, str]] = {}


def operator(*names: str, synonyms: Mapping[str, str] | None = None) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Registers an operator by its own name and ``names``; ``synonyms`` are other names of its parameters in steps."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        for name in {f.__name__, *names}:
            _OPERATORS[name] = f
            _SYNONYMS[name] = synonyms or {}
        return f

    return add


def rule(*names: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Registers a validation; validations are applied after all operators."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        for name in names or (f.__name__,):
            _RULES[name] = f
        return f

    return add


def load() -> None:
    """Import the modules that register operators."""
    from brookweave.operators import casting, dedupe, joins, masking, projections, reshaping, textual, validations  # noqa: F401


def names() -> tuple[list[str], list[str]]:
    load()
    return sorted(_OPERATORS), sorted(_RULES)


def _bind(step: Mapping[str, Any], known: Mapping[str, Callable[..., DataFrame]], context: Mapping[str, Any]):
    name = step.get("name")
    if name not in known:
        raise ValueError(f"unknown step {name!r}")
    f = known[name]
    accepted = inspect.signature(f).parameters
    given = {_SYNONYMS.get(name, {}).get(k, k): v for k, v in step.items() if k != "name"}
    if extra := set(given) - set(accepted):
        raise ValueError(f"{name} does not take {sorted(extra)}")
    given |= {k: v for k, v in context.items() if k in accepted and k not in given}
    if lacking := [k for k, p in list(accepted.items())[1:] if p.default is p.empty and k not in given and p.kind != p.VAR_KEYWORD]:
        raise ValueError(f"{name} needs {lacking}")
    return f, given


def run_pipeline(
    df: DataFrame,
    steps: Iterable[Mapping[str, Any]],
    validations: Iterable[Mapping[str, Any]] = (),
    context: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Fold operators, then validations, over ``df``. ``context`` offers values by parameter name (``cob_date``,
    ``tables``, ``key`` ...) to the operators that take them. The whole list is checked before the first step."""
    load()
    context = context or {}
    bound = [_bind(s, _OPERATORS, context) for s in steps] + [_bind(s, _RULES, context) for s in validations]
    for f, given in bound:
        df = f(df, **given)
    return df
