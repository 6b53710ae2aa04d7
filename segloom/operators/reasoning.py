"""Extension points: reasoners and annotation rounds with functions handed in, drivers by name, configurations from tables of values."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import fields, is_dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string


def annotate(rows: DataFrame, keys: Sequence[str], writer: Callable, critics: dict[str, Callable], rounds: int, draft: str) -> DataFrame:
    """(keys, accepted, draft, problems): each row drafted until no critic objects, or the rounds are over.

    writer(row, number, feedback) gives a draft of type `draft`; critics by name give an objection or None; feedback maps names to the
    objections to the draft before. accepted is the round, null if none passed; draft the last one; problems the last objections.
    """
    schema = ", ".join([f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys] + ["accepted int", f"draft {draft}", "problems map<string,string>"])
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                feedback: dict[str, str] = {}
                for number in range(1, rounds + 1):
                    text = writer(row, number, feedback)
                    feedback = {name: said for name, critic in critics.items() if (said := critic(text, row)) is not None}
                    if not feedback:
                        break
                out.append({**{k: row[k] for k in keys}, "accepted": None if feedback else number, "draft": text, "problems": list(feedback.items())})
            yield pa.RecordBatch.from_pylist(out, schema=target)

    return rows.mapInArrow(run, schema)


def load_driver(name: str, needs: Sequence[str]) -> dict[str, Callable]:
    """Functions `needs` of a module given by its dotted name; one that is missing or cannot be called is an error."""
    module = importlib.import_module(name)
    lacking = [n for n in needs if not callable(getattr(module, n, None))]
    if lacking:
        raise TypeError(f"{name} lacks {lacking}")
    return {n: getattr(module, n) for n in needs}


def configured(default, values: dict):
    """A configuration with some of its values replaced; unknown names, and values of another kind, are errors."""
    if not is_dataclass(default):
        raise TypeError("a configuration is a dataclass")
    kinds = {f.name: type(getattr(default, f.name)) for f in fields(default)}
    for k, v in values.items():
        if k not in kinds:
            raise KeyError(f"{type(default).__name__} has no {k!r}")
        if not isinstance(v, kinds[k]) and not (kinds[k] is float and isinstance(v, int) and not isinstance(v, bool)):
            raise TypeError(f"{k} is a {kinds[k].__name__}")
    return replace(default, **values)
