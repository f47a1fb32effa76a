"""What a feature family is made of."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from payscope.functions.text import Matcher
from payscope.operators.frequency import KeyStats
from payscope.options import Options

Layer = dict[str, Column]


class Columns:
    """Columns of one family by their local name.

    Inside a plan every computed column carries the prefix of its family, so that all families can
    stand side by side on one row.
    """

    def __init__(self, prefix: str):
        self._prefix = prefix

    def __getattr__(self, name: str) -> Column:
        return F.col(self._prefix + name)


@dataclass(frozen=True, eq=False)
class Family:
    """A set of features computed from one payment row and statistics of its key values.

    ``layers`` returns the computed columns in steps: a step may use the columns of the steps before
    it. ``outputs`` are the columns of the family on its own, ``final_outputs`` those it adds to the
    combined feature table; both map the output name to the computed column or, if there is no
    computed column of that name, to the payment column.
    """

    name: str
    inputs: tuple[str, ...]
    layers: Callable[[Columns, Matcher, Options], list[Layer]]
    outputs: dict[str, str]
    final_outputs: dict[str, str]
    stats: tuple[KeyStats, ...] = ()
    score: str | None = None

    @property
    def prefix(self) -> str:
        return f"__{self.name}_"

    def steps(self, options: Options, session: SparkSession) -> list[Layer]:
        return _steps(self, options, session.sparkContext.applicationId)

    def final_columns(self, available: Iterable[str]) -> list[str]:
        """The columns that the outputs in the combined table are taken from."""
        return [self._column(local, available) for local in self.final_outputs.values()]

    def _column(self, local: str, available: Iterable[str]) -> str:
        return self.prefix + local if self.prefix + local in available else local

    def select(
        self,
        available: Iterable[str] | dict[str, str],
        final: bool = False,
        only_if: str | None = None,
    ) -> list[str]:
        """Select expressions of the outputs, NULL where ``only_if`` does not hold.

        As text, because several hundred columns built one by one cost seconds of round trips.
        ``available`` may give the expression of a column that stands inside another one.
        """
        have = available if isinstance(available, dict) else {c: f"`{c}`" for c in available}
        outputs = self.final_outputs if final else self.outputs
        expressions = []
        for output, local in outputs.items():
            name = self._column(local, have)
            column = have.get(name, f"`{name}`")
            value = column if only_if is None else f"IF({only_if}, {column}, NULL)"
            expressions.append(f"{value} AS `{output}`")
        return expressions


@lru_cache(maxsize=128)
def _steps(family: Family, options: Options, application: str) -> list[Layer]:
    """Columns do not depend on the data, so one application builds those of a family once."""
    layers = family.layers(Columns(family.prefix), Matcher(options.match), options)
    return [{family.prefix + n: c for n, c in layer.items()} for layer in layers]


def same_names(*names: str) -> dict[str, str]:
    return {name: name for name in names}
