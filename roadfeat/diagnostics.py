"""Row counts of a run, gathered in the same pass as the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


class Diagnostics:
    """Named observations; values are there after an action has run the frames."""

    def __init__(self) -> None:
        self._observations: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str, metrics: dict[str, Column]) -> DataFrame:
        observation = Observation()
        self._observations[name] = observation
        return df.observe(observation, *[c.alias(k) for k, c in metrics.items()])

    def names(self) -> list[str]:
        return list(self._observations)

    def __getitem__(self, name: str) -> dict:
        return self._observations[name].get


def watch(diagnostics: Diagnostics | None, df: DataFrame, name: str, metrics: dict[str, Column]) -> DataFrame:
    return df if diagnostics is None else diagnostics.watch(df, name, metrics)
