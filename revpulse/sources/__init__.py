"""Where source rows come from and where results are written."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

from revpulse.schemas import ENTITIES


class Sources(Mapping):
    """The source entities of one snapshot, by name."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        unknown = sorted(set(frames) - set(ENTITIES))
        if unknown:
            raise ValueError(f"unknown source entities: {', '.join(unknown)}")
        self._frames = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)
