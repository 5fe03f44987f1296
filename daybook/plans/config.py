"""Settings of a configured multi-table import, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import zip_longest

from daybook.operators.incremental import DELTA_MODES, UPDATE_TYPES
from daybook.operators.tables import derived_partition_names


@dataclass(frozen=True)
class TableTask:
    source_table: str
    target_table: str
    source_delta_fields: tuple[str, ...] = ()
    target_delta_fields: tuple[str, ...] = ()
    partition_field: str | None = None


@dataclass(frozen=True)
class ImportConfig:
    """Aligned lists of source tables, target tables, delta and partition fields.

    A delta entry may name several fields, joined by ``-``; a partition entry reads
    ``column-year``, ``column-month`` or ``column-day``.
    """

    update_type: str
    source_tables: list[str]
    target_tables: list[str]
    source_delta_fields: list[str] = field(default_factory=list)
    target_delta_fields: list[str] = field(default_factory=list)
    partition_fields: list[str] = field(default_factory=list)
    delta_mode: str = ""
    keyed_target: bool = False

    def __post_init__(self) -> None:
        if self.update_type not in UPDATE_TYPES:
            raise ValueError(f"update type is one of {UPDATE_TYPES}, not {self.update_type!r}")
        if self.delta_mode and self.delta_mode not in DELTA_MODES:
            raise ValueError(f"delta mode is one of {DELTA_MODES}, not {self.delta_mode!r}")
        if self.keyed_target and self.partition_fields:
            raise ValueError("a keyed target has no partition fields")
        self._same_length("target_tables")
        if self.update_type in ("delta", "deltapart"):
            self._same_length("source_delta_fields")
            self._same_length("target_delta_fields")
        if self.update_type in ("fullpart", "deltapart"):
            self._same_length("partition_fields")
            for entry in self.partition_fields:
                derived_partition_names(entry)

    def _same_length(self, name: str) -> None:
        if len(getattr(self, name)) != len(self.source_tables):
            raise ValueError(f"{name} and source_tables differ in length")

    def tasks(self) -> list[TableTask]:
        rows = zip_longest(
            self.source_tables, self.target_tables, self.source_delta_fields,
            self.target_delta_fields, self.partition_fields,
        )
        return [
            TableTask(
                source, target,
                tuple(source_delta.split("-")) if source_delta else (),
                tuple(target_delta.split("-")) if target_delta else (),
                partition,
            )
            for source, target, source_delta, target_delta, partition in rows
        ]
