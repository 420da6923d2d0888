"""Stored models: immutable versions and a leader that is named last.

A version is a folder of its own, written once. The leader is the highest numbered
pointer, a small file written whole after its version, so a reader that resolves it
loads a complete model, also while another one is being saved; a death during a save
leaves the old leader. Scored rows carry the version that scored them.
"""

from __future__ import annotations

import os
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..session import list_names, read_small, remove_path, write_small

DIGITS = 12


class ModelStore:
    """Versions of one model in the shared folder ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _pointers(self) -> list[int]:
        return sorted(int(n[:DIGITS]) for n in list_names(
            self.spark, os.path.join(self.path, "leaders")) if n.endswith(".txt"))

    def _pointer(self, number: int) -> str:
        return os.path.join(self.path, "leaders", f"{number:0{DIGITS}}.txt")

    def _folder(self, number: int) -> str:
        return os.path.join(self.path, "versions", read_small(self.spark, self._pointer(number)))

    def save(self, model: PipelineModel) -> int:
        """Writes the model as the next version and makes it the leader."""
        number = max(self._pointers(), default=0) + 1
        name = f"{number:0{DIGITS}}-{uuid.uuid4().hex[:8]}"
        model.save(os.path.join(self.path, "versions", name))
        write_small(self.spark, self._pointer(number), name)
        return number

    def leader(self) -> int | None:
        """Number of the current version; None before the first."""
        return max(self._pointers(), default=None)

    def load(self, number: int | None = None) -> tuple[PipelineModel, int]:
        """(model, version): the leader, or an older version."""
        number = self.leader() if number is None else number
        if number is None:
            raise FileNotFoundError(f"no model in {self.path}")
        return PipelineModel.load(self._folder(number)), number

    def keep(self, last: int) -> None:
        """Removes all but the last versions and the rests of dead saves."""
        held = self._pointers()[-last:]
        names = {os.path.basename(self._folder(n)) for n in held}
        for n in self._pointers()[:-last]:
            remove_path(self.spark, self._pointer(n))
        for name in list_names(self.spark, os.path.join(self.path, "versions")):
            if name not in names:
                remove_path(self.spark, os.path.join(self.path, "versions", name))
