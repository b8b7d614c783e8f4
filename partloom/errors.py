"""Errors raised by the operators."""

from __future__ import annotations


class PipelineError(Exception):
    """Base of every error this package raises."""


class ConfigError(PipelineError, ValueError):
    """An option is missing, unknown or does not fit the table."""


class AlreadyExists(PipelineError):
    """A table, partition or location is there and the save mode forbids it."""


class NotFound(PipelineError):
    """A table, partition, location or query run is missing."""


class SchemaMismatch(PipelineError):
    """The columns of a SELECT differ from those of its target table."""


class PartlyDone(PipelineError):
    """A change of many partitions takes several statements, and a later one failed."""


class StorageError(PipelineError):
    """The file system refused to move or delete a directory."""


class Busy(PipelineError):
    """Another call is writing to the same directory or partition, or one died there and waits for ``recover``."""


class QueryTimeout(PipelineError):
    """The time limit passed and the running jobs were cancelled."""


class QueryFailed(PipelineError):
    """A query did not succeed; ``run`` is its record."""

    def __init__(self, run):
        super().__init__(f"query {run.id} {run.state}: {run.state_change_reason}")
        self.run = run
