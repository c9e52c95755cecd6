"""Errors of the engine. Only those marked retryable may be retried by reopening a subscription."""

from __future__ import annotations


class ChangeLogError(Exception):
    retryable = False


class InvalidConfiguration(ChangeLogError):
    pass


class ProtocolError(ChangeLogError):
    pass


class CollectionError(ChangeLogError):
    pass


class CheckpointError(ChangeLogError):
    pass


class CheckpointStoreError(ChangeLogError):
    pass


class RollbackRequired(ChangeLogError):
    """A shard must go back: shard, requested and rollback seqno, and its failover log (newest first)."""

    def __init__(self, shard: int, requested: int, rollback: int, log: list[tuple[int, int]]):
        super().__init__(f"shard {shard}: rollback from {requested} to {rollback}")
        self.shard, self.requested, self.rollback, self.log = shard, requested, rollback, log


class PersistenceError(ChangeLogError):
    pass


class StaleGeneration(ChangeLogError):
    pass


class Unsupported(ChangeLogError):
    pass


class MembershipError(ChangeLogError):
    pass


class Fenced(MembershipError):
    pass


class RetryableError(ChangeLogError):
    retryable = True


class TopologyError(RetryableError):
    pass


class StreamError(RetryableError):
    pass


class TimedOut(RetryableError):
    pass


class DeadConnection(RetryableError):
    pass


class Cancelled(RetryableError):
    pass
