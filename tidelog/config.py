"""Configuration with the same defaults and checks wherever a subscription is opened."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from tidelog.errors import InvalidConfiguration

_NAME = re.compile(r"^[A-Za-z0-9_%-]{1,251}$")


def _check(ok: bool, what: str) -> None:
    if not ok:
        raise InvalidConfiguration(what)


@dataclass(frozen=True)
class Selection:
    """Collections of a scope; no names stand for the whole scope."""

    scope: str = "_default"
    collections: tuple[str, ...] = ("_default",)

    def __post_init__(self):
        for n in (self.scope, *self.collections):
            _check(bool(_NAME.match(n)), f"bad name {n!r}")
        _check(len(set(self.collections)) == len(self.collections), "collection named twice")


@dataclass(frozen=True)
class FlowControl:
    buffer_bytes: int = 20 << 20
    ack_ratio: float = 0.2
    queue: int = 2048
    noop_s: float = 20
    dead_s: float = 60

    def __post_init__(self):
        _check(self.buffer_bytes > 0 and self.queue > 0, "flow control sizes must be positive")
        _check(0 < self.ack_ratio <= 1, "ack_ratio must be in (0, 1]")
        _check(self.noop_s >= 1, "noop interval must be a second at least")
        _check(self.dead_s > self.noop_s, "dead-connection time must exceed the noop interval")


@dataclass(frozen=True)
class Mitigation:
    enabled: bool = True
    poll_s: float = 1
    request_s: float = 5
    stall_s: float = 60

    def __post_init__(self):
        _check(self.poll_s > 0 and self.request_s > 0, "mitigation times must be positive")
        _check(self.stall_s > self.request_s and self.stall_s > self.poll_s, "stall time must exceed request and poll times")


@dataclass(frozen=True)
class Checkpointing:
    automatic: bool = True
    interval_s: float = 60
    timeout_s: float = 60

    def __post_init__(self):
        _check(self.interval_s > 0 and self.timeout_s > 0, "checkpoint times must be positive")


@dataclass(frozen=True)
class Health:
    enabled: bool = True
    interval_s: float = 60
    timeout_s: float = 10


@dataclass(frozen=True)
class Config:
    bucket: str
    group: str = "default"
    bucket_uuid: str | None = None
    mode: str = "infinite"
    start_from: str = "earliest"
    skip_until_ns: int | None = None
    selection: Selection = field(default_factory=Selection)
    rollback_policy: str = "stop_and_report"
    mitigation: Mitigation = field(default_factory=Mitigation)
    checkpointing: Checkpointing = field(default_factory=Checkpointing)
    flow: FlowControl = field(default_factory=FlowControl)
    health: Health = field(default_factory=Health)
    priority: str = "medium"
    network: str = "auto"

    def __post_init__(self):
        _check(bool(self.bucket), "bucket must be named")
        _check(bool(self.group), "group must be named")
        _check(self.mode in ("finite", "infinite"), "mode is finite or infinite")
        _check(self.start_from in ("earliest", "latest", "checkpoint"), "start_from is earliest, latest or checkpoint")
        _check(self.rollback_policy in ("stop_and_report", "rewind_and_replay", "delegate"), "unknown rollback policy")
        _check(self.priority in ("low", "medium", "high"), "unknown priority")


def parse_seed(seed: str, default_port: int) -> tuple[str, int]:
    """host and port of a seed: name, name:port, [v6], [v6]:port or a bare v6 address."""
    s = seed.strip()
    _check(bool(s), "empty seed")
    if s.startswith("["):
        host, closed, tail = s[1:].partition("]")
        _check(bool(closed) and bool(host) and (not tail or tail.startswith(":")), f"bad seed {seed!r}")
        port = tail[1:] if tail else str(default_port)
    elif s.count(":") == 1:
        host, _, port = s.partition(":")
    else:
        host, port = s, str(default_port)
    _check(bool(host) and port.isdigit() and 0 < int(port) < 65536, f"bad seed {seed!r}")
    return host, int(port)
