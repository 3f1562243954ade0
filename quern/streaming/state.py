"""State of incremental intake between runs: high-water marks, cooldowns, failure counts, and the loop that uses them.

The state is a few values per connector and lives in one JSON file that is replaced atomically; it belongs to the driver, not to Spark.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

Clock = Callable[[], float]


class FileState:
    """Key-value store with expiry. A missing or unreadable file counts as empty."""

    def __init__(self, path: str | None = None, clock: Clock = time.time):
        self.path, self.clock = Path(path) if path else None, clock
        self._values: dict[str, list] = {}
        if self.path and self.path.exists():
            try:
                self._values = json.loads(self.path.read_text())
            except ValueError:
                self._values = {}

    def get(self, key: str) -> str | None:
        value, until = self._values.get(key, (None, None))
        return None if until is not None and self.clock() >= until else value

    def put(self, key: str, value: str, ttl: float | None = None) -> None:
        self._values[key] = [value, None if ttl is None else self.clock() + ttl]
        self._save()

    def increase(self, key: str, ttl: float | None = None) -> int:
        n = int(self.get(key) or 0) + 1
        self.put(key, str(n), ttl)
        return n

    def drop(self, key: str) -> None:
        if self._values.pop(key, None) is not None:
            self._save()

    def _save(self) -> None:
        if self.path:
            self.path.parent.mkdir(parents=True, exist_ok=True)
            fd, name = tempfile.mkstemp(dir=self.path.parent)
            with os.fdopen(fd, "w") as f:
                json.dump(self._values, f)
            os.replace(name, self.path)


def advance_mark(state: FileState, connector: str, newest: dt.datetime, rewind: dt.timedelta = dt.timedelta(hours=6)) -> dt.datetime:
    """Store the newest time seen, rewound for late publishers; a mark never moves back."""
    mark = newest - rewind
    if (old := state.get(f"mark:{connector}")) is not None:
        mark = max(mark, dt.datetime.fromisoformat(old))
    state.put(f"mark:{connector}", mark.isoformat())
    return mark


def window_start(state: FileState, connector: str, now: dt.datetime, lookback: dt.timedelta = dt.timedelta(days=14), first: dt.timedelta = dt.timedelta(days=90)) -> dt.datetime:
    """Where the next run begins: the stored mark, but no further back than `lookback`; `first` back the first time."""
    mark = state.get(f"mark:{connector}")
    return now - first if mark is None else max(dt.datetime.fromisoformat(mark), now - lookback)


class Breaker:
    """Open after `most` failures within `seconds`; a success closes it."""

    def __init__(self, state: FileState, most: int = 3, seconds: float = 3600):
        self.state, self.most, self.seconds = state, most, seconds

    def open(self, connector: str) -> bool:
        return int(self.state.get(f"failures:{connector}") or 0) >= self.most

    def failed(self, connector: str) -> None:
        self.state.increase(f"failures:{connector}", self.seconds)

    def worked(self, connector: str) -> None:
        self.state.drop(f"failures:{connector}")


def retried(call: Callable, tries: int = 3, first: float = 1.0, most: float = 30.0, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random):
    """call() with exponentially growing pauses between tries; the last error is raised."""
    for k in range(tries):
        try:
            return call()
        except Exception:
            if k == tries - 1:
                raise
            sleep(min(most, first * 2**k) * (0.5 + jitter() / 2))
    return None


class Unavailable(RuntimeError):
    """A connector that can't be used now, through no fault of the run."""


def run_connector(name: str, fetch: Callable[[dt.datetime], object], state: FileState, now: dt.datetime, cooldown: float = 0.0, since: dt.datetime | None = None, ready: bool = True) -> tuple[str, object]:
    """(status, what fetch returned). With `since` given the run is a backfill: marks and failure counts are left alone."""
    breaker = Breaker(state)
    if not ready:
        return "skipped_no_credentials", None
    if since is None and state.get(f"cooldown:{name}") is not None:
        return "skipped_cooldown", None
    if since is None and breaker.open(name):
        return "skipped_circuit_open", None
    try:
        got = fetch(since or window_start(state, name, now))
    except Unavailable:
        return "unavailable", None
    except Exception:
        if since is None:
            breaker.failed(name)
        return "failed", None
    if since is None:
        breaker.worked(name)
        advance_mark(state, name, now)
        if cooldown:
            state.put(f"cooldown:{name}", "1", cooldown)
    return "success", got
