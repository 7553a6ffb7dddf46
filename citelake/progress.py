"""Time, memory and growth of long steps, for the log."""

from __future__ import annotations

import logging
import resource
import sys
import threading
import time
from collections.abc import Callable
from pathlib import Path

log = logging.getLogger(__name__)


def duration(seconds: float) -> str:
    """'42s', '3m 07s' or '2h 05m'."""
    s = int(seconds)
    return f"{s}s" if s < 60 else f"{s // 60}m {s % 60:02d}s" if s < 3600 else f"{s // 3600}h {s % 3600 // 60:02d}m"


def remaining(elapsed: float, done: int, left: int) -> str:
    """What is left at the pace so far."""
    return "done" if left <= 0 else "?" if done <= 0 else duration(elapsed / done * left)


def peak_gib() -> float:
    """The driver's highest resident memory so far."""
    peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    return peak / (1 << 30 if sys.platform == "darwin" else 1 << 20)


def current_gib() -> float | None:
    """The driver's resident memory now, None where it can't be told."""
    try:
        return int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize() / (1 << 30)
    except (OSError, IndexError, ValueError):
        return None


class Heartbeat:
    """Logs the size of a growing folder once a minute while a block runs; never raises.  ``sizes()`` gives the bytes of its files."""

    def __init__(self, name: str, sizes: Callable[[], list[int]], every: float = 60.0) -> None:
        self.name, self.sizes, self.every, self._stop = name, sizes, every, threading.Event()
        self._thread = threading.Thread(target=self._beat, daemon=True)

    def _beat(self) -> None:
        began = time.monotonic()
        while not self._stop.wait(self.every):
            try:
                files = self.sizes()
                log.info("%s: %d file(s), %.1f MiB after %s", self.name, len(files), sum(files) / (1 << 20), duration(time.monotonic() - began))
            except Exception:  # noqa: BLE001 - a missed line in the log must not end an export
                continue

    def __enter__(self) -> Heartbeat:
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._thread.join(5)
