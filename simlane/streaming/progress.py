"""Depth of the intake over time, and a time limit for a task's opaque step."""

from __future__ import annotations

import logging
import os
import signal
import threading
from collections.abc import Callable
from logging.handlers import TimedRotatingFileHandler
from typing import Any

from pyspark.sql.streaming import StreamingQueryListener


class DepthLog(StreamingQueryListener):
    """Calls write(time, query id, rows of the batch, rows a second) after each micro-batch."""

    def __init__(self, write: Callable[[str, str, int, float], None]):
        self.write = write

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.write(p.timestamp, str(p.id), int(p.numInputRows), float(p.processedRowsPerSecond))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def rotating_log(name: str, path: str, days: int = 7) -> logging.Logger:
    """A log of the driver that begins a new file each midnight (UTC) and keeps so many old ones."""
    log = logging.getLogger(name)
    if not any(isinstance(h, TimedRotatingFileHandler) and h.baseFilename == os.path.abspath(path) for h in log.handlers):
        h = TimedRotatingFileHandler(path, when="midnight", backupCount=days, utc=True, encoding="utf-8")
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(h)
        log.setLevel(logging.INFO)
    return log


class TimedOut(Exception):
    pass


def limited(f: Callable[..., Any], seconds: float) -> Callable[..., Any]:
    """f with a time limit; the alarm is cleared however f ends. For use in a worker's main thread, elsewhere f runs
    without one."""

    def run(*args: Any, **named: Any) -> Any:
        if threading.current_thread() is not threading.main_thread():
            return f(*args, **named)

        def ring(signum, frame):
            raise TimedOut(f"over {seconds} s")

        before = signal.signal(signal.SIGALRM, ring)
        signal.setitimer(signal.ITIMER_REAL, seconds)
        try:
            return f(*args, **named)
        finally:
            signal.setitimer(signal.ITIMER_REAL, 0)
            signal.signal(signal.SIGALRM, before)

    return run
