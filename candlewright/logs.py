"""Logging of the jobs: to standard output and, where one is named, to a file."""

from __future__ import annotations

import logging
import sys

FORMAT = "%(asctime)s %(levelname)s %(name)s %(message)s"


def get_logger(name: str = "candlewright", file: str | None = None) -> logging.Logger:
    """The logger ``name`` at level INFO. Asked for again, it gets no second handler of a kind."""
    log = logging.getLogger(name)
    log.setLevel(logging.INFO)
    files = [h.baseFilename for h in log.handlers if isinstance(h, logging.FileHandler)]
    wanted: list[logging.Handler] = []
    if len(files) == len(log.handlers):
        wanted.append(logging.StreamHandler(sys.stdout))
    if file is not None:
        handler = logging.FileHandler(file, encoding="utf-8", delay=True)
        wanted += [handler] if handler.baseFilename not in files else []
    for handler in wanted:
        handler.setFormatter(logging.Formatter(FORMAT))
        log.addHandler(handler)
    return log
