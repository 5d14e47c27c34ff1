"""JSON over HTTP, with a bounded number of attempts that wait as long as the server says."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request

#: Attempts for one request, and the longest wait between two that a server may ask for.
ATTEMPTS, LONGEST_WAIT_S = 3, 3600.0


def _wait_s(error: OSError, attempt: int) -> float:
    """The wait that the server's answer names, or one that doubles."""
    told = error.headers.get("Retry-After") if isinstance(error, urllib.error.HTTPError) else None
    return float(told) if told and told.strip().isdigit() else 2.0**attempt


def get_json(url: str, parameters: dict) -> list:
    """The decoded answer. A wait longer than ``LONGEST_WAIT_S``, or the last failed attempt, is an error."""
    address = f"{url}?{urllib.parse.urlencode({k: v for k, v in parameters.items() if v is not None})}"
    for attempt in range(1, ATTEMPTS + 1):
        try:
            with urllib.request.urlopen(address, timeout=30) as answer:
                return json.load(answer)
        except OSError as error:
            wait = _wait_s(error, attempt)
            if attempt == ATTEMPTS or wait > LONGEST_WAIT_S:
                raise
            time.sleep(wait)
    return []
