"""Posting JSON to a service, with retries."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable


def post_json(url: str, key: str, body: dict, attempts: int = 6, timeout: float = 180.0, sleep: Callable[[float], None] | None = None):
    """The answer's JSON. Time-outs, broken connections, 429 and 5xx are tried again, others are not: after 2 ** attempt
    seconds, and for 429 after Retry-After or 10 * 2 ** attempt seconds."""
    data, sleep = json.dumps(body).encode(), sleep or time.sleep
    for attempt in range(attempts):
        request = urllib.request.Request(url, data, {"Authorization": f"Bearer {key}", "Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return json.load(answer)
        except urllib.error.HTTPError as e:
            if e.code != 429 and e.code < 500:
                raise
            sleep(_pause(e, attempt))
        except (TimeoutError, ConnectionError, urllib.error.URLError):
            sleep(2**attempt)
    raise RuntimeError(f"no answer after {attempts} attempts")


def _pause(e: urllib.error.HTTPError, attempt: int) -> float:
    if e.code != 429:
        return 2**attempt
    try:
        return float(e.headers.get("Retry-After") or 0) or 10 * 2**attempt
    except ValueError:
        return 10 * 2**attempt
