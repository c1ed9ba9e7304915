"""Driver-side HTTP with a bounded retry; the request, the clock and the pause are passed in."""

from __future__ import annotations

import time
from collections.abc import Callable

#: Worth another try.
RETRY = frozenset({408, 425, 429, *range(500, 600)})


class HttpStatus(Exception):
    def __init__(self, status: int):
        super().__init__(f"HTTP status {status}")
        self.status = status


def fetch_within(request: Callable[[float], bytes], window: float = 1800, first_timeout: float = 120, later_timeout: float = 600, delay: float = 30, clock: Callable[[], float] = time.monotonic, pause: Callable[[float], None] = time.sleep) -> bytes:
    """Repeats a request until it succeeds or the window ends. The last pause is what is left of the window, and an
    attempt has a second at least; without a window there is one attempt with its whole timeout."""
    end, timeout = clock() + max(0.0, window), first_timeout
    while True:
        try:
            return request(min(timeout, max(1.0, end - clock())) if window > 0 else timeout)
        except HttpStatus as e:
            if e.status not in RETRY:
                raise
            error: Exception = e
        except OSError as e:
            error = e
        left = end - clock()
        if left <= 0:
            raise error
        pause(min(delay, left))
        timeout = later_timeout


def fetch_times(request: Callable[[float], bytes], attempts: int = 3, timeout: float = 90, delay: float = 20, pause: Callable[[float], None] = time.sleep) -> bytes:
    """A number of attempts, the pause growing with each."""
    for n in range(1, attempts + 1):
        try:
            return request(timeout)
        except (OSError, HttpStatus) as e:
            if n == attempts or (isinstance(e, HttpStatus) and e.status not in RETRY):
                raise
            pause(delay * n)
    raise AssertionError("no attempt")
