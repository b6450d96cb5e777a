"""Bounded retries for driver-side input and output; tasks are retried by the engine itself."""

from __future__ import annotations

import time
from collections.abc import Callable


def pauses(attempts: int, first_s: float) -> list[float]:
    """How long to wait before each further attempt: twice as long every time."""
    return [first_s * 2**k for k in range(attempts - 1)]


def with_retries[R](
    call: Callable[[], R], transient: tuple[type[Exception], ...], attempts: int = 3, seen: Callable[[int, Exception], None] | None = None, first_pause_s: float = 0.05
) -> R:
    """The call's result. After a ``transient`` error it is called again, with growing pauses, until the
    attempts are used up; what the last one raises is raised, as is any other error at once."""
    waits = pauses(attempts, first_pause_s)
    for number, wait in enumerate(waits, start=1):
        try:
            return call()
        except transient as error:
            (seen or (lambda *_: None))(number, error)
            time.sleep(wait)
    return call()


def poll[R](call: Callable[[], R], expected: R, attempts: int, pause_s: float = 0.0) -> R:
    """Ask until the answer is the expected one; after the last attempt another answer is an error."""
    answer = None
    for left in range(attempts - 1, -1, -1):
        answer = call()
        if answer == expected:
            return answer
        if left:
            time.sleep(pause_s)
    raise TimeoutError(f"{answer!r} instead of {expected!r} after {attempts} attempts")
