"""Manners of a crawl against a remote site: pauses, closed hours, repeated attempts, and sessions that expire."""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable
from datetime import datetime

_TOKEN = re.compile(r"""name=["']_token["'][^>]*value=["']([^"']*)["']""")


class Pace:
    """Waits between requests, as options of a source say it; without options there are none.

    delay_ms, delay_span_ms: a random wait of delay_ms to delay_ms + delay_span_ms - 1 after each request. pause_every, pause_ms:
    a long pause after so many good answers. closed: hours ``from-to`` in which no request is sent. retries, backoff_ms: attempts
    of one request, and the wait after the first failed one, which doubles each time.
    """

    def __init__(self, options: dict, sleep: Callable[[float], None] = time.sleep, now: Callable[[], datetime] = datetime.now):
        number = lambda name, default=0: int(options.get(name, default))
        self.delay, self.span, self.every, self.pause = number("delay_ms"), number("delay_span_ms"), number("pause_every"), number("pause_ms")
        self.retries, self.backoff = max(1, number("retries", 3)), number("backoff_ms", 2000 if options.get("fetch") else 0)
        lo, _, hi = str(options.get("closed", "0-0")).partition("-")
        self.closed = int(lo), int(hi)
        self.sleep, self.now, self.good = sleep, now, 0

    def before(self) -> None:
        """Until the closed hours end."""
        hour = self.now().hour
        if self.closed[0] <= hour < self.closed[1]:
            self.sleep((self.closed[1] - hour) * 3600)

    def after(self, good: bool) -> None:
        if self.delay or self.span:
            self.sleep((self.delay + random.randrange(max(1, self.span))) / 1000)
        self.good += good
        if self.every and self.good >= self.every:
            self.sleep(self.pause / 1000)
            self.good = 0

    def fetch(self, call: Callable[..., str | None], *key: object) -> tuple[str | None, str | None]:
        """(answer, error): a failing request is repeated, so that a page isn't lost to one error."""
        self.before()
        error = None
        for attempt in range(self.retries):
            try:
                answer = call(*key)
                self.after(answer is not None)
                return answer, None
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
                if self.backoff and attempt + 1 < self.retries:
                    self.sleep(self.backoff * 2**attempt / 1000)
        self.after(False)
        return None, error


def bootstrap(page: str, cookie_headers: list[str]) -> dict[str, str]:
    """The token of a page's hidden field and the cookies that it set, as a request sends them; a page without a token is an error."""
    m = _TOKEN.search(page)
    if not m:
        raise ValueError("the page has no token")
    return {"token": m[1], "cookie": "; ".join(h.split(";", 1)[0].strip() for h in cookie_headers)}


class Sessions:
    """A session of a remote site, made anew by ``make`` once it is older than ``ttl`` seconds."""

    def __init__(self, make: Callable[[], dict[str, str]], ttl: float = 6000, clock: Callable[[], float] = time.monotonic):
        self.make, self.ttl, self.clock = make, ttl, clock
        self.held: tuple[float, dict[str, str]] | None = None

    def get(self) -> dict[str, str]:
        now = self.clock()
        if self.held is None or now - self.held[0] > self.ttl:
            self.held = now, self.make()
        return self.held[1]
