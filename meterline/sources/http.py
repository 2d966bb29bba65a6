"""Delivery of line batches over HTTP: batching, gzip, retries, splitting and isolating bad lines.

``deliver`` runs inside a writer task.  Spark's own task retry is the outer net; both are safe
because a point written twice overwrites itself.
"""

from __future__ import annotations

import gzip
import json
import random
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

from meterline.functions.dialect import DIALECTS, LineError

# Status codes that are worth another try.
RETRYABLE = frozenset((429, 500, 502, 503, 504))
SMALLEST_SPLIT = 1024


@dataclass
class HttpOptions:
    url: str
    database: str
    dialect: int = 3
    precision: str = "ns"
    token: str | None = None
    org: str | None = None
    batch_lines: int = 25_000
    batch_bytes: int = 8 << 20
    gzip_level: int = 1
    gzip_min_bytes: int = 4096
    timeout: float = 30.0
    retry_first: float = 0.5
    retry_most: float = 30.0
    retry_total: float = 300.0
    isolate_requests: int = 64
    no_sync: bool = False
    accept_partial: bool = True


@dataclass
class Failure:
    """A line (or a batch's lines) that was not stored, why, and whether trying again may help."""

    lines: list[str]
    code: str
    message: str
    retryable: bool


@dataclass
class Outcome:
    written: int = 0
    requests: int = 0
    retries: int = 0
    sent_bytes: int = 0
    failures: list[Failure] = field(default_factory=list)


class Refused(Exception):
    def __init__(self, status: int, body: str, after: float | None = None):
        super().__init__(f"{status}: {body[:500]}")
        self.status, self.body, self.after = status, body, after


def batches(lines: Iterable[str], most_lines: int, most_bytes: int) -> Iterator[list[str]]:
    """Consecutive lines within both limits (one line at least)."""
    part: list[str] = []
    size = 0
    for x in lines:
        n = len(x.encode()) + 1
        if part and (len(part) >= most_lines or size + n > most_bytes):
            yield part
            part, size = [], 0
        part.append(x)
        size += n
    if part:
        yield part


def endpoint(o: HttpOptions) -> str:
    if o.dialect == 3:
        unit = {"ns": "nanosecond", "us": "microsecond", "ms": "millisecond", "s": "second"}[o.precision]
        q = {"db": o.database, "precision": unit, "no_sync": str(o.no_sync).lower(), "accept_partial": str(o.accept_partial).lower()}
        return f"{o.url.rstrip('/')}/api/v3/write_lp?{urllib.parse.urlencode(q)}"
    q = {"bucket": o.database, "precision": o.precision} | ({"org": o.org} if o.org else {})
    return f"{o.url.rstrip('/')}/api/v2/write?{urllib.parse.urlencode(q)}"


def post(o: HttpOptions, body: bytes) -> None:
    headers = {"Content-Type": "text/plain; charset=utf-8"}
    if o.token:
        headers["Authorization"] = f"{'Bearer' if o.dialect == 3 else 'Token'} {o.token}"
    if len(body) >= o.gzip_min_bytes and o.gzip_level:
        body, headers["Content-Encoding"] = gzip.compress(body, o.gzip_level), "gzip"
    try:
        with urllib.request.urlopen(urllib.request.Request(endpoint(o), body, headers, method="POST"), timeout=o.timeout) as r:
            if "html" in r.headers.get("Content-Type", ""):
                raise Refused(502, "an HTML page answered; is a proxy in the way?")
    except urllib.error.HTTPError as e:
        after = e.headers.get("Retry-After", "")
        raise Refused(e.code, e.read().decode(errors="replace"), float(after) if after.isdigit() else None) from None


class Delivery:
    def __init__(self, o: HttpOptions, send: Callable[[HttpOptions, bytes], None] = post, sleep: Callable[[float], None] = time.sleep):
        self.o, self.send, self.sleep, self.out = o, send, sleep, Outcome()
        self.most_bytes = o.batch_bytes

    def run(self, lines: Iterable[str]) -> Outcome:
        for part in batches(lines, self.o.batch_lines, self.o.batch_bytes):
            for fit in batches(part, len(part), self.most_bytes):
                self.one(fit)
        return self.out

    def _try(self, lines: list[str]) -> None:
        """One request with retries; raises what stays."""
        body, wait, spent, first = ("\n".join(lines) + "\n").encode(), self.o.retry_first, 0.0, True
        while True:
            self.out.requests += 1
            try:
                self.send(self.o, body)
                self.out.sent_bytes += len(body)
                return
            except Refused as e:
                if e.status not in RETRYABLE or spent >= self.o.retry_total:
                    raise
                pause = e.after if e.after is not None else wait * random.uniform(0.8, 1.2)
            except (OSError, TimeoutError) as e:
                if spent >= self.o.retry_total:
                    raise Refused(0, f"connection failed: {e}") from None
                pause = 0.0 if first else wait * random.uniform(0.8, 1.2)
            first = False
            self.out.retries += 1
            pause = min(pause, self.o.retry_total - spent) if spent < self.o.retry_total else 0.0
            self.sleep(pause)
            spent, wait = spent + max(pause, 1e-3), min(wait * 2, self.o.retry_most)

    def one(self, lines: list[str]) -> None:
        try:
            self._try(lines)
            self.out.written += len(lines)
        except Refused as e:
            self.refused(lines, e)

    def fail(self, lines: list[str], e: Refused, message: str | None = None) -> None:
        code = {0: "unavailable", 401: "unauthorized", 403: "forbidden", 404: "not_found", 413: "too_large"}.get(e.status, "unavailable" if e.status in RETRYABLE else "rejected")
        self.out.failures.append(Failure(lines, code, message or str(e), e.status == 0 or e.status in RETRYABLE))

    def refused(self, lines: list[str], e: Refused) -> None:
        size = sum(len(x.encode()) + 1 for x in lines)
        if e.status == 413:
            if len(lines) == 1 or size <= SMALLEST_SPLIT:
                self.fail(lines, e)
                return
            self.most_bytes = max(SMALLEST_SPLIT, min(self.most_bytes, size // 2))
            for half in (lines[: len(lines) // 2], lines[len(lines) // 2 :]):
                self.one(half)
            return
        if e.status not in (400, 422):
            self.fail(lines, e)
            return
        named = self.named(e.body)
        if named:  # stored but for the lines it names, each once
            bad = {n: m for n, m in named if 1 <= n <= len(lines)}
            for n, m in sorted(bad.items()):
                self.fail([lines[n - 1]], e, m)
            self.out.written += len(lines) - len(bad)
            return
        if m := re.search(r"dropped=(\d+)", e.body):
            n = min(len(lines), int(m[1]))
            self.fail([], e, f"{n} unidentified lines were dropped: {e.body}")
            self.out.written += len(lines) - n
            return
        quoted = set(re.findall(r"unable to parse '((?:[^'\\]|\\.|'(?!:))*)'", e.body))
        if found := [x for x in lines if x in quoted]:
            for x in found:
                self.fail([x], e)
            if rest := [x for x in lines if x not in quoted]:
                self.one(rest)
            return
        self.isolate(lines, e)

    @staticmethod
    def named(body: str) -> list[tuple[int, str]]:
        try:
            data = json.loads(body).get("data")
        except (ValueError, AttributeError):
            return []
        return [(int(x["line_number"]), str(x.get("error_message", ""))) for x in data if isinstance(x, dict) and "line_number" in x] if isinstance(data, list) else []

    def isolate(self, lines: list[str], e: Refused) -> None:
        """Finds lines the server refuses without naming them: first those we cannot parse, then by halving."""
        d = DIALECTS[self.o.dialect]

        def parses(x: str) -> bool:
            try:
                d.parse(x)
                return True
            except LineError:
                return False

        bad = [x for x in lines if not parses(x)]
        if bad and len(bad) < len(lines):
            for x in bad:
                self.fail([x], e)
            self.one([x for x in lines if parses(x)])
            return
        budget, stack = self.o.isolate_requests, [lines]
        while stack:
            part = stack.pop()
            if len(part) == 1 or budget <= 0:
                self.fail(part, e)
                continue
            for half in (part[len(part) // 2 :], part[: len(part) // 2]):
                budget -= 1
                try:
                    self._try(half)
                    self.out.written += len(half)
                except Refused as again:
                    if again.status in (400, 422):
                        stack.append(half)
                    else:
                        self.fail(half, again)
