"""Documents over HTTP: a polite client on the driver, and landing what it got.

One request at a time and host, with a least interval; conditional requests; retries of timeouts and of answers that ask to be
retried, never of a refusal. robots.txt is read once a host and holds. The user agent says who asks. It uses the standard library.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
import urllib.robotparser
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from urllib.parse import urlsplit

#: Answers that may be better later; fixed values.
RETRIED = (429, 500, 502, 503, 504)


class Refused(PermissionError):
    """The host doesn't want this client: never tried again."""


class NotFetched(OSError):
    """One document could not be had; the others go on."""

    def __init__(self, url: str, attempts: int, why: str, status: int | None = None) -> None:
        super().__init__(f"{url}: {why} after {attempts} attempt(s)")
        self.url, self.attempts, self.status = url, attempts, status


@dataclass(frozen=True)
class Policy:
    user_agent: str
    interval: float = 2.0
    attempts: int = 3
    backoff: float = 2.0
    timeout: float = 60.0
    respect_robots: bool = True

    def __post_init__(self) -> None:
        if not self.user_agent.strip() or self.user_agent.lower().startswith("mozilla"):
            raise ValueError("the user agent must say who asks, not pose as a browser")


@dataclass(frozen=True)
class Answer:
    url: str
    status: int
    headers: Mapping[str, str]
    content: bytes | None
    attempts: int


def _send(url: str, headers: Mapping[str, str], timeout: float) -> tuple[int, dict[str, str], bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=dict(headers)), timeout=timeout) as r:  # noqa: S310 - schemes are checked
            return r.status, {k.lower(): v for k, v in r.headers.items()}, r.read()
    except urllib.error.HTTPError as e:
        return e.code, {k.lower(): v for k, v in e.headers.items()}, e.read()


@dataclass
class Client:
    """send, sleep and clock can be replaced, as tests do."""

    policy: Policy
    send: Callable[[str, Mapping[str, str], float], tuple[int, dict[str, str], bytes]] = _send
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _last: dict[str, float] = field(default_factory=dict)
    _rules: dict[str, urllib.robotparser.RobotFileParser | None] = field(default_factory=dict)

    def _ask(self, url: str, headers: Mapping[str, str]) -> tuple[int, dict[str, str], bytes]:
        host = urlsplit(url).netloc.lower()
        if host in self._last:
            wait = self.policy.interval - (self.clock() - self._last[host])
            if wait > 0:
                self.sleep(wait)
        self._last[host] = self.clock()
        return self.send(url, {"User-Agent": self.policy.user_agent, **headers}, self.policy.timeout)

    def _allowed(self, url: str) -> bool:
        parts = urlsplit(url)
        origin = f"{parts.scheme}://{parts.netloc}".lower()
        if origin not in self._rules:
            rules = None
            try:
                status, _, body = self._ask(f"{origin}/robots.txt", {})
            except OSError:
                status, body = 0, b""  # not to be had says neither yes nor no
            if status == 403:
                raise Refused(f"{origin} refuses to show its rules")
            if status == 200:
                rules = urllib.robotparser.RobotFileParser()
                rules.parse(body.decode("utf-8", "replace").splitlines())
            self._rules[origin] = rules
        rules = self._rules[origin]
        return rules is None or rules.can_fetch(self.policy.user_agent, url)

    def fetch(self, url: str, etag: str | None = None, last_modified: str | None = None, accept: str | None = None) -> Answer:
        """One document; content is None if it hasn't changed."""
        if urlsplit(url).scheme not in ("http", "https"):
            raise ValueError(f"not an http url: {url}")
        if self.policy.respect_robots and not self._allowed(url):
            raise Refused(f"robots.txt keeps {url} from this client")
        asked = {"Accept": accept, "If-None-Match": etag, "If-Modified-Since": last_modified}
        headers, why, status = {k: v for k, v in asked.items() if v}, "nothing was tried", None
        for attempt in range(1, self.policy.attempts + 1):
            wait = self.policy.backoff * 2 ** (attempt - 1)
            try:
                status, got, body = self._ask(url, headers)
            except OSError as e:
                why = f"{type(e).__name__}: {e}"
            else:
                if status == 403:
                    raise Refused(f"{url} answers 403")
                if status == 304:
                    return Answer(url, status, got, None, attempt)
                if status < 400:
                    return Answer(url, status, got, body, attempt)
                why = f"HTTP {status}"
                if status not in RETRIED:
                    raise NotFetched(url, attempt, why, status)
                later = got.get("retry-after", "")
                wait = max(wait, float(later)) if later.replace(".", "", 1).isdigit() else wait
            if attempt < self.policy.attempts:
                self.sleep(wait)
        raise NotFetched(url, self.policy.attempts, why, status)

    def json(self, url: str, accept: str = "application/json;odata=nometadata") -> object:
        answer = self.fetch(url, accept=accept)
        try:
            return json.loads(answer.content or b"")
        except ValueError as e:
            raise NotFetched(url, answer.attempts, f"no JSON ({answer.headers.get('content-type', 'of no type')})", answer.status) from e


def sightings(client: Client, wanted: Iterable[Mapping], stamp: str) -> list[dict]:
    """A manifest row for each wanted document (url and keys; etag, last_modified and content_hash of its last sighting), with its
    bytes. A failure is a row with its error; a refusal is one, and the rest of that host's documents are not asked for."""
    import hashlib

    rows, refused = [], set()
    for w in wanted:
        host = urlsplit(w["url"]).netloc.lower()
        row = {k: v for k, v in w.items() if k not in ("etag", "last_modified", "content_hash")} | {"retrieved_at": stamp, "http_status": None, "error": None, "content_hash": None, "content": None, "unchanged": None, "prior_content_hash": w.get("content_hash")}
        rows.append(row)
        if host in refused:
            row["error"] = "not asked for: the host refused before"
            continue
        try:
            answer = client.fetch(w["url"], w.get("etag"), w.get("last_modified"))
        except Refused as e:
            refused.add(host)
            row["error"] = f"Refused: {e}"
            continue
        except (OSError, ValueError) as e:
            row["error"], row["http_status"] = f"{type(e).__name__}: {e}", getattr(e, "status", None)
            continue
        row |= {"http_status": answer.status, "etag": answer.headers.get("etag"), "last_modified": answer.headers.get("last-modified"), "content_type": answer.headers.get("content-type")}
        if answer.content is None:
            row |= {"content_hash": w.get("content_hash"), "unchanged": True}
        else:
            found = "sha256:" + hashlib.sha256(answer.content).hexdigest()
            row |= {"content_hash": found, "unchanged": found == w.get("content_hash"), "content": None if found == w.get("content_hash") else answer.content}
    return rows
