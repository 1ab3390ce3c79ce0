"""Sources by key behind a licence gate, configuration, polite cached fetching, and a paged source."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.parse
import urllib.request
import urllib.robotparser
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusmill.operators.splits import USABLE


@dataclass(frozen=True)
class Source:
    """A source: what it is, whether its licence lets it in, and how to read it."""

    key: str
    display: str
    license: str
    tier: str
    verdict: str
    enabled: bool
    read: Callable[[SparkSession], DataFrame] | None = None

    @property
    def status(self) -> str:
        return "blocked" if self.verdict not in USABLE else "usable" if self.enabled else "disabled"


def ingest(spark: SparkSession, sources: list[Source]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Frames of the usable sources, and every source's status; a source that fails is an error in
    the statuses, and the others go on."""
    frames, status = {}, {}
    for s in sources:
        status[s.key] = s.status
        if s.status == "usable" and s.read is not None:
            try:
                frames[s.key] = s.read(spark)
                status[s.key] = "ok"
            except Exception as e:
                status[s.key] = f"error: {type(e).__name__}: {e}"
    return frames, status


class Config:
    """Nested settings with dotted lookup; paths are relative to the file."""

    def __init__(self, data: dict, root: Path | None = None):
        self.data, self.root = data, root or Path.cwd()

    @classmethod
    def load(cls, path: str) -> Config:
        text = Path(path).read_text()
        if path.endswith((".yaml", ".yml")):
            import yaml

            return cls(yaml.safe_load(text) or {}, Path(path).resolve().parent)
        return cls(json.loads(text), Path(path).resolve().parent)

    def get(self, dotted: str, default=None):
        at = self.data
        for part in dotted.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return at

    def path(self, dotted: str, default: str | None = None) -> Path | None:
        value = self.get(dotted, default)
        return None if value is None else (self.root / value if not Path(value).is_absolute() else Path(value))


class Fetcher:
    """GET with an on-disk cache, robots rules, a pause per host and growing waits after failures.

    A driver-side helper outside query plans; tests hand in their own opener.
    """

    def __init__(self, cache: str, opener: Callable[[str], bytes] | None = None, pause: float = 1.0, retries: int = 5, first_wait: float = 2.0, longest_wait: float = 120.0, sleep=time.sleep, agent: str = "corpusmill"):
        self.cache, self.pause, self.retries, self.first_wait, self.longest_wait, self.sleep, self.agent = Path(cache), pause, retries, first_wait, longest_wait, sleep, agent
        self.open = opener or (lambda url: urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=60).read())
        self.last: dict[str, float] = {}
        self.robots: dict[str, urllib.robotparser.RobotFileParser] = {}

    def place(self, url: str) -> Path:
        return self.cache / urllib.parse.urlsplit(url).netloc / hashlib.sha1(url.encode()).hexdigest()[:16]

    def allowed(self, url: str) -> bool:
        parts = urllib.parse.urlsplit(url)
        host = f"{parts.scheme}://{parts.netloc}"
        if host not in self.robots:
            rules = urllib.robotparser.RobotFileParser()
            try:
                rules.parse(self.open(f"{host}/robots.txt").decode("utf-8", "replace").splitlines())
            except Exception:  # no rules to be had: nothing is forbidden
                rules.parse([])
            self.robots[host] = rules
        return self.robots[host].can_fetch(self.agent, url)

    def get(self, url: str) -> bytes:
        kept = self.place(url)
        if kept.exists():
            return kept.read_bytes()
        if not self.allowed(url):
            raise PermissionError(f"robots rules forbid {url}")
        host = urllib.parse.urlsplit(url).netloc
        for n in range(self.retries + 1):
            wait = self.last.get(host, 0) + self.pause - time.monotonic()
            if wait > 0:
                self.sleep(wait)
            self.last[host] = time.monotonic()
            try:
                body = self.open(url)
                break
            except Exception:
                if n == self.retries:
                    raise
                self.sleep(min(self.longest_wait, self.first_wait * 2**n))
        kept.parent.mkdir(parents=True, exist_ok=True)
        kept.write_bytes(body)
        return body


class PagedArticles(DataSource):
    """Articles of a category, listed page by page with a continue token and then read one by one.

    Options: listing (URL with {category} and {token}), article (URL with {title}), category, cache (a
    folder that all executors share; needed for other than file: URLs), and per_task, how many titles
    a task reads. The listing comes to the driver, titles only. A file: URL works as well, so a saved site can be read offline.
    """

    @classmethod
    def name(cls):
        return "paged_articles"

    def schema(self):
        return "title string, text string"

    def reader(self, schema):
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def _fetch(self, url: str):
        if url.startswith("file:"):
            return json.loads(Path(urllib.parse.unquote(urllib.parse.urlsplit(url).path)).read_text())
        if "cache" not in self.options:
            raise ValueError("give a cache folder that all executors share")
        return json.loads(Fetcher(self.options["cache"]).get(url))

    def partitions(self):
        titles, token = [], ""
        while True:
            page = self._fetch(self.options["listing"].format(category=urllib.parse.quote(self.options.get("category", "")), token=urllib.parse.quote(token)))
            titles += page.get("titles", [])
            token = page.get("continue") or ""
            if not token:
                n = max(1, int(self.options.get("per_task", 50)))
                return [InputPartition(tuple(titles[i : i + n])) for i in range(0, len(titles), n)] or [InputPartition(())]

    def read(self, partition):
        for title in partition.value:
            yield from self._article(title)

    def _article(self, title):
        got, seen = self._fetch(self.options["article"].format(title=urllib.parse.quote(title))), {title}
        while got.get("redirect") and got["redirect"] not in seen:
            seen.add(got["redirect"])
            got = self._fetch(self.options["article"].format(title=urllib.parse.quote(got["redirect"])))
        if got.get("text"):
            yield (got.get("title", title), got["text"])
