"""The provider's network interface: a Python data source for paged search, and fetches.

Next links depend on the page before, so a search is one partition.  A repeated
request ends it; a link to another origin, or one left after ``MAX_PAGES``, is an error: a server can't make
the reader loop or wander off.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections import defaultdict, deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from threading import Semaphore

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual, SimpleDataSourceStreamReader

from ..functions.geo import bbox_for_radius
from ..functions.stac import is_http_url
from ..operators.preview import ANSWER, MAX_BYTES, thumbnail_of
from ..schemas import ENDPOINT

AGENT = "kerbsight/0.1"
MAX_PAGES = 10_000
#: (status, headers, body) of (method, url, body, timeout, most bytes)
Client = Callable[[str, str, bytes | None, float, int], tuple[int, dict, bytes]]


class ProviderError(RuntimeError):
    """The provider can't be reached or answers with something unusable."""


def client(method: str, url: str, body: bytes | None, timeout: float, most: int) -> tuple[int, dict, bytes]:
    headers = {"User-Agent": AGENT} | ({"Content-Type": "application/json"} if body is not None else {})
    request = urllib.request.Request(url, body, headers, method=method)
    with urllib.request.urlopen(request, timeout=timeout) as answer:  # noqa: S310
        return answer.status, dict(answer.headers), answer.read(most)


def request_json(ask: Client, method: str, url: str, *, body: dict | None = None, timeout: float = 30.0) -> tuple[dict, str]:
    """A JSON object and its text; anything else is a ProviderError."""
    try:
        status, _, raw = ask(method, url, None if body is None else json.dumps(body).encode(), timeout, 1 << 28)
        if not 200 <= status < 400:
            raise ProviderError(f"request failed with status {status}")
        text = raw.decode("utf-8")
        found = json.loads(text)
    except (OSError, urllib.error.URLError) as exc:
        raise ProviderError(f"request failed: {exc}") from exc
    except ValueError as exc:
        raise ProviderError("the provider returned invalid JSON") from exc
    if not isinstance(found, dict):
        raise ProviderError("the provider returned JSON that is no object")
    return found, text


def search_pages(ask: Client, endpoint: str, latitude: float, longitude: float, radius_m: float, **options) -> Iterator[tuple[int, str]]:
    """Pages of the search box around a point; see ``box_pages``."""
    return box_pages(ask, endpoint, bbox_for_radius(latitude, longitude, radius_m), **options)


def first_request(endpoint: str, box: tuple[float, float, float, float], per_page: int) -> tuple[str, str, dict | None]:
    return "GET", f"{endpoint.rstrip('/')}/search?" + urllib.parse.urlencode({"bbox": ",".join(f"{x:.8f}" for x in box), "limit": per_page}), None


def one_page(ask: Client, endpoint: str, step: tuple[str, str, dict | None], timeout: float) -> tuple[list, str, tuple[str, str, dict | None] | None]:
    """(features, JSON text, next request or None) of a request."""
    page, text = request_json(ask, step[0], step[1], body=step[2], timeout=timeout)
    found = page.get("features")
    if not isinstance(found, list):
        raise ProviderError("search answer without a feature list")
    links = page.get("links")
    following = next((x for x in links if isinstance(x, dict) and x.get("rel") == "next"), None) if isinstance(links, list) else None
    href = str((following or {}).get("href") or "")
    if not href:
        return found, text, None
    href = urllib.parse.urljoin(step[1], href)
    if urllib.parse.urlsplit(href)[:2] != urllib.parse.urlsplit(endpoint)[:2]:
        raise ProviderError(f"next page on another origin: {href}")
    body = following.get("body")
    return found, text, (str(following.get("method") or "GET").upper(), href, body if isinstance(body, dict) else None)


def mark(step: tuple[str, str, dict | None]) -> str:
    return json.dumps(step, sort_keys=True)


def box_pages(ask: Client, endpoint: str, box: tuple[float, float, float, float], *, limit: int, page_limit: int = 500, timeout: float = 30.0) -> Iterator[tuple[int, str]]:
    """(page number, JSON text) as long as there is a next page and fewer than
    ``limit`` distinct ids have been seen."""
    step = first_request(endpoint, box, min(page_limit, limit))
    asked, ids = set(), set()
    for number in range(MAX_PAGES):
        if mark(step) in asked:
            return
        asked.add(mark(step))
        found, text, following = one_page(ask, endpoint, step, timeout)
        yield number, text
        ids |= {str(f["id"]) for f in found if isinstance(f, dict) and f.get("id")}
        if following is None or len(ids) >= limit:
            return
        step = following
        if number + 1 == MAX_PAGES and mark(step) not in asked:
            raise ProviderError(f"more than {MAX_PAGES} pages")


def provider_documents(ask: Client, endpoint: str, *, timeout: float = 30.0) -> tuple[str | None, str | None]:
    """JSON texts of the configuration and the landing page.  Either may be missing,
    but an unreachable landing page behind an empty configuration is an error."""
    base = endpoint.rstrip("/")
    try:
        config, text = request_json(ask, "GET", f"{base}/configuration", timeout=timeout)
    except ProviderError:
        config, text = {}, None
    try:
        return text, request_json(ask, "GET", base, timeout=timeout)[1]
    except ProviderError:
        if not config:
            raise
        return text, None


class SearchSource(DataSource):
    """spark.read.format("picture_search") with options latitude, longitude,
    radius_m, limit, page_limit, endpoint, timeout_s; columns page_no, body."""

    ask: Client = staticmethod(client)

    @classmethod
    def name(cls) -> str:
        return "picture_search"

    def schema(self) -> str:
        return "page_no bigint, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options), type(self).ask)


class _Reader(DataSourceReader):
    def __init__(self, options: dict, ask: Client):
        self.options, self.ask = options, ask

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        yield from search_pages(
            self.ask, o.get("endpoint", ENDPOINT), float(o["latitude"]), float(o["longitude"]), float(o["radius_m"]),
            limit=int(o.get("limit", 2000)), page_limit=int(o.get("page_limit", 500)), timeout=float(o.get("timeout_s", 30)),
        )


WORLD = (-180.0, -90.0, 180.0, 90.0)


class PictureSource(DataSource):
    """spark.read.format("pictures"): a row for each feature of a search, with options limit, page_limit, endpoint
    and timeout_s.  The box that is asked for comes from the plan: comparisons of longitude and latitude with
    constants narrow it.  Without such comparisons it is the whole world.  Spark demands that
    spark.sql.python.filterPushdown.enabled is set for that; where it can't be, the option pushdown=false makes a source
    that asks for the whole world and leaves all filters to Spark."""

    ask: Client = staticmethod(client)

    @classmethod
    def name(cls) -> str:
        return "pictures"

    def schema(self) -> str:
        return "page_no bigint, pos int, longitude double, latitude double, feature string"

    def reader(self, schema) -> DataSourceReader:
        kind = _PictureReader if self.options.get("pushdown", "true") == "true" else _WholeReader
        return kind(dict(self.options), type(self).ask)


def _degrees(v) -> float | None:
    """A coordinate as items have it: a number, a boolean, or a string that spells a number."""
    if isinstance(v, (int, float)):
        return float(v)
    try:
        return float(v.strip()) if isinstance(v, str) else None
    except ValueError:
        return None


def _position(feature: dict) -> tuple[float | None, float | None]:
    geometry = feature.get("geometry")
    coordinates = geometry.get("coordinates") if isinstance(geometry, dict) else None
    if not isinstance(coordinates, list) or len(coordinates) < 2:
        return None, None
    return _degrees(coordinates[0]), _degrees(coordinates[1])


#: Comparisons that the reader takes over: which side of the box each narrows, and what it says of a value.
#: A coordinate that is no number passes for larger than all others, as in Spark.
COMPARISONS = {
    GreaterThan: ("low", lambda x, v: x > v or x != x),
    GreaterThanOrEqual: ("low", lambda x, v: x >= v or x != x),
    LessThan: ("high", lambda x, v: x < v),
    LessThanOrEqual: ("high", lambda x, v: x <= v),
    EqualTo: ("low high", lambda x, v: x == v),
}


class _WholeReader(DataSourceReader):
    def __init__(self, options: dict, ask: Client):
        self.options, self.ask, self.box, self.tests = options, ask, list(WORLD), []

    def _passes(self, position: tuple[float | None, float | None]) -> bool:
        return all(position[at] is not None and (kind is IsNotNull or COMPARISONS[kind][1](position[at], value)) for at, kind, value in self.tests)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        if self.box[0] > self.box[2] or self.box[1] > self.box[3]:
            return  # filters that exclude each other
        pages = box_pages(self.ask, o.get("endpoint", ENDPOINT), tuple(self.box), limit=int(o.get("limit", 2000)), page_limit=int(o.get("page_limit", 500)), timeout=float(o.get("timeout_s", 30)))
        for number, text in pages:
            for pos, feature in enumerate(json.loads(text)["features"]):
                if isinstance(feature, dict) and self._passes(place := _position(feature)):
                    yield number, pos, *place, json.dumps(feature, ensure_ascii=False)


class _PictureReader(_WholeReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes comparisons of a coordinate with a number, which narrow the box and are applied to each
        feature as well, since a provider may round; other filters stay with Spark."""
        for f in filters:
            at = {("longitude",): 0, ("latitude",): 1}.get(getattr(f, "attribute", None))
            value = getattr(f, "value", None)
            if at is not None and isinstance(f, IsNotNull):
                self.tests.append((at, IsNotNull, 0.0))
            elif at is not None and type(f) in COMPARISONS and isinstance(value, (int, float)) and value == value:
                sides = COMPARISONS[type(f)][0]
                if "low" in sides:
                    self.box[at] = max(self.box[at], float(value))
                if "high" in sides:
                    self.box[at + 2] = min(self.box[at + 2], float(value))
                self.tests.append((at, type(f), float(value)))
            else:
                yield f


class SearchStreamSource(DataSource):
    """spark.readStream.format("picture_search_stream"): the pages of a search, one a micro-batch, with the
    options of picture_search.  The offset is the next request, so a query that was stopped after page k goes on with
    page k + 1.  Requests that come again end the search (Brent's cycle test, whose state is two requests
    and two counts); what a cycle repeats until then are copies, which candidates dedupe."""

    ask: Client = staticmethod(client)

    @classmethod
    def name(cls) -> str:
        return "picture_search_stream"

    def schema(self) -> str:
        return "page_no bigint, body string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _StreamReader(dict(self.options), type(self).ask)


class _StreamReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict, ask: Client):
        self.options, self.ask = options, ask
        self.endpoint, self.timeout = options.get("endpoint", ENDPOINT), float(options.get("timeout_s", 30))

    def initialOffset(self) -> dict:
        o = self.options
        box = bbox_for_radius(float(o["latitude"]), float(o["longitude"]), float(o["radius_m"]))
        return {"page": 0, "next": mark(first_request(self.endpoint, box, int(o.get("page_limit", 500)))), "seen": "", "span": 1, "since": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if not start["next"]:
            return iter(()), start
        _, text, following = one_page(self.ask, self.endpoint, tuple(json.loads(start["next"])), self.timeout)
        end = start | {"page": start["page"] + 1, "next": "" if following is None else mark(following), "since": start["since"] + 1}
        if end["next"] in (start["seen"], start["next"]):
            end["next"] = ""
        if end["since"] == start["span"]:
            end |= {"seen": start["next"], "span": 2 * start["span"], "since": 0}
        return iter([(start["page"], text)]), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        while start["page"] < end["page"]:
            rows, start = self.read(start)
            yield from rows


#: Requests to one host at a time within a task, tries of each, and seconds before the second one, doubled from try to try.
PER_HOST, TRIES, WAIT_S = 4, 3, 0.5
AGAIN = (408, 425, 429, 500, 502, 503, 504)


class _Answers:
    """Answers to the requests of one task: in order, some of them under way at a time."""

    def __init__(self, ask: Client, timeout: float, per_host: int, tries: int, wait_s: float):
        self.ask, self.timeout, self.tries, self.wait_s = ask, timeout, tries, wait_s
        self.hosts: dict[str, Semaphore] = defaultdict(lambda: Semaphore(per_host))
        self.pool = ThreadPoolExecutor(4 * per_host)

    def one(self, url: str, host: Semaphore) -> tuple[int | None, dict, bytes | None, str | None, int]:
        """(status, headers, body, error, tries); what looks passing is tried again, later each time."""
        for k in range(1, self.tries + 1):
            error = found = None
            try:
                with host:
                    found = self.ask("GET", url, None, self.timeout, MAX_BYTES + 1)
            except urllib.error.HTTPError as exc:
                found = (exc.code, dict(exc.headers or {}), b"")
            except Exception as exc:  # noqa: BLE001  any failure becomes a row
                error = str(exc)
            if k == self.tries or (found is not None and found[0] not in AGAIN):
                break
            time.sleep(self.wait_s * 2 ** (k - 1))
        return (*found, None, k) if found is not None else (None, {}, None, error, k)

    def all(self, urls: list[str | None]) -> Iterator[tuple]:
        """A window of requests is under way, so answers held are bounded whatever the batch."""
        waiting: deque = deque()
        for url in urls:
            waiting.append(url and self.pool.submit(self.one, url, self.hosts[urllib.parse.urlsplit(url).netloc]))
            if len(waiting) > 8 * PER_HOST:
                yield self._answer(waiting.popleft())
        while waiting:
            yield self._answer(waiting.popleft())

    @staticmethod
    def _answer(future) -> tuple:
        return future.result() if future is not None else (None, {}, None, None, 0)


def fetch(top: DataFrame, *, timeout: float = 30.0, ask: Client = client, per_host: int = PER_HOST, tries: int = TRIES, wait_s: float = WAIT_S) -> DataFrame:
    """Answers for the rows of a shortlist (rank, source_url): the item, then the
    thumbnail that it advertises.  At most MAX_BYTES and one are read.  A task has at most per_host requests
    to a host under way; attempts counts both requests' tries."""

    def get(batches: Iterator[pa.RecordBatch], url: str, status: str, body: str, error: str, kind: str | None) -> Iterator[pa.RecordBatch]:
        answers = _Answers(ask, timeout, per_host, tries, wait_s)
        try:
            yield from answered(batches, answers, url, status, body, error, kind)
        finally:
            answers.pool.shutdown(wait=False, cancel_futures=True)

    def answered(batches: Iterator[pa.RecordBatch], answers: _Answers, url: str, status: str, body: str, error: str, kind: str | None) -> Iterator[pa.RecordBatch]:
        types = {status: pa.int32(), body: pa.binary() if kind else pa.string(), error: pa.string(), "attempts": pa.int32()} | ({kind: pa.string()} if kind else {})
        for batch in batches:
            kept = [n for n in batch.schema.names if n != "attempts"]
            before = batch.column("attempts").to_pylist() if "attempts" in batch.schema.names else [0] * batch.num_rows
            found = answers.all(batch.column(url).to_pylist())
            for i, (code, headers, raw, failed, k) in enumerate(found):  # a row at a time: a thumbnail may have 5 MiB
                new = {status: code, body: raw if kind or raw is None else raw.decode("utf-8", "replace"), error: failed, "attempts": before[i] + k}
                if kind:
                    new[kind] = None if code is None else next((v for x, v in headers.items() if x.lower() == "content-type"), "")
                yield pa.RecordBatch.from_arrays([batch.column(n).slice(i, 1) for n in kept] + [pa.array([new[n]], t) for n, t in types.items()], names=[*kept, *types])

    rows = top.select("rank", F.when(is_http_url(F.col("source_url")), F.col("source_url")).alias("url"))
    first = rows.mapInArrow(lambda b: get(b, "url", "item_status", "item_body", "item_error", None), "rank int, url string, item_status int, item_body string, item_error string, attempts int")
    thumb = thumbnail_of(F.col("item_body"))
    second = first.withColumn("thumb", F.when(is_http_url(thumb), thumb)).drop("url")
    done = second.mapInArrow(
        lambda b: get(b, "thumb", "thumb_status", "content", "thumb_error", "content_type"),
        "rank int, item_status int, item_body string, item_error string, thumb string, thumb_status int, content binary, thumb_error string, attempts int, content_type string",
    )
    return done.select(*[f.split(" ")[0] for f in ANSWER.split(", ")], "attempts")
