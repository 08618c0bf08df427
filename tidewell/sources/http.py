"""The Arrow-over-HTTP protocol: query, plan, cancel and login. Standard library and pyarrow alone."""

from __future__ import annotations

import json
import random
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa

ARROW = "application/vnd.apache.arrow.stream"
#: Seconds without a byte after which a login or plan, and a query, fail.
TIMEOUT, QUERY_TIMEOUT = 30, 900


class RemoteError(OSError):
    """The server failed, or answered with something else than asked for."""


class BadRequest(ValueError):
    """The server refused the request as wrong."""


@dataclass(frozen=True)
class Split:
    """A part of a query that a server planned; it is a query of its own."""

    endpoints: tuple[str, ...]
    query_id: int
    query: str
    producer_id: str
    split_size: int
    query_checksum: str


def base_url(url: str) -> str:
    return url[:-1] if url.endswith("/") else url


def new_query_id() -> int:
    return random.getrandbits(62) + 1


def _open(url: str, accept: str, token: str | None, headers: dict | None = None, body: bytes | None = None, timeout: float | None = None):
    request = urllib.request.Request(url, data=body, headers={"Accept": accept, **(headers or {})})
    if token:
        request.add_header("Authorization", f"Bearer {token}")
    try:
        return urllib.request.urlopen(request, timeout=timeout)
    except urllib.error.HTTPError as e:
        text = e.read().decode("utf-8", "replace")[:1000]
        raise (BadRequest if 400 <= e.code < 500 else RemoteError)(f"{urllib.parse.urlsplit(url).path}: HTTP {e.code}: {text}") from None
    except urllib.error.URLError as e:
        raise RemoteError(f"{url.split('?')[0]}: {e.reason}") from None


def batches(url: str, query: str, token: str | None = None, query_id: int = -1) -> Iterator[pa.RecordBatch]:
    """The result's record batches as they arrive; if reading ends early, the server is told to cancel."""
    params = {"q": query} | ({"id": query_id} if query_id >= 0 else {})
    done = False
    try:
        with _open(f"{base_url(url)}/v1/query?{urllib.parse.urlencode(params)}", ARROW, token, timeout=QUERY_TIMEOUT) as response:
            kind = response.headers.get("Content-Type", "")
            if kind and ARROW not in kind and "application/octet-stream" not in kind:
                raise RemoteError(f"the server sent {kind}, not an Arrow stream")
            with pa.ipc.open_stream(response) as reader:
                yield pa.RecordBatch.from_pylist([], reader.schema)  # the schema, for empty results too
                yield from reader
        done = True
    except TimeoutError:
        raise RemoteError(f"the server sent nothing for {QUERY_TIMEOUT} seconds") from None
    except pa.ArrowInvalid as e:
        raise RemoteError(f"not a valid Arrow stream: {e}") from None
    finally:
        if not done and query_id >= 0:
            cancel(url, query, query_id, token)


def schema(url: str, query: str, token: str | None = None) -> pa.Schema:
    """The result's schema, without computing its rows."""
    return next(batches(url, f"SELECT * FROM ({query}) AS _subq LIMIT 0", token)).schema


def plan(url: str, query: str, token: str | None = None, split_size: int = -1) -> list[Split]:
    headers = {"x-dd-split-size": str(split_size)} if split_size > 0 else {}
    with _open(f"{base_url(url)}/v1/plan?{urllib.parse.urlencode({'q': query})}", "application/json", token, headers, timeout=TIMEOUT) as response:
        return parse_plan(response.read())


def parse_plan(text: bytes | str) -> list[Split]:
    """Entries without a query are skipped; anything but a list is an error."""
    try:
        found = json.loads(text)
    except ValueError as e:
        raise RemoteError(f"the plan is not JSON: {e}") from None
    if not isinstance(found, list):
        raise RemoteError("the plan is not a JSON array")
    out = []
    for entry in found:
        handle = ((entry.get("descriptor") or {}).get("statementHandle") or {}) if isinstance(entry, dict) else {}
        if handle.get("query"):
            out.append(Split(tuple(map(str, entry.get("endpoints") or ())), int(handle.get("queryId") or 0), str(handle["query"]), str(handle.get("producerId") or ""), int(handle.get("splitSize") or 0), str(handle.get("queryChecksum") or "")))
    return out


def cancel(url: str, query: str, query_id: int, token: str | None = None) -> None:
    """Ask the server to stop; whatever goes wrong here is not the caller's concern."""
    try:
        _open(f"{base_url(url)}/v1/cancel?{urllib.parse.urlencode({'q': query, 'id': query_id})}", "text/plain", token, timeout=5).close()
    except (OSError, ValueError):
        pass


def login(url: str, username: str, password: str, claims: str | None = None) -> str:
    """A token for ``username``. Of ``claims``, a JSON object as text, string values are sent; other text is ignored."""
    if username is None or password is None:
        raise ValueError("login needs a username and a password")
    body: dict = {"username": username, "password": password}
    try:
        given = json.loads(claims) if claims else None
    except ValueError:
        given = None
    if isinstance(given, dict) and (own := {k: v for k, v in given.items() if isinstance(v, str)}):
        body["claims"] = own
    parts = urllib.parse.urlsplit(url if "://" in url else f"http://{url}")
    with _open(f"{parts.scheme}://{parts.netloc}/v1/login", "application/json", None, {"Content-Type": "application/json"}, json.dumps(body).encode(), TIMEOUT) as response:
        token = json.loads(response.read() or b"{}").get("accessToken")
    if not token:
        raise RemoteError("the login's answer has no accessToken")
    return token
