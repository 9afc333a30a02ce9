"""Paged REST fetches: a small driver-side client with retries, landed as page files that Spark then reads.

No request is made on import. The transport is a parameter, so tests need no network.
"""

from __future__ import annotations

import http.client
import json
import os
import shutil
import time
import urllib.error
import urllib.parse
import urllib.request
import zipfile
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from pathlib import Path

from moneyflow.sources.store import LocalStore

Transport = Callable[[str], tuple[int, dict, bytes]]

RETRIED = {429, 500, 502, 503, 504, 599}


def http_get(url: str, timeout: float = 60) -> tuple[int, dict, bytes]:
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers or {}), e.read()


#: Stands for a connection that timed out, broke or was refused; it is tried again like a busy server.
NO_ANSWER = 599


class PagedClient:
    """GET with retries that honour Retry-After, and pagination by ``next`` links or page numbers."""

    def __init__(self, base: str, transport: Transport = http_get, key: str | None = None, tries: int = 8, longest_wait: float = 60, sleep: Callable[[float], None] = time.sleep):
        self.base, self.transport, self.key, self.tries, self.longest_wait, self.sleep = base.rstrip("/"), transport, key, tries, longest_wait, sleep

    def get(self, path: str, **params) -> dict:
        query = params | ({"api_key": self.key} if self.key else {})
        url = path if path.startswith("http") else f"{self.base}/{path.lstrip('/')}"
        if query:
            url += ("&" if "?" in url else "?") + urllib.parse.urlencode(query)
        for attempt in range(self.tries):
            try:
                status, headers, body = self.transport(url)
            except (OSError, http.client.HTTPException):  # urllib's errors and time-outs among them
                status, headers, body = NO_ANSWER, {}, b""
            if status < 400:
                return json.loads(body)
            if status not in RETRIED:
                break
            wait = headers.get("Retry-After", "")
            self.sleep(min(self.longest_wait, float(wait) if wait.isdigit() else 2.0**attempt))
        raise RuntimeError(f"{self._safe(url)}: status {status}")

    def _safe(self, url: str) -> str:
        return url.replace(self.key, "***") if self.key else url

    def pages(self, path: str, max_pages: int | None = None, **params) -> Iterator[dict]:
        """Pages until an empty one, no ``next`` link, the last page number, or the cap."""
        page = 1
        while max_pages is None or page <= max_pages:
            got = self.get(path, page=page, **params)
            if not got.get("results"):
                return
            yield got
            total = (got.get("pagination") or {}).get("pages")
            if (total is not None and page >= total) or (total is None and not got.get("next")):
                return
            page += 1


def ingest(
    client: PagedClient, path: str, folder: str, max_pages: int | None = None, stamp: str = "dt_posted", store: LocalStore | None = None, force: bool = False, **params
) -> dict:
    """Land pages as files and write a manifest.

    A complete manifest is left alone unless ``force`` is set, so a run can be repeated; a run that was cut short goes
    on at the last page it landed, which may have been partial.
    """
    store = store or LocalStore()
    manifest = f"{folder}/manifest.json"
    if not force and store.exists(manifest) and (known := store.read_json(manifest)).get("complete"):
        return known
    landed = [] if force else [n for n in store.names(folder) if n.startswith("page_") and n.endswith(".json")]
    page, reported, reason = max(1, len(landed)), None, "max_pages_reached"
    while max_pages is None or page <= max_pages:
        got = client.get(path, page=page, **params)
        reported = got.get("count", reported)
        if not got.get("results"):
            reason = "empty_results"
            break
        store.write_json(f"{folder}/page_{page:05d}.json", got)
        total = (got.get("pagination") or {}).get("pages")
        if (total is not None and page >= total) or (total is None and not got.get("next")):
            reason = "pagination_exhausted"
            break
        page += 1
    names = [n for n in store.names(folder) if n.startswith("page_") and n.endswith(".json")]
    n_rows, low, high = 0, None, None
    for name in names:
        rows = store.read_json(f"{folder}/{name}")["results"]
        stamps = [r[stamp] for r in rows if r.get(stamp)]
        n_rows += len(rows)
        low, high = min([*stamps, *([low] if low else [])], default=None), max([*stamps, *([high] if high else [])], default=None)
    out = {"page_count": len(names), "row_count": n_rows, "api_reported_count": reported, "complete": reason != "max_pages_reached" and reported == n_rows, "stop_reason": reason, "min_" + stamp: low, "max_" + stamp: high}
    store.write_json(manifest, out)
    return out


# The service's lists of codes
LOOKUPS = {
    "filing_types": "constants/filing/filingtypes/", "lobbying_activity_issues": "constants/filing/lobbyingactivityissues/", "government_entities": "constants/filing/governmententities/",
    "contribution_item_types": "constants/contribution/itemtypes/", "states": "constants/general/states/", "countries": "constants/general/countries/",
}


def lookups(client: PagedClient, folder: str, store: LocalStore | None = None, force: bool = False) -> dict:
    """Land each list of codes once, and a manifest with their lengths."""
    store, rows = store or LocalStore(), []
    for key, path in LOOKUPS.items():
        file = f"{folder}/{key}.json"
        if force or not store.exists(file):
            store.write_json(file, client.get(path))
        got = store.read_json(file)
        rows.append({"key": key, "path": path, "file": file, "row_count": len(got) if isinstance(got, list) else None})
    out = {"lookups": rows}
    store.write_json(f"{folder}/manifest.json", out)
    return out


def ingest_year(client: PagedClient, year: int, folder: str, store: LocalStore | None = None, page_size: int = 100, max_pages: int | None = None, with_lookups: bool = True) -> dict:
    """Both endpoints of a year, and the lists of codes."""
    store = store or LocalStore()
    ends = {e: ingest(client, f"{e}/", f"{folder}/{year}/{e}", max_pages, store=store, ordering="dt_posted", filing_year=year, page_size=page_size) for e in ("filings", "contributions")}
    out = {"year": year, "endpoints": ends, "complete": all(m["complete"] for m in ends.values())}
    if with_lookups:
        out["lookups"] = lookups(client, f"{folder}/lookups", store)["lookups"]
    store.write_json(f"{folder}/{year}/run_manifest.json", out)
    return out


def pages_needed(rows: int, page_size: int) -> int:
    return -(-rows // page_size)


def download(url: str, target: str, opener: Callable = urllib.request.urlopen, chunk: int = 8 << 20) -> None:
    """Stream to a temporary file beside the target, then rename; the time of the file is the server's."""
    part = target + ".part"
    with opener(url) as r, open(part, "wb") as out:
        while block := r.read(chunk):
            out.write(block)
        stamp = r.headers.get("Last-Modified")
    os.replace(part, target)
    if stamp:
        at = parsedate_to_datetime(stamp).timestamp()
        os.utime(target, (at, at))


def extract(archive: str, folder: str, expected: list[str]) -> None:
    """Unpack into a new folder and swap it in; missing members raise and leave the old folder."""
    fresh = Path(folder + ".new")
    with zipfile.ZipFile(archive) as z:
        z.extractall(fresh)
    if lacking := [n for n in expected if not any(fresh.rglob(n))]:
        raise FileNotFoundError(f"{archive} lacks {lacking}")
    old = Path(folder)
    if old.exists():
        shutil.rmtree(folder + ".old", ignore_errors=True)
        os.replace(old, folder + ".old")
    os.replace(fresh, old)
    shutil.rmtree(folder + ".old", ignore_errors=True)


def freshness(remote: dict[str, str | None], local: dict[str, str | None]) -> list[dict]:
    """Sources with their remote and local ISO times, compared as text; what is missing or older is stale."""
    return [{"source": s, "remote": t, "local": local.get(s), "stale": t is not None and (local.get(s) or "") < t} for s, t in sorted(remote.items())]


def head(url: str, timeout: float = 20) -> dict[str, str]:
    with urllib.request.urlopen(urllib.request.Request(url, method="HEAD"), timeout=timeout) as r:  # noqa: S310
        return dict(r.headers)


def _iso(seconds: float) -> str:
    return datetime.fromtimestamp(seconds, UTC).replace(microsecond=0).isoformat()


def source_status(sources: dict[str, tuple[str, str]], heads: Callable[[str], dict[str, str]] = head) -> list[dict]:
    """{key: (url, local path)} to one row each: what the server says, what is here, and whether the server's is newer."""
    out = []
    for key, (url, path) in sources.items():
        local, headers, error = _iso(os.path.getmtime(path)) if os.path.exists(path) else None, {}, ""
        try:
            headers = heads(url)
        except Exception as e:  # noqa: BLE001  a source that does not answer is a row with the error
            error = str(e)
        remote = _iso(parsedate_to_datetime(headers["Last-Modified"]).timestamp()) if headers.get("Last-Modified") else None
        size = int(headers["Content-Length"]) if headers.get("Content-Length") else None
        out.append(
            {"key": key, "remote_url": url, "local_path": path, "local_exists": local is not None, "local_last_modified_utc": local, "remote_last_modified_utc": remote,
             "remote_content_length": size, "remote_etag": headers.get("ETag"), "remote_is_newer": bool(local and remote and remote > local), "remote_error": error}
        )
    return out


def source_manifest(cycle: int, status: list[dict]) -> dict:
    times = [r["remote_last_modified_utc"] for r in status if r["remote_last_modified_utc"]]
    return {
        "cycle": cycle, "latest_bulk_release_utc": max(times, default=None), "bulk_sources": status,
        "sources_with_remote_newer_than_local": [r["key"] for r in status if r["remote_is_newer"]], "all_local_bulk_files_present": all(r["local_exists"] for r in status),
    }


def update_cycle(sources: dict[str, tuple[str, str]], force: bool = False, heads: Callable = head, opener: Callable = urllib.request.urlopen) -> list[str]:
    """Download and unpack the archives whose server copy is newer than the local file, or unknown; returns their keys."""
    done = []
    for row in source_status(sources, heads):
        if not force and row["local_exists"] and row["remote_last_modified_utc"] and not row["remote_is_newer"]:
            continue
        folder, name = os.path.split(row["local_path"])
        archive = folder + ".zip"
        os.makedirs(os.path.dirname(folder) or ".", exist_ok=True)
        download(row["remote_url"], archive, opener)
        extract(archive, folder, [name])
        at = os.path.getmtime(archive)
        os.utime(row["local_path"], (at, at))
        done.append(row["key"])
    return done


def load_env(path: str) -> dict[str, str]:
    """KEY=VALUE lines; comments, quotes and ``export`` are understood."""
    out = {}
    for line in Path(path).read_text().splitlines() if Path(path).exists() else []:
        line = line.strip().removeprefix("export ").strip()
        if line and not line.startswith("#") and "=" in line:
            k, v = line.split("=", 1)
            out[k.strip()] = v.strip().strip("\"'")
    return out
