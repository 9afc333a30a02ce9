"""Fetching, landing, reconciling and reading back published files, with a transport in place of the network."""

import io
import json
import os
import subprocess
import sys
import zipfile
from email.utils import formatdate
from pathlib import Path

import pytest

from moneyflow.plans import reconcile, site
from moneyflow.sources import rest
from moneyflow.sources.store import HadoopStore, LocalStore


class Service:
    """Pages of rows in time order; ``slip`` rows are missing from the first answers, ``broken`` calls fail."""

    def __init__(self, rows, size=2, broken=0):
        self.rows, self.size, self.broken, self.asked = rows, size, broken, []

    def __call__(self, url):
        if self.broken:
            self.broken -= 1
            raise ConnectionResetError("peer")
        if "constants/" in url:
            return 200, {}, json.dumps([{"value": 1}, {"value": 2}]).encode()
        get = dict(x.split("=") for x in url.split("?")[1].split("&"))
        page, size = int(get["page"]), min(int(get.get("page_size", self.size)), self.size)
        self.asked.append(page)
        some = self.rows[(page - 1) * size : page * size]
        more = page * size < len(self.rows)
        return 200, {}, json.dumps({"count": len(self.rows), "next": "x" if more else None, "results": some}).encode()


def rows(n):
    return [{"filing_uuid": f"u{k}", "dt_posted": f"2024-01-{k // 2 + 1:02d}", "filing_year": 2024} for k in range(n)]


def client(service):
    return rest.PagedClient("http://x", service, sleep=lambda s: None)


def test_broken_connections_are_tried_again():
    assert client(Service(rows(2), broken=3)).get("filings/", page=1)["count"] == 2
    with pytest.raises(RuntimeError, match="599"):
        client(Service(rows(2), broken=99)).get("filings/", page=1)


def test_an_ingest_goes_on_where_it_stopped(tmp_path):
    service, folder = Service(rows(9)), str(tmp_path / "f")
    part = rest.ingest(client(service), "filings/", folder, max_pages=3)
    assert not part["complete"] and part["stop_reason"] == "max_pages_reached" and part["row_count"] == 6
    whole = rest.ingest(client(service), "filings/", folder)
    assert service.asked == [1, 2, 3, 3, 4, 5] and whole["complete"] and whole["row_count"] == 9 and whole["max_dt_posted"] == "2024-01-05"
    assert rest.ingest(client(service), "filings/", folder) == whole and len(service.asked) == 6


def test_a_year_is_landed_verified_and_reconciled(spark, tmp_path):
    root, store = "file://" + str(tmp_path / "lda"), HadoopStore(spark)
    service = Service(rows(7))
    out = rest.ingest_year(client(service), 2024, root, store, page_size=2)
    assert out["complete"] and [x["row_count"] for x in out["lookups"]] == [2] * 6 and store.exists(f"{root}/2024/run_manifest.json")
    assert reconcile.verify_year(spark, client(service), 2024, root)["complete_as_of_verification"]
    service.rows = rows(9)  # two rows more since
    late = reconcile.verify_year(spark, client(service), 2024, root)
    assert late["complete"] and not late["complete_as_of_verification"]
    done = reconcile.reconcile_year(spark, client(service), 2024, root, page_size=2)
    assert done["complete"] and done["snapshots"]["contributions"]["topped_up"] == 2
    assert sorted(r.filing_uuid for r in spark.read.json(f"{root}/2024/filings/snapshot.jsonl").collect()) == [f"u{k}" for k in range(9)]


def test_stores_agree(spark, tmp_path):
    for store, root in ((LocalStore(), str(tmp_path / "a")), (HadoopStore(spark), "file://" + str(tmp_path / "b"))):
        assert store.names(root) == [] and not store.exists(f"{root}/x.json")
        store.write_json(f"{root}/x.json", {"é": [1]})
        assert store.read_json(f"{root}/x.json") == {"é": [1]} and "x.json" in store.names(root)


def test_bulk_files_are_updated_when_the_server_has_newer_ones(tmp_path):
    path, now = str(tmp_path / "2024" / "cm24" / "cm.txt"), 1_700_000_000

    class Answer(io.BytesIO):
        headers = {"Last-Modified": formatdate(now, usegmt=True)}

    def opener(url):
        body = io.BytesIO()
        with zipfile.ZipFile(body, "w") as z:
            z.writestr("cm.txt", url)
        return Answer(body.getvalue())

    sources, heads = {"cm": ("http://x/cm24.zip", path)}, lambda url: {"Last-Modified": formatdate(now, usegmt=True), "Content-Length": "5", "ETag": "e"}
    assert rest.update_cycle(sources, heads=heads, opener=opener) == ["cm"] and Path(path).read_text() == "http://x/cm24.zip"
    assert rest.update_cycle(sources, heads=heads, opener=opener) == []
    os.utime(path, (now - 10, now - 10))
    status = rest.source_status(sources, heads)
    assert status[0]["remote_is_newer"] and status[0]["remote_content_length"] == 5
    manifest = rest.source_manifest(2024, status)
    assert manifest["sources_with_remote_newer_than_local"] == ["cm"] and manifest["latest_bulk_release_utc"].startswith("2023-11-14T22:13:20")
    assert rest.update_cycle(sources, heads=heads, opener=opener) == ["cm"]

    def silent(url):
        raise TimeoutError("no answer")

    assert rest.source_status(sources, silent)[0]["remote_error"] == "no answer"


def test_a_bundle_is_read_back(spark, tmp_path):
    for f in site.BUNDLE.values():
        LocalStore().write_json(f"{tmp_path}/2024/{f}", {"file": f})
    for f in site.BUNDLE_TABLES.values():
        LocalStore().write(f"{tmp_path}/2024/{f}", "a,b\n1,x\n")
    got = site.load_bundle(spark, "file://" + str(tmp_path), 2024)
    assert got["homepage"] == {"file": "homepage_summary.json"} and got["candidate_senate"].collect() == [("1", "x")]
    assert "<td>tech_pct</td>" in site.glossary_page()


def test_the_rest_works_without_the_training_operators(tmp_path):
    """In a copy without these folders the entry lists the other queries and their SQL."""
    import shutil

    root = Path(__file__).resolve().parent.parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "corpus_pipeline.py", "__pycache__")])
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(q) == set(s) and len(q) > 100 and not any(n.startswith('op') and n[2].isdigit() for n in q); print('fine')"
    assert subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True).stdout.strip().endswith("fine")
