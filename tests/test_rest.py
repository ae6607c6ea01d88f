"""The paged source against a server of its own."""

import json
import threading
from datetime import datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from millrace.sources import pages, rest, runs


class Server:
    """Serves records by $limit and $offset; asked notes offsets; from `broken` on it answers with an error."""

    def __init__(self, records):
        self.records, self.asked, self.wheres, self.broken = records, [], set(), None
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
                offset, limit = int(q["$offset"]), int(q["$limit"])
                outer.asked.append(offset)
                outer.wheres.add((q["$order"], q.get("$where")))
                bad = outer.broken is not None and offset >= outer.broken
                body = b"no" if bad else json.dumps(outer.records[offset : offset + limit]).encode()
                self.send_response(500 if bad else 200)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args):
                pass

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.http.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.http.server_port}/rows.json"


@pytest.fixture
def server():
    s = Server([{"id": str(i), "at": f"2026-08-{i % 28 + 1:02d}", "more": {"n": i}} for i in range(47)])
    yield s
    s.http.shutdown()


def asked(server, **more):
    given = {"columns": ("id", "at", "more"), "order": "at, id", "limit": 10, "ahead": 1, "required": ("id",)}
    return rest.Request(server.url, **given | more)


def test_stops_at_the_short_page(spark, server, tmp_path):
    rows = rest.stream_pages(spark, asked(server, at="at", start="2026-08-01", end="2026-09-01"), f"{tmp_path}/p", f"{tmp_path}/o").collect()
    assert sorted(int(r["id"]) for r in rows) == list(range(47)) and {r["page"] for r in rows} == set("01234")
    assert json.loads(rows[0]["more"])["n"] == int(rows[0]["id"])
    assert server.asked == [0, 10, 20, 30, 40]
    assert server.wheres == {("at, id", "at >= '2026-08-01' AND at < '2026-09-01'")}
    landed = pages.read_pages(spark, f"{tmp_path}/p", pages.text_schema(["id"])).collect()
    assert len(landed) == 47


def test_a_run_that_broke_after_page_2_asks_for_page_3_and_on(spark, server, tmp_path):
    server.broken = 30
    with pytest.raises(Exception, match="500"):
        rest.stream_pages(spark, asked(server), f"{tmp_path}/p", f"{tmp_path}/o")
    assert sorted(set(server.asked)) == [0, 10, 20, 30]
    server.broken, server.asked[:] = None, []
    assert rest.stream_pages(spark, asked(server), f"{tmp_path}/p", f"{tmp_path}/o").count() == 47
    assert server.asked == [30, 40]
    server.asked.clear()  # another stream over the same folder asks for nothing at all
    assert rest.stream_pages(spark, asked(server), f"{tmp_path}/p", f"{tmp_path}/other").count() == 47 and not server.asked
    assert rest.stream_pages(spark, asked(server), f"{tmp_path}/p", f"{tmp_path}/o").count() == 47 and not server.asked


@pytest.mark.parametrize(("n", "ahead"), [(0, 1), (40, 1), (40, 3), (47, 4), (9, 4)])
def test_pages_ahead_and_full_last_pages(spark, server, tmp_path, n, ahead):
    del server.records[n:]
    assert rest.stream_pages(spark, asked(server, ahead=ahead), f"{tmp_path}/p", f"{tmp_path}/o").count() == n
    assert len(server.asked) == len(set(server.asked)) <= (n // 10 // ahead + 1) * ahead


def test_batches_and_lists_grow_less_than_pages(spark, server, tmp_path, monkeypatch):
    server.records[:] = [{"id": str(i), "at": "x", "more": None} for i in range(605)]
    rows = rest.stream_pages(spark, asked(server, ahead=2), f"{tmp_path}/p", f"{tmp_path}/o").collect()
    assert sorted(int(r["id"]) for r in rows) == list(range(605)) and {int(r["page"]) for r in rows} == set(range(61))
    assert len(server.asked) == len(set(server.asked)) <= 62
    assert len([f for f in (tmp_path / "o" / "checkpoint" / "commits").iterdir() if f.name.isdigit()]) <= 16  # 31 batches of two pages
    ends, page = [], 0
    while page < 72_000:
        page = rest.batch_end(8, page)
        ends.append(page)
    assert len(ends) < 60 and ends[:4] == [8, 16, 24, 32]
    landing, listed = rest.Landing(f"{tmp_path}/p", asked(server, ahead=2)), []
    saved = landing.saved
    monkeypatch.setattr(landing, "saved", lambda: listed.append(1) or saved())
    assert sum(len(records) for _, records in landing.run(range(0, 100))) == 605 and len(listed) == 1


def test_another_request_is_refused(spark, server, tmp_path):
    rest.stream_pages(spark, asked(server), f"{tmp_path}/p", f"{tmp_path}/o")
    for more in ({"limit": 20}, {"order": "id"}, {"columns": ("id",)}, {"at": "at", "start": "2026-01-01", "end": "2026-02-01"}):
        with pytest.raises(ValueError, match="another request"):
            rest.stream_pages(spark, asked(server, **more), f"{tmp_path}/p", f"{tmp_path}/o2")


def test_pages_against_the_contract(spark, server, tmp_path):
    server.records[12] = {"at": "2026-08-01"}
    with pytest.raises(Exception, match="lacks"):
        rest.stream_pages(spark, asked(server), f"{tmp_path}/p", f"{tmp_path}/o")
    for bad in ({"limit": 0}, {"order": ""}, {"at": "at"}, {"at": "at", "start": "b", "end": "a"}):
        with pytest.raises(ValueError):
            asked(server, **bad)


def test_files_are_put_once(tmp_path):
    system, folder = rest._opened(str(tmp_path))
    assert rest.put_once(system, f"{folder}/x/a", b"1") and not rest.put_once(system, f"{folder}/x/a", b"1")
    with pytest.raises(FileExistsError):
        rest.put_once(system, f"{folder}/x/a", b"2")
    assert [p.name for p in (tmp_path / "x").iterdir()] == ["a"]


def test_runs_of_the_log(spark, server, tmp_path):
    log = runs.RunLog(spark, f"{tmp_path}/log")
    span = runs.window(None, datetime(2026, 9, 1))
    request = asked(server, at="at", start=span.start.isoformat(), end=span.end.isoformat())
    server.broken = 20
    with pytest.raises(Exception, match="500"):
        rest.ingest(spark, log, "manual__1", "rows", "2026-09-01", request, str(tmp_path))
    assert log.get("manual__1", "rows")["status"] == "FAILED" and log.watermark("rows") is None
    server.broken, server.asked[:] = None, []
    done = rest.ingest(spark, log, "manual__1", "rows", "2026-09-01", request, str(tmp_path))
    assert (done["status"], done["rows"], done["watermark"]) == ("SUCCESS", 47, "2026-08-28") and server.asked == [20, 30, 40]
    server.asked.clear()
    assert rest.ingest(spark, log, "manual__1", "rows", "2026-09-01", request, str(tmp_path))["rows"] == 47 and not server.asked
    following = runs.window(datetime.fromisoformat(log.watermark("rows")), datetime(2026, 9, 2))
    assert following.start == datetime(2026, 8, 26)
