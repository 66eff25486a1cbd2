"""Downloads against a local server that cuts answers, asks to wait, fails and refuses."""

import hashlib
import http.server
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import downloads
from corpusloom.state.tables import Downloads

BODY = {f"/f{k}": bytes(hashlib.sha256(str(k).encode()).digest() * (400 + 90 * k)) for k in range(6)}


class Server(http.server.BaseHTTPRequestHandler):
    """f0 is plain, f1 cut twice, f2 asks to wait once, f3 fails once, f4 changes between two requests, f5 is cut and knows no ranges."""

    seen: Counter = Counter()
    sent: Counter = Counter()
    ranges: list = []
    down = False

    def do_GET(self):
        path, n = self.path, Server.seen[self.path]
        Server.seen[path] += 1
        if Server.down or path not in BODY and not path.startswith("/8/"):
            return self.refuse(503 if Server.down else 404)
        if path == "/f2" and n == 0:
            return self.refuse(429, {"Retry-After": "0"})
        if path == "/f3" and n == 0:
            return self.refuse(503)
        body, etag, start = BODY.get(path, path.encode()), f'"{path}"', 0
        if path == "/f4" and n > 0:
            body, etag = body[::-1], '"other"'
        asked = self.headers.get("Range")
        if asked:
            Server.ranges.append((path, asked))
            if self.headers.get("If-Range") == etag and path != "/f5":
                start = int(asked.removeprefix("bytes=").removesuffix("-"))
        self.send_response(206 if start else 200)
        self.send_header("ETag", etag)
        self.send_header("Content-Length", str(len(body) - start))
        self.end_headers()
        cut = n < {"/f1": 2, "/f4": 1, "/f5": 1}.get(path, 0)
        data = body[start : start + (len(body) - start) // 2] if cut else body[start:]
        Server.sent[path] += len(data)
        self.wfile.write(data)
        if cut:
            self.close_connection = True

    def refuse(self, code, headers=None):
        self.send_response(code)
        for k, v in (headers or {}).items():
            self.send_header(k, v)
        self.send_header("Content-Length", "0")
        self.end_headers()

    def log_message(self, *args):
        pass


@pytest.fixture
def base():
    Server.seen, Server.sent, Server.ranges, Server.down = Counter(), Counter(), [], False
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_cut_and_refused_answers(spark, tmp_path, base):
    rows = spark.createDataFrame([(f"{base}/f{k}", f"d/file{k}") for k in range(6)] + [(f"{base}/nowhere", "none"), (None, "null"), (f"{base}/f0", "d/file0"), ("no://address", "odd")], "url string, name string")
    options = {"folder": str(tmp_path / "out"), "state": str(tmp_path / "state"), "factor": 0.01}
    made = {r["name"]: r for r in downloads.download(spark, rows, **options).collect()}
    for k in range(6):
        want = BODY["/f4"][::-1] if k == 4 else BODY[f"/f{k}"]
        assert (tmp_path / "out" / "d" / f"file{k}").read_bytes() == want and made[f"d/file{k}"]["bytes"] == len(want)
    assert {n: r["status"] for n, r in made.items()} == {**{f"d/file{k}": "done" for k in range(6)}, "none": "gone", "null": "gone", "odd": "gone"}
    assert [made[f"d/file{k}"]["tries"] for k in range(4)] == [1, 3, 2, 2]
    assert Server.sent["/f1"] == len(BODY["/f1"])  # three requests, no byte twice
    assert {p for p, _ in Server.ranges} == {"/f1", "/f4", "/f5"}
    assert sorted(p.name for p in (tmp_path / "out" / "d").iterdir()) == [f"file{k}" for k in range(6)]
    before = sum(Server.seen.values())
    assert downloads.download(spark, rows, **options).collect() == [] and sum(Server.seen.values()) == before
    assert {r["status"]: r["files"] for r in downloads.report(Downloads(spark, str(tmp_path / "state")).read()).collect()} == {"done": 6, "gone": 3}


def test_a_second_run_fetches_what_is_left(spark, tmp_path, base):
    rows = spark.createDataFrame([(f"{base}/f1", "a"), (f"{base}/f0", "b")], "url string, name string")
    options = {"folder": str(tmp_path / "out"), "state": str(tmp_path / "state"), "factor": 0.01}
    first = {r["name"]: r for r in downloads.download(spark, rows, retries=0, **options).collect()}
    assert (first["a"]["status"], first["b"]["status"]) == ("failed", "done") and 0 < first["a"]["bytes"] < len(BODY["/f1"])
    Server.down = True
    assert [r["status"] for r in downloads.download(spark, rows, retries=1, **options).collect()] == ["failed"]
    Server.down = False
    (last,) = downloads.download(spark, rows, **options).collect()
    assert last["status"] == "done" and (tmp_path / "out" / "a").read_bytes() == BODY["/f1"]
    assert Server.sent["/f1"] == len(BODY["/f1"]) and Server.sent["/f0"] == len(BODY["/f0"])


def test_tiles_as_files(spark, tmp_path, base):
    made = downloads.scrape_tiles(spark, base, str(tmp_path / "t"), str(tmp_path / "s"), zoom=8, ratio=0.5, tasks=2)
    names = sorted(p.name for p in (tmp_path / "t").iterdir())
    assert names == sorted(r["name"] for r in made.collect()) and len(names) == 4
    assert made.filter(F.col("status") != "done").isEmpty()
    zoom, x, y = names[0].removesuffix(".png").split("_")
    assert (tmp_path / "t" / names[0]).read_bytes() == f"/{zoom}/{x}/{y}.png".encode()
