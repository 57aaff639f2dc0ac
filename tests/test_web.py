import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from curatrix.operators import reasoning
from curatrix.sources import web

PNG = bytes.fromhex("89504E470D0A1A0A") + b"x" * 200


@pytest.fixture(scope="module")
def site():
    asked = {}

    class Pages(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def answer(self, status, body=b"", kind="text/html"):
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            asked[self.path] = asked.get(self.path, 0) + 1
            if self.path == "/shaky":
                self.answer(*((200, PNG, "image/png") if asked[self.path] > 2 else (503,)))
            elif self.path == "/image":
                self.answer(200, PNG, "image/png")
            elif self.path == "/page":
                self.answer(200, b"<html>" + b"y" * 300)
            elif self.path == "/broken":
                self.answer(500)
            else:
                self.answer(404)

        def do_POST(self):
            said = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            self.answer(200, json.dumps({"text": said["prompt"].upper(), "key": self.headers.get("X-Key")}).encode(), "application/json")

    server = ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def test_addresses_are_fetched_with_bounded_tries(spark, site):
    host, asked = site
    urls = [f"{host}/{p}" for p in ("shaky", "image", "image", "page", "broken", "none")] + [None, "", "ftp://x"]
    df = web.fetched(spark.createDataFrame([(u,) for u in urls], "url string"), web.Fetcher(pause=0.01, at_once=3))
    rows = {r.url: r for r in df.collect()}
    assert {u and u.replace(host, ""): (r.status, r.tries) for u, r in rows.items()} == {"/shaky": (200, 3), "/image": (200, 1), "/page": (200, 1), "/broken": (500, 3), "/none": (404, 1), None: (None, 0), "": (None, 0), "ftp://x": (None, 0)}
    assert df.count() == 8 and asked["/image"] == 1
    assert {r.url.replace(host, "") for r in web.valid_images(df).collect()} == {"/shaky", "/image"}
    long = web.fetched(spark.createDataFrame([(f"{host}/page",)], "url string"), web.Fetcher(most_bytes=50)).first()
    assert (long.error, long.body) == ("too long", None)
    lost = web.fetched(spark.createDataFrame([("http://127.0.0.1:1/x",)], "url string"), web.Fetcher(tries=2, pause=0.01)).first()
    assert lost.tries == 2 and lost.error and lost.status is None
    assert web.fetched(spark.createDataFrame([], "url string")).count() == 0


def test_a_service_is_asked_for_all_prompts(site):
    host, _ = site
    client = reasoning.rest_client(f"{host}/v1", lambda p: {"prompt": p}, lambda a: f"{a['text']}|{a['key']}", {"X-Key": "k"})
    assert client("abc") == "ABC|k"

    def sometimes(prompt):
        if prompt == "p3":
            raise ValueError("no")
        return client(prompt)

    answers = reasoning.ask_all(sometimes, [f"p{i}" for i in range(8)], at_once=5)
    assert [str(a) for a in answers] == [f"P{i}|k" if i != 3 else "no" for i in range(8)]


def test_prompts_with_images(tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x01")
    parts = reasoning.content_parts("look", ["http://h/x.jpg", str(tmp_path / "a.png")])
    assert parts[0] == {"type": "text", "text": "look"} and [p["image_url"]["url"] for p in parts[1:]] == ["http://h/x.jpg", "data:image/png;base64,AQ=="]
    with pytest.raises(FileNotFoundError):
        reasoning.content_parts("look", [str(tmp_path / "none.png")])
