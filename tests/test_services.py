"""Adapters against a local server that stands in for the hosted ones, and the commands."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from tamarack import adapters, backends, cli
from tamarack.config import Settings

TEXT = "Defendant shall pay $100.00 on or before 2/1/2024"


@pytest.fixture
def server():
    asked, answers = [], []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked.append((self.path, self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            code, told = answers.pop(0) if len(answers) > 1 else answers[0]
            body = json.dumps({"choices": [{"message": {"content": told}}]}).encode()
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    s = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/v1", asked, answers
    s.shutdown()


def test_hosted_reader_and_model(server):
    url, asked, answers = server
    settings = Settings(llm_api_key="k", llm_base_url=url, llm_model="m", ocr_model="eyes", ocr_backend="hosted")
    answers.append((200, "page text"))
    assert adapters.reader(settings)().read(b"png") == "page text"
    path, key, body = asked.pop()
    assert (path, key, body["model"], body["max_tokens"]) == ("/v1/chat/completions", "Bearer k", "eyes", 8192)
    assert body["messages"][0]["content"][0]["image_url"]["url"] == "data:image/png;base64,cG5n"
    assert adapters.ChatModel(settings).answer(TEXT) == "page text"
    body = asked.pop()[2]
    assert body["temperature"] == 0.1 and body["response_format"] == {"type": "json_object"} and body["messages"][1]["content"].endswith(TEXT)
    answers[:] = [(429, "slow down"), (200, "read")]
    waits = []
    assert backends.retried(lambda: adapters.HostedReader(settings).read(b"x"), wait=waits.append) == "read" and waits == [2.0]
    with pytest.raises(ValueError):
        adapters.ChatModel(Settings())
    with pytest.raises(ValueError):
        adapters.reader(Settings())


def test_second_opinion_is_asked_again(server):
    url, asked, answers = server
    waits = []
    two = adapters.SecondOpinion(Settings(llm_api_key="k", llm_base_url=url, llm_model="m"), waits.append)
    good = '{"outcome_type": "Pay and Stay", "reasoning": "r"}'
    answers[:] = [(200, "no JSON"), (429, "rate_limit"), (200, f"```json\n{good}\n```")]
    assert two.answer("Case: unknown") == good and waits == [1.0, 20.0] and asked[0][2]["temperature"] == 0
    answers[:] = [(200, '{"outcome_type": "Maybe"}')]
    with pytest.raises(ValueError):
        two.answer("x")
    answers[:] = [(401, "who")]
    with pytest.raises(RuntimeError):
        two.answer("x")


class Pages:
    def pages(self, pdf, dpi):
        if pdf == b"bad":
            raise ValueError("broken")
        return [pdf]


class Reader:
    def read(self, png):
        return TEXT


def test_commands(spark, tmp_path, capsys, monkeypatch, server):
    url, asked, answers = server
    monkeypatch.setattr(cli, "session", lambda: spark)
    for name in ("LLM_API_KEY", "OCR_BACKEND", "USE_LLM"):
        monkeypatch.delenv(name, raising=False)
    src, pdfs = tmp_path / "in", tmp_path / "pdfs"
    src.mkdir()
    pdfs.mkdir()
    for n in ("a.txt", "b.txt"):
        (src / n).write_text(TEXT)
    for n, x in (("a.pdf", b"good"), ("b.pdf", b"bad")):
        (pdfs / n).write_bytes(x)
    assert cli.main(["extract", str(src / "a.txt"), "--regex-only"]) == 0
    assert json.loads(capsys.readouterr().out)["outcome_type"] == "Pay and Stay"
    here = [f"--rasterizer={__name__}:Pages", f"--reader={__name__}:Reader"]
    assert cli.main(["process", str(pdfs / "a.pdf"), *here]) == 0
    assert json.loads(capsys.readouterr().out)["payment_schedule"][0]["amount"] == "100.00"
    assert cli.main(["process", str(pdfs / "b.pdf"), *here]) == 1
    out = str(tmp_path / "out")
    assert cli.main(["extract-dir", str(src), "-o", out, "--no-clean", "--regex-only"]) == 0
    assert cli.main(["extract-dir", str(src), "-o", out, "--resume"]) == 0
    assert [r.source_file for r in spark.read.option("header", True).csv(out).collect()] == ["a.txt", "b.txt"]
    out = str(tmp_path / "wide")
    assert cli.main(["process-dir", str(pdfs), "-o", out, *here]) == 0
    assert spark.read.option("header", True).csv(out).count() == 1
    assert [r.file for r in spark.read.json(out + ".errors").collect()] == ["b.pdf"]
    for k, v in {"LLM_API_KEY": "k", "LLM_BASE_URL": url, "LLM_MODEL": "m"}.items():
        monkeypatch.setenv(k, v)
    answers[:] = [(200, '{"plaintiff": "From Model"}')]
    assert cli.main(["extract", str(src / "a.txt")]) == 0
    assert json.loads(capsys.readouterr().out)["plaintiff"] == "From Model" and len(asked) == 1
