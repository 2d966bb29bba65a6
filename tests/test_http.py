import json

from meterline.plans.query import bind_flux, bind_sql, flux_literal
from meterline.settings import duration, size
from meterline.sources.http import Delivery, HttpOptions, Refused

LINES = [f"m f={i} {i}" for i in range(100)]


def run(answer, lines=LINES, **o):
    got = []

    def send(options, body):
        part = body.decode().splitlines()
        answer(part)
        got.extend(part)

    out = Delivery(HttpOptions("http://x", "db", **o), send, lambda s: None).run(lines)
    return out, got


def test_retry_then_success():
    state = {"n": 0}

    def answer(part):
        state["n"] += 1
        if state["n"] < 3:
            raise Refused(503, "busy", 0.1) if state["n"] == 1 else OSError("reset")

    out, got = run(answer)
    assert (out.written, out.retries, got) == (100, 2, LINES)


def test_too_large_is_halved():
    def answer(part):
        if len(part) > 10:
            raise Refused(413, "too large")

    out, got = run(answer)
    # parts of at most 1 KiB are not cut further
    assert out.written + sum(len(f.lines) for f in out.failures) == 100


def test_named_and_quoted_and_unnamed_lines():
    body = json.dumps({"error": "partial write", "data": [{"line_number": 3, "error_message": "bad"}]})

    def partial(part):
        raise Refused(400, body)

    out, _ = run(partial)
    assert out.written == 99 and out.failures[0].lines == [LINES[2]]

    def quoted(part):
        if LINES[7] in part:
            raise Refused(400, f"unable to parse '{LINES[7]}': bad")

    out, got = run(quoted)
    assert out.written == 99 and out.failures[0].lines == [LINES[7]] and LINES[8] in got

    def unnamed(part):
        if LINES[50] in part:
            raise Refused(400, "line protocol parse failed")

    out, got = run(unnamed)
    assert out.written == 99 and [f.lines for f in out.failures] == [[LINES[50]]]


def test_fatal():
    def denied(part):
        raise Refused(401, "no")

    out, _ = run(denied, batch_lines=40)
    assert out.written == 0 and {f.code for f in out.failures} == {"unauthorized"} and len(out.failures) == 3


def test_parameters_and_units():
    assert bind_sql("SELECT '$a', \"t\" FROM x WHERE b = $b", {"b": 1}) == ("SELECT '$a', `t` FROM x WHERE b = :b", {"b": 1})
    assert flux_literal({"a": [1, 2.5, True, 'x"${y}']}) == '{a: [1, float(v: "2.5"), true, "x\\"\\${y}"]}'
    assert bind_flux('import "strings"\nfrom()', {"a": 1}).startswith('import "strings"\noption params')
    assert (duration("1m30s"), size("8MiB")) == (90.0, 8 << 20)
