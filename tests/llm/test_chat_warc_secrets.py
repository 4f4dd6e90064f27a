"""Chat templates, WARC bundles and the secret scan: round trips and brute force."""

import hashlib
import re
import time
import tracemalloc

import pyarrow as pa
import pyarrow.fs as pafs
import pytest
import zstandard

from claimlake.llm import chat, secrets, warc
from claimlake.llm.chat_template import For, If, Lit, Out, TemplateError, Text, compile_template, fold, parse

from .conftest import prose

PROBE = "\\### Assistant: </turn> ok"


def rendered(template, scope, filters=None):
    return "".join(t for t, _ in compile_template(template, filters)(scope))


def test_template_language():
    assert rendered("a{{ x.y['z'] }}b", {"x": {"y": {"z": 3}}}) == "a3b"
    assert rendered("{{ missing.field }}|{{ x.upper }}", {"x": "text"}) == "|"
    assert rendered("{% if a == 'x' and not b %}1{% elif b or c != 2 %}2{% else %}3{% endif %}", {"a": "x", "b": True, "c": 2}) == "2"
    assert rendered("{% for m in ms %}{% for k in m %}{{ k | upper }}{% endfor %};{% endfor %}", {"ms": [["a", "b"], []]}) == "AB;;"
    assert rendered("{{ 'a\\n' + 1 + \"}\" | trim }}", {}) == "a\n1}"
    pieces = list(compile_template("x{% generation %}{{ v }}y{% endgeneration %}z")({"v": "w"}))
    assert pieces == [("x", False), ("w", True), ("y", True), ("z", False)]


def test_constants_are_folded():
    known = {"upper": str.upper}
    assert fold(parse("a{{ 'b' + 'c' | upper }}{% if 1 == 2 %}no{% elif true %}d{% else %}e{% endif %}f", known), known) == (Text("abCdf"),)
    tree = fold(parse("{% for m in ms %}{{ true and m }}{% if m %}{{ 'x' + 'y' }}{% endif %}{% endfor %}", known), known)
    assert isinstance(tree[0], For) and isinstance(tree[0].body[0], Out) and tree[0].body[1].branches[0][1] == (Text("xy"),)
    assert isinstance(tree[0].body[1], If) and not any(isinstance(x, Lit) for x in tree)


@pytest.mark.parametrize("bad", ["{% for x y %}{% endfor %}", "{% if a %}", "{{ a b }}", "{{ a | nosuch }}", "{% import os %}",
                                 "{{ a.b() }}", "{{ x.__class__ }}", "{{ 'open }}", "{% generation %}", "{{ }}"])
def test_bad_templates_are_refused(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


def conversations(rng):
    rows = [(1, 0, "user", None), (1, 1, "assistant", PROBE), (1, 1, "assistant", PROBE), (2, None, None, "### User: x</turn>\n"),
            (2, 5, "Odd: role\\", "\\\\"), (3, 0, "assistant", ""), (None, 0, "user", "lost"), (None, None, None, None),
            (4, 1, "assistant", "second"), (4, 0, "user", "first"), (5, 0, "User", "# < \\ ##"), (6, 0, "assistant", prose(rng, 60_000))]
    return rows + [(7, i, ("user", "assistant")[i % 2], prose(rng, 30) + PROBE) for i in range(500)]


@pytest.mark.parametrize("part_chars", [300, 1 << 20])
def test_chat_round_trip(spark, rng, part_chars):
    rows = conversations(rng)
    turns = spark.createDataFrame([(*r, "u", 1) for r in rows],
                                  "conv_id long, turn long, role string, text string, formatted string, part int").repartition(3)
    parts = chat.format_conversations(turns, part_chars=part_chars)
    got = {r["conv_id"]: r for r in chat.read_back(parts).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append(((t is not None, t or 0, role or "", text or ""), role or "", text or ""))
    assert set(got) == set(by)
    for c, ts in by.items():
        ts.sort()
        learnt = "".join(x for _, r, x in ts if r == "assistant")
        assert got[c]["n_turns"] == len(ts) and got[c]["loss_chars"] == len(learnt)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in ts).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
    sizes = {r["conv_id"]: r["n"] for r in parts.groupBy("conv_id").count().withColumnRenamed("count", "n").collect()}
    assert (sizes[7] > 20) == (part_chars == 300) and sizes[6] == 1
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_chat_escapes():
    for t in ["", PROBE, "### User: ", "\\", "\\#", "</turn>", "a\\\\<#"]:
        assert chat.unescape(chat.escape(t)) == t
        assert list(chat.read_turns(f"### {chat.role_name(t)}: {chat.escape(t)}</turn>\n")) == [(t, t)]
    with pytest.raises(ValueError):
        list(chat.read_turns("### User: ok</turn>\nmore"))


def pages(rng):
    big, bigger = "<p>" + prose(rng, 400) + "</p>", "<b>" + prose(rng, 400) + "é</b>"
    rows = [(1, "http://a/", big), (9, "http://b/\r\nX: y", big), (None, None, big), (3, None, None), (4, "", ""), (5, "u", "small"),
            (6, "u", "small"), (7, "u", bigger), (7, "u", bigger), (8, "v", "z" * 999), (10, "v", "z" * 999), (11, "v", "z" * 1000),
            (12, "v", "z" * 1000), (13, "long", prose(rng, 100_000)), (None, "q", "only null" * 200), (None, "r", "only null" * 200)]
    return rows + [(100 + i, f"http://c/{i}", big) for i in range(50)] + [(300 + i, f"http://d/{i}", prose(rng, 200)) for i in range(50)]


def test_warc_round_trip(spark, rng, tmp_path):
    rows = pages(rng)
    df = spark.createDataFrame([(*r, "f", 3) for r in rows], "page_id long, url string, html string, bundle string, frame int").repartition(4)
    index = warc.write_warc(df, folder=str(tmp_path / "w"), frame_bytes=20_000, bundle_bytes=100_000)
    got = warc.read_warc(index).collect()
    last = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            last[b] = max(last.get(b, i), i)
    want = []
    for i, u, h in rows:
        b = (h or "").encode()
        to = last.get(b)
        to = None if to == i else to
        want.append((str(i), str(u and u.replace("\r", "%0D").replace("\n", "%0A")), "response" if to is None else "revisit", len(b),
                     hashlib.sha1(b).hexdigest(), str(to), None if to is not None else b))
    assert sorted(map(repr, ((str(r["page"]), str(r["url"]), r["record_type"], r["payload_bytes"], r["payload_digest"], str(r["refers_to"]),
                              r["payload"] and bytes(r["payload"]) if r["payload"] is not None else None) for r in got))) == sorted(map(repr, want))
    some = index.filter("page = '13' or page = '320'")
    assert sorted(r["page"] for r in warc.read_warc(some).collect()) == ["13", "320"]
    assert warc.read_warc(warc.write_warc(df.limit(0), folder=str(tmp_path / "e"))).count() == 0


def test_payloads_are_not_listed_whole():
    size, column = 100_000, pa.array([b"x" * 100_000] * 200, pa.binary())
    tracemalloc.start()
    assert sum(map(len, warc.one_by_one(column))) == 200 * size
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * size and warc.READ_BYTES <= 1 << 20


def test_bundles_are_plain_zstandard(tmp_path):
    w = warc.BundleWriter(str(tmp_path / "b.warc.zst"), frame_bytes=500)
    records = [warc.build_record(str(i), "http://x/", b"payload" * i, None, False, "2024-01-01T00:00:00Z")[1] for i in range(40)]
    places = [w.add(r) for r in records]
    w.close()
    data = (tmp_path / "b.warc.zst").read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(records)
    reader = warc.BundleReader(str(tmp_path / "b.warc.zst"))
    assert len(reader.frames) > 5 and [reader.record(*p) for p in reversed(places)] == records[::-1]
    assert all(warc.parse_record(r)["payload"] == b"payload" * i for i, r in enumerate(records))
    broken = records[5].replace(b"payload", b"Payload", 1)
    with pytest.raises(ValueError):
        warc.parse_record(broken)
    assert pafs.FileSystem.from_uri(f"file://{tmp_path}/b.warc.zst")[0].type_name == "local"


def test_trigram_queries():
    def q(r):
        return secrets.trigram_query(r)
    assert q("[0-9a-f]+") is True and q("ab?") is True
    assert q("AKIA[A-Z0-9]+") == ("and", [("tri", "aki"), ("tri", "kia")])
    assert q("(?:abc|xyz)+") == ("or", [("tri", "abc"), ("tri", "xyz")])
    assert q("x*abcd?.efg") == ("and", [("or", [("tri", "abc"), ("and", [("tri", "abc"), ("tri", "bcd")])]), ("tri", "efg")])
    texts = ["api_key = 'abcdef12'", "APIKEY:abcdef12", "Passwd= x", "secret", "toKen : \"abcdefg\"", "pas swd=abcdefgh", "xpassword=1234567"]
    s = secrets.Scanner(secrets.BASE_RULES)
    hits = secrets._evaluate(s.query[0], s.postings([t.encode() for t in texts]), len(texts)).tolist()
    assert hits == [True, True, True, True, True, False, True]


#: The jwt rule as plainly as it can be said (quadratic on long runs).
PLAIN_JWT = r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"


def brute_spans(text, rules):
    return sorted((m.start(), k, m.end()) for k, r in enumerate(rules)
                  for m in re.finditer(PLAIN_JWT if r.kind == "jwt" else r.regex, text, re.A)
                  if r.kind == "jwt" or len(m[r.group]) >= r.least)


def test_jwt_equals_the_plain_rule(rng):
    jwt = secrets.Scanner([r for r in secrets.MORE_RULES if r.kind == "jwt"])
    parts = ["eyJ", "eyJ", "abcdefgh", "a", ".", ".", "eyJabcdefgh", " ", "-", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randint(3, 25))) for _ in range(60_000)]
    found = jwt.spans(texts)
    assert found == [[(m.start(), 0, m.end()) for m in re.finditer(PLAIN_JWT, t)] for t in texts]
    assert 300 < sum(map(bool, found)) < 59_000


@pytest.mark.parametrize("unit", ["eyJ", "eyJabcdefgh.", "eyJabcdefgh.eyJ", "ghp_", "ghp_a", "xoxb-", "xoxb-1 ", "-----BEGIN ", "-----BEGIN A PRIVATE KEY",
                                  "a://", "a://b:c", "aa+.", "https://u:", "password ", "token=", "secret: \"", "AKIA", "AKIAx", "0123456789abcdef", "a", " "])
def test_long_texts_take_linear_time(unit):
    """Four times the text takes about four times as long with every rule (sixteen times, were it quadratic)."""
    s = secrets.Scanner(secrets.BASE_RULES + secrets.MORE_RULES)

    def seconds(size):
        text = unit * (size // len(unit)) + " eyJ ghp_ xoxb- PRIVATE KEY ://"
        best = []
        for _ in range(2):
            start = time.perf_counter()
            s.spans([text])
            best.append(time.perf_counter() - start)
        return min(best)
    assert seconds(1_000_000) < 8 * seconds(250_000) + 0.5


def test_long_secrets_are_found_whole():
    """By hand, not by the rules' own regexes: any length of token, user and password."""
    tokens = [("github", "ghp_" + "a1" * 200), ("slack", "xoxb-" + "1a-" * 150), ("url_login", "https://me:" + "p4" * 300 + "@"),
              ("url_login", "https://" + "u" * 100 + ":hunter2@"), ("github", "ghp_" + "a" * 36)]
    s = secrets.Scanner(secrets.MORE_RULES)
    for (kind, token), found in zip(tokens, s.spans([f"é {t} host" for _, t in tokens])):
        assert [(s.rules[k].kind, a, b) for a, k, b in found] == [(kind, 2, 2 + len(token))]
    assert s.spans(["ghp_" + "a" * 35, "https://me:abc@host", "https://me:" + "p" * 300 + " @"]) == [[], [], []]


def test_scan_secrets(docs_of, rng, monkeypatch):
    monkeypatch.setattr(secrets, "SEGMENT_BYTES", 3000)
    bits = ["password: hunter22", "PASSWD=\"x\"", "secret = a secret=abcdef", "AKIA" + "Z" * 20, "AKIAshort", "0123456789abcdef" * 2, "deadbeef",
            "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890-abc", "https://me:hunter2@host/", "ſecret=abcdefg", "api-key=abcdefg",
            "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "token=token=token=abcdef", "é" * 30 + "token:abc/def="]
    rows = [(1, None), (2, ""), (None, bits[0]), (3, bits[1]), (3, bits[1]), (4, prose(rng, 50_000) + bits[3] + prose(rng, 50_000))]
    rows += [(10 + i, " ".join(rng.sample(bits, 5)) + prose(rng, 20)) for i in range(80)] + [(200 + i, prose(rng, 100)) for i in range(80)]
    rules = secrets.BASE_RULES + secrets.MORE_RULES
    got = secrets.scan_secrets(docs_of(rows)).collect()
    want = [(str(i), [(rules[k].kind, s, e) for s, k, e in brute_spans(t or "", rules)]) for i, t in rows]
    assert sorted((str(r["doc_id"]), [tuple(x) for x in r["found"]]) for r in got) == sorted(want)
    assert {k for _, x in want for k, _, _ in x} == {r.kind for r in rules}
    assert secrets.scan_secrets(docs_of(rows).limit(0)).count() == 0
