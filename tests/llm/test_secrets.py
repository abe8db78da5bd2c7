import base64
import hashlib
import random
import re
import time

from basketflow.llm import secrets as S

FOLDER = "/root/testdata/sf0.01"

# The contract's base patterns, searched for plainly.
BASE = [
    ("assign", re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def brute(text):
    return [
        (m.start(), kind, m.end()) for kind, pattern, ok in BASE for m in pattern.finditer(text or "") if ok(m)
    ]


def base(text):
    body = (text or "").encode()
    spans = S.in_characters(body, S.scan(body, S.automaton()))
    return [(a, S.KINDS[k].name, b) for a, k, b in spans if S.KINDS[k].name in S.BASE]


def test_equals_plain_search():
    rnd = random.Random(4)
    parts = [*"aA=:\"' 0f_-\n", "password", "PASSWD", "Token", "api_key", "apikey", "sEcret", "AKIA", "akia", "0123456789abcdef",
             "deadbeef", "ABCDEFGHIJKL", "é", "ſ", "K", "x1y2z3w4v5u6"]
    for _ in range(6000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(25)))
        assert sorted(base(text)) == sorted(brute(text)), text


def test_further_kinds_need_a_right_checksum():
    body = b"a1B2" * 7 + b"zZ"
    good = b"x ghp_" + body + S.base62_crc(body) + b" y"
    bad = good.replace(b"ghp_a", b"ghp_b")
    header = base64.urlsafe_b64encode(b'{"alg":"HS256","typ":"JWT"}').rstrip(b"=")
    web = b"t " + header + b".e30.c2ln"
    kinds = [[S.KINDS[k].name for _, k, _ in S.scan(t, S.automaton())] for t in (good, bad, web, web.replace(b"eyJ", b"eyK"))]
    assert kinds == [["host_token"], [], ["web_token"], []]


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = S.op4_secrets(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    order = {"assign": 0, "access": 1, "hex": 2}
    for r in rows:
        want = sorted(brute(docs[r["doc_id"]]), key=lambda s: (s[0], order[s[1]]))
        counts = [sum(k == name for _, k, _ in want) for name in order]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts
        text = ",".join(f"{k}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) - {""} <= set(r["spans"].split(","))
    assert sum(r["n_assign"] for r in rows) > 0


def test_edge_rows(edge, no_docs):
    found = {str(r["doc"]["text"]): [(s["start"], s["kind"], s["stop"]) for s in r["spans"]] for r in S.find_secrets(edge).collect()}
    assert all(sorted(spans) == sorted(brute(text if text != "None" else "")) for text, spans in found.items())
    clean = S.redact(edge)
    assert clean.columns == edge.columns and clean.schema["n_chars"].dataType == edge.schema["n_chars"].dataType
    rows = clean.collect()
    assert len(rows) == edge.count()
    changed = [r for r in rows if r["text"] and "[secret]" in r["text"]]
    assert sorted(r["text"] for r in changed) == [
        "No id here but some words and [secret].", *["The same text twice, with [secret] in it."] * 3
    ]
    assert all(r["n_chars"] == len(r["text"]) for r in changed)
    assert sum(r["text"] is None for r in rows) == 2
    assert S.redact(no_docs).count() == 0 and S.find_secrets(no_docs).count() == 0


def added(text):
    body = text.encode()
    return [(S.KINDS[k].name, text[a:b]) for a, k, b in S.in_characters(body, S.scan(body, S.automaton())) if S.KINDS[k].name not in S.BASE]


def test_deep_and_long_headers_are_no_tokens():
    deep = b'{"a":' + b"[" * 60_000
    for head in (deep, b'{"a":' + b"[" * 9_000, b'{"alg":"none"}'):
        token = base64.urlsafe_b64encode(head).decode().rstrip("=") + ".e30.sig"
        assert [k for k, _ in added(f"x {token} y")] == (["web_token"] if b"alg" in head else [])


def test_runs_of_token_letters_take_linear_time():
    began = time.time()
    for text in ("eyJ" * 350_000, "eyJx." * 200_000, "eyJ" * 300_000 + "." + "eyJ" * 100_000, "iban " * 200_000, "xprv" * 250_000, "password " * 110_000):
        S.scan(text.encode(), S.automaton())
    assert time.time() - began < 12


def test_skipping_a_run_loses_no_token():
    pattern, rnd = S.WEB_TOKEN.pattern, random.Random(8)
    parts = ["eyJ", "a", ".", " ", "eyJhbGciOiJub25lIn0", "-", "e", "J"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(14)))
        found = [m[0].decode() for m in pattern.finditer(text.encode()) if S.signed_header(m)]
        assert [t for k, t in added(text) if k == "web_token"] == found, text


def test_keys_and_accounts_need_their_check_digits():
    key = "xprv9s21ZrQH143K3QTDL4LXw2F7HEK3wJUD2nW2nRk4stbPy6cq3jPPqjiChkVvvNKmPGJxWUtg6LnF5kejMRNNU3TGtRBeJgk33yuGBxrMPHi"
    assert added(f"key {key}.") == [("wallet_key", key)] and added(key[:-1] + "j") == []
    assert added(key + "A") == [] and added("zprv" + "z" * 107) == []
    for good in ("IBAN: DE89 3704 0044 0532 0130 00", "iban=GB82WEST12345698765432", "IBAN FR1420041010050500013M02606"):
        assert added(good + ", so") == [("account", good)]
    assert added("IBAN: DE89 3704 0044 0532 0130 01") == [] and added("iban iban: x") == []
