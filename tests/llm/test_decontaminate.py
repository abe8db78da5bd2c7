import hashlib
import re
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketflow.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items, window=10):
    out = []
    for text in texts:
        words, hit, named = plain_words(text), set(), set()
        for name, item in items:
            w = plain_words(item)
            n = min(window, len(w))
            heads = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in heads:
                    hit.update(range(i, i + n))
                    named.add(name)
        out.append((len(words), len(hit), sorted(x for x in named if x is not None)))
    return out


def found(texts, items, window=10):
    n, spans, names, _ = D.find([(t or "").encode() for t in texts], D.TestSuffixes([(i, (t or "").encode()) for i, t in items], window))
    return [(a, sum(s["stop"] - s["start"] for s in b), c) for a, b, c in zip(n, spans, names)]


TEXT = st.lists(st.sampled_from(["a", "B", "c", "d", "é"]), max_size=14).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=4), st.lists(TEXT, max_size=4), st.integers(1, 5))
def test_equals_brute_force(texts, items, window):
    named = [(str(i), t) for i, t in enumerate(items)]
    assert found(texts, named, window) == brute(texts, named, window)


def test_longest_match_and_place():
    item = " ".join(f"w{i}" for i in range(30))
    text = "x y " + " ".join(f"W{i}" for i in range(5, 27)) + " z"
    matches = D.find([text.encode()], D.TestSuffixes([("7", item.encode())]))[3][0]
    assert matches == [{"item_id": "7", "n_words": 22, "item_word": 5, "doc_word": 2}]


@pytest.fixture(scope="module")
def items(spark):
    rows = [(10, "Text twice, with password"), (9, None), (11, ""), (None, "words and deadbeefdeadbeef01"), (10, "Text twice, with password"),
            (12, " ".join(f"word{i % 977}" for i in range(500, 540)))]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_edge_rows(edge, items):
    rows = [(r["doc"]["text"], r["n_words"], r["spans"], r["items"]) for r in D.find_matches(edge, items).collect()]
    named = [(None if i is None else str(i), t) for i, t in {(r[0], r[1]) for r in items.collect()}]
    for text, n_words, spans, names in rows:
        assert (n_words, sum(s.stop - s.start for s in spans), names) == brute([text], named)[0]
    assert sum(bool(r[2]) for r in rows) == 5
    clean = D.remove_contaminated(edge, items)
    assert clean.columns == edge.columns
    assert clean.count() == edge.count() - 5


def test_blocks_of_items_give_the_same(edge, items):
    def rows(**options):
        out = D.find_matches(edge, items, **options)
        return sorted(str((r["doc"], r["n_words"], r["spans"], r["items"])) for r in out.collect())

    assert rows(block_bytes=64) == rows()
    assert rows(block_bytes=64, keep=["doc_id"]) == rows(keep=["doc_id"])


def test_empty_tables(no_docs, edge, items):
    assert D.find_matches(no_docs, items).count() == 0
    assert all(not r["items"] for r in D.find_matches(edge, items.limit(0)).collect())


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_many_items_with_one_preamble_take_bounded_memory():
    preamble = " ".join(f"p{i}" for i in range(10))
    items = [(str(i), f"{preamble} item{i}".encode()) for i in range(1000)]
    texts = [(f"{preamble} x " * 1500 + f"{preamble} item7").encode()]
    tests = D.TestSuffixes(items)
    tracemalloc.start()
    _, spans, names, matches = D.find(texts, tests)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(names[0]) == 1000 and len(spans[0]) == 1501
    best = {m["item_id"]: (m["n_words"], m["item_word"], m["doc_word"]) for m in matches[0]}
    assert best["7"] == (11, 0, 16500) and best["8"] == (10, 0, 0)
    assert peak < 100 << 20


def test_steps_do_not_change_what_is_found(monkeypatch):
    items = [("1", b"a b c d"), ("2", b"a b c"), ("3", b"b c"), ("4", b"a b c d"), (None, b"c d")]
    texts = [b"a b c d a b c b c", b"", b"c d b c", b"a b c d e"]
    whole = D.find(texts, D.TestSuffixes(items, 2))
    monkeypatch.setattr(D, "STEP", 1)
    assert D.find(texts, D.TestSuffixes(items, 2)) == whole
