import random
import zlib
from collections import Counter
from math import log2

import numpy as np
import pytest

from basketflow.llm import language_id as L
from tests.conftest import SMALL


def count(texts):
    rows = Counter()
    for lang, text in texts:
        body = np.frombuffer(L._START + L.folded(text.encode()), np.uint8)
        rows.update((lang, int(g)) for g in L.grams(body))
    return [(lang, g, n) for (lang, g), n in rows.items()]


def brute_length(train, text):
    """Code length by the definition, with plain dictionaries."""
    return brute_length_of(count_all(train), text)


_COUNTED = {}


def count_all(train):
    key = tuple(train)
    if key not in _COUNTED:
        seen = _COUNTED[key] = {}
        for t in train:
            body = L._START + L.folded(t.encode())
            for i in range(3, len(body)):
                for k in range(4):
                    seen.setdefault(body[i - k : i], Counter())[body[i]] += 1
    return _COUNTED[key]


def brute_length_of(seen, text):
    body, total = L._START + L.folded(text.encode()), 0.0
    for i in range(3, len(body)):
        for k in (3, 2, 1, 0, -1):
            if k < 0:
                total += 8
                break
            here = seen.get(body[i - k : i])
            if not here:
                continue
            whole = sum(here.values()) + len(here)
            if body[i] in here:
                total -= log2(here[body[i]] / whole)
                break
            total -= log2(len(here) / whole)
    return total


def test_lengths_equal_the_definition():
    train = {"x": ["the cat and the dog", "a theatre"], "y": ["der hund und die katze", "ÄÖ ä"]}
    trees = L.ContextTrees(count([(k, t) for k, v in train.items() for t in v]))
    texts = ["the hund", "", "zz", "Ä kat\n", "theatre and katze " * 50]
    got = trees.lengths([L.folded(t.encode()) for t in texts])
    for row, text in zip(got, texts, strict=True):
        for i, lang in enumerate(trees.langs):
            assert row[i] / L.UNIT == pytest.approx(brute_length(train[lang], text), abs=0.001 * max(1, len(text.encode())))


@pytest.mark.parametrize("languages", [1, 4, 100, 600])
def test_every_learned_context_counts(languages):
    """Lengths by the definition, and the winner of whole rows, however many languages share the trees."""
    rnd = random.Random(languages)
    words = ["".join(rnd.choice("abcdeäöñ漢字") for _ in range(rnd.randrange(1, 7))) for _ in range(400)]
    train = {f"l{i:03d}": [" ".join(rnd.choices(words, k=25)) for _ in range(2)] for i in range(languages)}
    trees = L.ContextTrees(count([(k, t) for k, v in train.items() for t in v]))
    assert trees.langs == sorted(train)
    texts = [rnd.choice(train[rnd.choice(trees.langs)])[:60] for _ in range(3)] + ["zzz abc", "漢"]
    got = trees.lengths([L.folded(t.encode()) for t in texts])
    wanted = [[brute_length(train[lang], t) for lang in trees.langs] for t in texts]
    for row, want, text in zip(got, wanted, texts, strict=True):
        assert np.allclose(row / L.UNIT, want, atol=0.001 * len(text.encode()))
    found = L.identify([t.encode() for t in texts], trees)[0]
    for name, want in zip(found, wanted, strict=True):
        assert want[trees.langs.index(name)] <= min(want) + 0.1


def test_texts_longer_than_a_stretch(monkeypatch):
    trees = L.ContextTrees(count([("x", "some words here"), ("y", "andere worte da")]))
    texts = [b"words " * 40, b"", b"worte da" * 9, b"x"]
    whole = trees.lengths(texts)
    for stretch, kinds in ((1, 1), (7, 3), (64, 2)):
        monkeypatch.setattr(L, "STRETCH", stretch)
        monkeypatch.setattr(L, "KINDS", kinds)
        assert (trees.lengths(texts) == whole).all()


def test_query_names_the_winner_of_whole_rows(spark, small_docs):
    rows = small_docs.select("doc_id", "text", "lang").collect()
    train = {}
    for r in rows:
        if r.lang is not None and r.text and zlib.crc32(str(r.doc_id).encode()) % 5:
            train.setdefault(r.lang, []).append(r.text)
    # Less text than the sample would take: all of it is learned.
    assert sum(len(t.encode()) for v in train.values() for t in v) < L.TRAIN_BYTES / len(train)
    found = {r.doc_id: r.lang_pred for r in L.op9_language_id(spark, SMALL).collect()}
    short = [r for r in rows if r.text and len(r.text) < 400][:40]
    for r in short:
        lengths = {lang: brute_length_of(count_all(texts), r.text) for lang, texts in train.items()}
        best = min(lengths.values())
        assert lengths[found[r.doc_id]] <= best + 0.001 * len(r.text.encode()) if L.has_letter(r.text.encode()) else found[r.doc_id] == "und"


def close_languages():
    """Two languages that share all their words but one in ten."""
    rnd = random.Random(5)
    shared = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randrange(2, 8))) for _ in range(300)]
    own = {lang: ["".join(rnd.choice("aeioulnrst") for _ in range(5)) for _ in range(30)] for lang in ("p", "q")}

    def text(lang, n):
        return " ".join(rnd.choice(own[lang] if rnd.random() < 0.1 else shared) for _ in range(n))

    return text


def test_close_languages_are_told_apart():
    text = close_languages()
    trees = L.ContextTrees(count([(lang, text(lang, 200)) for lang in ("p", "q") for _ in range(60)]))
    tests = [(lang, text(lang, 60)) for lang in ("p", "q") for _ in range(100)]
    found = L.identify([t.encode() for _, t in tests], trees)[0]
    assert sum(a == b for a, (b, _) in zip(found, tests, strict=True)) / len(tests) > 0.9


def test_a_text_costs_the_same_in_any_company():
    trees = L.ContextTrees(count([("x", "some words here"), ("y", "andere worte da")]))
    texts = [b"words", b"", b"worte da", b"x", b""]
    assert (trees.lengths(texts) == np.concatenate([trees.lengths([t]) for t in texts])).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = L.op9_language_id(spark, folder).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_rows(edge, no_docs):
    trees = L.train(edge)
    assert trees.langs == ["de", "en", "fr"]
    rows = L.predict(edge, trees).collect()
    assert len(rows) == edge.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r["doc"]["text"] or "")
        assert (r["lang_pred"] in trees.langs) == lettered
        assert lettered or (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert L.predict(no_docs, trees).count() == 0
    nothing = L.train(no_docs)
    assert {(r["lang_pred"], r["score"]) for r in L.predict(edge, nothing).collect()} == {("und", 0.0)}


def test_long_texts_do_not_crowd_out_the_others(spark):
    small = [(i, "x", f"the quick dog number {i} ran over the hill") for i in range(40)]
    huge = [(100, "x", "zzzq " * 400_000), (101, "y", "der hund und die katze " * 100_000), (102, "z", "le chien et le chat " * 100_000)]
    rows = spark.createDataFrame(small + huge, "doc_id long, lang string, text string").repartition(4)
    counted = L.count_contexts(rows, "lang", "text", "doc_id", 60_000).collect()
    assert {r["lang"] for r in counted} == {"x", "y", "z"}
    found = {(r["lang"], r["gram"].to_bytes(4, "big")): r["n"] for r in counted}
    assert found["x", b"quic"] == 40
    assert sum(n for (lang, _), n in found.items() if lang == "y") <= 1024
    trees = L.train(rows, train_bytes=60_000)
    assert L.identify([b"the quick dog ran", b"die katze und der hund", b"le chat et le chien"], trees)[0] == ["x", "y", "z"]


def test_every_language_keeps_a_row(spark):
    rows = spark.createDataFrame([(i, f"l{i % 200}", f"word{i} " * 3000) for i in range(400)], "doc_id long, lang string, text string")
    assert len(L.train(rows, train_bytes=2000).langs) == 200


def test_pieces_cover_a_long_text():
    text = "é".encode() * 50_000 + b"the end"
    got = L.pieces(text, 5000)
    assert len(got) == 4 and got[0].startswith(L._START) and got[-1].endswith(b"the end")
    assert all(len(p) <= 1027 and "\ufffd" not in p.decode() for p in got)
    assert L.pieces(b"Abc", 5000) == [L._START + b"abc"]
