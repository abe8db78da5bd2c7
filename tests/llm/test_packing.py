"""Packing: ids and cuts against the library, packings against what a packing is, sequences against the bound."""

import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketflow.llm import packing

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected_pieces(library, texts, capacity):
    """(text number, piece, start, length, crc) by the library."""
    out = []
    for at, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            out.append((at, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def check_layout(rows, capacity):
    """Every sequence is filled from 0 without gaps up to at most its capacity; the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_merging_by_rank_is_proved(tmp_path):
    assert packing.merges_by_rank(PATH)
    file = json.loads(open(PATH, encoding="utf-8").read())
    file["model"]["merges"][5:7] = file["model"]["merges"][6:4:-1]
    (tmp_path / "other.json").write_text(json.dumps(file), encoding="utf-8")
    assert not packing.merges_by_rank(str(tmp_path / "other.json"))


@pytest.mark.parametrize("by_rank", [True, False])
def test_encoder_equals_the_library(library, by_rank):
    odd = [
        "", " ", "\n\n  x", "it's we'll 'S I'm''s", "<|endoftext|>", "a<|endoftext|> b <|endoftext|", "x y \xa0z\x85q",
        "漢字かな  交じり文。", "é ½ Ⅷ ٣ 😀👩‍👩‍👧 ​", "İſK", "a  b   c \t d", "9" * 50, "no\r\nend ", "\x00\x1f",
    ]
    encoder = packing.Encoder(open(PATH, encoding="utf-8").read(), by_rank, remembered=20)
    for text in [*odd, *(a + b for a in odd for b in odd)]:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_long_texts_are_cut_in_stretches(library, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 100)
    encoder = packing.Encoder(open(PATH, encoding="utf-8").read(), True)
    for text in ["Some words of a text, and 漢字 <|endoftext|> it's.  \n " * 60, "x" * 5000, "漢" * 700, "a b" * 400]:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_edge_documents(edge, library):
    out = packing.pack_documents(edge, PATH, with_ids=True)
    rows, docs = out.collect(), edge.collect()
    wanted = [(docs[at].doc_id, *rest) for at, *rest in expected_pieces(library, [d.text for d in docs], 1024)]
    got = [(r.key, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    check_layout(rows, 1024)
    assert all(len(r.ids) == 4 * r.length for r in rows)
    made = packing.sequences(out).collect()
    assert sum(len(r.ids) // 4 for r in made) == sum(r.length for r in rows)


def test_no_documents(no_docs):
    assert packing.pack_documents(no_docs, PATH).collect() == []


def test_exact_multiples(spark):
    assert packing.cut_ids(bytes(4 * 8), 8) == [bytes(32)]
    assert [len(p) // 4 for p in packing.cut_ids(bytes(4 * 16), 8)] == [8, 8]
    assert [len(p) // 4 for p in packing.cut_ids(bytes(4 * 17), 8)] == [1, 8, 8]


@pytest.mark.parametrize("shard", [64, 8192])
def test_packings_are_valid_and_close_to_the_bound(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD", shard)
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 1024, 3000).tolist()
    pieces = spark.createDataFrame(list(enumerate(lengths)), "row long, length long").repartition(5)
    rows = packing.pack(pieces, 1024).collect()
    assert sorted(r.row for r in rows) == list(range(3000))
    by = {}
    for r in rows:
        by.setdefault(r.sequence, []).append((r.offset, lengths[r.row]))
    for parts in by.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 1024
    bound = packing.lower_bound(np.array(lengths), 1024)
    assert len(by) <= bound * (1.03 if shard == 64 else 1.004)


def test_evolution_beats_its_first_packings():
    """Triplets that only fit each other: best fit leaves room, the islands find more whole sequences."""
    rng = np.random.default_rng(0)
    parts = []
    for _ in range(40):
        a, b = sorted(rng.integers(200, 500, 2).tolist())
        parts += [a, b, 1024 - a - b]
    sizes = np.sort(np.array(parts))[::-1].astype(np.int64)
    island = packing.Island(sizes, 1024, 7)
    first = [island.fresh(0.1 * k) for k in range(6)]
    best = island.evolve(first, 400, 6)[0]
    assert island.fitness(best) > max(island.fitness(m) for m in first)
    assert (island.fills(best) <= 1024).all() and len(best) == len(sizes)


def test_reruns_agree(spark):
    lengths = np.random.default_rng(2).integers(300, 700, 500).tolist()
    pieces = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    runs = [sorted(map(tuple, packing.pack(pieces.repartition(n), 1024).collect())) for n in (2, 7)]
    assert runs[0] == runs[1]
