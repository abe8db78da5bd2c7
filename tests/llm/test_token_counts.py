import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from basketflow.llm import token_counts as C
from tests.conftest import SMALL

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return C.Tokenizer(PATH)


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts(library, tokenizer):
    rnd = random.Random(5)
    texts = ["", "<|endoftext|>a <|endoftext|><|endoftext|>", "<|endoftext", "it's  I'll \n\n x", "漢字 ½² Ⅳ", "\x1c\x1d a\x85b\xa0c",
             "a" * 5000, " " * 50, "'s don'T 's's", "\U0001f600 é", "x" * 99 + "\n" * 99]
    ranges = [(32, 127), (128, 0x240), (0x240, 0x3000), (0x3000, 0xD7FF), (0x10000, 0x1FFFF), (9, 14), (32, 33)]
    texts += ["".join(chr(rnd.randrange(*rnd.choice(ranges))) for _ in range(rnd.randrange(80))) for _ in range(1500)]
    texts += ["".join(chr(rnd.randrange(32, 0x240)) for _ in range(60)) for _ in range(500)]
    assert C.Counter(tokenizer)([t.encode() for t in texts]) == lengths(library, texts)


def test_forgetting_changes_nothing(library, tokenizer):
    texts = [f"unheardof{i} wörd{i * 7}" for i in range(300)]
    count = C.Counter(tokenizer, remembered=20)
    assert [count([t.encode()])[0] for t in texts] == lengths(library, texts)


def test_whole_tokens_are_proved(library, tokenizer):
    some = random.Random(6).sample(sorted(tokenizer.whole), 3000)
    assert len(tokenizer.whole) > 45_000
    assert all(len(e.ids) == 1 for e in library.encode_batch([s for s in some if C.library_cut(s) == [s]], add_special_tokens=False))


def test_query(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = C.op5_token_counts(spark, SMALL).collect()
    want = dict(zip(docs, lengths(library, list(docs.values())), strict=True))
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows} == {
        i: (len(t.encode()), want[i], want[i] > 512) for i, t in docs.items()
    }


def test_edge_rows(edge, no_docs, library):
    rows = C.count_tokens(edge, PATH).collect()
    assert [r["n_tokens"] for r in rows] == lengths(library, [r["doc"]["text"] or "" for r in rows])
    assert C.count_tokens(no_docs, PATH).count() == 0
