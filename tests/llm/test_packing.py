import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpuscle.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [" ", "  ", "   ", "\n", " \n", "\n ", "\t", "a", "Bc", "é", "1", "23", "'s", "!", "$$", "<|endoftext|>", " ", "　", "漢", "\x85", "\x1f", "\r\n", "😀", "_"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_of_chunks_are_those_of_the_text(tokenizer):
    draw = random.Random(3)
    texts = ["".join(draw.choices(ALPHABET, k=draw.randint(0, 14))) for _ in range(5000)] + ["", " ", "a" * 5000, "a b " * 20_000, "  " * 700]
    encoder = packing.Encoder(PATH)
    for _ in range(2):  # with an empty and with a filled cache
        ids, bounds = encoder.encode(pa.array(texts), 2)
        for i, text in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_pieces(spark, tokenizer):
    texts = [None, "", "one two", "word " * 1023, "word " * 1024, "word " * 5000, "x y  z\n" * 3000]
    docs = spark.createDataFrame([(i, t, 5, "p") for i, t in enumerate(texts)], "doc_id long, text string, extra int, Piece string")
    rows = packing.token_pieces(docs, PATH).collect()
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert [x for r in own for x in np.frombuffer(r["ids"], "<u4").tolist()] == ids
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // 1024)))
        assert [r["length"] for r in own] == [len(r["ids"]) // 4 for r in own]
        assert all(r["length"] == 1024 for r in own[1:]) and own[0]["length"] <= 1024
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert {r["extra"] for r in own} == {5}


def best_fill(items, capacity):
    """Fullest sum with the longest item, over all subsets."""
    longest = max(items)
    rest = list(items)
    rest.remove(longest)
    sums = {longest}
    for x in rest:
        sums |= {s + x for s in sums if s + x <= capacity}
    return max(sums)


@pytest.mark.parametrize("seed", range(30))
def test_a_bin_is_the_fullest_there_is(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 64, 100])
    items = [draw.randint(1, capacity) for _ in range(draw.randint(1, 14))]
    counts = {n: items.count(n) for n in items}
    chosen = packing.fullest(counts, capacity)
    assert all(counts[n] >= k > 0 for n, k in chosen.items()) and max(items) in chosen
    assert sum(n * k for n, k in chosen.items()) == best_fill(items, capacity)
    used = [n for p, t in packing.bin_patterns(counts, capacity) for n, k in p.items() for _ in range(k * t)]
    assert sorted(used) == sorted(items)


def check(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(bins) == list(range(len(bins)))
    return len(bins)


@pytest.mark.parametrize("lengths", [
    [1], [1024], [600] * 50 + [424] * 50, [7] * 3000, [1023, 2, 2], [500] * 2000 + [24] * 1500 + [1024] * 10,
    random.Random(1).choices(range(1, 1025), k=4000), [276] * 4000,
])
def test_places(spark, lengths):
    items = spark.createDataFrame([(i, n, 0) for i, n in enumerate(lengths)], "id long, length long, offset int").repartition(5)
    rows = packing.pack(items).collect()
    assert sorted((r["id"], r["length"]) for r in rows) == list(enumerate(lengths))
    bins = check(rows, 1024)
    halves = sum(n > 512 for n in lengths)
    least = max(-(-sum(lengths) // 1024), halves, -(-len(lengths) // (1024 // min(lengths))))
    assert bins <= 1 + 1.02 * least


def test_few_groups_number_alike(spark, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_GROUPS", 1)
    monkeypatch.setattr(packing, "ROWS_PER_GROUP", 3)
    items = spark.createDataFrame([(i, 1 + i % 3) for i in range(50)], "id long, length long")
    check(packing.pack(items, capacity=8).collect(), 8)


def test_wrong_lengths_repeats_and_no_rows(spark):
    frame = lambda rows: spark.createDataFrame(rows, "id long, length long")
    for wrong in (0, 1025, None):
        with pytest.raises(Exception, match="a length is not from 1 to 1024"):
            packing.pack(frame([(1, wrong)])).collect()
    rows = packing.pack(frame([(1, 600)] * 3)).collect()
    assert len(rows) == 3 and check(rows, 1024) == 3
    assert packing.pack(frame([])).count() == 0


def test_documents_are_packed_with_their_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack_documents(docs, PATH).collect()
    bins = check(rows, 1024)
    total = sum(r["length"] for r in rows)
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows) and bins <= 1.05 * total / 1024 + 2


class Counting:
    """A tokenizer that notes what it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, texts, **how):
        self.given += texts
        return self.tokenizer.encode_batch_fast(texts, **how)


def same(encoder, tokenizer, texts):
    ids, bounds = encoder.encode(pa.array(texts), 2)
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2], repr(text)


def test_a_word_is_encoded_once_whatever_sign_follows(tokenizer):
    words = [f"{a}{b}" for a in ("wor", "lé", "zu") for b in ("ndif", "taqu", "eß")]
    encoder = packing.Encoder(PATH)
    encoder.tokenizer = Counting(tokenizer)
    same(encoder, tokenizer, [f"x {' '.join(words)}"])
    same(encoder, tokenizer, ["x " + " ".join(w + sign for w in words for sign in (".", ",", "!?", "###", ".\nAnd", "\nAnd", "(1)"))])
    given = "".join(encoder.tokenizer.given)
    assert all(given.count(w) == 1 for w in words) and given.count("And") == 1


def test_words_met_again_outlast_those_met_once(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_CHUNKS", 100)
    encoder = packing.Encoder(PATH)
    encoder.tokenizer = Counting(tokenizer)
    for i in range(40):
        same(encoder, tokenizer, [f"x often again. {' '.join(f'w{i}q{k}z' for k in range(30))}"])
        assert len(encoder.known) <= 200 and len(set(encoder.known.to_pylist())) == len(encoder.starts) == len(encoder.known)
    given = "".join(encoder.tokenizer.given)
    assert given.count("often") == given.count("again") == 1


def test_ids_at_signs_breaks_and_zero_bytes(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_CHUNKS", 300)
    draw, encoder = random.Random(7), packing.Encoder(PATH)
    parts = [*ALPHABET, "\0", "a\nb\nc", "ª", "²", "'", "'re", "...", "(", "|", "÷", " ", "　", "́", "a.", "é,", "9)"]
    for _ in range(150):
        some = draw.sample(parts, draw.randint(3, 20))
        same(encoder, tokenizer, ["".join(draw.choices(some, k=draw.randint(0, 25))) for _ in range(60)])
