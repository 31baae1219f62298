import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from corpuscle.operators import textsearch

KIND = "doc string, n int, text string"


def brute(chunks, questions, k):
    words = {(d, n): re.findall(r"\w+", (t or "").lower()) for d, n, t in chunks}
    filled = {c: w for c, w in words.items() if w}
    mean = sum(map(len, filled.values())) / max(len(filled), 1)
    counts = {c: Counter(w) for c, w in filled.items()}
    df = Counter(t for c in counts.values() for t in c)
    out = {}
    for q, text in questions:
        scores = {}
        for token, times in Counter(re.findall(r"\w+", (text or "").lower())).items():
            rarity = math.log(1 + (len(filled) - df[token] + 0.5) / (df[token] + 0.5))
            for c, found in counts.items():
                if found[token]:
                    part = found[token] / (found[token] + 1.2 * (1 - 0.75 + 0.75 * len(filled[c]) / mean))
                    scores[c] = scores.get(c, 0.0) + times * rarity * part
        best = sorted(scores, key=lambda c: (-math.floor(scores[c] * 1e9 + 0.5), c))[:k]
        for rank, c in enumerate(best, 1):
            out[q, rank] = (*c, round(scores[c], 6))
    return out


def answers(df):
    return {(r["question_id"], r["rank"]): (r["doc"], r["n"], round(r["score"], 6)) for r in df.collect()}


def corpus(seed=1, n=400):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return [(f"d{i // 5:03}", i % 5, " ".join(draw.choices(words, weights, k=draw.randint(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("span", [4, 32, 1000])
def test_equals_scoring_every_row(spark, span):
    chunks = corpus() + [("copy", i, "w9 w120 w7") for i in range(150)]
    questions = [("a", "w120 w7"), ("b", "w1 w2 w3 w200 w200"), ("c", "nothing here"), ("d", None), ("e", "W299"), ("f", "w1"), ("f2", "")]
    path = textsearch.text_index(spark.createDataFrame(chunks, KIND).repartition(7), ["doc", "n"], span=span)
    asked = spark.createDataFrame(questions, "question_id string, question string")
    assert answers(textsearch.ranked_text(asked, path, 6)) == brute(chunks, questions, 6)


def test_blocks_below_the_kth_score_are_not_opened(spark):
    chunks = corpus(3, 2000)
    path = textsearch.text_index(spark.createDataFrame(chunks, KIND), ["doc", "n"], span=8)
    questions = [(f"q{i}", f"w{150 + i} w1 w2") for i in range(20)]
    search = textsearch.TextSearch(spark.createDataFrame(questions, "question_id string, question string"), path, 5, "question_id", "question")
    assert answers(search.result()) == brute(chunks, questions, 5)
    opened, held = search.first.count() + search.rest.count(), search.bounds.count()
    assert search.first.count() <= textsearch.FIRST * 20 and opened < 0.4 * held


@pytest.mark.parametrize("span", [8, 48])
def test_lots_and_parts_of_questions_change_no_result(spark, monkeypatch, span):
    monkeypatch.setattr(textsearch, "LOT", 64)
    monkeypatch.setattr(textsearch, "PART", 3)
    chunks = corpus(5, 1000)
    questions = [(f"q{i}", f"w{i} w0 w1 w0" if i % 3 else f"w{i}") for i in range(20)]
    path = textsearch.text_index(spark.createDataFrame(chunks, KIND).repartition(3), ["doc", "n"], span=span)
    search = textsearch.TextSearch(spark.createDataFrame(questions, "question_id string, question string"), path, 7, "question_id", "question")
    assert search.met.select("lot").distinct().count() >= 16 and search.met.select("part").distinct().count() > 1
    assert answers(search.result()) == brute(chunks, questions, 7)


def test_postings_of_a_lot_go_out_once_for_all_questions(spark):
    """One row for a term of a lot, not one for each question and block that has it."""
    chunks = corpus(7, 3000)
    questions = [(f"q{i}", "w0 w1 w2") for i in range(50)]
    path = textsearch.text_index(spark.createDataFrame(chunks, KIND).coalesce(1), ["doc", "n"], span=8)
    search = textsearch.TextSearch(spark.createDataFrame(questions, "question_id string, question string"), path, 5, "question_id", "question")
    assert search.bounds.count() > 50 * 300
    assert search.met.count() == 3 * spark.read.parquet(f"{path}/lists").select("lot").distinct().count() <= 3 * 8
    assert answers(search.result()) == brute(chunks, questions, 5)


def counted(met):
    return met.append_column("entries", pa.array([len(b) // 2 for b in met["best"].to_pylist()], pa.int32()))


def test_many_words_are_cut_into_several_tables(monkeypatch):
    number = np.arange(40) + (5 << 33)
    words = [[f"w{j}" for j in range(1 + i % 7)] for i in range(40)]
    rows = pa.record_batch({"_n": pa.array(number), "_size": pa.array([1 + i % 7 for i in range(40)], pa.int32()), "_words": pa.array(words)})

    def told(most, step):
        monkeypatch.setattr(textsearch, "WORDS", most)
        tables = [pa.Table.from_batches([t]) for t in textsearch._lists((rows.slice(i, step) for i in range(0, 40, step)), 3.0, 4, 4)]
        shares, df = {}, Counter()
        for table in tables:
            for lot in set(table["lot"].to_pylist()):
                held = table.filter(pc.equal(table["lot"], lot))
                asks = pa.array([[{"q": j, "weight": 1.0} for j in range(3)]] * held.num_rows, pa.list_(pa.struct([("q", pa.int64()), ("weight", pa.float64())])))
                entries = textsearch._Lot(counted(held.append_column("asks", asks)))
                starts, place, part = entries.postings(3.0)
                token = np.repeat(np.array(held["token"].to_pylist()), entries.entries)
                for e in range(len(token)):
                    for i in range(starts[e], starts[e] + entries.n[e]):
                        shares[str(token[e]), (lot * 4 + int(entries.block[e])) * 4 + int(place[i])] = float(part[i])
                    assert entries.best()[e] >= max(part[starts[e]:starts[e] + entries.n[e]])
            for token, n in zip(table["token"].to_pylist(), table["n"].to_pylist()):
                df[token] += n
        return len(tables), shares, df

    whole, cut = told(1 << 22, 40), told(20, 9)
    assert whole[1:] == cut[1:] and cut[0] > whole[0] and len(whole[1]) == sum(whole[2].values()) == sum(1 + i % 7 for i in range(40))


def test_few_scores_at_a_time_change_no_result(monkeypatch):
    draw = random.Random(2)
    size = [draw.randint(1, 30) for _ in range(200)]
    words = [[f"w{draw.randint(0, 40)}" for _ in range(n)] for n in size]
    rows = pa.record_batch({"_n": pa.array(range(200), pa.int64()), "_size": pa.array(size, pa.int32()), "_words": pa.array(words)})
    met = pa.Table.from_batches(list(textsearch._lists(iter([rows]), 12.0, 8, 25)))
    kind = pa.list_(pa.struct([("q", pa.int64()), ("weight", pa.float64())]))
    met = counted(met).append_column("asks", pa.array([[{"q": q, "weight": 0.5 + q} for q in range(9) if draw.random() < 0.4 or not q] for _ in range(met.num_rows)], kind))

    def told(cells):
        monkeypatch.setattr(textsearch, "CELLS", cells)
        bounds = textsearch._bounds(met, 25)
        visits = bounds.filter(pc.field("block") != 3).select(["q", "block"])
        visits = visits.append_column("floor", pa.array([-math.inf] * visits.num_rows))
        return bounds.to_pylist(), textsearch._opened(met, visits, 4, 12.0, 8, 25).to_pylist()

    assert told(1) == told(100) == told(1 << 20) and len(told(1)[1]) == 36


def test_numbers_come_back():
    values = np.array([0, 1, 127, 128, 300, 16383, 16384, 2**40, 5])
    raw, used = textsearch.encode(values)
    assert textsearch.decode(raw.tobytes()).tolist() == values.tolist() and used.tolist() == [1, 1, 1, 2, 2, 2, 3, 6, 1]
    assert textsearch.decode(b"").tolist() == []


@pytest.mark.parametrize("chunks", [[], [("a", 1, None)], [("a", 1, "one one"), ("a", 2, "")]])
def test_few_rows(spark, chunks):
    path = textsearch.text_index(spark.createDataFrame(chunks, KIND), ["doc", "n"])
    questions = [("q", "one two")]
    assert answers(textsearch.ranked_text(spark.createDataFrame(questions, "question_id string, question string"), path)) == brute(chunks, questions, 8)
