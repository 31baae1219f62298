import random

import brute
import pytest

from corpuscle.llm import components, simhash
from corpuscle.llm.simhash import fingerprint


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [
    "", " \t\n", "one", "one two", "A b C", "The cat sat on the mat the cat sat on the mat", "Éa ÉA éa\x0bx\x0cy\x1fz", "a b " * 30_000, "x" * 100_000,
])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute.fingerprint(text)


def near_and_far(count, seed):
    draw = random.Random(seed)
    found = set()
    while len(found) < count:
        center = draw.getrandbits(64)
        for _ in range(draw.choice([1, 1, 5, 30])):
            found.add(center ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))))
    return sorted(found)


def test_links_are_all_pairs_within_three_bits(spark):
    marks = near_and_far(500, 1) + [0, 1, 7, 15, (1 << 64) - 1, (1 << 64) - 8, 1 << 63]
    rows = spark.createDataFrame([(signed(m),) for m in set(marks)], "fp long")
    got = {frozenset((r["a"], r["b"])) for r in simhash.links(rows).collect()}
    every = sorted(set(marks))
    want = {frozenset((signed(a), signed(b))) for i, a in enumerate(every) for b in every[i + 1:] if (a ^ b).bit_count() <= 3}
    assert len(want) > 500 and got == want


def test_pairs_at_each_pattern_of_three_bits_are_found(spark):
    """Whichever half or segment the differing bits fall into, whichever side has them set."""
    draw = random.Random(3)
    for base in (0, (1 << 64) - 1, draw.getrandbits(64)):
        others = {base ^ sum(1 << b for b in draw.sample(range(64), 3)) for _ in range(400)}
        others |= {base ^ (7 << s) for s in range(62)} | {base ^ (3 << s) ^ (1 << (s + 33) % 64) for s in range(62)}
        rows = spark.createDataFrame([(signed(m),) for m in {base, *others}], "fp long")
        met = {r["a"] + r["b"] - signed(base) for r in simhash.links(rows).collect() if signed(base) in (r["a"], r["b"])}
        assert met == {signed(o) for o in others if 0 < (o ^ base).bit_count() <= 3}


def test_a_dense_group_is_joined_by_few_links(spark):
    """Ten thousand near copies in 211 partitions: links do not grow with the square of the group."""
    draw = random.Random(11)
    center = draw.getrandbits(64)
    marks = {signed(center ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 3)))) for _ in range(10_000)}
    far = {signed(draw.getrandbits(64)) for _ in range(5000)}
    rows = spark.createDataFrame([(m,) for m in marks | far], "fp long").repartition(211)
    led = simhash.leader_links(rows).count()
    assert led < 16 * len(marks | far)
    roots = {r["fp"]: r["root"] for r in simhash.components(rows).collect()}
    assert {roots[m] for m in marks} == {min(marks)} and all(roots[m] == m for m in far)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 1)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)],
                                   [(i, (i * 7 + 3) % 101) for i in range(101)] + [(500, 400), (400, 300)]])
def test_components(spark, edges):
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    pairs = {frozenset(e) for e in edges}
    assert got == brute.components(nodes, lambda a, b: frozenset((a, b)) in pairs)


def variants():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(12):
        base = draw.choices(words, k=400)
        for k in range(draw.randint(1, 6)):
            copy = list(base)
            for at in draw.sample(range(400), draw.choice([0, 0, 1])):
                copy[at] = "changed"
            texts.append(" ".join(copy))
    return texts + ["", " ", None, "one", "ONE", "one two"]


def test_documents_get_the_smallest_id_of_their_component(spark):
    texts = variants()
    ids = random.Random(4).sample(range(1000), len(texts))
    docs = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts)], "doc_id long, text string, fp int").repartition(3)
    marks = {i: brute.fingerprint(t) for i, t in zip(ids, texts)}
    want = brute.components(ids, lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 3)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ids) and {r["doc_id"]: r["component_id"] for r in rows} == want
    assert len(set(want.values())) < len({t for t in texts if t})
    assert {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in rows} == marks

    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_repeats_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(2, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, "else where it is"), (7, None)], "doc_id long, text string")
    rows = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.near_duplicates(docs).collect())
    assert rows == [("2", "2"), ("2", "2"), ("7", "7"), ("None", "2"), ("None", "None")]
    kept = sorted((str(r["doc_id"]), r["text"]) for r in simhash.one_of_each(docs).collect())
    assert kept == [("2", "a b c d"), ("7", None), ("None", "else where it is")]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.one_of_each(docs.limit(0)).count() == 0


@pytest.mark.parametrize("joined", [simhash.leader_links, simhash.links, lambda marks: simhash.links(marks.withColumn("root", marks.fp), "root")])
def test_cells_never_go_through_the_driver(spark, joined):
    """A table of fingerprints is small, that of the cells they look into is not: neither side is broadcast."""
    marks = spark.createDataFrame([(signed(m),) for m in near_and_far(50, 2)], "fp long")
    plan = joined(simhash.stage(marks, "few"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
