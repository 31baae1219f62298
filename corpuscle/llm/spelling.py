"""Spelling variants: words one edit apart, found by walking a trie with a frontier of states.

The trie is a relation of edges (node, label, child).  A node stands for a prefix, by its
hash.  There are two tries, of the words and of the words read backwards: of two words one
edit apart, whatever comes before the edit or what comes after it is at least half of the
longer one, so one of the tries has the edit in the second half of the word.  Only that
half is kept.

A state is (word, node, labels still to read).  A word's states without an edit follow
its own path and need no join.  From them come the states with one edit: another edge of
the same node with a larger code point replaces one, and the node itself deletes one.
Insertions are deletions of the longer word.  In every round states are joined with the
edges, (node, next label), and so go down one level; what has read all its labels at the
end of a word names a neighbour, which is then compared with the word itself.

Edges span 1, 4, 16, ... code points, and a state takes the longest that it has left, so the
number of rounds is logarithmic in the longest word.  Words are sorted before their
paths are cut: a word whose prefix no neighbour in that order shares has no state there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscle.llm.common import ascii_lower
from corpuscle.session import stage

RUN = r"[A-Za-z\x{00C0}-\x{00FF}]"
SHORTEST, LEAST, TIMES, SPARED = 7, 2, 10, 31
STEP = 4  # each kind of edge spans as many times the code points of the kind before

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MASK = (1 << 64) - 1


def _mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Paths:
    """Prefix hashes of the words of a batch, read forwards or backwards."""

    def __init__(self, words: list[str], backwards: bool):
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.turn = np.uint64(0xD1B54A32D192ED03 if backwards else 0)
        self.codes, self.sizes = (codes[::-1], sizes[::-1]) if backwards else (codes, sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(codes)) - np.repeat(self.starts, self.sizes)
        most = int(sizes.max(initial=0))
        self.power, self.inverse = _powers(BASE, most), _powers(BASE_INVERSE, most)
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(_mixed(self.codes + np.uint64(1)) * self.power[place], out=self.sums[1:])

    def node(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The node of the first ``at`` code points of a word."""
        start = self.starts[word]
        return _mixed((self.sums[start + at] - self.sums[start]) ^ (at.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)) ^ self.turn).view(np.int64)

    def label(self, word: np.ndarray, at: np.ndarray, span: np.ndarray) -> np.ndarray:
        """A hash of ``span`` code points from ``at``."""
        first = self.starts[word] + at
        part = (self.sums[first + span] - self.sums[first]) * self.inverse[at]
        return _mixed(part ^ (span.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))).view(np.int64)

    def code(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.codes[self.starts[word] + at].astype(np.int64)

    def places(self, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every word with its places from the middle to ``last`` of the word."""
        first = self.sizes // 2
        n = np.maximum(last - first + 1, 0)
        word = np.repeat(np.arange(len(n)), n)
        return word, first[word] + np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)


def spans(left: np.ndarray) -> np.ndarray:
    """The longest edge for ``left`` code points: a power of ``STEP``; 0 for none."""
    out = np.zeros(len(left), dtype=np.int64)
    span = 1
    while len(left) and span <= left.max():
        out[left >= span] = span
        span *= STEP
    return out


def shared(words: list[str]) -> np.ndarray:
    """How much each word of a sorted list has in common with the word before or after; all of it at the ends."""
    common = [0] * (len(words) + 1)
    for i in range(1, len(words)):
        a, b = words[i - 1], words[i]
        k, most = 0, min(len(a), len(b))
        while k < most and a[k] == b[k]:
            k += 1
        common[i] = k
    if words:
        common[0], common[-1] = len(words[0]), len(words[-1])
    return np.maximum(common[:-1], common[1:]) if words else np.zeros(0, dtype=np.int64)


def _edges(batches: Iterator[pa.RecordBatch], backwards: bool, span: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        paths = Paths(words, backwards)
        word, at = paths.places(paths.sizes - span)
        wide = np.full(len(at), span)
        rows = np.stack([paths.node(word, at), paths.label(word, at, wide), paths.node(word, at + span), paths.code(word, at)])
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["node", "label", "child", "code"])


def _states(batches: Iterator[pa.RecordBatch], backwards: bool, low: int, high: int, deletions: bool) -> Iterator[pa.RecordBatch]:
    """States of the words' own paths with ``low`` to ``high`` code points to read after the one edited."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        forwards = Paths(words, False)
        ids = forwards.node(np.arange(len(words)), forwards.sizes)
        paths = Paths(words, True) if backwards else forwards
        common = shared([w[::-1] for w in words] if backwards else words)
        if backwards:
            ids, common = ids[::-1], common[::-1]
        word, at = paths.places(np.minimum(common, paths.sizes - 1))
        left = paths.sizes[word] - at - 1
        taken = (left >= low) & (left < high)
        if deletions:
            after = np.where(left > 0, paths.code(word, np.minimum(at + 1, paths.sizes[word] - 1)), -1)
            taken &= (paths.sizes[word] > SHORTEST) & (after != paths.code(word, at))
        word, at, left = word[taken], at[taken], left[taken]
        place, rest, labels = at + 1, left.copy(), []
        while rest.any():
            span = spans(rest)
            labels.append(np.where(span > 0, paths.label(word, np.where(span > 0, place, 0), span), 0))
            place, rest = place + span, rest - span
        counts = np.zeros(len(word), dtype=np.int64)
        place, rest = at + 1, left.copy()
        while rest.any():
            span = spans(rest)
            counts += span > 0
            place, rest = place + span, rest - span
        table = np.stack(labels, axis=1) if labels else np.zeros((len(word), 0), dtype=np.int64)
        flat = table[np.arange(table.shape[1])[None, :] < counts[:, None]]
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[word]), pa.array(paths.node(word, at)), pa.array(paths.code(word, at)), pa.array(left),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["id", "node", "code", "left", "labels"],
        )


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node of each whole word in either trie; forwards it is the word's id."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        every = np.arange(len(words))
        ways = [Paths(words, False), Paths(words, True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), pa.array(ways[0].node(every, ways[0].sizes)),
             pa.array(ways[1].node(every, ways[1].sizes)[::-1])], names=["word", "n", "id", "back"],
        )


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words (``word``, ``n``) of whole texts, some occurrences misspelt by the rule of the query.

    Null texts have no words and a null key counts as an empty one.  Occurrences are counted
    where they are read before they are shuffled.
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(RUN + "{%d,}" % SHORTEST), F.lit(0))).alias("run"),
    ).withColumn("run", F.when(F.col("run").rlike("[A-Z]"), ascii_lower(F.col("run"))).otherwise(F.col("run")))
    spoilt = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    k = F.pmod(spoilt, F.length("run")).cast("int")
    word = F.when(F.pmod(spoilt, F.lit(SPARED)) == 0, F.concat(F.substring("run", F.lit(1), k), F.substring("run", k + 2, F.length("run")))).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= SHORTEST) & (F.col("n") >= LEAST))


STATE = "id long, node long, code long, left long, labels array<long>"


def neighbours(words: DataFrame) -> DataFrame:
    """Pairs (u, un, v, vn) of the distinct words of (word, n) one edit apart, each once in either order.

    Words are at least ``SHORTEST`` code points long.  Every round is written to the shared
    folder; a round reads the edges of one span only.
    """
    sorted_by = {
        False: stage(words.repartitionByRange("word").sortWithinPartitions("word"), "words"),
        True: stage(words.repartitionByRange(F.reverse("word")).sortWithinPartitions(F.reverse("word")), "words-backwards"),
    }
    longest = sorted_by[False].agg(F.max(F.length("word"))).first()[0] or 0
    both = lambda rows: rows(False).union(rows(True))

    def edges(span: int) -> DataFrame:
        found = both(lambda way: sorted_by[way].mapInArrow(lambda b: _edges(b, way, span), "node long, label long, child long, code long"))
        return stage(found.distinct(), f"edges-{span}")

    def states(low: int, high: int, deletions: bool) -> DataFrame:
        return both(lambda way: sorted_by[way].mapInArrow(lambda b: _states(b, way, low, high, deletions), STATE))

    single = edges(1)
    other = single.select(F.col("node").alias("at"), "child", F.col("code").alias("larger"))
    replaced = stage(
        states(0, longest + 1, False).join(other, (F.col("node") == F.col("at")) & (F.col("larger") > F.col("code")))
        .select("id", F.col("child").alias("node"), "left", "labels"), "replaced",
    )
    pool, span = [replaced], 1
    while span * STEP <= (longest + 1) // 2:
        span *= STEP
    while span:
        steps = (single if span == 1 else edges(span)).select(F.col("node").alias("at"), "label", "child")
        current = states(span, span * STEP, True).select("id", "node", "left", "labels")
        for table in pool:
            current = current.union(table.where((F.col("left") >= span) & (F.col("left") < span * STEP)))
        for _ in range(STEP - 1):
            moved = current.join(steps, (F.col("node") == F.col("at")) & (F.col("labels")[0] == F.col("label")))
            current = stage(moved.select(
                "id", F.col("child").alias("node"), (F.col("left") - span).alias("left"), F.slice("labels", 2, 64).alias("labels")), "frontier")
            pool.append(current)
            current = current.where(F.col("left") >= span)
        span //= STEP
    found = states(0, 1, True).select("id", "node")
    for table in pool:
        found = found.union(table.where("left = 0").select("id", "node"))

    ends = stage(sorted_by[False].mapInArrow(_ends, "word string, n long, id long, back long"), "word-ends")
    ended = ends.select(F.inline(F.array(*[F.struct(F.col(c).alias("end"), F.col("word").alias("v"), F.col("n").alias("vn")) for c in ("id", "back")])))
    named = found.join(ended, F.col("node") == F.col("end")).select("id", "v", "vn")
    own = ends.select(F.col("id").alias("own"), F.col("word").alias("u"), F.col("n").alias("un"))
    pairs = named.join(own, F.col("id") == F.col("own")).where(F.levenshtein("u", "v", 1) == 1)
    return pairs.select("u", "un", "v", "vn").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following (word, form) to the last; each round doubles the way, and counts grow tenfold a step."""
    current = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stage(current.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        current = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return current


def variants(words: DataFrame) -> DataFrame:
    """Per row of (word, n): ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    ``form`` is the near word with the largest n, of ties the first in code-point order, if it
    is at least ``TIMES`` the word's; ``root`` follows forms to the last.  No words, no rows.
    """
    words = stage(words, "word-counts")
    pairs = stage(neighbours(words), "near-words")
    sides = pairs.select(F.col("u").alias("word"), F.col("un").alias("n"), F.col("v").alias("near"), F.col("vn").alias("near_n")).union(
        pairs.select("v", "vn", "u", "un"))
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("form")))
    near = sides.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.first("n").alias("own_n")).select(
        "word", "n_near", F.when(-F.col("best.order") >= TIMES * F.col("own_n"), F.col("best.form")).alias("form"),
        F.when(-F.col("best.order") >= TIMES * F.col("own_n"), -F.col("best.order")).alias("form_n"),
    )
    near = stage(near, "forms")
    roots = _roots(near.where("form IS NOT NULL"))
    told = near.join(roots, "word", "left")
    return words.join(told, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The variants of the words of ``docs``; other columns are ignored, repeated rows count as often as they are."""
    return variants(word_counts(docs, key, text))
