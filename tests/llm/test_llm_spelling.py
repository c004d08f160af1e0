"""Spelling variants: the whole query by hand, the index against all pairs, crowded halves, awkward rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.llm import queries, spelling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"


def counts_by_hand(rows, slip_every=97, least_length=5, least=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip_every and h % slip_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def near_by_hand(words):
    """All pairs that are one edit apart, by the words that deleting a code point leaves (``one_edit`` decides)."""
    by_rest = {}
    for w in words:
        for rest in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by_rest.setdefault(rest, []).append(w)
    return {(a, b) for group in by_rest.values() for a in group for b in group if a != b and one_edit(a, b)}


def variants_by_hand(counts, times=2):
    near = {}
    for a, b in near_by_hand(counts):
        near.setdefault(a, []).append(b)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x))
        if counts[best] >= times * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near.get(w, [])), counts.get(form.get(w))) for w, n in counts.items())


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def table(spark, counts):
    return spark.createDataFrame(sorted(counts.items()), "word string, n bigint")


def test_query_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = variants_by_hand(counts_by_hand(map(tuple, docs)))
    got = queries.QUERIES["op12_spelling"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n")
    assert result(got) == want and any(w[1] for w in want)


def crowd(rng, letters, least, most, n):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(n)})


@pytest.mark.parametrize("letters,least,most,n", [("ab", 1, 7, 300), ("abcdeéÿ", 5, 7, 800), ("a", 1, 30, 40), ("xy", 3, 3, 1)])
def test_index_finds_all_pairs(letters, least, most, n):
    """Every question against one index of all words, from either half."""
    words = crowd(random.Random(n), letters, least, most, n)
    index = spelling.Vocabulary(words)
    length = np.array([len(w) for w in words])
    number = np.arange(len(words))
    found = set()
    for head, tail in ((length // 2, length * 0), (length * 0, length - length // 2)):
        a, b = index.near(number, head, tail)
        for x, y in zip(a, b):
            assert one_edit(words[x], words[y])
            h, t = head[x], tail[x]
            assert words[y].startswith(words[x][:h]) and words[y].endswith(words[x][len(words[x]) - t:])
            found.add((words[x], words[y]))
    assert found == near_by_hand(words)


def test_both_ends_exact():
    """With an exact start and end the edit lies between; all of these and no others are found."""
    words = crowd(random.Random(5), "abc", 4, 7, 600)
    index = spelling.Vocabulary(words)
    for h, t in ((1, 2), (2, 1), (2, 2), (1, 1)):
        ask = np.array([i for i, w in enumerate(words) if len(w) > h + t])
        a, b = index.near(ask, np.full(len(ask), h), np.full(len(ask), t))
        want = {(x, y) for x, y in near_by_hand(words) if len(x) > h + t and len(y) >= h + t
                and x[:h] == y[:h] and x[-t:] == y[-t:]}
        assert {(words[x], words[y]) for x, y in zip(a, b)} == want


def test_rotations_and_ranks():
    rng = np.random.default_rng(1)
    text = np.concatenate([[0], rng.integers(1, 5, 500)])
    side = spelling.Side(text, 5)
    twice = text.tolist() * 2
    assert side.rotations.tolist() == sorted(range(501), key=lambda i: twice[i:i + 501])
    before = text[side.rotations - 1]
    for i in (0, 1, 15, 16, 17, 250, 501):
        for c in range(5):
            smaller, equal = side.rank(np.array([c]), np.array([i]))
            assert smaller[0] == (before[:i] < c).sum() and equal[0] == (before[:i] == c).sum()
    for low, size in ((0, 501), (3, 5), (10, 400), (7, 0)):
        _, found = side.symbols_before(np.array([low]), np.array([size]))
        assert found.tolist() == sorted(set(before[low:low + size].tolist()) - {0})


@pytest.mark.parametrize("index,shared", [(1, 2), (200, 5), (500_000, 10_000)])
def test_crowded_halves_are_cut_on(spark, index, shared):
    """Small indexes and halves shared by most words."""
    rng = random.Random(9)
    words = {"entwicklungs" + w for w in crowd(rng, "abc", 1, 5, 200)} | {w + "schaftliche" for w in crowd(rng, "xyé", 2, 6, 150)}
    words |= set(crowd(rng, "ab", 5, 8, 120)) | {"a" * n for n in range(5, 12)}
    counts = {w: rng.choice([3, 4, 5, 8, 16, 40, 90]) for w in words}
    got = spelling.variants(table(spark, counts), index=index, shared=shared)
    assert result(got) == variants_by_hand(counts)


def test_long_words(spark):
    long = "ab" * 3000
    counts = {long: 9, long[1:]: 4, long[:2999] + long[3000:]: 3, long + "b": 20, "b" + long: 50, "abcde": 3}
    assert result(spelling.variants(table(spark, counts))) == variants_by_hand(counts)


def test_chains_and_ties(spark):
    """A chain of forms ends at its last word; of equally common near words the first in code-point order counts."""
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "zaaaaa": 6, "éaaaa": 6, "Zaaaa": 6}
    got = result(spelling.variants(table(spark, counts)))
    assert got == variants_by_hand(counts)
    assert {w[0]: w[2] for w in got}["aaaab"] == "abbbb" and {w[0]: w[1] for w in got}["aaaaa"] == "Zaaaa"


AWKWARD = [(1, None), (2, ""), (3, " \n\t 123 -- "), (4, "Colour colour COLOUR color color"), (5, "color colors; colors/colors colour"),
           (5, "color colors; colors/colors colour"), (None, "colour color color color"), (6, "ÉTUDE Étude étude étudE"),
           (7, "étude " * 300_000), (8, "x×÷y " * 5), (9, "naïve naïve naïve naive naive naive naive naive naive naïveté"),
           (10, "w" * 30_000 + " " + "w" * 30_000), (11, "w" * 30_000)]


@pytest.mark.parametrize("every", [0, 1, 3, 97])
def test_awkward_rows(spark, every):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    extra = ["word", "n", "id", "raw", "part", "ask", "form", "root", "near", "index", "own"]
    df = df.select("*", *(F.lit("mine").alias(c) for c in extra)).repartition(3)
    assert result(spelling.group_spellings(df, slip_every=every)) == variants_by_hand(counts_by_hand(AWKWARD, every))


def test_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    monkeypatch.setattr(spelling, "HELD", 40)
    got = spelling.word_counts(spark.createDataFrame(AWKWARD[:7], SCHEMA), slip_every=3)
    assert {r["word"]: r["n"] for r in got.collect()} == counts_by_hand(AWKWARD[:7], 3)


def test_nothing(spark):
    assert result(spelling.group_spellings(spark.createDataFrame([], SCHEMA))) == []
    assert result(spelling.variants(table(spark, {"alone": 3}))) == [("alone", None, "alone", 3, 0, None)]


def test_times_must_grow(spark):
    with pytest.raises(ValueError):
        spelling.variants(table(spark, {"alone": 3}), times=1)
