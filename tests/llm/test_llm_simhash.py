"""SimHash near copies: all pairs by brute force, the trie join on planted bit patterns, awkward rows."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tenura.llm import queries, simhash_trie

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def fingerprint_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [words[i:i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints, budget=2):
    """Smallest document id of each component; prints: (doc_id, fingerprint)."""
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= budget and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    groups = {}
    for (d, _), x in zip(prints, label):
        groups.setdefault(x, []).append(d)
    low = {x: min((d for d in ds if d is not None), default=None) for x, ds in groups.items()}
    return [low[x] for x in label]


def check(df, rows, **options):
    got = simhash_trie.near_copies(df, **options)
    assert got.columns == ["doc_id", "fp", "component_id"]
    prints = [(d, fingerprint_by_hand(t)) for d, t in rows]
    want = [(d, signed(p), c) for (d, p), c in zip(prints, components_by_hand(prints))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r["doc_id"], fingerprint_by_hand(r["text"])) for r in docs]
    want = [(d, f"{p:016x}", c) for (d, p), c in zip(prints, components_by_hand(prints))]
    got = queries.QUERIES["op11_simhash"](spark, SF).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def planted(rng, n):
    """Random numbers and some at 1 to 3 bits from them, many below one node."""
    values = {rng.getrandbits(64) for _ in range(n)}
    crowd = 0xABCD << 48
    values |= {crowd | rng.getrandbits(12) for _ in range(n)}
    for v in list(values)[: n // 2]:
        values.add(v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    return sorted(values)


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_join_finds_all_pairs(budget):
    values = np.array(planted(random.Random(budget), 150), np.uint64)
    got = {(int(a), int(b)) for x, y in simhash_trie.linked_pairs(values, None, 0, 0, budget) for a, b in zip(x, y)}
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values))
            if int(values[i] ^ values[j]).bit_count() <= budget}
    assert got == want


def test_trie_join_of_two_nodes():
    rng = random.Random(7)
    low = np.array(sorted({rng.getrandbits(62) for _ in range(80)} | {5, 7}), np.uint64)
    high = np.array(sorted({int(v) | 1 << 63 for v in low[::2]} | {1 << 63 | 4}), np.uint64)
    got = {(int(a), int(b)) for x, y in simhash_trie.linked_pairs(low, high, 1, 1, 2) for a, b in zip(x, y)}
    assert got == {(i, j) for i in range(len(low)) for j in range(len(high)) if int(low[i] ^ high[j]).bit_count() <= 2}


@pytest.mark.parametrize("block", [2, 16, 100, 1 << 15])
def test_links_at_any_depth(spark, block):
    """Small blocks make Spark go far down, crowded nodes further."""
    values = planted(random.Random(3), 60)
    df = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    edges = simhash_trie.links(df, 2, block).collect()
    label = {signed(v): signed(v) for v in values}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in edges:
        label[top(r["a"])] = top(r["b"])
    want = components_by_hand([(signed(v), v) for v in values])
    groups = {}
    for v, w in zip(values, want):
        groups.setdefault(w, set()).add(top(signed(v)))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_hang_together():
    labels = np.arange(8)
    simhash_trie.hang_together(labels, np.array([7, 5, 3]), np.array([5, 3, 2]))
    assert labels.tolist() == [0, 1, 2, 2, 4, 2, 6, 2]


def test_long_texts_in_pieces(monkeypatch):
    text = "  ".join(f"Word{i % 97}é\n" for i in range(3000)) + " x" * 5 + " " + "y" * 5000 + " \t end "
    for piece in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(simhash_trie, "PIECE", piece)
        for t in (text, "", " ", "a", "a  b", " a b c ", "a b c d", "\x85   b"):
            assert simhash_trie.fingerprint(t.encode()) == fingerprint_by_hand(t)


LONG = "lorem ipsum dolor sit " * 50_000
AWKWARD = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, "one"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Ünï 😀 café ÀÉ"),
           (8, "ünï 😀 café ÀÉ"), (None, "one two"), (None, None), (None, "only null ids here"), (9, LONG), (10, LONG + "x"),
           (11, "a b c"), (12, "A\tb\r\nc")]


def test_awkward_rows(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    extra = ["fp", "low", "n", "root", "left", "right", "node", "a", "b", "component_id", "raw"]
    check(df.select("*", *(F.lit("mine").alias(c) for c in extra)), AWKWARD)


def test_copies_of_one_text(spark):
    """Most rows have one text, more have none."""
    rows = [(i, "the same text in many rows") for i in range(3000, 0, -1)] + [(i, None) for i in range(5000, 6000)]
    got = simhash_trie.near_copies(spark.createDataFrame(rows, SCHEMA)).groupBy("component_id").count().collect()
    assert {tuple(r) for r in got} == {(1, 3000), (5000, 1000)}


def test_nothing(spark):
    assert simhash_trie.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
