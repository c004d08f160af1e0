"""Near copies by SimHash: a self-join of the binary trie of all fingerprints.

Equal fingerprints are one entry of the trie. The join begins with the pair (root, root) and goes from a pair of nodes to
the pairs of their children; a pair of children whose last bits differ has one differing bit more, and pairs over
the budget are left. The upper levels are gone down by Spark: each fingerprint is sent to the pairs of nodes at
a depth that follows from the number of fingerprints, and pairs that still hold too many go down some levels
more. Below, a pair of subtrees is one task's: it is traversed level by level on sorted numbers, and only which
fingerprints hang together leaves the task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.ngram_join import components
from tenura.llm.storage import stored

SPACE = re.compile(rb"[\x20\x09-\x0D]")
SEED = 42
#: Bytes of a text, fingerprints below a node, levels gone down at once, and node pairs, that are worked on together.
PIECE, BLOCK, LEVELS, PAIRS = 1 << 20, 1 << 15, 4, 1 << 17


def shingle_hashes(raw: bytes, k: int) -> Iterator[np.ndarray]:
    """The XXH64 of a text's ``k``-word shingles, piece by piece; of fewer words that of the whole sequence, of none nothing."""
    carried, at, begun = [], 0, False
    while at < len(raw) or not begun:
        cut = SPACE.search(raw, at + PIECE) if at + PIECE < len(raw) else None
        end = cut.end() if cut else len(raw)
        words = carried + raw[at:end].lower().split()  # bytes: only A-Z, and exactly the six white space characters
        at = end
        if at < len(raw) and len(words) < k:
            carried = words
            continue
        if len(words) < k:
            if not begun and words:
                yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
            return
        begun = True
        text = b" ".join(words)
        ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
        starts = [0, *(e + 1 for e in ends)]
        digest = xxhash.xxh64_intdigest
        yield np.array([digest(text[a:b], SEED) for a, b in zip(starts, ends[k - 1:])], np.uint64)
        carried = words[len(words) - k + 1:]


def fingerprint(raw: bytes, k: int = 3) -> int:
    """Bit i is set if it is set in over half the shingles' hashes; 0 for a text without words."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(raw, k):
        n += len(hashes)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (64 bits as a signed number) of each row; null texts are empty."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("raw"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(raw.as_py() or b"", k) for raw in batch.column("raw")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(made, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return rows.mapInArrow(sign, T.StructType([rows.schema["doc_id"], T.StructField("fp", T.LongType())]))


class Trie:
    """The levels of the binary trie of sorted different numbers, each made when it is first asked for."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self._starts: dict[int, np.ndarray] = {}
        self._levels: dict[int, tuple] = {}

    def starts(self, depth: int) -> np.ndarray:
        """Where the nodes of a level begin among the values, and at last the number of values."""
        if depth not in self._starts:
            prefix = self.values >> np.uint64(64 - depth) if depth else np.zeros(len(self.values), np.uint64)
            new = np.flatnonzero(prefix[1:] != prefix[:-1]) + 1
            self._starts[depth] = np.concatenate([[0], new, [len(self.values)]])
        return self._starts[depth]

    def level(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the nodes: first value, number of values, and both children (-1: none) in the next level."""
        if depth not in self._levels:
            here = self.starts(depth)
            first, size = here[:-1], np.diff(here)
            children = np.full((2, len(first)), -1)
            if depth < 64:
                below = self.starts(depth + 1)
                low = np.searchsorted(below, first)
                bit = (self.values[first] >> np.uint64(63 - depth) & np.uint64(1)).astype(np.int64)
                children[bit, np.arange(len(first))] = low
                two = below[low + 1] < here[1:]
                children[1, two] = low[two] + 1
            self._levels[depth] = first, size, children
        return self._levels[depth]


def linked_pairs(a: np.ndarray, b: np.ndarray | None, depth: int, differing: int,
                 budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``a`` and ``b`` of the values that differ in at most ``budget`` bits, a part at a time.

    Both are sorted and belong to one node each at ``depth``; these differ in ``differing`` bits. Without ``b``, ``a`` is
    joined with itself and a pair is given once.
    """
    one = Trie(a)
    two = one if b is None else Trie(b)
    values = two.values
    zero = np.zeros(1, np.int64)
    todo = [(depth, zero, zero, np.full(1, differing))] if len(a) and len(values) else []
    while todo:
        depth, i, j, e = todo.pop()
        first_i, size_i, below_i = one.level(depth)
        first_j, size_j, below_j = two.level(depth)
        single = (size_i[i] == 1) & (size_j[j] == 1)
        if single.any():
            x, y = first_i[i[single]], first_j[j[single]]
            near = np.bitwise_count(a[x] ^ values[y]) <= budget
            if b is None:
                near &= x != y
            yield x[near], y[near]
        i, j, e = i[~single], j[~single], e[~single]
        if not len(i):
            continue
        parts = []
        for s, t in ((0, 0), (1, 1), (0, 1), (1, 0)):
            u, v, d = below_i[s][i], below_j[t][j], e + (s != t)
            keep = (u >= 0) & (v >= 0) & (d <= budget)
            if b is None and (s, t) == (1, 0):
                keep &= i != j
            parts.append((u[keep], v[keep], d[keep]))
        i, j, e = (np.concatenate(p) for p in zip(*parts))
        todo += [(depth + 1, i[n:n + PAIRS], j[n:n + PAIRS], e[n:n + PAIRS]) for n in range(0, len(i), PAIRS)]


def hang_together(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Give linked places one label, the smallest of their group; ``labels`` are such labels before and after."""
    while True:
        p, r = labels[x], labels[y]
        apart = p != r
        if not apart.any():
            return
        x, y = x[apart], y[apart]
        np.minimum.at(labels, np.maximum(p, r)[apart], np.minimum(p, r)[apart])
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def meetings(items: DataFrame, depth: int, levels: int, budget: int) -> DataFrame:
    """``left``, ``right``, ``fp``: pairs of nodes at ``depth`` gone down by ``levels``.

    A node's number is 1 followed by its prefix, the smaller node of a pair is on the left. A fingerprint goes to its node's
    pairs with those nodes below the other node that the budget still reaches.
    """
    if not levels:
        return items
    masks = [[sum(1 << b for b in bits) for n in range(left + 1) for bits in combinations(range(levels), n)]
             for left in range(budget + 1)]
    own = F.shiftrightunsigned("fp", 64 - depth - levels).bitwiseOR(F.lit(1 << (depth + levels)))
    used = F.bit_count(F.col("left").bitwiseXOR(F.col("right")))
    reach = F.element_at(F.array(*(F.array(*(F.lit(m).cast("bigint") for m in some)) for some in masks)),
                         (F.lit(budget + 1) - used).cast("int"))
    # the other node is left xor right xor the fingerprint's own node
    other = F.col("left").bitwiseXOR(F.col("right")).bitwiseXOR(F.shiftright("own", levels))
    last = F.col("own").bitwiseAND(F.lit((1 << levels) - 1))
    below = F.shiftleft(other, levels).bitwiseOR(last.bitwiseXOR(F.col("mask")))
    return items.select("fp", "left", "right", own.alias("own"), F.explode(reach).alias("mask")).select(
        F.least("own", below).alias("left"), F.greatest("own", below).alias("right"), "fp")


def linked_in_task(budget: int):
    def run(group: pa.Table) -> pa.Table:
        left, right = group["left"][0].as_py(), group["right"][0].as_py()
        depth = left.bit_length() - 1
        values = np.sort(group["fp"].to_numpy().view(np.uint64))
        a, b = values, None
        if left != right:
            is_left = (values >> np.uint64(64 - depth) | np.uint64(1 << depth)) == np.uint64(left)
            a, b = values[is_left], values[~is_left]
            values = np.concatenate([a, b])
        labels = np.arange(len(values))
        for x, y in linked_pairs(a, b, depth, (left ^ right).bit_count(), budget):
            hang_together(labels, x, y if b is None else y + len(a))
        moved = np.flatnonzero(labels != np.arange(len(values)))
        return pa.table({"a": values[moved].view(np.int64), "b": values[labels[moved]].view(np.int64)})

    return run


def links(prints: DataFrame, budget: int = 2, block: int = BLOCK) -> DataFrame:
    """``a``, ``b``: pairs of the different ``fp`` of a stored table that hang together as all within ``budget`` bits do.

    ``block`` (2 at least) is about the number of fingerprints below a node at which a task takes a pair over. It changes
    no result.
    """
    if block < 2:
        raise ValueError("block must be 2 at least")
    depth = max(0, min(ceil(log2(max(1, prints.count()) / block)), 40))
    root = F.lit(1).cast("bigint")
    items = meetings(prints.select(root.alias("left"), root.alias("right"), "fp"), 0, depth, budget)
    work = None
    while True:
        heavy = None
        if depth + LEVELS <= 62:
            sizes = items.groupBy("left", "right").count()
            heavy = stored(sizes.where(F.col("count") > 4 * block).select("left", "right"))
        if heavy is None or heavy.isEmpty():
            work = items if work is None else work.unionByName(items)
            break
        light = items.join(heavy, ["left", "right"], "left_anti")
        work = light if work is None else work.unionByName(light)
        items = stored(meetings(items.join(heavy, ["left", "right"], "left_semi"), depth, LEVELS, budget))
        depth += LEVELS
    return stored(work.groupBy("left", "right").applyInArrow(linked_in_task(budget), "a bigint, b bigint"))


def look_up(rows: DataFrame, facts: DataFrame, on: str, share: int = 1000) -> DataFrame:
    """``rows`` with the facts (one row for each key, with its number of rows ``n``) of their key.

    The facts of keys that fill more than 1 / ``share`` of the rows, at most ``share`` keys, go to the rows; the others meet
    by a shuffle.
    """
    most = rows.count() / share
    hot = facts.where(F.col("n") > most)
    others = rows.join(F.broadcast(hot.select(on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(others.join(facts.where(F.col("n") <= most), on))


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3, budget: int = 2,
                block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``fp`` (64 bits as a signed number), ``component_id`` for each row of ``docs``.

    Words are runs without ASCII white space with A-Z lower-cased; a text's shingles are its ``k`` words in a row, repeats
    counted, or all words if there are fewer. Documents are linked if their fingerprints differ in at most ``budget`` bits;
    a component is what hangs together by links, and its id its smallest document id.

    Null, empty and wordless texts have fingerprint 0 and are linked like any other. Rows with equal id are documents of
    their own. A null id is never the smallest, unless a component has no other. Other columns are not looked at.
    """
    signed = stored(fingerprints(docs, doc_id, text, k))
    prints = stored(signed.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")))
    roots = components(links(prints, budget, block)).withColumnRenamed("node", "fp")
    placed = stored(prints.join(roots, "fp", "left"))
    linked = placed.where(F.col("root").isNotNull()).withColumnRenamed("n", "copies")
    classes = stored(linked.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n")))
    found = look_up(linked, classes, "root").select("fp", "component_id", F.col("copies").alias("n"))
    alone = placed.where(F.col("root").isNull()).select("fp", F.col("low").alias("component_id"), "n")
    return look_up(signed, stored(found.unionByName(alone)), "fp").select("doc_id", "fp", "component_id")
