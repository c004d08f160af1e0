"""Mixing sources to target weights.

Every source is one stream of words, its documents in a hashed order, cut into blocks of equal
length. A target of several times the source takes whole passes and then the first blocks of a
permuted pass, the last block cut so that the words are exact. The blocks drawn from each
source are divided among the output shards by a splitting tree: at each node a multivariate
hypergeometric draw says how many blocks of each source go to the left half, so every shard
gets its exact share of blocks and its sources vary as in a random shuffle. A shard's blocks are
then ordered by a hash.

Which blocks a document covers follows from where it starts in its stream, so the only data that
meet are sums of sizes. Streams are dealt by a hash into ranges of about ``rows_per_range`` rows, whatever
their source's size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm import kernels
from tenura.llm.kernels import U64
from tenura.llm.storage import stored

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
MOST_BLOCKS = 500_000_000

DRAW = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("place", T.LongType()),
    T.StructField("at", T.LongType()), T.StructField("epoch", T.IntegerType()), T.StructField("block", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
])


def targets(sizes: dict[str | None, int], weights=(3, 1, 2), share: float = 1.5,
            most: float = 2.0) -> dict[str | None, float]:
    """Words to take from each source.

    The sources by code point, null last, weigh ``weights`` in turn and share ``share`` times all words. A
    target stops at ``most`` times its source's size; the excess goes to the others by weight until
    none is above. Sources without words get 0.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in names if s in open_ and unit * weight[s] > most * sizes[s]]
        if not full:
            out |= {s: unit * weight[s] for s in open_}
            break
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
            open_.remove(s)
    return {s: max(0.0, out[s]) for s in names}


@dataclass(frozen=True)
class Draw:
    """What is taken from one source."""

    size: int
    target: float
    n_blocks: int
    passes: int
    rest: int  # words of the last, partial pass
    keys: tuple[int, ...]  # of the permutations, one for each pass
    ends: np.ndarray  # how many drawn blocks are dealt up to each shard


def splitting_tree(counts: list[int], shards: int, rng: np.random.Generator) -> np.ndarray:
    """How many blocks of each source (row) each shard (column) gets."""
    out = np.zeros((len(counts), shards), np.int64)
    total = sum(counts)
    ends = [total * i // shards for i in range(shards + 1)]
    stack = [(0, shards, np.array(counts, np.int64))]
    while stack:
        first, end, have = stack.pop()
        if end - first == 1:
            out[:, first] = have
            continue
        middle = (first + end) // 2
        left = rng.multivariate_hypergeometric(have, ends[middle] - ends[first], method="marginals")
        stack += [(first, middle, left), (middle, end, have - left)]
    return out


def plan(sizes: dict[str | None, int], seed: int, weights, share: float, most: float,
         block_words: int, shard_words: int, max_shards: int) -> tuple[dict[str | None, Draw], int]:
    wanted = targets(sizes, weights, share, most)
    block = max(block_words, math.ceil((1 + sum(wanted.values())) / MOST_BLOCKS))
    shards = min(max_shards, max(1, math.ceil(sum(wanted.values()) / shard_words)))
    made, counts = {}, []
    for s, target in wanted.items():
        size, words = sizes[s], min(math.floor(target), math.floor(most * sizes[s]))
        n, passes, rest = -(-size // block), words // size if size else 0, words % size if size else 0
        name = hashlib.blake2b(repr((seed, s)).encode(), digest_size=8).digest()
        key = int.from_bytes(name, "big")
        keys = tuple(key + e for e in range(passes + 1))
        made[s] = (size, target, n, passes, rest, keys)
        drawn = 0
        if rest:  # the short last block may be among those drawn
            drawn = -(-rest // block)
            rank = int(kernels.permute(np.array([n - 1]), n, keys[-1])[0])
            drawn = -(-(rest + n * block - size) // block) if rank < drawn else drawn
        counts.append(passes * n + drawn)
    dealt = splitting_tree(counts, shards, np.random.default_rng(seed))
    return {s: Draw(*made[s], np.cumsum(dealt[i])) for i, s in enumerate(made)}, block


def _draws(draw: Draw, block: int, start: np.ndarray, size: np.ndarray):
    """For documents at ``start`` of a source's stream: (row, shard, place, at, epoch, block, first, words)."""
    first, last = start // block, np.where(size > 0, (start + size - 1) // block, -1)
    n = np.where(size > 0, last - first + 1, 0)
    row = np.repeat(np.arange(len(start)), n)
    b = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    found = []
    for epoch in range(draw.passes + (draw.rest > 0)):
        rank = kernels.permute(b, draw.n_blocks, draw.keys[epoch])
        have = np.minimum(block, draw.size - b * block)
        if epoch == draw.passes:
            short = int(kernels.permute(np.array([draw.n_blocks - 1]), draw.n_blocks, draw.keys[epoch])[0])
            before = rank * block - np.where(short < rank, draw.n_blocks * block - draw.size, 0)
            have = np.clip(draw.rest - before, 0, have)
        begin = np.maximum(b * block, start[row])
        end = np.minimum(b * block + have, start[row] + size[row])
        keep = np.flatnonzero(end > begin)
        with np.errstate(over="ignore"):
            place = kernels.mix(kernels.mix(b[keep].astype(U64)) + U64(draw.keys[epoch] & (2**64 - 1)))
        shard = np.searchsorted(draw.ends, epoch * draw.n_blocks + rank[keep], "right")
        found.append((row[keep], shard, place.view(np.int64), (begin - b * block)[keep], np.full(len(keep), epoch),
                      b[keep], begin[keep] - start[row[keep]], (end - begin)[keep]))
    if not found:
        return [np.zeros(0, np.int64)] * 8
    columns = [np.concatenate(c) for c in zip(*found)]
    order = np.lexsort((columns[5], columns[4], columns[0]))
    return [c[order] for c in columns]


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


def with_sizes(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``__size``: the words of the text between white space; 0 if null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.utf8(batch.column("__text"))
            sizes = [kernels.per_text(kernels.word_starts(~WHITE[data[offsets[a]:offsets[b]]],
                                                          offsets[a:b + 1] - offsets[a]),
                                      offsets[a:b + 1] - offsets[a])
                     for a, b in kernels.in_pieces(offsets)]
            sizes = np.concatenate([np.zeros(0, np.int64), *sizes])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes)],
                                             [*batch.schema.names, "__size"])

    docs = docs.withColumn("__text", F.col(f"`{text}`")) if text != "__text" else docs
    schema = T.StructType([*docs.schema.fields, T.StructField("__size", T.LongType())])
    return docs.mapInArrow(count, schema)


def draw(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    order_by: tuple[str, ...] = ("doc_id",),
    weights=(3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    block_words: int = 1024,
    shard_words: int = 1_000_000,
    max_shards: int = 4096,
    rows_per_range: int = 5_000,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: its columns (or those in ``carry``) as struct ``row``, its ``size`` in words,
    its source's ``source_size`` and ``target``, and ``draws``: where its words go.

    A draw is (shard, place, at, epoch, block, first_word, n_words): these words stand in that shard, whose blocks are
    read in the order of ``place``, ``at`` words behind the start of their block. No word is drawn more than ceil(``most``) times, and
    of each source exactly the whole part of its target is drawn.

    Null texts have no words and no draws; null sources are a source of their own. Rows are
    ordered by a hash of ``order_by`` and the text, so runs agree; rows that are equal in these may swap.
    An empty table gives an empty result. Sizes are collected for each source, and shards times
    sources numbers are made on the driver, both bounded by ``max_shards`` and the number of sources.
    At over ``MOST_BLOCKS`` blocks the blocks get longer.
    """
    kept = docs.columns if carry is None else list(carry)
    row = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row")
    tie = F.xxhash64(*(F.col(f"`{c}`") for c in order_by), F.col(f"`{text}`")).alias("__hash")
    base = docs.select(row, F.col(f"`{source}`").cast("string").alias("__source"), tie,
                       F.col(f"`{text}`").alias("__text"))
    ranges = max(1, math.ceil(docs.count() / rows_per_range))
    keyed = lambda df: df.withColumns({"__key": _source_key(F.col("__source")),
                                       "__range": F.pmod("__hash", F.lit(ranges).cast("bigint"))})
    sums = keyed(with_sizes(base.select("__source", "__hash", "__text"), "__text"))
    sums = sums.groupBy("__key", "__range").agg(F.first("__source").alias("__source"),
                                                F.sum("__size").alias("__sum"))
    sums = stored(sums)
    by_source = {r[0]: int(r[1]) for r in sums.groupBy("__source").agg(F.sum("__sum")).collect()}
    draws, block = plan(by_source, seed, weights, share, most, block_words, shard_words, max_shards)
    by_key = {"n" if s is None else "s" + s: d for s, d in draws.items()}

    before = Window.partitionBy("__key").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("__key", "__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__key", "__range").orderBy("__hash", "__size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    sized = keyed(with_sizes(base, "__text")).drop("__text", "__source")
    placed = sized.withColumn("__before", F.coalesce(F.sum("__size").over(inside), F.lit(0)))
    placed = placed.join(starts, ["__key", "__range"]).select(
        "row", "__key", F.col("__size").alias("size"), (F.col("__start") + F.col("__before")).alias("__at"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column("__key").to_pylist(), object)
            size, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "__at"))
            parts = []
            for key in set(keys.tolist()):
                mine = np.flatnonzero(keys == key)
                found = _draws(by_key[key], block, at[mine], size[mine])
                parts.append([mine[found[0]], *found[1:]])
            found = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 8
            order = np.argsort(found[0], kind="stable")
            found = [c[order] for c in found]
            ends = np.concatenate([[0], np.cumsum(np.bincount(found[0], minlength=len(keys)))])
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            items = pa.StructArray.from_arrays(
                [pa.array(c).cast(k) for c, k in zip(found[1:], kinds)], DRAW.names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("size"),
                 pa.array([by_key[k].size for k in keys], pa.int64()),
                 pa.array([by_key[k].target for k in keys], pa.float64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)],
                ["row", "size", "source_size", "target", "draws"])

    schema = T.StructType([
        placed.schema["row"], T.StructField("size", T.LongType()),
        T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
        T.StructField("draws", T.ArrayType(DRAW)),
    ])
    return placed.mapInArrow(spread, schema)


def mixed(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The shards: ``shard``, ``place``, ``at``, ``epoch``, ``first_word``, ``n_words`` and the columns of ``docs``, the text
    cut to the words drawn. Sort a shard by ``place`` and ``at`` to read it.

    Columns of ``docs`` with one of these names are left out.
    """
    drawn = draw(docs, text=text, **options)
    names = ["shard", "place", "at", "epoch", "first_word", "n_words"]
    pieces = drawn.select("row", "size", F.explode("draws").alias("draw"))
    whole = (F.col("draw.first_word") == 0) & (F.col("draw.n_words") == F.col("size"))
    full = F.col(f"row.`{text}`")
    words = F.array_remove(F.split(full, r"[\x20\x09-\x0D]+"), "")
    cut = F.concat_ws(" ", F.slice(words, (F.col("draw.first_word") + 1).cast("int"),
                                   F.col("draw.n_words").cast("int")))
    rest = [F.when(whole, full).otherwise(cut).alias(c) if c == text else F.col(f"row.`{c}`")
            for c in docs.columns if c not in names]
    return pieces.select(*(F.col(f"draw.{n}") for n in names), *rest)
