"""Digests of the improbable features of a document.

A feature is a window of 16 bytes. Its entropy, in 1000 steps, has a rank: the rarer the entropy among all
windows of the corpus, the lower. In every run of 32 neighbouring windows the leftmost of the lowest rank is
marked; windows marked at least 8 times are the document's features. Texts of at most 256 windows keep
all of them, and texts shorter than a window are cut into windows of 4 bytes. Features go into Bloom filters of 256
bytes, 160 to a filter, then the next filter is begun. Two digests are as like as the bits of
their filters overlap beyond chance.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm import kernels
from tenura.llm.kernels import U64

WINDOW, RUN, MARKS, SHORT, TINY = 16, 32, 8, 256, 4
STEPS = 1000
FILTER_BITS, FILTER_HASHES, FILTER_FEATURES = 2048, 5, 160
PIECE = 1 << 18
ROWS_AT_ONCE = 500
_C = np.arange(WINDOW + 2, dtype=np.float64)
#: c log2 c in units of 2^-20, so that sums are exact.
WEIGHT = np.round(_C * np.log2(np.maximum(_C, 1)) * (1 << 20)).astype(np.int64)
GAIN = np.diff(WEIGHT)


def entropy_steps(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows that lie in one text: where they start, and their entropy in steps (0 to STEPS)."""
    n = len(data)
    sizes = np.maximum(np.diff(offsets) - WINDOW + 1, 0)
    if not sizes.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    same = np.empty(n, bool)
    for lag in range(1, WINDOW):
        eq = np.equal(data[lag:], data[:-lag], out=same[:n - lag]).view(np.uint8)
        before[lag:] += eq
        after[:-lag] += eq
    texts = np.flatnonzero(sizes)
    first = offsets[:-1][texts]
    heads = data[first[:, None] + np.arange(WINDOW)]
    total = np.empty(len(first), np.int64)
    for i in range(0, len(first), 256):
        equal = heads[i:i + 256, :, None] == heads[i:i + 256, None, :]
        count = equal.sum(2)
        is_first = ~np.tril(equal, -1).any(2)
        total[i:i + 256] = np.where(is_first, WEIGHT[count], 0).sum(1)
    starts = np.repeat(first - np.concatenate([[0], np.cumsum(sizes[texts])[:-1]]), sizes[texts])
    starts = starts + np.arange(len(starts))
    step = np.zeros(len(starts), np.int64)
    heads_at = np.concatenate([[0], np.cumsum(sizes[texts])[:-1]])
    inner = np.ones(len(starts), bool)
    inner[heads_at] = False
    s = starts[inner] - 1  # the byte that leaves; the one that enters is WINDOW further
    step[inner] = GAIN[before[s + WINDOW]] - GAIN[after[s]]
    ends = np.concatenate([[0], total[:-1] + np.add.reduceat(step, heads_at)[:-1]])
    step[heads_at] = total - ends  # restart the running sum at each text
    weight = np.cumsum(step)
    return starts, STEPS - weight * STEPS // int(WEIGHT[WINDOW])


def features(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the features of the texts, in order, and each one's text.

    Of texts shorter than a window they are the windows of 4 bytes, or the whole text; empty ones have none.
    """
    lengths = np.diff(offsets)
    starts, steps = entropy_steps(data, offsets)
    chosen = np.zeros(0, np.int64)
    if len(starts):
        text = np.searchsorted(offsets, starts, "right") - 1
        best = (ranks[steps].astype(np.int64) << 40) | np.arange(len(starts))
        windows = np.maximum(lengths - WINDOW + 1, 0)
        keep = windows[text] <= SHORT
        lowest, width = best, 1
        while width < RUN:
            lowest = np.minimum(lowest[:-width], lowest[width:]) if len(lowest) > width else lowest[:0]
            width *= 2
        if len(lowest):
            inside = text[:len(lowest)] == text[RUN - 1:]
            marks = np.bincount(lowest[inside] & ((1 << 40) - 1), minlength=len(starts))
            # a long text in which no window is marked often enough keeps its most marked ones
            most = np.zeros(len(lengths), np.int64)
            np.maximum.at(most, text, marks)
            keep |= marks >= np.clip(most, 1, MARKS)[text]
        chosen = np.flatnonzero(keep)
        at, owner = starts[chosen], text[chosen]
        bytes_ = np.ascontiguousarray(data[at[:, None] + np.arange(WINDOW)]).view(np.uint64)
    else:
        owner, bytes_ = np.zeros(0, np.int64), np.zeros((0, WINDOW // 8), np.uint64)
    with np.errstate(over="ignore"):
        made = np.zeros(len(bytes_), U64)
        for j in range(WINDOW // 8):
            made = kernels.mix(made * U64(0x9E3779B97F4A7C15) + bytes_[:, j] + U64(j + 1))
    tiny = [(i, data[offsets[i]:offsets[i + 1]].tobytes()) for i in np.flatnonzero((lengths > 0) & (lengths < WINDOW))]
    parts = [(i, t[j:j + TINY]) for i, t in tiny for j in range(max(1, len(t) - TINY + 1))]
    owner = np.concatenate([owner, np.array([i for i, _ in parts], np.int64)])
    made = np.concatenate([made, np.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "big")
                                           for _, t in parts], U64)])
    order = np.argsort(owner, kind="stable")
    return made[order], owner[order]


def chain(hashes: np.ndarray) -> np.ndarray:
    """The Bloom filters (rows of bits) of a text's features; a feature that the current filter has is not added again."""
    _, first = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(first)]
    filters = np.zeros((-(-len(hashes) // FILTER_FEATURES), FILTER_BITS), bool)
    number = np.arange(len(hashes)) // FILTER_FEATURES
    for j in range(FILTER_HASHES):
        filters[number, (hashes >> U64(11 * j)) & U64(FILTER_BITS - 1)] = True
    return filters


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The filters of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    out = []
    for a, b in kernels.in_pieces(offsets, PIECE):
        data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        hashes, owner = features(data, offsets[a:b + 1] - offsets[a], ranks)
        cuts = np.searchsorted(owner, np.arange(b - a + 1))
        out += [chain(hashes[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
    return out


def encode(filters: np.ndarray) -> str:
    """A digest as text: the number of filters and their bits."""
    return f"{len(filters)}:{base64.b64encode(np.packbits(filters, axis=1).tobytes()).decode()}" if len(filters) else ""


def decode(digest: str) -> np.ndarray:
    if not digest:
        return np.zeros((0, FILTER_BITS), bool)
    count, _, body = digest.partition(":")
    packed = np.frombuffer(base64.b64decode(body), np.uint8).reshape(int(count), -1)
    return np.unpackbits(packed, axis=1).astype(bool)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: for each filter of the shorter digest its best overlap, beyond what chance gives, with one of the other.

    Two empty digests are alike, an empty one and another are not.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    x, y = a.astype(np.float32), b.astype(np.float32)
    in_a, in_b = x.sum(1)[:, None], y.sum(1)[None, :]
    common, chance, most = x @ y.T, in_a * in_b / FILTER_BITS, np.minimum(in_a, in_b)
    return float(np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(1).mean())


def entropy_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The rank of each entropy step: rare ones first, by how many windows of the whole corpus have it.

    Steps that no window has come last. Only the counts of the steps reach the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STEPS + 1, np.int64)
        for batch in batches:
            data, offsets = kernels.utf8(batch.column(0))
            for a, b in kernels.in_pieces(offsets, PIECE):
                steps = entropy_steps(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])[1]
                total += np.bincount(steps, minlength=STEPS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(STEPS + 1)), pa.array(total)], ["step", "n"])

    counts = docs.select(F.col(f"`{text}`")).mapInArrow(count, "step bigint, n bigint")
    seen = np.zeros(STEPS + 1, np.int64)
    for step, n in counts.groupBy("step").agg(F.sum("n")).collect():
        seen[step] = n
    order = np.lexsort((np.arange(STEPS + 1), seen, seen == 0))
    ranks = np.empty(STEPS + 1, np.int64)
    ranks[order] = np.arange(STEPS + 1)
    return ranks


def fingerprint(docs: DataFrame, ranks: np.ndarray | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``; ``ranks`` are those of the corpus itself unless given.

    Null and empty texts have an empty fingerprint. Equal texts have equal fingerprints under the same ranks.
    A column of that name is replaced, all others are kept.
    """
    ranks = entropy_ranks(docs, text) if ranks is None else ranks
    kept = [c for c in docs.columns if c != "fingerprint"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text}`").alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            made = [encode(f) for f in digests(texts, ranks)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, pa.string())], ["row", "fingerprint"])

    schema = T.StructType([rows.schema["row"], T.StructField("fingerprint", T.StringType())])
    return rows.mapInArrow(make, schema).select("row.*", "fingerprint")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_range: int = 2_000,
              max_ranges: int = 10_000) -> DataFrame:
    """The documents in descending order of a numeric id (null last, equal ids by their texts' hashes), laid out so
    that in each partition every row with ``extra`` false is followed by its next document in the same ``range``.

    Rows are dealt into ranges of ids. The first row of a range is repeated (``extra``) at the end of the range that
    comes before it, and the first of all at the end of the last. Only ids of such rows reach the driver.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    count = rows.count()
    ranges = max(1, min(max_ranges, -(-count // rows_per_range)))
    id_ = rows.select(F.col("doc_id").cast("double").alias("at"))
    edges = sorted(set(id_.approxQuantile("at", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges)))) if ranges > 1 and count else []
    splits = [-float("inf"), *edges, float("inf")]
    rows = rows.withColumns({"at": F.col("doc_id").cast("double"), "part": F.lit(0.0)})
    if edges:
        rows = Bucketizer(splits=splits, inputCol="at", outputCol="part", handleInvalid="keep").transform(rows.drop("part"))
    # ranges in reading order: descending ids, then rows without id
    rows = rows.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(len(splits)))
                           .otherwise(F.lit(len(splits) - 2) - F.col("part").cast("int"))).drop("at", "part")
    heads = rows.groupBy("range").agg(F.max(F.struct("doc_id", "hash")).alias("head")).orderBy("range").collect()
    to = [(heads[i - 1]["range"], h["head"]["doc_id"], h["head"]["hash"]) for i, h in enumerate(heads)]
    repeated = docs.sparkSession.createDataFrame(
        to, T.StructType([T.StructField("to", T.IntegerType()),
                          T.StructField("head_id", rows.schema["doc_id"].dataType),
                          T.StructField("head_hash", T.LongType())]))
    is_head = rows["doc_id"].eqNullSafe(F.col("head_id")) & (rows["hash"] == F.col("head_hash"))
    extra = rows.join(F.broadcast(repeated), is_head).select("doc_id", "text", "hash", F.col("to").alias("range"),
                                                             F.lit(True).alias("extra"))
    laid = rows.select("doc_id", "text", "hash", "range", F.lit(False).alias("extra")).unionByName(extra)
    return laid.repartition("range").sortWithinPartitions(
        "range", "extra", F.col("doc_id").desc_nulls_last(), F.col("hash").desc())


PAIR = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def compare_with_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: np.ndarray | None = None,
                        rows_per_range: int = 2_000) -> DataFrame:
    """For each document its fingerprint, that of an edited text, and how like it is to that and to the next document's.

    The edited text has the last half of the characters (rounded down) replaced by the first as many, or all, of
    the next document in descending order of ``doc_id``; the first document follows the last. Result: ``doc_id``,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``, a row for each row of ``docs``.
    Null texts are empty. A single document is its own next. Equal ids are ordered by their texts' hashes.
    Other columns are not looked at; an empty table gives an empty result.
    """
    ranks = entropy_ranks(docs, text) if ranks is None else ranks
    laid = with_next(docs, doc_id, text, rows_per_range)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (id, text, (range, extra), digest) of the row before
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            ids = batch.column("doc_id")
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            where = list(zip(batch.column("range").to_pylist(), batch.column("extra").to_pylist()))
            prints = digests([t.encode() for t in texts], ranks)
            rows = [] if last is None else [last]
            rows += list(zip([x.as_py() for x in ids], texts, where, prints))
            mine = [(a, b) for a, b in zip(rows[:-1], rows[1:]) if not a[2][1] and a[2][0] == b[2][0]]
            last = rows[-1] if rows else last
            if not mine:
                continue
            edited = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for (_, t, *_), (_, n, *_) in mine]
            raw = [e.encode() for e in edited]
            after = digests(raw, ranks)
            columns = [
                [a[0] for a, _ in mine], [len(a[1]) for a, _ in mine], [hashlib.sha256(e).hexdigest() for e in raw],
                [encode(a[3]) for a, _ in mine], [encode(f) for f in after],
                [likeness(a[3], f) for (a, _), f in zip(mine, after)], [likeness(a[3], b[3]) for a, b in mine]]
            kinds = [ids.type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = ["doc_id", *(x.split()[0] for x in PAIR.split(", "))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = T.StructType([T.StructField("doc_id", laid.schema["doc_id"].dataType), *T.StructType.fromDDL(PAIR).fields])
    return laid.select("doc_id", "text", "range", "extra").mapInArrow(pairs, schema)
