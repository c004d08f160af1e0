"""Documents alike in their word 5-grams, by MinHash banding with exact verification.

The number of bands and of rows in a band follow from the wanted recall at the threshold. Texts that share
a band's hash meet through a hub: of each bucket the text that shares most buckets with others. A text is sent
once to each of its hubs (few, as one hub serves the buckets of a whole group) and not to every bucket, and what
shares a hub is compared on full n-gram sets, inside the task. Groups too large for a task are cut into
blocks and compared block by block. No pair leaves a task: a task returns, for each text, how
many others it is linked to and one other text that it hangs together with.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm import kernels
from tenura.llm.kernels import U64
from tenura.llm.storage import stored

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
BLOCK_TEXTS, BLOCK_WORDS = 2048, 500_000
#: Bytes of text that are hashed at once; a word costs some hundred bytes while its n-grams are hashed.
PIECE_BYTES = 1 << 18


def band_plan(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows in a band for which the wanted share of pairs at ``threshold`` meets."""
    for rows in range(most_hashes, 0, -1):
        meets = threshold**rows
        bands = 1 if meets == 1 else math.ceil(math.log1p(-recall) / math.log1p(-meets))
        if bands * rows <= most_hashes:
            return bands, rows
    raise ValueError(f"{most_hashes} hashes cannot reach a recall of {recall}")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the texts' word ``k``-grams and each one's text.

    Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased. A text of fewer than
    ``k`` words, but not none, has one n-gram of all its words.
    """
    is_word = IS_WORD[data]
    starts = kernels.word_starts(is_word, offsets)
    at = np.flatnonzero(is_word)
    if not len(at):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    begin = np.flatnonzero(starts[at])
    lengths = np.diff(np.append(begin, len(at)))
    exponent = np.arange(len(at)) - np.repeat(begin, lengths)
    with np.errstate(over="ignore"):
        values = (LOWER[data[at]].astype(U64) + U64(1)) * _powers(0x9E3779B97F4A7C15, int(lengths.max()))[exponent]
        word = kernels.mix(np.add.reduceat(values, begin) + lengths.astype(U64))
        text = np.searchsorted(offsets, at[begin], "right") - 1
        n = len(word) - k + 1
        full = np.flatnonzero(text[:n] == text[k - 1:]) if n > 0 else np.zeros(0, np.int64)
        made = np.zeros(len(full), U64)
        for j in range(k):
            made = kernels.mix(made + word[full + j] * U64(2 * j + 0x51ED270B))
        first = np.concatenate([[0], np.flatnonzero(np.diff(text)) + 1])
        count = np.diff(np.append(first, len(text)))
        few = np.flatnonzero(count < k)
        short = [kernels.mix(np.array([_fold(word[first[i]:first[i] + count[i]])], U64))[0] for i in few]
    owner = np.concatenate([text[full], text[first[few]]])
    return np.concatenate([made, np.array(short, U64)]), owner


def _fold(words: np.ndarray) -> np.uint64:
    made = U64(len(words))
    for w in words:
        made = kernels.mix(np.array([made + w * U64(0x2545F4914F6CDD1D)], U64))[0]
    return made


def band_hashes(data: np.ndarray, offsets: np.ndarray, k: int, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of band hashes for each text that has n-grams, and these texts."""
    hashes, owner = shingles(data, offsets, k)
    order = np.argsort(owner, kind="stable")
    hashes, owner = hashes[order], owner[order]
    if not len(hashes):
        return np.zeros((0, bands), np.int64), owner
    begin = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
    out = np.zeros((len(begin), bands), U64)
    with np.errstate(over="ignore"):
        seeds = kernels.mix(np.arange(1, 2 * bands * rows + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
        for i in range(bands * rows):
            low = np.minimum.reduceat(hashes * (seeds[2 * i] | U64(1)) + seeds[2 * i + 1], begin)
            out[:, i // rows] = kernels.mix(out[:, i // rows] + low + U64(i // rows + 1))
    return out.view(np.int64), owner[begin]


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """``id``, ``key`` (of the text), ``words`` (n-grams, repeats counted) and ``bands`` (null without words) for each row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernels.utf8(batch.column("text"))
            n = len(offsets) - 1
            signs, counts = [None] * n, np.zeros(n, np.int64)
            for a, b in kernels.in_pieces(offsets, PIECE_BYTES):
                piece, inner = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                made, owner = band_hashes(piece, inner, k, bands, rows)
                counts[a:b] = np.maximum(kernels.per_text(kernels.word_starts(IS_WORD[piece], inner), inner) - k + 1, 1)
                for i, row in zip(owner, made):
                    signs[a + i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(counts), pa.array(signs, pa.list_(pa.int64()))],
                ["id", "key", "words", "bands"])

    schema = T.StructType([docs.schema["id"], docs.schema["key"], T.StructField("words", T.LongType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])
    return docs.select("id", "key", "text").mapInArrow(sign, schema)


def compare(texts: list[str], k: int, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each text the later texts whose n-gram sets have a Jaccard similarity of at least ``threshold``."""
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    hashes, owners = [], []
    for a, b in kernels.in_pieces(offsets, PIECE_BYTES):
        made, owner = shingles(np.frombuffer(b"".join(raw[a:b]), np.uint8), offsets[a:b + 1] - offsets[a], k)
        hashes.append(made)
        owners.append(owner + a)
    hashes, owners = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((owners, hashes))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])  # a set holds an n-gram once
    hashes, owners = hashes[new], owners[new]
    sizes = np.bincount(owners, minlength=len(texts))
    begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    post = np.diff(np.append(begin, len(hashes)))
    gram = np.repeat(np.arange(len(begin)), post)
    shared = post[gram] > 1
    by_text = np.argsort(owners[shared], kind="stable")
    grams = gram[shared][by_text]
    cuts = np.searchsorted(owners[shared][by_text], np.arange(len(texts) + 1))
    for u in range(len(texts)):
        mine = grams[cuts[u]:cuts[u + 1]]
        if not len(mine):
            continue
        n = post[mine]
        where = np.repeat(begin[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(owners[where], minlength=len(texts))
        union = sizes[u] + sizes - common
        close = np.flatnonzero(common >= threshold * union - 1e-9)
        yield u, close[close > u]


def _task(hub, left, right, rows: list[tuple], k: int, threshold: float) -> list[tuple]:
    """(key, other, links) for the linked texts of a task; rows: (key, text, block, copies, hubs)."""
    rows = list({r[0]: r for r in rows}.values())
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = np.zeros(len(rows), np.int64)
    copies = np.array([r[3] for r in rows])
    block = np.array([r[2] for r in rows])
    several = np.array([len(r[4]) > 1 for r in rows])
    for u, close in compare([r[1] for r in rows], k, threshold):
        if left != right:
            close = close[block[close] != block[u]]
        if not len(close):
            continue
        for v in close:
            a, b = top(u), top(int(v))
            if a != b:
                parent[max(a, b)] = min(a, b)
        if several[u]:  # a pair that meets at several hubs is counted at the first
            own = set(rows[u][4])
            close = np.array([v for v in close if not several[v] or min(own & set(rows[v][4])) == hub], np.int64)
        links[u] += copies[close].sum()
        links[close] += copies[u]
    linked = {top(i) for i in range(len(rows)) if top(i) != i}
    return [(rows[i][0], rows[top(i)][0], int(links[i])) for i in range(len(rows)) if top(i) != i or i in linked]


def text_links(docs: DataFrame, sign: DataFrame, k: int, threshold: float) -> DataFrame:
    """``key``, ``other``, ``links``: the links among different texts, as each task found them."""
    texts = sign.where(F.col("bands").isNotNull()).groupBy("key").agg(
        F.min("id").alias("id"), F.first("words").alias("words"), F.count("*").alias("copies"),
        F.first("bands").alias("bands"))
    texts = stored(texts)
    buckets = texts.select("key", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").count().where(F.col("count") > 1)
    meeting = stored(buckets.join(shared, "bucket"))
    weight = meeting.groupBy("key").agg(F.sum("count").alias("weight"))
    hubs = meeting.join(weight, "key").groupBy("bucket").agg(
        F.max(F.struct("weight", "key")).alias("hub")).select("bucket", F.col("hub.key").alias("hub"))
    member = stored(meeting.join(hubs, "bucket").select("hub", "key").distinct())

    facts = texts.select("key", "id", "words", "copies")
    member = stored(member.join(facts, "key").join(
        member.groupBy("key").agg(F.sort_array(F.collect_list("hub")).alias("hubs")), "key"))
    blocks = member.groupBy("hub").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_TEXTS, F.sum("words") / BLOCK_WORDS)).cast("int").alias("blocks"))
    member = member.join(blocks, "hub").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks").cast("bigint")).cast("int"))
    member = member.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "id", "copies", "hub", "hubs", "block",
        F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"))

    full = docs.select(F.col("id").alias("text_id"), F.col("key").alias("text_key"), "text")
    # texts meet by shuffle whatever the size: a broadcast of what is needed would grow with the table
    needed = member.select("key", "id").distinct().hint("merge")
    full = full.join(needed, (F.col("text_key") == F.col("key")) & F.col("text_id").eqNullSafe(F.col("id")), "left_semi")
    work = member.join(full.select("text_key", "text").hint("merge"), F.col("key") == F.col("text_key"))
    work = work.select("hub", "left", "right", "key", "text", "block", "copies", "hubs")
    work = work.repartition("hub", "left", "right").sortWithinPartitions("hub", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, out = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != at:
                    if len(rows) > 1:
                        out += _task(*at, rows, k, threshold)
                    at, rows = row[:3], []
                rows.append(row[3:])
        if len(rows) > 1:
            out += _task(*at, rows, k, threshold)
        key, other, links = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.string()), pa.array(other, pa.string()), pa.array(links, pa.int64())],
            ["key", "other", "links"])

    return stored(work.mapInArrow(run, "key string, other string, links bigint"))


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each node of ``a``-``b`` edges hangs together with.

    Large-star and small-star steps until nothing changes; each is two joins of the edges by node, whatever the
    shape of the graph, and their number grows with the logarithm of its size.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct())
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            small.select("a", F.col("low").alias("b")))
        edges = stored(small.where("a <> b").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _text_key(text: str) -> Column:
    return F.substring(F.sha2(F.col(f"`{text}`"), 256), 1, 32)


def _base(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("id"), _text_key(text).alias("key"), F.col(f"`{text}`").alias("text"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, threshold: float = 0.8,
                    recall: float = 0.9999) -> DataFrame:
    """``doc_id``, ``text_key``, ``class_id``, ``n_links`` for each row of ``docs``.

    Two documents are linked if their texts are equal or the Jaccard similarity of their sets of word ``k``-grams is at
    least ``threshold``; pairs at the threshold are met with probability ``recall`` at least, and all that meet
    are verified on the full sets. ``n_links`` counts the documents that a document is linked to. A class is what hangs
    together by links; ``class_id`` is its smallest id. Texts of fewer than ``k`` words, but not none, have one n-gram.
    Null texts and texts without words are linked to nothing; their class is their own id.

    Rows with equal id and text are copies of each other like any equal texts. A null id is never the smallest, unless
    a class has no other. Other columns are not looked at.
    """
    bands, rows = band_plan(threshold, recall)
    base = _base(docs, doc_id, text)
    sign = stored(signatures(base, k, bands, rows))
    found = text_links(base, sign, k, threshold)
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("key").alias("a"), F.col("other").alias("b")))
    per_text = sign.where(F.col("bands").isNotNull()).groupBy("key").agg(
        F.min("id").alias("low"), F.count("*").alias("copies"))
    per_text = per_text.join(linked.withColumnRenamed("node", "key"), "key", "left").join(links, "key", "left")
    per_text = per_text.withColumn("root", F.coalesce("root", "key"))
    classes = per_text.groupBy("root").agg(F.min("low").alias("class_id"))
    per_text = stored(per_text.join(classes, "root").select(
        F.col("key").alias("text_key"), "class_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    worded = F.col("bands").isNotNull()
    # documents without words have no class to look up; they are spread by their ids
    look_up = F.when(worded, F.col("key")).otherwise(F.concat(F.lit("-"), F.xxhash64("id").cast("string")))
    own = sign.select(F.col("id").alias("doc_id"), "key", worded.alias("worded"), look_up.alias("look_up"))
    joined = own.join(per_text, F.col("look_up") == F.col("text_key"), "left")
    return joined.select("doc_id", F.col("key").alias("text_key"),
                         F.when(F.col("worded"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                         F.when(F.col("worded"), F.col("n_links")).otherwise(0).cast("bigint").alias("n_links"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class: that with the smallest id, of equal ids the one with the smallest text key.

    Documents without words all stay; of rows with equal id and text one stays. All columns are kept. Options are those
    of ``near_duplicates``.
    """
    def row_key(id_: str, key: str):
        return F.concat_ws(" ", F.col(key), F.col(id_).cast("string"))

    found = stored(near_duplicates(docs, doc_id, text, **options).where(F.col("n_links") > 0).distinct())
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    best = found.groupBy("class_id").agg(F.min(order).alias("best")).withColumnRenamed("class_id", "class")
    lost = found.join(best, F.col("class_id").eqNullSafe(F.col("class"))).where(order != F.col("best"))
    lost = lost.select(row_key("doc_id", "text_key").alias("lost")).distinct()

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col(f"`{doc_id}`").alias("id"), _text_key(text).alias("key"),
                       F.when(F.col(f"`{text}`").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"), 0).otherwise(
                           F.monotonically_increasing_id()).alias("number"))
    rows = rows.withColumn("row_key", row_key("id", "key"))
    kept = rows.join(lost, F.col("row_key") == F.col("lost"), "left_anti")
    return kept.dropDuplicates(["row_key", "number"]).select("row.*")
