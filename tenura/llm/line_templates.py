"""Lines that recur across documents, by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and then by its leading tokens; a token with a
digit is a variable field. What reaches the same leaf is generalised: of a line's tokens the share ``similarity``
that most of the leaf's lines have at their place is constant, and so are tokens as common as the rarest of these; the
others are variable fields too. Only the order of the counts decides, so a field stays one however large the leaf
grows. A line's template is what stays constant.
Templates that stand in ``min_docs`` documents recur; the first document that has one keeps its
lines, all others lose them. A line that recurs as it is counts in its leaf and for its template like all others, and
goes even if its template doesn't recur. Long lines may recur from fewer documents on.

Texts are parsed once into a table of line hashes and places. Lines meet as counts of (leaf, line) and (leaf, place, token)
hashes, which are added up before they are moved, and only leaves that recur and have several lines are read again,
for their tokens.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.llm.storage import stored

DIGIT = re.compile(r"\d")
#: White space other than a space and a newline: what ``str.split`` takes for white space.
ODD_SPACE = [chr(c) for c in (9, *range(11, 14), *range(28, 32), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                              0x202F, 0x205F, 0x3000)]
FIELD = "<*>"


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def parse_line(line: str, depth: int, constant: float, leaves: set[int] | None = None,
               leaf_hash: Callable[[str], int] = _hash) -> tuple[int, int, list[str]] | None:
    """(leaf, line hash, tokens with typed fields masked); None for a blank line, and for one of no leaf of ``leaves``.

    Fields are masked if at least a share of ``constant`` tokens stays; else the line stands for itself.
    """
    tokens = line.split()
    if not tokens:
        return None
    if DIGIT.search(line):
        masked = [FIELD if DIGIT.search(t) else t for t in tokens]
        if masked.count(FIELD) <= (1 - constant) * len(tokens):
            tokens = masked
    leaf = leaf_hash(f"{len(tokens)} {' '.join(tokens[:depth])}")
    return None if leaves is not None and leaf not in leaves else (leaf, _hash(" ".join(tokens)), tokens)


def _plain(text: str) -> bool:
    """Whether all white space of a text is one space between two tokens of a line, or a newline."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ":
        return False
    return not any(c in text for c in ODD_SPACE)


def _has_digit(text: str) -> bool:
    """As ``DIGIT``. Below U+0100 only 0-9 are digits, and ten searches for one character are quicker than one for a class."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return DIGIT.search(text) is not None
    return any(c in text for c in "0123456789")


def parsed(text: str, depth: int, constant: float, leaves: set[int] | None, leaf_hash: Callable[[str], int]
           ) -> Iterator[tuple[int, int, int, int, list[str] | str]]:
    """(place, leaf, line hash, tokens in the line, the tokens or the line itself) of the lines that are not blank and, if
    ``leaves`` is given, are of one of them.

    Where a text has single spaces only, a line without digits is not taken apart.
    """
    plain = _plain(text)
    digits = _has_digit(text)
    for place, line in enumerate(text.split("\n")):
        if not plain or digits and DIGIT.search(line):
            found = parse_line(line, depth, constant, leaves, leaf_hash)
            if found is not None:
                yield place, found[0], found[1], len(found[2]), found[2]
        elif line:
            size = line.count(" ") + 1
            leaf = leaf_hash(f"{size} {' '.join(line.split(' ', depth)[:depth])}")
            if leaves is None or leaf in leaves:
                yield place, leaf, _hash(line), size, line


def _map_lines(docs: DataFrame, last: str, kind: pa.DataType, rows_of: Callable, known: DataFrame | None) -> DataFrame:
    """Rows (``id``, ``hash``, ``leaf``, ``line``, ``last``) that ``rows_of(text, leaves, hash)`` makes of each text.

    ``known``: only lines of these leaves; sent along if they are few enough, else joined.
    """
    few = None
    if known is not None and known.count() <= 1_000_000:
        few = np.sort(np.array([r[0] for r in known.select("leaf").collect()], np.int64))
    names = [x.split()[0] for x in last.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves = None if few is None else set(few.tolist())
        known_hash = functools.lru_cache(1 << 16)(_hash)  # leaves and tokens are often the same
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                rows += [(i, *row) for row in rows_of(text or "", leaves, known_hash)]
                if len(rows) >= 50_000:
                    yield batch_of(batch, rows)
                    rows = []
            yield batch_of(batch, rows)

    def batch_of(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        at, *columns = zip(*rows) if rows else ((), *((),) * (len(names) + 2))
        at = pa.array(at, pa.int64())
        kinds = (pa.int64(), pa.int64(), *(pa.int32() for _ in names[1:]), kind)
        return pa.RecordBatch.from_arrays(
            [batch.column("id").take(at), batch.column("hash").take(at), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            ["id", "hash", "leaf", "line", *names])

    made = T.StructType([docs.schema["id"], docs.schema["hash"],
                         *T.StructType.fromDDL(f"leaf bigint, line bigint, {last}").fields])
    made = docs.select("id", "hash", "text").mapInArrow(read, made)
    return made if known is None or few is not None else made.join(known.select("leaf").distinct(), "leaf", "left_semi")


def all_lines(docs: DataFrame, depth: int, constant: float) -> DataFrame:
    """``id``, ``hash``, ``leaf``, ``line``, ``size``, ``places``: each document's different lines and where they stand."""

    def rows_of(text, leaves, known_hash):
        places: dict[tuple, list[int]] = {}
        for place, leaf, line, size, _ in parsed(text, depth, constant, leaves, known_hash):
            places.setdefault((leaf, line, size), []).append(place)
        return [(*key, where) for key, where in places.items()]

    return _map_lines(docs, "size int, places array<int>", pa.list_(pa.int32()), rows_of, None)


def line_tokens(docs: DataFrame, leaves: DataFrame, depth: int, constant: float, least_tokens: int) -> DataFrame:
    """``id``, ``hash``, ``leaf``, ``line``, ``tokens``: the token hashes (0: masked) of the documents' different lines
    of at least ``least_tokens`` tokens in ``leaves``."""

    def rows_of(text, leaves, known_hash):
        seen = set()
        for _, leaf, line, size, tokens in parsed(text, depth, constant, leaves, known_hash):
            if size >= least_tokens and (leaf, line) not in seen:
                seen.add((leaf, line))
                tokens = tokens.split(" ") if isinstance(tokens, str) else tokens
                yield leaf, line, [0 if t == FIELD else known_hash(t) for t in tokens]

    return _map_lines(docs, "tokens array<bigint>", pa.list_(pa.int64()), rows_of, leaves)


def recurring(docs: DataFrame, lines: DataFrame, min_docs: int, depth: int, constant: float, similarity: float,
              least_tokens: int, long_tokens: int | None = None, long_docs: int = 2) -> DataFrame:
    """The lines of recurring templates: ``leaf``, ``line`` and ``first``, the (id, hash) of the first document.

    ``lines`` are ``all_lines`` of ``docs``.
    """
    enough = F.lit(min_docs)  # documents that a line of ``size`` tokens recurs in
    if long_tokens is not None:
        enough = F.when(F.col("size") >= long_tokens, long_docs).otherwise(min_docs)
    lines = stored(lines.groupBy("leaf", "line", "size").agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("first")))
    same = lines.where(F.col("n") >= enough)

    leaves = lines.where(F.col("size") >= least_tokens).groupBy("leaf", "size").agg(
        F.sum("n").alias("n"), F.count("*").alias("different"))
    leaves = stored(leaves.where((F.col("n") >= enough) & (F.col("different") > 1)).select("leaf"))
    apart = line_tokens(docs, leaves, depth, constant, least_tokens)
    counted = same.select("leaf", "line", "first", F.col("n").alias("known"))
    apart = apart.join(counted, ["leaf", "line"], "left")
    # of a line that recurs as it is the first document's stands for all
    apart = stored(apart.where(F.col("known").isNull() | F.col("id").eqNullSafe(F.col("first.id"))
                               & (F.col("hash") == F.col("first.hash"))).drop("first"))
    once = apart.groupBy("leaf", "line").agg(
        F.first("tokens").alias("tokens"), F.coalesce(F.max("known"), F.count("*")).alias("n"))
    places = once.select("leaf", "line", "n", F.size("tokens").alias("size"), F.posexplode("tokens").alias("place", "token"))
    common = places.where("token <> 0").groupBy("leaf", "place", "token").agg(
        F.first("size").alias("size"), F.sum("n").alias("often"))
    common = common.where(F.col("often") >= enough).drop("size")
    found = places.join(common, ["leaf", "place", "token"]).groupBy("leaf", "line").agg(
        F.first("size").alias("size"), F.collect_list(F.struct("often", "place", "token")).alias("found"))
    rarest = F.get(F.sort_array("found.often", asc=False), F.ceil(similarity * F.col("size")).cast("int") - 1)
    general = found.withColumn("rarest", rarest).where("rarest IS NOT NULL")
    constants = F.filter("found", lambda x: x["often"] >= F.col("rarest"))
    constants = F.transform(constants, lambda x: F.struct(x["place"], x["token"]))
    general = stored(general.select("leaf", "line", "size", F.xxhash64(F.sort_array(constants)).alias("template")))
    stands = apart.select("leaf", "line", "id", "hash", "known").join(general, ["leaf", "line"])
    documents = stands.groupBy("leaf", "size", "template", "id", "hash").agg(F.max("known").alias("known"))
    documents = documents.groupBy("leaf", "size", "template").agg(
        F.count("*").alias("n"), F.max("known").alias("known"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("first"))
    documents = documents.where(F.greatest("n", "known") >= enough).select("leaf", "template", "first")
    generalised = stored(general.join(documents, ["leaf", "template"]).select("leaf", "line", "first"))
    same = same.select("leaf", "line", "first").join(generalised, ["leaf", "line"], "left_anti")
    return same.unionByName(generalised)


def drop_recurring_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    depth: int = 3,
    constant: float = 0.6,
    similarity: float = 0.8,
    least_tokens: int = 5,
    long_tokens: int | None = None,
    long_docs: int = 2,
) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text``, and ``n_lines``, ``n_dropped``.

    Lines end at a newline; blank lines, and what white space stands at the ends of a line or between its tokens, do not matter
    and blank lines stay. Lines of at least ``least_tokens`` tokens are generalised, if a share of ``similarity`` of
    their tokens stands in ``min_docs`` of the leaf's lines; typed fields are masked in all lines if a share of ``constant`` stays.
    For lines of at least ``long_tokens`` tokens, if given, ``long_docs`` is in place of ``min_docs``. The first document
    is that with the smallest id (null last), of equal ids that with the smallest hash of its text.

    No row is dropped: a text that loses all its lines is empty, a null text stays null with no lines. Rows with equal id and
    text are one document and treated alike. Columns of ``docs`` named like the two new ones are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{doc_id}`").alias("id"),
                       F.xxhash64(F.col(f"`{text}`")).alias("hash"), F.col(f"`{text}`").alias("text"))
    known = rows.select("id", "hash", "text").where(F.length("text") > 0)
    every = stored(all_lines(known, depth, constant))
    lines = stored(recurring(known, every, min_docs, depth, constant, similarity, least_tokens, long_tokens, long_docs))
    places = every.select("id", "hash", "leaf", "line", "places")
    first = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash"))
    gone = places.join(lines, ["leaf", "line"]).where(~first).select("id", "hash", F.explode("places").alias("place"))
    gone = gone.groupBy(F.col("id").alias("gone_id"), F.col("hash").alias("gone_hash")).agg(
        F.collect_set("place").alias("gone"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash"))
    joined = rows.join(gone, same, "left").select("row", F.col("row")[text].alias("text"), "gone")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for whole, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                parts = [] if whole is None else whole.split("\n")
                out = set(gone or ())
                made.append((whole if not out else "\n".join(x for i, x in enumerate(parts) if i not in out),
                             len(parts), len(out)))
            columns = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64())))],
                ["row", "new_text", "n_lines", "n_dropped"])

    schema = T.StructType([rows.schema["row"], T.StructField("new_text", T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    out = joined.mapInArrow(rebuild, schema)
    return out.select(*(F.col("new_text").alias(c) if c == text else F.col(f"row.`{c}`") for c in kept),
                      "n_lines", "n_dropped")
