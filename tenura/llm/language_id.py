"""Language identification by compression.

Each language has a raw-content dictionary: text of that language, at most ``dictionary_bytes`` of it.
A document is compressed with every dictionary and belongs to the language whose dictionary
makes it smallest; long ones in pieces, each with the dictionary, whose sizes are added, so that all of the text has its
say. Where the best two are closer than ``min_margin`` the document is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
NOT_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))
#: A short text is written several times, or else it may not be worth compressing at all.
SHORT, REPEATS = 256, 4
#: A longer text is cut into equal pieces of at most this; what a dictionary saves is near the start of what it is used for.
PIECE = 1 << 16
ADDED = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
])


def normal(text: str | None) -> bytes:
    """Lower-cased, ASCII characters other than letters as spaces, one space between words; empty without a letter."""
    low = (text or "").lower()
    out = b" ".join(low.encode().translate(NOT_LETTERS).split())
    return b" " + out + b" " if out and any(map(str.isalpha, low)) else b""


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents by their id; never those without one."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text", dictionary_bytes: int = 1 << 17,
          sample_chars: int = 4000, max_languages: int = 200) -> dict[str, bytes]:
    """A dictionary for each language of ``labelled``, collected to the driver.

    A bounded sample is enough: about ``dictionary_bytes`` for each language, from the first
    ``sample_chars`` characters of texts chosen by a hash, equal texts once. Rows with a null are ignored;
    languages whose texts hold no letter are not learned. More than ``max_languages`` are an error.
    """
    rows = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"),
                           F.substring(F.col(f"`{text}`"), 1, sample_chars).alias("text")).dropna()
    rows = rows.withColumn("hash", F.xxhash64("text"))
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"))
    sizes = dict(sizes.limit(max_languages + 1).collect())
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not sizes:
        return {}
    parts = 1 << 20
    share = F.create_map(*(F.lit(x) for k, n in sizes.items()
                           for x in (k, int(min(1.0, 8 * dictionary_bytes / max(n, 1)) * parts))))
    chosen = rows.where(F.pmod("hash", F.lit(parts).cast("bigint")) < share[F.col("lang")])
    chosen = chosen.dropDuplicates(["lang", "hash"])
    size = F.sum(F.octet_length("text")).over(
        Window.partitionBy("lang").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1))
    found: dict[str, list[bytes]] = {}
    within = chosen.withColumn("before", F.coalesce(size, F.lit(0))).where(F.col("before") < dictionary_bytes)
    for row in within.orderBy("lang", "hash").collect():
        found.setdefault(row["lang"], []).append(normal(row["text"]))
    made = {k: b"".join(v)[:dictionary_bytes] for k, v in found.items()}
    return {k: v for k, v in sorted(made.items()) if v}


class Classifier:
    """The compressors of all languages; made in the task that uses them."""

    def __init__(self, dictionaries: dict[str, bytes], level: int):
        self.languages = list(dictionaries)
        self.compressors = []
        for content in dictionaries.values():
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(
                level=level, dict_data=raw, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: bytes) -> np.ndarray:
        step = -(-len(text) // -(-len(text) // PIECE))
        pieces = [text[i:i + step] for i in range(0, len(text), step)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in self.compressors])

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): of equal sizes the first language; ``und`` without a letter or language."""
        data = normal(text)
        if not data or not self.languages:
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(data * REPEATS if len(data) < SHORT else data)
        best = int(np.argmin(sizes))
        rest = np.delete(sizes, best)
        margin = float((rest.min() - sizes[best]) / rest.min()) if len(rest) else 1.0
        score = 1.0 / np.exp2(-np.minimum(sizes - sizes[best], 1000).astype(float)).sum()
        return self.languages[best], float(score), margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", min_margin: float = 0.002,
             level: int = 5) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``margin`` and ``rejected``.

    The prediction sees the whole text and nothing else. ``margin`` is by how much smaller the best size is than the
    next, as a share of that; ``score`` (0 to 1) takes every byte of difference for a halving of the odds.
    Texts that are null or have no letter are ``und`` with score 0 and rejected, and so is everything if no
    language was learned. Columns of ``docs`` with one of these names are replaced, all others are kept.
    """
    kept = [c for c in docs.columns if c not in ADDED.names]
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text}`").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(dictionaries, level)
        for batch in batches:
            made = [classifier.judge(t.as_py()) for t in batch.column("text")]
            lang, score, margin = zip(*made) if made else ((), (), ())
            rejected = [x == UNKNOWN or m < min_margin for x, m in zip(lang, margin)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(margin, pa.float64()), pa.array(rejected, pa.bool_())], ["row", *ADDED.names])

    schema = T.StructType([docs.schema["row"], *ADDED.fields])
    return docs.mapInArrow(predict, schema).select("row.*", *ADDED.names)
