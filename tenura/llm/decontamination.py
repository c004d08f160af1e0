"""Benchmark passages in documents, by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one window). Its
tokens are word shingles. For a document to contain the window it must contain every shingle of
it, so the necessary prefix is one shingle: the one that is rarest in the documents. Document
shingles are joined to these prefix shingles only; the place of the prefix in its window bounds
where the window can start and end, and the words between are then compared exactly.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.storage import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; none if null."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    split = F.array_remove(F.split(low, BETWEEN_WORDS), "")
    return F.coalesce(split, F.array().cast("array<string>"))


def _hash(*parts: Column) -> Column:
    """A shingle's hash, never 0."""
    made = F.xxhash64(*parts)
    return F.when(made == 0, F.lit(1).cast("bigint")).otherwise(made)


def _shingle_at(shingle: int, size: Column) -> Column:
    """The hash of the first ``size`` (at most ``shingle``) words of the struct column ``at``."""
    parts = [F.col(f"at.{i}") for i in range(shingle)]
    cases = F.when(size == shingle, _hash(*parts))
    for n in range(1, shingle):
        cases = cases.when(size == n, _hash(*parts[:n]))
    return cases


def _places(source: DataFrame, shingle: int) -> DataFrame:
    """A row for each place of ``words``, and one past the end: ``pos``, ``at`` (the words from there)."""
    n = F.size("words")
    lagged = [F.slice("words", i + 1, F.greatest(n, F.lit(1))).alias(str(i)) for i in range(shingle)]
    past = F.array(F.struct(*(F.lit(None).cast("string").alias(str(i)) for i in range(shingle))))
    return source.select("*", F.posexplode(F.concat(F.arrays_zip(*lagged), past)).alias("pos", "at"))


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct windows: ``words``, ``items`` (the ids as strings, of the items that have it)."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"),
                             words(F.col(f"`{text}`")).alias("all"))
    items = items.where(F.col("item").isNotNull() & (F.size("all") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    cut = items.select("item", F.explode(F.transform(
        starts, lambda i: F.slice("all", i, window))).alias("words"))
    return cut.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def occurrences(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 3,
    max_broadcast_windows: int = 1_000_000,
) -> DataFrame:
    """Every occurrence of a window: ``doc_id``, ``text_hash``, ``n_words``, ``start``, ``length``, ``items``.

    One more row for each row of ``documents``, with null ``start``, carries its ``n_words``, so that
    documents without a hit are there too. Windows are broadcast after they were counted; beyond
    ``max_broadcast_windows`` they are joined by shuffle.
    """
    windows = item_windows(benchmark, item_id, item_text, window).withColumn("id", F.xxhash64("words"))
    windows = stored(windows)
    size = F.least(F.size("words"), F.lit(shingle))
    lengths = [r[0] for r in windows.select(size.alias("n")).distinct().collect()]
    small = windows.count() <= max_broadcast_windows
    side = F.broadcast if small else (lambda df: df)

    n = F.size("words")
    parts = _places(windows.withColumn("size", size), shingle)
    parts = parts.where(F.col("pos") <= n - F.col("size")).select(
        "id", "words", "items", "pos", _shingle_at(shingle, F.col("size")).alias("token"))

    docs = documents.select(F.col(f"`{doc_id}`").alias("doc_id"),
                            F.xxhash64(f"`{text}`").alias("text_hash"),
                            words(F.col(f"`{text}`")).alias("words"))

    def tokens(of: DataFrame, ends: bool) -> DataFrame:
        """A row for each place and shingle length; the place past the end has the token 0."""
        places = _places(of, shingle)
        last = F.col("pos") == n
        every = [F.when(F.col(f"at.{k - 1}").isNotNull(), _shingle_at(shingle, F.lit(k)))
                 for k in sorted(lengths)]
        if ends:
            first = F.when(last, F.lit(0).cast("bigint"))
            every = [first.otherwise(every[0]), *every[1:]] if every else [first]
        token = every[0] if len(every) == 1 else F.explode(F.array(*every))
        out = places.select(*of.columns, "pos", token.alias("token"))
        return out.where(F.col("token").isNotNull())

    if lengths:
        known = parts.select("token").distinct()
        counted = tokens(docs.select("words"), ends=False).select("token")
        counted = counted.join(side(known), "token").groupBy("token").count()
        ranked = parts.join(counted, "token", "left").withColumn(
            "rank", F.struct(F.coalesce("count", F.lit(0)), "token", "pos"))
        prefixes = ranked.groupBy("id", "words", "items").agg(F.min("rank").alias("rank")).select(
            F.col("rank.token").alias("token"), F.col("rank.pos").alias("offset"),
            F.col("words").alias("window"), "items")
        prefixes = stored(prefixes)
    else:
        prefixes = docs.sparkSession.createDataFrame(
            [], "token bigint, offset int, window array<string>, items array<string>")
    end = docs.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("token"), F.lit(None).cast("int").alias("offset"),
        F.lit(None).cast("array<string>").alias("window"),
        F.lit(None).cast("array<string>").alias("items"))
    found = tokens(docs, ends=True).join(side(prefixes.unionByName(end)), "token")
    start, length = F.col("pos") - F.col("offset"), F.size("window")
    fits = (start >= 0) & (start + length <= n)
    same = F.slice("words", F.greatest(start, F.lit(0)) + 1, length) == F.col("window")
    found = found.where((F.col("token") == 0) | (fits & same))
    return found.select("doc_id", "text_hash", n.alias("n_words"), start.alias("start"),
                        F.when(start.isNotNull(), length).alias("length"), "items")


def contamination(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``items`` (sorted strings), ``spans`` for each row of ``documents``.

    A word inside any occurrence of a window is hit; ``spans`` lists [first, end) word ranges.
    Options are those of ``occurrences``. A null or wordless text has no words and no hits.
    Items without id or words are ignored; an empty benchmark hits nothing. Items with
    one id count once. Repeated documents (and null ids) give one row each. Other columns of either
    table are not looked at.
    """
    found = occurrences(documents, benchmark, **options)
    hit = F.col("start").isNotNull()
    grouped = found.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count(F.when(~hit, 1)).alias("times"),
        F.sort_array(F.collect_set(F.when(hit, F.struct(
            F.col("start").alias("first"), (F.col("start") + F.col("length")).alias("end")
        )))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    merge = F.expr("""aggregate(ranges,
        named_struct('hit', 0, 'reach', 0),
        (a, x) -> named_struct(
            'hit', a.hit + greatest(0, x.end - greatest(x.first, a.reach)),
            'reach', greatest(a.reach, x.end)),
        a -> a.hit)""")
    out = grouped.select("doc_id", "text_hash", "n_words", merge.cast("bigint").alias("n_hit"), "items",
                         F.col("ranges").alias("spans"), "times")
    repeated = F.expr("sequence(1L, times)")
    return out.select("*", F.explode(repeated).alias("__copy")).drop("times", "__copy")


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``documents`` without the rows that have a hit, all their columns kept."""
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    found = occurrences(documents, benchmark, **options).where(F.col("start").isNotNull())
    bad = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = documents[f"`{doc_id}`"].eqNullSafe(F.col("__id")) & (
        F.xxhash64(documents[f"`{text}`"]) == F.col("__hash"))
    return documents.join(bad, same, "left_anti")
