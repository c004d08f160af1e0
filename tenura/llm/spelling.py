"""Spelling variants: words one edit apart, by a search scheme on a bidirectional FM-index of the vocabulary.

A pattern is cut in two. Of one error one half is free, so either half is matched exactly and then extended across the
other, with the error allowed there; both directions keep the interval of the pattern among the sorted suffixes of
the delimited vocabulary and that among the sorted reversed prefixes in step.

The vocabulary is dealt to indexes by the exact half: a word is an entry wherever a word of its length, one more or
one less could ask for it, so a question goes to one index for each half and misses nothing there. Halves that too
many words share are cut on: the other half is again exact in one of its halves. That ends at words that agree in
all but one place, of which there are few, so the parts stay bounded without dropping any word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.storage import stored

#: After A-Z are lower-cased.
RUN, NO_RUN = re.compile("[a-zÀ-ÿ]+"), re.compile("[^a-zÀ-ÿ]")
#: Code points of a text counted at once; code points of counted words that a task holds before it hands them on.
PIECE, HELD = 1 << 20, 1 << 22
#: Code points in an index, words that may share a half before it is cut on, questions and cells worked on at once.
INDEX, SHARED, AT_ONCE, CELLS = 500_000, 10_000, 4096, 1 << 20
BAR = "|"


# counting words

def _with_slips(runs: Counter, prefix: int, every: int) -> Iterator[tuple[str, int]]:
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), prefix)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        yield run, n


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least: int = 3,
                slip_every: int = 0) -> DataFrame:
    """``word``, ``n``: the words of at least ``least_length`` code points that occur ``least`` times or more in all texts.

    Words are maximal runs of a-z and U+00C0 to U+00FF after A-Z are lower-cased. With ``slip_every`` an occurrence loses a
    letter first if its checksum, the crc32 of ``<id>:<word>``, is divisible by it: the one at checksum modulo length. A
    null id is written as nothing.
    """
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
                       F.col(f"`{text}`").cast("binary").alias("raw"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = Counter(), 0
        for batch in batches:
            for id_, raw in zip(batch.column("id").to_pylist(), batch.column("raw")):
                whole = (raw.as_py() or b"").lower().decode("utf-8", "replace")
                prefix = zlib.crc32(f"{id_}:".encode())
                at = 0
                while at < len(whole):
                    cut = NO_RUN.search(whole, at + PIECE) if at + PIECE < len(whole) else None
                    end = cut.start() if cut else len(whole)
                    runs = Counter(RUN.findall(whole, at, end))
                    at = end
                    for run, n in _with_slips(runs, prefix, slip_every) if slip_every else runs.items():
                        if len(run) >= least_length:
                            if run not in held:
                                size += len(run) + 8
                            held[run] += n
                    if size > HELD:
                        yield _counted(held)
                        held, size = Counter(), 0
        yield _counted(held)

    parts = rows.mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


# who meets whom

def _head(size: Column) -> Column:
    return F.substring("word", F.lit(1), size)


def _tail(size: Column) -> Column:
    return F.substring("word", F.length("word") - size + 1, size)


def _halves(length: Column) -> list[Column]:
    """The exact parts of a question of this length, head and tail by a bar: its first half, or the rest."""
    half = F.floor(length / 2).cast("int")
    return [F.concat(_head(half), F.lit(BAR)), F.concat(F.lit(BAR), _tail(length - half))]


def _cut_on(length: Column) -> list[Column]:
    """The exact parts of a question of this length whose part ``head``, ``tail`` too many words share.

    One open place is not cut; with none there is no question. Null: the word cannot be near such a question there.
    """
    open_ = length - F.length("head") - F.length("tail")
    half = F.length("head") + F.floor(open_ / 2).cast("int")
    longer_head = F.when(half + F.length("tail") <= F.length("word"), F.concat(_head(half), F.lit(BAR), "tail"))
    longer_tail = F.when(F.length("word") - (length - half) >= F.length("head"),
                         F.concat("head", F.lit(BAR), _tail(length - half)))
    stay = F.when(open_ == 1, F.col("was"))
    return [F.when(open_ >= 2, longer_head).otherwise(stay), F.when(open_ >= 2, longer_tail).otherwise(stay)]


def _spread(rows: DataFrame, parts) -> DataFrame:
    """The rows of a word under all exact parts by which words of neighbouring lengths could ask for it."""
    own = F.array(*parts(F.length("word")))
    every = F.array(*(part for d in (-1, 0, 1) for part in parts(F.length("word") + d)))
    spread = rows.select("*", own.alias("own"), F.explode(F.array_distinct(F.array_compact(every))).alias("part"))
    asks = F.col("ask") & F.coalesce(F.array_contains("own", F.col("part")), F.lit(False))
    return spread.select("word", "n", asks.alias("ask"), "part", "was")


def meetings(words: DataFrame, shared: int = SHARED) -> DataFrame:
    """``word``, ``n``, ``ask``, ``part``: the exact parts under which a word is an entry, and if it asks there."""
    start = words.select("word", "n", F.lit(True).alias("ask"), F.lit("").alias("was"))
    open_, done = stored(_spread(start, _halves).drop("was")), None
    while True:
        hot = stored(open_.groupBy("part").count().where(F.col("count") > shared).select("part"))
        if hot.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        at = F.instr("part", BAR)
        heavy = open_.join(hot, "part", "left_semi").select(
            "word", "n", "ask", F.col("part").alias("was"), F.substring("part", F.lit(1), at - 1).alias("head"),
            F.substring("part", at + 1, F.length("part")).alias("tail"))
        cut = stored(_spread(heavy, _cut_on))
        # what was not cut is whole: its words agree in all but one place
        light = open_.join(hot, "part", "left_anti").unionByName(cut.where(F.col("part") == F.col("was")).drop("was"))
        done = light if done is None else done.unionByName(light)
        open_ = stored(cut.where(F.col("part") != F.col("was")).groupBy("part", "word").agg(
            F.first("n").alias("n"), F.max("ask").alias("ask")))


# the index of one task

class Side:
    """One direction of the index: the sorted rotations of a cyclic text and counts of the symbols before them."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.symbols, n = symbols, len(text)
        self.rotations = sorted_rotations(text, symbols)
        before = text[self.rotations - 1]
        self.step = max(16, 1 << max(0, symbols.bit_length() - 2))
        blocks = n // self.step + 1
        self.blocks = np.full(blocks * self.step, symbols, np.int32)  # padded by a symbol above all
        self.blocks[:n] = before
        self.before = self.blocks
        at = np.arange(n) // self.step * symbols + before
        counts = np.bincount(at, minlength=blocks * symbols).reshape(blocks, symbols)
        below = np.zeros((blocks + 1, symbols + 1), np.int32)
        np.cumsum(np.cumsum(counts, 0), 1, out=below[1:, 1:])
        self.below = below[:-1]  # [block, c]: symbols smaller than c in all blocks before
        self.blocks = self.blocks.reshape(blocks, self.step)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])

    def rank(self, c: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of the first ``i`` symbols are smaller than ``c``, and how many are ``c``."""
        block = i // self.step
        here = self.blocks[block]
        inside = np.arange(self.step) < (i % self.step)[:, None]
        smaller = self.below[block, c] + ((here < c[:, None]) & inside).sum(1)
        equal = self.below[block, c + 1] - self.below[block, c] + ((here == c[:, None]) & inside).sum(1)
        return smaller, equal

    def step_to(self, c: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The interval of c + pattern (start, size), and how many rows of the pattern's interval have a smaller symbol before."""
        less_a, same_a = self.rank(c, low)
        less_b, same_b = self.rank(c, low + size)
        return self.first[c] + same_a, same_b - same_a, less_b - less_a

    def _counts(self, i: np.ndarray) -> np.ndarray:
        block = i // self.step
        rows, places = np.nonzero(np.arange(self.step) < (i % self.step)[:, None])
        inside = rows * self.symbols + self.blocks[block[rows], places]
        return np.diff(self.below[block], axis=1) + np.bincount(
            inside, minlength=len(i) * self.symbols).reshape(len(i), self.symbols)

    def symbols_before(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols before each interval, as (number of the interval, symbol), without the delimiter 0."""
        found = np.zeros((len(low), self.symbols + 1), bool)
        narrow = np.flatnonzero(size <= self.step)
        places = np.arange(self.step) < size[narrow, None]
        rows, offset = np.nonzero(places)
        found[narrow[rows], self.before[low[narrow[rows]] + offset]] = True
        wide = np.flatnonzero(size > self.step)
        if len(wide):
            found[wide, :-1] = self._counts(low[wide] + size[wide]) > self._counts(low[wide])
        found[:, 0] = False
        return np.nonzero(found[:, :-1])


def sorted_rotations(text: np.ndarray, symbols: int) -> np.ndarray:
    """The starts of a cyclic text's rotations in order; all must differ. Prefix doubling from packed symbols."""
    width = 1
    while symbols ** (width + 1) < 1 << 62 and width < len(text):
        width += 1
    rank = np.zeros(len(text), np.int64)
    for j in range(width):
        rank = rank * symbols + np.roll(text, -j)
    while True:
        order = np.argsort(rank, kind="stable")
        ranked = rank[order]
        new = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if new[-1] == len(text) - 1:
            return order
        rank[order] = new
        rank = rank * len(text) + np.roll(rank, -width)
        width *= 2


class Vocabulary:
    """A bidirectional index of different words, written one after the other with a delimiter before each."""

    def __init__(self, words: list[str]):
        self.words = words
        letters = sorted(set("".join(words)))
        code = {ord(c): i + 1 for i, c in enumerate(letters)}
        flat = np.frombuffer("\0".join(["", *words]).encode("utf-32-le"), np.uint32)
        known = np.array(sorted(code), np.uint32)
        self.text = np.where(flat == 0, 0, np.searchsorted(known, flat) + 1).astype(np.int64)
        self.starts = np.flatnonzero(self.text == 0)
        self.ends = np.append(self.starts[1:], len(self.text))
        self.after = Side(self.text, len(letters) + 1)
        self.before = Side(self.text[::-1], len(letters) + 1)

    def near(self, ask: np.ndarray, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, word one edit away), as numbers, of the words asked for, the edit being past the first ``head`` and
        before the last ``tail`` code points. A pair may be given twice."""
        length = self.ends[ask] - self.starts[ask] - 1
        forward = head >= tail
        found = []
        for side, some in ((True, np.flatnonzero(forward)), (False, np.flatnonzero(~forward))):
            some = some[np.argsort(length[some], kind="stable")]
            at = 0
            while at < len(some):
                n = AT_ONCE
                while n > 1 and n * int(length[some[min(at + n, len(some)) - 1]]) > CELLS:
                    n //= 2
                part = some[at:at + n]
                at += n
                found.append(self._search(ask[part], length[part], head[part], tail[part], side))
        pairs = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found)] or [np.zeros(0, np.int64)] * 2
        return pairs[0], pairs[1]

    def _search(self, ask, length, head, tail, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """The exact start is matched towards the word's edge, then the rest away from it, with the error."""
        m = int(length.max())
        places = np.minimum(np.arange(m), length[:, None] - 1)
        if forward:
            near_side, far_side, a, b = self.after, self.before, head, length - tail
            q = self.text[self.starts[ask][:, None] + 1 + places]
        else:
            near_side, far_side, a, b = self.before, self.after, tail, length - head
            q = self.text[self.ends[ask][:, None] - 1 - places]
        low = np.zeros(len(ask), np.int64)
        other, size = low.copy(), np.full(len(ask), len(self.text))
        for t in range(int(a.max()) + 1):  # the exact part from its inner end, then the delimiter
            on = np.flatnonzero(t <= a)
            c = np.where(t < a[on], q[on, np.maximum(a[on] - 1 - t, 0)], 0)
            low[on], size[on], less = near_side.step_to(c, low[on], size[on])
            other[on] += less

        found_row, found_low = [], []
        row, p, err, low = np.arange(len(ask)), a.copy(), np.zeros(len(ask), bool), other
        while len(row):
            last = np.maximum(length[row] - 1, 0)
            may = ~err & (p < b[row])
            same_next = (p + 1 < b[row]) & (q[row, np.minimum(p, last)] == q[row, np.minimum(p + 1, last)])
            skip = np.flatnonzero(may & ~same_next)  # a letter of the question is missing in the word
            row, p, low, size = (np.concatenate([x, x[skip] + d]) for x, d in ((row, 0), (p, 1), (low, 0), (size, 0)))
            err = np.concatenate([err, np.ones(len(skip), bool)])

            end = np.flatnonzero(err & (p == length[row]))
            if len(end):
                at, n, _ = far_side.step_to(np.zeros(len(end), np.int64), low[end], size[end])
                found_row.append(row[end][n > 0])
                found_low.append(at[n > 0])

            exact = np.flatnonzero((p < length[row]) & (err | (p < b[row])))
            c = q[row[exact], p[exact]]
            steps = [(exact, c, p[exact] + 1, err[exact])]
            free = np.flatnonzero(~err & (p <= b[row]))
            of, c = far_side.symbols_before(low[free], size[free])
            of = free[of]
            here = np.where(p[of] < length[row[of]], q[row[of], np.minimum(p[of], length[row[of]] - 1)], 0)
            put = (c != here) | (p[of] == b[row[of]])  # a letter more; before an equal one it is put in later
            steps.append((of[put], c[put], p[of][put], np.ones(int(put.sum()), bool)))
            change = (c != here) & (p[of] < b[row[of]])
            steps.append((of[change], c[change], p[of][change] + 1, np.ones(int(change.sum()), bool)))
            of, c, p, err = (np.concatenate(x) for x in zip(*steps))
            low, size, _ = far_side.step_to(c, low[of], size[of])
            on = np.flatnonzero(size > 0)
            row, p, err, low, size = row[of][on], p[on], err[on], low[on], size[on]
        if not found_row:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start = far_side.rotations[np.concatenate(found_low)]
        if forward:  # there the text is reversed; the delimiter found is that of the next word
            word = (np.searchsorted(self.starts, len(self.text) - 1 - start) - 1) % len(self.words)
        else:
            word = np.searchsorted(self.starts, start)
        return ask[np.concatenate(found_row)], word


def search(group: pa.Table) -> pa.Table:
    """All pairs that the questions of a group have among its entries."""
    words = group["word"].to_pylist()
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    counts = np.zeros(len(numbers), np.int64)
    counts[[numbers[w] for w in words]] = group["n"].to_numpy()
    asks = group.filter(group["ask"])
    parts = [p.split(BAR) for p in asks["part"].to_pylist()]
    index = Vocabulary(list(numbers))
    a, b = index.near(np.array([numbers[w] for w in asks["word"].to_pylist()], np.int64),
                      np.array([len(h) for h, _ in parts], np.int64), np.array([len(t) for _, t in parts], np.int64))
    both = np.unique(np.stack([a, b]), axis=1)
    names = pa.array(index.words, pa.string())
    return pa.table({"word": names.take(pa.array(both[0])), "near": names.take(pa.array(both[1])),
                     "near_n": counts[both[1]]})


def near_words(words: DataFrame, index: int = INDEX, shared: int = SHARED) -> DataFrame:
    """``word``, ``near``, ``near_n``: all pairs (in both orders, some repeated) of the different words of a stored table ``word``, ``n``
    that differ by one inserted, deleted or replaced code point. Words must not hold a bar or U+0000."""
    rows = stored(meetings(words, shared))
    size = rows.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    rows = rows.withColumn("index", F.pmod(F.xxhash64("part"), F.lit(size // index + 1)))
    return rows.groupBy("index").applyInArrow(search, "word string, near string, near_n bigint")


# forms and roots

def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the end of each word's chain of forms. Each round doubles the length gone."""
    chain = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        up = chain.select(F.col("word").alias("root"), F.col("root").alias("above"))
        chain = stored(chain.join(up, "root", "left").select(
            "word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        if chain.where("moved").isEmpty():
            return chain.select("word", "root")
        chain = chain.drop("moved")


def variants(words: DataFrame, times: int = 2, **options) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for each of the different words of a table ``word``, ``n``.

    Near words differ by exactly one inserted, deleted or replaced code point; ``n_near`` counts them. ``form`` is the near
    word of largest ``n`` (of equal ones the first in code-point order) if that is at least ``times`` the word's own, else
    null. ``root`` is where the forms lead, the word itself if it has none. ``times`` must be over 1, so that chains end.
    Other columns are not looked at; an empty table has an empty result.
    """
    if times <= 1:
        raise ValueError("times must be over 1")
    words = stored(words.select("word", "n"))
    best = near_words(words, **options).groupBy("word").agg(
        F.count_distinct("near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best, "word", "left")
    enough = -F.col("best.less") >= times * F.col("n")
    found = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                 F.when(enough, F.col("best.near")).alias("form"),
                                 F.when(enough, -F.col("best.less")).alias("form_n")))
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slip_every: int = 0,
                    **options) -> DataFrame:
    """``variants`` of the ``word_counts`` of whole texts. Null, empty and wordless texts have no words; repeated rows count
    each time; very long texts are counted in pieces. Other columns are not looked at."""
    return variants(word_counts(docs, doc_id, text, slip_every=slip_every), **options)
