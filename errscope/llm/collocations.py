"""Operator 13, phrase collocations by direct-address tiling.

Words of a language are ranked by frequency, and a word's rank is its number.
Neighbouring words are pairs of numbers, cells of a square that is cut into
tiles: tiles that many pairs of a buffer fall into are counted at the address
of the pair, with a dense numpy bincount; the pairs of all other tiles are
sorted and run-length counted (sorted COO). Frequent pairs are ranked in their
turn and become the left side of the next square: pair and next word make
phrases of three words, these and the next word phrases of four, and so on. A
phrase can be frequent only if both phrases that lack one end word are, so
nothing else is counted.

Every worker knows the ranks of the ``head`` most frequent words or phrases of a
level. Should a level have more, the others are told by a bitmap of fixed size and
go by their hashes in the sparse tiles; a bit that is set by chance lets a rare
phrase be counted, never one be missed.

A phrase's score is that of its weakest cut, ``1000 * a * n / (l * r)`` rounded
down (a: occurrences, l and r: those of the two parts, n: words of the
language), in whole decimal numbers.

Cases: null text counts as empty, null language as ``und``; words of upper and
lower case A-Z are one; rows that repeat an id count one by one, as ids play no
part; a language without frequent phrases has no rows; an empty table gives an
empty result; other columns are not passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_rows, map_arrow, map_batches, materialise, mix, text_slices, words_in

_STEP = np.uint64(0x9E3779B97F4A7C15)
_CUT = b".,;:!?\n\x0b\x0c\r"  # bytes that end a piece
_ENDS = np.array([b in _CUT for b in range(256)])
_IS_WORD = np.array([b not in (0x20, 0x09) and b not in _CUT for b in range(256)])

TILE = 512  # numbers along the side of a tile
DENSE = 8  # a tile is dense if a buffer has a pair for every so many of its cells
TILES_AT_ONCE = 32
BUFFER = 1 << 22  # words or pairs that a task gathers before it counts them
PAGE = 1 << 16  # bits of a page of the bitmap
PAGES = 1 << 10


# ------------------------------------------------------------------ words
@dataclass
class Slice:
    """Words of consecutive rows: keys, the pieces they stand in, and their bytes."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray  # row of the batch
    key: np.ndarray  # of word and language, below 2**62
    piece: np.ndarray

    def grams(self, size: int) -> np.ndarray:
        """Keys of the runs of ``size`` words that start at each word (ends of the slice cut off)."""
        key = self.key
        for k in range(1, size):
            key = joined_keys(key[: len(self.key) - k], self.key[k:])
        return key

    def whole(self, size: int) -> np.ndarray:
        """Whether the run of ``size`` words from each word lies in one piece."""
        n = max(0, len(self.piece) - size + 1)
        return self.piece[:n] == self.piece[size - 1 :][:n]


def joined_keys(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of phrases that are longer by one word."""
    return mix(left * _STEP + word) >> np.uint64(2)


def _language_keys(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    keys = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in coded.dictionary.to_pylist()], np.uint64)
    return keys[coded.indices.to_numpy()]


def _slices(batch: pa.RecordBatch) -> Iterator[Slice]:
    """Columns lang and text of a batch as words."""
    lang = _language_keys(batch.column(0))
    for first, data, offsets in text_slices(batch.column(1)):
        w, start, end = words_in(data, offsets, _IS_WORD)
        if not len(start):
            continue
        row = w.row_of_word() + first
        ends = np.concatenate([[0], np.cumsum(_ENDS[data])])
        new = (row[1:] != row[:-1]) | (ends[start[1:]] != ends[end[:-1]])
        key = mix(w.hash * _STEP + lang[row]) >> np.uint64(2)
        yield Slice(data, start, end, row, key, np.concatenate([[0], np.cumsum(new)]))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, key, phrase, n) of every word of (lang, text)."""

    def count(parts: list[tuple[Slice, pa.Array]]) -> pa.RecordBatch:
        bounds = np.cumsum([0, *(len(s.key) for s, _ in parts)])
        key, at, n = np.unique(np.concatenate([s.key for s, _ in parts]), return_index=True, return_counts=True)
        which = np.searchsorted(bounds, at, side="right") - 1
        langs, words = [], []
        for p, k in zip(which.tolist(), (at - bounds[which]).tolist()):
            s, lang = parts[p]
            langs.append(lang[s.row[k]].as_py())
            words.append(s.data[s.start[k] : s.end[k]].tobytes().lower().decode())
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(key.astype(np.int64)), pa.array(words, pa.string()), pa.array(n.astype(np.int64))], names=["lang", "key", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for s in _slices(batch):
                parts.append((s, batch.column(0)))
                held += len(s.key)
                if held >= BUFFER // 4:  # the texts are held too
                    yield count(parts)
                    parts, held = [], 0
        if parts:
            yield count(parts)

    found = map_arrow(texts, run, "lang string, key long, phrase string, n long")
    return found.groupBy("lang", "key").agg(F.first("phrase").alias("phrase"), F.sum("n").alias("n"))


# ------------------------------------------------------------------ ranks
class Ranks:
    """Numbers of keys: ranks by frequency; -2 - key for keys that only the
    bitmap knows; -1 for others."""

    def __init__(self, keys: np.ndarray, bits: np.ndarray | None):
        self.keys = keys.astype(np.int64)  # by rank
        self.order = np.argsort(self.keys)
        self.sorted = self.keys[self.order]
        self.seen = np.zeros(1 << 22, bool)  # a quick look before the search
        self.seen[self.keys & ((1 << 22) - 1)] = True
        self.bits = bits

    def __len__(self) -> int:
        return len(self.keys)

    def of(self, key: np.ndarray) -> np.ndarray:
        key = key.astype(np.int64)
        out = np.full(len(key), -1, np.int64)
        if len(self.keys):
            some = np.flatnonzero(self.seen[key & ((1 << 22) - 1)])
            at = np.minimum(np.searchsorted(self.sorted, key[some]), len(self.sorted) - 1)
            hit = self.sorted[at] == key[some]
            out[some[hit]] = self.order[at[hit]]
        if self.bits is not None:
            bit = key % (PAGES * PAGE)
            more = (out < 0) & ((self.bits[bit >> 3] >> (bit & 7)) & 1).astype(bool)
            out[more] = -2 - key[more]
        return out

    def key_of(self, number: np.ndarray) -> np.ndarray:
        out = -2 - number
        head = number >= 0
        out[head] = self.keys[number[head]]
        return out


def ranks_of(level: DataFrame, head: int) -> Ranks:
    """Ranks of the ``head`` most frequent keys of a level, and a bitmap of the others."""
    # by language first: words of a language have neighbouring numbers
    top = arrow_rows(level.orderBy(F.desc("n"), "key").limit(head).select("lang", "key", "n"), head, "ranked phrases")
    lang = top.column("lang").combine_chunks().dictionary_encode()
    lang = lang.combine_chunks() if isinstance(lang, pa.ChunkedArray) else lang
    key, n = (top.column(c).to_numpy() for c in ("key", "n"))
    keys = key[np.lexsort((key, -n, lang.indices.to_numpy()))] if len(key) else np.zeros(0, np.int64)
    if len(key) < head:
        return Ranks(keys, None)
    last = (n == n.min()) & (key == key[n == n.min()].max())
    least, tie = int(n[last][0]), int(key[last][0])
    rest = level.where((F.col("n") < least) | ((F.col("n") == least) & (F.col("key") > tie)))
    bit = F.pmod("key", F.lit(PAGES * PAGE))
    pages = rest.groupBy(F.floor(bit / PAGE).cast("long").alias("page")).agg(F.collect_set(F.pmod(bit, F.lit(PAGE)).cast("int")).alias("bits"))  # at most PAGE of them
    flags = np.zeros(PAGES * PAGE, bool)
    for page in arrow_rows(pages, PAGES, "pages of the bitmap").to_pylist():
        flags[page["page"] * PAGE + np.array(page["bits"])] = True
    return Ranks(keys, np.packbits(flags, bitorder="little") if flags.any() else None)


# ------------------------------------------------------------------ tiles
def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, counts) by sorting."""
    key = np.sort(key)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.diff(np.append(first, len(key)))


def count_pairs(left: np.ndarray, right: np.ndarray, columns: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left, right, count) of pairs of numbers; ``right`` is below ``columns``.

    Negative numbers have no place in the square and are sorted."""
    placed = (left >= 0) & (right >= 0)
    if not placed.all():
        a, b = left[~placed], right[~placed]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        yield a[first], b[first], np.diff(np.append(first, len(a)))
        left, right = left[placed], right[placed]
    across = -(-columns // TILE)
    tile = (left // TILE) * across + right // TILE
    used, of, size = np.unique(tile, return_inverse=True, return_counts=True)
    dense = np.flatnonzero(size >= TILE * TILE // DENSE)
    number = np.full(len(used), -1)
    number[dense] = np.arange(len(dense))
    number = number[of]
    sparse = number < 0
    key, n = _runs(left[sparse] * columns + right[sparse])
    yield key // columns, key % columns, n
    if not len(dense):
        return
    left, right, number = left[~sparse], right[~sparse], number[~sparse]
    for at in range(0, len(dense), TILES_AT_ONCE):
        own = (number >= at) & (number < at + TILES_AT_ONCE)
        address = ((number[own] - at) * TILE + left[own] % TILE) * TILE + right[own] % TILE
        cells = np.bincount(address)
        found = np.flatnonzero(cells)
        which, cell = np.divmod(found, TILE * TILE)
        down, along = np.divmod(used[dense[at + which]], across)
        yield down * TILE + cell // TILE, along * TILE + cell % TILE, cells[found]


def phrase_counts(texts: DataFrame, size: int, words: Ranks, shorter: Ranks, least: int) -> DataFrame:
    """(left, word, key, n) of the frequent phrases of ``size`` words: keys of
    the phrase without its last word, of that word, and of the whole."""
    shared = texts.sparkSession.sparkContext.broadcast((words, shorter))

    def count(left: list[np.ndarray], right: list[np.ndarray], columns: int) -> Iterator[pa.RecordBatch]:
        for a, b, n in count_pairs(np.concatenate(left), np.concatenate(right), columns):
            if len(n):
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, n)], names=["left", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shorter = shared.value
        left, right, held, columns = [], [], 0, max(1, len(words))
        for batch in batches:
            for s in _slices(batch):
                whole = np.flatnonzero(s.whole(size))
                known = shorter.of(s.grams(size - 1)) if len(whole) else np.zeros(0, np.int64)
                a, b = known[whole], words.of(s.key[whole + size - 1])
                use = (a != -1) & (b != -1) & (known[whole + 1] != -1 if size > 2 else True)
                left.append(a[use])
                right.append(b[use])
                held += len(left[-1])
                if held >= BUFFER:
                    yield from count(left, right, columns)
                    left, right, held = [], [], 0
        if held:
            yield from count(left, right, columns)

    def decode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, shorter = shared.value
        left, word = shorter.key_of(batch.column(0).to_numpy()), words.key_of(batch.column(1).to_numpy())
        key = joined_keys(left.astype(np.uint64), word.astype(np.uint64)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(word), pa.array(key), batch.column(2)], names=["left", "word", "key", "n"])

    counted = map_arrow(texts, run, "left long, word long, n long").groupBy("left", "word").agg(F.sum("n").alias("n"))
    return map_batches(counted.where(F.col("n") >= least), decode, "left long, word long, key long, n long")


# ------------------------------------------------------------------ operator
def frequent_phrases(texts: DataFrame, most_words: int, least: int, head: int) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, n) of all frequent words and phrases, (lang, n) with all words)."""
    counted = materialise(word_counts(texts), "word-counts")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = materialise(counted.where(F.col("n") >= least), "frequent-words")
    ranks = shorter = ranks_of(words, head)
    level, out = words, [words.withColumn("size", F.lit(1))]
    for size in range(2, most_words + 1):
        if not len(shorter):
            break
        found = phrase_counts(texts, size, ranks, shorter, least)
        named = found.join(level.select(F.col("key").alias("left"), "lang", F.col("phrase").alias("_start")), "left")
        named = named.join(words.select(F.col("key").alias("word"), F.col("phrase").alias("_end")), "word")
        level = materialise(named.select("lang", "key", F.concat_ws(" ", "_start", "_end").alias("phrase"), "n"), f"phrases-{size}")
        out.append(level.withColumn("size", F.lit(size)))
        shorter = ranks_of(level, head)
    phrases = out[0]
    for more in out[1:]:
        phrases = phrases.unionByName(more)
    return phrases.select("lang", "phrase", "size", "n"), totals


def _part(start, n) -> F.Column:
    return F.concat_ws(" ", F.slice("w", start, n))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    most_words: int = 5,
    least: int = 100,
    inside_percent: int = 100,
    top: int = 2000,
    head: int = 1_000_000,
) -> DataFrame:
    """(``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``):
    the best phrases of two to ``most_words`` words of each language that stand
    there ``least`` times, without those that a longer one nearly always holds."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    phrases, totals = frequent_phrases(texts, most_words, least, head)
    found = phrases.where("size > 1").withColumn("w", F.split("phrase", " "))

    # a phrase inside a longer one is also inside one that has a single word more, which stands there at least as often
    longer = found.where("size > 2")
    ends = F.array(_part(F.lit(1), F.col("size") - 1), _part(F.lit(2), F.col("size") - 1))
    held = longer.select("lang", F.explode(ends).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("_most"))
    found = found.join(held, ["lang", "phrase"], "left").where(F.col("_most").isNull() | (F.col("_most") * 100 < F.col("n") * inside_percent))

    cuts = found.select("lang", "phrase", F.col("n").alias("a"), "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("_l"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("_r"))
    for side in "lr":
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(f"_{side}"), F.col("n").alias(side)), ["lang", f"_{side}"])
    cuts = cuts.join(totals, "lang")
    a, n, left, right = (F.col(c).cast("decimal(20,0)") for c in "anlr")
    cuts = cuts.withColumns({"_over": a * n * F.lit(1000).cast("decimal(4,0)"), "_under": left * right})
    cuts = cuts.withColumn("score", F.expr("_over div _under"))
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n"))
    flat = weakest.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
