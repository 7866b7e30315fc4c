"""Operator 7, Brown class-based n-gram scoring.

Words are counted over all training rows. Those that occur at least twice (the
``head_words`` most frequent of them, should there be more) are the dictionary,
and every word of it is clustered by exchange, in distributed rounds. The texts
are written once as word numbers. A round reads them, counts class bigrams and,
for a salted batch of the words, the classes to the left and right of each; then
each word of the batch moves to the class with the greatest gain in likelihood.
The next round measures the likelihood of the new classes: should words that moved
together have lowered it, half of them are put back, and so on, so it never falls. The first
``classes - 1`` words by frequency start with a class of their own and draw the
others out of the last one. There are about as many classes as the square root of
the dictionary, up to ``max_classes``, which bounds the class bigram table.

The history of a token is the class of the token before it; words outside the
dictionary have a class of their own, and so has the start of a text:

    P(w | h) = P(class of w | class of h) * P(w | class of w)

with additive smoothing towards class frequencies in the first factor. Words of
the dictionary have their share of their class. In the class of rare words those
that training has seen have theirs less a discount; what the discounts leave
is the probability of a word that training has not seen.

Words outside the dictionary meet their counts in a join.

Cases: null or empty text is the end token alone; rows that repeat an id are
scored one by one; without training rows both scores are 0; an empty table gives
an empty result; other columns are not passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NON_SPACE, Words, arrow_rows, map_arrow, map_batches, materialise, mix, signed, unsigned, words_of

HALVINGS = 3  # how often a batch of moves that lowers the likelihood is halved before it is taken back
END = np.uint64(1)  # stands for the end of a text among word hashes
_FLUSH = 1 << 21  # words that a task gathers before it counts them


# ------------------------------------------------------------------ tokens
def _tokens(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Words of column ``at`` with the end token behind each row."""
    for batch in batches:
        for w in words_of(batch.column(at), NON_SPACE):
            ends = w.bounds[1:]
            hashes = np.insert(w.hash, ends, END)
            yield batch, Words(w.first_row, w.bounds + np.arange(w.rows + 1), hashes)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over a single text column."""

    def count(parts: list[np.ndarray]) -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(signed(word)), pa.array(n.astype(np.int64))], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for _, w in _tokens(batches, 0):
            parts.append(w.hash)
            size += len(w.hash)
            if size >= _FLUSH:
                yield count(parts)
                parts, size = [], 0
        if parts:
            yield count(parts)

    return map_arrow(texts, run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lookup:
    """Positions of hashes in a sorted array, -1 where absent."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)


# ------------------------------------------------------------------ classes
def encoded(texts: DataFrame, words: np.ndarray) -> DataFrame:
    """(ids): each text as numbers of the dictionary's words, -1 for others, written."""
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(shared.value)
        for _, w in _tokens(batches, 0):
            ids = pa.ListArray.from_arrays(pa.array(w.bounds.astype(np.int32)), pa.array(find(w.hash).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([ids], names=["ids"])

    return materialise(map_arrow(texts, run, "ids array<int>"), "encoded-texts")


def history_classes(own: np.ndarray, bounds: np.ndarray, start: int) -> np.ndarray:
    """For every token the class of the token before it in its row, or ``start``."""
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = start
    return before


def class_counts(ids: DataFrame, own: np.ndarray, classes: int, batch: np.ndarray | None) -> DataFrame:
    """(word, code, n). Word -1: bigrams of classes, code is
    ``history * (classes + 1) + class`` with the rare class after the others, and the start
    after that as a history. Other words are those of ``batch`` (a flag for each
    word): code is the class to the left, or ``classes + 2`` and the one to the right."""
    shared = ids.sparkSession.sparkContext.broadcast((np.append(own, classes).astype(np.int32), batch))
    sides = 2 * classes + 3

    def rows(word: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(word.astype(np.int32)), pa.array(code.astype(np.int32)), pa.array(n.astype(np.int64))], names=["word", "code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, batch = shared.value
        table = np.zeros((classes + 2) * (classes + 1), np.int64)
        keys, held = [], 0
        for part in batches:
            lists = part.column(0)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            word = lists.flatten().to_numpy()
            bounds = bounds - bounds[0]
            if not len(word):
                continue
            now = own[word]  # -1 is the rare class, at the end
            before = history_classes(now, bounds, classes + 1)
            table += np.bincount(before * (classes + 1) + now, minlength=len(table))
            if batch is None:
                continue
            mine = (word >= 0) & batch[word]
            last = np.zeros(len(word), bool)
            last[bounds[1:][np.diff(bounds) > 0] - 1] = True
            followed = np.flatnonzero(mine & ~last)
            keys += [word[mine].astype(np.int64) * sides + before[mine], word[followed].astype(np.int64) * sides + classes + 2 + now[followed + 1]]
            held += len(keys[-1]) + len(keys[-2])
            if held >= _FLUSH:
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield rows(key // sides, key % sides, n)
                keys, held = [], 0
        if keys:
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            yield rows(key // sides, key % sides, n)
        used = np.flatnonzero(table)
        yield rows(np.full(len(used), -1), used, table[used])

    return map_arrow(ids, run, "word int, code int, n long").groupBy("word", "code").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(table: np.ndarray) -> float:
    """What the classes add to the log likelihood of the texts, from their bigrams."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(1)).sum() - _xlogx(table.sum(0)).sum())


def best_classes(left: np.ndarray, right: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of greatest gain for each word, from the counts of classes to
    its left and right. A word's own counts are taken out of its class."""
    classes = table.shape[1] - 1
    follow, lead = table[:, :classes], table[:classes]
    n_left, n_right = left.sum(1), right.sum(1)
    size_in, size_out = follow.sum(0), lead.sum(1)
    log = lambda x: np.log(np.maximum(x, 0) + 0.5)
    gain = left @ log(follow) + right @ log(lead).T - n_left[:, None] * log(size_in) - n_right[:, None] * log(size_out)
    here = (left * log(follow.T[own] - left)).sum(1) + (right * log(lead[own] - right)).sum(1)
    here -= n_left * log(size_in[own] - n_left) + n_right * log(size_out[own] - n_right)
    row = np.arange(len(own))
    gain[row, own] = here
    best = gain.argmax(1)
    return np.where(gain[row, best] > here + 1e-9, best, own)


def moves(counts: DataFrame, own: np.ndarray, table: np.ndarray) -> DataFrame:
    """(word, class): the words of the counted batch that gain by another class."""
    classes = table.shape[1] - 1
    shared = counts.sparkSession.sparkContext.broadcast((own, table.astype(np.float64)))
    lists = counts.where("word >= 0").groupBy("word").agg(F.collect_list(F.struct("code", "n")).alias("sides"))  # at most two for a class

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own, table = shared.value
        word = batch.column(0).to_numpy()
        sides = batch.column(1)
        row = np.repeat(np.arange(len(word)), np.diff(sides.offsets.to_numpy()))
        flat = sides.flatten()
        dense = np.zeros((len(word), 2 * classes + 3))
        dense[row, flat.field(0).to_numpy()] = flat.field(1).to_numpy()
        to = best_classes(dense[:, : classes + 2], dense[:, classes + 2 :], own[word], table)
        moved = to != own[word]
        yield pa.RecordBatch.from_arrays([pa.array(word[moved]), pa.array(to[moved].astype(np.int32))], names=["word", "class"])

    return map_batches(lists, run, "word int, class int")


def exchange(ids: DataFrame, words: np.ndarray, n: np.ndarray, classes: int, sweeps: int, salts: int, few: float = 0.002) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each word, class bigrams, likelihood of each round that was kept)."""
    frequent = np.empty(len(words), np.int64)
    frequent[np.lexsort((words, -n))] = np.arange(len(words))
    own = np.minimum(frequent, classes - 1).astype(np.int32)
    salt = mix(words + np.uint64(5)) % np.uint64(salts)

    def measured(own: np.ndarray, batch: np.ndarray | None) -> tuple[DataFrame, np.ndarray]:
        counts = materialise(class_counts(ids, own, classes, batch), "class-counts")
        cells = arrow_rows(counts.where("word = -1"), (classes + 2) * (classes + 1), "class bigrams")
        table = np.zeros((classes + 2) * (classes + 1), np.int64)
        table[cells.column("code").to_numpy()] = cells.column("n").to_numpy()
        return counts, table.reshape(classes + 2, classes + 1)

    kept, reached = own, []
    pending, salt_bits = [np.zeros(0, np.int64), np.zeros(0, np.int32)], mix(words + np.uint64(11))

    def settled(own: np.ndarray, batch: np.ndarray | None) -> tuple[np.ndarray, DataFrame, np.ndarray]:
        """``own`` with as many of the pending moves as leave the likelihood where it was, measured."""
        counts, table = measured(own, batch)
        for part in range(HALVINGS + 1):
            if not reached or likelihood(table) >= reached[-1]:
                break
            some = (salt_bits[pending[0]] >> np.uint64(part)) & np.uint64(1) == 0
            some = some if part < HALVINGS else np.zeros(len(some), bool)
            own = kept.copy()
            pending[:] = [x[some] for x in pending]
            own[pending[0]] = pending[1]
            counts, table = measured(own, batch)
        reached.append(likelihood(table))
        return own, counts, table

    for _ in range(sweeps):
        moved = 0
        for turn in range(salts):
            kept, counts, table = settled(own, salt == turn)
            found = arrow_rows(moves(counts, kept, table), len(words), "moves")
            pending[:] = [found.column("word").to_numpy(), found.column("class").to_numpy()]
            own = kept.copy()
            own[pending[0]] = pending[1]
            moved += found.num_rows
        if moved <= few * len(words):
            break
    own, _, table = settled(own, None)
    return own, table, reached


# ------------------------------------------------------------------ model
@dataclass
class ClassModel:
    """What every worker needs: the dictionary, and log10 probabilities."""

    words: np.ndarray  # hashes of the dictionary, sorted
    count: np.ndarray
    own: np.ndarray  # class of each word
    emission: np.ndarray  # log10 P(word | class)
    transition: np.ndarray  # [history, class]: log10 P(class | history); the last class is that of rare words, the last history the start
    unseen: float  # log10 P(a word not seen | rare class)
    tokens: int  # N
    types: int  # V
    exchanged: float  # share of the training tokens whose words were exchanged
    reached: list[float]  # likelihood round by round

    @property
    def classes(self) -> int:
        return self.transition.shape[1] - 1

    @property
    def total(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)


def _log10(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


def train_class_model(
    texts: DataFrame, head_words: int = 1_000_000, max_classes: int = 256, sweeps: int = 2, salts: int = 4, smoothing: float = 20.0
) -> tuple[ClassModel, DataFrame, int, float]:
    """Fit the model on a single text column. Returns it with the rare words
    (word, n) outside the dictionary, their tokens and the discount."""
    counted = materialise(word_counts(texts), "word-counts")
    often = counted.where((F.col("n") > 1) & (F.col("word") != int(END)))
    top = arrow_rows(often.orderBy(F.desc("n"), "word").limit(head_words), head_words, "dictionary")
    facts = counted.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum((F.col("n") == 1).cast("long")).alias("n1"), F.sum((F.col("n") == 2).cast("long")).alias("n2"), F.max(F.when(F.col("word") == int(END), F.col("n"))).alias("ends"))
    facts = facts.toArrow().to_pylist()[0]
    words = np.append(unsigned(top.column("word").to_numpy()), END)
    n = np.append(top.column("n").to_numpy(), facts["ends"] or 0).astype(np.int64)
    order = np.argsort(words)
    words, n = words[order], n[order]
    # the last word of the list is the least frequent one: what comes after it is rare
    rest = counted.where(F.col("word") != int(END))
    if top.num_rows == head_words:
        least, tie = top.column("n")[head_words - 1].as_py(), top.column("word")[head_words - 1].as_py()
        rest = rest.where((F.col("n") < least) | ((F.col("n") == least) & (F.col("word") > tie)))
    else:
        rest = rest.where("n = 1")
    rare = rest.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toArrow().to_pylist()[0]
    tokens, rare_tokens, rare_types = facts["n"] or 0, rare["n"] or 0, rare["v"]
    n1, n2 = facts["n1"] or 0, facts["n2"] or 0
    discount = n1 / (n1 + 2 * n2) if 0 < n1 and n2 else 0.5

    classes = int(min(max_classes, max(2, round(np.sqrt(len(words))))))
    own, table, reached = exchange(encoded(texts, words), words, n, classes, sweeps, salts)
    frequency = table.sum(0) + 0.5
    frequency = frequency / frequency.sum()
    chance = (table + smoothing * frequency) / (table.sum(1, keepdims=True) + smoothing)
    size = np.bincount(own, weights=n, minlength=classes)
    emission = _log10(n / np.maximum(size[own], 1))
    unseen = _log10(np.array(discount * rare_types / rare_tokens if rare_tokens else 1.0))
    model = ClassModel(words, n, own, emission, _log10(chance), float(unseen), tokens, facts["v"], float(n.sum()) / max(tokens, 1), reached)
    return model, rest.select("word", "n"), rare_tokens, discount


def _score_rows(docs: DataFrame, model: ClassModel, id_type: str) -> DataFrame:
    """Per row its sums over words of the dictionary (``h`` is -1), and one row
    for each other word with its history."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        find, class_of = Lookup(m.words), np.append(m.own, m.classes)
        base = np.log10((m.count + 0.5) / m.total)
        for batch, w in _tokens(batches, 2):
            rows, n = w.rows, np.diff(w.bounds)
            row = w.row_of_word()
            at = find(w.hash)
            own = class_of[at]
            history = history_classes(own, w.bounds, m.classes + 1)
            known = at >= 0
            score = m.transition[history[known], own[known]] + m.emission[at[known]]
            sums = [np.bincount(row[known], weights=x, minlength=rows) for x in (base[at[known]], score)]
            found = np.bincount(row[known & (m.count[np.maximum(at, 0)] > 0)], minlength=rows)
            other = np.flatnonzero(~known)
            key = batch.column(0).slice(w.first_row, rows)
            ids = batch.column(1).slice(w.first_row, rows)
            k, none = len(other), pa.nulls
            yield pa.RecordBatch.from_arrays(
                [key, ids, key, pa.array(np.full(rows, -1, np.int32)), pa.array(n.astype(np.int64)), pa.array(found.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1])],
                names=["key", "id", "word", "h", "n_tokens", "n_known", "base", "score"],
            )
            if k:
                yield pa.RecordBatch.from_arrays(
                    [key.take(pa.array(row[other])), none(k, ids.type), pa.array(signed(w.hash[other])), pa.array(history[other].astype(np.int32)), none(k, pa.int64()), none(k, pa.int64()), none(k, pa.float64()), none(k, pa.float64())],
                    names=["key", "id", "word", "h", "n_tokens", "n_known", "base", "score"],
                )

    return map_arrow(docs, run, f"key long, id {id_type}, word long, h int, n_tokens long, n_known long, base double, score double")


def lm_scoring(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``) of every row, learning from the rows where ``train`` holds."""
    texts = docs.where(train).select(text_col)
    model, rest, rare_tokens, discount = train_class_model(texts, **settings)
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = _score_rows(keyed, model, dict(docs.dtypes)[id_col])
    rest = rest.select(F.col("word").alias("_word"), F.col("n").alias("_n"))
    met = rows.join(rest, (F.col("word") == F.col("_word")) & (F.col("h") >= 0), "left")

    rare = F.element_at(F.array(*[F.lit(float(x)) for x in model.transition[:, -1]]), F.col("h") + 1)
    is_rare, seen = F.col("h") >= 0, F.col("_n").isNotNull()
    rare_score = rare + F.when(seen, F.log10((F.col("_n") - discount) / float(max(rare_tokens, 1)))).otherwise(model.unseen)
    base = F.log10((F.coalesce("_n", F.lit(0)) + 0.5) / model.total)
    out = met.groupBy("key").agg(
        F.max("id").alias(id_col),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.when(is_rare, seen.cast("long")).otherwise(F.col("n_known"))).alias("n_known"),
        F.sum(F.when(is_rare, base).otherwise(F.col("base"))).alias("base_score"),
        F.sum(F.when(is_rare, rare_score).otherwise(F.col("score"))).alias("score"),
    )
    return out.select(id_col, "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", F.when(F.lit(model.tokens > 0), F.col("score")).otherwise(F.col("base_score")).alias("score"))
