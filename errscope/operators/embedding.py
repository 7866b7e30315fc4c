"""Trained word and document vectors kept as tables.

A model is a table (word, vec, out, n): the vector of every word, its output
weights and how often training has seen it. Training predicts a word from the mean
of the words around it (and, for document vectors, of its document's vector)
against ``negative`` other words drawn by frequency.

A pass deals the documents out to chunks of bounded size. A chunk meets the rows
of its own words in a join, goes through its texts in small steps of gradient
descent (``together`` times, each time at its own rate), and gives the rows back;
every word's rows are then averaged, weighted by the word's occurrences in each
chunk, in parts of the vocabulary that take the rows as a stream. So no task, and
never the driver, holds a whole vocabulary, and document vectors stay with their
chunk. The rows cross the network as Arrow tables; what a turn returns is written.

Continuing a stored model starts from its rows: words of the new texts go on from
where they were, words that are new start from numbers drawn by their
hash, and all others keep their vectors without being read again by a chunk.

Cases: null or empty token arrays train nothing, and their documents keep the
vector drawn by their id; a text of one word has no context but its document's;
rows that repeat an id are one document each with the same start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

CHUNK = 50_000  # tokens of a chunk, unless a single text has more
LEAST_CHUNK = 4_000  # of few texts, chunks of so many tokens are made
STEP = 256  # words that are predicted at once
SHARED = 128  # other words that all of a step are set against, weighted as ``negative`` for each
PART = 4_000_000  # numbers that a part of the vocabulary holds while it is averaged
_VEC = T.ArrayType(T.FloatType())
_TRAINED = T.StructType(
    [T.StructField("row", T.LongType()), T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("vec", _VEC), T.StructField("out", _VEC), T.StructField("loss", T.DoubleType())]
)


def _drawn(keys: np.ndarray, size: int) -> list[np.ndarray]:
    """A start for each 64-bit key: uniform numbers of a word's usual scale."""
    return [((np.random.default_rng(int(k) & (2**63 - 1)).random(size) - 0.5) / size).astype(np.float32) for k in keys]


def with_start(df: DataFrame, key: str, size: int, seed: int, out: str) -> DataFrame:
    """``df`` with a vector drawn by the hash of ``key``."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, _VEC)])

    def run(frames):
        for f in frames:
            yield f.drop(columns="_seed").assign(**{out: _drawn(f["_seed"].to_numpy(), size)})

    return df.withColumn("_seed", F.xxhash64(F.lit(seed), F.col(key))).mapInPandas(run, schema)


# ------------------------------------------------------------------ inside a chunk
def _add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add ``rows`` to the rows ``at`` of a table; a row may come up several times."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    table[at[first]] += np.add.reduceat(rows[order], first, axis=0)


def _window_sums(rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of the rows from ``first`` to before ``last``."""
    total = np.zeros((len(rows) + 1, rows.shape[1]), rows.dtype)
    np.cumsum(rows, axis=0, out=total[1:])
    return total[last] - total[first]


def descend(
    word: np.ndarray, text: np.ndarray, vec: np.ndarray, out: np.ndarray, docs: np.ndarray | None, noise: np.ndarray, window: int, negative: int, rate: float, rng: np.random.Generator
) -> float:
    """One pass over the words (numbers) of texts; changes ``vec``, ``out`` and
    ``docs`` (one row for each text) in place and returns the loss.

    ``text`` rises. Sums over windows are differences of running sums, and the words
    of a step share their other words, so that a step is a few matrix products."""
    n = len(word)
    draws = np.cumsum(noise / noise.sum())
    place = np.arange(n)
    first = np.maximum(place - window, np.searchsorted(text, text))
    last = np.minimum(place + window + 1, np.searchsorted(text, text, side="right"))
    loss = 0.0
    for at in rng.permutation(-(-n // STEP)):
        lo, hi = at * STEP, min(n, (at + 1) * STEP)
        start, stop = first[lo], last[hi - 1]
        rows, own = vec[word[start:stop]], slice(lo - start, hi - start)
        count = (last[lo:hi] - first[lo:hi] - 1).astype(np.float32)
        context = _window_sums(rows, first[lo:hi] - start, last[lo:hi] - start) - rows[own]
        if docs is not None:
            context += docs[text[lo:hi]]
            count += 1
        some = count > 0
        scale = (some / np.maximum(count, 1)).astype(np.float32)[:, None]
        context *= scale
        target = word[lo:hi]
        other = np.minimum(np.searchsorted(draws, rng.random(SHARED)), len(noise) - 1)
        wanted, against = out[target], out[other]
        near = 1 / (1 + np.exp(-np.clip((context * wanted).sum(1), -30, 30)))
        far = 1 / (1 + np.exp(-np.clip(context @ against.T, -30, 30)))
        use = (negative / SHARED * ((other != target[:, None]) & some[:, None])).astype(np.float32)
        loss -= float(np.log(np.maximum(near[some], 1e-12)).sum() + (use * np.log(np.maximum(1 - far, 1e-12))).sum())
        pull, push = (some * (1 - near) * rate).astype(np.float32), (use * far * rate).astype(np.float32)
        back = (pull[:, None] * wanted - push @ against) * scale
        _add_rows(out, target, pull[:, None] * context)
        _add_rows(out, other, -(push.T @ context))
        # a word is moved by all that it is near to
        centres = np.clip(first[start:stop], lo, hi) - lo, np.clip(last[start:stop], lo, hi) - lo
        moved = _window_sums(back, *centres)
        moved[own] -= back
        _add_rows(vec, word[start:stop], moved)
        if docs is not None:
            _add_rows(docs, text[lo:hi], back)
    return loss


# ------------------------------------------------------------------ passes
def _counts(corpus: DataFrame) -> DataFrame:
    return corpus.select(F.explode("tokens").alias("word")).where(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("seen"))


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """A column of vectors as a matrix of its own."""
    flat = column.combine_chunks().flatten() if len(column) else pa.array([], pa.float32())
    return np.array(flat.to_numpy(zero_copy_only=False), np.float32).reshape(-1, size)


def _vectors(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(np.ascontiguousarray(rows, np.float32).ravel()))


def _trained_rows(row: np.ndarray, word: pa.Array | None = None, n: np.ndarray | None = None, vec: np.ndarray | None = None, out: np.ndarray | None = None, loss: list | None = None) -> pa.Table:
    size, vectors = len(row), pa.list_(pa.float32())
    return pa.table(
        {
            "row": pa.array(row, pa.int64()),
            "word": pa.nulls(size, pa.string()) if word is None else word,
            "n": pa.array(np.zeros(size, np.int64) if n is None else n, pa.int64()),
            "vec": pa.nulls(size, vectors) if vec is None else _vectors(vec),
            "out": pa.nulls(size, vectors) if out is None else _vectors(out),
            "loss": pa.nulls(size, pa.float64()) if loss is None else pa.array(loss, pa.float64()),
        }
    )


def _turn(corpus: DataFrame, words: DataFrame, chunks: int, parts: int, size: int, window: int, negative: int, rates: list[float], seed: int, fixed: bool) -> DataFrame:
    """Trained rows: of words (row -1), of documents and of losses (row -2 for the
    first of ``rates``, -3 for the next).

    ``corpus``: (row, tokens[, doc]); ``words``: (word, seen, vec, out), or (word, seen,
    start) before the first turn: a chunk then draws the vectors of its words itself."""
    with_docs = "doc" in corpus.columns
    at_start = "start" in words.columns
    dealt = corpus.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)))
    own = dealt.select(F.col("chunk").alias("of_chunk"), F.explode("tokens").alias("word")).distinct().join(words, "word")

    def run(key, texts, known):
        texts = texts.sort_by("row")
        tables = [_trained_rows(np.zeros(0, np.int64))]
        docs = _matrix(texts["doc"], size) if with_docs else None
        if texts.num_rows and known.num_rows:
            order = pc.sort_indices(known["word"])
            names, seen = (known[c].combine_chunks().take(order) for c in ("word", "seen"))
            if at_start:
                vec = np.vstack(_drawn(known["start"].to_numpy()[order.to_numpy()], size))
                out = np.zeros_like(vec)
            else:
                vec, out = (_matrix(known[c], size)[order.to_numpy()] for c in ("vec", "out"))
            lists = texts["tokens"].combine_chunks()
            number = pc.index_in(lists.flatten(), names)
            text = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            met = number.is_valid().to_numpy(zero_copy_only=False)
            word, text = number.drop_null().to_numpy().astype(np.int64), text[met]
            before = (vec.copy(), out.copy()) if fixed else None
            rng = np.random.default_rng([seed, key[0].as_py()])
            losses = [descend(word, text, vec, out, docs, seen.to_numpy().astype(float) ** 0.75, window, negative, rate, rng) for rate in rates]
            if fixed:
                vec, out = before
            else:
                tables.append(_trained_rows(np.full(len(vec), -1), names.cast(pa.string()), np.bincount(word, minlength=len(vec)), vec, out))
            tables.append(_trained_rows(-2 - np.arange(len(rates)), n=np.full(len(rates), len(word)), loss=losses))
        if with_docs:
            tables.append(_trained_rows(texts["row"].to_numpy(), vec=docs))
        return pa.concat_tables(tables)

    trained = dealt.groupBy("chunk").cogroup(own.groupBy("of_chunk")).applyInArrow(run, _TRAINED)
    part = F.pmod(F.xxhash64(F.coalesce("word", F.col("row").cast("string"))), F.lit(parts))
    return trained.withColumn("part", part).groupBy("part").applyInArrow(_averaging(size), _TRAINED)


def _averaging(size: int):
    """A word's rows of all chunks become one, weighted by occurrences, with their
    number; the rows of documents and losses stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        total, n = np.zeros((1024, 2 * size)), np.zeros(1024, np.int64)
        for batch in batches:
            some = pa.Table.from_batches([batch]).select(_TRAINED.names)
            is_word = pc.equal(some["row"], -1)
            yield from some.filter(pc.invert(is_word)).combine_chunks().to_batches()
            some = some.filter(is_word)
            if not some.num_rows:
                continue
            at = np.array([number.setdefault(w, len(number)) for w in some["word"].to_pylist()])
            while len(total) < len(number):
                total, n = np.concatenate([total, np.zeros_like(total)]), np.concatenate([n, np.zeros_like(n)])
            seen = some["n"].to_numpy()
            np.add.at(n, at, seen)
            _add_rows(total, at, np.concatenate([_matrix(some["vec"], size), _matrix(some["out"], size)], axis=1) * seen[:, None].astype(float))
        names = list(number)
        for lo in range(0, len(names), 2000):
            some = slice(lo, min(lo + 2000, len(names)))
            means = total[some] / n[some, None]
            yield from _trained_rows(np.full(len(means), -1), pa.array(names[some], pa.string()), n[some], means[:, :size], means[:, size:]).combine_chunks().to_batches()

    return run


def _first_state(counts: DataFrame, size: int, seed: int, passes: int) -> DataFrame:
    """The words before the first turn, with the key that their start is drawn by; vectors
    are neither written nor sent. Without passes, with their vectors."""
    if passes < 1:
        return with_start(counts, "word", size, seed, "vec").withColumn("out", F.array_repeat(F.lit(0.0).cast("float"), size))
    return counts.withColumn("start", F.xxhash64(F.lit(seed), F.col("word")))


def _state(trained: DataFrame) -> DataFrame:
    """(word, seen, vec, out) of the rows that a turn returns."""
    return trained.where("row = -1").select("word", F.col("n").alias("seen"), "vec", "out")


def _parts(counts: DataFrame, size: int) -> int:
    return max(1, -(-counts.count() * 2 * size // PART))


def _numbered(docs: DataFrame, tokens: str) -> DataFrame:
    lists = F.filter(F.coalesce(F.col(tokens), F.array().cast("array<string>")), lambda t: t.isNotNull())
    return written(docs.select(F.monotonically_increasing_id().alias("row"), lists.alias("tokens"), *[c for c in docs.columns if c not in ("row", tokens)]), "corpus")


def _chunks(corpus: DataFrame, chunk: int | None) -> int:
    """Chunks of ``chunk`` tokens; without a size, of at most 200,000 tokens, and of
    fewer where there would be only some chunks."""
    total = corpus.agg(F.sum(F.size("tokens"))).toArrow().column(0)[0].as_py() or 0
    return max(1, -(-total // (chunk or min(4 * CHUNK, max(LEAST_CHUNK, total // 24)))))


def train_word_vectors(
    docs: DataFrame,
    model: DataFrame | None = None,
    tokens: str = "sequence",
    size: int = 300,
    window: int = 7,
    passes: int = 30,
    negative: int = 5,
    rate: float = 0.025,
    chunk: int | None = CHUNK,
    seed: int = 42,
    together: int = 1,
) -> tuple[DataFrame, list[float]]:
    """V1/V2: ((word, vec, out, n), mean loss of each pass).

    With ``model`` training goes on from its rows; ``size`` is then its width. Chunks
    make ``together`` passes between two averages."""
    corpus = _numbered(docs.select(tokens), tokens)
    counts = written(_counts(corpus), "word-counts")
    chunks = _chunks(corpus, chunk)
    if model is None:
        state = _first_state(counts, size, seed, passes)
    else:
        size = width(model) or size
        met = counts.join(model.select("word", "vec", "out"), "word", "left")
        old = met.where(F.col("vec").isNotNull())
        new = with_start(met.where(F.col("vec").isNull()).select("word", "seen"), "word", size, seed, "vec").withColumn("out", F.array_repeat(F.lit(0.0).cast("float"), size))
        state = written(old.unionByName(new).select("word", "seen", "vec", "out"), "word-vectors")
    losses, parts = [], _parts(counts, size)
    for turn in range(0, passes, together):
        rates = [max(rate * (1 - k / passes), rate * 1e-3) for k in range(turn, min(passes, turn + together))]
        trained = written(_turn(corpus, state, chunks, parts, size, window, negative, rates, seed + turn, False), "trained")
        losses += _losses(trained, len(rates))
        state = _state(trained)
    out = state.select("word", "vec", "out", F.col("seen").alias("n"))
    if model is not None:
        before = model.select("word", F.col("n").alias("_n"))
        touched = out.join(before, "word", "left").select("word", "vec", "out", (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"))
        out = touched.unionByName(model.select("word", "vec", "out", "n").join(counts, "word", "left_anti"))
    return out, losses


def _losses(trained: DataFrame, passes: int) -> list[float]:
    """The mean loss of each pass of a turn."""
    rows = trained.where("row < -1").groupBy("row").agg((F.sum("loss") / F.greatest(F.sum("n"), F.lit(1))).alias("loss")).toArrow().to_pylist()
    mean = {r["row"]: r["loss"] for r in rows}
    return [mean.get(-2 - k, 0.0) for k in range(passes)]


def train_document_vectors(
    docs: DataFrame,
    doc_col: str,
    tokens: str = "sequence",
    model: DataFrame | None = None,
    size: int = 300,
    window: int = 7,
    passes: int = 10,
    negative: int = 5,
    rate: float = 0.05,
    chunk: int = CHUNK,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, list[float]]:
    """V6: ((doc_col, doc_vector), the word model, mean loss of each pass).

    With ``model`` its words stay as they are and only documents are trained, which
    gives vectors to documents that training has not seen."""
    corpus = _numbered(docs.select(F.col(doc_col).alias("_id"), tokens), tokens)
    counts = written(_counts(corpus), "word-counts")
    chunks = _chunks(corpus, chunk)
    if model is None:
        state = _first_state(counts, size, seed, passes)
    else:
        size = width(model) or size
        state = counts.drop("seen").join(model.select("word", F.col("n").alias("seen"), "vec", "out"), "word")
        state = written(state.select("word", "seen", "vec", "out"), "word-vectors")
    texts = corpus.select("row", "tokens", "_id")
    texts = written(with_start(texts, "_id", size, seed + 1, "doc"), "documents")
    names = texts.select("row", "_id", "tokens")
    losses, parts = [], _parts(counts, size)
    for turn in range(passes):
        step = max(rate * (1 - turn / passes), rate * 1e-3)
        trained = written(_turn(texts.select("row", "tokens", "doc"), state, chunks, parts, size, window, negative, [step], seed + turn, model is not None), "trained")
        losses += _losses(trained, 1)
        texts = written(names.join(trained.where("row >= 0").select("row", F.col("vec").alias("doc")), "row"), "documents")
        if model is None:
            state = _state(trained)
    out = texts.select(F.col("_id").alias(doc_col), F.col("doc").alias("doc_vector"))
    return out, state.select("word", "vec", "out", F.col("seen").alias("n")), losses


# ------------------------------------------------------------------ use
def mean_vectors(model: DataFrame, docs: DataFrame, tokens: str = "sequence", out: str = "vector", chunk: int | None = None) -> DataFrame:
    """V4: ``docs`` with the mean of the vectors of a row's tokens; tokens without a
    vector count as zeros, a row without tokens gets zeros.

    Rows are dealt to chunks of about ``chunk`` tokens (more of them the shorter vectors
    are), and a vector goes once to each chunk that has its word. Rows cross the network
    once, and leave the chunk with their means."""
    size = width(model) or 1
    chunk = chunk or min(20 * CHUNK, max(4 * CHUNK, 1200 * CHUNK // size))
    names = [c for c in docs.columns if c != out or c == tokens]
    rows = written(docs.select(*names, F.monotonically_increasing_id().alias("_row")), "rows")
    chunks = _chunks(rows.select(F.col(tokens).alias("tokens")).where(F.size("tokens") > 0), chunk)
    dealt = rows.withColumn("_chunk", F.pmod(F.xxhash64("_row"), F.lit(chunks))).drop("_row")
    words = dealt.select(F.col("_chunk").alias("of_chunk"), F.explode(tokens).alias("word")).distinct()
    own = words.join(model.select("word", "vec").where(F.col("vec").isNotNull()), "word")
    fields = [docs.schema[c] for c in names if c != out]
    schema = T.StructType([*fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        means = np.zeros((texts.num_rows, size))
        if texts.num_rows and known.num_rows:
            if (known["vec"].combine_chunks().value_lengths().to_numpy() != size).any():
                raise ValueError("vectors differ in length")
            found = known["word"].combine_chunks().dictionary_encode()
            vec = np.zeros((len(found.dictionary), size))
            flat = known["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            np.add.at(vec, found.indices.to_numpy(), flat.reshape(-1, size).astype(np.float64))  # a word's rows add up
            lists = texts[tokens].combine_chunks()
            number = pc.fill_null(pc.index_in(lists.flatten(), found.dictionary), -1).to_numpy()
            length = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            end = np.cumsum(length)
            for at in np.flatnonzero(length):
                met, n = np.unique(number[end[at] - length[at] : end[at]], return_counts=True)
                if met[0] < 0:
                    met, n = met[1:], n[1:]
                if len(met):
                    means[at] = n @ vec[met] / length[at]
        column = pa.ListArray.from_arrays(np.arange(len(means) + 1, dtype=np.int32) * size, pa.array(means.ravel()))
        return texts.select([f.name for f in fields]).append_column(out, column)

    return dealt.groupBy("_chunk").cogroup(own.groupBy("of_chunk")).applyInArrow(run, schema)


def width(model: DataFrame) -> int | None:
    """The width of a model's vectors, None for an empty one."""
    first = model.select("vec").limit(1).toArrow()
    return len(first.column("vec")[0]) if first.num_rows else None


def current_version(spark: SparkSession, path: str) -> int | None:
    """The newest finished version of a stored table, None where there is none."""
    try:
        done = spark.read.schema("version long").parquet(f"{path}/versions")
        return done.agg(F.max("version")).toArrow().column(0)[0].as_py()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def store(model: DataFrame, path: str) -> int:
    """Write ``model`` as the next version below ``path``. The version counts
    only from when its number is appended to ``versions``, after all its rows; a
    run that was killed before leaves what was current."""
    spark = model.sparkSession
    version = (current_version(spark, path) or 0) + 1
    model.write.mode("overwrite").parquet(f"{path}/version={version}")
    spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current or a named version of a stored table."""
    version = version or current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing is stored at {path}")
    return spark.read.parquet(f"{path}/version={version}")
