"""Operator 9, line dedup over levelled sorted runs of line hashes.

A run is a Parquet table bucketed and sorted by the line hash, one row per
line: how many documents of its batch hold it and the largest of their ids. A
line stands in one run only, that of the batch that brought it: each new batch
is written bucketed too, a merge anti join with the runs (equal buckets, so
nothing is shuffled) leaves its new lines, which are the next run, and the counts
of the lines that a run has already go to its list of additions, which is as long
as there are lines that batches share. When a level holds ``fanout`` runs they
are compacted: put together, with the additions to their lines, into one run of
the next level. Hot lines cost one row per batch: counting is partially
aggregated before the shuffle.

Texts without a line to drop stay where they are: a bitmap of bounded size over
the keys of the others tells which texts have to meet their lists.

Cases: a null or empty text is one empty line; rows that share an id are one
document, and all of them keep the lines that it owns; every row with a null id is
a document of its own, which owns a line only if no id does; an empty table gives
an empty result; other columns are passed on unless they have the name of a
result column.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import map_batches, materialise, shuffle_partitions
from .exact_dedup import bitmap_bits, bitmap_of, marked

SPACES = " \t\n\x0b\x0c\r"
_KEY = ["hi", "lo"]


def _hash(key: bytes) -> int:
    return xxhash.xxh3_128_intdigest(key)


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _long_keys(text: str, min_chars: int) -> Iterator[tuple[str, bytes | None]]:
    """Every line with its key (white space stripped at both ends, A-Z
    lower-cased), or None for a line whose key is too short."""
    for line in text.split("\n"):
        core = line.strip(SPACES)
        yield line, core.encode("utf-8", "surrogatepass").lower() if len(core) >= min_chars else None


def _row(text_col: str) -> Column:
    """With the id the key of a document: the same wherever it is computed."""
    return F.xxhash64(F.coalesce(text_col, F.lit("")))


def line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int, batches: int) -> DataFrame:
    """(batch, id, row, hi, lo): each distinct long line of each document once;
    ``row`` is the hash of its text."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batch: pa.RecordBatch):
        row, hi, lo = [], [], []
        for i, text in enumerate(batch.column(3)):
            for h in {_hash(k) for _, k in _long_keys(text.as_py() or "", min_chars) if k is not None}:
                row.append(i)
                hi.append(_long(h >> 64))
                lo.append(_long(h & 0xFFFFFFFFFFFFFFFF))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(pa.array(row, pa.int32())) for c in range(3)), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())],
            names=["batch", "id", "row", "hi", "lo"],
        )

    batch_no = F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)).cast("int")
    source = docs.select(batch_no.alias("batch"), F.col(id_col).alias("id"), _row(text_col).alias("row"), F.col(text_col).alias("text"))
    return map_batches(source, run, f"batch int, id {id_type}, row long, hi long, lo long")


@dataclass
class LineRuns:
    """The levelled runs. ``levels[k]`` lists the tables of level k, oldest
    first; ``additions`` the tables of counts of lines that a run holds already."""

    spark: SparkSession
    buckets: int
    fanout: int = 3
    levels: list[list[str]] = field(default_factory=list)
    additions: list[str] = field(default_factory=list)

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, rows: DataFrame) -> str:
        """A table of one sorted file per bucket. Rows that come out of merge joins
        of such tables lie by bucket already, so nothing is shuffled for them."""
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, name)
        rows.repartition(self.buckets, *_KEY).write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY).option("path", path).saveAsTable(name)
        return name

    def _keys(self, name: str) -> DataFrame:
        """The lines of a run, to be met in a merge join."""
        return self.spark.table(name).select(*_KEY).hint("merge")

    def add(self, lines: DataFrame) -> str:
        """Add a batch of (id, hi, lo). Returns the table of its run: the lines
        that no earlier run holds."""
        counted = lines.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("owner"))
        name = self._write(counted)
        if self.tables():
            batch = name
            fresh = self.spark.table(batch)
            for run in self.tables():
                fresh = fresh.join(self._keys(run), _KEY, "left_anti")
            name = self._write(fresh)
            known = self.spark.table(batch).join(self._keys(name), _KEY, "left_anti")
            self.additions.append(self._write(known))
            self._forget([batch])
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name)
        self._compact()
        return name

    def _together(self, runs: list[str]) -> DataFrame:
        """(hi, lo, n_docs, owner) of the lines of these runs, each of which
        stands in one of them, with all additions."""
        out = None
        for name in runs:
            rows = self.spark.table(name).select(*_KEY, "n_docs", "owner")
            for more in self.additions:
                more = self.spark.table(more).select(*_KEY, F.col("n_docs").alias("_n"), F.col("owner").alias("_o"))
                rows = rows.join(more.hint("merge"), _KEY, "left").select(*_KEY, (F.col("n_docs") + F.coalesce("_n", F.lit(0))).alias("n_docs"), F.greatest("owner", "_o").alias("owner"))
            out = rows if out is None else out.unionByName(rows)
        return out

    def _compact(self) -> None:
        """Put the runs of every level that is full together, as one of the next level."""
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                full = self.levels[level]
                run = self._write(materialise(self._together(full), "compacted"))
                others = [name for name in self.tables() if name not in full]
                left = [self._write(self._left_over(run))] if others and self.additions else []
                self._forget([*full, *self.additions])
                self.additions = left
                self.levels[level] = []
                self.levels[level + 1].append(run)
            level += 1

    def _left_over(self, run: str) -> DataFrame:
        """The additions to lines that ``run`` doesn't hold, summed up."""
        rest = None
        for name in self.additions:
            some = self.spark.table(name).join(self._keys(run), _KEY, "left_anti")
            rest = some if rest is None else rest.unionByName(some)
        # written before it is summed: Spark 4.1 takes a union of bucketed tables for a
        # bucketed table, leaves out the shuffle of the sum, and sums in each part alone
        return materialise(rest, "left-over").groupBy(*_KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("owner").alias("owner"))

    def counts(self) -> DataFrame:
        """(hi, lo, n_docs, owner) over everything added so far."""
        return self._together(self.tables())

    def _forget(self, names: list[str]) -> None:
        """Take tables out of the catalogue; their files stay below the shared folder."""
        for name in names:
            self.spark.sql(f"drop table if exists {name}")

    def close(self) -> None:
        self._forget([*self.tables(), *self.additions])
        self.levels, self.additions = [], []


def drop_lists(drops: DataFrame) -> DataFrame:
    """(drop_id, drop_row, drops): the lines listed in ``drops`` (id, row, hi,
    lo) by document, each once, so a list is bounded by one document's lines
    however many rows share its id."""
    return drops.groupBy(F.col("id").alias("drop_id"), F.col("row").alias("drop_row")).agg(F.collect_set(F.struct("hi", "lo")).alias("drops"))


def drop_lines(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Texts without the lines listed in ``drops`` (id, row, hi, lo); adds
    ``n_lines`` and ``n_dropped`` and replaces the text."""
    lists = materialise(drop_lists(drops), "drop-lists")
    bits = bitmap_bits(lists.count())
    rest = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    whole = docs.select(F.col(id_col).alias("id"), _row(text_col).alias("row"), F.struct(*rest).alias("rest"), F.coalesce(text_col, F.lit("")).alias("text"))
    whole = marked(whole, "row", bitmap_of(lists.select("drop_row"), "drop_row", bits), bits, "listed")
    met = whole.where("listed").join(lists, (F.col("row") == F.col("drop_row")) & F.col("id").eqNullSafe(F.col("drop_id")), "left")
    joined = met.select("rest", "text", F.col("drops.hi").alias("hi"), F.col("drops.lo").alias("lo"))
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    others = whole.where("not listed").select("rest", "text", (breaks + 1).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))

    def run(batch: pa.RecordBatch):
        texts, lines, dropped = [], [], []
        for text, hi, lo in zip(batch.column(1), batch.column(2), batch.column(3)):
            text = text.as_py()
            if not hi.is_valid:
                texts.append(text)
                lines.append(text.count("\n") + 1)
                dropped.append(0)
                continue
            unwanted = set(zip(hi.values.to_pylist(), lo.values.to_pylist()))
            kept, n = [], 0
            for line, key in _long_keys(text, min_chars):
                n += 1
                if key is not None:
                    h = _hash(key)
                    if (_long(h >> 64), _long(h & 0xFFFFFFFFFFFFFFFF)) in unwanted:
                        continue
                kept.append(line)
            texts.append("\n".join(kept))
            lines.append(n)
            dropped.append(n - len(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=["rest", "text", "n_lines", "n_dropped"]
        )

    schema = T.StructType([joined.schema["rest"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    out = map_batches(joined, run, schema).unionByName(others)
    columns = [F.col("text").alias(text_col) if c == text_col else F.col(f"rest.`{c}`") for c in docs.columns if c in rest or c == text_col]
    return out.select(*columns, "n_lines", "n_dropped")


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fanout: int = 3,
) -> DataFrame:
    """Lines of at least ``min_chars`` code points found in at least
    ``min_docs`` documents stay only in the document with the largest id that
    holds them. Returns the rows of ``docs`` with the new text, ``n_lines``
    (before) and ``n_dropped``."""
    spark = docs.sparkSession
    lines = materialise(line_rows(docs, id_col, text_col, min_chars, batches), "line-hashes")
    held = _once_per_id(lines, docs, id_col)
    runs = LineRuns(spark, shuffle_partitions(spark), fanout)
    for batch in range(batches):
        runs.add(held.where(F.col("batch") == batch).select("id", *_KEY))
    common = materialise(runs.counts().where(F.col("n_docs") >= min_docs), "line-common")
    runs.close()
    drops = lines.join(common.select(*_KEY, "owner"), _KEY).where(~F.col("id").eqNullSafe(F.col("owner"))).select("id", "row", *_KEY)
    return drop_lines(docs, drops, id_col, text_col, min_chars)


def _once_per_id(lines: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """``lines`` with each line once per id, where rows share an id."""
    ids = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    shared = materialise(ids.where("n > 1").select("id"), "shared-ids")
    if not shared.limit(1).count():
        return lines
    once = lines.join(shared, "id", "left_semi").dropDuplicates(["id", *_KEY])
    return materialise(lines.join(shared, "id", "left_anti").unionByName(once.select(*lines.columns)), "line-holders")
