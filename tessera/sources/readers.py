"""Sources S1-S5: line files, paragraph files, JSON-lines documents, datasets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import strip_arrow
from tessera.sources import fs

DATASET_FORMATS = {"csv": "csv", "json": "json", "jsonl": "json", "txt": "text",
                   "parquet": "parquet"}


def _reject_xz(spark, paths):
    """xz has no Hadoop codec, so its bytes would come back as lines; also inside folders and globs."""
    for p in paths:
        for name in [str(p), *fs.file_names(spark, str(p))]:
            if name.endswith(".xz"):
                raise ValueError(f"{name} in {p}: xz has no Hadoop codec; recompress as gzip or bzip2")


# ------------------------------------------------------------------ S1
def read_lines(spark: SparkSession, path, line_col: str = "line") -> DataFrame:
    """Lines of a text file, or of every ``*.*`` file of a directory.

    Plain files stay splittable; ``.gz`` / ``.bz2`` are decoded by suffix.
    Lines end at ``\\n``, ``\\r`` or ``\\r\\n`` (universal newlines).  ``.xz`` is
    rejected: Spark has no codec for it and would return raw bytes.
    """
    paths = [path] if isinstance(path, str) else list(path)
    _reject_xz(spark, paths)
    reader = spark.read.format("text")
    if len(paths) == 1 and fs.is_dir(spark, paths[0]):
        reader = reader.option("pathGlobFilter", "*.*")
    return reader.load(paths).withColumnRenamed("value", line_col)


# ------------------------------------------------------------------ S2
def read_paragraphs(spark: SparkSession, path) -> DataFrame:
    """Paragraphs: runs of lines separated by lines that are blank after strip.

    Lines end at ``\\n``, ``\\r`` or ``\\r\\n``, and files of any of them stay
    splittable: every file block cuts its own lines into runs, and only the runs that touch
    an end of their block are shuffled, to be joined with their other parts.  A
    file end always ends a paragraph.  Output ``(file, record_id, para_no, lines)``, ordered in
    a file by ``(record_id, para_no)``: the start of the block in which the paragraph begins, and
    its number there (dense; from 1 on where the block's first lines belong to an earlier one).
    """
    inner, edge = _runs(spark, path)
    return inner.unionByName(_joined(edge))


def numbered_paragraphs(spark: SparkSession, path, prepare=None, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, lines)`` of :func:`read_paragraphs`, numbered in the order of file names and places.

    ``prepare`` maps an Arrow array of lines to one as long; blank is what is so before.  The
    text is read once to find the runs at the ends of the blocks (checkpointed), from whose
    numbers the counts of all follow, and once more for the lines of the others.
    """
    from tessera.operators.rowindex import block_starts, with_block_index
    from tessera.session import checkpoint_dir
    checkpoint_dir(spark)
    inner, edge = _runs(spark, path, prepare)
    edge = edge.checkpoint()
    joined = _joined(edge).checkpoint()
    # a block's runs are its first one, 0, then the inner ones, then its last one
    between = (edge.where(F.col("tail") & (F.col("para_no") > 1))
               .select("file", "record_id", F.lit(1).alias("first"), (F.col("para_no") - 1).cast("long").alias("n")))
    begun = joined.select("file", "record_id", F.col("para_no").alias("first"), F.lit(1).cast("long").alias("n"))
    counts = (between.unionByName(begun).groupBy(F.col("file").alias("_file"), F.col("record_id").alias("_block"))
              .agg(F.min("first").alias("_first"), F.sum("n").alias("_n")))
    starts = block_starts(counts)
    inner, joined = (with_block_index(rows, F.col("file"), F.col("record_id"), F.col("para_no"), id_col, starts)
                     for rows in (inner, joined))
    return inner.unionByName(joined).select(id_col, "lines")


def _runs(spark: SparkSession, path, prepare=None) -> tuple[DataFrame, DataFrame]:
    """Runs of lines that touch no end of their file block, and those that do (see ``_line_runs``)."""
    paths = [path] if isinstance(path, str) else list(path)
    _reject_xz(spark, paths)
    lines = spark.read.format("text").load(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("record_id"), "value")
    schema = "file string, record_id long, para_no int, lines array<string>, head boolean, tail boolean"
    inner, edge = (lines.mapInArrow(lambda batches, ends=ends: _line_runs(batches, ends, prepare), schema) for ends in (False, True))
    return inner.select("file", "record_id", "para_no", "lines"), edge


def _joined(edge: DataFrame) -> DataFrame:
    """A run at its block's start goes on with the one at the end of the block before."""
    order = Window.partitionBy("file").orderBy("record_id", "para_no")
    edge = edge.withColumn("begins", (~F.col("head") | ~F.coalesce(F.lag("tail").over(order), F.lit(False))).cast("long"))
    edge = edge.withColumn("chain", F.sum("begins").over(order)).where(F.size("lines") > 0)
    part = F.struct("record_id", "para_no", "lines")
    return edge.groupBy("file", "chain").agg(F.array_sort(F.collect_list(part)).alias("parts")).select(
        "file", F.col("parts")[0]["record_id"].alias("record_id"), F.col("parts")[0]["para_no"].alias("para_no"),
        F.flatten("parts.lines").alias("lines"))


def _line_runs(batches, ends: bool, prepare=None):
    """Runs of lines of each file block: number in the block, and whether they touch its first or last line.

    With ``ends`` only runs that do, without it only the others.  A block that ends or
    begins with a blank line gets an empty run there, so that its neighbours' runs see that
    nothing goes on.  Lines stay Arrow data.
    """
    names = ["file", "record_id", "para_no", "lines", "head", "tail"]
    at, number, parts, head = None, 0, [], True

    def rows(first, lines, sizes, head, tail):
        lines = lines if prepare is None else prepare(lines)
        n = len(sizes)
        bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.record_batch([pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()),
                                pa.array(np.arange(first, first + n), pa.int32()), pa.ListArray.from_arrays(bounds, lines),
                                pa.array([head] * n), pa.array([tail] * n)], names=names)

    def joined(parts):
        return pa.concat_arrays([*parts, pa.array([], pa.string())])

    for b in batches:
        files, blocks, values = b.column(0), b.column(1), b.column(2).cast(pa.string())
        new = np.flatnonzero(pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
                             .to_numpy(zero_copy_only=False)) + 1
        cuts = [0, *new.tolist(), len(values)] if len(values) else []
        for lo, hi in zip(cuts, cuts[1:]):
            place = (files[lo].as_py(), blocks[lo].as_py())
            if at != place:
                if at is not None and ends:
                    lines = joined(parts)
                    yield rows(number, lines, [len(lines)], head, True)
                at, number, parts, head = place, 0, [], True
            piece = values.slice(lo, hi - lo)
            blank = pc.equal(pc.binary_length(strip_arrow(piece)), 0).to_numpy(zero_copy_only=False)
            if not blank.any():
                parts.append(piece)
                continue
            piece = piece.filter(pa.array(~blank))
            closed = np.cumsum(~blank)[blank]  # lines before each blank one
            opened = sum(map(len, parts))
            sizes = np.diff(closed, prepend=-opened)
            if head:
                if ends:
                    lines = joined([*parts, piece.slice(0, int(closed[0]))])
                    yield rows(0, lines, [len(lines)], True, False)
                done, sizes, head, number = int(closed[0]), sizes[1:], False, 1
                parts = []
            else:
                done = 0
            sizes = sizes[sizes > 0]
            if len(sizes) and not ends:
                yield rows(number, joined([*parts, piece.slice(done, int(closed[-1]) - done)]), sizes, False, False)
            number += len(sizes)
            parts = [piece.slice(int(closed[-1]))]
    if at is not None and ends:
        lines = joined(parts)
        yield rows(number, lines, [len(lines)], head, True)


# ------------------------------------------------------------------ S3
JSON_DOC_SCHEMA = "title string, text string, _corrupt_record string"


def read_json_docs(spark: SparkSession, path, mode: str = "PERMISSIVE") -> DataFrame:
    """JSON-lines documents (gzip or plain); only ``title`` and ``text`` are parsed.

    Lines without ``text`` (index / metadata lines) and empty texts drop out.
    In ``PERMISSIVE`` mode malformed lines are kept aside in
    ``_corrupt_record`` (counted by ``json_doc_stats``); ``FAILFAST`` raises.
    """
    raw = (spark.read.schema(JSON_DOC_SCHEMA).option("mode", mode)
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    return raw.where(F.col("_corrupt_record").isNull() & F.col("text").isNotNull()
                     & (F.col("text") != "")).select("title", "text")


def json_doc_stats(spark: SparkSession, path) -> DataFrame:
    """One row ``(n_lines, n_docs, n_corrupt)`` for a JSON-lines source: all
    lines, lines kept as documents, malformed lines (reported, not fatal)."""
    raw = (spark.read.schema(JSON_DOC_SCHEMA)
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    doc = F.col("_corrupt_record").isNull() & F.col("text").isNotNull() & (F.col("text") != "")
    return raw.agg(F.count(F.lit(1)).alias("n_lines"),
                   F.count(F.when(doc, 1)).alias("n_docs"),
                   F.count("_corrupt_record").alias("n_corrupt"))


# ------------------------------------------------------------------ S4, S5
def dataset_format(spark: SparkSession, path: str) -> str:
    """Format from the suffix; a directory takes its first data file's suffix."""
    p = path
    if fs.is_dir(spark, path):
        names = [n for n in fs.list_names(spark, path) if not n.startswith((".", "_"))]
        if not names:
            raise ValueError(f"{path}: empty directory")
        p = names[0]
    base = p.rstrip("/").rsplit("/", 1)[-1]
    ext = base.rsplit(".", 1)[-1].lower() if "." in base else ""
    if ext not in DATASET_FORMATS:
        raise ValueError(f"{path}: format must be one of {sorted(DATASET_FORMATS)}")
    return DATASET_FORMATS[ext]


def read_dataset(spark: SparkSession, train_path: str, valid_path: str | None = None,
                 multi_line: bool = False):
    """``(train, valid)`` DataFrames; valid is read in train's format.

    CSV quotes are escaped by doubling.  ``multi_line`` lets quoted values hold
    line ends; such files cannot be split.
    """
    fmt = dataset_format(spark, train_path)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = (reader.option("header", "true").option("escape", '"')
                  .option("multiLine", str(multi_line).lower()))
    train = reader.load(train_path)
    valid = reader.load(valid_path) if valid_path else None
    return train, valid


def text_column(df: DataFrame, out_col: str = "text") -> DataFrame:
    """Column ``text`` if present, else the first column, as ``out_col``."""
    name = "text" if "text" in df.columns else df.columns[0]
    return df.select(F.col(name).alias(out_col))
