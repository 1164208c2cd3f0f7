"""CSV in and out."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.functions.text import na_to_null

# Where a row stood in its input: file, split, row within the split. Rows of one
# split get rising row ids, but splits are packed into tasks by size, so the
# row id alone does not give file order.
POSITION = ("_file", "_block", "_row")
OVERFLOW = "_overflow"

_RAW = "_raw_record"
_DIALECT = {
    "header": True,
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _input(spark: SparkSession, path: str, read) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise


def files_with_line_breaks_in_quotes(spark: SparkSession, path: str) -> list[str]:
    """Files of the input in which a record spans lines.

    If every line of a file holds an even number of quotes, every line starts
    outside quotes, and the file may be split at any line.
    """
    odd = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file")).where(_quotes("value") % 2 == 1)
    return [r["_file"] for r in odd.select("_file").distinct().collect()]


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """All columns as text, missing-value tokens as NULL, plus row position.

    ``_overflow`` marks records with more fields than the header; records with
    fewer are filled up with NULL. ``multi_line=None`` looks for quoted line
    breaks first; records of files that have some are put together from their
    lines (``_records``). All files are read in splits.
    """
    header = _input(spark, path, spark.read.options(**_DIALECT).csv)
    names = header.columns
    if multi_line is not None:
        return _records(spark, header.inputFiles(), names) if multi_line else _rows(spark, [path], names)
    broken = set(files_with_line_breaks_in_quotes(spark, path))
    if not broken:
        return _rows(spark, [path], names)
    # Both lists come from Spark, but not with the same number of slashes after the scheme.
    known = {_slashes(b) for b in broken}
    plain = [f for f in header.inputFiles() if _slashes(f) not in known]
    rows = _records(spark, sorted(broken), names)
    return rows.unionByName(_rows(spark, plain, names)) if plain else rows


def land_csv(spark: SparkSession, path: str, save: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``read_csv`` into ``save`` (which writes its frame and returns what is stored), in a single scan of clean files.

    The rows are written as if no record spanned lines, and the quotes are
    counted by the way. Only if that was wrong, or the files' first lines
    differ, they are read again the careful way, and ``save`` replaces the rows.
    """
    header = _input(spark, path, spark.read.options(**_DIALECT).csv)
    listed = header.inputFiles()
    first = spark.read.text(listed[:1]).first() if listed else None
    if first is None:
        return save(read_csv(spark, path))
    lines = _lines(spark, [path])
    is_head = (F.col("_block") == 0) & (_no_return("_line") == F.lit(_bare_line(first[0])))
    seen = Observation()
    odd, heads = F.max(_quotes("_line") % 2), F.count_if(is_head)
    counted = lines.observe(seen, odd.alias("odd"), heads.alias("heads"))
    stored = save(_parsed(counted.where(~is_head), header.columns))
    if seen.get.get("odd") == 0 and seen.get.get("heads") == len(listed):
        return stored
    return save(read_csv(spark, path))


def _slashes(file: str) -> str:
    return re.sub(":/+", ":/", file, count=1)


def _bare_line(line: str) -> str:
    return line.removeprefix("\ufeff").removesuffix("\r")


def _count(c: Column, character: str) -> Column:
    """How often an ASCII character stands in a text, from the bytes: their number needs no look at the text."""
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(character), F.lit("")))


def _quotes(column: str) -> Column:
    return _count(F.col(column), '"')


def _no_return(column: str) -> Column:
    """A line without the carriage return at its end; the pattern is only tried on lines that have one."""
    return F.when(F.col(column).contains("\r"), F.regexp_replace(column, r"\r$", "")).otherwise(F.col(column))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with their position, without the mark at the beginning of a file."""
    marked = (F.col("_metadata.file_block_start") == 0) & F.col("value").startswith("\ufeff")
    line = F.when(marked, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    return spark.read.text(paths, lineSep="\n").select(
        line.alias("_line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def _records(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    """Rows of files in which records may span lines, read in splits all the same.

    A line begins outside quotes if the quotes before it in the file are even.
    The quotes of each split (one small row) summed over the splits before it
    give its state at the beginning, running sums within the split that of its
    lines. Lines that begin and end outside quotes are records; only the others
    are put together, by the place where their record begins, which may be some
    splits earlier.
    """
    place = W.partitionBy("_file", "_block").orderBy("_row")
    up_to = place.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    lines = _lines(spark, paths).withColumn("_quotes", _quotes("_line"))
    splits = lines.groupBy("_file", "_block").agg(F.sum("_quotes").alias("_own"))
    states = splits.select("_file", "_block", F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_before"))
    placed = (
        lines.join(states, ["_file", "_block"])
        .withColumn("_after", (F.col("_before") + F.sum("_quotes").over(up_to)) % 2)
        .withColumn("_inside", (F.col("_after") + F.col("_quotes")) % 2)
        .withColumn("_head", (F.col("_block") == 0) & (F.row_number().over(place) == 1))
        .withColumn("_start", F.max(F.when(F.col("_inside") == 0, F.col("_row"))).over(up_to))
    )
    whole = placed.where((F.col("_inside") == 0) & (F.col("_after") == 0)).select("_file", "_block", "_row", "_head", "_line")

    # Lines before a split's first beginning of a record belong to the last one begun in an earlier split.
    begun = placed.groupBy("_file", "_block").agg(F.max("_start").alias("_last"))
    here = F.when(F.col("_last").isNotNull(), F.struct(F.col("_block").alias("block"), F.col("_last").alias("row")))
    open_at = begun.select("_file", "_block", F.last(here, ignorenulls=True).over(earlier).alias("_open"))
    broken = placed.where((F.col("_inside") != 0) | (F.col("_after") != 0)).join(open_at, ["_file", "_block"])
    begins = F.when(F.col("_start").isNotNull(), F.struct(F.col("_block").alias("block"), F.col("_start").alias("row")))
    parts = F.sort_array(F.collect_list(F.struct("_block", "_row", "_line")))
    joined = broken.groupBy("_file", F.coalesce(begins, F.col("_open")).alias("_begin")).agg(parts.alias("_parts"), F.max("_head").alias("_head"))
    text = F.array_join(F.transform("_parts", lambda p: p["_line"]), "\n")
    joined = joined.select("_file", F.col("_begin.block").alias("_block"), F.col("_begin.row").alias("_row"), "_head", text.alias("_line"))

    # Every file repeats the header; of another one its first record would be lost.
    expected = ",".join(names).replace('"', "").lower()
    own = F.lower(F.regexp_replace(F.regexp_replace("_line", '"', ""), r"\r$", ""))
    wrong = F.raise_error(F.concat(F.lit("header doesn't conform in "), F.col("_file")))
    head = F.when(F.col("_head") & (own != F.lit(expected)), wrong.cast("boolean")).otherwise(F.col("_head"))
    return _parsed(whole.unionByName(joined).where(~head), names)


def _schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def _too_many(record: Column, names: list[str]) -> Column:
    """Whether a record has more separators outside quotes than the header."""
    # A doubled quote reads as two neighbouring strings; nothing here recurses over a long text.
    outside = F.regexp_replace(record, r'"[^"]*"', "")
    commas, separators = (_count(x, ",") for x in (record, outside))
    return F.when(commas >= len(names), separators >= len(names)).otherwise(F.lit(False))


def _parsed(records: DataFrame, names: list[str]) -> DataFrame:
    """Records as text (``_line``) with their position, as rows; blank ones are none.

    As in ``_rows``, separators are only counted in records that the parser found
    to have more or fewer fields than the header.
    """
    line = _no_return("_line")
    given = {**_DIALECT, "multiLine": True, "columnNameOfCorruptRecord": _RAW}
    options = {k: str(value).lower() if isinstance(value, bool) else value for k, value in given.items()}
    fields = F.from_csv(line, _schema([*names, _RAW]).toDDL(), options)
    found = records.where(F.trim(line) != "").select(fields.alias("_fields"), *POSITION)
    overflow = F.coalesce(_too_many(F.col(f"_fields.{_RAW}"), names), F.lit(False)).alias(OVERFLOW)
    return found.select(*[na_to_null(F.col(f"_fields.`{c}`")).alias(c) for c in names], overflow, *POSITION)


def _rows(spark: SparkSession, paths: list[str], names: list[str]) -> DataFrame:
    schema = _schema([*names, _RAW])
    rows = spark.read.options(**_DIALECT, enforceSchema=False, columnNameOfCorruptRecord=_RAW).schema(schema).csv(paths)
    return rows.select(
        *[na_to_null(F.col(f"`{c}`")).alias(c) for c in names],
        F.coalesce(_too_many(F.col(_RAW), names), F.lit(False)).alias(OVERFLOW),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Header, UTF-8, text quoted where needed.

    Rows of a sorted frame stay in order over all part files. ``single_file``
    is for small dimensions only.
    """
    if single_file:
        df = df.coalesce(1)
    times = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx") for c in times}).write.mode(
        "overwrite"
    ).options(**_DIALECT).csv(path)
    return path


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Rows of a SQL text over named tables (``{orders}`` in the text)."""
    return spark.sql(sql, **tables)
