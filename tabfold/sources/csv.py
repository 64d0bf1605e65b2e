"""Labelled CSV load (name cleaning, NA tokens, null-target drop) and CSV sink.

Quoted fields may hold line breaks, and still a file is read by many tasks:
its byte ranges are read as lines, each range's quotation marks are counted,
and the parity of those before a range tells whether it begins inside a
quoted field.  So every range knows where its first record starts, and cuts
its own lines into records; only the two ends of a range, whose record goes on
elsewhere, are put together afterwards.  Records are then parsed by Spark.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabfold.functions.columns import clean_name, sanitize_columns
from tabfold.sources.tables import nan_to_null

# fixed values: text tokens read as missing
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _na_to_null(df: DataFrame) -> DataFrame:
    strs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strs:
        return df
    return df.withColumns({c: F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)) for c in strs})


def _retype(df: DataFrame) -> DataFrame:
    """String columns that hold only numbers once NA tokens are gone become numeric."""
    strs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strs:
        return df
    probe = df.agg(*[F.bool_and(F.col(c).isNull() | F.col(c).try_cast("double").isNotNull()).alias(c)
                     for c in strs], *[F.bool_and(F.col(c).isNull() | F.col(c).try_cast("bigint").isNotNull())
                                       .alias(f"{c}__i") for c in strs]).first()
    casts = {}
    for c in strs:
        if probe[f"{c}__i"]:
            casts[c] = F.col(c).try_cast("bigint")
        elif probe[c]:
            casts[c] = F.col(c).try_cast("double")
    return df.withColumns(casts) if casts else df


def _ranges_open(lines: DataFrame) -> DataFrame:
    """(file, range, open): whether a byte range begins inside a quoted field.  A row for each range."""
    counts = lines.groupBy("file", "range").agg(F.sum("marks").alias("marks"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(F.col("file").alias("_file"), F.col("range").alias("_range"),
                         (F.coalesce(F.sum("marks").over(before), F.lit(0)) % 2 == 1).alias("open"))


def _record_cutter():
    """A function for the tasks, sent with its code: lines of byte ranges, in order, to records."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """``part``: the record goes on in another range, ``first``: it starts in this one."""
        at, n, inside, held, first, out = None, 0, False, [], True, []

        def close(whole: bool) -> None:
            nonlocal n, held, first
            if held:
                out.append((*at, n, "\n".join(held), not (whole and first), first))
                n += 1
            held, first = [], True
        for batch in batches:
            for file, start, is_open, line, marks in zip(batch["file"], batch["range"], batch["open"], batch["line"], batch["marks"], strict=True):
                if (file, start) != at:
                    close(not inside)
                    at, n, inside, first = (file, start), 0, bool(is_open), not is_open
                held.append(line)
                inside ^= bool(marks & 1)
                if not inside:
                    close(True)
            yield pd.DataFrame(out, columns=["file", "range", "n", "record", "part", "first"])
            out = []
        close(not inside)
        yield pd.DataFrame(out, columns=["file", "range", "n", "record", "part", "first"])
    return cut


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, head) of CSV files: a row for each record, which may hold line breaks; ``head``: the first of its file.

    Blank lines between records are left out.  A file is read by as many tasks
    as it has splits; nothing but the ends of splits is shuffled.
    """
    line = F.col("value")
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(line.alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
                     (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))).cast("long").alias("marks")))
    ranges = _ranges_open(lines).persist()
    split = ranges.where("open").limit(1).count() > 0
    # a row for each split of the input; the lines keep their order
    told = lines.join(F.broadcast(ranges), (F.col("file") == F.col("_file")) & (F.col("range") == F.col("_range")))
    cut = told.select("file", "range", "open", "line", "marks").mapInPandas(
        _record_cutter(), "file string, range long, n long, record string, part boolean, first boolean")
    cut = cut.withColumn("head", (F.col("range") == 0) & (F.col("n") == 0))
    whole = cut.where(~F.col("part")).select("record", "head")
    if split:                # only then a record may lie in two ranges, and the ends of ranges are looked for
        begun = F.sum(F.col("first").cast("int")).over(Window.partitionBy("file").orderBy("range", "n"))
        joined = (cut.where("part").withColumn("of", begun).groupBy("file", "of")
                  .agg(F.array_sort(F.collect_list(F.struct("range", "n", "record"))).alias("parts"), F.bool_or("head").alias("head"))
                  .select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"), "head"))
        whole = whole.unionByName(joined)
    else:
        whole = cut.select("record", "head")       # an open end of a file is a record, too
    return (whole.withColumn("record", F.regexp_replace("record", "\\r\\z", ""))
            .where((F.trim("record") != "") | F.col("head")))


def _header(records: DataFrame) -> list[str] | None:
    """Column names, from the first record of one file."""
    first = records.where("head").select(F.min("record")).first()[0]
    if first is None:
        return None
    names = next(csv.reader(io.StringIO(first.lstrip("\ufeff"), newline=""), strict=False), [])
    return [name if name else f"_c{i}" for i, name in enumerate(names)]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True,
             corrupt: str | None = None) -> DataFrame:
    """CSV with header; NA tokens -> null, NaN -> null.  With no schema, types are inferred
    by one more pass over the text columns.

    Quotes within a quoted field are doubled.  ``multi_line`` lets quoted
    fields hold line breaks (``csv_records``); without it, lines are records
    and are read by Spark's own reader.  With a schema, ``corrupt`` names a
    column that keeps the text of rows which do not fit it (others have null
    there).
    """
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType(), True)]) if schema is not None and corrupt else schema
    if not multi_line:
        r = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"'))
        if corrupt:
            r = r.option("columnNameOfCorruptRecord", corrupt)
        df = r.schema(full).csv(path) if full is not None else _retype(_na_to_null(r.option("inferSchema", False).csv(path)))
        return nan_to_null(_na_to_null(df))
    records = csv_records(spark, path)
    if full is None:
        names = _header(records)
        full = T.StructType([T.StructField(n, T.StringType(), True) for n in names or []])
    if not full.fields:
        return spark.createDataFrame([], full)
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    # parsed under names that need no quoting, and named afterwards
    plain = T.StructType([T.StructField(f.name if f.name == corrupt else f"c{i}", f.dataType, True) for i, f in enumerate(full.fields)])
    parsed = records.where(~F.col("head")).select(F.from_csv("record", plain.simpleString()[7:-1].replace(":", " "), options).alias("_r"))
    df = parsed.select(*[F.col("_r").getField(p.name).alias(f.name) for p, f in zip(plain.fields, full.fields, strict=True)])
    return nan_to_null(_na_to_null(df if schema is not None else _retype(_na_to_null(df))))


def load_labelled(spark: SparkSession, path: str, target: str, key: str | None = None,
                  drop_before_rename: bool = False, schema: T.StructType | None = None,
                  multi_line: bool = True) -> DataFrame:
    """Load, clean names, drop rows whose target is null.

    The target is looked up after cleaning (``drop_before_rename=False``) or by
    its raw name before cleaning (``True``).  The key column, if given, stays.
    """
    df = read_csv(spark, path, schema, multi_line)
    if drop_before_rename:
        df = df.dropna(subset=[target])
        df = sanitize_columns(df)
    else:
        df = sanitize_columns(df)
        df = df.dropna(subset=[clean_name(target)])
    if key is not None and clean_name(key) not in df.columns:
        raise KeyError(key)
    return df


def load_unlabelled(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True,
                    corrupt: str | None = None) -> DataFrame:
    """Scoring input: same reader and name cleaning, no target; ``corrupt`` keeps rows that do not fit the schema, with their text."""
    return sanitize_columns(read_csv(spark, path, schema, multi_line, corrupt))


def write_csv(df: DataFrame, path: str, cols: Sequence[str] | None = None, single_file: bool = False, quote_all: bool = False) -> None:
    """Selected columns, header, no index; values keep their white space.  ``single_file`` only for small outputs.

    ``quote_all``: every value in quotation marks, so carriage returns at the end of a value are kept, too.
    """
    out = df.select(*cols) if cols else df
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", quote_all)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
