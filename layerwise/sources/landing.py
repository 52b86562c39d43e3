"""Landing CSV files: inventory, delimiter detection and reading."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwise.functions.names import decode_file_name, parse_source_name, slugify
from layerwise.operators.incremental import latest_file_per_group
from layerwise.operators.schema import quoted
from layerwise.session import local_frame, scratch_path
from layerwise.sources.records import read_records

DELIMITERS = (",", ";", "\t", "|", ":")
SAMPLE_LINES = 5
# Lines looked at to find the sample's records, which may span lines.
HEAD_LINES = 40
# Files that are read whole to see their first lines, and scans of larger ones in one job.
SMALL_FILE = 1 << 20
SCANS = 64
UTF8 = "UTF-8"
# Texts a CSV field may hold for "no value".
NA_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# Separator of files with one column: a character that no text line holds.
ONE_COLUMN = "\x01"
# Position of a row in its source: a total order that survives any shuffle.
POSITION = ("src_file", "src_block", "src_row")


# A packed position: digits of the file's code, of its block and of its row.
_DIGITS = (6, 15, 17)


def with_packed_position(rows: DataFrame, name: str = "src_position", most_files: int = 100_000) -> tuple[DataFrame, list[str]]:
    """Rows with their position as one number of fixed width, and the columns to order by.

    An aggregate keeps such a number in its hash table's buffer, where a text would make it sort its
    input. Files get codes in the order of their names, which the driver lists as it lists the files;
    with more than ``most_files`` of them the rows stay as they are and the order is ``POSITION``.
    """
    files = rows.select("src_file").distinct().limit(most_files + 1).toArrow()
    found = sorted(files.column(0).to_pylist())
    if len(found) > most_files:
        return rows, list(POSITION)
    codes = local_frame(rows.sparkSession, list(zip(found, range(len(found)))), "__file string, __code int")
    parts = zip(("__code", "src_block", "src_row"), _DIGITS, (sum(_DIGITS[1:]), _DIGITS[2], 0))
    packed = [F.col(part).cast(f"decimal({digits},0)").cast("decimal(38,0)") * Decimal(10**shift) for part, digits, shift in parts]
    joined = rows.join(F.broadcast(codes), F.col("src_file") == F.col("__file"), "left")
    position = reduce(Column.__add__, packed).cast("decimal(38,0)")
    return joined.withColumn(name, position).drop("__file", "__code"), [name]


def csv_glob(date: str | None = None) -> str:
    return f"*_{date}.[cC][sS][vV]" if date else "*.[cC][sS][vV]"


def file_inventory(
    spark: SparkSession, path: str | Sequence[str], glob: str = "*"
) -> DataFrame:
    """Name, size and time of each file below a path. File contents are not read.

    A scan yields no row for an empty file, so those are added from the scan's own file list,
    with size 0 and no time.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    found = files.select(
        "path",
        F.col("_metadata.file_path").alias("file_path"),
        decode_file_name(F.col("_metadata.file_name")).alias("file_name"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"),
    )
    listed = local_frame(spark, [(name,) for name in files.inputFiles()], "path string")
    name = decode_file_name(F.element_at(F.split("path", "/"), -1))
    empty = listed.withColumn("file_name", name).join(found, "file_name", "left_anti")
    return found.unionByName(
        empty.select(
            "path",
            F.col("path").alias("file_path"),
            "file_name",
            F.lit(0).cast("bigint").alias("file_size"),
            F.lit(None).cast("timestamp").alias("modified_at"),
        )
    )


def head_lines(spark: SparkSession, files: Sequence[tuple[str, int]], n: int = HEAD_LINES) -> DataFrame:
    """(file_path, __block, __line_id, value) of the first ``n`` lines of files, given by path and
    size, without reading on; ``__block`` and then ``__line_id`` order a file's lines.

    Files of up to ``SMALL_FILE`` bytes are read in one scan. Each larger one is a scan of its own
    that stops at its limit, many of them in one job, so what is read follows the number of files
    and not their size. The settings that keep a file in one piece are those of a session of its
    own; where they do not hold, its lines are taken from the split that starts the file, and the
    others are passed over. The lines come back as a small table in the shared folder.
    """
    apart = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        apart.conf.set(key, str(1 << 40))
    place = scratch_path(spark, "heads")

    def keep(lines: DataFrame) -> None:
        lines.select("file_path", "__block", "__line_id", "value").write.mode("append").parquet(place)

    def scan(session: SparkSession, paths: Sequence[str]) -> DataFrame:
        # Numbered within the split as it is read: a limit's shuffle keeps no order.
        return session.read.text(list(paths)).select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("__block"),
            F.monotonically_increasing_id().alias("__line_id"),
            "value",
        )

    small = [path for path, size in files if 0 < size <= SMALL_FILE]
    large = [path for path, size in files if size > SMALL_FILE]
    for at in range(0, len(large), SCANS):
        heads = [scan(apart, [path]).where(F.col("__block") == 0).limit(n) for path in large[at : at + SCANS]]
        keep(reduce(DataFrame.unionByName, heads))
    if small or not large:
        none = "file_path string, __block bigint, __line_id bigint, value string"
        keep(scan(spark, small) if small else local_frame(spark, [], none))
    return spark.read.schema("file_path string, __block bigint, __line_id bigint, value string").parquet(place)


# A quote opens a field at a line's start or after a delimiter, and closes it before one.
_COMPLETE = r'(^|[,;\t|:\x01])"[^"]*+(?:""[^"]*+)*+"(?!")'
_OPEN = r'(^|[,;\t|:\x01])"'


def leaves_open(line: Column) -> Column:
    """Whether a line that starts outside of quotes ends within a quoted field."""
    rest = F.regexp_replace(line, _COMPLETE, "$1")
    return F.when(F.contains(line, F.lit('"')), F.regexp_like(rest, F.lit(_OPEN))).otherwise(False)


def sample_records(samples: DataFrame, n: int = SAMPLE_LINES) -> DataFrame:
    """Line samples as samples of the first ``n`` records: lines are joined while a quote is open,
    and blank lines before the first record go."""
    begun = F.filter("sample", lambda line, i: F.exists(F.slice("sample", F.lit(1), i + 1), lambda l: F.trim(l) != ""))
    joined = F.aggregate(
        begun,
        F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open")),
        lambda acc, line: _with_line(acc, F.concat_ws("\n", acc["open"], line)),
        lambda acc: F.concat(acc["done"], F.array_compact(F.array(acc["open"]))),
    )
    return samples.withColumn("sample", F.slice(joined, 1, n))


def _with_line(acc: Column, text: Column) -> Column:
    goes_on = leaves_open(text)
    done = F.when(goes_on, acc["done"]).otherwise(F.concat(acc["done"], F.array(text)))
    return F.struct(done.alias("done"), F.when(goes_on, text).alias("open"))


def first_lines(lines: DataFrame, file: str, order: Sequence[str], n: int = SAMPLE_LINES) -> DataFrame:
    """(file, sample array) of each file's first lines; map tasks pass on at most ``n`` per file."""
    rank = F.row_number().over(Window.partitionBy(file).orderBy(*order))
    kept = lines.withColumn("__rank", rank).filter(F.col("__rank") <= n)
    pairs = F.sort_array(F.collect_list(F.struct("__rank", "value")))
    return kept.groupBy(file).agg(pairs["value"].alias("sample"))


def sniff(samples: DataFrame, delimiters: Sequence[str] = DELIMITERS) -> DataFrame:
    """Add valid, delimiter, n_columns, sample_rows, has_header and header to line samples.

    The delimiter is the candidate found equally often in most sample lines, outside of
    quotes; ties go to the more frequent, then to the earlier candidate. A file without any
    candidate in its first line has one column and no delimiter. A file without a line that is not
    blank is not valid.
    """
    candidates = F.array(
        *[
            F.struct(F.lit(-rank).alias("rank"), F.lit(d).alias("delimiter"))
            for rank, d in enumerate(delimiters)
        ]
    )
    plain = F.transform("sample", lambda line: F.regexp_replace(line, '"[^"]*"', "x"))
    counted = F.transform(
        candidates,
        lambda c: F.struct(
            c["rank"].alias("rank"),
            c["delimiter"].alias("delimiter"),
            F.transform(
                "__plain",
                lambda line: F.length(line)
                - F.length(F.replace(line, c["delimiter"], F.lit(""))),
            ).alias("counts"),
        ),
    )
    scores = F.transform(
        F.filter("__counted", lambda c: F.get(c["counts"], F.lit(0)) > 0),
        lambda c: F.struct(
            F.size(
                F.filter(c["counts"], lambda n: n == F.get(c["counts"], F.lit(0)))
            ).alias("agree"),
            F.get(c["counts"], F.lit(0)).alias("n"),
            c["rank"].alias("rank"),
            c["delimiter"].alias("delimiter"),
        ),
    )
    pattern = F.concat(F.lit(r"\Q"), F.col("__best.delimiter"), F.lit(r"\E"))
    fields = F.transform("__plain", lambda line: F.split(line, pattern))
    scored = (
        samples.withColumn("__plain", plain)
        .withColumn("__counted", counted)
        .withColumn("__best", F.array_max(scores))
        .withColumn("__fields", fields)
    )
    return scored.select(
        *samples.columns,
        _is_text(F.get("sample", F.lit(0))).alias("valid"),
        F.col("__best.delimiter").alias("delimiter"),
        F.when(_is_text(F.get("sample", F.lit(0))), F.coalesce(F.col("__best.n"), F.lit(0)) + 1)
        .cast("bigint")
        .alias("n_columns"),
        F.greatest(F.size("sample") - 1, F.lit(0)).cast("bigint").alias("sample_rows"),
        F.coalesce(_header_votes() > 0, F.lit(False)).alias("has_header"),
        F.get("sample", F.lit(0)).alias("header"),
    )


def _is_text(line: Column) -> Column:
    return F.coalesce(F.trim(line) != "", F.lit(False))


def line_flags(lines: DataFrame, file: str) -> DataFrame:
    """(file, multi_line, utf8): whether a line of the file leaves a quoted field open, so that a
    record may go on in the next one, and whether all of its bytes are UTF-8."""
    return lines.groupBy(file).agg(
        F.bool_or(leaves_open(F.col("value"))).alias("multi_line"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
    )


def _header_votes() -> Column:
    """Columns whose first line looks unlike the lines below, less those where it looks alike.

    A column of numbers votes by whether its first line is one; a column of equally long
    texts by whether its first line has that length; other columns do not vote.
    """
    rows = F.slice("__fields", F.lit(2), F.greatest(F.size("__fields") - 1, F.lit(0)))

    def number(text: Column) -> Column:
        return text.try_cast("double").isNotNull()

    def vote(i: Column) -> Column:
        head = F.get(F.get("__fields", F.lit(0)), i)
        below = F.transform(rows, lambda fields: F.coalesce(F.get(fields, i), F.lit("")))
        lengths = F.array_distinct(F.transform(below, lambda text: F.length(text)))
        alike = (
            F.when(F.forall(below, number), number(head))
            .when(F.size(lengths) == 1, F.length(head) == F.get(lengths, F.lit(0)))
        )
        return F.when(alike, -1).when(~alike, 1).otherwise(0)

    positions = F.sequence(F.lit(0), F.size(F.get("__fields", F.lit(0))) - 1)
    total = F.aggregate(F.transform(positions, vote), F.lit(0), lambda a, b: a + b)
    return F.when((F.size("__fields") > 1), total)


def landing_catalog(
    spark: SparkSession,
    path: str | Sequence[str],
    expected: Sequence[str],
    date: str | None = None,
    fallback_encoding: str | None = None,
) -> DataFrame:
    """One row per landing file to process: name parts, CSV format and whether it is expected.

    Names that do not parse are left out, and of files for the same brand, table and date only
    the last delivered is kept. A date narrows the listing itself. Formats are found in the first
    lines of each file, and no more of it is read for them. One pass over the lines tells the files
    whose records may span lines (``multi_line``) and those that are not UTF-8: these have the
    ``fallback_encoding`` if there is one, and are not valid otherwise.
    """
    glob = csv_glob(date)
    files = file_inventory(spark, path, glob).withColumn("__name", parse_source_name(F.col("file_name")))
    files = files.select(
        "path",
        "file_path",
        "file_name",
        "file_size",
        "modified_at",
        F.col("__name.brand").alias("brand"),
        F.col("__name.table").alias("table_name"),
        F.col("__name.filedate").alias("filedate"),
    ).filter((F.col("brand") != "") & (F.col("table_name") != "") & (F.col("filedate") != ""))
    files = latest_file_per_group(
        files, ["brand", "table_name", "filedate"], ["modified_at", "file_name"]
    )
    listed = [(row.path, row.file_size) for row in files.select("path", "file_size").collect()]
    heads = first_lines(head_lines(spark, listed), "file_path", ["__block", "__line_id"], HEAD_LINES)
    formats = sniff(sample_records(heads)).drop("sample")
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    flags = line_flags(lines.select("value", F.col("_metadata.file_path").alias("file_path")), "file_path")
    utf8 = F.coalesce("utf8", F.lit(True))
    encoding = F.when(utf8, F.lit(UTF8)).otherwise(F.lit(fallback_encoding))
    return (
        files.join(formats, "file_path", "left")
        .join(flags, "file_path", "left")
        .withColumn("encoding", encoding)
        .withColumn("valid", F.coalesce("valid", F.lit(False)) & F.col("encoding").isNotNull())
        .withColumn("multi_line", F.coalesce("multi_line", F.lit(False)))
        .withColumn("brand_slug", slugify(F.col("brand")))
        .withColumn("expected", F.col("table_name").isin(list(expected)))
        .drop("utf8")
    )


def header_names(header: str, delimiter: str | None) -> list[str]:
    """Column names of a header line; a name repeated in any case gets a number."""
    names: list[str] = []
    for position, name in enumerate(next(csv.reader([header], delimiter=delimiter or ONE_COLUMN))):
        base = name.strip().lstrip("\ufeff") or f"Unnamed: {position}"
        unique, n = base, 0
        while unique.lower() in {known.lower() for known in names}:
            n += 1
            unique = f"{base}.{n}"
        names.append(unique)
    return names


def read_landing(
    spark: SparkSession,
    paths: Sequence[str],
    delimiter: str | None,
    header: str | None = None,
    infer: bool = False,
    multi_line: bool = False,
    na_texts: Sequence[str] = NA_TEXTS,
    reject_column: str | None = None,
    encoding: str = UTF8,
) -> DataFrame:
    """Rows of CSV files that share a delimiter, header and encoding, with source and position columns.

    All columns are text unless ``infer`` asks for a second pass to find types. Large files
    are read in splits, with ``multi_line`` too (``records.read_records``), but for ``infer`` with
    it; without a delimiter a line is one field.
    Records with more or fewer fields than the header carry their text in ``reject_column``, and
    stop the job where none is named.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", delimiter or ONE_COLUMN)
        .option("columnPruning", False)  # a record's fields are counted whatever is read of it
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("encoding", encoding)
        .option("inferSchema", infer)
    )
    if not infer:
        if header is None:
            raise ValueError("reading without type inference needs the header line")
        names = header_names(header, delimiter)
        if reject_column:
            names.append(reject_column)
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", reject_column)
        else:
            reader = reader.option("mode", "FAILFAST")
        if multi_line:
            return _from_records(spark, paths, delimiter, names, na_texts, reject_column, encoding)
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    frame = reader.csv(list(paths))
    columns = []
    for item in frame.schema.fields:
        text = isinstance(item.dataType, T.StringType) and item.name != reject_column
        columns.append(_field(quoted(item.name), item.name, na_texts if text else ()))
    return frame.select(
        *columns,
        decode_file_name(F.col("_metadata.file_name")).alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_row"),
    )


def _field(value: Column, name: str, na_texts: Sequence[str]) -> Column:
    return (F.when(~value.isin(list(na_texts)), value) if na_texts else value).alias(name)


def _from_records(
    spark: SparkSession,
    paths: Sequence[str],
    delimiter: str | None,
    names: Sequence[str],
    na_texts: Sequence[str],
    reject_column: str | None,
    encoding: str,
) -> DataFrame:
    """Rows of files whose records may span lines: records are cut split by split, then parsed one
    by one. The first record of a file is its header."""
    separator = delimiter or ONE_COLUMN
    records = read_records(spark, paths, separator, encoding)
    schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in names)
    options = {"sep": separator, "escape": '"', "mode": "PERMISSIVE" if reject_column else "FAILFAST"}
    if reject_column:
        options["columnNameOfCorruptRecord"] = reject_column
    parsed = records.where("NOT first").withColumn("row", F.from_csv("record", schema, options))
    columns = [_field(F.col("row")[name], name, () if name == reject_column else na_texts) for name in names]
    return parsed.select(*columns, *POSITION)


def raw_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of files as they are, with their source and position."""
    return spark.read.text(list(paths)).select(
        "value",
        decode_file_name(F.col("_metadata.file_name")).alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_row"),
    )
