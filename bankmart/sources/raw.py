"""The raw zone: a folder tree of CSV and text files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmart.functions import dates, numbers, text
from bankmart.operators.dedup import SOURCE_ORDER
from bankmart.schemas import BASE_TABLES

RAW_FILES = "*.{csv,txt}"

# What to do with files of one name in several folders.
STOP, LAST_WINS, ALL = "stop", "last", "all"

# What else to do with rows that do not fit their header, and the column that marks rejected ones.
KEEP, REJECT = "keep", "reject"
REJECTED = "_rejected"
_TEXT = "_text"

# More bytes than a file has: what a task may read at most, and what opening a file counts as.
_ONE_FILE = 1 << 40
_GLOB_SIGNS = re.compile(r"[\\*?\[\]{}]")


class SameName(Exception):
    """Raised for files of one name when the caller did not say what they mean."""


def raw_files(spark: SparkSession, root: str, same_name: str = STOP) -> DataFrame:
    """Name, path and size of every raw file under ``root``.

    Files of one name in different folders stop the job, unless the caller says
    that the last path wins or that all of them count. Contents are not read.
    Raises when there is no file at all.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", RAW_FILES)
        .load(root)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", "length")
    )
    if files.isEmpty():
        raise FileNotFoundError(f"no {RAW_FILES} files under {root}")
    if same_name == LAST_WINS:
        return files.groupBy("file_name").agg(F.max("path").alias("path"), F.max_by("length", "path").alias("length"))
    if same_name == STOP:
        repeated = files.groupBy("file_name").count().filter("count > 1").orderBy("file_name").first()
        if repeated is not None:
            raise SameName(f"{repeated['count']} files under {root} are named {repeated['file_name']}")
    return files


def read_raw_table(
    spark: SparkSession, root: str, names: str | Sequence[str], same_name: str = STOP, **options: object
) -> DataFrame:
    """Read a table of one or more raw files, wherever under ``root`` they lie.

    A name with a slash is a folder under ``root``, all of whose files count; any
    other is a file name. Files are named to Spark by folder and pattern, so their
    list stays with Spark's own reader, however many there are.
    """
    names = [names] if isinstance(names, str) else list(names)
    places: list[tuple[str, str | None]] = []
    for name in names:
        if "/" in name:
            places.append((f"{root.rstrip('/')}/{name.strip('/')}", RAW_FILES))
            continue
        # Only the names asked for have to be one file each.
        found = raw_files(spark, root, ALL).filter(F.col("file_name") == name)
        own = found.agg(F.count(F.lit(1)).alias("files"), F.max("path").alias("last")).first()
        if not own["files"]:
            raise FileNotFoundError(f"no raw file named {name} under {root}")
        if own["files"] > 1 and same_name == STOP:
            raise SameName(f"{own['files']} files under {root} are named {name}")
        one = own["files"] == 1 or same_name == LAST_WINS
        places.append((_literal(own["last"]), None) if one else (root, _literal(name)))
    frames = [read_csv(spark, path, glob=glob, **options) for path, glob in places]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_lines(spark: SparkSession, paths: Sequence[str], glob: str | None = None) -> DataFrame:
    """``path`` and ``header``, its first line that is not blank, of every file behind paths and folders.

    One job, in which each file is a task that looks at its lines up to that one; Spark still reads
    the file on to its end. Spark has no limit by file among its expressions, so the tasks iterate
    over batches of their rows themselves.
    """

    def first(batches):
        for batch in batches:
            for i, line in enumerate(batch.column("header").to_pylist()):
                if line.strip("\ufeff \t"):
                    yield batch.slice(i, 1)
                    return

    # A session of its own, whose files are neither split nor put together.
    whole = spark.newSession()
    for setting in ("maxPartitionBytes", "openCostInBytes"):
        whole.conf.set(f"spark.sql.files.{setting}", _ONE_FILE)
    text = whole.read.text(list(paths), recursiveFileLookup=True, **_only(glob))
    starts = text.where("_metadata.file_block_start = 0").select("_metadata.file_path", F.col("value").alias("header"))
    # The path is given as a URI, decoded once a file.
    path = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))
    return starts.mapInArrow(first, "file_path string, header string").select(path.alias("path"), "header")


def _literal(path: str) -> str:
    """A path or name that no sign of which is read as a pattern."""
    return _GLOB_SIGNS.sub(r"\\\g<0>", path)


def _only(glob: str | None) -> dict[str, str]:
    return {"pathGlobFilter": glob} if glob else {}


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    multi_line: bool = False,
    malformed: str = STOP,
    glob: str | None = None,
) -> DataFrame:
    """Headed CSV files or folders as text columns plus the position of each row.

    Every file's own header names its columns: files whose headers differ are
    read by header and put together by name, and columns that one lacks are null
    there. ``glob`` chooses among the files of folders. Jobs are one for all
    headers and one for each different one, whatever the number of files.

    A row with more or fewer fields than its header stops the job.
    ``malformed="keep"`` fills up short rows and cuts long ones; ``"reject"``
    returns them beside the others, marked in the column ``REJECTED`` by their
    text and the reason (see ``split_rejected``).

    Missing-value markers become null. Types are applied later by name
    (``typed``), so nothing is inferred and the data is read once. Quotes inside
    quoted fields are doubled. ``multi_line`` allows line breaks inside quoted
    fields but stops Spark from splitting large files, so it is off by default.

    The position is (file, block, row number within the task): a block is read by
    one task from top to bottom, so positions sort in file order.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = first_lines(spark, paths, glob)
    found = lines.groupBy("header").agg(F.min("path").alias("example")).orderBy("header").collect()
    if not found:
        raise FileNotFoundError(f"no file with a header in {paths}")
    columns = {
        r["header"]: tuple(spark.read.csv(_literal(r["example"]), header=True, escape='"', multiLine=multi_line).columns) for r in found
    }
    if len(set(columns.values())) == 1:
        return _read_alike(spark, paths, columns[found[0]["header"]], multi_line, malformed, glob)
    # The files of each header are listed to Spark's reader, which holds such a list itself.
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in lines.orderBy("path").collect():
        groups.setdefault(columns[row["header"]], []).append(_literal(row["path"]))
    frames = [_read_alike(spark, files, names, multi_line, malformed) for names, files in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _read_alike(
    spark: SparkSession, paths: list[str], columns: Sequence[str], multi_line: bool, malformed: str, glob: str | None = None
) -> DataFrame:
    """Files of one header."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    if malformed == REJECT:
        schema.add(_TEXT, T.StringType())
    # Without column pruning a row is seen whole, so that its fields can be counted.
    reader = spark.read.schema(schema).option("columnPruning", malformed == KEEP)
    frame = reader.csv(
        paths, header=True, escape='"', multiLine=multi_line, enforceSchema=False, recursiveFileLookup=True,
        mode="FAILFAST" if malformed == STOP else "PERMISSIVE", columnNameOfCorruptRecord=_TEXT, **_only(glob),
    )
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(SOURCE_ORDER)
    values = [text.null_if_marker(F.col(f"`{c}`")).alias(c) for c in columns]
    if malformed != REJECT:
        return frame.select(*values, position)
    return frame.select(*values, position, _rejection(F.col(_TEXT), columns).alias(REJECTED))


def _rejection(line: Column, columns: Sequence[str]) -> Column:
    """Text and reason of a row that does not fit, null for one that does."""
    # Spark refuses to read the text of such rows without any of their columns, so one is named.
    line_or_field = F.coalesce(line, F.col(f"`{columns[0]}`"))
    unquoted = F.regexp_replace(line_or_field, '"([^"]|"")*"', "")
    own = F.size(F.split(unquoted, ",")).cast("string")
    reason = F.when(F.contains(unquoted, F.lit('"')), "quote without end").otherwise(F.concat(own, F.lit(f" fields instead of {len(columns)}")))
    return F.when(line.isNotNull(), F.struct(line_or_field.alias("text"), reason.alias("reason")))


def split_rejected(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that fit their header, and ``file``, ``block``, ``row``, ``text`` and ``reason`` of the others."""
    rejected = df.where(F.col(REJECTED).isNotNull()).select(f"{SOURCE_ORDER}.*", f"{REJECTED}.*")
    return df.where(F.col(REJECTED).isNull()).drop(REJECTED), rejected


def typed(
    df: DataFrame,
    table: str,
    date_format: str | None = None,
    keep: Sequence[str] = (SOURCE_ORDER,),
    observation: Observation | None = None,
) -> DataFrame:
    """Text columns to the types of a base table; unreadable values become null.

    Columns are picked by name without regard to case, as in the base tables.
    Columns to ``keep`` follow unchanged, if present: by default the source
    position, for the deduplication that comes next. An ``observation`` gets, by
    column, the number of values that were there but could not be read.
    """
    converters = {
        "bigint": numbers.key,
        "double": numbers.amount,
        "timestamp_ntz": lambda value: dates.event_time(value, date_format),
        "string": lambda value: value,
    }
    converted = {
        field.name: converters[field.dataType.simpleString()](F.col(field.name)) for field in BASE_TABLES[table].fields
    }
    if observation is not None:
        lost = {name: F.count_if(F.col(name).isNotNull() & value.isNull()) for name, value in converted.items()}
        df = df.observe(observation, *[count.alias(name) for name, count in lost.items()])
    columns = [value.alias(name) for name, value in converted.items()]
    return df.select(*columns, *[c for c in df.columns if c in keep])
