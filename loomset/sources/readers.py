"""Sources of instruction data and of the version registry."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.operators.registry import REGISTERED, REGISTRY_COLUMNS, REGISTRY_SCHEMA
from loomset.session import drop_path, materialize, write_scratch
from loomset.sources import blocks

CORRUPT = "_corrupt_record"
_MARK = 7_203_685_477_580_911  # a number that no text is expected to end with

# Cells that CSV readers of the pandas family take as missing.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _files(spark: SparkSession, path: str) -> list:
    """The file itself, or the data files of a folder."""
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        raise FileNotFoundError(f"nothing to read at {path}")
    if fs.getFileStatus(hadoop_path).isFile():
        return [hadoop_path]
    inside = [s.getPath() for s in fs.listStatus(hadoop_path) if s.isFile()]
    return [p for p in inside if not p.getName().startswith(("_", "."))]


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> list[tuple[int, str]]:
    """(number, path) of the finished folders named ``prefix`` and a number, ascending."""
    hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    inside = [s.getPath() for s in fs.listStatus(hadoop_path) if s.isDirectory() and s.getPath().getName().startswith(prefix)]
    return sorted((int(p.getName()[len(prefix) :]), p.toString()) for p in inside if fs.exists(done(p, "_SUCCESS")))


def with_row_id(df: DataFrame) -> DataFrame:
    """Adds ``row_id`` in scan order, for inputs without an id.

    Spark numbers rows by partition, so ids are unique and ascending but have gaps. They are the
    same again only for the same files and split size.
    """
    return df if "row_id" in df.columns else df.withColumn("row_id", F.monotonically_increasing_id())


def _fields(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _marked(fields: T.StructType) -> T.StructType:
    return T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])


def _parsed(text: Column, fields: T.StructType) -> Column:
    """One object; a broken one, or one with a value of another type, fills ``CORRUPT``."""
    return F.from_json(text, _marked(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _refused(what: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{what} in "), "__file"))


_QUOTE, _ESCAPE, _OPEN, _CLOSE = 1, 2, 3, 4
_SPECIAL = np.zeros(256, np.uint8)
_SPECIAL[list(b'"\\[{]')] = [_QUOTE, _ESCAPE, _OPEN, _OPEN, _CLOSE]


def _unescaped(at: np.ndarray, kind: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Which special bytes do not follow an odd number of backslashes of their piece; backslashes are none."""
    slashes = kind == _ESCAPE
    if not slashes.any():
        return ~slashes
    joined = np.zeros(len(at), bool)  # goes on a row of backslashes
    joined[1:] = slashes[1:] & slashes[:-1] & (at[1:] == at[:-1] + 1) & (piece[1:] == piece[:-1])
    place = np.arange(len(at))
    row = place - np.maximum.accumulate(np.where(joined, 0, place)) + 1
    escaped = np.zeros(len(at), bool)
    escaped[1:] = slashes[:-1] & (row[:-1] % 2 == 1) & (at[1:] == at[:-1] + 1) & (piece[1:] == piece[:-1])
    return ~slashes & ~escaped


def _piece_effects(texts: pa.Array) -> list[np.ndarray]:
    """end0, end1, add0 and add1 of every piece, from its bytes."""
    data = texts.cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    body = data.buffers()[2]
    held = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body else np.empty(0, np.uint8)
    kind = _SPECIAL[held]
    at = np.flatnonzero(kind)
    kind = kind[at]
    piece = np.searchsorted(offsets - offsets[0], at, side="right") - 1
    plain = _unescaped(at, kind, piece)
    kind, piece = kind[plain], piece[plain]
    quotes = np.bincount(piece[kind == _QUOTE], minlength=len(data))
    seen = np.cumsum(kind == _QUOTE) - (np.cumsum(quotes) - quotes)[piece]  # quotes of its piece so far
    step = np.where(kind == _OPEN, 1, np.where(kind == _CLOSE, -1, 0))
    outside = seen % 2 == 0
    out, inner = (np.bincount(piece[side], step[side], len(data)).astype(np.int64) for side in (outside, ~outside))
    end0 = quotes % 2
    # What is outside quotes for one start is inside them for the other.
    return [end0, 1 - end0, out - 1 + end0, inner - end0]


def _list_effect(rows: DataFrame) -> DataFrame:
    """Quote state and added depth of pieces of JSON that end with a closing brace, for both starts."""
    names = [*rows.columns, "end0", "end1", "add0", "add1"]
    value = rows.columns.index("value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            effects = [pa.array(e, pa.int32()) for e in _piece_effects(batch.column(value))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *effects], names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *[T.StructField(n, T.IntegerType()) for n in names[-4:]]]))


_BLANK = r"[ \t\r\n]*+"


def _list_items(spark: SparkSession, path: str) -> DataFrame:
    """(file, place, item, good): objects of files that each hold one list, and one row per file for its end.

    ``item`` is null where a row is no object. ``good`` is false where a file is not a list of objects.
    """
    rows = blocks.records(blocks.pieces(spark, path, "}", _list_effect), "}", 1)
    before = F.when(F.col("first"), rf"^\x{{FEFF}}?{_BLANK}\[{_BLANK}").otherwise(rf"^{_BLANK},{_BLANK}")
    after = F.when(F.col("first"), rf"^\x{{FEFF}}?{_BLANK}\[{_BLANK}\]{_BLANK}$").otherwise(rf"^{_BLANK}\]{_BLANK}$")
    pattern = F.when(F.col("last"), after).otherwise(F.concat(before, F.lit(r"(?=\{)")))
    good = F.regexp_like("text", pattern)
    item = F.when(~F.col("last") & good, F.regexp_replace("text", F.concat(before, F.lit(r"(?=\{)")), F.lit("")))
    return rows.select("file", blocks.file_order().alias("place"), item.alias("item"), good.alias("good"))


def _inferred(items: DataFrame, quarantine: bool) -> T.StructType:
    """The fields of objects that lie in the column ``item``; line breaks between values do not matter."""
    path = write_scratch(items.where("item IS NOT NULL").select(F.translate("item", "\r\n", "  ").alias("value")), "items", "text")
    spark = items.sparkSession
    found = spark.read.options(mode="DROPMALFORMED" if quarantine else "FAILFAST").json(path).schema
    drop_path(spark, path)
    return found


def _broken_lists(items: DataFrame, fields: T.StructType) -> DataFrame:
    """Files that are no list of objects, or hold an object that does not parse."""
    bad = ~F.col("__good") | F.col(CORRUPT).isNotNull()
    return _unfolded(items, _parsed(F.col("item"), fields)).where(bad).select(F.col("__file").alias("file")).distinct()


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, quarantine: bool = False
) -> DataFrame:
    """Files that each hold one JSON list of objects.

    A file that is no list, holds anything but objects or goes on behind the list fails the job; with
    ``quarantine`` such files give no rows here and are found by ``malformed_json``. A file without a byte has
    no rows. Many tasks read a file, whatever its line breaks. Pass a schema to avoid an extra pass.
    """
    _files(spark, path)
    items = _list_items(spark, path)
    if schema is None:
        items = materialize(items, "items")
    fields = _inferred(items, quarantine) if schema is None else _fields(schema)
    if quarantine:
        items = items.join(_broken_lists(items, fields), "file", "left_anti").where("item IS NOT NULL")
    rows = _unfolded(items, _parsed(F.col("item"), fields))
    if not quarantine:
        # One condition: a filter beside it could take the rows that have to fail away first.
        sound = F.col(CORRUPT).isNull()
        wanted = F.when(F.col("__item").isNull(), False).when(sound, True).otherwise(_refused("Malformed JSON").cast("boolean"))
        rows = rows.where(F.when(F.col("__good"), wanted).otherwise(_refused("a JSON list is wanted").cast("boolean")))
    return _numbered(rows, fields)


def _unfolded(rows: DataFrame, parsed: Column) -> DataFrame:
    """The fields of ``parsed`` as columns, beside the others as ``__<name>``. Generated rows are parsed once,
    however many columns and filters look at them."""
    return rows.select(*[F.col(c).alias(f"__{c}") for c in rows.columns], F.inline_outer(F.array(parsed)))


def _numbered(rows: DataFrame, fields: T.StructType) -> DataFrame:
    """The parsed fields, with ``row_id`` in file order unless they have one."""
    return rows.select(*[f"`{f.name}`" for f in fields.fields], *([] if "row_id" in fields.names else [F.col("__place").alias("row_id")]))


def _one_object(text: Column) -> Column:
    """Whether a text is one JSON object and nothing else: a mark put behind it is found behind it."""
    trimmed = F.btrim(text, F.lit(" \t\r\n\ufeff"))
    probe = F.from_json(F.concat(F.lit("["), trimmed, F.lit(f',{{"_end":{_MARK}}}]')), "array<struct<_end:bigint>>")
    return trimmed.startswith("{") & F.coalesce((F.size(probe) == 2) & (F.element_at(probe, -1)["_end"] == _MARK), F.lit(False))


def _lines(spark: SparkSession, path: str, fields: T.StructType) -> DataFrame:
    """Fields of every line that is not blank, beside __file, __place, __value and whether it is ``__sound``."""
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"), "value")
    lines = read.where(F.length(F.btrim("value", F.lit(" \t\r\n\ufeff"))) > 0)
    return _unfolded(lines, _parsed(F.col("value"), fields)).withColumn("__sound", _one_object(F.col("__value")) & F.col(CORRUPT).isNull())


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, quarantine: bool = False
) -> DataFrame:
    """One JSON object per line. A line that does not parse, or holds more than one object, fails the job;
    with ``quarantine`` it gives no row here and is found by ``malformed_json``."""
    _files(spark, path)
    if schema is None:
        schema = spark.read.options(mode="DROPMALFORMED" if quarantine else "FAILFAST").json(path).schema
    fields = _fields(schema)
    lines = _lines(spark, path, fields)
    keep = F.col("__sound") if quarantine else F.when(F.col("__sound"), True).otherwise(_refused("Malformed JSON").cast("boolean"))
    return _numbered(lines.where(keep), fields)


def malformed_json(spark: SparkSession, path: str, schema: T.StructType | str, lists: bool = False) -> DataFrame:
    """(file, value) of the lines, or with ``lists`` of the whole files, that readers with ``quarantine`` leave out."""
    _files(spark, path)
    fields = _fields(schema)
    if not lists:
        left = _lines(spark, path, fields).where(~F.col("__sound"))
        return left.select(F.col("__file").alias("file"), F.col("__value").alias("value"))
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return texts.join(_broken_lists(_list_items(spark, path), fields), "file", "left_semi")


def _csv_effect(rows: DataFrame) -> DataFrame:
    """Quote state of lines of CSV for both starts: a quote opens at the beginning of a cell, a single one closes.

    A doubled quote leaves the state as it is, wherever it stands.
    """

    def without_cells(name: str) -> Column:
        """The line without its closed quoted cells: a quote that is left at a cell's beginning is open."""
        return F.when(F.contains(F.col(name), F.lit('"')), F.regexp_replace(name, r'(^|,)"[^"]*+"[^,]*+', "$1")).otherwise(F.lit(""))

    def opened(name: str) -> Column:
        return F.when(F.col(name).startswith('"') | F.contains(F.col(name), F.lit(',"')), 1).otherwise(0)

    single = rows.withColumn("_single", F.replace("value", F.lit('""'), F.lit("")))
    # A rest behind a closed quote begins with a comma or is empty, so it cannot open at its beginning.
    cut = single.withColumn("_rest", F.regexp_replace("_single", r'^[^"]*+"[^,]*+', ""))
    left = cut.withColumns({"_left0": without_cells("_single"), "_left1": without_cells("_rest")})
    end1 = F.when(F.contains(F.col("_single"), F.lit('"')), opened("_left1")).otherwise(1)
    return left.withColumns({"end0": opened("_left0"), "end1": end1, "add0": F.lit(0), "add1": F.lit(0)})


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header in every file; every column is text and missing-value markers become null.

    Quoted cells may hold line breaks; many tasks read a file all the same. ``multi_line=False`` saves the
    pass that finds out which line breaks are quoted, for files whose cells are known to have none.
    """
    _files(spark, path)
    layout = {"quote": '"', "escape": '"'}
    if not multi_line:
        table = spark.read.csv(path, header=True, multiLine=False, inferSchema=False, **layout)
        return with_row_id(table.select(*[_csv_cell(F.col(f"`{c}`")).alias(c) for c in table.columns]))
    names = spark.read.csv(path, header=True, multiLine=True, inferSchema=False, **layout).columns
    rows = blocks.records(blocks.pieces(spark, path, "\n", _csv_effect), "\n", 0)
    line = F.regexp_replace("text", r"\r?\n?$", "")
    cells = ", ".join(f"_{i} string" for i in range(len(names)))
    lines = rows.where(~F.col("first")).select(blocks.file_order().alias("place"), line.alias("line")).where("line <> ''")
    parsed = _unfolded(lines, F.from_csv("line", cells, {**layout, "multiLine": "true"}))
    columns = [_csv_cell(F.col(f"_{i}")).alias(c) for i, c in enumerate(names)]
    return parsed.select(*columns, *([] if "row_id" in names else [F.col("__place").alias("row_id")]))


def _csv_cell(cell: Column) -> Column:
    return F.when(~cell.isin(CSV_MISSING), cell)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    _files(spark, path)
    return with_row_id(spark.read.parquet(path))


def read_split(spark: SparkSession, root: str, name: str, split: str = "train") -> DataFrame:
    """One split of a named table stored with a ``split`` partition; other splits are not read."""
    return read_parquet(spark, f"{root.rstrip('/')}/{name}").where(F.col("split") == split).drop("split")


def load(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Read by format name, else by file ending; anything unknown is taken as a JSON list.

    ``options`` go to the reader, e.g. ``schema`` for JSON or ``multi_line`` for CSV.
    """
    endings = {".csv": "csv", ".jsonl": "jsonl", ".ndjson": "jsonl", ".parquet": "parquet"}
    name = path.rstrip("/").lower()
    chosen = fmt or next((f for end, f in endings.items() if name.endswith(end)), "json")
    readers = {"csv": read_csv, "jsonl": read_json_lines, "parquet": read_parquet, "json": read_json_array}
    if chosen not in readers:
        raise ValueError(f"no source format named {chosen!r}; known are {sorted(readers)}")
    return readers[chosen](spark, path, **options)


def read_registry(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Registry rows; unknown keys are dropped, missing ones get their default, a missing ``seq`` one above all given.

    A line that does not parse keeps its text in ``_corrupt_record``. ``multi_line`` reads files
    that each hold one JSON list; there the whole file is the unit.
    """
    if multi_line:
        files = spark.read.text(path, wholetext=True)
        rows = T.ArrayType(T.StructType.fromDDL(REGISTRY_SCHEMA))
        parsed = files.select("value", F.from_json("value", rows).alias("_list"))
        items = parsed.select(
            F.explode_outer("_list").alias("_row"), F.when(F.col("_list").isNull(), F.col("value")).alias(CORRUPT)
        ).where(F.col("_row").isNotNull() | F.col(CORRUPT).isNotNull())
        raw = items.select("_row.*", CORRUPT)
    else:
        lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        parsed = F.from_json("value", f"{REGISTRY_SCHEMA}, {CORRUPT} string", options)
        raw = lines.select(parsed.alias("_row")).select("_row.*")
    last = raw.agg(F.max("seq")).first()[0]
    unnumbered = F.monotonically_increasing_id() + F.lit(0 if last is None else last + 1)
    blank = F.lit("")
    return raw.select(
        F.coalesce("seq", unnumbered).alias("seq"),
        F.coalesce("name", blank).alias("name"),
        F.coalesce("version", blank).alias("version"),
        F.coalesce("path", blank).alias("path"),
        F.coalesce("metrics", F.create_map().cast("map<string,double>")).alias("metrics"),
        "timestamp",
        F.coalesce("status", F.lit(REGISTERED)).alias("status"),
        CORRUPT,
    )


def healthy(registry: DataFrame) -> DataFrame:
    return registry.where(F.col(CORRUPT).isNull()).select(*REGISTRY_COLUMNS)


def quarantined(registry: DataFrame) -> DataFrame:
    return registry.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
