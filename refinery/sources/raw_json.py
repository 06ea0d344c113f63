"""The raw zone: JSON files below one root, read with lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from refinery.contracts import RAW

CORRUPT = "_corrupt_record"
RESCUED = "_rescued"
LAYOUTS = ("lines", "array")


def _json_options(reader, layout: str):
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    # A JSON array spans its whole file, which one task then parses; JSON Lines can be split.
    return (
        reader.option("multiLine", layout == "array")
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("mode", "PERMISSIVE")
    )


def _day_path(path: str, ingest_date: str | None) -> str:
    return f"{path.rstrip('/')}/ingest_date={ingest_date}" if ingest_date else path


def discover_schema(
    spark: SparkSession,
    path: str,
    *,
    layout: str = "lines",
    base: T.StructType = RAW,
    ingest_date: str | None = None,
    sampling_ratio: float = 1.0,
) -> T.StructType:
    """``base`` plus every field that occurs in the files but not in it, scalars as text.

    Costs a pass over the files (over a share of them with ``sampling_ratio``). A field
    that ``base`` names keeps its type from there, whatever the files hold; a struct gains the
    members that ``base`` does not name.
    """
    found = (
        _json_options(spark.read, layout)
        .option("primitivesAsString", True)
        .option("samplingRatio", sampling_ratio)
        .json(_day_path(path, ingest_date))
        .schema
    )
    return _with_extra(base, found)


def _with_extra(base: T.StructType, found: T.StructType) -> T.StructType:
    """``base`` with the fields, also of nested structs, that only ``found`` has."""
    fields = []
    for field in base.fields:
        other = found[field.name].dataType if field.name in found.names else None
        if isinstance(field.dataType, T.StructType) and isinstance(other, T.StructType):
            field = T.StructField(field.name, _with_extra(field.dataType, other), field.nullable)
        fields.append(field)
    extra = [f for f in found.fields if f.name not in base.names and f.name != CORRUPT]
    return T.StructType(fields + extra)


def read_raw(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | None = None,
    layout: str = "lines",
    ingest_date: str | None = None,
) -> DataFrame:
    """Every JSON file below ``path`` (or below one landing day), with lineage columns.

    Without a schema new fields are discovered first, which reads the files twice.
    """
    if schema is None:
        schema = discover_schema(spark, path, layout=layout, ingest_date=ingest_date)
    if layout == "array":
        return read_records(spark, path, schema, layout=layout, ingest_date=ingest_date).drop(RESCUED)
    reader = _json_options(spark.read, layout).schema(with_corrupt(schema))
    return shape_raw(reader.json(_day_path(path, ingest_date)))


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    layout: str = "lines",
    ingest_date: str | None = None,
) -> DataFrame:
    """The records below ``path`` in one pass under ``schema``, with what it does not name in ``_rescued``.

    Rows are those of :func:`read_raw`: the records of an array are rows each, also of one that
    stands in a line. A file of the array layout that holds no readable array is one record.
    """
    return parse_records(text_scan(spark.read, _day_path(path, ingest_date), layout), schema, layout)


def read_lines(
    spark: SparkSession, path: str, schema: T.StructType, *, ingest_date: str | None = None
) -> DataFrame:
    return read_records(spark, path, schema, ingest_date=ingest_date)


def text_scan(reader, path: str, layout: str) -> DataFrame:
    """The text of lines, or of whole files, as a table or a stream."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    return reader.option("recursiveFileLookup", True).text(path, wholetext=layout == "array")


def parse_records(scan: DataFrame, schema: T.StructType, layout: str = "lines") -> DataFrame:
    """Records from a :func:`text_scan`.

    The text of an array file is split into the texts of its records first, so each record is parsed
    by itself: a mistyped field marks its own record only, and unknown fields are kept.
    """
    value = F.col("value")
    if layout == "array":
        # A line end may stand before the bracket.
        scan, starts = scan.where(value.rlike(r"\S")), value.rlike(r"^\s*\[")
    else:
        starts = F.ltrim(value).startswith("[")
    whole = _numbers_quoted(value) if _all_text(schema) else value
    several = F.when(starts, F.from_json(whole, "array<string>"))
    records = F.explode(F.coalesce(several, F.array(whole)))
    return _parsed(scan.select(records.alias("value"), _source_file()).where(F.trim("value") != ""), schema)


def with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.names:
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def _source_file() -> Column:
    return F.col("_metadata.file_path").alias("_source_file")


def _loaded_at() -> Column:
    return F.current_timestamp().alias("_bronze_loaded_at")


def shape_raw(scan: DataFrame) -> DataFrame:
    """Add source file and load time.

    JSON Lines keep the text of every record that could not be read whole, also where only one
    field has the wrong type.
    """
    data = [F.col(f"`{name}`") for name in scan.columns if name != CORRUPT]
    return scan.select(*data, CORRUPT, _source_file(), _loaded_at())


# ``from_json`` writes the numbers it gives as text anew, through a double: 7.50 becomes 7.5, and
# 18 digits after the point become 16. So numbers become marked texts before, outside of texts only:
# each match starts where the last one ended, and takes what is no number, or whole texts, first.
_MARK = "\u0001"
_NUMBER = r"-?(?:0|[1-9]\d*+)(?:\.\d++)?(?:[eE][+-]?\d++)?(?![\w.+-])"
_BEFORE = r"""\G((?:[^"'\d\-]++|"[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+'|-(?!\d))*+)"""


def _numbers_quoted(text: Column) -> Column:
    return F.regexp_replace(text, f"(?s){_BEFORE}({_NUMBER})", r'$1"\\u0001$2"')


def _plain(text: Column) -> Column:
    """A parsed text without marks: of a number, or of the numbers within an object or array."""
    inside = F.regexp_replace(text, r'"\\u0001([^"]*)"', "$1")
    return F.ltrim(F.when(text.contains('"\\u0001'), inside).otherwise(text), F.lit(_MARK))


def _all_text(kind: T.DataType) -> bool:
    """Whether every scalar of the type is a text."""
    if isinstance(kind, T.StructType):
        return all(_all_text(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _all_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return _all_text(kind.keyType) and _all_text(kind.valueType)
    return isinstance(kind, T.StringType)


def _unmarked(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        members = [_unmarked(column[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*members))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _unmarked(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(column, lambda _, x: _unmarked(x, kind.valueType))
    return _plain(column)


def _named(names: list[str]) -> Column:
    return F.array(*[F.lit(name) for name in names]).cast("array<string>")


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Records from a scan of text lines, as :func:`shape_raw` has them, plus ``_rescued``.

    ``_rescued`` holds what ``schema`` does not name: unknown fields, and declared structs with
    unknown members, as one JSON text; NULL where there is none. Blank lines are no records. Where
    the schema has texts only, numbers keep the digits they are written with.
    """
    value = _numbers_quoted(F.col("value")) if _all_text(schema) else F.col("value")
    return _parsed(lines.where(F.trim("value") != "").select(value.alias("value"), _source_file()), schema)


def _parsed(records: DataFrame, schema: T.StructType) -> DataFrame:
    """One record per text; numbers are marked if all of the schema is text.

    A record is parsed once. Only one that has more names than those found in it, or whose structs
    have, is parsed again for the rest.
    """
    marked, value = _all_text(schema), F.col("value")
    plain = _plain if marked else lambda text: text
    # Structs of texts are parsed as maps, which show their further members as well.
    mapped = [f.name for f in schema.fields if isinstance(f.dataType, T.StructType) and _only_texts(f.dataType)]
    as_map = T.MapType(T.StringType(), T.StringType())
    kinds = T.StructType([T.StructField(f.name, as_map if f.name in mapped else f.dataType) for f in schema.fields])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = records.select(
        F.from_json("value", with_corrupt(kinds), options).alias("__row"),
        F.json_object_keys("value").alias("__names"), "value", "_source_file",
    )

    data, more = [], {}
    for field in schema.fields:
        found, kind = F.col(f"__row.`{field.name}`"), field.dataType
        if field.name in mapped:
            members = F.struct(*[plain(found[name]).alias(name) for name in kind.names])
            more[field.name] = _beyond(F.map_keys(found), kind.names, [found[name] for name in kind.names])
            found = F.when(found.isNotNull(), members)
        elif isinstance(kind, T.StructType):
            names = F.json_object_keys(F.get_json_object(value, f"$.{field.name}"))
            more[field.name] = _beyond(names, kind.names, [])
        if marked and field.name not in mapped:
            found = _unmarked(found, kind)
        data.append(found.alias(field.name))
    found = [F.col(f"__row.`{name}`") for name in schema.names]
    beyond = _beyond(F.col("__names"), schema.names, found)
    for condition in more.values():
        beyond = beyond | condition
    with_more = [F.when(condition, name) for name, condition in more.items()]
    known = F.array_except(_named(schema.names), F.array(*with_more, F.lit("")))
    unknown = F.map_filter(F.from_json(value, "map<string,string>"), lambda name, _: ~F.array_contains(known, name))
    if marked:
        unknown = F.transform_values(unknown, lambda _, text: _plain(text))
    corrupt = plain(F.col(f"__row.`{CORRUPT}`")).alias(CORRUPT)
    if CORRUPT in schema.names:
        data = [column for name, column in zip(schema.names, data) if name != CORRUPT]
    return rows.select(*data, corrupt, F.when(beyond, F.to_json(unknown)).alias(RESCUED), "_source_file", _loaded_at())


def _only_texts(kind: T.StructType) -> bool:
    return all(isinstance(field.dataType, T.StringType) for field in kind.fields)


def _beyond(names: Column, known: list[str], values: list[Column]) -> Column:
    """Whether ``names`` has any beyond the known ones; ``values`` are what was found under those.

    As many names as values means that there are no others, which spares a comparison of names.
    """
    count = sum((value.isNotNull().cast("int") for value in values), F.lit(0))
    return F.coalesce((F.size(names) > count) & (F.size(F.array_except(names, _named(known))) > 0), F.lit(False))
