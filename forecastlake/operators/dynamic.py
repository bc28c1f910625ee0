"""Dynamic flatten that finds its variables itself (P4, P15, P18, X17), on the VARIANT type.

Bodies are parsed once into a staging table whose ``body`` is a VARIANT: every block of
a body stays queryable, not only those that a schema names. One aggregation merges
the shapes of all bodies' blocks into one schema, which gives the variables with their
types; the flatten then reads the variants, without parsing JSON again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecastlake.functions.scalars import iso_format, parse_date, parse_time
from forecastlake.operators.parse import ERR_MISSING_BLOCK, parse_responses
from forecastlake.schemas import require_interval

#: Columns of a wide table that discovery returns at most; more is an error, not a wide table.
MAX_VARIABLES = 2_000
_KEEP = ("location", "api_latitude", "api_longitude", "api_elevation", "api_timezone", "api_generationtime_ms",
         "ingestion_timestamp_utc", "elapsed_ms", "request_url")


def stage_variants(responses: DataFrame, path: str, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Usable responses with their whole body as a VARIANT, written to ``path`` and read back."""
    parsed = parse_responses(responses).withColumn("_variant", F.try_parse_json("body"))
    # The typed parse has no block where one field isn't an array; the variant has.
    times = F.when(F.col("interval") == "daily", _field("daily", "time", "array<string>", "_variant")) \
        .otherwise(_field("hourly", "time", "array<string>", "_variant"))
    usable = F.col("error").isNull() | (F.col("error").startswith(ERR_MISSING_BLOCK) & times.isNotNull())
    staged = parsed.filter(usable).select(*_KEEP, *keep, F.col("_variant").alias("body"))
    staged.write.parquet(path)
    return responses.sparkSession.read.schema(staged.schema).parquet(path)


def _field(block: str, name: str, kind: str, body: str = "body") -> Column:
    """A field of a block of the body as ``kind``; names that a variant path can't hold go through a map."""
    if "'" not in name and "\\" not in name:
        return F.try_variant_get(body, f"$.{block}['{name}']", kind)
    return F.try_variant_get(F.try_variant_get(body, f"$.{block}", "map<string,variant>")[name], "$", kind)


def block_schema(staged: DataFrame, block: str) -> T.StructType:
    """Fields of a block over all bodies, with merged types: one aggregation of the shapes.

    Only the merged schema comes to the driver. A field whose bodies disagree beyond
    numbers is a VARIANT. No bodies, or none with the block: no fields.
    """
    merged = staged.agg(F.schema_of_variant_agg(F.try_variant_get("body", f"$['{block}']", "variant")).alias("s")).first()["s"]
    if merged is None or not merged.startswith("OBJECT<"):
        return T.StructType([])
    schema = T.DataType.fromDDL(merged.replace("OBJECT<", "STRUCT<"))
    if len(schema.fields) > MAX_VARIABLES:
        raise ValueError(f"{block} has {len(schema.fields)} fields, more than {MAX_VARIABLES}")
    return schema


def _cell_type(t: T.DataType) -> str:
    """Column type of an array's cells: numbers are doubles, what disagrees stays text."""
    cell = t.elementType if isinstance(t, T.ArrayType) else T.NullType()
    if isinstance(cell, T.NumericType) or isinstance(cell, T.NullType):
        return "double"
    return "boolean" if isinstance(cell, T.BooleanType) else "string"


def discovered_variables(staged: DataFrame, interval: str) -> dict[str, str]:
    """Variable -> column type, by name; all arrays of the block but ``time``."""
    schema = block_schema(staged, require_interval(interval))
    return {f.name: _cell_type(f.dataType) for f in sorted(schema.fields, key=lambda f: f.name)
            if f.name != "time" and isinstance(f.dataType, (T.ArrayType, T.NullType, T.VariantType))}


def flatten_discovered(staged: DataFrame, interval: str, variables: dict[str, str] | None = None) -> DataFrame:
    """Rows of the prototype flatten (P4) with a column for every variable that bodies hold.

    Without ``variables`` they are discovered. A cell that doesn't fit its column, is
    absent or past its array's end is null; an array that isn't one has null cells.
    """
    if variables is None:
        variables = discovered_variables(staged, interval)
    require_interval(interval)
    loc = F.col("location")
    arrays = staged.select(
        "*", _field(interval, "time", "array<string>").alias("_time"),
        *[_field(interval, v, "array<variant>").alias(f"_arr_{i}") for i, v in enumerate(variables)])
    cells = F.transform("_time", lambda t, i: F.struct(
        t.alias("_time_text"), *[F.get(F.col(f"_arr_{k}"), i).alias(f"_cell_{k}") for k in range(len(variables))]))
    hourly = interval == "hourly"
    first = parse_time("_time_text").alias("time") if hourly else parse_date("_time_text").alias("date")
    name = F.coalesce(loc["name"], F.concat_ws(",", loc["latitude"].cast("string"), loc["longitude"].cast("string")))
    rows = arrays.select(
        name.alias("location_name"), loc["latitude"].alias("requested_latitude"), loc["longitude"].alias("requested_longitude"),
        "api_latitude", "api_longitude", "api_elevation", "api_timezone", "api_generationtime_ms",
        iso_format("ingestion_timestamp_utc").alias("ingestion_timestamp_utc"),
        F.col("elapsed_ms").alias("ingest_elapsed_ms" if hourly else "request_elapsed_ms"), "request_url", F.inline(cells))
    values = [F.try_variant_get(f"_cell_{k}", "$", kind).alias(v) for k, (v, kind) in enumerate(variables.items())]
    return rows.select(first, *values, *rows.columns[:11])


def top_level_shape(staged: DataFrame) -> DataFrame:
    """(key, kind, bodies): top-level keys over all bodies with their kind of value (P15, P18), from the variants."""
    keys = staged.select(F.explode(F.map_entries(F.try_variant_get("body", "$", "map<string,variant>"))).alias("e"))
    kind = F.regexp_extract(F.schema_of_variant("e.value"), "^([A-Z]+)", 1)
    kind = F.when(kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(kind)
    return keys.groupBy(F.col("e.key").alias("key"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("bodies"))
