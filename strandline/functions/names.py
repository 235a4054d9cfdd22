"""What file names, dates, order names and tool lists say, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Instrument name -> file suffix; tools that an order may ask for.
SENSOR_SUFFIX = {"PS2": "_PS2_TOA.tif", "PS2.SD": "_2SD_TOA.tif", "PSB.SD": "_BSD_TOA.tif"}
TOOLS = ("clip", "toar", "coregister")
BATCH_SIZE = 499


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def base_name(name: Column, separator: str = "_3B") -> Column:
    """Text before the separator; an error where it is not in the name."""
    return F.when(F.contains(name, F.lit(separator)), F.split_part(name, F.lit(separator), F.lit(1))).otherwise(
        F.raise_error(F.concat(F.lit(f"no {separator} in "), name)).cast("string")
    )


def scene_id(name: Column) -> Column:
    """The first four tokens between underscores."""
    return F.array_join(F.slice(F.split(name, "_"), 1, 4), "_")


def name_time(name: Column) -> Column:
    """The time in the first two tokens, null if they are none."""
    return F.try_to_timestamp(F.substring_index(name, "_", 2), F.lit("yyyyMMdd_HHmmss"))


def name_date(name: Column) -> Column:
    return F.date_format(name_time(name), "yyyy-MM-dd-HH-mm-ss")


def first_token(name: Column) -> Column:
    return F.substring_index(name, "_", 1)


def acquired_date(acquired: Column) -> Column:
    """The part of an ISO time before its T."""
    return F.split_part(acquired, F.lit("T"), F.lit(1))


def sensor_suffix(sensor: Column, mapping: dict[str, str] | None = None) -> Column:
    pairs = [F.lit(x) for kv in (mapping or SENSOR_SUFFIX).items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), sensor), F.lit("_UNKNOWN_TOA.tif"))


def known_tools(tools: Column, known: tuple[str, ...] = TOOLS) -> tuple[Column, Column]:
    """(tools known, trimmed and in lower case; tools that are not known)."""
    clean = F.transform(tools, lambda t: F.lower(F.trim(t)))
    names = F.array(*[F.lit(k) for k in known])
    return F.array_intersect(clean, names), F.array_except(clean, names)


def order_name_matches(name: Column, wanted: str) -> Column:
    """The name itself, or one of its batches; ``wanted`` is a pattern, as it stands."""
    return (name == wanted) | name.rlike(f"^{wanted}(_batch.*)?$")


def batch_name(base: str, index: Column, length: Column) -> Column:
    return F.concat_ws("_", F.lit(base), F.lit("batch"), index.cast("string"), length.cast("string"))


def property_or(json: Column, key: str, default) -> Column:
    """A property of a JSON text, or the default where it is missing."""
    return F.coalesce(F.get_json_object(json, f"$.{key}").cast(type_name(default)), F.lit(default))


def type_name(value) -> str:
    return {float: "double", int: "bigint", bool: "boolean"}.get(type(value), "string")


def timestamps_as_text(df, form: str = "yyyy-MM-dd HH:mm:ss"):
    """Every timestamp column of a table as text."""
    kinds = ("timestamp", "timestamp_ntz")
    return df.select(*[F.date_format(f"`{n}`", form).alias(n) if t in kinds else F.col(f"`{n}`") for n, t in df.dtypes])


def projected_epsg(epsg: Column) -> Column:
    """``EPSG:n`` of a projected (UTM) system, else null."""
    utm = epsg.between(32601, 32660) | epsg.between(32701, 32760)
    return F.when(utm, F.concat(F.lit("EPSG:"), epsg.cast("string")))
