"""Keys and names of stored objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where each layer and flow is stored (bucket, schema, table), and the two origins.
DESTINATIONS = {
    ("bronze", "teoria"): ("bronze-teoria", "bronze", "teoria_documentos"),
    ("silver", "teoria"): ("silver-teoria", "silver", "teoria_documentos"),
    ("bronze", "historico"): ("bronze-historico", "bronze", "historico_documentos"),
    ("silver", "historico"): ("silver-historico", "silver", "historico_documentos"),
}
DRIVE, LEGACY = "drive", "local_legacy"


def destination(layer: str, flow: str) -> tuple[str, str, str]:
    """Bucket, schema and table of a layer and flow; an unknown pair is an error."""
    try:
        return DESTINATIONS[layer, flow]
    except KeyError:
        raise ValueError(f"no destination for layer {layer!r} and flow {flow!r}") from None


def safe_name(name: Column) -> Column:
    """`name` with _ for every character other than A-Z, a-z, 0-9, dot, underscore and hyphen."""
    return F.regexp_replace(name, "[^A-Za-z0-9._-]", "_")


def compact_time(time: Column) -> Column:
    """An RFC 3339 time without - and :."""
    return F.translate(time, "-:", "")


def origin(drive_id: Column) -> Column:
    """"local_legacy" without a drive id, else "drive"."""
    return F.when(drive_id.isNull(), LEGACY).otherwise(DRIVE)


def object_path(drive_id: Column, modified: Column, md5: Column, name: Column) -> Column:
    """drive/<id>/<compact time>/<name>, or local_legacy/<md5>/<name>."""
    return F.when(drive_id.isNull(), F.concat_ws("/", F.lit(LEGACY), md5, safe_name(name))).otherwise(F.concat_ws("/", F.lit(DRIVE), drive_id, compact_time(modified), safe_name(name)))


def local_name(name: Column, extension: Column) -> Column:
    """`name`, with the extension unless it ends with it in any case."""
    return F.when(F.lower(name).endswith(F.lower(extension)), name).otherwise(F.concat(name, extension))


def idempotency_key(drive_id: Column, modified: Column, md5: Column) -> Column:
    """Struct that is equal for rows that may not both be stored: id and time with a drive id, else the hash alone. The two never mix."""
    legacy = drive_id.isNull()
    return F.struct(legacy.alias("legacy"), F.when(legacy, md5).otherwise(drive_id).alias("key"), F.when(~legacy, modified).alias("time"))
