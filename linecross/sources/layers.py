"""Reading layers from Parquet, GeoJSON and WKB tables into the schemas of ``linecross.schema``."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from linecross.functions import planar
from linecross.schema import LINE, POINT
from linecross.sources.collections import RANGE_BYTES, collection_features

_VERTEX_ARRAY = T.ArrayType(T.DoubleType())
_CORRUPT = "_corrupt_record"


def _vertex(c: Column) -> Column:
    return F.struct(*[F.get(c, i).alias(axis) for i, axis in enumerate("xyzm")])


def _geojson_point(coordinates: Column) -> Column:
    return F.when(coordinates.isNotNull(), _vertex(F.from_json(coordinates, _VERTEX_ARRAY)))


def _geojson_line(kind: Column, coordinates: Column) -> Column:
    single = F.from_json(coordinates, T.ArrayType(_VERTEX_ARRAY))
    multi = F.from_json(coordinates, T.ArrayType(T.ArrayType(_VERTEX_ARRAY)))

    def part(p: Column) -> Column:
        return F.transform(p, _vertex)
    return F.when(kind == "LineString", F.array(part(single))).when(kind == "MultiLineString", F.transform(multi, part))


def _read_geojson(spark: SparkSession, path: str, schema: T.StructType, id_col: str | None, range_bytes: int | None) -> DataFrame:
    """Features of collections, read by ranges of ``range_bytes``, or one feature per line where that is None."""
    properties = T.StructType([f for f in schema if f.name != "geom"])
    # the JSON reader keeps a nested value as text where the schema asks for a string
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feature = T.StructType([T.StructField("id", T.StringType()), T.StructField("properties", properties),
                            T.StructField("geometry", geometry)])
    if range_bytes:
        read = T.StructType([*feature, T.StructField("type", T.StringType()), T.StructField(_CORRUPT, T.StringType())])
        parsed = F.from_json("feature", read, {"columnNameOfCorruptRecord": _CORRUPT})
        features = collection_features(spark, path, range_bytes).select(parsed.alias("f")).select("f.*")
        broken = F.col("type").isNull() & F.col(_CORRUPT).isNotNull()
        features = features.where(F.when(broken, F.raise_error(F.concat(F.lit("no JSON: "), F.substring(_CORRUPT, 1, 200))).cast("boolean")).otherwise(
            F.col("type") == "Feature"))
    else:
        features = spark.read.schema(feature).json(path)
    columns = []
    for field in schema:
        if field.name == "geom":
            kind, coordinates = F.col("geometry.type"), F.col("geometry.coordinates")
            geom = _geojson_line(kind, coordinates) if field.dataType == LINE else _geojson_point(coordinates)
            columns.append(geom.alias("geom"))
        elif field.name == id_col:
            columns.append(F.coalesce(F.col(f"properties.{field.name}").cast(field.dataType),
                                      F.col("id").cast(field.dataType)).alias(field.name))
        else:
            columns.append(F.col(f"properties.{field.name}"))
    return features.select(*columns)


_POINT, _LINE, _MULTI_LINE = 1, 2, 5


def _wkb_part(buffer: memoryview, offset: int) -> tuple[int, int, str, str, int]:
    """Of the ISO or extended WKB geometry at ``offset``: type, place of what follows its header, byte order, axes, and count."""
    order = "<" if buffer[offset] else ">"
    (code,) = struct.unpack_from(f"{order}I", buffer, offset + 1)
    offset += 9 if code & 0x20000000 else 5  # the reference system may follow; a layer has one
    kind, dims = (code & 0xFFFF) % 1000, (code & 0xFFFF) // 1000
    axes = "xy" + "z" * (bool(code & 0x80000000) or dims in (1, 3)) + "m" * (bool(code & 0x40000000) or dims in (2, 3))
    if kind == _POINT:
        return kind, offset, order, axes, 1
    (n,) = struct.unpack_from(f"{order}I", buffer, offset)
    return kind, offset + 4, order, axes, n


def _wkb_parts(buffer: memoryview) -> list[tuple[str, np.ndarray]]:
    """Axes and ordinates (a row per vertex) of each part; a view of the buffer where the byte order is the machine's."""
    kind, offset, order, axes, n = _wkb_part(buffer, 0)
    parts = []
    for _ in range(n if kind == _MULTI_LINE else 1):
        if kind == _MULTI_LINE:
            inner, offset, order, axes, n = _wkb_part(buffer, offset)
        else:
            inner = kind
        if inner not in (_POINT, _LINE):
            raise ValueError(f"geometry type {inner}")
        values = np.frombuffer(buffer, f"{order}f8", n * len(axes), offset)
        offset += values.nbytes
        parts.append((axes, values.reshape(n, len(axes))))
    if offset != len(buffer):
        raise ValueError(f"{len(buffer) - offset} bytes too many")
    return parts


def decode_wkb(values: pa.Array) -> pa.Array:
    """``struct<geom, error>`` for an Arrow array of WKB: nested lists made from whole columns, and why a value is no line or point."""
    parts, errors, counts = [], [], []
    for value in values:
        found, error = [], None
        if value.is_valid:
            try:
                found = _wkb_parts(memoryview(value.as_buffer()))
            except (ValueError, IndexError, struct.error) as problem:
                error = str(problem) or type(problem).__name__
        parts += found
        errors.append(error)
        counts.append(len(found) if value.is_valid and error is None else None)
    sizes = [len(v) for _, v in parts]
    columns = []
    for axis in "xyzm":
        known = [axes.find(axis) for axes, _ in parts]
        flat = np.concatenate([np.empty(0), *[v[:, k] if k >= 0 else np.full(len(v), np.nan) for k, (_, v) in zip(known, parts)]]).astype("=f8")
        columns.append(pa.array(flat, mask=np.repeat(np.array(known, int) < 0, sizes)))
    vertices = pa.StructArray.from_arrays(columns, list("xyzm"))
    lines = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), vertices)
    ends = np.cumsum([0, *[n or 0 for n in counts]])
    # a null offset marks a null list
    offsets = pa.array([None if n is None else int(end) for n, end in zip(counts, ends)] + [int(ends[-1])], pa.int32())
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, lines), pa.array(errors, pa.string())], ["geom", "error"])


@F.arrow_udf(T.StructType([T.StructField("geom", LINE), T.StructField("error", T.StringType())]))
def _decoded(values: pa.Array) -> pa.Array:
    return decode_wkb(values)


def read_layer(spark: SparkSession, path: str, schema: T.StructType, id_col: str | None = None, fmt: str = "parquet",
               reject: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Read a layer with the columns of ``schema``; filters on the result reach a Parquet scan.

    ``fmt``: ``parquet`` (geometry as arrays of vertices), ``wkb`` (Parquet with a binary ``geom``), ``geojsonl`` (one
    feature per line, which splits into tasks) or ``geojson`` (feature collections, read in ranges of ``range_bytes`` whatever
    their layout). ``id_col`` is taken from the feature's id where its property is missing. ``reject`` names one more column for ``wkb``: why the geometry of a
    row cannot be read, which is NULL then; without it such a row fails the read.
    """
    names = schema.fieldNames()
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt == "wkb":
        stored = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "geom" else f.dataType) for f in schema])
        rows = spark.read.schema(stored).parquet(path)
        if "geom" not in names:
            return rows
        parts = F.col("_read.geom") if reject else F.when(F.col("_read.error").isNull(), F.col("_read.geom")).otherwise(
            F.raise_error(F.concat(F.lit("no line or point in WKB: "), F.col("_read.error"))))
        geom = parts[0][0] if schema["geom"].dataType == POINT else parts
        rows = rows.withColumn("_read", _decoded("geom"))
        return rows.select(*[geom.alias(n) if n == "geom" else F.col(n) for n in names],
                           *([F.col("_read.error").alias(reject)] if reject else []))
    if fmt in ("geojson", "geojsonl"):
        return _read_geojson(spark, path, schema, id_col, range_bytes if fmt == "geojson" else None)
    raise ValueError(f"fmt: {fmt!r}")


def read_codes(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a code table (no geometry) from Parquet, JSON lines or CSV with a header."""
    reader = spark.read.schema(schema)
    return {"parquet": reader.parquet, "json": reader.json, "csv": lambda p: reader.option("header", True).csv(p)}[fmt](path)


def promote_to_multi(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Layer with single-part lines (one vertex array) turned into multi-part ones."""
    return df.withColumn(geom, F.expr(planar.promote_to_multi(geom)))


def force_2d(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Layer with z and m of its lines removed."""
    return df.withColumn(geom, F.expr(planar.force_2d(geom)))
