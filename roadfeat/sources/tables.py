"""Reading attribute tables and layers, and writing results."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from roadfeat.config import POINT_ID, PROJECT_CRS
from roadfeat.functions.clean import name, normalize_na, require_columns
from roadfeat.functions.geometry import bounds, close_rings
from roadfeat.layer import LINE, POINT, POLYGON, Layer
from roadfeat.sources.shapefile import (
    crs_of_shapefile,
    crs_of_text,
    find_shapefiles,
    header_rows,
    is_file,
    merged_schema,
    read_shapefile,
)

BBOX_COLUMNS = ("xmin", "ymin", "xmax", "ymax")
Source = "str | os.PathLike | DataFrame"


def active_session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active Spark session")
    return spark


def read_table(
    source: Source,
    required: Iterable[str] = (),
    optional: Iterable[str] = (),
    encoding: str = "utf-8",
    file_format: str | None = None,
    what: str = "table",
    multi_line: bool = False,
) -> DataFrame:
    """The needed columns of a CSV, Parquet, ORC or JSON table, or of a DataFrame.

    ``multi_line`` reads quoted line feeds in CSV values; such a file can't be split, so each is one task.

    CSV columns stay text (no inference pass) with missing-value texts made null; typed
    tables keep their types. A missing required column fails before any job.
    """
    if isinstance(source, DataFrame):
        df = source
    else:
        path = os.fspath(source)
        reader = active_session().read
        if is_text_file(source, file_format):
            df = reader.csv(path, header=True, encoding=encoding, quote='"', escape='"', multiLine=multi_line)
        else:
            df = reader.format(file_format or _suffix(source) or "parquet").load(path)
    required = list(required)
    require_columns(df, required, what)
    wanted = required + [c for c in optional if c in df.columns and c not in required]
    df = df.select(*[name(c) for c in wanted]) if wanted else df
    return normalize_na(df) if is_text_file(source, file_format) else df


def _suffix(source: Source) -> str:
    return os.path.splitext(os.fspath(source).rstrip("/"))[1].lstrip(".").lower()


def is_text_file(source: Source, file_format: str | None = None) -> bool:
    """Whether a source is a CSV file, whose columns have no types of their own."""
    return isinstance(source, (str, os.PathLike)) and (file_format or _suffix(source)) == "csv"


def read_layer(
    source: "Source | Layer",
    kind: str,
    crs: int | None = None,
    encoding: str = "utf-8",
    columns: Iterable[str] | None = None,
    what: str = "layer",
) -> Layer:
    """A geometry layer from a shapefile, a layer table, a DataFrame or a Layer.

    Layer tables have ``parts`` (lines, polygons) or ``x, y`` (points). ``crs`` stands
    in where the source states none.
    """
    if isinstance(source, Layer):
        layer = source
    elif isinstance(source, DataFrame):
        layer = Layer(source, kind, crs or PROJECT_CRS)
    else:
        path = os.fspath(source)
        if path.rstrip("/").lower().endswith(".shp"):
            layer = _shapefile_layer(path, kind, crs, encoding, columns, what)
        else:
            layer = Layer(read_table(path, what=what), kind, crs or PROJECT_CRS)
    require_columns(layer.df, ["x", "y"] if layer.kind == POINT else ["parts"], what)
    df = layer.df
    if columns is not None:
        geometry = ["x", "y"] if layer.kind == POINT else ["parts"]
        extra = [c for c in BBOX_COLUMNS if c in df.columns]
        df = df.select(*[name(c) for c in df.columns if c in set(columns) | set(geometry) | set(extra)])
    if layer.kind == POLYGON:
        df = df.withColumn("parts", close_rings("parts"))
    return replace(layer, df=df)


def _shapefile_layer(
    path: str, kind: str, crs: int | None, encoding: str, columns: Iterable[str] | None, what: str
) -> Layer:
    """One shapefile, or a folder of parts that has the name of one; only the named columns are decoded."""
    spark = active_session()
    columns = list(columns) if columns is not None else None
    if is_file(path):
        return Layer(
            read_shapefile(spark, path, kind, encoding, columns), kind, crs_of_shapefile(path) or crs or PROJECT_CRS
        )
    parts = find_shapefiles(path)
    if not parts:
        raise FileNotFoundError(path)
    headers = header_rows(spark, parts, encoding)
    systems = list(dict.fromkeys(crs_of_text(r["prj"], path) for r in headers.select("prj").distinct().collect()))
    if len(systems) > 1:
        raise ValueError(f"{what}: {path} has files in several coordinate systems {systems}")
    schema = merged_schema(headers, kind, columns)
    return Layer(read_shapefile(spark, parts, kind, encoding, schema=schema), kind, systems[0] or crs or PROJECT_CRS)


def ingest_layer(layer: Layer, path: str, tile_m: float = 5_000.0, mode: str = "errorifexists") -> None:
    """Write a layer as Parquet with bounding boxes, sorted by tile inside each file.

    The box columns let later reads with a bounding box skip row groups.
    """
    from pyspark.sql import functions as F

    if layer.kind == POINT:
        df, x, y = layer.df, F.col("x"), F.col("y")
    else:
        df = layer.df.withColumns(bounds("parts"))
        x, y = F.col("xmin"), F.col("ymin")
    tiled = df.withColumns({"_tx": F.floor(x / tile_m), "_ty": F.floor(y / tile_m)})
    # Ranges over tile and place, so that one crowded tile still spreads over files.
    tiled = tiled.repartitionByRange("_tx", "_ty", x, y).sortWithinPartitions("_tx", "_ty")
    tiled.drop("_tx", "_ty").write.mode(mode).parquet(path)


def within_box(layer: Layer, box: tuple[float, float, float, float]) -> Layer:
    """Rows whose bounding box overlaps ``box`` (in the layer's coordinates)."""
    from pyspark.sql import functions as F

    xmin, ymin, xmax, ymax = box
    df = layer.df
    if layer.kind == POINT:
        kept = df.where(F.col("x").between(xmin, xmax) & F.col("y").between(ymin, ymax))
    else:
        added = {k: c for k, c in bounds("parts").items() if k not in df.columns}
        kept = (
            df.withColumns(added)
            .where("xmax >= %r and xmin <= %r and ymax >= %r and ymin <= %r" % (xmin, xmax, ymin, ymax))
            .drop(*added)
        )
    return replace(layer, df=kept)


def write_table(
    df: DataFrame, path: str, file_format: str = "parquet", mode: str = "overwrite", single: bool = False, order_by: str | None = None
) -> None:
    """The result table, in ranges of ``order_by`` (the point id where there is one): Parquet by default, or CSV with a header.

    Rows are written once, then ranged; all parts go to a folder beside ``path`` and published by a rename, so a reader sees the old table or the
    new one, and a run that is killed leaves the old one; what a run killed between its two renames moved aside is put back by the next
    call. ``single`` makes ``path`` one CSV file, streamed together from the sorted parts. ``mode`` is ``overwrite`` or
    ``errorifexists``; appending goes through Spark's own writer.
    """
    if mode not in ("overwrite", "errorifexists", "append") or (single and file_format != "csv"):
        raise ValueError("mode must be overwrite, errorifexists or append, and a single file is a CSV")
    order_by = order_by or (POINT_ID if POINT_ID in df.columns else None)
    spark = df.sparkSession
    if mode == "append":
        _save(df, path, file_format, mode, True)
        return
    target, files = _hadoop(spark, path)
    _put_back(spark, target, files)
    if mode == "errorifexists" and files.exists(target):
        raise FileExistsError(path)
    run = uuid.uuid4().hex
    draft, rows = _beside(spark, target, f"_draft-{run}"), _beside(spark, target, f"_rows-{run}")
    try:
        if order_by is not None:
            # Ranges are found from a sample of the rows: of written ones, or all that leads to them would run twice.
            df.write.parquet(rows.toString())
            written = spark.read.schema(df.schema).parquet(rows.toString())
            df = written.repartitionByRange(name(order_by)).sortWithinPartitions(name(order_by))
        _save(df, draft.toString(), file_format, "errorifexists", not single)
        if single:
            joined = _beside(spark, target, f"_joined-{run}")
            _join_parts(spark, files, df.columns, draft, joined)
            files.delete(draft, True)
            draft = joined
    except BaseException:
        files.delete(draft, True)
        raise
    finally:
        files.delete(rows, True)
    aside = _beside(spark, target, f"_old-{run}")
    if files.exists(target):
        files.rename(target, aside)
    if not files.rename(draft, target):
        raise OSError(f"{path}: the new table could not be moved to its place")
    files.delete(aside, True)


def _save(df: DataFrame, path: str, file_format: str, mode: str, header: bool) -> None:
    writer = df.write.mode(mode)
    if file_format == "csv":
        writer.option("header", header).option("encoding", "UTF-8").csv(path)
    else:
        writer.format(file_format).save(path)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(target), files


def _beside(spark: SparkSession, target, suffix: str):
    return spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}{suffix}")


def _put_back(spark: SparkSession, target, files) -> None:
    """The table that a run moved aside and could not replace."""
    if files.exists(target) or not files.exists(target.getParent()):
        return
    for status in files.listStatus(target.getParent()):
        if status.getPath().getName().startswith(f".{target.getName()}_old-"):
            files.rename(status.getPath(), target)
            return


def _join_parts(spark: SparkSession, files, columns: list[str], folder, out_path) -> None:
    """One file from a header and the parts in order; bytes are streamed, a part at a time."""
    header = ",".join(f'"{c.replace(chr(34), chr(34) * 2)}"' if any(x in c for x in ',"\n') else c for c in columns)
    out = files.create(out_path)
    try:
        out.write(bytearray((header + "\n").encode()))
        for status in sorted(files.listStatus(folder), key=lambda s: s.getPath().getName()):
            if status.getPath().getName().startswith("part-"):
                part = files.open(status.getPath())
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                finally:
                    part.close()
    finally:
        out.close()


__all__ = [
    "LINE", "POINT", "POLYGON", "ingest_layer", "read_layer", "read_table", "within_box", "write_table",
]
