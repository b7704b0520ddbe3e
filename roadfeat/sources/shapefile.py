"""Shapefiles as a Spark data source.

Tasks read ranges of records, cut by the bytes that the ``.shx`` index gives them, and decode only what is
asked for: records whose own box meets the conditions that Catalyst pushes on ``xmin, ymin, xmax, ymax`` (``x, y`` for
points), and the columns that the read names. Files whose header box is out of reach are not opened
further. Rows leave as Arrow batches. Paths may be local or any URI that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from roadfeat.functions.crs import WGS84, Crs, crs_from_wkt, datum, projection

RECORD_NUMBER = "record_number"
SOURCE_FILE = "source_file"
BOX = ("xmin", "ymin", "xmax", "ymax")
PUSH_CONF = "spark.sql.python.filterPushdown.enabled"
# Bytes of shapes that a task reads, and of those that it holds and decodes at once; files of one task at most.
BYTES_PER_TASK, BYTES_AT_ONCE, FILES_PER_TASK = 64 << 20, 8 << 20, 500
# Bytes of shapes in a written file, and rows that are encoded at once.
BYTES_PER_FILE, ROWS_AT_ONCE = 8 << 20, 1_000
# Entries of an index read at once while ranges are cut.
INDEX_AT_ONCE = 1 << 17

# Shape type codes by geometry, without the Z and M variants' offsets (10, 20).
POINT_SHAPE, LINE_SHAPE, POLYGON_SHAPE, MULTIPOINT_SHAPE = 1, 3, 5, 8
# Bytes of a file's header, of a record's header, and of a line record before its parts.
FILE_HEADER, RECORD_HEADER, LINE_HEADER = 100, 8, 44

VERTEX = StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])
PARTS = ArrayType(ArrayType(VERTEX))


def _open(path: str):
    path = re.sub(r"^file:/+", "/", path)
    if "://" in path:
        fs, inner = pafs.FileSystem.from_uri(path)
    else:
        fs, inner = pafs.LocalFileSystem(), os.path.abspath(path)
    return fs, inner


def is_file(path: str) -> bool:
    fs, inner = _open(path)
    return fs.get_file_info(inner).type == pafs.FileType.File


def _read(path: str, start: int = 0, length: int | None = None) -> bytes:
    fs, inner = _open(path)
    with fs.open_input_file(inner) as f:
        if length is None:
            return f.readall()
        f.seek(start)
        return f.read(length)


def _sibling(path: str, extension: str) -> str:
    stem = path[: -len(".shp")]
    for candidate in (stem + extension, stem + extension.upper()):
        if is_file(candidate):
            return candidate
    raise FileNotFoundError(stem + extension)


@dataclass(frozen=True)
class DbfField:
    name: str
    kind: str
    offset: int
    width: int
    decimals: int

    @property
    def is_number(self) -> bool:
        return self.kind in "NFIOB"


@dataclass(frozen=True)
class DbfHeader:
    header_bytes: int
    row_bytes: int
    fields: tuple[DbfField, ...]


def read_dbf_header(path: str, encoding: str) -> DbfHeader:
    head = _read(path, 0, 32)
    header_bytes, row_bytes = struct.unpack_from("<HH", head, 8)
    table = _read(path, 32, header_bytes - 32)
    fields, offset = [], 1
    for at in range(0, len(table) - 31, 32):
        if table[at] == 0x0D:
            break
        label = table[at : at + 11].split(b"\0", 1)[0].decode(encoding, "replace")
        kind, width, decimals = chr(table[at + 11]), table[at + 16], table[at + 17]
        fields.append(DbfField(label, kind, offset, width, decimals))
        offset += width
    return DbfHeader(header_bytes, row_bytes, tuple(fields))


def prj_of_shapefile(path: str) -> str | None:
    """The text of the ``.prj`` next to a shapefile."""
    try:
        return _read(_sibling(path, ".prj")).decode("utf-8", "replace").strip("\ufeff \r\n") or None
    except FileNotFoundError:
        return None


def crs_of_shapefile(path: str) -> Crs | None:
    """The system that the ``.prj`` next to a shapefile describes; None without one."""
    return crs_of_text(prj_of_shapefile(path), path)


def crs_of_text(text: str | None, path: str) -> Crs | None:
    try:
        return None if text is None else crs_from_wkt(text)
    except ValueError as e:
        raise ValueError(f"{path}: coordinate system of the .prj file is not supported: {e}") from None


def prj_text(code: Crs) -> str:
    """The ``.prj`` text of a system."""
    plane = projection(code)
    base = datum(code)
    e = base.ellipsoid
    name, shift = ("D_WGS_1984", "") if base == WGS84 else ("Other", f",TOWGS84[{','.join(map(repr, base.shift))}]")
    geographic = (
        f'GEOGCS["Base",DATUM["{name}",SPHEROID["Ellipsoid",{e.semi_major!r},{e.inverse_flattening!r}]{shift}],'
        'PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
    )
    if plane is None:
        return geographic
    named = {
        "False_Easting": plane.false_easting, "False_Northing": plane.false_northing, "Central_Meridian": plane.lon0,
        "Scale_Factor": plane.scale, "Latitude_Of_Origin": plane.lat0,
    }
    listed = ",".join(f'PARAMETER["{k}",{v!r}]' for k, v in named.items())
    return f'PROJCS["Plane",{geographic},PROJECTION["Transverse_Mercator"],{listed},UNIT["Meter",1.0]]'


def _gather(data: np.ndarray, at: np.ndarray, width: int, kind: str) -> np.ndarray:
    """One row of ``kind`` values for each offset; the bytes need no alignment."""
    found = data[at[:, None] + np.arange(width)]
    return np.ascontiguousarray(found).view(kind)


def shape_codes(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Shape type of each record without the Z and M offsets; 0 for records too short to have one."""
    codes = np.zeros(len(at), np.int32)
    long_enough = size >= 4
    codes[long_enough] = _gather(data, at[long_enough], 4, "<i4")[:, 0] % 10
    return codes


def decode_points(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    xy = _gather(data, at + 4, 16, "<f8")
    return xy[:, 0], xy[:, 1]


def _box_of(data: np.ndarray, at: int) -> tuple[float, ...]:
    parts, points = np.frombuffer(data, "<i4", 2, at + 36).tolist()
    xy = np.frombuffer(data, "<f8", 2 * points, at + LINE_HEADER + 4 * parts).reshape(-1, 2)
    return (*xy.min(axis=0), *xy.max(axis=0)) if points else (np.nan,) * 4


def decode_parts(data: np.ndarray, at: np.ndarray, known: np.ndarray) -> pa.Array:
    """Line parts or rings of the records; null where ``known`` is false."""
    where = at[known]
    counts = _gather(data, where + 36, 8, "<i4").astype(np.int64) if len(where) else np.zeros((0, 2), np.int64)
    n_parts, n_points = counts[:, 0], counts[:, 1]
    starts, flat = [], []
    before = 0
    for offset, parts, points in zip(where.tolist(), n_parts.tolist(), n_points.tolist(), strict=True):
        first = offset + LINE_HEADER
        starts.append(np.frombuffer(data, "<i4", parts, first) + before)
        flat.append(np.frombuffer(data, "<f8", 2 * points, first + 4 * parts))
        before += points
    vertices = np.concatenate(flat).reshape(-1, 2) if flat else np.zeros((0, 2))
    ends = np.append(np.concatenate(starts) if starts else np.zeros(0), before).astype(np.int32)
    xy = pa.StructArray.from_arrays([pa.array(vertices[:, 0]), pa.array(vertices[:, 1])], ["x", "y"])
    per_record = np.zeros(len(at), np.int64)
    per_record[known] = n_parts
    offsets = pa.array(np.append(0, np.cumsum(per_record)).astype(np.int32), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), xy), mask=pa.array(~known))


_WHOLE, _DECIMAL = re.compile(r"[+-]?[0-9]{1,18}"), re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")


def decode_column(rows: np.ndarray, field: DbfField, encoding: str, kind: DataType) -> pa.Array:
    """One attribute of the rows as ``kind``, the type that the column has over all files; blank and bad values are null."""
    raw = np.ascontiguousarray(rows[:, field.offset : field.offset + field.width]).view(f"S{field.width}")[:, 0]
    texts = [v.decode(encoding, "replace").strip("\0 ") for v in raw.tolist()]
    if not field.is_number or isinstance(kind, StringType):
        return pa.array([t or None for t in texts], pa.string())
    if isinstance(kind, DoubleType):
        return pa.array([float(t) if _DECIMAL.fullmatch(t) else None for t in texts], pa.float64())

    def whole(text: str) -> int | None:
        if _WHOLE.fullmatch(text):
            return int(text)
        value = float(text) if _DECIMAL.fullmatch(text) else 0.5
        return int(value) if value.is_integer() and abs(value) < 1e18 else None

    return pa.array([whole(t) for t in texts], pa.int64())


@dataclass
class RecordRanges(InputPartition):
    """``ranges``: (file, first record, number of records); a negative number stands for all records from the first."""

    ranges: list[tuple[str, int, int]]


@dataclass(frozen=True)
class Bound:
    """A pushed condition: ``column`` at least or at most ``value``, or beyond it if ``strict``; no value: not null."""

    column: str
    at_least: bool = True
    value: float | None = None
    strict: bool = False

    def holds(self, values: np.ndarray) -> np.ndarray:
        """Like Spark, NaN is greater than any number."""
        if self.value is None:
            return np.ones(len(values), bool)
        greater = np.isnan(values) | ((values > self.value) if self.strict else (values >= self.value))
        return greater if self.at_least else ((values < self.value) if self.strict else (values <= self.value))


class ShapefileReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema = schema
        self.paths = options["paths"].split("\n")
        self.kind = options["kind"]
        self.encoding = options.get("encoding", "utf-8")
        self.bytes_per_task = int(options.get("bytespertask", options.get("bytesPerTask", BYTES_PER_TASK)))
        self.bounds: list[Bound] = []

    def partitions(self):
        """Small files share a task; large ones are cut where the index says that a task's bytes end."""
        tasks, held, size = [], [], 0
        for path in self.paths:
            fs, inner = _open(path)
            bytes_ = fs.get_file_info(inner).size
            if bytes_ > self.bytes_per_task:
                tasks += [[r] for r in self._cut(path)]
                continue
            if held and (size + bytes_ > self.bytes_per_task or len(held) == FILES_PER_TASK):
                tasks.append(held)
                held, size = [], 0
            held.append((path, 0, -1))
            size += bytes_
        return [RecordRanges(r) for r in [*tasks, held] if r] or [RecordRanges([])]

    def _cut(self, path: str) -> list[tuple[str, int, int]]:
        index = _sibling(path, ".shx")
        fs, inner = _open(index)
        records = (fs.get_file_info(inner).size - FILE_HEADER) // 8
        ranges, first, room = [], 0, self.bytes_per_task
        for low in range(0, records, INDEX_AT_ONCE):
            words = _read_index(index, low, min(INDEX_AT_ONCE, records - low))[:, 1]
            for i, size in enumerate((words * 2 + RECORD_HEADER).tolist(), low):
                if size > room and i > first:
                    ranges.append((path, first, i - first))
                    first, room = i, self.bytes_per_task
                room -= size
        return [*ranges, (path, first, records - first)] if records > first else ranges

    def read(self, part: RecordRanges) -> Iterator[pa.RecordBatch]:
        for path, first, count in part.ranges:
            if self._in_reach(path):
                yield from self._read_range(path, first, count)

    def _in_reach(self, path: str) -> bool:
        """Whether any record of the file can meet the pushed bounds, by the box of the whole file."""
        box = dict(zip(BOX, struct.unpack("<4d", _read(path, 36, 32)), strict=True)) if self.bounds else {}
        box = {k: v for k, v in box.items() if v == v}
        if len(box) < 4 or not any(box.values()):
            return True  # unknown
        for b in self.bounds:
            axis = b.column[0]
            ends = np.array([box[f"{axis}max" if b.at_least else f"{axis}min"]])
            if b.value is not None and not b.holds(ends)[0]:
                return False
        return True

    def _read_range(self, path: str, first: int, count: int) -> Iterator[pa.RecordBatch]:
        index = _sibling(path, ".shx")
        if count < 0:
            fs, inner = _open(index)
            count = (fs.get_file_info(inner).size - FILE_HEADER) // 8 - first
        if count <= 0:
            return
        dbf_path = _sibling(path, ".dbf")
        header = read_dbf_header(dbf_path, self.encoding)
        places = _read_index(index, first, count)
        for low, high in _runs(places):
            begin, size = places[low:high, 0] * 2 + RECORD_HEADER, places[low:high, 1] * 2
            start = int(begin.min())
            # Some zero bytes, so that headers can be gathered of short records too.
            data = np.frombuffer(_read(path, start, int((begin + size).max()) - start) + bytes(64), np.uint8)
            rows = _read(dbf_path, header.header_bytes + header.row_bytes * (first + low), header.row_bytes * (high - low))
            table = np.frombuffer(rows.ljust(header.row_bytes * (high - low)), np.uint8).reshape(high - low, header.row_bytes)
            yield self._batch(path, header, data, begin - start, size, table, first + low)

    def _batch(self, path: str, header: DbfHeader, data, at, size, table, first: int) -> pa.RecordBatch:
        codes = shape_codes(data, at, size)
        known = codes == {"point": POINT_SHAPE, "line": LINE_SHAPE, "polygon": POLYGON_SHAPE}[self.kind]
        places: dict[str, np.ndarray] = {}
        if self.kind == "point":
            places["x"], places["y"] = decode_points(data, at)
        else:
            boxes = _gather(data, at + 4, 32, "<f8")
            # Some writers leave the box of a record empty.
            for i in np.flatnonzero(known & ~boxes.any(axis=1)).tolist():
                boxes[i] = _box_of(data, int(at[i]))
            places.update({c: boxes[:, i] for i, c in enumerate(BOX)})
        keep = table[:, 0] != ord("*")  # deleted
        for bound in self.bounds:
            keep &= known & bound.holds(places[bound.column])
        at, known, table, numbers = at[keep], known[keep], table[keep], np.flatnonzero(keep) + first
        fields = {f.name: f for f in header.fields}

        def column(f: StructField) -> pa.Array:
            if f.name == RECORD_NUMBER:
                return pa.array(numbers, pa.int64())
            if f.name == SOURCE_FILE:
                return pa.array([path] * len(numbers), pa.string())
            if f.name in places:
                return pa.array(places[f.name][keep], mask=~known)
            if f.name == "parts" and self.kind != "point":
                return decode_parts(data, at, known)
            if f.name not in fields:
                return pa.nulls(len(numbers), {StringType(): pa.string(), LongType(): pa.int64()}.get(f.dataType, pa.float64()))
            return decode_column(table, fields[f.name], self.encoding, f.dataType)

        return pa.RecordBatch.from_arrays([column(f) for f in self.schema.fields], [f.name for f in self.schema.fields])


class PushingReader(ShapefileReader):
    """The reader where Spark may push conditions; bounds on the place are met while records are chosen."""

    def pushFilters(self, filters):  # noqa: N802
        kinds = {GreaterThanOrEqual: (True, False), GreaterThan: (True, True), LessThanOrEqual: (False, False), LessThan: (False, True)}
        columns = ("x", "y") if self.kind == "point" else BOX
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in columns and type(f) is IsNotNull:
                self.bounds.append(Bound(name))
            elif name in columns and type(f) in kinds:
                self.bounds.append(Bound(name, kinds[type(f)][0], float(f.value), kinds[type(f)][1]))
            else:
                yield f


def _read_index(path: str, first: int, count: int) -> np.ndarray:
    """Offset and length of records, both in 16-bit words."""
    return np.frombuffer(_read(path, FILE_HEADER + 8 * first, 8 * count), ">i4").reshape(-1, 2).astype(np.int64)


def _runs(places: np.ndarray):
    """Consecutive records, cut so that the bytes from first to last stay about ``BYTES_AT_ONCE``."""
    offsets, low = np.asarray(places)[:, 0], 0
    while low < len(offsets):
        far = np.abs(offsets[low:] - offsets[low]) * 2 > BYTES_AT_ONCE
        high = low + int(far.argmax()) if far.any() else len(offsets)
        yield low, high
        low = high


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class ShapefileWriter(DataSourceArrowWriter):
    """Shapefiles of bounded size, at least one for each task with rows; files get their names only when all tasks are done."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool) -> None:
        self.kind, self.path, self.prj = options["kind"], options["path"].rstrip("/"), options.get("prj", "")
        self.encoding = options.get("encoding", "utf-8")
        self.bytes_per_file = int(options.get("bytesperfile", options.get("bytesPerFile", BYTES_PER_FILE)))
        place = ("x", "y") if self.kind == "point" else ("parts",)
        self.attributes = [f for f in schema.fields if f.name not in (*place, *BOX)]
        self.overwrite, self.run = overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        task = f"{self.path}/_{self.run}-{context.partitionId()}-{context.attemptNumber()}"
        stems: list[str] = []
        bodies: list[bytes] = []
        values: list[list[str]] = [[] for _ in self.attributes]
        size = 0

        def close() -> None:
            stems.append(f"{task}-{len(stems)}")
            self._write_file(stems[-1], bodies, values)
            for held in (bodies, *values):
                held.clear()

        for whole in iterator:
            for low in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(low, ROWS_AT_ONCE)
                shapes = zip(batch["x"].to_pylist(), batch["y"].to_pylist()) if self.kind == "point" else batch["parts"].to_pylist()
                made = [encode_shape(s, self.kind) for s in shapes]
                for kept, f in zip(values, self.attributes, strict=True):
                    kept += ["" if v is None else str(v) for v in batch[f.name].to_pylist()]
                bodies += made
                size += sum(map(len, made))
                if size >= self.bytes_per_file:
                    close()
                    size = 0
        if bodies:
            close()
        return Written(stems)

    def _write_file(self, stem: str, bodies: list[bytes], values: list[list[str]]) -> None:
        files = shapefile_bytes(bodies, [f.name for f in self.attributes], [f.dataType for f in self.attributes], values, self.kind, self.encoding)
        fs, folder = _open(self.path)
        fs.create_dir(folder, recursive=True)
        for extension, content in {**files, ".prj": self.prj.encode()}.items():
            if content:
                fs, inner = _open(stem + extension)
                with fs.open_output_stream(inner) as out:
                    out.write(content)

    def commit(self, messages) -> None:  # noqa: ANN001
        fs, folder = _open(self.path)
        fs.create_dir(folder, recursive=True)
        listed = fs.get_file_info(pafs.FileSelector(folder)) if self.overwrite else []
        old = [i.path for i in listed if not i.base_name.startswith("_")]
        for stem in [s for m in messages if m for s in m.files]:
            # The main file last: a folder is read by these.
            for extension in (".shx", ".dbf", ".prj", ".shp"):
                fs, inner = _open(stem + extension)
                if fs.get_file_info(inner).type == pafs.FileType.File:
                    fs.move(inner, "/part-".join(inner.rsplit("/_", 1)))
        for path in old:
            fs.delete_file(path)
        self._clear()

    def abort(self, messages) -> None:  # noqa: ANN001
        self._clear()

    def _clear(self) -> None:
        fs, folder = _open(self.path)
        for i in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if i.base_name.startswith(f"_{self.run}"):
                fs.delete_file(i.path)


def encode_shape(shape, kind: str) -> bytes:  # noqa: ANN001
    """A record's content; the null shape for a missing geometry."""
    if kind == "point":
        return struct.pack("<i", 0) if None in shape else struct.pack("<i2d", POINT_SHAPE, *shape)
    if not shape or not any(shape):
        return struct.pack("<i", 0)
    flat = np.array([(v["x"], v["y"]) for part in shape for v in part])
    starts = np.cumsum([0, *[len(part) for part in shape[:-1]]]).astype("<i4")
    code = LINE_SHAPE if kind == "line" else POLYGON_SHAPE
    box = (*flat.min(axis=0), *flat.max(axis=0))
    return struct.pack("<i4d2i", code, *box, len(shape), len(flat)) + starts.tobytes() + flat.astype("<f8").tobytes()


def shapefile_bytes(bodies, names, types, values, kind: str, encoding: str) -> dict[str, bytes]:  # noqa: ANN001
    """The main file, the index and the table of encoded records. Texts are cut at 254 bytes, names at 10: the format's limits."""
    code = {"point": POINT_SHAPE, "line": LINE_SHAPE, "polygon": POLYGON_SHAPE}[kind]
    # Points are boxes too: of one place.
    whole = [b[4:20] * 2 if code == POINT_SHAPE else b[4:36] for b in bodies if len(b) > 4]
    boxes = np.frombuffer(b"".join(whole), "<f8").reshape(-1, 4)
    extent = (*boxes[:, :2].min(axis=0), *boxes[:, 2:].max(axis=0)) if len(boxes) else (0.0,) * 4

    def head(size: int) -> bytes:
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i8d", 1000, code, *extent, 0, 0, 0, 0)

    main, index, at = [], [], FILE_HEADER
    for i, body in enumerate(bodies, 1):
        index.append(struct.pack(">2i", at // 2, len(body) // 2))
        main += [struct.pack(">2i", i, len(body) // 2), body]
        at += RECORD_HEADER + len(body)
    fields, columns = [], []
    for name, kind_, texts in zip(names, types, values, strict=True):
        raw = [t.encode(encoding, "replace")[:254] for t in texts]
        width = max(1, *map(len, raw)) if raw else 1
        letter = b"C" if isinstance(kind_, StringType) else b"N"
        decimals = 0 if letter == b"C" or isinstance(kind_, LongType) else min(15, max(0, width - 2))
        fields.append(name.encode(encoding)[:10].ljust(11, b"\0") + letter + bytes(4) + bytes([width, decimals]) + bytes(14))
        columns.append([r.ljust(width) for r in raw])
    rows = b"".join(b" " + b"".join(cells) for cells in (zip(*columns, strict=True) if columns else [()] * len(bodies)))
    width = 1 + sum(len(c[0]) for c in columns)
    table = struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(bodies), 33 + 32 * len(fields), width) + b"".join(fields) + b"\r" + rows
    return {".shp": head(at) + b"".join(main), ".shx": head(FILE_HEADER + 8 * len(bodies)) + b"".join(index), ".dbf": table}


def write_shapefiles(df: DataFrame, path: str, kind: str, crs: Crs | None = None, encoding: str = "utf-8", mode: str = "errorifexists") -> None:
    """Write a layer's rows as a folder of shapefiles, some for each task: ``x, y`` or ``parts``, and the attributes."""
    fs, inner = _open(path)
    if mode == "errorifexists" and fs.get_file_info(inner).type != pafs.FileType.NotFound:
        raise FileExistsError(path)
    df.sparkSession.dataSource.register(ShapefileSource)
    options = {"kind": kind, "encoding": encoding, "prj": prj_text(crs) if crs is not None else ""}
    df.write.format(ShapefileSource.name()).options(**options).mode("overwrite" if mode == "overwrite" else "append").save(path)


class ShapefileSource(DataSource):
    """``spark.read.format("roadfeat_shapefile")``: options ``paths``, ``kind``, ``encoding``, ``columns``, ``push``.

    Writing makes a folder with shapefiles of bounded size; options ``kind``, ``encoding``, ``path``, ``prj``, ``bytesPerFile``.
    """

    @classmethod
    def name(cls) -> str:
        return "roadfeat_shapefile"

    def schema(self) -> StructType:
        columns = self.options.get("columns")
        headers = [
            read_dbf_header(_sibling(p, ".dbf"), self.options.get("encoding", "utf-8")) for p in self.options["paths"].split("\n")
        ]
        return shapefile_schema(headers, self.options["kind"], columns.split("\n") if columns is not None else None)

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = PushingReader if self.options.get("push") == "true" else ShapefileReader
        return kind(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> ShapefileWriter:
        return ShapefileWriter(schema, dict(self.options), overwrite)


def shapefile_schema(headers: Iterable[DbfHeader], kind: str, columns: Iterable[str] | None = None) -> StructType:
    types: dict[str, DataType] = {}
    for header in headers:
        for f in header.fields:
            types[f.name] = _wider(types.get(f.name), _own_type(f))
    return schema_of(types, kind, columns)


def schema_of(types: dict[str, DataType], kind: str, columns: Iterable[str] | None = None) -> StructType:
    """Record number, file, place (with the record's box, unless an attribute has one of its names) and attributes."""
    wanted = types if columns is None else {c: t for c, t in types.items() if c in set(columns)}
    fields = [StructField(RECORD_NUMBER, LongType()), StructField(SOURCE_FILE, StringType())]
    place = ("x", "y") if kind == "point" else ("parts", *BOX)
    fields += [StructField(c, PARTS if c == "parts" else DoubleType()) for c in place]
    return StructType(fields + [StructField(label, t) for label, t in wanted.items() if label not in (RECORD_NUMBER, SOURCE_FILE, *place)])


def _own_type(field: DbfField) -> DataType:
    if not field.is_number:
        return StringType()
    return LongType() if field.kind in "NFI" and field.decimals == 0 and field.width < 19 else DoubleType()


def _wider(a: DataType | None, b: DataType) -> DataType:
    """The type that holds the values of both: text holds any, double any number."""
    if a is None or a == b:
        return b
    return StringType() if StringType() in (a, b) else DoubleType()


def read_shapefile(
    spark: SparkSession,
    paths: str | list[str],
    kind: str,
    encoding: str = "utf-8",
    columns: Iterable[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The records of the files: attributes, geometry and its box, record number and file name.

    The columns are those of all headers, or of these the ones in ``columns``: one that only some files have is null in the
    others, and a column of several types takes the widest. Only headers are read to find them, unless ``schema`` says
    it all. Conditions on the box (on ``x, y`` of points) are met by the reader before it decodes a shape.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if schema is None:
        for path in paths:
            if not is_file(path):
                raise FileNotFoundError(path)
    spark.dataSource.register(ShapefileSource)
    options = {"paths": "\n".join(paths), "kind": kind, "encoding": encoding}
    if columns is not None:
        options["columns"] = "\n".join(columns)
    if spark.conf.get(PUSH_CONF, "false") == "true":
        options["push"] = "true"
    reader = spark.read.format(ShapefileSource.name()).options(**options)
    return (reader if schema is None else reader.schema(schema)).load()


_HEADER = "no long, path string, prj string, at int, field string, type string"


def header_rows(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """One row for each field of each file, read in tasks: file number, path, text of the coordinate system, place in the header, name and type.

    A file without fields has one row with a null name.
    """
    listed = spark.createDataFrame(list(enumerate(paths)), "no long, path string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for no, path in zip(batch["no"].to_pylist(), batch["path"].to_pylist(), strict=True):
                fields = [(f.name, _own_type(f).typeName()) for f in read_dbf_header(_sibling(path, ".dbf"), encoding).fields]
                prj = prj_of_shapefile(path)
                rows += [(no, path, prj, i, *f) for i, f in enumerate(fields or [(None, None)])]
            if rows:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]
                names = [f.split()[0] for f in _HEADER.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return listed.repartition(max(1, len(paths) // FILES_PER_TASK + 1), "no").mapInArrow(read, _HEADER)


def merged_schema(headers: DataFrame, kind: str, columns: Iterable[str] | None = None) -> StructType:
    """The schema over all files, merged by one aggregation; a field stands where the first file that has it has it."""
    rank = F.when(F.col("type") == "string", 2).when(F.col("type") == "double", 1).otherwise(0)
    merged = headers.where("field is not null").groupBy("field").agg(F.min(F.struct("no", "at")).alias("place"), F.max(rank).alias("rank"))
    types = {r["field"]: (LongType(), DoubleType(), StringType())[r["rank"]] for r in merged.orderBy("place").collect()}
    return schema_of(types, kind, columns)


def find_shapefiles(folder: str) -> list[str]:
    """All ``.shp`` files below a folder, sorted; none is no error, an absent folder is."""
    fs, inner = _open(folder)
    if fs.get_file_info(inner).type != pafs.FileType.Directory:
        raise FileNotFoundError(folder)
    found = fs.get_file_info(pafs.FileSelector(inner, recursive=True))
    paths = sorted(i.path for i in found if i.type == pafs.FileType.File and i.path.lower().endswith(".shp"))
    scheme = folder.split("://", 1)[0] + "://" if "://" in folder else ""
    return [scheme + p for p in paths]


__all__ = ["ShapefileSource", "crs_of_shapefile", "find_shapefiles", "read_shapefile", "write_shapefiles"]
