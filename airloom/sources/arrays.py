"""Gridded array files in the classic NetCDF format as a Spark source of cell rows.

``spark.read.format("grid_arrays").load(folder)`` plans one partition per file, variable and chunk
of time steps and latitudes, from the files' headers. Filters on ``variable``, ``time`` and
``lat`` decide which chunks are planned at all; Spark still applies them to the rows. Fill values
are null, scale and offset are applied. Coordinates are looked for under their usual names.

Only variables over (time, lat, lon) or (lat, lon) are cells; others are skipped, and so are files
without coordinates. ``skipped`` lists both with the reason.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta
from math import prod

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D

from airloom.sources.grids import LATITUDE_NAMES, LONGITUDE_NAMES

NAME = "grid_arrays"
SCHEMA = (
    "path string, time timestamp_ntz, cell_id long, lat double, lon double, variable string, "
    "long_name string, value double"
)
TIME_NAMES = ["time", "valid_time", "Time"]
#: Cells of a planned chunk.
CHUNK_CELLS = 1_000_000
#: Headers read at once while planning, and bytes tried first for each.
READERS = 16
HEADER_BYTES = 65_536

# Fixed values of the file format: tags and element types by number.
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
TYPES = dict(enumerate(["i1", "S1", ">i2", ">i4", ">f4", ">f8", "u1", ">u2", ">u4", ">i8", ">u8"], 1))
STREAMING = 0xFFFFFFFF
UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600, "day": 86400, "days": 86400}


@dataclass(frozen=True)
class Variable:
    name: str
    dims: tuple[int, ...]
    attributes: dict
    kind: str
    begin: int
    shape: tuple[int, ...]
    #: Bytes from one step of the first dimension to the next.
    stride: int

    @property
    def width(self) -> int:
        return np.dtype(self.kind).itemsize


class _Short(Exception):
    """The header is longer than the bytes at hand."""


class _Cursor:
    def __init__(self, data: bytes, version: int) -> None:
        self.data, self.at, self.wide = data, 4, version == 5
        self.offset = ">i" if version == 1 else ">q"

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise _Short
        out = self.data[self.at : self.at + n]
        self.at += n
        return out

    def number(self, form: str = ">I") -> int:
        return struct.unpack(form, self.take(struct.calcsize(form)))[0]

    def count(self) -> int:
        return self.number(">Q" if self.wide else ">I")

    def padded(self, n: int) -> bytes:
        out = self.take(n)
        self.take(-n % 4)
        return out

    def name(self) -> str:
        return self.padded(self.count()).decode()

    def entries(self, tag: int) -> int:
        """Length of a list that may be absent."""
        found, n = self.number(), self.count()
        if n and found != tag:
            raise ValueError("not a classic array file")
        return n

    def attributes(self) -> dict:
        out = {}
        for _ in range(self.entries(ATTRIBUTES)):
            name, kind = self.name(), TYPES[self.number()]
            n = self.count()
            raw = self.padded(n * np.dtype(kind).itemsize)
            values = np.frombuffer(raw, kind)
            out[name] = raw.decode(errors="replace").rstrip("\0") if kind == "S1" else values[0].item() if n else None
        return out


def parse_header(data: bytes, size: int) -> tuple[list[str], dict[str, Variable]]:
    """Dimension names and variables of a file of ``size`` bytes that begins with ``data``."""
    if data[:3] != b"CDF" or data[3] not in (1, 2, 5):
        raise ValueError("not a classic array file")
    c = _Cursor(data, data[3])
    records = c.count()
    dims = [(c.name(), c.count()) for _ in range(c.entries(DIMENSIONS))]
    unlimited = next((i for i, (_, n) in enumerate(dims) if n == 0), None)
    c.attributes()
    raw = []
    for _ in range(c.entries(VARIABLES)):
        name = c.name()
        own = tuple(c.count() for _ in range(c.count()))
        attributes, kind = c.attributes(), TYPES[c.number()]
        c.count()
        raw.append((name, own, attributes, kind, c.number(c.offset)))

    def step(own: Sequence[int], kind: str) -> int:
        return prod(dims[d][1] for d in own) * np.dtype(kind).itemsize

    of_records = [(own, kind) for _, own, _, kind, _ in raw if own and own[0] == unlimited]
    # A single record variable is not padded.
    sizes = [step(own[1:], kind) for own, kind in of_records]
    record = sizes[0] if len(sizes) == 1 else sum(n + -n % 4 for n in sizes)
    if records == STREAMING or records == (1 << 64) - 1:
        first = min((b for _, own, _, _, b in raw if own and own[0] == unlimited), default=size)
        records = (size - first) // record if record else 0
    out = {}
    for name, own, attributes, kind, begin in raw:
        grows = bool(own) and own[0] == unlimited
        shape = tuple(records if d == unlimited else dims[d][1] for d in own)
        stride = record if grows else step(own[1:], kind)
        out[name] = Variable(name, own, attributes, kind, begin, shape, stride)
    return [n for n, _ in dims], out


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def read_header(path: str) -> tuple[list[str], dict[str, Variable]]:
    system, name = _open(path)
    size = system.get_file_info(name).size
    with system.open_input_file(name) as file:
        n = HEADER_BYTES
        while True:
            try:
                return parse_header(file.read_at(min(n, size), 0), size)
            except _Short:
                if n >= size:
                    raise ValueError("header is cut off") from None
                n *= 4


def _values(file: pa.NativeFile, v: Variable, first: int, last: int, low: int = 0, high: int | None = None) -> np.ndarray:
    """Steps ``first`` to ``last`` of the first dimension, of each the rows ``low`` to ``high`` of
    the second, decoded; missing ones are NaN."""
    rest = v.shape[1:]
    row = prod(rest[1:]) * v.width
    a, b = (low * row, (rest[0] if high is None else high) * row) if rest else (0, v.width)
    raw = [file.read_at(b - a, v.begin + i * v.stride + a) for i in range(first, last)]
    stored = np.frombuffer(b"".join(raw), v.kind)
    out = stored.astype(float)
    for name in ("_FillValue", "missing_value"):
        if v.attributes.get(name) is not None:
            out[stored == np.array(v.attributes[name], v.kind)] = np.nan
    return out * v.attributes.get("scale_factor", 1) + v.attributes.get("add_offset", 0)


def decoded_times(values: np.ndarray, units: str) -> np.ndarray:
    """Times from numbers and ``<unit> since <moment>``."""
    unit, _, start = units.partition(" since ")
    moment = datetime(*map(int, re.findall(r"[0-9]+", start)[:6]))
    scale = UNITS[unit.strip().lower()]
    # To the microsecond: times stored as floats are not exact beyond.
    micros = np.round(values * scale * 1e6).astype(np.int64)
    return np.datetime64(moment, "us") + micros.astype("timedelta64[us]")


@dataclass(frozen=True)
class Chunk(D.InputPartition):
    path: str
    variable: Variable
    times: tuple | None
    lats: tuple[float, ...]
    lons: tuple[float, ...]
    first: int
    low: int

    def rows(self) -> pa.RecordBatch:
        v, steps = self.variable, len(self.times) if self.times else 1
        system, name = _open(self.path)
        height, width = len(self.lats), len(self.lons)
        with system.open_input_file(name) as file:
            if self.times:
                value = _values(file, v, self.first, self.first + steps, self.low, self.low + height)
            else:
                value = _values(file, v, self.low, self.low + height)
        n = steps * height * width
        cell = (np.arange(height)[:, None] + self.low) * width + np.arange(width)[None, :]
        moments = np.array(self.times or (None,), "datetime64[us]")
        gone = np.isnan(value)
        return pa.RecordBatch.from_arrays(
            [
                pa.repeat(self.path, n),
                pa.array(np.repeat(moments, height * width), pa.timestamp("us")),
                pa.array(np.tile(cell.ravel(), steps)),
                pa.array(np.tile(np.repeat(np.array(self.lats), width), steps)),
                pa.array(np.tile(np.tile(np.array(self.lons), height), steps)),
                pa.repeat(v.name, n),
                pa.repeat(pa.scalar(v.attributes.get("long_name"), pa.string()), n),
                pa.array(value, mask=gone),
            ],
            ["path", "time", "cell_id", "lat", "lon", "variable", "long_name", "value"],
        )


def plan_file(path: str, wanted: Wanted, chunk_cells: int) -> tuple[list[Chunk], list[tuple[str, str | None, str]]]:
    """Chunks of one file, and what is skipped: (path, variable or none, reason)."""
    try:
        dims, found = read_header(path)
    except ValueError as error:
        return [], [(path, None, str(error))]

    def axis(names: Sequence[str]) -> str | None:
        return next((n for n in names if n in found and len(found[n].dims) == 1), None)

    lat, lon, time = axis(LATITUDE_NAMES), axis(LONGITUDE_NAMES), axis(TIME_NAMES)
    if lat is None or lon is None:
        return [], [(path, None, "no coordinates")]
    chunks, skipped = [], []
    system, name = _open(path)
    with system.open_input_file(name) as file:
        lats, lons = (_values(file, found[n], 0, found[n].shape[0]) for n in (lat, lon))
        times = None
        if time is not None:
            own = found[time]
            times = decoded_times(_values(file, own, 0, own.shape[0]), own.attributes["units"]).astype(object)
    grid = (*found[lat].dims, *found[lon].dims)
    for v in found.values():
        if v.name in (lat, lon, time):
            continue
        timed = time is not None and v.dims == (*found[time].dims, *grid)
        if not timed and v.dims != grid:
            skipped.append((path, v.name, "not over time, latitude and longitude"))
            continue
        if not wanted.variable(v.name):
            continue
        rows = max(1, min(len(lats), chunk_cells // max(1, len(lons))))
        steps = max(1, chunk_cells // max(1, rows * len(lons)))
        for low in range(0, len(lats), rows):
            band = lats[low : low + rows]
            if not wanted.between("lat", band.min(), band.max()):
                continue
            for first in range(0, len(times) if timed else 1, steps):
                part = tuple(times[first : first + steps]) if timed else None
                if part and not wanted.between("time", min(part), max(part)):
                    continue
                chunks.append(Chunk(path, v, part, tuple(band.tolist()), tuple(lons.tolist()), first, low))
    return chunks, skipped


class Wanted:
    """What pushed filters leave possible."""

    def __init__(self, filters: Sequence[D.Filter] = ()) -> None:
        self.names: set[str] | None = None
        self.ranges: dict[str, tuple] = {}
        for f in filters:
            column = getattr(f, "attribute", (None,))[0]
            if column == "variable" and isinstance(f, (D.EqualTo, D.In)):
                own = {f.value} if isinstance(f, D.EqualTo) else set(f.value)
                self.names = own if self.names is None else self.names & own
            elif column in ("lat", "time") and isinstance(
                f, (D.EqualTo, D.GreaterThan, D.GreaterThanOrEqual, D.LessThan, D.LessThanOrEqual)
            ):
                low, high = self.ranges.get(column, (None, None))
                value = f.value.replace(tzinfo=None) if isinstance(f.value, datetime) else f.value
                if not isinstance(f, (D.LessThan, D.LessThanOrEqual)):
                    low = value if low is None else max(low, value)
                if not isinstance(f, (D.GreaterThan, D.GreaterThanOrEqual)):
                    high = value if high is None else min(high, value)
                self.ranges[column] = low, high

    def variable(self, name: str) -> bool:
        return self.names is None or name in self.names

    def between(self, column: str, least, most) -> bool:
        """Whether a chunk with values from ``least`` to ``most`` can hold wanted rows."""
        low, high = self.ranges.get(column, (None, None))
        return (low is None or most >= low) and (high is None or least <= high)


class _Reader(D.DataSourceReader):
    def __init__(self, folder: str, chunk_cells: int) -> None:
        self.folder, self.chunk_cells, self.wanted = folder, chunk_cells, Wanted()

    def pushFilters(self, filters: list[D.Filter]) -> Iterator[D.Filter]:
        self.wanted = Wanted(filters)
        # Chunks are coarser than rows, so Spark filters those as well.
        yield from filters

    def partitions(self) -> list[Chunk]:
        return [c for chunks, _ in _plans(self.folder, self.wanted, self.chunk_cells) for c in chunks]

    def read(self, partition: Chunk | None) -> Iterator[pa.RecordBatch]:
        # Where no chunk is planned Spark still reads once.
        if partition is not None:
            yield partition.rows()


def _plans(folder: str, wanted: Wanted, chunk_cells: int) -> list[tuple[list[Chunk], list]]:
    system, name = _open(folder)
    infos = system.get_file_info(fs.FileSelector(name, recursive=True))
    prefix = folder.split(name)[0] if name in folder else ""
    paths = sorted(prefix + i.path for i in infos if i.is_file and i.path.endswith(".nc"))
    with ThreadPoolExecutor(READERS) as pool:
        return list(pool.map(lambda p: plan_file(p, wanted, chunk_cells), paths))


class GridArrays(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("chunkCells", CHUNK_CELLS)))


def read_arrays(spark: SparkSession, folder: str, chunk_cells: int = CHUNK_CELLS) -> DataFrame:
    """Rows (path, time, cell_id, lat, lon, variable, long_name, value) of all files below a folder."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GridArrays)
    return spark.read.format(NAME).option("chunkCells", chunk_cells).load(folder)


def skipped(spark: SparkSession, folder: str) -> DataFrame:
    """Files and variables that are not read: (path, variable, reason)."""
    found = [s for _, skips in _plans(folder, Wanted(), CHUNK_CELLS) for s in skips]
    return spark.createDataFrame(found, "path string, variable string, reason string")


# Writing: one file per group of rows, for tests and exchange.

_KIND_NUMBER = {"S1": 2, ">i2": 3, ">f8": 6}


def _packed_name(text: str) -> bytes:
    raw = text.encode()
    return struct.pack(">I", len(raw)) + raw + b"\0" * (-len(raw) % 4)


def _packed_attributes(attributes: dict) -> bytes:
    out = [struct.pack(">II", ATTRIBUTES if attributes else 0, len(attributes))]
    for name, value in attributes.items():
        if isinstance(value, str):
            raw = value.encode()
            body = struct.pack(">II", 2, len(raw)) + raw
        elif isinstance(value, int):
            body = struct.pack(">II", 3, 1) + struct.pack(">h", value)
        else:
            body = struct.pack(">II", 6, 1) + struct.pack(">d", value)
        out.append(_packed_name(name) + body + b"\0" * (-len(body) % 4))
    return b"".join(out)


def encode_file(
    times: np.ndarray, start: datetime, lats: np.ndarray, lons: np.ndarray, cells: dict[str, tuple[np.ndarray, dict]]
) -> bytes:
    """A file with an unlimited time axis in hours since ``start``; cells by variable as arrays
    (time, lat, lon) in their stored kind, with attributes."""
    dims = [("time", 0), ("latitude", len(lats)), ("longitude", len(lons))]
    given = [
        ("latitude", (1,), {"units": "degrees_north"}, lats.astype(">f8")),
        ("longitude", (2,), {"units": "degrees_east"}, lons.astype(">f8")),
        ("time", (0,), {"units": f"hours since {start:%Y-%m-%d %H:%M:%S}"}, times.astype(">f8")),
        *((n, (0, 1, 2), attributes, values) for n, (values, attributes) in cells.items()),
    ]

    def size(own: tuple[int, ...], kind: np.dtype) -> int:
        n = prod(dims[d][1] for d in own if d) * kind.itemsize
        return n + -n % 4

    def header(begins: list[int]) -> bytes:
        out = [b"CDF\x02", struct.pack(">I", len(times)), struct.pack(">II", DIMENSIONS, len(dims))]
        out += [_packed_name(n) + struct.pack(">I", k) for n, k in dims]
        out += [_packed_attributes({}), struct.pack(">II", VARIABLES, len(given))]
        for (name, own, attributes, values), begin in zip(given, begins, strict=True):
            out.append(_packed_name(name) + struct.pack(f">I{len(own)}I", len(own), *own) + _packed_attributes(attributes))
            out.append(struct.pack(">IIq", _KIND_NUMBER[values.dtype.str], size(own, values.dtype), begin))
        return b"".join(out)

    at, begins = len(header([0] * len(given))), []
    for _, own, _, values in given:
        begins.append(at)
        at += size(own, values.dtype)
    out = [header(begins)]
    out += [values.tobytes() for _, own, _, values in given if own[0] != 0]
    for t in range(len(times)):
        for _, own, _, values in given:
            if own[0] == 0:
                raw = values[t : t + 1].tobytes()
                out.append(raw + b"\0" * (-len(raw) % 4))
    return b"".join(out)


def write_arrays(
    df: DataFrame, folder: str, name: str, lats: Sequence[float], lons: Sequence[float], long_names: dict[str, str] | None = None
) -> DataFrame:
    """One file per value of column ``name`` from rows (time, lat, lon, variable, value); rows
    (path, bytes). A group is one file, so it has to fit a task. A repeated run replaces a file."""
    labels = long_names or {}

    def write(group: pa.Table) -> pa.Table:
        rows = group.to_pandas()
        start = rows["time"].min().to_pydatetime().replace(minute=0, second=0, microsecond=0)
        hours = (rows["time"] - start) / timedelta(hours=1)
        axis = np.array(sorted(set(hours)))
        t, y, x = (np.searchsorted(a, v) for a, v in ((axis, hours), (np.array(lats), rows["lat"]), (np.array(lons), rows["lon"])))
        cells = {}
        for variable in sorted(set(rows["variable"])):
            own = (rows["variable"] == variable).to_numpy()
            grid = np.full((len(axis), len(lats), len(lons)), -9999.0)
            grid[t[own], y[own], x[own]] = rows["value"][own].fillna(-9999.0)
            cells[variable] = grid.astype(">f8"), {"_FillValue": -9999.0, "long_name": labels.get(variable, variable)}
        data = encode_file(axis, start, np.array(lats), np.array(lons), cells)
        path = f"{folder}/{rows[name][0]}.nc"
        system, at = _open(path)
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(at) as out:
            out.write(data)
        return pa.table({"path": [path], "bytes": pa.array([len(data)], pa.int64())})

    return df.groupBy(name).applyInArrow(write, "path string, bytes long")
