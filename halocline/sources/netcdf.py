"""NetCDF as a Spark source and sink.

A scan is planned in two stages.  The driver lists names; tasks read the headers and
return runs of time steps with their bounds of time and depth (``chunk_index``).  Filters
then leave out whole runs, and what is left is dealt to tasks of about equal size.  A task
holds one slab of one step at a time and reads only the levels it needs.  Classic files
(CDF-1, -2 and -5) are decoded here; HDF5-based files need the netCDF4 package on the
executors.  Axes are found by name and by what their attributes say (``schema.EVIDENCE``).

Writing (``FieldWriter``) assembles one file for each dataset and span in a task, in a
staging folder; the driver's commit moves all files to their names, an abort removes them.
"""

from __future__ import annotations

import base64
import glob
import json
import mmap
import operator
import os
import re
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field as dc_field
from datetime import date, datetime, timedelta
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from halocline.schema import FILL_VALUE, STALE_ATTRS, best_axis, column_attrs, main_variable, resolve_alias

SCHEMA = (
    "path string, var string, time timestamp_ntz, raw_time double, step int, n_steps int, "
    "lev double, lev_idx int, iy int, ix int, lat double, lon double, value double"
)
# Fixed by the file format: external type code -> big-endian numpy type.
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8",
         7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
SLAB = 262_144
TASK_ROWS = 4_000_000
CALENDAR_DAYS = {"noleap": 365, "365_day": 365, "all_leap": 366, "366_day": 366, "360_day": 360}
UNIT_SECONDS = {"day": 86400.0, "hour": 3600.0, "minute": 60.0, "min": 60.0, "second": 1.0, "sec": 1.0,
                "d": 86400.0, "h": 3600.0, "hr": 3600.0, "s": 1.0}


# ---- classic header --------------------------------------------------------
@dataclass
class Variable:
    dims: tuple[str, ...]
    shape: tuple[int, ...]
    dtype: str
    begin: int
    attrs: dict[str, Any]
    stride: int | None  # bytes between records; None for fixed-size variables


@dataclass
class Classic:
    """The header of a classic file and reads of whole variables or single steps."""

    path: str
    dims: dict[str, int] = dc_field(default_factory=dict)
    attrs: dict[str, Any] = dc_field(default_factory=dict)
    variables: dict[str, Variable] = dc_field(default_factory=dict)

    def __post_init__(self) -> None:
        with open(self.path, "rb") as f:
            magic = f.read(4)
            if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
                raise ValueError(f"{self.path} is not a classic netCDF file")
            wide = magic[3] == 5
            size = lambda: struct.unpack(">q" if wide else ">i", f.read(8 if wide else 4))[0]
            offset = lambda: struct.unpack(">i" if magic[3] == 1 else ">q", f.read(4 if magic[3] == 1 else 8))[0]
            code = lambda: struct.unpack(">i", f.read(4))[0]

            def text() -> str:
                n = size()
                raw = f.read(n + (-n) % 4)
                return raw[:n].decode("utf-8")

            def attributes() -> dict[str, Any]:
                code()
                out = {}
                for _ in range(size()):
                    name, kind, n = text(), code(), size()
                    width = n * np.dtype(TYPES[kind]).itemsize
                    raw = f.read(width + (-width) % 4)[:width]
                    values = raw.decode("utf-8", "replace") if kind == 2 else np.frombuffer(raw, TYPES[kind])
                    out[name] = values if kind == 2 or len(values) != 1 else values[0].item()
                return out

            steps = size()
            code()
            order = [(text(), size()) for _ in range(size())]
            self.dims = {n: (steps if length == 0 else length) for n, length in order}
            record = {n for n, length in order if length == 0}
            self.attrs = attributes()
            code()
            sizes = []
            for _ in range(size()):
                name = text()
                dims = tuple(order[size()][0] for _ in range(size()))
                attrs, kind, vsize, begin = attributes(), code(), size(), offset()
                per_record = bool(dims) and dims[0] in record
                self.variables[name] = Variable(
                    dims, tuple(self.dims[d] for d in dims), TYPES[kind], begin, attrs, -1 if per_record else None)
                if per_record:
                    shape = tuple(self.dims[d] for d in dims[1:])
                    sizes.append(int(np.prod(shape, dtype=np.int64)) * np.dtype(TYPES[kind]).itemsize)
            # A lone record variable is packed; several are padded to 4 bytes.
            stride = sizes[0] if len(sizes) == 1 else sum(n + (-n) % 4 for n in sizes)
            for v in self.variables.values():
                if v.stride is not None:
                    v.stride = stride

    def read(self, name: str, step: int | None = None, levels: tuple[int, int] | None = None) -> np.ndarray:
        """A whole variable, its slice at one position of the leading dimension, or some of that slice's leading rows."""
        v = self.variables[name]
        shape = v.shape if step is None else v.shape[1:]
        width = np.dtype(v.dtype).itemsize
        if v.stride is not None and step is None:
            return self.records(name, 0, v.shape[0])
        row = int(np.prod(v.shape[1:], dtype=np.int64)) * width
        at = v.begin if step is None else v.begin + step * (v.stride if v.stride is not None else row)
        if levels is not None:
            at += levels[0] * int(np.prod(shape[1:], dtype=np.int64)) * width
            shape = (levels[1] - levels[0], *shape[1:])
        count = int(np.prod(shape, dtype=np.int64))
        with open(self.path, "rb") as f:
            f.seek(at)
            return np.frombuffer(f.read(count * width), v.dtype).reshape(shape)

    def records(self, name: str, first: int, last: int) -> np.ndarray:
        """Positions ``first`` to ``last`` of the leading dimension, records picked out of the mapped file."""
        v = self.variables[name]
        form = np.dtype(v.dtype)
        inner = int(np.prod(v.shape[1:], dtype=np.int64))
        step = v.stride if v.stride is not None else inner * form.itemsize
        if last <= first or inner == 0:
            return np.empty((max(last - first, 0), *v.shape[1:]), form)
        with open(self.path, "rb") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as m:
            rows = np.ndarray((last - first, inner), form, m, v.begin + first * step, (step, form.itemsize)).copy()
        return rows.reshape(last - first, *v.shape[1:])


class Library:
    """The same reads through the optional netCDF4 package, for HDF5-based files."""

    def __init__(self, path: str) -> None:
        try:
            import netCDF4
        except ImportError as e:
            raise ImportError(f"{path} is HDF5-based: reading it needs the netCDF4 package") from e
        self.data = netCDF4.Dataset(path)
        self.data.set_auto_maskandscale(False)
        self.dims = {n: len(d) for n, d in self.data.dimensions.items()}
        self.variables = {
            n: Variable(v.dimensions, v.shape, v.dtype.str, 0, {a: v.getncattr(a) for a in v.ncattrs()}, None)
            for n, v in self.data.variables.items()
        }

    def read(self, name: str, step: int | None = None, levels: tuple[int, int] | None = None) -> np.ndarray:
        data = self.data.variables[name]
        return np.asarray(data[:] if step is None else data[step] if levels is None else data[step, levels[0]:levels[1]])

    def records(self, name: str, first: int, last: int) -> np.ndarray:
        return np.asarray(self.data.variables[name][first:last])


def open_file(path: str):
    with open(path, "rb") as f:
        head = f.read(8)
    return Library(path) if head == b"\x89HDF\r\n\x1a\n" else Classic(path)


# ---- decoding --------------------------------------------------------------
def day_number(year: int, month: int, day: int, julian: bool = False) -> int:
    """Days since 1970-01-01 of the Gregorian calendar; years are astronomical, so year 0 is a year."""
    y, m = (year - 1, month + 12) if month <= 2 else (year, month)
    leaps = y // 4 - (2 if julian else y // 100 - y // 400)
    return 365 * y + leaps + (153 * (m - 3) + 2) // 5 + day - 719469


def civil(days: int, julian: bool = False) -> tuple[int, int, int]:
    """The date of a day number."""
    year = 1970 + days // 366 if days >= 0 else 1970 + days // 365 - 1
    while day_number(year + 1, 1, 1, julian) <= days:
        year += 1
    month = 1
    while month < 12 and day_number(year, month + 1, 1, julian) <= days:
        month += 1
    return year, month, days - day_number(year, month, 1, julian) + 1


#: First day of the Gregorian calendar; the days before it are Julian in the mixed one.
REFORM = day_number(1582, 10, 15)


def decode_times(values: np.ndarray, units: str, calendar: str = "standard") -> list[datetime]:
    """CF time coordinates as datetimes; days a real month lacks move to its last day.

    ``standard`` and ``gregorian`` are Julian before 1582-10-15.  A result before year 1 cannot be held.
    """
    match = re.match(r"\s*(\w+?)s?\s+since\s+(-?\d+)-(\d+)-(\d+)(?:[T\s]+(\d+):(\d+)(?::(\d+))?)?", units)
    if not match or match.group(1).lower() not in UNIT_SECONDS:
        raise ValueError(f"cannot decode time units {units!r}")
    unit = UNIT_SECONDS[match.group(1).lower()]
    y, m, d, hh, mm, ss = (int(g) if g else 0 for g in match.groups()[1:])
    name = calendar.lower()
    length = CALENDAR_DAYS.get(name)
    if length is None:
        if name not in ("standard", "gregorian", "mixed", "proleptic_gregorian", "julian"):
            raise ValueError(f"unknown calendar {calendar!r}")
        julian = name == "julian" or name != "proleptic_gregorian" and (y, m, d) < (1582, 10, 15)
        first = day_number(y, m, d, julian)

        def date_of(day: int) -> tuple[int, int, int]:
            return civil(first + day, name == "julian" or name != "proleptic_gregorian" and first + day < REFORM)
    else:
        months = (
            [30] * 12 if length == 360
            else [31, 28 + (length == 366), 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
        )
        before = np.concatenate([[0], np.cumsum(months)])
        first = y * length + int(before[m - 1]) + d - 1

        def date_of(day: int) -> tuple[int, int, int]:
            year, in_year = divmod(first + day, length)
            month = int(np.searchsorted(before, in_year, side="right"))
            return year, month, in_year - int(before[month - 1]) + 1

    out = []
    for s in np.asarray(values, dtype="float64") * unit:
        day, rest = divmod(round(hh * 3600 + mm * 60 + ss + float(s), 3), 86400.0)
        year, month, dom = date_of(int(day))
        if year < 1:
            raise ValueError(f"{units!r} reaches back before year 1")
        last = ((date(year + month // 12, month % 12 + 1, 1)) - timedelta(days=1)).day
        out.append(datetime(year, month, min(dom, last)) + timedelta(seconds=rest))
    return out


def physical(raw: np.ndarray, attrs: Mapping[str, Any]) -> np.ndarray:
    """Packed values as doubles; fill, missing and huge values as NaN."""
    out = raw.astype("float64")
    for key in ("_FillValue", "missing_value"):
        if key in attrs:
            out[raw == np.asarray(attrs[key]).astype(raw.dtype)] = np.nan
    out = out * float(attrs.get("scale_factor", 1.0)) + float(attrs.get("add_offset", 0.0))
    out[~(np.abs(out) < FILL_VALUE)] = np.nan
    return out


@dataclass
class Layout:
    """Where a data variable keeps its axes; ``y``, ``x`` and ``lev`` are dimensions, the others variables."""

    var: str
    time: str | None
    lev: str | None
    lat: str
    lon: str
    y: str
    x: str

    @classmethod
    def of(cls, nc, wanted: str | None, rule: str) -> "Layout":
        v = nc.variables
        attrs = {n: x.attrs for n, x in v.items()}
        bounds = {str(a["bounds"]) for a in attrs.values() if "bounds" in a}
        spatial = {n: attrs[n] for n, x in v.items() if 1 <= len(x.dims) <= 2 and n not in bounds and x.dtype[-2:-1] in "fiu"}
        lat, lon = best_axis("lat", spatial), best_axis("lon", spatial)
        if lat is None or lon is None or lat == lon:
            raise ValueError("no latitude or longitude")
        on_axis = {n: attrs.get(n, {}) for n in nc.dims}
        times = {n for n in on_axis if best_axis("time", {n: on_axis[n]})}
        levels = {n for n in on_axis if best_axis("lev", {n: on_axis[n]})} - times
        coords = {lat, lon, *times, *levels, *bounds, *nc.dims}
        data = [n for n, x in v.items() if n not in coords and len(x.dims) >= 2]
        timed = {n: int(np.prod(v[n].shape, dtype=np.int64)) for n in data if set(v[n].dims) & times}
        if wanted and "," in wanted:
            var = resolve_alias(data, wanted.split(","))
        else:
            var = main_variable(data, wanted or None, rule, timed)
        dims = v[var].dims
        y, x = v[lat].dims if len(v[lat].dims) == 2 else (v[lat].dims[0], v[lon].dims[0])
        if y == x or not {y, x} <= set(dims):
            raise ValueError(f"{var}: axes {lat} and {lon} lie along {y} and {x}, the data along {dims}")
        time = best_axis("time", {d: on_axis[d] for d in dims if d not in (y, x)})
        if time is not None and dims[0] != time:
            raise ValueError(f"{var}: time must be the leading dimension, got {dims}")
        left = [d for d in dims if d not in (time, y, x)]
        if len(left) > 1:
            raise ValueError(f"{var}: unexpected dimensions {dims}")
        return cls(var, time, left[0] if left else None, lat, lon, y, x)

    def slab(self, nc, step: int, levels: tuple[int, int]) -> np.ndarray:
        """Physical values of one step and a range of levels: (level, cell), cells row by row."""
        v = nc.variables[self.var]
        dims = list(v.dims[1:] if self.time else v.dims)
        if self.lev and dims[0] == self.lev and self.time:
            raw = nc.read(self.var, step, levels)
        else:
            raw = nc.read(self.var, step if self.time else None)
            if self.lev:
                raw = raw.take(range(*levels), axis=dims.index(self.lev))
        raw = raw.transpose([dims.index(d) for d in ([self.lev] if self.lev else []) + [self.y, self.x]])
        return physical(raw, v.attrs).reshape(levels[1] - levels[0], -1)


def _times(nc, at: Layout, first: int, last: int) -> tuple[np.ndarray | None, list[datetime] | None]:
    """Raw and decoded times of some steps; a range that fits no calendar is an error."""
    if not at.time or at.time not in nc.variables:
        return None, None
    t = nc.variables[at.time]
    raw = nc.records(at.time, first, last).astype("float64")
    return raw, decode_times(raw, str(t.attrs.get("units", "")), str(t.attrs.get("calendar", "standard")))


@dataclass
class Chunk:
    """Successive time steps of a file, and what is known of them from the header.

    Without a header the chunk is part ``first`` of ``last`` of the file, and ``n_steps`` is None.
    """

    path: str
    first: int
    last: int
    n_steps: int | None = None
    times: tuple[str, str] | None = None
    levels: tuple[float, float] | None = None
    n_lev: int = 1
    rows: int = 0

    def may_hold(self, bounds: Mapping[str, list[tuple[str, Any]]]) -> bool:
        """Whether any row can satisfy the comparisons."""
        ranges = {"time": tuple(map(datetime.fromisoformat, self.times)) if self.times else None,
                  "step": (self.first, self.last - 1), "lev": self.levels, "lev_idx": (0, self.n_lev - 1)}
        return self.n_steps is None or all(
            _overlaps(ranges[c], k, v) for c, tests in bounds.items() for k, v in tests if ranges[c] is not None)


def _overlaps(span: tuple[Any, Any], kind: str, value: Any) -> bool:
    low, high = span
    return {"eq": low <= value <= high, "gt": high > value, "ge": high >= value, "lt": low < value, "le": low <= value}[kind]


@dataclass
class Task(InputPartition):
    chunks: list[Chunk]


def chunks_of(path: str, variable: str | None, rule: str, decode: bool, run: int) -> tuple[list[Chunk], dict[str, dict[str, str]]]:
    """The chunks of a file, and the attributes of its value and coordinates."""
    nc = open_file(path)
    at = Layout.of(nc, variable, rule)
    v = nc.variables[at.var]
    n = v.shape[0] if at.time else 1
    slab = int(np.prod(v.shape[1:] if at.time else v.shape, dtype=np.int64))
    run = run or max(1, TASK_ROWS // max(1, slab))
    known = at.lev is not None and at.lev in nc.variables
    depth = physical(nc.read(at.lev), {}) if known else None
    levels = (float(np.nanmin(depth)), float(np.nanmax(depth))) if known and np.isfinite(depth).any() else None
    decoded = _times(nc, at, 0, n)[1] if decode and at.time else None
    out = []
    for i in range(0, n, run):
        part = decoded[i:i + run] if decoded else None
        span = (min(part).isoformat(), max(part).isoformat()) if part else None
        out.append(Chunk(path, i, min(i + run, n), n, span, levels, v.shape[v.dims.index(at.lev)] if at.lev else 1,
                         slab * (min(i + run, n) - i)))
    attrs = {column: {k: str(x) for k, x in nc.variables[name].attrs.items() if not isinstance(x, np.ndarray)}
             for column, name in (("value", at.var), ("time", at.time), ("lev", at.lev), ("lat", at.lat), ("lon", at.lon))
             if name in nc.variables}
    return out, attrs


INDEX = ("path string, first int, last int, n_steps int, first_time string, last_time string, "
         "first_lev double, last_lev double, n_lev int, rows long, attrs string")


def chunk_index(spark: SparkSession, paths: Sequence[str], variable: str | None = None, rule: str = "predictor",
                decode: bool = True, run: int = 0) -> DataFrame:
    """One row for each run of steps of the listed files, from their headers, which tasks read.

    Times are ISO texts; ``attrs`` is JSON and stands in a file's first row.
    """
    def scan(batches):
        import pandas as pd
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                chunks, attrs = chunks_of(path, variable, rule, decode, run)
                for i, c in enumerate(chunks):
                    rows.append((c.path, c.first, c.last, c.n_steps, *(c.times or (None, None)), *(c.levels or (None, None)),
                                 c.n_lev, c.rows, None if i else json.dumps(attrs)))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in INDEX.split(", ")])

    return spark.createDataFrame([(p,) for p in paths], "path string").mapInPandas(scan, INDEX)


def time_extent(spark: SparkSession, path: str | Sequence[str], variable: str | None = None, rule: str = "predictor") -> DataFrame:
    """``path, first_time, last_time, n_steps`` of every file, from headers and time axes alone."""
    paths = FieldReader({"path": _joined(path)}).files()
    return chunk_index(spark, paths, variable, rule).groupBy("path").agg(
        F.min("first_time").cast("timestamp_ntz").alias("first_time"), F.max("last_time").cast("timestamp_ntz").alias("last_time"),
        F.max("n_steps").alias("n_steps"))


class FieldReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = {k.lower(): v for k, v in dict(options).items()}
        self.variable = self.options.get("variable") or None
        self.rule = self.options.get("rule", "predictor")
        self.decode = self.options.get("decodetimes", "true").lower() == "true"
        self.run = int(self.options.get("chunksteps", "0"))
        self.bounds: dict[str, list[tuple[str, Any]]] = {"time": [], "step": [], "lev": [], "lev_idx": []}

    def pushFilters(self, filters):
        """Comparisons of time, step and level spare tasks and reads; Spark applies all of them again."""
        from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual
        kinds = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}
        for f in filters:
            if type(f) in kinds and f.attribute[0] in self.bounds:
                self.bounds[f.attribute[0]].append((kinds[type(f)], f.value))
            yield f

    def wanted(self, column: str, value: Any) -> bool:
        return value is None or all(getattr(operator, k)(value, v) for k, v in self.bounds[column])

    def files(self) -> list[str]:
        found: list[str] = []
        paths = self.options["path"]
        for part in paths.split("\n" if "\n" in paths else ","):
            part = re.sub(r"^file:/*", "/", part.strip())
            if not part:
                continue
            if os.path.isdir(part):
                found += glob.glob(os.path.join(part, "**", "*.nc"), recursive=True)
            else:
                found += glob.glob(part)
        if not found:
            raise FileNotFoundError(self.options["path"])
        return sorted(set(found))

    def partitions(self) -> Sequence[Task]:
        """No file is opened here.  Without an index a file is cut by its size alone."""
        if "chunks" not in self.options:
            def parts(path: str) -> list[Chunk]:
                n = -(-os.path.getsize(path) // (4 * TASK_ROWS)) or 1
                return [Chunk(path, i, n) for i in range(n)]
            return [Task([c]) for path in self.files() for c in parts(path)]
        kept = [c for c in unpacked(self.options["chunks"]) if c.may_hold(self.bounds)]
        if self.run:
            return [Task([c]) for c in kept]
        goal = max(1, min(TASK_ROWS, sum(c.rows for c in kept) // int(self.options.get("tasks", "1"))))
        tasks: list[Task] = []
        room = 0
        for c in kept:
            if c.rows > room or not tasks:
                tasks.append(Task([]))
                room = goal
            tasks[-1].chunks.append(c)
            room -= c.rows
        return tasks

    def read(self, partition: Task | None) -> Iterator:
        # Spark passes None where no partition is left
        for chunk in partition.chunks if partition else ():
            yield from self.read_chunk(chunk)

    def read_chunk(self, chunk: Chunk) -> Iterator:
        import pyarrow as pa

        nc = open_file(chunk.path)
        at = Layout.of(nc, self.variable, self.rule)
        v = nc.variables[at.var]
        n_steps = v.shape[0] if at.time else 1
        first, last = chunk.first, chunk.last
        if chunk.n_steps is None:
            first, last = n_steps * chunk.first // chunk.last, n_steps * (chunk.first + 1) // chunk.last
        lat, lon = (physical(nc.read(n), nc.variables[n].attrs) for n in (at.lat, at.lon))
        if lat.ndim == 1 and lon.ndim == 1:
            lat, lon = np.meshgrid(lat, lon, indexing="ij")
        elif lon.shape != lat.shape:
            raise ValueError(f"{chunk.path}: {at.lat} and {at.lon} differ in shape")
        ny, nx = lat.shape
        iy, ix = np.divmod(np.arange(ny * nx, dtype="int32"), np.int32(nx))
        depth = physical(nc.read(at.lev), {}) if at.lev and at.lev in nc.variables else None
        n_lev = v.shape[v.dims.index(at.lev)] if at.lev else 1
        chosen = [k for k in range(n_lev) if not at.lev or self.wanted("lev_idx", k) and (
            depth is None or np.isnan(depth[k]) or self.wanted("lev", float(depth[k])))]
        if not chosen:
            return
        if self.decode and at.time and at.time not in nc.variables:
            raise ValueError(f"{chunk.path}: no time coordinate")
        raw, times = _times(nc, at, first, last) if self.decode else (
            nc.records(at.time, first, last).astype("float64") if at.time in nc.variables else None, None)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = {"string": pa.string(), "timestamp_ntz": pa.timestamp("us"), "double": pa.float64(), "int": pa.int32()}
        schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in SCHEMA.split(", ")])
        for i, step in enumerate(range(first, last)):
            if not (self.wanted("step", step) and self.wanted("time", times[i] if times else None)):
                continue
            cube = at.slab(nc, step, (chosen[0], chosen[-1] + 1))
            for k in chosen:
                for lo in range(0, ny * nx, SLAB):
                    part = slice(lo, min(lo + SLAB, ny * nx))
                    n = part.stop - part.start
                    constants = {
                        "path": chunk.path, "var": at.var,
                        "time": times[i] if times else None,
                        "raw_time": float(raw[i]) if raw is not None else None,
                        "step": step, "n_steps": n_steps,
                        "lev": float(depth[k]) if depth is not None else None,
                        "lev_idx": k if at.lev else None,
                    }
                    columns = {
                        c: pa.repeat(pa.scalar(x, schema.field(c).type), n) for c, x in constants.items()
                    } | {
                        "iy": pa.array(iy[part]), "ix": pa.array(ix[part]),
                        "lat": pa.array(lat.ravel()[part], from_pandas=True),
                        "lon": pa.array(lon.ravel()[part], from_pandas=True),
                        "value": pa.array(cube[k - chosen[0], part], from_pandas=True),
                    }
                    yield pa.RecordBatch.from_pydict({n_: columns[n_] for n_ in names}, schema=schema)


def packed(chunks: Sequence[Chunk]) -> str:
    """Chunks as an option of the reader."""
    rows = [(c.path, c.first, c.last, c.n_steps, c.times, c.levels, c.n_lev, c.rows) for c in chunks]
    return base64.b64encode(zlib.compress(json.dumps(rows).encode())).decode()


def unpacked(text: str) -> list[Chunk]:
    return [Chunk(*row) for row in json.loads(zlib.decompress(base64.b64decode(text)))]


def _joined(path: str | Sequence[str]) -> str:
    return path if isinstance(path, str) else "\n".join([*path, ""])


class FieldSource(DataSource):
    """``spark.read.format("ncfield")`` and ``df.write.format("ncfield")``.

    Reading: options path, variable, rule, decodeTimes, chunkSteps.  Without ``chunkSteps`` a task takes
    about four million rows.  ``step`` is the position inside the file, out of ``n_steps``.
    ``variable`` may list aliases separated by commas: the first present is read, else the file's
    first data variable.  ``read_netcdf`` adds the index of chunks; without it nothing is pruned before the tasks.

    Writing: options path, dataset, value, span, name, attrs; see ``write_netcdf``.
    """

    @classmethod
    def name(cls) -> str:
        return "ncfield"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FieldReader:
        return FieldReader(self.options)

    def writer(self, schema, overwrite: bool) -> "FieldWriter":
        return FieldWriter(self.options)


def read_netcdf(spark: SparkSession, path: str | Sequence[str], variable: str | None = None,
                **options: Any) -> DataFrame:
    """The long form of one variable of one or many files.

    Names are listed here and headers are read by a job of as many tasks as cores; the driver holds a line for each
    run of steps, about as many as the scan has tasks.  Attributes that all files share stand as column metadata.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FieldSource)
    given = {k.lower(): str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
    plan = FieldReader({"path": _joined(path), "variable": variable or "", **given})
    found = chunk_index(spark, plan.files(), plan.variable, plan.rule, plan.decode, plan.run).collect()
    chunks = [Chunk(r.path, r.first, r.last, r.n_steps, r.first_time and (r.first_time, r.last_time),
                    None if r.first_lev is None else (r.first_lev, r.last_lev), r.n_lev, r.rows) for r in found]
    reader = spark.read.format("ncfield").option("path", _joined(path)).option("chunks", packed(chunks)).option(
        "tasks", str(spark.sparkContext.defaultParallelism))
    for key, value in {"variable": variable or "", **given}.items():
        reader = reader.option(key, value)
    df = reader.load()
    shared: dict[str, dict[str, str]] | None = None
    for r in found:
        if r.attrs is not None:
            own = json.loads(r.attrs)
            shared = own if shared is None else {
                c: {k: v for k, v in a.items() if own.get(c, {}).get(k) == v} for c, a in shared.items()}
    return _with_attrs(df, shared or {})


def _with_attrs(df: DataFrame, attrs: Mapping[str, Mapping[str, str]]) -> DataFrame:
    return df.select(*[F.col(c).alias(c, metadata=dict(attrs[c])) if attrs.get(c) else F.col(c) for c in df.columns])


def variable_names(path: str) -> list[str]:
    """Names in file order, from the header."""
    return list(open_file(path).variables)


def file_attrs(listing: DataFrame) -> DataFrame:
    """(path, var, key, value) of every attribute in the headers of listed files."""
    def each(batches):
        import pandas as pd
        for pdf in batches:
            rows = [
                (path, var, key, str(value))
                for path in pdf["path"] for var, v in open_file(path).variables.items()
                for key, value in v.attrs.items()
            ]
            yield pd.DataFrame(rows, columns=["path", "var", "key", "value"])

    return listing.select("path").mapInPandas(each, "path string, var string, key string, value string")


def units_of(path: str, var: str) -> str:
    """Unit of a variable in a file, or in the first file of a folder; '' if none is given."""
    first = FieldReader({"path": path}).files()[0]
    found = open_file(first).variables.get(var)
    return str(found.attrs.get("units", "")) if found else ""


# ---- writing ---------------------------------------------------------------
def _pad(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 4)


def _name(text: str) -> bytes:
    raw = text.encode("utf-8")
    return struct.pack(">i", len(raw)) + _pad(raw)


def _attributes(attrs: Mapping[str, Any]) -> bytes:
    if not attrs:
        return struct.pack(">ii", 0, 0)
    out = struct.pack(">ii", 12, len(attrs))
    for key, value in attrs.items():
        if isinstance(value, str):
            raw = value.encode("utf-8")
            out += _name(key) + struct.pack(">ii", 2, len(raw)) + _pad(raw)
        else:
            kind, form = (5, ">f4") if isinstance(value, np.float32) else (6, ">f8")
            out += _name(key) + struct.pack(">ii", kind, 1) + np.array([value], form).tobytes()
    return out


def write_classic(path: str, dims: Mapping[str, int], variables: Mapping[str, tuple], attrs: Mapping[str, Any]) -> None:
    """One classic file with 64-bit offsets: ``variables`` maps name -> (dims, array, attrs)."""
    codes = {"f4": 5, "f8": 6, "i4": 4}
    index = {d: i for i, d in enumerate(dims)}
    head = b"CDF\x02" + struct.pack(">i", 0) + struct.pack(">ii", 10, len(dims))
    for d, n in dims.items():
        head += _name(d) + struct.pack(">i", n)
    head += _attributes(attrs) + struct.pack(">ii", 11, len(variables))
    entries, blobs = [], []
    for name, (vdims, array, vattrs) in variables.items():
        form = np.dtype(array.dtype).str[1:]
        raw = _pad(np.ascontiguousarray(array, ">" + form).tobytes())
        entry = _name(name) + struct.pack(">i", len(vdims)) + b"".join(struct.pack(">i", index[d]) for d in vdims)
        entries.append(entry + _attributes(vattrs) + struct.pack(">ii", codes[form], min(len(raw), 2**31 - 4)))
        blobs.append(raw)
    at = len(head) + sum(len(e) + 8 for e in entries)
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(temp, "wb") as f:
        f.write(head)
        for entry, raw in zip(entries, blobs):
            f.write(entry + struct.pack(">q", at))
            at += len(raw)
        for raw in blobs:
            f.write(raw)
    os.replace(temp, path)


class Written(WriterCommitMessage):
    """Files of one task: (staged path, name, steps)."""

    def __init__(self, files: list[tuple[str, str, int]]) -> None:
        self.files = files


class FieldWriter(DataSourceArrowWriter):
    """Rows sorted by dataset, span, time and cell become one classic file for each dataset and span.

    Every attempt of a task writes under a folder of its own, so a lost or repeated attempt changes
    nothing that is published.  ``commit`` renames the files of the attempts that count and removes the
    staging folder with all else; two tasks with the same file are an error, as rows were not clustered.
    """

    def __init__(self, options: Mapping[str, str]) -> None:
        o = {k.lower(): v for k, v in dict(options).items()}
        self.folder = re.sub(r"^file:/*", "/", o["path"])
        self.dataset = [c for c in o.get("dataset", "var").split(",") if c]
        self.value = o.get("value", "value")
        self.span = o.get("span", "month")
        self.template = o.get("name", ".".join(f"{{{c}}}" for c in [*self.dataset, "span"]))
        self.attrs = json.loads(o.get("attrs", "{}"))
        self.columns = json.loads(o.get("columns", "{}"))
        self.staging = os.path.join(self.folder, f"_staging-{uuid.uuid4().hex}")

    def write(self, iterator) -> Written:
        attempt = os.path.join(self.staging, uuid.uuid4().hex)
        files: list[tuple[str, str, int]] = []
        held: list[Any] = []
        key: tuple | None = None

        def flush() -> None:
            if held:
                name = self.template.format(**dict(zip([*self.dataset, "span"], key))) + ".nc"
                staged = os.path.join(attempt, name + ".part")
                os.makedirs(os.path.dirname(staged), exist_ok=True)
                files.append((staged, name, self.assemble(staged, held)))
                held.clear()

        for batch in iterator:
            if batch.num_rows == 0:
                continue
            pdf = batch.to_pandas()
            keys = pdf[[*self.dataset, "span"]].astype(str)
            new = (keys != keys.shift()).any(axis=1).to_numpy()
            starts = [*np.flatnonzero(new), len(pdf)]
            for a, b in zip(starts, starts[1:]):
                mine = tuple(keys.iloc[a])
                if mine != key:
                    flush()
                    key = mine
                held.append(pdf.iloc[a:b].reset_index(drop=True))
        flush()
        return Written(files)

    def assemble(self, path: str, parts: Sequence[Any]) -> int:
        """Write one file; the number of its steps."""
        import pandas as pd

        pdf = pd.concat(parts, ignore_index=True)
        var = str(pdf["var"].iloc[0]) if "var" in pdf.columns else self.value
        lat, lon = (pdf.groupby(i)[c].first().sort_index() for i, c in (("iy", "lat"), ("ix", "lon")))
        times = np.sort(pdf["time"].unique())
        at = [np.searchsorted(times, pdf["time"].to_numpy()), lat.index.get_indexer(pdf["iy"]), lon.index.get_indexer(pdf["ix"])]
        dims, order = {"time": len(times), "lat": len(lat), "lon": len(lon)}, ["time", "lat", "lon"]
        days = ((times - np.datetime64("1850-01-01")) / np.timedelta64(1, "D")).astype("f8")
        flat = bool((pdf.groupby("iy")["lat"].nunique() <= 1).all() and (pdf.groupby("ix")["lon"].nunique() <= 1).all())
        variables: dict[str, tuple] = {
            "time": (("time",), days, {"standard_name": "time", **self.kept("time"), "units": "days since 1850-01-01", "calendar": "standard"})}
        for c, axis, units in (("lat", lat, "degrees_north"), ("lon", lon, "degrees_east")):
            held, along = axis.to_numpy("f8"), (c,)
            if not flat:
                held, along = np.full((len(lat), len(lon)), np.nan), ("lat_index", "lon_index")
                held[at[1], at[2]] = pdf[c].to_numpy("f8")
            variables[c] = (along, held, {"units": units, **self.kept(c)})
        if not flat:
            dims = {"time": len(times), "lat_index": len(lat), "lon_index": len(lon)}
            order = list(dims)
        if "lev" in pdf.columns and pdf["lev"].notna().any():
            levels = np.sort(pdf["lev"].unique())
            at.insert(1, np.searchsorted(levels, pdf["lev"].to_numpy()))
            dims, order = {**dims, "lev": len(levels)}, [order[0], "lev", *order[1:]]
            variables["lev"] = (("lev",), levels.astype("f8"), {"units": "m", "axis": "Z", **self.kept("lev")})
        cube = np.full([dims[d] for d in order], FILL_VALUE, "f4")
        cube[tuple(at)] = pdf[self.value].fillna(FILL_VALUE).to_numpy("f4")
        variables[var] = (tuple(order), cube, {**self.kept(self.value), "_FillValue": np.float32(FILL_VALUE)})
        write_classic(path, dims, variables, self.attrs)
        return len(times)

    def kept(self, column: str) -> dict[str, str]:
        """Attributes of a column that hold in the new file too."""
        gone = {*STALE_ATTRS, "_FillValue", "missing_value", "bounds", "coordinates", "cell_measures"}
        return {k: str(v) for k, v in self.columns.get(column, {}).items() if k not in gone and not k.startswith("__")}

    def commit(self, messages) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        names = [name for _, name, _ in files]
        twice = sorted({n for n in names if names.count(n) > 1}) if len(set(names)) < len(names) else []
        if twice:
            raise ValueError(f"rows of one file lie in several tasks: {twice[:3]}")
        for staged, name, _ in files:
            os.makedirs(os.path.dirname(os.path.join(self.folder, name)), exist_ok=True)
            os.replace(staged, os.path.join(self.folder, name))
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


def span_of(span: str) -> Column:
    """The part of the time that goes into one file, as text."""
    form = {"month": "yyyyMM", "year": "yyyy"}.get(span)
    return F.date_format("time", form) if form else F.lit("all")


def write_netcdf(df: DataFrame, folder: str, dataset: Sequence[str] = ("var",), value: str = "value",
                 attrs: Mapping[str, str] | None = None, span: str = "month", name: str | None = None) -> None:
    """Export a field: one file for each dataset and month (or ``span`` "year", or "all" for a whole series).

    ``name`` is a file name without its ending, with ``{column}`` of the dataset columns and ``{span}``; slashes make
    folders.  Column metadata become attributes, ``attrs`` global ones.  A task assembles one file, so a span should
    be a few hundred grids at most.  Files appear when all are written; those of the same names are
    replaced one by one.  ``folder`` must be shared.
    """
    spark = df.sparkSession
    spark.dataSource.register(FieldSource)
    keys = [*dataset, "span"]
    extra = ["lev"] if "lev" in df.columns else []
    columns = [c for c in dict.fromkeys([*keys, *(["var"] if "var" in df.columns else []), "time", *extra, "iy", "ix", "lat", "lon", value])]
    rows = df.withColumn("span", span_of(span)).select(*columns)
    sorted_rows = rows.repartition(*keys).sortWithinPartitions(*keys, "time", *extra, "iy", "ix")
    meta = {c: a for c, a in column_attrs(df).items() if a}
    writer = sorted_rows.write.format("ncfield").mode("append").option("dataset", ",".join(dataset)).option(
        "value", value).option("span", span).option("attrs", json.dumps(dict(attrs or {}))).option("columns", json.dumps(meta))
    if name:
        writer = writer.option("name", name)
    writer.save(folder)
