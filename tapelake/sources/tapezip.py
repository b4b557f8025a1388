"""Zip archives of tapes as a data source of Spark: ``spark.read.format("tapezip").load(folder)`` once it is registered.

Rows are lines, with the archive, entry and member they are from and what the member's name says: agency, kind and quarter.
Each member ends in one row with its outcome. There is a partition per member; a nested zip that is deflated is one partition,
because its members cannot be reached without inflating it. Filters on ``source``, ``agency``, ``kind`` and ``quarter`` are
pushed: archives that the filter on their name leaves out are not opened, and of the others only the wanted members are read.
Where archives are named after their vintages (option ``vintages``), a filter on the quarter leaves archives out too.

``read_zipped`` splits the lines into a layout's fields, which leaves the filters where they are.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition

from tapelake.sources import archives, tapes

COLUMNS = ["archive", "source", "entry", "member", "agency", "kind", "quarter", "value", "rows", "error"]
SCHEMA = ", ".join(f"{c} {'long' if c == 'rows' else 'string'}" for c in COLUMNS)
_PUSHED = ("source", "agency", "kind", "quarter")
# Agency names in the silver layer, the single-file tape's suffix, and a vintage in an archive's name.
_FRE, _FNM, _SINGLE = "freddie", "fannie", ".csv"
_VINTAGE = re.compile(r"(2[0-9]{3})(Q[1-4])?")


def of_name(member: str | None) -> dict[str, str | None]:
    """What a member's name says."""
    found = re.search(tapes.QUARTER_PATTERN, member or "")
    if found:
        return {"agency": _FRE, "kind": "performance" if "historical_data_time_" in member else "origination", "quarter": found[1]}
    return {"agency": _FNM if (member or "").lower().endswith(_SINGLE) else None, "kind": None, "quarter": None}


@dataclass
class Entry(InputPartition):
    """A member to read, or a deflated nested zip of which the wanted members are read."""

    archive: str
    entry: str | None
    member: str | None
    inside: str | None
    error: str | None = None

    def __post_init__(self):
        InputPartition.__init__(self, (self.archive, self.entry, self.member))


class Wanted:
    """Values that pushed filters allow; a column without a filter allows all."""

    def __init__(self):
        self.values: dict[str, set] = {}

    def push(self, filter_: Filter) -> bool:
        """Whether a filter is one of those that choose members, exactly."""
        attribute = getattr(filter_, "attribute", None)
        if not attribute or len(attribute) != 1 or attribute[0] not in _PUSHED:
            return False
        if isinstance(filter_, (EqualTo, EqualNullSafe)) and filter_.value is not None:
            allowed = {filter_.value}
        elif isinstance(filter_, In):
            allowed = {v for v in filter_.value if v is not None}
        else:
            return False
        self.values[attribute[0]] = self.values.get(attribute[0], allowed) & allowed
        return True

    def allows(self, **known: str | None) -> bool:
        return all(known[c] in allowed for c, allowed in self.values.items() if c in known)

    def allows_archive(self, source: str, vintages: bool) -> bool:
        if not self.allows(source=source):
            return False
        found = _VINTAGE.search(source) if vintages else None
        return not found or "quarter" not in self.values or any(q.startswith(found[0]) or found[0].startswith(q) for q in self.values["quarter"])


class TapeZipReader(DataSourceReader):
    def __init__(self, path: str, vintages: bool):
        self.path, self.vintages, self.wanted = path, vintages, Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for filter_ in filters:
            if not self.wanted.push(filter_):
                yield filter_

    def partitions(self) -> list[Entry]:
        """Lists archives and what lies in them; only directories are read, of the archives that are wanted."""
        from pyarrow import fs

        filesystem, path = archives._file(self.path)
        info = filesystem.get_file_info(path)
        found = [info] if info.type == fs.FileType.File else filesystem.get_file_info(fs.FileSelector(path, recursive=True))
        scheme = self.path.split("://")[0] + "://" if "://" in self.path else ""
        names = sorted(scheme + f.path for f in found if f.type == fs.FileType.File and f.path.lower().endswith(".zip"))
        return [e for name in names if self.wanted.allows_archive(name.rsplit("/", 1)[-1], self.vintages) for e in self._entries(name)]

    def _entries(self, archive: str) -> Iterator[Entry]:
        try:
            with ExitStack() as stack:
                outer = archives._open(stack, archive)
                for info in outer.infolist():
                    if info.is_dir():
                        continue
                    if not archives._is_zip(info.filename):
                        if self.wanted.allows(**of_name(info.filename)):
                            yield Entry(archive, info.filename, info.filename, None)
                    elif info.compress_type != zipfile.ZIP_STORED or info.flag_bits & 1:
                        yield Entry(archive, info.filename, None, None)
                    else:
                        inner = stack.enter_context(zipfile.ZipFile(archives._stored(outer, info.filename)))
                        for member in inner.infolist():
                            if not member.is_dir() and self.wanted.allows(**of_name(member.filename)):
                                yield Entry(archive, info.filename, member.filename, info.filename)
        except archives._UNREADABLE as failure:
            yield Entry(archive, None, None, None, archives._text(failure))

    def read(self, partition: Entry | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's one partition of a source that has none
            return
        if partition.member is None and partition.error is None:
            yield from self._nested(partition)
            return
        yield from self._lines(partition, vars(partition) | {"place": partition.archive})

    def _lines(self, partition: Entry, row: dict, opened=None) -> Iterator[pa.RecordBatch]:
        named = of_name(row["member"])
        said = {"archive": partition.archive, "source": partition.archive.rsplit("/", 1)[-1], "entry": partition.entry, "member": row["member"], **named}
        for batch in archives.lines_of(row, opened):
            size = batch.num_rows
            if row["member"] is None and self.wanted.values.keys() - {"source"}:
                continue  # what cannot be read has no agency, kind or quarter to be wanted for
            places = [pa.repeat(pa.scalar(said[c], pa.string()), size) for c in COLUMNS[:7]]
            yield pa.RecordBatch.from_arrays([*places, *(batch.column(c) for c in COLUMNS[7:])], names=COLUMNS)

    def _nested(self, partition: Entry) -> Iterator[pa.RecordBatch]:
        """The wanted members of a deflated nested zip; to seek back in one inflates it again."""
        try:
            with ExitStack() as stack:
                outer = archives._open(stack, partition.archive)
                inner = stack.enter_context(zipfile.ZipFile(stack.enter_context(outer.open(partition.entry))))
                for info in sorted(inner.infolist(), key=lambda i: i.header_offset):
                    if not info.is_dir() and self.wanted.allows(**of_name(info.filename)):
                        yield from self._lines(partition, {"member": info.filename, "error": None}, inner)
        except archives._UNREADABLE as failure:
            yield from self._lines(partition, {"member": None, "error": archives._text(failure)})


class TapeZip(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tapezip"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TapeZipReader:
        return TapeZipReader(self.options["path"], self.options.get("vintages", "false").lower() == "true")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TapeZip)


def read_zipped(spark: SparkSession, path: str, width: int, separator: str = tapes.SEPARATOR, vintages: bool = False) -> DataFrame:
    """The rows of all members, with where they are from and a layout's fields; damaged members raise nothing and have fewer rows."""
    register(spark)
    lines = spark.read.format("tapezip").option("vintages", str(vintages).lower()).load(path)
    return tapes.split_fields(lines.where("value IS NOT NULL"), width, separator, before=("source", "entry", "member", "agency", "kind", "quarter"))
