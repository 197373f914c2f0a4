"""A data source that splits one large JSON object at its members.

Spark reads a JSON object as one row of one task, however large it is. Here a file is cut into
byte ranges, and a task reads those members whose name begins in its range. A member begins
behind ``}, `` with ``"name": {``; text inside a member cannot look like that, since a quote in a
text is escaped and a quote that ends a text is followed by a comma, a colon or a brace. So the
values must be objects without objects inside. A broken member becomes a row with its error and
leaves its neighbours as they are.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 32 << 20
AHEAD = 1 << 20  # bytes read at once behind a range, to the end of its last member, at most
FIRST_AHEAD = 1 << 12  # and at first: members are short against a range

_TEXT = rb'"(?:[^"\\]|\\.)*"'
_BEGIN = re.compile(rb'\}\s*,\s*(?=' + _TEXT + rb'\s*:\s*\{)', re.DOTALL)
_HEAD = re.compile(rb'(?:\xef\xbb\xbf)?\s*\{\s*')


def open_files(path: str):
    """The file system of a path, and (name, size) of the file or of all files below the folder."""
    from pyarrow import fs
    if re.match(r"file:/(?!//)", path):
        path = "file://" + path[len("file:"):]
    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    found = system.get_file_info(inner)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    listed = [found] if found.type == fs.FileType.File else system.get_file_info(
        fs.FileSelector(inner, recursive=True))
    return system, [(f.path, f.size) for f in sorted(listed, key=lambda f: f.path)
                    if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]


class ByteRange(InputPartition):
    def __init__(self, file: str, low: int, high: int, size: int):
        self.file, self.low, self.high, self.size = file, low, high, size


class MembersReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, split_bytes

    def partitions(self) -> list[ByteRange]:
        _, files = open_files(self.path)
        return [ByteRange(name, low, min(low + self.split_bytes, size), size)
                for name, size in files for low in range(0, size, self.split_bytes)]

    def read(self, part: ByteRange) -> Iterator[tuple]:
        system, _ = open_files(self.path)
        with system.open_input_file(part.file) as file:
            yield from self._members(file, part)

    def _members(self, file, part: ByteRange) -> Iterator[tuple]:
        def bytes_of(low: int, high: int) -> bytes:
            file.seek(low)
            return file.read(high - low)
        # back to the last byte before the range that is neither white space nor a comma
        back = part.low
        while back and not bytes_of(back, min(back + 1, part.low)).strip(b" \t\r\n,"):
            back -= 1
        base, data = back, bytes_of(back, part.high)
        if part.low == 0:
            head = _HEAD.match(data)
            starts = [head.end() if head else 0]
        else:
            starts = []
        reached, scanned, ahead = part.high, 0, FIRST_AHEAD
        while True:
            # a beginning may lie across the end of what was read, so the last place is looked at again
            for found in _BEGIN.finditer(data, scanned):
                starts.append(found.end())
            ends = [s for s in starts if base + s >= part.high]
            if ends or reached >= part.size:
                break
            if not any(base + s >= part.low for s in starts) and reached > part.high + AHEAD:
                return  # the range lies within a member that begins before it
            scanned = max([s for s in starts] + [0])
            more = bytes_of(reached, min(reached + ahead, part.size))
            reached, ahead = reached + len(more), min(2 * ahead, AHEAD)
            data += more
        mine = sorted({s for s in starts if part.low <= base + s < part.high})
        if not mine:
            return
        last = min(ends) if ends else len(data)
        for low, high in zip(mine, [*mine[1:], last]):
            raw = data[low:high].strip()
            if high == len(data) and reached >= part.size and not ends:
                raw = raw.removesuffix(b"}").strip()  # the brace of the whole object
            raw = raw.removesuffix(b",").strip()
            if raw or len(mine) > 1:
                yield self._row(raw)

    @staticmethod
    def _row(raw: bytes) -> tuple:
        text = raw.decode("utf-8", "replace")
        try:
            (name, value), = json.loads("{" + text + "}").items()
            return name, json.dumps(value, ensure_ascii=False), None
        except ValueError as problem:
            name = re.match(r'\s*"((?:[^"\\]|\\.)*)"', text)
            return (name.group(1) if name else None), text, f"broken member: {problem}"


class JsonMembers(DataSource):
    """``spark.read.format("json_members").load(path)``: (name, value, error) of each member of the JSON objects at
    the path, one object in each file. Option ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "json_members"

    def schema(self) -> str:
        return "name string, value string, error string"

    def reader(self, schema) -> MembersReader:
        return MembersReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))
