"""A stream of durable pages: the offset is a position in pinned Parquet files, the page id a digest of its rows."""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

MOST_ROWS = 5000


class PlacePages(DataSource):
    """Format place_pages: options path (a folder of Parquet files), columns (a schema), rows (of a page, 1,000 unless given).

    A page travels through the driver, so its rows are bounded. Its offset is
    logged before the sink sees it and committed after: a query that dies in
    between reads the same rows again, under the same page_id.
    """

    @classmethod
    def name(cls) -> str:
        return "place_pages"

    def schema(self) -> str:
        return f"{self.options['columns']}, file int, row long, page_id string"

    def simpleStreamReader(self, schema) -> PageReader:
        return PageReader(self.options, [f.name for f in schema.fields][:-3])


class PageReader(SimpleDataSourceStreamReader):
    def __init__(self, options, columns: list[str]):
        self.path, self.columns, self.most = options["path"], columns, int(options.get("rows", 1000))
        if not 1 <= self.most <= MOST_ROWS:
            raise ValueError("invalid page size")

    def _files(self) -> tuple[fs.FileSystem, list[str], str]:
        """The Parquet files by path, and a digest of their paths and sizes."""
        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        found = sorted((f.path, f.size) for f in system.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file and f.path.endswith(".parquet"))
        return system, [p for p, _ in found], sha256(json.dumps(found).encode()).hexdigest()

    def initialOffset(self) -> dict:
        return {"file": 0, "row": 0, "files": self._files()[2]}

    def _rows(self, start: dict, most: int) -> tuple[list[tuple], dict]:
        """Up to `most` rows from `start` on, and the position behind them; row groups before it are not decoded."""
        system, files, digest = self._files()
        if digest != start["files"]:
            raise ValueError("the pinned files have changed")
        out: list[tuple] = []
        file, row = start["file"], start["row"]
        while file < len(files) and len(out) < most:
            with pq.ParquetFile(system.open_input_file(files[file])) as source:
                first = 0
                for group in range(source.metadata.num_row_groups):
                    n = source.metadata.row_group(group).num_rows
                    if first + n > row and len(out) < most:
                        table = source.read_row_group(group, columns=self.columns).slice(row - first, most - len(out))
                        out += [(*values, file, row + k) for k, values in enumerate(zip(*(table.column(c).to_pylist() for c in self.columns), strict=True))]
                        row += table.num_rows
                    first += n
                if row >= first:
                    file, row = file + 1, 0
        return out, {"file": file, "row": row, "files": digest}

    def _named(self, rows: list[tuple]) -> Iterator[tuple]:
        page = sha256(json.dumps(rows, default=str, ensure_ascii=False).encode()).hexdigest()
        return iter([(*r, page) for r in rows])

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self._rows(start, self.most)
        return self._named(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        rows, _ = self._rows(start, MOST_ROWS)  # the page as it was read, whatever its size is now
        return self._named([r for r in rows if (r[-2], r[-1]) < (end["file"], end["row"])])

    def commit(self, end: dict) -> None:
        """The checkpoint holds the position; nothing else is kept."""
