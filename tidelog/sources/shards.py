"""The change log in files as a data source of its own: a partition per owned shard, offsets by shard.

    shards.register(spark)
    spark.readStream.format("tidelog").schema(...).options(path=..., shards="0,1", starts='{"0": 12}').load()

Offsets are a map from shard to the last seqno. Rows without a seqno go with the next
event (a stream's end with the event before), so a marker is never read without
what follows it; a stream that begins inside a snapshot is told its marker first.
Only folders of owned shards are listed, and of their files only row groups that reach
beyond the offset are read, in order: memory holds a batch of rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

_ALL = (1 << 63) - 1


class ShardPart(InputPartition):
    """Rows of a shard after seqno `start`, up to `end`; opens: the stream begins here, so it needs a marker."""

    def __init__(self, shard: int, start: int, end: int, opens: bool):
        self.shard, self.start, self.end, self.opens = shard, start, end, opens


class _Files:
    """A shard's files in order of arrival, and their seqnos by statistics."""

    def __init__(self, path: str):
        self.fs, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self._known: dict[str, tuple[int, int]] = {}

    def shards(self) -> list[int]:
        found = self.fs.get_file_info(fs.FileSelector(self.root))
        return sorted(int(f.base_name[6:]) for f in found if f.type == fs.FileType.Directory and f.base_name.startswith("shard="))

    def of(self, shard: int) -> list[str]:
        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/shard={shard}", allow_not_found=True))
        names = [f.path for f in found if f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
        return sorted(names, key=lambda n: self._span(n)[0])

    def _span(self, name: str) -> tuple[int, int]:
        """Least arrival and highest seqno."""
        if name not in self._known:
            meta = pq.read_metadata(name, filesystem=self.fs)
            low, high = _ALL, 0
            for g in range(meta.num_row_groups):
                low, high = min(low, bounds(meta, g, "arrival")[0]), max(high, bounds(meta, g, "seqno")[1])
            self._known[name] = low, high
        return self._known[name]

    def high(self, shard: int) -> int:
        return max((self._span(n)[1] for n in self.of(shard)), default=0)


def bounds(meta, group: int, column: str) -> tuple[int, int]:
    """Least and greatest value of a row group's column; (-1, 0) if it has none."""
    g = meta.row_group(group)
    for i in range(g.num_columns):
        c = g.column(i)
        if c.path_in_schema == column:
            return (c.statistics.min, c.statistics.max) if c.statistics is not None and c.statistics.has_min_max else (-1, 0) if c.statistics is not None and c.statistics.null_count == g.num_rows else (-1, _ALL)
    return -1, 0


def read_part(files: _Files, part: ShardPart, columns: Sequence[str], batch_rows: int = 65_536) -> Iterator[pa.Table]:
    """The part's rows in order of arrival. Only rows that wait for their event are carried from batch to batch."""
    carried: pa.Table | None = None
    marker: pa.Table | None = None
    opening = part.opens and part.start > 0
    need = list(dict.fromkeys([*columns, "kind", "seqno", "snap_end"]))
    done = False
    for name in files.of(part.shard):
        f = pq.ParquetFile(name, filesystem=files.fs)
        groups = [g for g in range(f.num_row_groups) if opening or bounds(f.metadata, g, "seqno")[1] >= part.start or bounds(f.metadata, g, "seqno")[0] < 0]
        for b in f.iter_batches(batch_rows, groups, [c for c in need if c != "shard"], use_threads=False):
            x = pa.Table.from_batches([b])
            x = x.append_column("shard", pa.array([part.shard] * len(x), pa.int32())).select(need)
            if opening:
                after = pc.index(pc.fill_null(pc.greater(x["seqno"], part.start), False), True).as_py()
                before = x.slice(0, after if after >= 0 else len(x))
                marks = before.filter(pc.equal(before["kind"], "snapshot_marker"))
                marker = marks.slice(len(marks) - 1) if len(marks) else marker
            x = x if carried is None else pa.concat_tables([carried, x])
            at = pc.fill_null_backward(pc.if_else(pc.equal(x["kind"], "stream_end"), pc.fill_null_forward(x["seqno"]), x["seqno"]))
            inside = pc.and_(pc.greater(at, part.start), pc.less_equal(at, part.end))
            out = x.filter(pc.fill_null(inside, False))
            carried = x.filter(pc.is_null(at))
            done = pc.any(pc.greater(at, part.end)).as_py() or False
            if opening and len(out):
                if marker is not None and out["kind"][0].as_py() != "snapshot_marker":
                    yield marker.select(columns)
                opening = False
            if len(out):
                yield out.select(columns)
            if done:
                return


class _Reader:
    def __init__(self, options: dict, schema, filters: list[Filter] = ()):
        self.path, self.columns = options["path"], schema.names
        self.starts = {int(k): int(v) for k, v in json.loads(options.get("starts", "{}")).items()}
        self.ends = {int(k): int(v) for k, v in json.loads(options.get("ends", "{}")).items()}
        self.frozen = options.get("frozen")
        self.files = _Files(self.path)
        own = options.get("shards")
        self.owned = sorted({int(s) for s in own.split(",")}) if own else None
        self.kept = [int(c) for c in options["collections"].split(",")] if options.get("collections") else None

    def shards(self) -> list[int]:
        there = self.files.shards()
        return there if self.owned is None else [s for s in self.owned if s in there]

    def limits(self) -> dict[int, int]:
        """Where each shard ends: given, or where it ended when the frozen read began (told by the file `frozen`), or at its last seqno."""
        now = {s: min(self.files.high(s), self.ends.get(s, _ALL)) for s in self.shards()}
        if not self.frozen:
            return now
        store, name = fs.FileSystem.from_uri(self.frozen) if "://" in self.frozen else (fs.LocalFileSystem(), self.frozen)
        if store.get_file_info(name).type == fs.FileType.NotFound:
            with store.open_output_stream(name) as f:
                f.write(json.dumps(now).encode())
            return now
        with store.open_input_stream(name) as f:
            return {int(k): v for k, v in json.loads(f.read()).items()}

    def read(self, part: ShardPart):
        import pyarrow as pa
        import pyarrow.compute as pc

        need = list(dict.fromkeys([*self.columns, "collection_id"])) if self.kept is not None else self.columns
        for t in read_part(_Files(self.path), part, need):
            if self.kept is not None:
                t = t.filter(pc.or_(pc.is_null(t["collection_id"]), pc.is_in(t["collection_id"], pa.array(self.kept, t["collection_id"].type)))).select(self.columns)
            yield from t.to_batches()


class _Batch(_Reader, DataSourceReader):
    """Filters on shard, seqno and collection_id are pushed: to folders, row groups and rows."""

    def __init__(self, options, schema):
        super().__init__(options, schema)
        self.low, self.high, self.also = {}, {}, None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("shard",) and isinstance(f, (EqualTo, In)):
                mine = {int(v) for v in (value if isinstance(f, In) else [value])}
                self.owned = sorted(mine if self.owned is None else mine & set(self.owned))
            elif column == ("seqno",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.also = max(self.also or 0, int(value) - isinstance(f, GreaterThanOrEqual))
                yield f  # rows without a seqno stay with their events, so Spark looks again
            elif column == ("seqno",) and isinstance(f, (LessThan, LessThanOrEqual)):
                top = int(value) - isinstance(f, LessThan)
                self.ends = {s: min(top, self.ends.get(s, _ALL)) for s in self.shards()}
                yield f
            else:
                yield f

    def partitions(self):
        limits = self.limits()
        parts = [(s, max(self.starts.get(s, 0), self.also or 0), limits.get(s, 0)) for s in self.shards()]
        return [ShardPart(s, a, e, True) for s, a, e in parts if a < e] or [ShardPart(-1, 0, 0, False)]


class _Stream(_Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {str(s): self.starts.get(s, 0) for s in self.shards()}

    def latestOffset(self) -> dict:
        limits = self.limits()
        return {str(s): max(limits.get(s, 0), self.starts.get(s, 0)) for s in self.shards()}

    def partitions(self, start: dict, end: dict):
        first = self.initialOffset()
        parts = [(int(s), start.get(s, self.starts.get(int(s), 0)), e) for s, e in end.items()]
        return [ShardPart(s, a, e, a == first.get(str(s))) for s, a, e in parts if a < e]

    def commit(self, end: dict) -> None:
        pass


class ShardLog(DataSource):
    """Options: path; shards (owned ones, else all); starts and ends (JSON maps of seqnos by shard); collections; frozen (a file that keeps the ends of a finite read over restarts)."""

    @classmethod
    def name(cls) -> str:
        return "tidelog"

    def schema(self):
        from tidelog.schema import EVENTS

        return EVENTS

    def reader(self, schema):
        return _Batch(self.options, schema)

    def streamReader(self, schema):
        return _Stream(self.options, schema)


def register(spark) -> None:
    """Makes the format known to a session, with filters pushed to it."""
    spark.dataSource.register(ShardLog)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
