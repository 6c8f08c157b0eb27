"""A sink that takes row by row, each partition of each epoch once."""

from __future__ import annotations

import json
import logging
import uuid

from pyspark import TaskContext
from pyspark.sql import Row

log = logging.getLogger("pulsegrid")


class RowFiles:
    """Messages as JSON lines, a file for each partition of each epoch, for `runner.start(rows=...)`.

    A file appears whole when its partition is done. `open` refuses a partition and epoch whose file is
    there, so an epoch that is repeated writes nothing twice; a stream's id is part of the path, so other
    streams and new checkpoints don't meet. Messages without payload aren't rows: they are logged, and
    kept below `empty` by topic, partition and offset. The folder must be on a file system that pyarrow knows.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def open(self, partition_id: int, epoch_id: int) -> bool:
        from pyarrow import fs

        self.fs, root = fs.FileSystem.from_uri(self.path) if ":" in self.path else (fs.LocalFileSystem(), self.path)
        task = TaskContext.get()
        stream = (task.getLocalProperty("sql.streaming.queryId") if task else None) or "none"
        self.at = {kind: f"{root}/{kind}/stream={stream}/epoch={epoch_id}" for kind in ("rows", "empty")}
        self.name, self.making = f"partition-{partition_id:05d}.json", f".making-{partition_id}-{uuid.uuid4().hex}"
        self.out = {}
        return not self._there("rows")

    def _there(self, kind: str) -> bool:
        from pyarrow import fs

        return self.fs.get_file_info(f"{self.at[kind]}/{self.name}").type != fs.FileType.NotFound

    def _put(self, kind: str, line: dict) -> None:
        if kind not in self.out:
            self.fs.create_dir(self.at[kind])
            self.out[kind] = self.fs.open_output_stream(f"{self.at[kind]}/{self.making}")
        self.out[kind].write(json.dumps(line).encode() + b"\n")

    def process(self, row: Row) -> None:
        place = {"topic": row["topic"], "partition": row["partition"], "offset": row["offset"]}
        if not row["value"]:
            log.warning("empty payload: %s", place)
            self._put("empty", place)
        else:
            self._put("rows", place | {"value": bytes(row["value"]).decode(errors="replace")})

    def close(self, error: Exception | None) -> None:
        for kind in ("empty", "rows"):  # the file that `open` looks for comes last
            if kind in self.out:
                self.out[kind].close()
                made = f"{self.at[kind]}/{self.making}"
                self.fs.delete_file(made) if error else self.fs.move(made, f"{self.at[kind]}/{self.name}")
