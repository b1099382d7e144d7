"""One JSON file a document as a sink of Spark's writer, with a commit: a failed job leaves no file.

    spark.dataSource.register(DocumentFiles)
    per_document.write.format("document_files").mode("append").save(folder)

Tasks write to a staging folder of the job, each attempt to a folder of its own; only when all tasks have succeeded are
the files of the attempts that count moved to their places, and on a failure the staging folder goes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Files that are moved at a time.
MOVERS = 16


@dataclass
class Staged(WriterCommitMessage):
    """What one task has written: its folder, and the files' names."""

    folder: str
    names: list[str]


class DocumentFiles(DataSource):
    """Rows (doc_id, json) to <doc_id>.json, indented, in a path or address that pyarrow's file systems know. Files of
    the same documents are replaced; with mode overwrite all others go, too."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return DocumentWriter(self.options["path"], [schema.fieldNames().index(c) for c in ("doc_id", "json")], overwrite)


class DocumentWriter(DataSourceWriter):
    def __init__(self, path: str, columns: list[int], overwrite: bool):
        self.path, self.columns, self.overwrite = path, columns, overwrite
        self.job = f"_staging-{uuid.uuid4().hex}"

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        store, folder = self._store()
        own, names = f"{folder}/{self.job}/{uuid.uuid4().hex}", []
        store.create_dir(own, recursive=True)
        for r in iterator:
            doc_id, body = (r[c] for c in self.columns)
            with store.open_output_stream(f"{own}/{doc_id}.json") as out:
                out.write(json.dumps(json.loads(body), ensure_ascii=False, indent=2).encode())
            names.append(f"{doc_id}.json")
        return Staged(own, names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, folder = self._store()
        moves = [(f"{m.folder}/{n}", f"{folder}/{n}") for m in messages if m for n in m.names]
        if self.overwrite:
            new = {to for _, to in moves}
            for old in store.get_file_info(fs.FileSelector(folder)):
                if old.path.endswith(".json") and old.is_file and f"{folder}/{old.base_name}" not in new:
                    store.delete_file(old.path)
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda m: store.move(*m), moves))
        self._clear(store, folder)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*self._store())

    def _clear(self, store: fs.FileSystem, folder: str) -> None:
        if store.get_file_info(f"{folder}/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{folder}/{self.job}")
