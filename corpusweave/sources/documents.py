"""A sink of text documents: one file each, in place only if the whole write succeeds."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Parts of a document: what stands before its lines, the lines, and what stands after them.
HEAD, LINE, FOOT = 0, 1, 2
SCHEMA = "name string, part int, text string"


def _files(path: str):
    """The file system of a path or URI (all that pyarrow knows), and the path in it."""
    from pathlib import Path

    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else str(Path(path).absolute()))


@dataclass
class _Staged(WriterCommitMessage):
    names: list[tuple[str, str]]  # a document's file name, and where it is staged


class TextDocuments(DataSource):
    """Rows (name, part, text) to a file `<name><ending>` for each name. Rows of a name must come to one task, one after the other; see `write_documents`.

    Options: path (a folder that all executors reach), ending, separator (between lines). Tasks write into a staging folder; the driver moves
    the files when all tasks have succeeded, and with mode overwrite then deletes the files of the same ending that were not written. If a task
    fails for good, the staging folder goes and what was there before stays as it was.
    """

    @classmethod
    def name(cls) -> str:
        return "text_documents"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], self.options.get("ending", ".txt"), self.options.get("separator", "\n"), overwrite)


class _Writer(DataSourceWriter):
    def __init__(self, path: str, ending: str, separator: str, overwrite: bool):
        self.path, self.ending, self.separator, self.overwrite = path, ending, separator, overwrite
        self.stage = f"_staged-{uuid4().hex}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        files, root = _files(self.path)
        place = posixpath.join(root, self.stage, uuid4().hex)  # an attempt's own: another one of the same task doesn't meet it
        files.create_dir(place, recursive=True)
        names: list[tuple[str, str]] = []
        out, now, lines = None, None, 0
        try:
            for name, part, text in iterator:
                if out is None or name != now:
                    if out is not None:
                        out.close()
                    now, lines = name, 0
                    names.append((quote(name or "", safe=" ") + self.ending, posixpath.join(place, str(len(names)))))
                    out = files.open_output_stream(names[-1][1])
                if part == LINE:
                    text = (self.separator if lines else "") + text
                    lines += 1
                out.write(text.encode())
        finally:
            if out is not None:
                out.close()
        return _Staged(names)

    def commit(self, messages: list) -> None:
        files, root = _files(self.path)
        staged = [x for m in messages if m is not None for x in m.names]
        if len({n for n, _ in staged}) < len(staged):
            self.abort(messages)
            raise ValueError("rows of one document came to several tasks, or not one after the other")
        for name, place in staged:
            to = posixpath.join(root, name)
            if files.get_file_info(to).type.name != "NotFound" and files.type_name != "local":
                files.delete_file(to)
            files.move(place, to)
        files.delete_dir(posixpath.join(root, self.stage))
        if self.overwrite:
            from pyarrow import fs

            new = {n for n, _ in staged}
            for f in files.get_file_info(fs.FileSelector(root)):
                if f.is_file and f.base_name.endswith(self.ending) and f.base_name not in new:
                    files.delete_file(f.path)

    def abort(self, messages: list) -> None:
        files, root = _files(self.path)
        if files.get_file_info(posixpath.join(root, self.stage)).type.name == "Directory":
            files.delete_dir(posixpath.join(root, self.stage))


def write_documents(rows: DataFrame, path: str, ending: str, separator: str = "\n", *order: str) -> None:
    """Rows (name, part, text and what orders lines) as a file for each name, in place of the files that were there. A document is written as a stream by one
    task, sorted by Spark, so it may be larger than memory; deal very large ones over several names before."""
    rows.sparkSession.dataSource.register(TextDocuments)
    dealt = rows.repartition("name").sortWithinPartitions("name", "part", *(order or ("text",))).select("name", F.col("part").cast("int").alias("part"), "text")
    dealt.write.format("text_documents").mode("overwrite").options(path=path, ending=ending, separator=separator).save()
