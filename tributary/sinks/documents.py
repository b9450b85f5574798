"""Raw layer of one document per fetch: ``raw/<source>/<source>_<stamp>.json``.

The layout that existing tools read: every response is one file, an indented JSON document
in the source's folder. A load of several responses has their numbers behind the stamp
(``<source>_<stamp>-<seq>.json``). The files are written by the tasks to a hidden folder and
take their names when the whole job has succeeded; a failed job leaves none.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tributary.sources.rest import response_struct

STAMP = "%Y%m%d_%H%M%S"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[int, str]]  # seq and hidden path


class DocumentWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.folder, self.source, self.stamp = (options[k] for k in ("path", "source", "stamp"))
        self.folder = self.folder.rstrip("/")
        self.hidden = f"{self.folder}/_writing-{uuid.uuid4().hex}"

    def _open(self, url: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(url)

    def write(self, rows) -> Written:
        files, path = self._open(f"{self.hidden}/{uuid.uuid4().hex}")  # each attempt writes for itself
        written = []
        for row in rows:
            if row["error"] is not None or row["body"] is None:
                continue
            if not written:
                files.create_dir(path, recursive=True)
            name = f"{path}/{len(written)}.json"
            text = json.dumps(json.loads(row["body"]), indent=2)
            with files.open_output_stream(name) as out:
                out.write(text.encode())
            written.append((row["seq"], name))
        return Written(written)

    def commit(self, messages) -> None:
        files, folder = self._open(self.folder)
        found = [f for m in messages if m is not None for f in m.files]
        names = {}
        for seq, path in found:
            suffix = f"-{seq}" if len(found) > 1 else ""
            target = f"{folder}/{self.source}_{self.stamp}{suffix}.json"
            if target in names:
                self.abort(messages)
                raise ValueError(f"two responses of {self.source!r} have the number {seq}")
            names[target] = path
        for target, path in names.items():
            files.move(path, target)
        self.abort(messages)

    def abort(self, messages) -> None:
        from pyarrow import fs

        files, hidden = self._open(self.hidden)
        if files.get_file_info(hidden).type == fs.FileType.Directory:
            files.delete_dir(hidden)


class DocumentsSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_documents"

    def schema(self):
        return response_struct()

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return DocumentWriter(self.options)


def write_documents(responses: DataFrame, root: str, source: str, stamp: str | None = None) -> str:
    """Responses (``seq``, ``body`` and optionally ``error``) → one document each; returns the stamp.

    Responses without a body, and failed ones, are left out; a body that is not JSON fails
    the job, and so do two responses of one number. Numbers must be given and not negative.
    A second load with the same stamp replaces documents of the same name.
    """
    from tributary.session import ship_package

    spark = responses.sparkSession
    ship_package(spark)
    spark.dataSource.register(DocumentsSink)
    stamp = stamp or _dt.datetime.now().strftime(STAMP)
    cols = [F.col(f.name) if f.name in responses.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in response_struct().fields]
    out = responses.select(*cols)
    seq = F.when(F.col("seq") >= 0, F.col("seq")).otherwise(F.raise_error(F.lit("a response needs a number")).cast("bigint"))
    (out.withColumn("seq", seq).write.format("json_documents").mode("append")
     .options(source=source, stamp=stamp).save(f"{root.rstrip('/')}/raw/{source}"))
    return stamp
