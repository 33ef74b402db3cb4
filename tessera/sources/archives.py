"""Archives as a source: the files within zip, tar and compressed tar files, nested ones too, as rows."""

from __future__ import annotations

import io
import os
import tarfile
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Endings of archives.
ENDINGS = (".zip", ".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")


def members(content: bytes, name: str, nested: bool = True) -> Iterator[tuple[str, bytes]]:
    """(path, content) of the files of an archive; an archive within it is opened where it lies, below its own name."""
    if name.endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for entry in archive.infolist():
                if not entry.is_dir():
                    yield from _opened(entry.filename, archive.read(entry), nested)
        return
    with tarfile.open(fileobj=io.BytesIO(content)) as archive:
        for entry in archive:
            if entry.isfile() and (file := archive.extractfile(entry)):
                yield from _opened(entry.name, file.read(), nested)


def _opened(path: str, content: bytes, nested: bool) -> Iterator[tuple[str, bytes]]:
    if nested and path.endswith(ENDINGS):
        for inner, own in members(content, path):
            yield f"{path}/{inner}", own
    else:
        yield path, content


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """archive, path, content of every file in the archives below a folder; an archive is opened in one task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def rows(batches):
        import pandas as pd

        for batch in batches:
            for archive, content in zip(batch.path, batch.content, strict=True):
                if archive.endswith(ENDINGS):
                    for inner, own in members(bytes(content), archive):
                        yield pd.DataFrame({"archive": [archive], "path": [inner], "content": [own]})

    return files.mapInPandas(rows, "archive string, path string, content binary")


def unpack(archive: str, folder: str, nested: bool = True) -> list[str]:
    """Writes an archive's files below a folder; a path that leads out of it is an error, and then nothing is written."""
    with open(archive, "rb") as file:
        found = list(members(file.read(), archive, nested))
    root = os.path.realpath(folder)
    targets = [os.path.realpath(os.path.join(root, path)) for path, _ in found]
    for (path, _), target in zip(found, targets, strict=True):
        if not target.startswith(root + os.sep):
            raise ValueError(f"{path} leads out of the folder")
    for (_, content), target in zip(found, targets, strict=True):
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "wb") as out:
            out.write(content)
    return targets
