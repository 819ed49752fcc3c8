"""Small metadata files on any file system the cluster uses: written once, in sight only when whole."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

#: Entries of a log in one folder, so that listing the newest is bounded.
_FOLDER = 1000


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _place(spark, path)
    return fs.exists(place)


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether a Spark write to ``folder`` has ended."""
    return exists(spark, f"{folder}/_SUCCESS")


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, sorted, without temporary files; nothing if it is absent."""
    place, fs = _place(spark, folder)
    if not fs.exists(place):
        return []
    return sorted(n for s in fs.listStatus(place) if (n := s.getPath().getName())[:1] not in "._")


def make_folder(spark: SparkSession, folder: str) -> None:
    place, fs = _place(spark, folder)
    fs.mkdirs(place)


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target and rename, so a death on the way leaves a temporary file that nobody reads."""
    place, fs = _place(spark, path)
    if fs.exists(place):
        raise FileExistsError(path)
    aside, _ = _place(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(aside, place):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    place, fs = _place(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class NumberedLog:
    """Entries 0, 1, 2, ... of one writer, each a small JSON file under ``root/<thousands>/<number>.json``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, number: int) -> str:
        return f"{self.root}/{number // _FOLDER:09d}/{number:012d}.json"

    def newest(self) -> int:
        """The highest number, -1 without entries."""
        for folder in reversed(names(self.spark, self.root)):
            entries = names(self.spark, f"{self.root}/{folder}")
            if entries:
                return int(entries[-1].removesuffix(".json"))
        return -1

    def numbers(self, after: int = -1) -> list[int]:
        """The numbers beyond ``after``, ascending."""
        found = []
        for folder in names(self.spark, self.root):
            if int(folder) >= (after + 1) // _FOLDER:
                found += [int(n.removesuffix(".json")) for n in names(self.spark, f"{self.root}/{folder}")]
        return [n for n in found if n > after]

    def has(self, number: int) -> bool:
        return exists(self.spark, self.path(number))

    def read(self, number: int) -> dict:
        return json.loads(read_text(self.spark, self.path(number)))

    def write(self, number: int, entry: dict) -> None:
        write_once(self.spark, self.path(number), json.dumps({"number": number, **entry}))
