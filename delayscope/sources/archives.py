"""Flight CSVs packed in (compressed) tar archives, read as streams."""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from delayscope.schema import RAW_SCHEMA
from delayscope.sinks.scratch import scratch_path

CSV_MEMBER = r"^[^.].*\.csv$"
#: Lines of a member that leave the unpacking task together.
LINES = 10_000


class Pieces(io.RawIOBase):
    """A byte stream over the pieces of a file, each of which ends where a line feed was.

    Keeps no more than the piece at hand. ``more`` gives the next piece, None at the end.
    """

    def __init__(self, more):
        self.more, self.held, self.at = more, b"", 0

    def read(self, n: int = -1) -> bytes:
        found, wanted = [], n if n >= 0 else 1 << 62
        while wanted:
            if self.at == len(self.held):
                piece = self.more()
                if piece is None:
                    break
                self.held, self.at = piece + b"\n", 0
            part = self.held[self.at : self.at + wanted]
            self.at += len(part)
            wanted -= len(part)
            found.append(part)
        return b"".join(found)


def records(lines: Iterable[bytes]) -> Iterator[str]:
    """CSV records of a member's lines: a line feed inside quotes belongs to its record."""
    held: list[str] = []
    quotes = 0
    for line in lines:
        if not held and b'"' not in line:
            yield line.decode("utf-8", "replace").rstrip("\r\n")
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n") if not held else line.decode("utf-8", "replace").rstrip("\n")
        held.append(text)
        quotes += text.count('"')
        if quotes % 2 == 0:
            yield "\n".join(held)
            held, quotes = [], 0
    if held:
        yield "\n".join(held)


def archive_lines(spark: SparkSession, path: str | Sequence[str], name_pattern: str = "*.tar.gz", member_pattern: str = CSV_MEMBER) -> DataFrame:
    """(archive, member, line_no, line) of the CSV members of the archives below a path.

    An archive is read by Spark's text source, which unpacks gzip on the fly, and runs
    through one task as a stream: a compressed file can only be read from the front. No
    archive and no member is ever held as a whole, so neither has a size limit. Members
    whose base name does not match and empty ones are skipped, blank lines too; line 0 is
    the header. Archives that Spark would split (not compressed) are put together in order first.
    """
    reader = spark.read.option("pathGlobFilter", name_pattern).option("recursiveFileLookup", True).option("lineSep", "\n")
    pieces = reader.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("archive"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").cast("binary").alias("piece"),
    )
    if not name_pattern.endswith(".gz"):
        pieces = pieces.repartition("archive").sortWithinPartitions("archive", "block", "place")

    def unpack(batches):
        import itertools
        import posixpath
        import re
        import tarfile

        import pyarrow as pa

        keep = re.compile(member_pattern)

        def joined(batches):
            # The lines of an archive in a batch are one piece: a step per line would cost most of the time.
            for batch in batches:
                values, at = batch.column(3).to_pylist(), 0
                for archive, own in itertools.groupby(batch.column(0).to_pylist()):
                    end = at + sum(1 for _ in own)
                    yield archive, b"\n".join(values[at:end])
                    at = end

        def batch_of(archive, member, first, found):
            size = len(found)
            columns = ([archive] * size, [member] * size, range(first, first + size), found)
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["archive", "member", "line_no", "line"])

        for archive, own in itertools.groupby(joined(batches), key=lambda row: row[0]):
            stream = Pieces(lambda own=own: next((p for _, p in own), None))
            with tarfile.open(fileobj=stream, mode="r|") as packed:
                for entry in packed:
                    name = posixpath.basename(entry.name)
                    if not entry.isfile() or not keep.match(name) or entry.size == 0:
                        continue
                    filled = (r for r in records(packed.extractfile(entry)) if r.strip())
                    first = 0
                    while found := list(itertools.islice(filled, LINES)):
                        yield batch_of(archive, name, first, found)
                        first += len(found)
            for _ in own:  # what follows the end of the archive
                pass

    return pieces.mapInArrow(unpack, "archive string, member string, line_no long, line string")


def read_archives(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                  name_pattern: str = "*.tar.gz", member_pattern: str = CSV_MEMBER) -> DataFrame:
    """Rows of the CSV members of all archives below a path, as text columns bound by header name.

    Adds ``archive`` and ``member``. The lines are unpacked once, stored and dealt evenly;
    parsing them is Spark's own CSV parser, in parallel however few archives there are. Members
    are grouped by their header line, and each group is bound to its own; columns a member
    lacks are NULL, as are empty fields.
    """
    wanted = list(columns or RAW_SCHEMA.fieldNames())
    stored = scratch_path(spark, "archive-lines")
    archive_lines(spark, path, name_pattern, member_pattern).hint("rebalance").write.parquet(stored)
    lines = spark.read.parquet(stored)
    heads = lines.where("line_no = 0").select("archive", "member", F.col("line").alias("header"))
    bound = lines.where("line_no > 0").join(heads, ["archive", "member"])
    groups = []
    for (header,) in heads.select("header").distinct().orderBy("header").toLocalIterator():
        names = _fields(spark, header)
        layout = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        parsed = bound.where(F.col("header") == header).select("archive", "member", F.from_csv("line", F.lit(layout.simpleString()[7:-1].replace(":", " ")), {"nullValue": "", "mode": "PERMISSIVE"}).alias("r"))
        at = {name: i for i, name in reversed(list(enumerate(names)))}
        groups.append(parsed.select("archive", "member", *(
            (F.col(f"r.c{at[w]}") if w in at else F.lit(None).cast("string")).alias(w) for w in wanted
        )))
    if not groups:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in ("archive", "member", *wanted)))
    return reduce(DataFrame.unionByName, groups)


def _fields(spark: SparkSession, header: str) -> list[str]:
    """The names in a header line, by the rules of CSV."""
    import csv

    return [name.strip().lstrip("﻿") for name in next(csv.reader([header]))]
