"""Small steps on the file system behind a path, whatever kind it is: through Spark's own classes."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_COPY_BYTES = 1 << 20


def folder(spark: SparkSession, path: str):
    """The path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = folder(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder this library wrote; one that is not there is no error."""
    place, system = folder(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none where there is no such folder."""
    place, system = folder(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, None where there is none."""
    place, system = folder(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, compressed ones too; nothing beyond it is parsed."""
    jvm = spark._jvm
    place, system = folder(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(place)
    stream = system.open(place)
    try:
        source = stream if codec is None else codec.createInputStream(stream)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears in one step, in place of a former one."""
    above, name = path.rsplit("/", 1)
    beside = f"{above}/.{name}.{uuid.uuid4().hex}"
    place, system = folder(spark, beside)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    replace(spark, beside, path)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another one in one step."""
    jvm, gateway = spark._jvm, spark._sc._gateway
    start, end = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(start.toUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context.rename(start, end, options)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder its final name, which nothing may have."""
    place, system = folder(spark, source)
    if not system.rename(place, folder(spark, target)[0]):
        raise OSError(f"cannot rename {source} to {target}")


def join_files(spark: SparkSession, sources: list[str], target: str) -> None:
    """One file from several, in order: by the file system itself where it can, else by copying.

    A copy streams through a fixed buffer; no task and no table holds the content.
    """
    jvm = spark._jvm
    place, system = folder(spark, target)
    parts = [folder(spark, s)[0] for s in sources]
    if not system.exists(place):
        system.create(place, True).close()
    kept = [p for p in parts if system.getFileStatus(p).getLen() > 0]
    try:
        array = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(kept))
        for i, p in enumerate(kept):
            array[i] = p
        system.concat(place, array)
        return
    except Exception as error:  # noqa: BLE001 - only what says that the file system cannot
        if "UnsupportedOperationException" not in f"{type(error).__name__}: {error}":
            raise
    above, name = target.rsplit("/", 1)
    before = f"{above}/.{name}.{uuid.uuid4().hex}"
    out = system.create(folder(spark, before)[0], True)
    try:
        for p in [place, *kept]:
            stream = system.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, _COPY_BYTES, False)
            finally:
                stream.close()
    finally:
        out.close()
    replace(spark, before, target)
