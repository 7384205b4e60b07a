"""Small files beside the tables, in whatever store the paths name: commit files, markers, and removal of old folders."""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DIGITS = 20


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The visible names in a folder; none if it is not there."""
    place, fs = _fs(spark, folder)
    if not fs.exists(place):
        return []
    return sorted(n for s in fs.listStatus(place) if not (n := s.getPath().getName()).startswith((".", "_")))


def remove(spark: SparkSession, path: str) -> None:
    place, fs = _fs(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    place, fs = _fs(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole small file, unless there is one of that name: False then.

    The text is written aside and renamed without overwriting, so that readers see it whole and one of two writers wins. The
    store must refuse such a rename where the name is taken, as HDFS does.
    """
    place, fs = _fs(spark, path)
    jvm = spark._jvm
    aside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(place), how)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def put_number(spark: SparkSession, folder: str, number: int, text: str = "") -> bool:
    """The file of a number, such as a commit; False if it is taken."""
    return put_if_absent(spark, f"{folder}/{number:0{DIGITS}d}", text)


def read_number(spark: SparkSession, folder: str, number: int) -> str:
    return read_text(spark, f"{folder}/{number:0{DIGITS}d}")


def last_number(spark: SparkSession, folder: str) -> int:
    """The largest number that has a file; -1 if there is none."""
    return max((int(n) for n in names(spark, folder) if n.isdigit()), default=-1)


def remove_numbers_below(spark: SparkSession, folder: str, number: int) -> None:
    for name in names(spark, folder):
        if name.isdigit() and int(name) < number:
            remove(spark, f"{folder}/{name}")
