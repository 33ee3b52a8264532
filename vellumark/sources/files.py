"""Text documents, attachments and zip packages as DataFrames."""

from __future__ import annotations

import hashlib
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import NativeFile
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumark.functions.values import media_type
from vellumark.session import bounded_batches, stored
from vellumark.sources.filesystem import list_folder, open_file_system, publish, stat_paths

HEAD_LINES = 50
FILES_PER_RUN = 10
PROCESSED_MARK = "_Processed"
TASK_BYTES = 256 << 20  # bytes and files one task reads
TASK_FILES = 1000
OPENED_BATCH = 100  # files whose content a task holds before passing it on
BLOCK = 1 << 20

# Leading bytes (hex) of image formats.
IMAGE_MAGIC = ("89504E47", "FFD8FF", "47494638", "49492A00", "4D4D002A", "424D")
PDF_MAGIC = "25504446"


def write_named_texts(df: DataFrame, folder: str) -> str:
    """One text file per row of (name, text). Returns the folder."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = open_file_system(folder)
        system.create_dir(root, recursive=True)
        for pdf in batches:
            for name, text in zip(pdf["name"], pdf["text"]):
                part = f"{root}/_{uuid.uuid4().hex}"  # hidden until it is complete
                with system.open_output_stream(part) as out:
                    out.write(text.encode())
                publish(system, part, f"{root}/{name}")
            yield pdf[["name"]]

    df.select("name", "text").mapInPandas(write, "name string").agg(F.count("name")).first()
    return folder


def write_spread_texts(df: DataFrame, folder: str, folders: int) -> list[str]:
    """One text file per row of (name, text), over `folders` folders by the name; returns those that hold any.

    Tasks hardly meet in a folder, and each folder is listed by a task of its own.
    """
    bounded_batches(df.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = open_file_system(folder)
        used: set[str] = set()
        for pdf in batches:
            for name, text in zip(pdf["name"], pdf["text"]):
                own = f"{zlib.crc32(str(name).encode()) % folders:06d}"
                if own not in used:
                    system.create_dir(f"{root}/{own}", recursive=True)
                    used.add(own)
                part = f"{root}/{own}/_{uuid.uuid4().hex}"  # hidden until it is complete
                with system.open_output_stream(part) as out:
                    out.write(text.encode())
                publish(system, part, f"{root}/{own}/{name}")
        yield pd.DataFrame({"folder": sorted(used)}, dtype=object)

    written = df.select("name", "text").mapInPandas(write, "folder string").distinct().collect()  # at most `folders` rows
    return sorted(f"{folder}/{r['folder']}" for r in written)


LISTING = "name string, path string, size bigint, modified timestamp"


def list_files(spark: SparkSession, *folders: str) -> DataFrame:
    """name, path, size, modified of the files directly in the folders, a task per folder.

    Unlike Spark's file sources this keeps empty files. The listing is written
    down, so that every later step sees the same files.
    """
    numbered = spark.createDataFrame(list(enumerate(folders)), "n int, folder string")
    wanted = numbered.repartitionById(max(len(folders), 1), F.col("n")).select("folder")  # no two folders in one task

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for folder in pdf["folder"]:
                yield from list_folder(folder)

    return stored(wanted.mapInPandas(run, LISTING), "listing")


def stat_files(references: DataFrame, column: str = "path") -> DataFrame:
    """A listing of the files that rows refer to, each once; those that are not there are left out.

    For collections too large for one listing: every task asks for its own
    paths, so nothing is listed and the work spreads with the references.
    """
    paths = references.select(F.col(column).alias("path")).where("path is not null").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield stat_paths(pdf["path"].tolist())

    return stored(paths.mapInPandas(run, LISTING), "listing")


def spread(files: DataFrame) -> DataFrame:
    """A listing over as many tasks as its bytes and number of files ask for."""
    whole = files.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    tasks = max((whole["bytes"] or 0) // TASK_BYTES, whole["n"] // TASK_FILES, 1)
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(int(min(max(tasks, cores), max(whole["n"], 1))), "path")


def _with_each(files: DataFrame, column: str, read: Callable[[NativeFile], str]) -> DataFrame:
    """Add a string column computed from every opened file; files are read in blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), OPENED_BATCH):
                some = pdf.iloc[at : at + OPENED_BATCH]
                out = []
                for path in some["path"]:
                    system, inner = open_file_system(path)
                    with system.open_input_stream(inner) as data:
                        out.append(read(data))
                yield some.assign(**{column: out})

    return spread(files).mapInPandas(run, f"{LISTING}, {column} string")


def _text_of(data: NativeFile) -> str:
    return data.read().decode("utf-8", errors="ignore")


def _digest_of(data: NativeFile) -> str:
    sha = hashlib.sha256()
    while block := data.read(BLOCK):
        sha.update(block)
    return sha.hexdigest()


def _magic_of(data: NativeFile) -> str:
    return data.read(4).hex().upper()


def read_texts(files: DataFrame) -> DataFrame:
    """Add `text` to a listing; bytes that are not UTF-8 are left out."""
    return _with_each(files, "text", _text_of)


def text_head(text: Column, lines: int = HEAD_LINES) -> Column:
    """The first lines, with their line breaks."""
    parts = F.split(text, "\n", -1)
    head = F.array_join(F.slice(parts, 1, lines), "\n")
    return F.when(F.size(parts) > lines, F.concat(head, F.lit("\n"))).otherwise(text)


def unprocessed(df: DataFrame) -> DataFrame:
    """Text documents not yet marked as processed."""
    return df.filter(F.endswith("name", F.lit(".txt")) & ~F.contains("name", F.lit(PROCESSED_MARK)))


def intake(df: DataFrame, order_by: str, files: int = FILES_PER_RUN) -> DataFrame:
    """The next files of a run, in name order."""
    return df.orderBy(order_by).limit(files)


def read_text_heads(spark: SparkSession, folder: str | list[str], files: int = FILES_PER_RUN) -> DataFrame:
    """name, head of the next unprocessed files of one folder or several; only those files are read."""
    folders = [folder] if isinstance(folder, str) else folder
    chosen = intake(unprocessed(list_files(spark, *folders)), "name", files)
    return read_texts(chosen).select("name", text_head(F.col("text")).alias("head")).orderBy("name")


def mark_processed(files: DataFrame) -> DataFrame:
    """Rename the text files of a listing so that later runs skip them; returns the new names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            renamed = []
            for path in pdf["path"]:
                system, inner = open_file_system(path)
                target = inner.removesuffix(".txt") + PROCESSED_MARK + ".txt"
                publish(system, inner, target)
                renamed.append(target.rsplit("/", 1)[1])
            yield pdf[["path"]].assign(name=renamed)

    return stored(spread(files).select("path").mapInPandas(run, "path string, name string"), "processed")


def attachments(files: DataFrame) -> DataFrame:
    """Add checksum, content_name and mimetype to a listing.

    Files are digested in blocks, so their size is not limited.
    """
    digest = F.col("sha256")
    return _with_each(files, "sha256", _digest_of).select(
        *files.columns,
        F.base64(F.unhex(digest)).alias("checksum"),
        F.concat(F.lit("ea_"), digest).alias("content_name"),
        media_type(F.col("name")).alias("mimetype"),
    )


def document_kinds(files: DataFrame) -> DataFrame:
    """Add `kind`, pdf, image or text, by the leading bytes; no more is read."""
    magic = F.col("magic")
    image = F.lit(False)
    for m in IMAGE_MAGIC:
        image = image | F.startswith(magic, F.lit(m))
    kind = F.when(magic == PDF_MAGIC, "pdf").when(image, "image").otherwise("text")
    return _with_each(files, "magic", _magic_of).withColumn("kind", kind).drop("magic")


def _test_zip(path: str) -> bool:
    system, at = open_file_system(path)
    try:
        with system.open_input_file(at) as raw, zipfile.ZipFile(raw) as z:
            return z.testzip() is None
    except (zipfile.BadZipFile, zlib.error, EOFError, OSError, ValueError, RuntimeError, NotImplementedError):
        return False


def check_zips(files: DataFrame) -> DataFrame:
    """path, modified, valid of the zips in a listing: valid when every entry passes its CRC check."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(valid=[_test_zip(p) for p in pdf["path"]])

    zips = files.filter(F.endswith(F.lower("name"), F.lit(".zip")))
    return (
        spread(zips)
        .select("path", "modified")
        .mapInPandas(check, "path string, modified timestamp, valid boolean")
    )


def newest_valid_zip(checked: DataFrame) -> str:
    """Path of the newest valid package; raises when there is none."""
    newest = F.max_by("path", F.struct("modified", "path"))
    path = checked.filter("valid").agg(newest.alias("path")).first()["path"]
    if path is None:
        raise FileNotFoundError("no valid package")
    return path
