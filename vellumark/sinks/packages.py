"""Zip packages: payload, descriptor and the attachments of each package."""

from __future__ import annotations

import hashlib
import shutil
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumark.functions.formats import DESCRIPTOR_NAME, PAYLOAD_NAME
from vellumark.operators.skew import join_unique
from vellumark.sources.filesystem import open_file_system, publish

_STAMP = (1980, 1, 1, 0, 0, 0)  # fixed, so equal content gives an equal zip
_BLOCK = 1 << 20
PACKAGE_ROW = "package_id bigint, path string, files int, bytes bigint, sha string, error string"


class _Digest:
    """Output stream that also hashes what it writes."""

    def __init__(self, out):
        self.out, self.sha, self.size = out, hashlib.sha256(), 0

    def write(self, data):
        self.sha.update(data)
        self.size += len(data)
        return self.out.write(data)

    def flush(self):
        self.out.flush()


def _write_package(package, folder: str, holding: str, limit: int | None) -> dict:
    """Write one zip; attachments are streamed from where they lie."""
    row = {"package_id": package.package_id, "path": None, "files": 0, "bytes": 0, "sha": None, "error": None}
    if package.payload is None:
        return {**row, "error": "no records"}
    if package.fault:
        return {**row, "error": package.fault}
    texts = [(PAYLOAD_NAME, package.payload), (DESCRIPTOR_NAME, package.descriptor)]
    total = sum(len(t.encode()) for _, t in texts) + sum(int(a["size"] or 0) for a in package.files)
    absent = sorted(a["name"] for a in package.files if a["path"] is None)
    if absent:
        return {**row, "error": "missing attachment: " + ", ".join(absent)}
    if limit is not None and total > limit:
        return {**row, "error": f"{total} bytes exceed the limit of {limit}"}
    token = uuid.UUID(hashlib.sha256(package.payload.encode()).hexdigest()[:32])
    system, root = open_file_system(folder)
    system.create_dir(root, recursive=True)
    target = f"{root}/{holding}_{package.package_id}-{token}.zip"
    part = f"{root}/_{uuid.uuid4().hex}"  # hidden until it is complete
    with system.open_output_stream(part) as raw:
        out = _Digest(raw)
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in texts:
                z.writestr(zipfile.ZipInfo(name, _STAMP), text, zipfile.ZIP_DEFLATED)
            for a in sorted(package.files, key=lambda a: a["name"]):
                info = zipfile.ZipInfo(a["name"], _STAMP)
                info.compress_type = zipfile.ZIP_DEFLATED
                info.file_size = int(a["size"] or 0)  # tells the writer which entries need 64-bit sizes
                source, path = open_file_system(a["path"])
                with source.open_input_stream(path) as data, z.open(info, "w") as entry:
                    shutil.copyfileobj(data, entry, _BLOCK)
    publish(system, part, target)
    row.update(path=target, files=len(texts) + len(package.files), bytes=out.size, sha=out.sha.hexdigest())
    return row


def write_packages(packages: DataFrame, folder: str, holding: str, limit: int | None = None) -> DataFrame:
    """Write a zip per row of (package_id, payload, descriptor, files) and perhaps `fault`.

    `files` is an array of (name, path, size). A package with a fault or a
    missing attachment, or one of more bytes than `limit`, gives a row with an
    error and no zip.
    Names derive from the content, so running again replaces a zip by itself.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [_write_package(p, folder, holding, limit) for p in pdf.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PACKAGE_ROW.split(", ")])

    fault = F.col("fault") if "fault" in packages.columns else F.lit(None).cast("string").alias("fault")
    chosen = packages.select("package_id", "payload", "descriptor", "files", fault)
    return chosen.mapInPandas(run, PACKAGE_ROW)


def with_package_files(documents: DataFrame, package_files: DataFrame, files: DataFrame) -> DataFrame:
    """Add the array of attachments, each with its path, to the package documents."""
    located = join_unique(package_files.select("package_id", "name"), files.select("name", "path", "size"), "name")
    grouped = located.groupBy("package_id").agg(F.collect_list(F.struct("name", "path", "size")).alias("files"))
    empty = F.array().cast("array<struct<name:string,path:string,size:bigint>>")
    return documents.join(grouped, "package_id", "left").withColumn("files", F.coalesce("files", empty))
