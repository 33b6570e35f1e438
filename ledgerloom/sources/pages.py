"""Captured pages: gzip files in sharded folders, and as a table."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.urls import safe_name, shard

#: Longer pages are cut here when they are stored.
MAX_BYTES = 3_000_000


def stored_path(domain: Column, page_type: Column) -> Column:
    """shard/host/type.html.gz, the place of a page below the store's root."""
    return F.concat_ws("/", shard(domain), safe_name(domain), F.concat(page_type, F.lit(".html.gz")))


def read_stored(spark: SparkSession, root: str) -> DataFrame:
    """(stored_path, html) of all gzip pages below ``root``; bytes that are no UTF-8 are replaced, unreadable files skipped."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b.path, b.content):
                try:
                    out.append((path, gzip.decompress(content).decode("utf-8", "replace")))
                except (OSError, EOFError):
                    continue
            yield pd.DataFrame(out, columns=["path", "html"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.html.gz").load(root).select("path", "content")
    pages = files.mapInPandas(unpack, "path string, html string")
    return pages.select(F.array_join(F.slice(F.split("path", "/"), -3, 3), "/").alias("stored_path"), "html")


def write_stored(pages: DataFrame, root: str) -> DataFrame:
    """Writes (stored_path, html) as gzip files below ``root``, a folder all executors reach (a path or the address of a shared file system);
    (stored_path, byte_size) of what was written. A page written twice replaces itself."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        made = set()
        for b in batches:
            out = []
            for path, html in zip(b.stored_path, b.html):
                data = gzip.compress(html.encode("utf-8")[:MAX_BYTES], mtime=0)
                folder, _, name = f"{base}/{path}".rpartition("/")
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(f"{folder}/.{name}.part") as f:
                    f.write(data)
                store.move(f"{folder}/.{name}.part", f"{folder}/{name}")
                out.append((path, len(data)))
            yield pd.DataFrame(out, columns=["stored_path", "byte_size"])

    return pages.select("stored_path", "html").where("stored_path is not null and html is not null").mapInPandas(pack, "stored_path string, byte_size long")
