"""Where document texts come from."""

from __future__ import annotations

import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit
from urllib.request import url2pathname

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvec.functions.text import has_visible, html_to_text, looks_like_html

Fetch = Callable[[str], bytes]
Extract = Callable[[bytes], str]

FETCH_TIMEOUT_SEC = 60
URIS_PER_TASK = 200


def uri_list(spark: SparkSession, path: str, per_task: int = URIS_PER_TASK) -> DataFrame:
    """One URI per line, each once, spread over tasks for fetching: as many as the list
    needs at ``per_task`` each, and one per core at least."""
    lines = spark.read.text(path).toDF("uri").filter(F.length("uri") > 0).dropDuplicates(["uri"])
    wanted = -(-lines.count() // per_task)
    return lines.repartition(max(wanted, spark.sparkContext.defaultParallelism))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``uri`` and ``content`` of all files under a path, without a URI list."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("uri"), "content")


class Files:
    """Source over files under a path, read by Spark and with its credentials.

    ``listing`` gives ``uri``, ``size`` and ``modified`` without reading a file; called, it
    extracts ``uri``, ``text`` and ``error`` of all files or of those in a table of URIs.
    The first stage keeps the listing of files that it extracted and passes over those
    that are still the same.
    """

    def __init__(self, spark: SparkSession, path: str, extract: Extract | None = None, pattern: str | None = None):
        self.spark, self.path, self.extract, self.pattern = spark, path, extract or decode, pattern

    def _files(self) -> DataFrame:
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if self.pattern:
            reader = reader.option("pathGlobFilter", self.pattern)
        return reader.load(self.path)

    def listing(self) -> DataFrame:
        return self._files().select(
            F.col("path").alias("uri"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
        )

    def __call__(self, uris: DataFrame | None = None) -> DataFrame:
        files = self._files().select(F.col("path").alias("uri"), "content")
        if uris is not None:
            files = files.join(uris, "uri", "left_semi")
        return extract_files(files, self.extract)


def fetch_uri(uri: str, timeout: float = FETCH_TIMEOUT_SEC) -> bytes:
    """Bytes behind a URI: a web address, a local file or an object store."""
    parts = urlsplit(uri)
    if parts.scheme in ("http", "https"):
        with urllib.request.urlopen(uri, timeout=timeout) as response:
            return response.read()
    if parts.scheme in ("", "file"):
        with open(url2pathname(parts.path), "rb") as handle:
            return handle.read()
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    with system.open_input_stream(path) as stream:
        return stream.read()


def decode(content: bytes) -> str:
    return content.decode("utf-8", errors="replace")


def _visible_text(raw: DataFrame) -> DataFrame:
    html = F.when(looks_like_html("text"), html_to_text("text"))
    return raw.withColumn("text", F.coalesce(html, F.col("text")))


EXTRACTED = "uri string, text string, error string"


def _extracted(extraction: Callable[[], str | None]) -> tuple[str, str | None]:
    try:
        return extraction() or "", None
    except Exception as exc:
        return "", f"{type(exc).__name__}: {exc}"


def extraction_failures(extracted: DataFrame) -> DataFrame:
    """``uri`` and ``reason`` of documents without a text."""
    reason = F.col("error") if "error" in extracted.columns else F.lit(None).cast("string")
    failed = extracted.filter(~F.coalesce(has_visible("text"), F.lit(False)))
    return failed.select("uri", F.coalesce(reason, F.lit("no visible text")).alias("reason"))


def extract_uris(
    uris: DataFrame, fetch: Fetch = fetch_uri, extract: Extract = decode
) -> DataFrame:
    """``uri``, ``text`` and ``error``; any failure gives an empty text and its reason.

    One file at a time is held in a task. ``extract`` turns bytes into text and may be
    replaced for other formats; pages are reduced to visible text afterwards.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uri in frame["uri"]:
                text, error = _extracted(lambda: extract(fetch(uri)))
                yield pd.DataFrame({"uri": [uri], "text": [text], "error": [error]})

    return _visible_text(uris.select("uri").mapInPandas(run, EXTRACTED))


def extract_files(files: DataFrame, extract: Extract = decode) -> DataFrame:
    """The same for rows that already hold ``uri`` and ``content``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [_extracted(lambda: extract(bytes(content))) for content in frame["content"]]
            texts, errors = [t for t, _ in made], [e for _, e in made]
            yield pd.DataFrame({"uri": frame["uri"], "text": texts, "error": errors})

    return _visible_text(files.select("uri", "content").mapInPandas(run, EXTRACTED))


def extract_pages(pages: DataFrame, uri: str = "url", html: str = "html") -> DataFrame:
    """``uri`` and visible text of stored pages, without leaving the JVM."""
    return pages.select(F.col(uri).alias("uri"), html_to_text(html).alias("text"))


def read_table(spark: SparkSession, folder: str, name: str, min_tasks: int | None = None) -> DataFrame:
    """A Parquet table of a folder.

    A table stored in fewer pieces than there are cores is spread over them, so that
    work on its rows runs in parallel. Tables of a large store are left as they are.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    if min_tasks is None:
        return df
    return df if df.rdd.getNumPartitions() >= min_tasks else df.repartition(min_tasks)
