"""Files in and out: raw books, pages on disk, indexes, state and logs."""

from __future__ import annotations

import re
import shutil
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import language_zh_en, usable_chars

#: Type of a page by the folder it lies in, in the order in which folders are read.
FOLDERS = {"entities": "entity", "concepts": "concept", "topics": "topic", "sources": "source", "analyses": "analysis", "conflicts": "conflict", "dashboards": "dashboard"}

#: Text of a file's bytes, or null where the bytes can't be read.
Reader = Callable[[bytes], str | None]


def raw_files(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """``path, length, sha256[, content]`` of the PDF, EPUB, Markdown and text files under ``root``; bytes are read for the digest only."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{pdf,epub,md,txt,PDF,EPUB}").load(root)
    keep = ["path", "length", F.sha2("content", 256).alias("sha256")]
    return rows.select(*keep, "content") if content else rows.select(*keep)


def read_html(data: bytes) -> str | None:
    """The text of HTML or of an unzipped EPUB page: scripts and styles out, blocks on lines of their own."""
    import html

    s = data.decode("utf-8", "replace")
    s = re.sub(r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->", " ", s)
    s = re.sub(r"(?i)<(?:br|hr)\s*/?>|</?(?:p|div|h[1-6]|li|tr|table|ul|ol|section|article|blockquote)\b[^>]*>", "\n", s)
    s = html.unescape(re.sub(r"<[^>]+>", "", s))
    s = re.sub(r"[ \t\r\f\v\xa0]+", " ", s)
    return re.sub(r"\n\s*\n+", "\n\n", re.sub(r" ?\n ?", "\n", s)).strip()


def read_epub(data: bytes) -> str | None:
    """The text of an EPUB's pages in the order of its spine, null if it is no readable archive."""
    import io
    import zipfile

    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            names = [n for n in z.namelist() if re.search(r"\.x?html?$", n, re.I)]
            opf = next((n for n in z.namelist() if n.endswith(".opf")), None)
            if opf:
                package = z.read(opf).decode("utf-8", "replace")
                href = dict((b, a) if a.startswith("#") else (a, b) for a, b in re.findall(r'<item\b[^>]*?\bid="([^"]+)"[^>]*?\bhref="([^"]+)"', package))
                href |= {b: a for a, b in re.findall(r'<item\b[^>]*?\bhref="([^"]+)"[^>]*?\bid="([^"]+)"', package)}
                spine = [href.get(i, "") for i in re.findall(r'<itemref\b[^>]*?\bidref="([^"]+)"', package)]
                base = opf.rpartition("/")[0]
                ordered = [n for s in spine if s for n in names if n == f"{base}/{s}".lstrip("/")]
                names = ordered or names
            return "\n\n".join(t for n in names if (t := read_html(z.read(n))))
    except (zipfile.BadZipFile, KeyError):
        return None


def read_text(data: bytes) -> str | None:
    return data.decode("utf-8", "replace")


def read_pdf(data: bytes) -> str | None:
    """Pages of a PDF in form-feed form by the ``pdftotext`` program, null where it is absent or fails."""
    if not shutil.which("pdftotext"):
        return None
    import subprocess

    try:
        done = subprocess.run(["pdftotext", "-layout", "-", "-"], input=data, capture_output=True, timeout=600)
    except subprocess.TimeoutExpired:
        return None
    return done.stdout.decode("utf-8", "replace") if done.returncode == 0 else None


READERS: dict[str, Reader] = {"txt": read_text, "md": read_text, "html": read_html, "epub": read_epub, "pdf": read_pdf}


def missing_programs(paths: list[str]) -> list[str]:
    """Programs that are needed for files of these names and aren't installed."""
    need = {"pdftotext"} if any(p.lower().endswith(".pdf") for p in paths) else set()
    return sorted(p for p in need if not shutil.which(p))


def converted(raw: DataFrame, readers: dict[str, Reader] | None = None, least: int = 500) -> DataFrame:
    """``path, sha256, text, pages_total, language, state`` of ``raw(path, sha256, content)``.

    Form feeds become page markers, blank pages lose theirs. Files without a reader or with fewer than ``least`` usable
    characters need OCR. Each file is read in one task; files are the rows, so they spread over the cluster.
    """
    table = READERS | (readers or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts: list[str | None] = []
            pages: list[int | None] = []
            for path, data in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                read = table.get(path.rpartition(".")[2].lower())
                text = read(data) if read and data is not None else None
                if text and "\f" in text:
                    parts = text.split("\f")
                    pages.append(len(parts) - (not parts[-1].strip()))
                    text = "\n\n".join(f"<!-- PAGE:{i} -->\n\n{p.strip()}" for i, p in enumerate(parts, 1) if p.strip())
                else:
                    pages.append(None)
                texts.append(text)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(pages, pa.int32())], names=["path", "sha256", "text", "pages_total"])

    rows = raw.select("path", "sha256", "content").mapInArrow(run, "path string, sha256 string, text string, pages_total int")
    short = F.coalesce(usable_chars(F.col("text")), F.lit(0)) < least
    return rows.withColumn("language", language_zh_en(F.coalesce("text", F.lit("")))).withColumn("state", F.when(short, "needs_ocr").otherwise("converted"))


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """``slug, type, path, md`` of the Markdown pages under a wiki's type folders."""
    rows = spark.read.text([f"{root}/{d}" for d in FOLDERS if _exists(spark, f"{root}/{d}")], wholetext=True, pathGlobFilter="*.md")
    path = F.col("_metadata.file_path")
    kind = F.create_map(*[F.lit(x) for kv in FOLDERS.items() for x in kv])[F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)]
    return rows.select(F.regexp_extract(F.url_decode(path), r"([^/]+)\.md$", 1).alias("slug"), kind.alias("type"), F.url_decode(path).alias("path"), F.col("value").alias("md"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_pages(md: DataFrame, root: str) -> None:
    """``slug, type, md`` as one snapshot, partitioned by type; the whole batch appears at once or not at all.

    The snapshot is written to a folder of its own; a row that names it is appended when it is complete. Readers take
    the last one named, so that a job that fails leaves the one before in place.
    """
    spark, folder = md.sparkSession, f"snapshot-{uuid.uuid4().hex}"
    md.write.partitionBy("type").parquet(f"{root}/{folder}")
    last = spark.read.parquet(f"{root}/versions").agg(F.max("version")).first()[0] if _exists(spark, f"{root}/versions") else 0
    spark.range(1).select(F.lit((last or 0) + 1).cast("bigint").alias("version"), F.lit(folder).alias("folder")).coalesce(1).write.mode("append").parquet(f"{root}/versions")


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The pages of the last complete snapshot."""
    folder = spark.read.parquet(f"{root}/versions").agg(F.max_by("folder", F.struct("version", "folder"))).first()[0]
    return spark.read.parquet(f"{root}/{folder}")


def read_index(spark: SparkSession, path: str, wiki: Callable[[], DataFrame]) -> DataFrame:
    """The pages of a JSON index, or what ``wiki`` gives where it is absent or broken."""
    kind = "version int, page_count int, pages array<struct<slug string, title string, type string, path string, summary string, tags array<string>, aliases array<string>>>"
    if not _exists(spark, path):
        return wiki()
    rows = spark.read.schema(kind).option("multiLine", "true").json(path).where("pages is not null")
    return wiki() if rows.isEmpty() else rows.select(F.inline("pages"))


def append_log(rows: DataFrame, path: str) -> None:
    """Append ``at, op, title, detail`` rows to the audit log."""
    rows.write.mode("append").parquet(path)


def write_state(run_status: DataFrame, path: str) -> None:
    run_status.write.mode("append").json(path)
