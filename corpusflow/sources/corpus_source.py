"""The on-disk corpus layout as a Spark data source, one file per article and kind (S1-S4 in, K1, K3-K5 out).

``spark.read.format("corpus_files")`` reads ``N_raw.txt``, ``N_meta.json``,
``N_cleaned.txt`` and ``N_udpipe.conllu`` files, zero-length ones included, from a
folder and the folders in it.  The driver lists folders only: a partition is a range
of folders, or one of several stripes (by article id) of a folder that holds more
files than folders are there to deal out, and each task lists its own.

``df.write.format("corpus_files")`` writes such files from rows (article_id, kind,
text).  A task writes into a folder of its own under ``_temporary`` and moves its
files to their places when all of them are whole; a task that is lost leaves nothing
but its temporary folder, which the end of the job removes.  A repeated task writes
the same names again.  ``_SUCCESS`` marks a job that ended well.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

from corpusflow.functions.paths import ARTIFACT_SUFFIX
from corpusflow.session import ship_package

NAME = "corpus_files"
SCHEMA = "path string, name string, article_id long, kind string, length long, modified timestamp, text string"
#: Tasks of a read, and bytes of text in one batch of rows.
PARTITIONS, BATCH_BYTES = 16, 8 << 20
#: Articles of one folder of the written layout.
FOLDER_ARTICLES = 10_000
_KIND_OF = {suffix: kind for kind, suffix in ARTIFACT_SUFFIX.items()}
_FILE = re.compile("([0-9]+)(" + "|".join(re.escape(s) for s in _KIND_OF) + ")")
_TEMPORARY = "_temporary"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path.rstrip("/")
    fs, own = pafs.FileSystem.from_uri(path)
    return fs, own.rstrip("/")


@dataclass
class Stripe(InputPartition):
    """Some folders, and the part of their files that belongs to the task: ids equal to ``at`` modulo ``of``."""

    folders: list[str]
    at: int
    of: int


class CorpusReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self._path = options["path"]
        self._kinds = set(options.get("kinds", ",".join(ARTIFACT_SUFFIX)).split(","))
        if unknown := self._kinds - set(ARTIFACT_SUFFIX):
            raise ValueError(f"unknown artifact kind: {', '.join(sorted(unknown))}")
        self._content = options.get("content", "true") == "true"
        self._wanted = int(options.get("partitions", str(PARTITIONS)))

    def partitions(self) -> Sequence[InputPartition]:
        fs, root = _open(self._path)
        there = fs.get_file_info(root)
        if there.type == pafs.FileType.NotFound:
            raise FileNotFoundError(f"no such folder: {root}")
        if there.type != pafs.FileType.Directory:
            raise NotADirectoryError(f"no folder: {root}")
        inner = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(root)) if i.type == pafs.FileType.Directory
                       and not i.base_name.startswith(("_", ".")))
        folders = [root, *inner]
        of = -(-self._wanted // len(folders))
        step = -(-len(folders) // self._wanted)
        return [Stripe(folders[i:i + step], at, of) for i in range(0, len(folders), step) for at in range(of)]

    def read(self, partition: Stripe) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self._path)
        schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("article_id", pa.int64()), ("kind", pa.string()),
                            ("length", pa.int64()), ("modified", pa.timestamp("us", tz="UTC")), ("text", pa.string())])
        rows: list[tuple] = []
        size = 0
        for folder in partition.folders:
            for info in fs.get_file_info(pafs.FileSelector(folder)):
                name = _FILE.fullmatch(info.base_name)
                if info.type != pafs.FileType.File or name is None or _KIND_OF[name[2]] not in self._kinds \
                        or int(name[1]) % partition.of != partition.at:
                    continue
                text = None
                if self._content:
                    with fs.open_input_stream(info.path) as f:
                        text = f.read().decode("utf-8")
                rows.append((info.path, info.base_name, int(name[1]), _KIND_OF[name[2]], info.size, info.mtime, text))
                size += len(text or "") + 200
                if size >= BATCH_BYTES:
                    yield _batch(rows, schema)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    files: int


class CorpusWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        missing = {"article_id", "kind", "text"} - set(schema.names)
        if missing:
            raise ValueError(f"columns are missing: {', '.join(sorted(missing))}")
        self._path, self._at = options["path"], [schema.names.index(c) for c in ("article_id", "kind", "text")]
        self._folders = options.get("folders", "true") == "true"
        self._job = uuid.uuid4().hex
        fs, root = _open(self._path)
        if overwrite and fs.get_file_info(root).type == pafs.FileType.Directory:
            fs.delete_dir_contents(root)
        fs.create_dir(root, recursive=True)

    def _place(self, article: int, kind: str) -> tuple[str, str]:
        if kind not in ARTIFACT_SUFFIX:
            raise ValueError(f"unknown artifact kind: {kind}")
        return f"{article // FOLDER_ARTICLES:06d}" if self._folders else "", f"{article}{ARTIFACT_SUFFIX[kind]}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _open(self._path)
        own = f"{root}/{_TEMPORARY}/{self._job}/{uuid.uuid4().hex}"
        fs.create_dir(own, recursive=True)
        places = set()
        for batch in iterator:
            for article, kind, text in zip(*(batch.column(i).to_pylist() for i in self._at), strict=True):
                folder, name = self._place(article, kind)
                with fs.open_output_stream(f"{own}/{name}") as f:
                    f.write((text or "").encode())
                places.add((folder, name))
        # all files are whole: they go to their places
        for folder in sorted({folder for folder, _ in places}):
            fs.create_dir(f"{root}/{folder}", recursive=True)
        for folder, name in sorted(places):
            fs.move(f"{own}/{name}", f"{root}/{folder}/{name}" if folder else f"{root}/{name}")
        fs.delete_dir(own)
        return Written(len(places))

    def _clean(self) -> tuple[pafs.FileSystem, str]:
        fs, root = _open(self._path)
        if fs.get_file_info(f"{root}/{_TEMPORARY}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{_TEMPORARY}")
        return fs, root

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = self._clean()
        with fs.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clean()


class CorpusFiles(DataSource):
    """Corpus files by article and kind.

    Options: ``path``; when read, ``kinds`` (comma-separated), ``content`` (``false``: no
    texts, nothing is opened) and ``partitions``; when written, ``folders`` (``false``: all
    files in one folder, else one folder per FOLDER_ARTICLES ids).
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return CorpusReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return CorpusWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and the package to its workers."""
    ship_package(spark)
    spark.dataSource.register(CorpusFiles)


def read_files(spark: SparkSession, path: str, kinds: Sequence[str] = tuple(ARTIFACT_SUFFIX), content: bool = True,
               partitions: int = PARTITIONS) -> DataFrame:
    """``(path, name, article_id, kind, length, modified, text)`` of the corpus files of a folder."""
    register(spark)
    return (spark.read.format(NAME).option("kinds", ",".join(kinds)).option("content", str(content).lower())
            .option("partitions", str(partitions)).load(path))


def write_files(files: DataFrame, path: str, mode: str = "overwrite", folders: bool = True) -> None:
    """K1, K3-K5: rows ``(article_id, kind, text)`` as one file each; ``mode="overwrite"`` empties the folder first (K7),
    so the rows must not come from it.

    Rows of one article and kind are written once; which of several, is not defined.  A
    null text makes an empty file; a null id or an unknown kind fails the job.
    """
    register(files.sparkSession)
    files.select("article_id", "kind", "text").write.format(NAME).option("folders", str(folders).lower()).mode(mode).save(path)


def article_files(articles: DataFrame, **texts: Column) -> DataFrame:
    """Rows ``(article_id, kind, text)``: for every article one per kind given, e.g. ``raw=F.col("text")``; null texts are left out."""
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), text.cast("string").alias("text")) for kind, text in texts.items()])
    return articles.select("article_id", F.explode(each).alias("f")).select("article_id", "f.kind", "f.text").filter(F.col("text").isNotNull())


def read_articles(spark: SparkSession, path: str, partitions: int = PARTITIONS) -> DataFrame:
    """S4 / J1 on corpus files: one article per id that has a raw text and a meta record.

    Both kinds come from one source; META fields with defaults, and the raw ``text``.
    """
    from corpusflow.sources.files import parse_meta_json, scan_corpus
    raw = read_files(spark, path, ("raw",), partitions=partitions).select("article_id", "text")
    meta = read_files(spark, path, ("meta",), partitions=partitions).select("article_id", F.col("text").alias("meta_json"))
    return scan_corpus(raw, parse_meta_json(meta).drop("pattern_matches"))
