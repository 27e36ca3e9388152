"""Manifests: listings, manifest lines, key-value stores and folder cross products, as DataFrames with explicit ordinals."""

from __future__ import annotations

from urllib.parse import unquote

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def file_system(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + unquote(root[5:]).lstrip("/")
    return pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parse_manifest_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """``name.png (h,w,c) level`` lines: key (up to the first dot), h, w, c, level. Other columns stay; a line of another form gives null sizes."""
    size = r"\((\d+),(\d+),(\d+)\)\s+(\d+)$"
    out = lines.withColumn("key", F.split_part(F.col(line), F.lit("."), F.lit(1)))
    for k, name in enumerate(("h", "w", "c", "level")):
        found = F.regexp_extract(line, size, k + 1)
        out = out.withColumn(name, F.when(found != "", found).cast("int"))
    return out


def first_token(line: Column) -> Column:
    return F.split_part(line, F.lit(" "), F.lit(1))


def cross_folders(names: DataFrame, folders: list[str], folder_major: bool) -> DataFrame:
    """names: line_no, name. Each name in each folder, with an ordinal that follows the names (file-major) or the folders."""
    spark = names.sparkSession
    sides = spark.createDataFrame(list(enumerate(folders)), "folder_no int, folder string")
    n = len(folders)
    path = F.concat_ws("/", "folder", "name")
    if folder_major:
        return names.crossJoin(F.broadcast(sides)).select("folder_no", "line_no", path.alias("path"))
    return names.crossJoin(F.broadcast(sides)).select((F.col("line_no") * n + F.col("folder_no")).alias("ordinal"), path.alias("path"))


def csv_bench(rows: DataFrame) -> DataFrame:
    """Benchmark rows: those without a PSNR ("-") are dropped, numbers are cast, and the display name is name and variant."""
    numbers = ["fps", "vram", "psnr"]
    kept = rows.where(F.trim("psnr") != "-")
    return kept.select(F.trim(F.concat_ws(" ", "name", "variant")).alias("display"), F.col("scale").cast("int").alias("scale"), *[F.expr(f"try_cast({c} as double)").alias(c) for c in numbers])


class Folders(InputPartition):
    """Folders of one task, each with all that lies below it, or the files of the root alone."""

    def __init__(self, names: list[str], below: bool):
        self.names, self.below = names, below


class ListingReader(DataSourceReader):
    """The driver lists the root's own folders only; tasks go through what is below them."""

    def __init__(self, options):
        self.root, self.suffix = options["path"], options.get("suffix", "")
        self.recursive = options.get("recursive", "false").lower() == "true"
        self.tasks = int(options.get("tasks", "64"))

    def partitions(self):
        top = [rel for rel, info in self._entries("") if info.type == pafs.FileType.Directory] if self.recursive else []
        dealt = [top[k :: self.tasks] for k in range(min(self.tasks, len(top)))]
        return [Folders([""], False), *(Folders(names, True) for names in dealt)]

    def _entries(self, rel: str):
        system, base = file_system(self.root)
        found = system.get_file_info(pafs.FileSelector(f"{base.rstrip('/')}/{rel}" if rel else base))
        return sorted(((f"{rel}/{i.base_name}" if rel else i.base_name, i) for i in found), key=lambda e: e[0])

    def read(self, partition):
        stack = list(partition.names)
        while stack:
            for name, info in self._entries(stack.pop()):
                if info.type == pafs.FileType.Directory:
                    if partition.below:
                        stack.append(name)
                elif not info.base_name.startswith(".") and name.endswith(self.suffix):
                    yield self.root, name, info.size


class Listing(DataSource):
    """Files of a folder: hidden files are left out, but hidden folders are entered, which Spark's own sources do not do."""

    @classmethod
    def name(cls):
        return "pairloom_listing"

    def schema(self):
        return "root string, rel_path string, size bigint"

    def reader(self, schema):
        return ListingReader(self.options)


def listing(spark: SparkSession, path: str, suffix: str = "", recursive: bool = True) -> DataFrame:
    spark.dataSource.register(Listing)
    return spark.read.format("pairloom_listing").option("suffix", suffix).option("recursive", str(recursive).lower()).load(path)


def write_store(images: DataFrame, path: str) -> None:
    """A key-value store: key and value (bytes) as Parquet, beside a manifest of ``key.png (h,w,c) level`` lines. An existing target is an error."""
    images.select("key", "value").write.mode("errorifexists").parquet(f"{path}/data")
    images.select(manifest_line(F.col("key"), F.col("h"), F.col("w"), F.col("c"), F.col("level")).alias("value")).write.mode("errorifexists").text(f"{path}/meta_info")


def read_store(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Values of the asked keys; a missing key gives null."""
    return keys.join(spark.read.parquet(f"{path}/data"), "key", "left")


def manifest_line(key: Column, h: Column, w: Column, c: Column, level: Column) -> Column:
    return F.concat(key, F.lit(".png ("), h, F.lit(","), w, F.lit(","), c, F.lit(") "), level)
