"""File sources: discovery, archives, JSON lines, verified reads, pre-rendered slides."""

from __future__ import annotations

import io
import os
import posixpath
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType

from evispark.operators.checks import rows, union

MOST_FILES = 500
MOST_BYTES = 4 << 30
# Limits of an archive that is safe to open.
MOST_MEMBERS, MOST_MEMBER_BYTES, MOST_TOTAL_BYTES, MOST_RATIO = 20_000, 512 << 20, 4 << 30, 2_000
REQUIRED_PARTS = ("[Content_Types].xml", "ppt/presentation.xml")


def separate(spark: SparkSession, source: str, target: str) -> None:
    """Fails where input and output hold each other, or a local one lies behind a symbolic link."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    whole = []
    for path in (source, target):
        uri = place(path).getFileSystem(conf).makeQualified(place(path)).toUri()
        whole.append((f"{uri.getScheme()}://{uri.getAuthority() or ''}", posixpath.normpath(uri.getPath())))
        if uri.getScheme() == "file":
            steps = whole[-1][1].split("/")
            for n in range(2, len(steps) + 1):
                if os.path.islink("/".join(steps[:n])):
                    raise ValueError(f"{path} lies behind a symbolic link")
    (store, a), (other, b) = whole
    if store == other and posixpath.commonpath([a, b]) in (a, b):
        raise ValueError(f"{source} and {target} hold each other")


def discover(spark: SparkSession, path: str, pattern: str = "*.pptx", recursive: bool = True) -> DataFrame:
    """(path, size, modified, sha256, content) of input files; lock files of editors are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)
    named = files.where(~F.element_at(F.split("path", "/"), -1).startswith("~$"))
    return named.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), "content")


def changed(spark: SparkSession, path: str, found: DataFrame, pattern: str = "*.pptx") -> DataFrame:
    """Violations where inputs (path, size, modified) are no longer what they were when they were found: changed while they were
    read, gone, or new. Contents aren't read again."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    now = files.where(~F.element_at(F.split("path", "/"), -1).startswith("~$")).select("path", F.struct(F.col("length").alias("size"), F.col("modificationTime").alias("modified")).alias("now"))
    both = found.select("path", F.struct("size", "modified").alias("then")).join(now, "path", "full")
    return union([rows(both.where("now is null"), "input-gone", F.col("path")), rows(both.where("then is null"), "input-new", F.col("path")), rows(both.where("now <> then"), "input-changed", F.col("path"))])


def limits(files: DataFrame, most_files: int = MOST_FILES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Violations where there are no files, too many, or too many bytes."""
    total = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    return union([rows(total.where(F.col("n") == 0), "no-input", F.lit("*")), rows(total.where(F.col("n") > most_files), "too-many-files", F.col("n")), rows(total.where(F.col("bytes") > most_bytes), "too-many-bytes", F.col("bytes"))])


@udtf(returnType="name string, size long, packed long")
class ZipMembers:
    """Members of a zip archive; a broken one gives none."""

    def eval(self, content: bytes):
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for m in z.infolist():
                    yield m.filename, m.file_size, m.compress_size
        except zipfile.BadZipFile:
            return


@udtf(returnType="part string, target string, kind string")
class ExternalRelations:
    """Relations of a deck that point outside, hyperlinks apart."""

    def eval(self, content: bytes):
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for name in z.namelist():
                    if name.endswith(".rels"):
                        for r in ElementTree.fromstring(z.read(name)):
                            if r.get("TargetMode") == "External" and not r.get("Type", "").endswith("/hyperlink"):
                                yield name, r.get("Target"), r.get("Type", "").rsplit("/", 1)[-1]
        except (zipfile.BadZipFile, ElementTree.ParseError):
            return


def register(spark: SparkSession) -> None:
    spark.udtf.register("zip_members", ZipMembers)
    spark.udtf.register("external_relations", ExternalRelations)


def archive_violations(files: DataFrame) -> DataFrame:
    """Archives that break a limit, lack a required part, leave their folder, or fetch from outside. files: (path, content)."""
    register(files.sparkSession)
    files.createOrReplaceTempView("_archives")
    spark = files.sparkSession
    members = spark.sql("SELECT a.path, m.* FROM _archives a, LATERAL zip_members(a.content) m")
    per = members.groupBy("path").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.collect_set(F.when(F.col("name").isin(*REQUIRED_PARTS), F.col("name"))).alias("parts"))
    outside = members.where(F.col("name").startswith("/") | F.col("name").rlike(r"(^|[/\\])\.\.([/\\]|$)") | F.col("name").rlike(r"^[A-Za-z]:"))
    dense = members.where((F.col("packed") > 0) & (F.col("size") / F.col("packed") > MOST_RATIO))
    return union([
        rows(files.join(per, "path", "left_anti"), "not-an-archive", F.col("path")),
        rows(per.where(F.col("n") > MOST_MEMBERS), "too-many-members", F.col("path"), F.col("n")),
        rows(per.where(F.col("total") > MOST_TOTAL_BYTES), "archive-too-large", F.col("path"), F.col("total")),
        rows(members.where(F.col("size") > MOST_MEMBER_BYTES), "member-too-large", F.col("path"), F.col("name")),
        rows(dense, "compression-ratio", F.col("path"), F.col("name")),
        rows(outside, "unsafe-member", F.col("path"), F.col("name")),
        rows(per.where(F.size("parts") < len(REQUIRED_PARTS)), "missing-part", F.col("path")),
        rows(spark.sql("SELECT a.path, m.* FROM _archives a, LATERAL external_relations(a.content) m"), "external-resource", F.col("path"), F.col("target")),
    ])


def json_lines(spark: SparkSession, path: str, schema: StructType | str, required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, violations) of a JSON lines file: broken lines and nulls in required columns are violations."""
    typed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = spark.read.text(path).where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = raw.select("value", F.from_json("value", StructType([*typed.fields]).add("_bad", "string"), options).alias("r"))
    wrong = rows(parsed.where("r._bad is not null"), "corrupt-line", F.left("value", F.lit(200)))
    good = parsed.where("r._bad is null").select(*(F.col(f"r.{f.name}") for f in typed))
    return good, union([wrong, *(rows(good.where(F.col(c).isNull()), f"missing-{c}", F.to_json(F.struct("*"))) for c in required)])


def verified(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(name, content, ok): files of a folder against a manifest (name, sha256)."""
    files = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return files.join(manifest, "name").select("name", "content", (F.sha2("content", 256) == F.col("sha256")).alias("ok"))


def rendered_slides(spark: SparkSession, folder: str) -> DataFrame:
    """(slide_number, path) of images in natural order: numbers in names count as numbers."""
    from pyspark.sql import Window

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{png,jpg,jpeg,webp}").load(folder).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", F.row_number().over(Window.orderBy(F.regexp_extract(name, r"(\d+)(?!.*\d)", 1).cast("long"), name)).alias("slide_number"))
