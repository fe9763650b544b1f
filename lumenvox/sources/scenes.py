"""Scene manifests: tokens to files, and which scenes are still to be done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The pattern of baked scene tokens and the folder of scanned scenes.
BAKED_PATTERN = r"^sc(\d+)[\-_]?(\d+)$"
SCAN_FOLDER = "hm3d-minival-habitat-v2"


def baked_scene(token: Column) -> Column:
    """Instance file of a baked scene token such as sc0_00; other tokens stay as they are."""
    number = lambda i: F.regexp_extract(F.trim(token), BAKED_PATTERN, i).cast("int")
    named = F.format_string("Baked_sc%d_staging_%02d.scene_instance.json", number(1), number(2))
    return F.when(token.endswith(".scene_instance.json"), token).when(F.trim(token).rlike(BAKED_PATTERN), named).otherwise(token)


def scan_scene(root: str, token: Column) -> Column:
    """Mesh file of a scanned scene such as 00800-TEEsavR23oF; paths of meshes stay as they are."""
    last = F.element_at(F.split(token, "-"), -1)
    return F.when(token.endswith(".glb"), token).otherwise(F.concat(F.lit(f"{root}/{SCAN_FOLDER}/"), token, F.lit("/"), last, F.lit(".basis.glb")))


def scene_file(kind: Column, root: str, token: Column) -> Column:
    """File of a scene by the kind of its data set: baked, scanned, or a file that is named as it is; other kinds are an error."""
    unknown = F.raise_error(F.concat(F.lit("unknown kind of scene: "), F.coalesce(kind, F.lit("null"))))
    return F.when(kind == "baked", baked_scene(token)).when(kind == "scanned", scan_scene(root, token)).when(kind == "file", token).otherwise(unknown.cast("string"))


def found_files(scenes: DataFrame, files: DataFrame, column: str) -> DataFrame:
    """``scenes`` whose file in ``column`` is one of ``files`` (file)."""
    return scenes.join(files.select(F.col("file").alias(column)).distinct(), column, "left_semi")


def short_id(token: Column) -> Column:
    return F.substring_index(token, "-", 1)


def preferred(*candidates: Column) -> Column:
    """The first candidate that exists (is not null)."""
    return F.coalesce(*candidates)


#: Manifests of the scanned scenes, the smaller one first.
SCAN_MANIFESTS = ("hm3d_annotated_minival_basis", "hm3d_annotated_basis")


def scan_manifest(small: Column, full: Column) -> Column:
    """Manifest of a data set of scanned scenes: the smaller one where it is there (true), else the full one, else null."""
    named = [F.when(there, F.lit(f"{name}.scene_dataset_config.json")) for there, name in zip((small, full), SCAN_MANIFESTS, strict=True)]
    return preferred(*named)


def listed(spark: SparkSession, root: str) -> DataFrame:
    """token, short and files: scene folders right below ``root``, the part of their name before the first hyphen, and the files in them.

    Only paths are read, not what the files hold.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    token = F.element_at(F.split("path", "/"), -2)
    return files.select(token.alias("token")).groupBy("token").agg(F.count("*").alias("files")).select("token", short_id(F.col("token")).alias("short"), "files")


def not_done(manifest: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Scenes without a finished result."""
    return manifest.join(done.select(key), key, "left_anti")
