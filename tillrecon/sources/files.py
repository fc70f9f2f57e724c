"""Source files: journals, closing reports, shops from paths, fingerprints."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillrecon import fixed
from tillrecon.functions.text import decode_cp1252, holds
from tillrecon.sources.staging import stage


def _below_root(path: Column, root: str) -> Column:
    """The part of a path that starts with the root directory's own name."""
    root_path = urlsplit(root).path.rstrip("/")
    if not root_path.startswith("/"):
        raise ValueError(f"the source root must be an absolute path: {root}")
    above = len(root_path.rpartition("/")[0]) + 1
    return F.substring(path, F.instr(path, root_path) + F.lit(above), F.length(path))


def shop_from_path(path: Column, root: str, shops) -> Column:
    """Shop named in the path from the source root downwards; NULL when none or several are."""
    text = F.upper(_below_root(path, root))
    named = F.filter(F.array(*map(F.lit, shops)), lambda shop: F.contains(text, shop))
    return F.when(F.size(named) == 1, F.get(named, 0))


def with_shop(files: DataFrame, root: str, shops, on_unclear: str = "skip") -> DataFrame:
    """Add ``shop``. Files without exactly one shop are skipped, kept with NULL or fail the job."""
    shop = shop_from_path(F.col("path"), root, shops)
    if on_unclear == "fail":
        message = F.concat(F.lit("not exactly one shop in path: "), F.col("path"))
        return files.withColumn("shop", shop).filter(holds(F.col("shop").isNotNull(), message))
    found = files.withColumn("shop", shop)
    if on_unclear == "skip":
        return found.filter(F.col("shop").isNotNull())
    if on_unclear == "keep":
        return found
    raise ValueError(f"unknown policy: {on_unclear}")


def _names(path: Column, root: str) -> list[Column]:
    return [
        path.alias("path"),
        _below_root(path, root).alias("rel_path"),
        F.regexp_extract(path, "([^/]*)$", 1).alias("file_name"),
    ]


def read_binary(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )


def read_journals(
    spark: SparkSession, root: str, shops, pattern: str = fixed.JOURNAL_NAMES, on_unclear: str = "skip"
) -> DataFrame:
    """Blocks of all journals below ``root``: path, rel_path, file_name, shop, block_pos, block, block_id.

    One text scan, whose record separator is the ticket separator, reads files of any size, a huge one
    in many tasks. Its records are stored with their split and their place in it; positions are counted
    on the stored rows, so neither the settings of a later session nor another number of cores can
    change them.
    """
    records = stage(_records(spark, root, pattern), "records")
    # Position of a record in its file: its place within its split plus the records of the splits
    # before. One row per split.
    splits = records.groupBy("path", "_start").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("path").orderBy("_start")
    earlier = F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("path", "_start", "_first", F.coalesce(earlier, F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_at") - F.col("_first")
    placed = records.join(splits, ["path", "_start"]).select("path", position.alias("_pos"), "content")
    # The scan has no record behind a separator at the very end; the block that begins there is empty.
    mark = len(fixed.TICKET_SEPARATOR)
    read = records.groupBy("path").agg(
        F.count("*").alias("_pos"),
        F.sum(F.octet_length("content") + mark).alias("_read"),
        F.first("_size").alias("_size"),
    )
    # A byte-order mark is read over.
    ends = read.filter(F.col("_size").isin(F.col("_read"), F.col("_read") + 3))
    last = ends.select("path", F.col("_pos").cast("bigint").alias("_pos"), F.lit("").cast("binary").alias("content"))
    # Record 0 of a file is what stands before its first separator.
    blocks = placed.unionByName(last).filter("_pos > 0")
    named = blocks.select(
        *_names(F.col("path"), root), (F.col("_pos") - 1).alias("block_pos"), decode_cp1252(F.col("content")).alias("block")
    )
    return with_shop(named, root, shops, on_unclear).withColumn(
        "block_id", F.concat_ws("#", "rel_path", F.col("block_pos").cast("string"))
    )


def _records(spark: SparkSession, root: str, pattern: str, separator: str = fixed.TICKET_SEPARATOR) -> DataFrame:
    """Bytes between separators, with file, split, place in reading order and size of the file."""
    raw_path = F.col("_metadata.file_path")
    return (
        spark.read.option("lineSep", separator)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .text(root)
        .select(
            F.url_decode(F.replace(raw_path, F.lit("+"), F.lit("%2B"))).alias("path"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.col("_metadata.file_size").alias("_size"),
            F.monotonically_increasing_id().alias("_at"),
            # The text source hands the bytes over as they are.
            F.col("value").cast("binary").alias("content"),
        )
    )


def report_family(file_name: Column) -> Column:
    """Family of a closing report by its file name, NULL for files that are none."""
    name = F.upper(file_name)
    family = F.lit(None).cast("string")
    for key, prefixes in fixed.REPORT_PREFIXES.items():
        starts = F.lit(False)
        for prefix in prefixes:
            starts = starts | name.startswith(prefix)
        family = F.when(name.endswith(".CSV") & starts, key).otherwise(family)
    return family


def read_reports(
    spark: SparkSession, root: str, shops, on_unclear: str = "fail"
) -> DataFrame:
    """Closing reports below ``root`` as text: path, rel_path, file_name, family, shop, text, report_id.

    A report is one till's fixed list of counters, a few kilobytes; it stays one value.
    """
    files = read_binary(spark, root, "[zZ]*.[cC][sS][vV]")
    reports = files.select(
        *_names(F.col("path"), root), decode_cp1252(F.col("content")).alias("text")
    ).withColumn("family", report_family(F.col("file_name")))
    reports = reports.filter(F.col("family").isNotNull())
    return with_shop(reports, root, shops, on_unclear).withColumn("report_id", F.col("rel_path"))


def source_fingerprints(
    spark: SparkSession, root: str, pattern: str = "*.{[tT][xX][tT],[cC][sS][vV]}"
) -> DataFrame:
    """SHA-256 of every source file: rel_path, sha256."""
    files = read_binary(spark, root, pattern)
    return files.select(
        _below_root(F.col("path"), root).alias("rel_path"), F.sha2("content", 256).alias("sha256")
    )


# Lines of a leaf of the tree.
LEAF_LINES = 1 << 16


def content_digests(
    spark: SparkSession, root: str, pattern: str = "*.{[tT][xX][tT],[cC][sS][vV]}"
) -> DataFrame:
    """A digest of the content of every source file, of any size: rel_path, digest.

    A hash tree over ranges of lines. Lines are hashed with their number in the file where they are read; a
    leaf adds up the hashes of ``LEAF_LINES`` lines, and the digest is the SHA-256 of the file's size and its leaves in order.
    A line's number is its place within its split and the lines of the splits before, so the digest does not
    depend on how files are split, and it changes with any line that changes, moves, comes or goes. A file
    without bytes has no row, so one that becomes empty shows as removed.
    """
    lines = _records(spark, root, pattern, "\n")
    splits = lines.groupBy("path", "_start").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    # One row per split.
    splits = splits.select("path", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    number = (F.col("_at") + F.col("_shift")).alias("_line")
    numbered = lines.join(splits, ["path", "_start"]).select("path", "_size", number, "content")
    hashed = [F.sum(F.xxhash64(F.lit(seed), "_line", "content").cast("decimal(20,0)")).cast("string").alias(f"_h{seed}") for seed in (1, 2)]
    leaf = F.floor(F.col("_line") / LEAF_LINES).alias("_leaf")
    leaves = numbered.groupBy("path", "_size", leaf).agg(*hashed)
    ordered = F.array_sort(F.collect_list(F.struct("_leaf", F.concat_ws(".", "_h1", "_h2").alias("_h"))))["_h"]
    tops = leaves.groupBy("path", "_size").agg(ordered.alias("_leaves"))
    digest = F.sha2(F.concat_ws("/", F.col("_size").cast("string"), "_leaves"), 256).alias("digest")
    return tops.select(_below_root(F.col("path"), root).alias("rel_path"), digest)


def diff_fingerprints(
    before: DataFrame, after: DataFrame, key: str = "rel_path", mark: str = "sha256"
) -> DataFrame:
    """One row per file of either state with ``status`` added, removed, changed or same."""
    left = before.select(key, F.col(mark).alias(f"{mark}_before"), F.lit(True).alias("_was"))
    right = after.select(key, F.col(mark).alias(f"{mark}_after"), F.lit(True).alias("_is"))
    status = (
        F.when(F.col("_was").isNull(), "added")
        .when(F.col("_is").isNull(), "removed")
        .when(F.col(f"{mark}_before").eqNullSafe(F.col(f"{mark}_after")), "same")
        .otherwise("changed")
    )
    return left.join(right, key, "full_outer").select(
        key, f"{mark}_before", f"{mark}_after", status.alias("status")
    )
