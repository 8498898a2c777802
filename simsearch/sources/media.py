"""Lists of media files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File kinds taken by default.
MEDIA = (".mp3", ".wav")


def media_catalog(
    spark: SparkSession,
    root: str,
    extensions: Iterable[str] = MEDIA,
    folders: tuple[int, int] | None = None,
    ignore_case: bool = False,
    limit: int | None = None,
    content: bool = False,
) -> DataFrame:
    """Rows ``(id, path, folder, length)`` of the files below ``root``.

    ``folders`` keeps files in three-digit folders of that inclusive range;
    folders that do not exist are simply not found. Without ``content`` only the
    listing is read.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    )
    path = F.lower("path") if ignore_case else F.col("path")
    wanted = F.lit(False)
    for extension in extensions:
        wanted = wanted | path.endswith(extension.lower() if ignore_case else extension)
    found = files.where(wanted).select(
        F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("id"),
        "path",
        F.regexp_extract("path", r"([^/]*)/[^/]+$", 1).alias("folder"),
        "length",
        *(["content"] if content else []),
    )
    if folders is not None:
        number = F.when(F.col("folder").rlike(r"^\d{3}$"), F.col("folder").cast("int"))
        found = found.where(number.between(*folders))
    if limit is not None:
        found = found.orderBy("path").limit(limit)
    return found
