"""Text files in the checkpoint folder: tables written as the line formats that
the text sources read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from robustagg.sources.store import new_path

FILE_BYTES = 64 << 20
MOST_FILES = 99_999  # names of files with more digits would not ascend


def write_lines(lines: DataFrame, order: str | None = None, files: int = 4) -> str:
    """Path of a new folder with the ``value`` lines in text files: one per partition
    of ``lines``; with ``order`` the lines, file after file, ascend by that column, in
    ``files`` files, or more of about ``FILE_BYTES``."""
    path = f"{new_path(lines)}-text"
    if order:
        size = lines.agg(F.sum(F.octet_length("value") + F.lit(1).cast("long"))).first()[0] or 0
        files = min(max(files, -(-size // FILE_BYTES)), MOST_FILES)
        lines = lines.repartitionByRange(files, order).sortWithinPartitions(order)
    lines.select("value").write.text(path)
    return path
