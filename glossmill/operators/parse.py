"""Positional projection of a block into a record."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from glossmill.functions.text import split_tags


def parse_blocks(blocks: DataFrame, max_record_bytes: int | None = None) -> DataFrame:
    """`group_blocks` output -> `id` (line 1), `tags` (line 2), `texts` (the rest).

    `reason` is NULL for a good record. Otherwise it says why the block belongs
    in quarantine, and the block's own columns are still there to be written. A block
    is rejected for its size only if the caller sets `max_record_bytes`. Every part of
    a large block has its id and tags, and the verdict on the whole block: one bad line
    rejects all of them, whatever limit made them parts.
    """
    lines, head = F.col("lines"), F.col("head")
    reason = F.when(~F.col("valid"), "invalid_utf8").when(F.size(head) < 2, "missing_tags")
    if max_record_bytes is not None:
        reason = reason.when(F.col("block_bytes") > max_record_bytes, "oversize_record")
    return blocks.withColumns(
        {
            "id": F.try_element_at(head, F.lit(1)),
            "tags": split_tags(F.try_element_at(head, F.lit(2))),
            "texts": F.slice(lines, F.col("head_lines") + 1, F.size(lines)),
            "reason": reason,
        }
    )
