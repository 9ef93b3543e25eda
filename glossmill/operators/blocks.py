"""Group the lines of a file into blocks separated by blank lines.

Most blocks lie inside one file split, and a task that reads a split sees their lines
in order. `_closed` puts those together where they are read, in Arrow batches, so
their text is never shuffled. What is left are the lines at the borders of
splits, and blocks too large to be held while they are read: `_open` gives them as
pieces, and only pieces are shuffled, by block.

A block is numbered by the byte offset of the split in which it begins plus the blank
lines before it in that split. So a closed block needs no other split to have its
number. A piece at the start of a split belongs to the last block of the nearest
split before with a blank line, which a table of one row per split tells.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

# A Spark row cannot exceed 2 GiB; a block of more than this is several rows.
MAX_BLOCK_BYTES = 256 * 1024 * 1024
# What a line takes besides its text.
LINE_BYTES = 48
# Part numbers of one section of a block end where those of the next begin.
SECTION_STEP = 1_000_000

_RUN = "path string, split long, local_no long, piece long, lines array<string>, raw array<string>, bytes long, valid boolean"


def group_blocks(
    lines: DataFrame, keep_unterminated: bool = True, max_block_bytes: int = MAX_BLOCK_BYTES
) -> DataFrame:
    """`scan_lines` output, whole and as it comes -> one row per non-empty block.

    Columns: `path`; `block_no`, increasing in file order, with gaps; `part`; `head`, the
    first two lines of the block, and `head_lines`, how many of them are the first of
    this row's `lines`; `lines`; `raw`, the bytes of lines that are not UTF-8, in base64
    and parallel to `lines` (NULL if all of this row are); `bytes` of text in this row; `block_bytes`
    in the block; `valid`, false when any line of the block was not UTF-8.

    `keep_unterminated=False` leaves out a last block that no blank line follows.
    `part` is NULL for a whole block. A block of more than `max_block_bytes` (text
    and `LINE_BYTES` per line) is several rows, in file order by `part`, whose
    numbers increase with gaps; together they have every line, and each has the
    `head`, `block_bytes` and `valid` of the whole block. A part holds at most 1.25 times
    the limit and one line. No task sees more of a block than about one limit and
    three file splits, and a reading task holds at most a quarter of the limit.
    """
    piece_bytes = max(max_block_bytes // 4, 1)
    opened = _assemble(_open(lines, piece_bytes), lines, max_block_bytes, keep_unterminated)
    return _closed(lines, piece_bytes).union(opened)


def _closed(lines: DataFrame, piece_bytes: int) -> DataFrame:
    """The blocks of at most `piece_bytes` that begin and end inside one split."""
    return _runs(lines, piece_bytes, closed=True).selectExpr(
        "path",
        "split + local_no AS block_no",
        "CAST(NULL AS BIGINT) AS part",
        "slice(lines, 1, 2) AS head",
        "least(2, size(lines)) AS head_lines",
        "lines",
        "raw",
        "bytes",
        "bytes AS block_bytes",
        "valid",
    )


def _open(lines: DataFrame, piece_bytes: int) -> DataFrame:
    """All other lines, as pieces of about `piece_bytes` of what a block has in one split."""
    return _runs(lines, piece_bytes, closed=False)


def _runs(lines: DataFrame, piece_bytes: int, closed: bool) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def changes(column: pa.Array, before: object) -> np.ndarray:
            """Where a value differs from the one before it."""
            found = np.ones(len(column), bool)
            found[0] = column[0].as_py() != before
            found[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
            return found

        def rows(batch: pa.RecordBatch, numbers: np.ndarray, before: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
            """Non-blank lines, of which every start begins a row."""
            offsets = pa.array(np.append(starts, batch.num_rows), pa.int32())
            valid = np.logical_and.reduceat(batch["valid"].to_numpy(zero_copy_only=False), starts)
            first = pa.array(starts)
            columns = [
                batch["path"].take(first),
                batch["split"].take(first),
                pa.array(numbers[starts]),
                pa.array(before[starts]),
                pa.ListArray.from_arrays(offsets, batch["line"]),
                # Rows of valid lines only have no `raw`.
                pa.ListArray.from_arrays(offsets, batch["raw"], mask=pa.array(valid)),
                pa.array(np.add.reduceat(octets(batch), starts)),
                pa.array(valid),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        def octets(batch: pa.RecordBatch) -> np.ndarray:
            return pc.binary_length(batch["line"]).to_numpy(zero_copy_only=False).astype(np.int64)

        def held_rows(held: list[pa.RecordBatch], number: int, before: int) -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            cost = octets(whole) + LINE_BYTES
            costs = before + np.cumsum(cost) - cost
            begins = np.append(True, costs[1:] // piece_bytes > costs[:-1] // piece_bytes)
            starts = np.array([0]) if closed else np.flatnonzero(begins)
            return rows(whole, np.full(whole.num_rows, number), costs, starts)

        names = ["path", "split", "local_no", "piece", "lines", "raw", "bytes", "valid"]
        last_path = last_split = last_row = None
        last_blanks = 0
        # The block that goes on at the end of a batch: the lines of it that are held, what
        # they and those before them cost, what of that is out, its number, and whether it began in this split.
        held: list[pa.RecordBatch] = []
        going, size, out, number, began = False, 0, 0, 0, False

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = changes(batch["path"], last_path) | changes(batch["split"], last_split)
            row = batch["row"].to_numpy()
            follows = np.append(row[0] - 1 if last_row is None else last_row, row[:-1]) + 1 == row
            if not np.all(follows | new):
                raise ValueError("the lines of a split must come whole and in order, as scan_lines gives them")
            cost = octets(batch) + LINE_BYTES
            blank = cost == LINE_BYTES
            blanks = np.cumsum(blank)
            # Blank lines before a line in its split, and so the number of its block in the split.
            at = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            numbers = blanks - np.where(at >= 0, blanks[at] - blank[at], -last_blanks)
            left_closed = (numbers > 0) | (batch["split"].to_numpy() == 0)

            filled = np.flatnonzero(~blank)
            starts_block = np.ones(len(filled), bool)
            starts_block[1:] = (np.diff(filled) > 1) | new[filled[1:]]
            if going and len(filled) and filled[0] == 0 and not new[0]:
                starts_block[0] = False
            blocks = np.flatnonzero(starts_block)

            # What goes on from the batch before.
            lead = int(blocks[0]) if len(blocks) else len(filled)
            if going and lead:
                held.append(batch.slice(0, lead))
                size += int(cost[:lead].sum())
            if going and lead < n:
                # It ends here: at a blank line, or at the end of its split.
                is_closed = began and blank[lead] and not new[lead] and size <= piece_bytes
                if held and is_closed == closed:
                    yield held_rows(held, number, out)
                held, going = [], False

            if len(blocks):
                first = filled[blocks]
                ends = np.append(filled[blocks[1:] - 1], filled[-1]) + 1
                costs = np.add.reduceat(cost[filled], blocks)
                goes_on = ends[-1] == n
                # The line after a block is blank unless the next split begins there.
                after = np.minimum(ends, n - 1)
                is_closed = left_closed[first] & blank[after] & ~new[after] & (costs <= piece_bytes)
                wanted = np.flatnonzero((is_closed == closed)[: len(blocks) - goes_on])
                if len(wanted):
                    marks = np.zeros(n + 1, np.int64)
                    np.add.at(marks, first[wanted], 1)
                    np.add.at(marks, ends[wanted], -1)
                    places = np.flatnonzero(np.cumsum(marks[:n]))
                    begins = np.zeros(len(places), bool)
                    begins[np.searchsorted(places, first[wanted])] = True
                    sums = np.cumsum(cost[places]) - cost[places]
                    before = sums - sums[np.maximum.accumulate(np.where(begins, np.arange(len(places)), 0))]
                    if not closed:
                        begins[1:] |= before[1:] // piece_bytes > before[:-1] // piece_bytes
                    yield rows(batch.take(pa.array(places)), numbers[places], before, np.flatnonzero(begins))
                if goes_on:
                    held, going = [batch.slice(int(first[-1]))], True
                    size, out = int(costs[-1]), 0
                    number, began = int(numbers[first[-1]]), bool(left_closed[first[-1]])
            if held and size > piece_bytes and size - out > piece_bytes:
                # Too large for a closed block, however it ends.
                if not closed:
                    yield held_rows(held, number, out)
                held, out = [], size
            last_path, last_split = batch["path"][n - 1].as_py(), batch["split"][n - 1].as_py()
            last_row, last_blanks = int(row[-1]), int(numbers[-1])
        if held and not closed:
            yield held_rows(held, number, out)

    return lines.select("path", "split", "row", "line", "raw", "valid").mapInArrow(run, _RUN)


# One row per file split, aggregated map-side from a scan of two numbers per line.
#
# `first_block` is the number of the block that is open at the start of the split, and
# `last_block` that of the last one of the file. A split without a blank line is filled by one
# block. A block with more than the limit of such splits is cut at them into sections of
# about that size: `first_section` is the section in which this split's first block goes on,
# `first_sections` and `last_sections` count those of its first and its last block, as
# `..._bytes` and `..._bad` tell of the splits that they fill. `place` is the place of the split
# among those that start inside or at the end of the same block.
_SPLITS = """
counted AS (
  SELECT path, split, count_if(n = 0) AS blanks, sum(IF(n > 0, n + :line_bytes, 0)) AS size,
    sum(n) AS octets, max(NOT valid) AS bad
  FROM (SELECT path, split, CAST(octet_length(line) AS BIGINT) AS n, valid FROM {lines})
  GROUP BY path, split),
numbered AS (
  SELECT *, blanks = 0 AS fills, IF(blanks > 0, split + blanks, NULL) AS own_last,
    coalesce(last(IF(blanks > 0, split + blanks, NULL)) IGNORE NULLS OVER (
      PARTITION BY path ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_block
  FROM counted),
summed AS (
  SELECT *, row_number() OVER in_order AS place,
    sum(IF(fills, size, 0)) OVER in_order - IF(fills, size, 0) AS filled_before,
    sum(IF(fills, size, 0)) OVER in_block AS filled,
    sum(IF(fills, octets, 0)) OVER in_block AS first_bytes,
    max(fills AND bad) OVER in_block AS first_bad
  FROM numbered
  WINDOW in_block AS (PARTITION BY path, first_block),
    in_order AS (PARTITION BY path, first_block ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cut AS (
  SELECT *, IF(filled > :limit, filled_before div :limit, 0) AS first_section,
    max(IF(filled > :limit, filled_before div :limit, 0)) OVER (PARTITION BY path, first_block) + 1 AS first_sections
  FROM summed),
splits AS (
  SELECT path, split, blanks, fills, place, first_block, first_section, first_sections, first_bytes, first_bad,
    max(coalesce(own_last, first_block)) OVER (PARTITION BY path) AS last_block,
    lead(first_sections, 1, 1L) OVER in_file AS last_sections,
    lead(first_bytes, 1, 0L) OVER in_file AS last_bytes,
    lead(first_bad, 1, false) OVER in_file AS last_bad
  FROM cut WINDOW in_file AS (PARTITION BY path ORDER BY split))"""

# Pieces with the number of their block, and the section of it that they belong to.
#
# `lead` has the first lines of a piece that may start its block. In a block of several sections
# such pieces, and those that do not fill their split, also go to the other sections, without
# `lines`, so that each section knows the head, the bytes and the validity of the block. All scans of the
# files are cut alike; a split without its row in the table would mean lost lines, so it fails the job.
_PLACED = """
joined AS (
  SELECT p.*, s.* EXCEPT (path, split, blanks),
    coalesce(s.blanks, CAST(raise_error('file splits changed between scans') AS BIGINT)) AS blanks,
    p.bytes + :line_bytes * size(p.lines) AS size
  FROM {pieces} p LEFT JOIN splits s ON p.path = s.path AND p.split = s.split),
placed AS (
  SELECT path, split, piece, lines, raw, bytes, valid, size, fills, last_block,
    IF(local_no = 0, first_block, split + local_no) AS block_no,
    IF(local_no = 0, first_section, 0) AS section,
    CASE WHEN local_no = 0 THEN first_sections WHEN local_no = blanks THEN last_sections ELSE 1 END AS sections,
    CASE WHEN local_no = 0 THEN first_bytes WHEN local_no = blanks THEN last_bytes ELSE 0 END AS filled_bytes,
    CASE WHEN local_no = 0 THEN first_bad WHEN local_no = blanks THEN last_bad ELSE false END AS filled_bad,
    IF(local_no > 0 OR place <= 2, slice(lines, 1, 2), NULL) AS lead
  FROM joined),
spread AS (
  SELECT *, explode(IF(sections > 1 AND (lead IS NOT NULL OR NOT fills),
    sequence(0L, sections - 1), array(section))) AS at
  FROM placed WHERE :keep_unterminated OR block_no < last_block)"""

# Pieces of blocks, or of sections of large blocks, -> whole blocks or parts.
#
# Every piece has a line, so the first two lines are in the first two leads. What the splits that a
# cut block fills have is known from the table; all else is counted in every section.
_ASSEMBLED = """
whole AS (
  SELECT *, at AS own_section,
    sum(IF(at = section, size, 0)) OVER to_end AS total,
    sum(IF(at = section, size, 0)) OVER in_order - IF(at = section, size, 0) AS before,
    greatest(2 - coalesce(sum(array_size(lead)) OVER in_order - coalesce(array_size(lead), 0), 0), 0) AS head_left,
    first(lead) IGNORE NULLS OVER to_end AS head1,
    nth_value(lead, 2) IGNORE NULLS OVER to_end AS head2,
    sum(IF(sections = 1 OR NOT fills, bytes, 0)) OVER to_end + IF(sections > 1, filled_bytes, 0) AS block_bytes,
    min(valid OR (sections > 1 AND fills)) OVER to_end AND NOT (sections > 1 AND filled_bad) AS block_valid
  FROM spread
  WINDOW
    in_order AS (PARTITION BY path, block_no, at ORDER BY split, piece ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    to_end AS (
      PARTITION BY path, block_no, at ORDER BY split, piece ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
collected AS (
  SELECT path, block_no, part,
    sort_array(collect_list(struct(
      split, piece, lines, coalesce(raw, array_repeat(CAST(NULL AS STRING), size(lines))) AS raw))) AS pieces,
    first(head1) AS head1, first(head2) AS head2, max(head_left) AS head_left, sum(bytes) AS bytes,
    max(block_bytes) AS block_bytes, min(block_valid) AS valid, min(valid) AS part_valid
  FROM (
    SELECT *, IF(sections > 1 OR total > :limit, section * :step + before div :limit, NULL) AS part
    FROM whole WHERE at = section)
  GROUP BY path, block_no, at, part)
SELECT path, block_no, part, slice(concat(head1, coalesce(head2, array())), 1, 2) AS head,
  CAST(least(head_left, size(flatten(pieces.lines))) AS INT) AS head_lines, flatten(pieces.lines) AS lines,
  IF(part_valid, NULL, flatten(pieces.raw)) AS raw, bytes, block_bytes, valid
FROM collected"""


def _assemble(pieces: DataFrame, lines: DataFrame, max_block_bytes: int, keep_unterminated: bool) -> DataFrame:
    """Pieces -> whole blocks and parts of blocks, numbered and joined by the splits that they stand in."""
    return pieces.sparkSession.sql(
        f"WITH {_SPLITS}, {_PLACED}, {_ASSEMBLED}",
        args={
            "limit": max_block_bytes,
            "line_bytes": LINE_BYTES,
            "step": SECTION_STEP,
            "keep_unterminated": keep_unterminated,
        },
        lines=lines,
        pieces=pieces,
    )
