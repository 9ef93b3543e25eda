import base64
import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from glossmill import group_blocks, parse_blocks, scan_lines
from glossmill.operators.blocks import LINE_BYTES
from glossmill.sources.text import write_blocks
from tests.model import blocks_of

EDGE_FILES = {
    "plain": "id1\nt1 t2\ns1\ns2\n\nid2\nt3\ns3\n\n",
    "unterminated": "id1\nt1\ns1\n\nid2\nt\ns2\n",
    "whitespace_separator": "id1\nt1\ns1\n \t\nid2\nt\ns2\n \n",
    "crlf": "id1\r\nt1\r\ns1\r\n\r\nid2\r\nt\r\ns2\r\n\r\n",
    "cr_only": "id1\rt1\rs1\r\rid2\rt\rs2\r\r",
    "leading_and_repeated_blanks": "\n\nid1\nt1\ns1\n\n\n\n\nid2\nt\n  s2  \n\n",
    "odd_whitespace": "id1\nt\na\x0bb\x0c\n\x1c\nid2\nt\n x y\x85\n\n",
    "short_block": "id1\n\nid2\nt\n\n",
    "empty": "",
    "only_blanks": "\n \n\n",
    "one_line_no_end": "id1",
}
KEPT = [2, 2, 2, 2, 2, 2, 2, 2, 0, 0, 1]
TERMINATED = [2, 1, 2, 2, 2, 2, 2, 2, 0, 0, 0]


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def grouped(spark, path, **options):
    rows = group_blocks(scan_lines(spark, path), **options).orderBy("path", "block_no").collect()
    return [list(r.lines) for r in rows]


@pytest.mark.parametrize("split_bytes", ["3", "7", "128m"])
def test_edge_files(spark, tmp_path, conf, split_bytes):
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    # File names keep the order of the dictionary.
    paths = [write(tmp_path / f"{i:02}-{n}.txt", t) for i, (n, t) in enumerate(EDGE_FILES.items())]
    for keep, counts in ((True, KEPT), (False, TERMINATED)):
        expected = [blocks_of(p, keep) for p in paths]
        assert [len(blocks) for blocks in expected] == counts
        assert grouped(spark, str(tmp_path), keep_unterminated=keep) == sum(expected, [])


def random_text(seed, blocks):
    rng = random.Random(seed)
    out = []
    for i in range(blocks):
        out.append(f"id{i}\nt{i % 7} x\n")
        out.extend(f"{'word ' * rng.randint(1, 12)}é{j}\n" for j in range(rng.randint(0, 6)))
        out.append("\n" * rng.randint(1, 4))
    return "".join(out)


@pytest.mark.parametrize("split_bytes", ["997", "4000", "7000", "128m"])
def test_random_file_at_several_split_sizes(spark, tmp_path, conf, split_bytes):
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    path = write(tmp_path / "big.txt", random_text(1, 3000))
    assert grouped(spark, path) == blocks_of(path)


def test_random_files_at_random_split_sizes(spark, tmp_path, conf):
    rng = random.Random(2)
    for seed in range(4):
        conf("spark.sql.files.maxPartitionBytes", str(rng.randint(11, 600)))
        folder = tmp_path / str(seed)
        folder.mkdir()
        paths = [write(folder / f"{i}.txt", random_text(seed * 10 + i, 25).rstrip("\n")) for i in range(3)]
        for keep in (True, False):
            expected = sum((blocks_of(p, keep) for p in paths), [])
            assert grouped(spark, str(folder), keep_unterminated=keep) == expected


def test_result_does_not_depend_on_the_join_strategy(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "500")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    path = write(tmp_path / "a.txt", random_text(5, 300))
    assert grouped(spark, path) == blocks_of(path)


def test_gzip_file_is_one_split(spark, tmp_path):
    text = random_text(3, 50)
    plain = write(tmp_path / "a.txt", text)
    with gzip.open(tmp_path / "b.txt.gz", "wb") as file:
        file.write(text.encode("utf-8"))
    assert grouped(spark, str(tmp_path / "b.txt.gz")) == blocks_of(plain)


def test_duplicates_and_order_are_kept(spark, tmp_path):
    path = write(tmp_path / "a.txt", "id\nt\nb\na\nb\n\n" * 3)
    assert grouped(spark, path) == [["id", "t", "b", "a", "b"]] * 3


GIANT = [f"line {i}" for i in range(200)]
GIANT_FILES = {
    "inside": "id1\nt\ns\n\nid2\nt\n" + "\n".join(GIANT) + "\n\nid3\nt\ns\n\n",
    "only": "\n".join(GIANT),
    "first": "\n".join(GIANT) + "\n\nid\nt\n\n",
    "last": "id\nt\n\n" + "\n".join(GIANT),
    "long_lines": "id\nt\n\n" + "\n".join("x" * (100 + i) for i in range(30)) + "\n\nid\nt\ns\n\n",
    "short_lines": "id\nt\n\n" + "a\nb\n" * 100 + "\nid\nt\ns",
}


@pytest.mark.parametrize("split_bytes, limit", [("60", 60), ("100", 500), ("1000", 60), ("1000", 3000), ("128m", 500)])
def test_large_blocks_are_parts_with_every_line(spark, tmp_path, conf, split_bytes, limit):
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    paths = [write(tmp_path / f"{name}.txt", text) for name, text in sorted(GIANT_FILES.items())]
    with gzip.open(tmp_path / "zipped.txt.gz", "wb") as file:
        file.write(GIANT_FILES["inside"].encode())
    expected = [b for p in [*paths, write(tmp_path.parent / "zipped.txt", GIANT_FILES["inside"])] for b in blocks_of(p)]

    parsed = parse_blocks(group_blocks(scan_lines(spark, str(tmp_path)), max_block_bytes=limit))
    blocks = {}
    for r in parsed.orderBy("path", "block_no", "part").collect():
        blocks.setdefault((r.path, r.block_no), []).append(r)
    assert [sum((r.lines for r in rows), []) for rows in blocks.values()] == expected
    for (rows, lines) in zip(blocks.values(), expected):
        cost = sum(len(x) + LINE_BYTES for x in lines)
        parts = [r.part for r in rows]
        assert parts == [None] if len(parts) == 1 and cost <= limit else None not in parts
        assert all(p < q for p, q in zip(parts, parts[1:]))
        assert all(r.id == lines[0] and " ".join(r.tags) == lines[1] and r.reason is None for r in rows)
        assert sum((r.texts for r in rows), []) == lines[2:]
        longest = max(map(len, lines)) + LINE_BYTES
        assert all(sum(len(x) + LINE_BYTES for x in r.lines) <= 1.25 * limit + 2 * longest for r in rows)


def test_only_borders_of_splits_are_shuffled(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "20000")
    path = write(tmp_path / "a.txt", random_text(6, 3000))
    df = group_blocks(scan_lines(spark, path))
    assert len(df.collect()) == 3000
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Closed blocks, pieces of open ones, and the split table.
    assert plan.count("FileScan text") == 3
    size = os.path.getsize(path)
    assert size > 300_000 and sum(shuffle_bytes(df)) < size / 4


def shuffle_bytes(df):
    """What each shuffle of the executed plan wrote."""
    found, seen, todo = [], set(), [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ReusedExchangeExec":
            continue
        if kind == "ShuffleExchangeExec" and node.id() not in seen:
            seen.add(node.id())
            found.append(node.metrics().apply("dataSize").value())
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            children = node.children()
            todo.extend(children.apply(i) for i in range(children.size()))
    return found


def test_bad_bytes_mark_the_line_and_the_block(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_bytes(b"id1\nt\n\xff\xfe oops\n\nid2\nt\n\xc3\xa9\n\n")
    lines = scan_lines(spark, str(path))
    assert [r.line for r in lines.filter("NOT valid").collect()] == ["�� oops"]
    rows = parse_blocks(group_blocks(lines)).orderBy("block_no").collect()
    assert [(r.id, r.reason) for r in rows] == [("id1", "invalid_utf8"), ("id2", None)]
    raw = [r and base64.b64decode(r) for r in rows[0].raw]
    assert raw == [None, None, b"\xff\xfe oops"] and rows[1].raw is None


def test_parse(spark, tmp_path):
    path = write(tmp_path / "a.txt", "id1\n a  b\tc\ns1\ns2\n\nid2\nt\n\nid3\n\n")
    rows = parse_blocks(group_blocks(scan_lines(spark, path))).orderBy("block_no").collect()
    assert [(r.id, r.tags, r.texts, r.reason) for r in rows] == [
        ("id1", ["a", "b", "c"], ["s1", "s2"], None),
        ("id2", ["t"], [], None),
        ("id3", None, [], "missing_tags"),
    ]


def test_record_too_large_to_annotate_is_quarantined_whole(spark, tmp_path):
    path = write(tmp_path / "a.txt", "id1\nt\nabc\n\nid2\nt\né\n\n")
    parsed = parse_blocks(group_blocks(scan_lines(spark, path)), max_record_bytes=6).orderBy("block_no")
    assert [(r.id, r.bytes, r.reason, r.lines[2]) for r in parsed.collect()] == [
        ("id1", 7, "oversize_record", "abc"),
        ("id2", 6, None, "é"),
    ]


def test_write_blocks_round_trip(spark, tmp_path):
    blocks = [[f"id{i}", "t", *(f"s{j}" for j in range(i))] for i in range(5)]
    df = spark.createDataFrame([(b,) for b in blocks], "lines array<string>")
    write_blocks(df, F.col("lines"), str(tmp_path / "out"))
    assert sorted(grouped(spark, str(tmp_path / "out"), keep_unterminated=False)) == sorted(blocks)


def test_changed_splits_fail_instead_of_losing_lines(spark, tmp_path, conf):
    """A line whose split is not in the split table must not vanish in the join."""
    from pyspark.errors import PySparkException

    from glossmill.operators import blocks as module

    path = write(tmp_path / "a.txt", random_text(4, 20) + "open")
    lines = scan_lines(spark, path)
    table = module._SPLITS
    module._SPLITS = table.replace("SELECT path, split, count_if", "SELECT path, split + 1 AS split, count_if")
    try:
        with pytest.raises(PySparkException, match="file splits changed"):
            group_blocks(lines).collect()
    finally:
        module._SPLITS = table


@pytest.mark.parametrize("split_bytes", ["60", "500", "128m"])
def test_verdict_and_bytes_do_not_depend_on_the_limit(spark, tmp_path, conf, split_bytes):
    """One bad line anywhere rejects every part of its block; so does the size of the block."""
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    sizes = {}
    for bad in (None, 0, 1, 2, 20, 38, 39):
        rows = [f"line {i:04} of {bad}".encode() for i in range(40)]
        if bad is not None:
            rows[bad] += b"\xff"
        (tmp_path / f"{bad}.txt").write_bytes(b"id\nt\ns\n\n" + b"\n".join(rows) + b"\n\nlonely\n")
        sizes[f"line 0000 of {bad}"[:18]] = bad
    for limit in (100, 600, 5000, 10**9):
        lines = scan_lines(spark, str(tmp_path))
        rows = parse_blocks(group_blocks(lines, max_block_bytes=limit), max_record_bytes=10_000).collect()
        blocks = {}
        for r in rows:
            blocks.setdefault((r.path, r.block_no), []).append(r)
        assert len(blocks) == 21
        for parts in blocks.values():
            parts.sort(key=lambda r: r.part or 0)
            lines_of = [x for r in parts for x in r.lines]
            n_bad = sum("\ufffd" in x for x in lines_of)
            expected = "invalid_utf8" if n_bad else "missing_tags" if lines_of == ["lonely"] else None
            assert {r.reason for r in parts} == {expected}
            assert {r.block_bytes for r in parts} == {sum(r.bytes for r in parts)}
            assert sum(r.bytes for r in parts) == sum(len(x.encode()) for x in lines_of)
            assert sum(x is not None for r in parts for x in r.raw or []) == n_bad
            assert all(r.raw is None or len(r.raw) == len(r.lines) for r in parts)
            assert len(lines_of) in (1, 3, 40) and (len(parts) > 1) == (len(lines_of) == 40 and limit < 2700)
        over = parse_blocks(group_blocks(lines, max_block_bytes=limit), max_record_bytes=500)
        assert {tuple(r) for r in over.filter("size(lines) > 1 AND head[0] != 'id' AND valid").select("reason").collect()} == {("oversize_record",)}


def test_lines_out_of_order_are_refused(spark, tmp_path):
    path = write(tmp_path / "a.txt", random_text(8, 50))
    lines = scan_lines(spark, path)
    with pytest.raises(Exception, match="whole and in order"):
        group_blocks(lines.filter("line != 'id3'")).collect()


def test_batches_do_not_change_blocks(spark, tmp_path, conf):
    path = write(tmp_path / "a.txt", "x\n" * 30 + "\n" + random_text(9, 200) + "y\n" * 30)
    for batch, split, limit in (("1", "300", 500), ("2", "128m", 100), ("3", "700", 2000), ("7", "128m", 10**6)):
        conf("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        conf("spark.sql.files.maxPartitionBytes", split)
        rows = group_blocks(scan_lines(spark, path), max_block_bytes=limit).orderBy("block_no", "part").collect()
        blocks = {}
        for r in rows:
            blocks.setdefault(r.block_no, []).extend(r.lines)
        assert list(blocks.values()) == blocks_of(path)
