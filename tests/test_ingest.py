import base64
import json

import pytest
from pyspark.sql import functions as F

from glossmill import RECORD_SCHEMA, STORED_SCHEMA, ingest, read_records, scan_lines
from glossmill.plans.ingest import main, shuffle_width
from tests.model import records_of
from tests.test_blocks import random_text, write


def found(spark, dest, fmt="json"):
    rows = read_records(spark, dest, fmt=fmt).collect()
    return sorted((r.id, r.tags, [s.text for s in r.sentences]) for r in rows)


@pytest.fixture
def corpus(tmp_path):
    path = write(tmp_path / "corpus.txt", random_text(7, 400))
    return path


@pytest.mark.parametrize("options", [{}, {"fmt": "parquet"}, {"partitions": 5}])
def test_records_match_the_model(spark, corpus, tmp_path, conf, options):
    conf("spark.sql.files.maxPartitionBytes", "5000")
    dest = str(tmp_path / "out")
    counts = ingest(spark, corpus, dest, **options)
    assert counts == {"records": 400, "quarantined": 0}
    assert found(spark, dest, options.get("fmt", "json")) == sorted(records_of(corpus))


@pytest.mark.parametrize("partitions", [None, 3])
@pytest.mark.parametrize("with_lexicon", [False, True])
def test_records_in_file_order(spark, corpus, tmp_path, conf, partitions, with_lexicon):
    conf("spark.sql.files.maxPartitionBytes", "3000")
    lexicon = spark.createDataFrame([("word", "w", "N", "NN")], "form string, lemma string, pos1 string, pos2 string")
    dest = tmp_path / "out"
    options = {"lexicon": lexicon} if with_lexicon else {}
    counts = ingest(spark, corpus, str(dest), ordered=True, partitions=partitions, **options)
    assert counts == {"records": 400, "quarantined": 0}
    rows = [json.loads(x) for p in sorted(dest.glob("part-*")) for x in p.read_text().splitlines()]
    assert [r["id"] for r in rows] == [r[0] for r in records_of(corpus)]


def test_shuffle_width_follows_the_splits_and_is_restored(spark, corpus, conf):
    key = "spark.sql.shuffle.partitions"
    conf("spark.sql.files.maxPartitionBytes", "1000")
    before = spark.conf.get(key)
    lines = scan_lines(spark, corpus)
    splits = lines.select("split").distinct().count()
    assert splits > 20
    with shuffle_width(spark, lines):
        assert int(spark.conf.get(key)) >= 20
    with shuffle_width(spark, lines, 9):
        assert spark.conf.get(key) == "9"
    conf(key, "300")
    with shuffle_width(spark, lines):
        assert spark.conf.get(key) == "300"
    conf(key, before)


def test_bad_blocks_are_quarantined_and_nothing_is_lost(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "100")
    giant = "\n".join(f"line {i}" for i in range(200))
    text = f"id1\nt\ns1\n\nlonely\n\n{giant}\n\nid2\nt\n\n"
    path = tmp_path / "a.txt"
    path.write_bytes(text.encode() + b"bad\nt\n\xff\n\n")
    dest, rejected = str(tmp_path / "out"), str(tmp_path / "rejected")

    counts = ingest(spark, str(path), dest, quarantine=rejected, max_block_bytes=400)
    stored = read_records(spark, dest, STORED_SCHEMA).orderBy("part").collect()
    assert counts == {"records": len(stored), "quarantined": 2}
    whole = sorted((r.id, r.tags, [x.text for x in r.sentences]) for r in stored if r.part is None)
    assert whole == [("id1", ["t"], ["s1"]), ("id2", ["t"], [])]
    parts = [r for r in stored if r.part is not None]
    assert len(parts) > 10 and {(r.id, tuple(r.tags)) for r in parts} == {("line 0", ("line", "1"))}
    assert [x.text for r in parts for x in r.sentences] == giant.split("\n")[2:]
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text.count('"part":') == len(parts)
    rows = spark.read.json(rejected).select("reason", F.size("lines").alias("n"), "lines").collect()
    by_reason = {}
    for r in rows:
        by_reason.setdefault(r.reason, []).append(r)
    assert [r.lines for r in by_reason["missing_tags"]] == [["lonely"]]
    assert [r.lines for r in by_reason["invalid_utf8"]] == [["bad", "t", "�"]]
    raw = spark.read.schema("raw array<string>").json(rejected).filter("raw IS NOT NULL").head().raw
    assert base64.b64decode(raw[2]) == b"\xff"

    # A clean run leaves no stale quarantine behind.
    ingest(spark, write(tmp_path / "b.txt", "id1\nt\n\n"), dest, quarantine=rejected)
    assert spark.read.schema("reason string").json(rejected).isEmpty()
    assert found(spark, dest) == [("id1", ["t"], [])]


def test_unterminated_block(spark, tmp_path):
    path = write(tmp_path / "a.txt", "id1\nt\ns\n\nid2\nt\ns\n")
    assert ingest(spark, path, str(tmp_path / "out"))["records"] == 2
    assert ingest(spark, path, str(tmp_path / "out"), keep_unterminated=False)["records"] == 1


def test_empty_input(spark, tmp_path):
    counts = ingest(spark, write(tmp_path / "a.txt", ""), str(tmp_path / "out"))
    assert counts == {"records": 0, "quarantined": 0}
    assert found(spark, str(tmp_path / "out")) == []


def test_lexicon(spark, corpus, tmp_path):
    lexicon = spark.createDataFrame(
        [("word", "lexeme", "NOUN", "NN")], "form string, lemma string, pos1 string, pos2 string"
    )
    dest = str(tmp_path / "out")
    ingest(spark, corpus, dest, lexicon=lexicon)
    assert found(spark, dest) == sorted(records_of(corpus))
    lemmas = read_records(spark, dest).select(F.explode("sentences.lemma").alias("l")).select(F.explode("l"))
    assert {r[0] for r in lemmas.distinct().collect()} >= {"lexeme"}
    assert lemmas.filter("col = 'word'").isEmpty()


def test_plugin_errors_are_written_next_to_the_record(spark, tmp_path):
    def factory():
        def run(texts):
            if any("boom" in t for t in texts):
                raise ValueError("boom")
            return [{"token": t.split(), "dep": ["d"] * len(t.split())} for t in texts]

        return run

    path = write(tmp_path / "a.txt", "id1\nt\nfine here\n\nid2\nt\nboom\nok\n\n")
    dest = str(tmp_path / "out")
    ingest(spark, path, dest, annotator=factory)
    rows = {r.id: r for r in read_records(spark, dest).collect()}
    assert rows["id1"].sentences[0].dep == ["d", "d"]
    assert [s.token for s in rows["id2"].sentences] == [None, ["ok"]]
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert text.count("_errors") == 1 and "ValueError: boom" in text


def test_command_line(spark, corpus, tmp_path, capsys):
    dest = str(tmp_path / "out")
    main(["--src", corpus, "--dest", dest, "--format", "parquet", "--partitions", "3"])
    assert "'records': 400" in capsys.readouterr().out
    assert found(spark, dest, "parquet") == sorted(records_of(corpus))
    assert read_records(spark, dest, fmt="parquet").schema.names == RECORD_SCHEMA.names


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_a_failed_run_leaves_both_outputs_as_they_were(spark, tmp_path, fmt):
    def factory():
        def run(texts):
            import os

            raise KeyboardInterrupt if os.path.exists(bomb) else ValueError

        return run

    bomb = str(tmp_path / "bomb")
    path = write(tmp_path / "a.txt", "id1\nt\ns\n\nlonely\n\n")
    dest, schema = str(tmp_path / "out"), "reason string, lines array<string>"
    read = lambda: (found(spark, dest, fmt), spark.read.schema(schema).format(fmt).load(f"{dest}.quarantine").collect())
    settings_before = dict(spark.conf.getAll)
    assert ingest(spark, path, dest, fmt=fmt) == {"records": 1, "quarantined": 1}
    before = read()
    assert [tuple(r) for r in before[1]] == [("missing_tags", ["lonely"])]
    write(tmp_path / "bomb", "")
    other = write(tmp_path / "b.txt", "id2\nt\ns\n\n")
    with pytest.raises(Exception):
        ingest(spark, other, dest, fmt=fmt, annotator=factory)
    assert read() == before
    assert dict(spark.conf.getAll) == settings_before
    left = sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith("."))
    assert left == ["a.txt", "b.txt", "bomb", "out", "out.quarantine"]


def test_bad_blocks_add_no_scan(spark, tmp_path):
    """Good and bad blocks come from one write of one plan."""
    path = write(tmp_path / "a.txt", "id1\nt\ns\n\nlonely\n\n" * 50)
    jobs = spark.sparkContext.statusTracker()
    group = "ingest-once"
    spark.sparkContext.setJobGroup(group, group)
    ingest(spark, path, str(tmp_path / "out"))
    with_bad = len(jobs.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup(group + "2", group)
    ingest(spark, write(tmp_path / "b.txt", "id1\nt\ns\n\n" * 100), str(tmp_path / "out2"))
    assert with_bad == len(jobs.getJobIdsForGroup(group + "2"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_compressed_outputs(spark, tmp_path, capsys):
    """Both outputs, and the same records, in a small part of the bytes."""
    text = "".join(f"id{i}\nt\n" + "Words of a sentence, again and again.\n" * 20 + "\nbad\n\n" for i in range(200))
    path = write(tmp_path / "a.txt", text)
    rows, octets = [], []
    for compression in (None, "gzip"):
        dest = tmp_path / str(compression)
        assert ingest(spark, path, str(dest), compression=compression) == {"records": 200, "quarantined": 200}
        rows.append((found(spark, str(dest)), spark.read.schema("lines array<string>").json(f"{dest}.quarantine").count()))
        octets.append(sum(p.stat().st_size for p in dest.glob("part-*")))
    assert rows[0] == rows[1] and rows[0][1] == 200
    assert octets[1] * 5 < octets[0]
    main(["--src", path, "--dest", str(tmp_path / "line"), "--compression", "gzip"])
    assert found(spark, str(tmp_path / "line")) == rows[0][0]
    assert all(p.name.endswith(".gz") for p in (tmp_path / "line").glob("part-*"))
