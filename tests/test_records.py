import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from glossmill import (
    RECORD_SCHEMA,
    SENTENCE_SCHEMA,
    distribute,
    enforce_schema,
    fill_missing,
    flatten_sentences,
    flatten_tokens,
    nest_children,
    read_records,
    schema_violations,
    write_records,
)
from glossmill.functions.safe import fields_or_reasons
from glossmill.sources.records import read_checked, read_strict
from glossmill.sources.text import number_lines, scan_lines
from glossmill.session import get_session, settings, shared_path, split_settings

FULL = ("N1", ["a"], [("x y", ["x", "y"], ["x", "y"], ["X", "X"], ["XX", "XX"], ["d", "e"]), ("", [], [], [], [], [])])
NO_DEP = ("N2", [], [("x", ["x"], ["x"], ["X"], ["XX"], None)])
EMPTY = ("N3", None, [])


@pytest.fixture
def records(spark):
    return spark.createDataFrame([FULL, NO_DEP, EMPTY], RECORD_SCHEMA)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_schemas():
    assert RECORD_SCHEMA.simpleString() == (
        "struct<id:string,tags:array<string>,sentences:array<struct<text:string,token:array<string>,"
        "lemma:array<string>,pos1:array<string>,pos2:array<string>,dep:array<string>>>>"
    )
    assert not RECORD_SCHEMA["id"].nullable
    assert all(f.nullable for f in RECORD_SCHEMA.fields[1:] + SENTENCE_SCHEMA.fields)


def test_flatten(records):
    sentences = flatten_sentences(records)
    assert sorted((r.id, r.sent_pos) for r in sentences.filter("text IS NOT NULL").collect()) == [
        ("N1", 0), ("N1", 1), ("N2", 0),
    ]
    assert [tuple(r) for r in sentences.filter("id = 'N3'").collect()] == [("N3",) + (None,) * 7]
    tokens = sorted(map(tuple, flatten_tokens(sentences).collect()))
    assert tokens == [
        ("N1", 0, 0, "x", "x", "X", "XX", "d"),
        ("N1", 0, 1, "y", "y", "X", "XX", "e"),
        ("N2", 0, 0, "x", "x", "X", "XX", None),
    ]


def test_flatten_then_nest_round_trip(records):
    parents = records.select("id", "tags")
    children = flatten_sentences(records).filter("sent_pos IS NOT NULL")
    nested = nest_children(children, ["id"], "sent_pos", SENTENCE_SCHEMA.names, "sentences", parents)
    assert same(nested.select("id", "tags", "sentences"), records)


def test_nest_orders_children(spark):
    rows = [(1, 3, "c"), (2, 1, "z"), (1, 1, "a"), (1, 2, None), (1, 4, "a")]
    df = spark.createDataFrame(rows, "k int, pos int, text string").repartition(3)
    out = {r.k: [c.text for c in r.kids] for r in nest_children(df, ["k"], "pos", ["text"], "kids").collect()}
    assert out == {1: ["a", None, "c", "a"], 2: ["z"]}


def test_large_groups_are_parts_with_every_child(spark):
    """NULL keys, groups without strings and children larger than a part included."""
    rows = [(k, i, [str(i)] * 3, "x" * (700 if i == 40 else 5)) for k in (1, None) for i in range(100)]
    rows += [(2, 0, None, None), (2, 1, [], "y")]
    df = spark.createDataFrame(rows, "k long, pos int, a array<string>, text string").repartition(5)
    nested = nest_children(df, ["k"], "pos", ["pos", "a", "text"], "kids", max_part_bytes=500)
    found = nested.select("k", "part", F.size("kids").alias("n"), F.inline("kids")).collect()
    key = lambda r: (r[0] is None, r[0], r[1])
    assert sorted([(r.k, r.pos, r.a, r.text) for r in found], key=key) == sorted(rows, key=key)
    for k in (1, None):
        parts = [r.part for r in sorted(found, key=lambda r: r.pos) if r.k == k]
        assert parts == sorted(parts) and set(parts) == set(range(max(parts) + 1)) and max(parts) > 5
    assert {(r.part, r.n) for r in found if r.k == 2} == {(None, 2)}


def test_one_large_group_is_spread_over_tasks(spark, conf):
    """As many tasks sort children of the group as there are ranges, and parts come in order."""
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    n = 40_000
    df = spark.range(n).select(
        F.when(F.col("id") < n - 10, F.lit(1)).otherwise(F.col("id")).alias("k"),
        ((F.col("id") * 7919) % n).alias("pos"),
        F.col("id").cast("string").alias("v"),
    )
    nested = nest_children(df, ["k"], "pos", ["pos", "v"], "kids", max_part_bytes=60_000)
    tagged = nested.withColumn("task", F.spark_partition_id())
    rows = tagged.collect()
    large = sorted((r for r in rows if r.k == 1), key=lambda r: r.part)
    assert [r.part for r in large] == list(range(len(large))) and len(large) > 30
    assert len({r.task for r in large}) > 8
    places = [kid.pos for r in large for kid in r.kids]
    assert places == sorted(places) and len(places) == n - 10
    assert {(r.k, r.part, len(r.kids)) for r in rows if r.k != 1} == {(k, None, 1) for k in range(n - 10, n)}


def test_children_with_equal_places_are_spread_too(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("k"), F.lit(5).alias("pos"), F.col("id").alias("v"))
    rows = nest_children(df, ["k"], "pos", ["v"], "kids", max_part_bytes=20_000).collect()
    rows.sort(key=lambda r: r.part)
    assert len(rows) > 3 and [kid.v for r in rows for kid in r.kids] == list(range(3000))


def test_parents_of_parts_and_of_nothing(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 10, F.col("id")).otherwise(99).alias("k"), F.col("id").alias("pos"), F.lit(1).alias("v")
    )
    parents = spark.createDataFrame([(k,) for k in [*range(10), 99, 100]], "k long")
    nested = nest_children(df, ["k"], "pos", ["v"], "kids", parents, max_part_bytes=5000)
    n = {r.k: r.n for r in nested.groupBy("k").agg(F.sum(F.size("kids")).alias("n")).collect()}
    assert n == {**{k: 1 for k in range(10)}, 99: 990, 100: 0}


def test_checked_read_keeps_every_line(spark, tmp_path):
    schema = RECORD_SCHEMA
    long = "x" * 21_000_000
    lines = [
        '{"id":"a","tags":["t"]}',
        '{"id":"b",',
        '{"id":"c","colour":1,"size":2}',
        '{"tags":[]}',
        "[1]",
        '{"id":"d","tags":["' + long + '"]}',
    ]
    (tmp_path / "r.json").write_text("\n".join(lines))
    rows = read_checked(spark, str(tmp_path / "r.json"), schema).collect()
    assert [r.reason for r in sorted(rows, key=lambda r: lines.index(r.line))] == [
        None,
        "malformed",
        "unknown_fields: colour, size",
        "null_id",
        "malformed",
        None,
    ]
    assert read_records(spark, str(tmp_path / "r.json")).filter("id = 'd'").first().tags == [long]
    with pytest.raises(Exception, match="bad record"):
        read_strict(spark, str(tmp_path / "r.json"), schema).collect()
    (tmp_path / "good.json").write_text("\n".join([lines[0], lines[5]]))
    assert sorted(r.id for r in read_strict(spark, str(tmp_path / "good.json"), schema).collect()) == ["a", "d"]


def test_required_fields_of_any_type(spark):
    schema = T.StructType([T.StructField("d", T.DateType(), False), T.StructField("a", T.ArrayType(T.LongType()), False)])
    schema = schema.add("m", T.DecimalType(9, 2), False).add("t", T.TimestampType(), False)
    df = spark.sql("SELECT date'2020-01-02' AS d, array(1L) AS a UNION ALL SELECT NULL, array(2L)")
    df = df.selectExpr("*", "cast(1.5 as decimal(9,2)) as m", "timestamp'2020-01-01' as t")
    good = enforce_schema(df, schema)
    assert good.count() == 1 and not good.schema["d"].nullable and not good.schema["a"].nullable


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_round_trip(spark, records, tmp_path, fmt):
    path = str(tmp_path / "out")
    write_records(records, path, fmt)
    write_records(records, path, fmt)
    back = read_records(spark, path, fmt=fmt)
    assert same(back, records)
    assert enforce_schema(back).schema == RECORD_SCHEMA


def test_json_leaves_null_out_and_keeps_empty_lists(records, tmp_path):
    write_records(records.filter("id = 'N3'").coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == '{"id":"N3","sentences":[]}\n'


def test_enforce_schema_sets_null_ids_aside(spark):
    df = spark.createDataFrame([("a", ["t"], []), (None, ["t"], [])], "id string, tags array<string>, sentences array<string>")
    schema = T.StructType([*RECORD_SCHEMA.fields[:2], T.StructField("sentences", T.ArrayType(T.StringType()))])
    good = enforce_schema(df, schema)
    assert not good.schema["id"].nullable and [r.id for r in good.collect()] == ["a"]
    assert [r.reason for r in schema_violations(df, schema).collect()] == ["null_id"]


def test_required_fields_of_other_types(spark):
    schema = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("s", T.StringType())])
    df = spark.createDataFrame([(1,), (None,)], "n long")
    assert [tuple(r) for r in enforce_schema(df, schema).collect()] == [(1, None)]


def test_null_id_is_rejected_on_creation(spark):
    with pytest.raises(PySparkException, match="FIELD_NOT_NULLABLE"):
        spark.createDataFrame([(None, [], [])], RECORD_SCHEMA)


def test_fill_missing(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.ArrayType(SENTENCE_SCHEMA))])
    df = spark.createDataFrame([([("x",)],)], "b array<struct<text:string>>")
    row = fill_missing(df, schema).first()
    assert row.a is None and row.b[0].text == "x" and row.b[0].dep is None


def test_unknown_fields_are_errors(spark):
    with pytest.raises(TypeError, match="unexpected fields: extra"):
        fill_missing(spark.createDataFrame([("a", 1)], "id string, extra int"))
    df = spark.createDataFrame([("a", [("x", 1)])], "id string, sentences array<struct<text:string,n:int>>")
    with pytest.raises(TypeError, match="unexpected fields: sentences.n"):
        fill_missing(df)


def test_distribute_widens_only_narrow_scans(spark):
    narrow = spark.range(0, 100, 1, 1)
    assert distribute(narrow, 4).rdd.getNumPartitions() == 4
    assert distribute(narrow, 4).count() == 100
    wide = spark.range(0, 100, 1, 8)
    assert distribute(wide, 4) is wide


def test_session(spark):
    assert get_session() is spark or get_session().sparkContext is spark.sparkContext


def test_settings_are_put_back(spark, conf):
    held, unset = "spark.sql.shuffle.partitions", "spark.sql.files.minPartitionNum"
    conf(held, "7")
    assert spark.conf.get(unset, None) is None
    assert split_settings(spark) == {unset: "4"}
    with pytest.raises(ValueError), settings(spark, {held: "9", **split_settings(spark)}):
        assert (spark.conf.get(held), spark.conf.get(unset)) == ("9", "4")
        raise ValueError
    assert (spark.conf.get(held), spark.conf.get(unset, None)) == ("7", None)
    conf(unset, "3")
    assert split_settings(spark) == {unset: "3"}


def test_shared_path_is_in_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first != second and first.startswith(f"{base}/x-")


def test_shared_path_without_a_checkpoint_folder():
    class Unset:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "local[2]"

    first, second = shared_path(Unset, "x"), shared_path(Unset, "x")
    assert first != second and os.path.isdir(os.path.dirname(first))
    assert os.path.dirname(first) == os.path.dirname(second)


def test_no_machine_local_folder_on_a_cluster():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(Cluster, "x")


def written(folder):
    return {p.name: p.read_text() for p in folder.iterdir() if not p.name.startswith(".")}


def test_staged_folders_replace_both_or_none(spark, tmp_path, monkeypatch):
    from glossmill.sources import records as module

    places = [tmp_path / "a", tmp_path / "b"]
    targets = [str(p) for p in places]

    def write(text):
        with module.staged(spark, targets) as stages:
            for stage in stages:
                os.makedirs(stage)
                with open(f"{stage}/x", "w") as file:
                    file.write(text)

    write("one")
    write("two")
    assert [written(p) for p in places] == [{"x": "two"}] * 2

    # A failure in the block, and one at each of the moves.
    with pytest.raises(ValueError), module.staged(spark, targets):
        raise ValueError
    move, count = module._files.move, [0]
    for fail_at in range(1, 5):
        count[0] = 0

        def broken(self, path, to):
            count[0] += 1
            if count[0] == fail_at:
                raise OSError("lost")
            move(self, path, to)

        monkeypatch.setattr(module._files, "move", broken)
        with pytest.raises(OSError, match="lost"):
            write("three")
        monkeypatch.setattr(module._files, "move", move)
        assert [written(p) for p in places] == [{"x": "two"}] * 2
        assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["a", "b"]

    # The driver is lost after each move: nothing is put back until the next run or `recover`.
    for fail_at in range(1, 5):
        count[0] = 0
        monkeypatch.setattr(module._files, "move", broken)
        monkeypatch.setattr(module, "recover", lambda *a: False)
        monkeypatch.setattr(module._files, "delete", lambda *a: None)
        with pytest.raises(OSError):
            write("four")
        monkeypatch.undo()
        assert module.recover(spark, targets[0]) and not module.recover(spark, targets[0])
        assert [written(p) for p in places] == [{"x": "two"}] * 2
    write("five")
    assert [written(p) for p in places] == [{"x": "five"}] * 2


NESTED = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField(
            "s",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("x", T.StringType(), False),
                        T.StructField("m", T.MapType(T.StringType(), T.LongType(), False)),
                    ]
                ),
                False,
            ),
        ),
        T.StructField("o", T.StructType([T.StructField("k", T.LongType(), False)])),
    ]
)
NESTED_LINES = {
    '{"id":"a","s":[{"x":"1","m":{"q":1}}],"o":{"k":1}}': None,
    '{"id":"b","s":[{"x":"1"},{"m":{}}]}': "null_s.x",
    '{"id":"c","s":[null]}': "null_s[]",
    '{"id":"d","o":{}}': "null_o.k",
    '{"id":"e","s":[{"x":"1","zzz":1},{"x":"2","y":{"u":1}}],"o":{"k":2,"kk":1},"w":1}': "unknown_fields: w, s.zzz, s.y, o.kk",
    '{"id":"f","s":[{"x":"1","m":{"q":null}}]}': "null_s.m[]",
    '{"id":"g","id":"g","s":[]}': None,
    '{"id":"h","s":null}': None,
    '{"s":[{}]}': "null_id",
    "7": "malformed",
}


def test_required_and_unknown_fields_at_every_depth(spark, tmp_path):
    (tmp_path / "j.json").write_text("\n".join(NESTED_LINES))
    rows = read_checked(spark, str(tmp_path / "j.json"), NESTED)
    assert {r.line: r.reason for r in rows.collect()} == NESTED_LINES
    good = enforce_schema(rows.select(*NESTED.names), NESTED)
    assert good.schema == NESTED
    assert sorted(r.id for r in good.collect()) == ["a", "e", "g", "h"]
    assert good.filter("id = 'a'").first().s[0].m == {"q": 1}
    reasons = {r.id: r.reason for r in schema_violations(rows.drop("reason").select(*NESTED.names), NESTED).collect()}
    assert reasons == {"b": "null_s.x", "c": "null_s[]", "d": "null_o.k", "f": "null_s.m[]", None: "null_id"}


def test_required_fields_that_the_rows_do_not_have(spark):
    df = spark.createDataFrame([("a", [(1,)], None), ("b", [], None)], "id string, s array<struct<z:int>>, o struct<k:bigint>")
    with pytest.raises(TypeError, match="unexpected fields: s.z"):
        enforce_schema(df, NESTED)
    df = df.select("id", F.transform("s", lambda x: F.struct(F.lit(None).cast("map<string,bigint>").alias("m"))).alias("s"), "o")
    assert [(r.id, r.reason) for r in schema_violations(df, NESTED).collect()] == [("a", "null_s.x")]


def test_a_value_or_a_reason_for_every_field(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b's", T.StringType())])
    cases = {
        '{"a":7,"b\'s":"x"}': ((7, None), ("x", None)),
        '{"a":"x7","b\'s":null}': ((None, "wrong_type"), (None, "absent")),
        '{"a":"7"}': ((7, None), (None, "absent")),
        "[1]": ((None, "not_an_object"),) * 2,
        '{"a"': ((None, "invalid_json"),) * 2,
        None: ((None, "null_input"),) * 2,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    rows = df.select("t", fields_or_reasons(F.col("t"), schema).alias("f")).collect()
    assert {r.t: tuple(map(tuple, r.f)) for r in rows} == cases


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, conf):
    text = "\n\na\n" + "\n".join("x" * (i % 90) for i in range(500))
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text(text + name)
    for split_bytes in ("40", "999", "128m"):
        conf("spark.sql.files.maxPartitionBytes", split_bytes)
        rows = number_lines(scan_lines(spark, str(tmp_path))).collect()
        for name in ("a", "b"):
            own = sorted((r.number, r.line) for r in rows if r.path.endswith(f"{name}.txt"))
            assert own == list(enumerate((text + name).split("\n"), 1))
