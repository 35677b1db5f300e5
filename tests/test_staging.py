import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import at, plan, raw_frame, raw_row
from tallyhouse.functions import (
    event_date,
    hour_of_day,
    infer_language,
    json_texts,
    last_path_part,
    short_repo_label,
    split_repo,
)
from tallyhouse.operators.idfilter import BLOCK_BITS, MAX_BITS, bitmap_bits, id_filter
from tallyhouse.operators.staging import (
    dedup_latest,
    repeated_ids,
    stage_events,
    staged_from_files,
)
from tallyhouse.schemas import RAW_SCHEMA, STAGING_COLUMNS


def test_rows_without_required_fields_go(spark):
    raw = raw_frame(spark, raw_row("1"), raw_row(None), raw_row("2", type=None), raw_row("3", when=None))
    assert [r.event_id for r in stage_events(raw).collect()] == ["1"]


def test_newest_copy_stays(spark):
    raw = raw_frame(
        spark,
        raw_row("1", "2024-05-01T10:00:00", actor="old"),
        raw_row("1", "2024-05-02T10:00:00", actor="new"),
        raw_row("1", "2024-05-01T12:00:00", actor="mid"),
    )
    staged = stage_events(raw)
    assert staged.columns == list(STAGING_COLUMNS)
    assert [r.actor_login for r in staged.collect()] == ["new"]


def test_incomplete_newer_copy_does_not_win(spark):
    raw = raw_frame(spark, raw_row("1", actor="kept"), raw_row("1", "2024-06-01T00:00:00", type=None))
    assert [r.actor_login for r in stage_events(raw).collect()] == ["kept"]


def test_payload_does_not_change_the_other_columns(spark):
    rows = [raw_row("1", actor=a, payload=p) for a in ("x", "y") for p in ('{"a":1}', '{"b":2}', None)]
    raw = raw_frame(spark, *rows)
    full = stage_events(raw).drop("payload").collect()
    assert full == stage_events(raw, payload=False).collect()
    assert len(full) == 1


def test_payload_is_not_read_when_left_out(spark, tmp_path):
    raw_frame(spark, raw_row("1")).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    scan = plan(stage_events(raw, payload=False)).split("ReadSchema")[1].splitlines()[0]
    assert "payload" not in scan


def test_plan_limits_groups_before_the_shuffle(spark, tmp_path):
    raw_frame(spark, raw_row("1")).write.parquet(str(tmp_path / "raw"))
    text = plan(stage_events(spark.read.parquet(str(tmp_path / "raw"))))
    assert "Partial" in text and text.count("WindowGroupLimit") >= 2
    assert "IsNotNull(id)" in text and "IsNotNull(created_at)" in text


def test_json_edge_values(spark):
    texts = [
        ('{"id":12345678901234567890,"name":"a"}', "a", "12345678901234567890"),
        ('{"id":1.5,"name":null}', None, "1.5"),
        ('{"name":"ünï/\\"x\\""}', 'ünï/"x"', None),
        ("{}", None, None),
        (None, None, None),
        ("not json", None, None),
        ('{"id":true}', None, "true"),
    ]
    df = spark.createDataFrame([(t,) for t, _, _ in texts], "repo string")
    got = df.select(*json_texts("repo", name="name", id="id")).collect()
    assert [tuple(r) for r in got] == [(n, i) for _, n, i in texts]


def test_text_timestamp_must_parse(spark):
    df = spark.createDataFrame([("nonsense",)], "created_at string")
    with pytest.raises(PySparkException):
        df.select(F.col("created_at").cast("timestamp")).collect()


@pytest.mark.parametrize(
    "name, owner, short, last, label, language",
    [
        ("acme/python-sdk", "acme", "python-sdk", "python-sdk", "acme/python-sdk", "Python"),
        ("acme/JavaScript", "acme", "JavaScript", "JavaScript", "acme/JavaScript", "JavaScript"),
        ("acme/java-x", "acme", "java-x", "java-x", "acme/java-x", "Java"),
        ("acme/mongodb", "acme", "mongodb", "mongodb", "acme/mongodb", "Go"),
        ("acme/typescript-rust", "acme", "typescript-rust", "typescript-rust", "acme/typescript-rust", "Rust"),
        ("acme/my-cpp", "acme", "my-cpp", "my-cpp", "acme/my-cpp", "C++"),
        ("acme/csharp", "acme", "csharp", "csharp", "acme/csharp", "C#"),
        ("plain-python", "plain-python", None, "plain-python", "plain-python", None),
        ("a/b/c-ruby", "a", "b", "c-ruby", "b/c-ruby", None),
        ("acme/react", "acme", "react", "react", "acme/react", None),
        ("x" * 20 + "/" + "y" * 20, "x" * 20, "y" * 20, "y" * 20, "x" * 20 + "/yyyy...", None),
        (None, None, None, None, None, None),
    ],
)
def test_repository_names(spark, name, owner, short, last, label, language):
    df = spark.createDataFrame([(name,)], "n string")
    row = df.select(
        split_repo("n", 0), split_repo("n", 1), last_path_part("n"), short_repo_label("n"),
        infer_language(split_repo("n", 1)),
    ).first()
    assert tuple(row) == (owner, short, last, label, language)


def test_label_boundary(spark):
    df = spark.createDataFrame([("a" * 28,), ("b" * 29,)], "n string")
    assert [r[0] for r in df.select(short_repo_label("n")).collect()] == ["a" * 28, "b" * 25 + "..."]
    with pytest.raises(ValueError):
        short_repo_label("n", 3)


# -- deduplication of stored files --------------------------------------------


def many_copies(spark):
    """A third of all rows carry one id; some ids come twice, most once."""
    return spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN CAST(id % 100 AS STRING) "
        "ELSE concat('e', id) END AS id",
        "IF(id % 7 = 0, NULL, 'PushEvent') AS type",
        "concat('{\"id\":', id % 5, ',\"login\":\"u', id % 11, '\"}') AS actor",
        "concat('{\"id\":', id % 3, ',\"name\":\"o/r', id % 13, '\"}') AS repo",
        "concat('{\"n\":', id, '}') AS payload",
        "id % 2 = 0 AS public",
        "timestamp_seconds(1714550400 + (id % 17) * 3600) AS created_at",
        "CAST(NULL AS STRING) AS org",
    )


def test_file_based_dedup_equals_the_window(spark, tmp_path):
    path = str(tmp_path / "raw")
    many_copies(spark).repartition(9).write.parquet(path)
    raw = spark.read.schema(RAW_SCHEMA).parquet(path)
    columns = list(STAGING_COLUMNS)
    expected = sorted(map(str, stage_events(raw).select(*columns).collect()))
    for bits in (MAX_BITS, 4096):  # a filter with room, and one that hits by chance
        with staged_from_files(raw, max_bits=bits) as staged:
            assert sorted(map(str, staged.rows.select(*columns).collect())) == expected


def test_payloads_of_single_ids_are_never_exchanged(spark, tmp_path):
    path = str(tmp_path / "raw")
    many_copies(spark).repartition(9).write.parquet(path)
    raw = spark.read.schema(RAW_SCHEMA).parquet(path)
    repeated = {r.id for r in repeated_ids(raw).collect()}
    with staged_from_files(raw) as staged:
        text = plan(staged.settled)
        assert "BroadcastHashJoin" in text
        assert not re.search("hashpartitioning|rangepartitioning|SinglePartition", text)
        settled = {r.event_id for r in staged.settled.collect()}
        # What is shuffled has passed the filter, and is cut to a row per id and task before.
        moved = plan(staged.moved)
        assert moved.index("Exchange hashpartitioning") < moved.index("BroadcastHashJoin")
        assert moved.count("WindowGroupLimit") >= 2
        assert {r.event_id for r in staged.moved.collect()} - repeated == set()
    usable = {r.id for r in raw.filter("type IS NOT NULL").select("id").collect()}
    assert settled == usable - repeated


def test_copies_that_differ_in_payload_only(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [raw_row(str(i % 40), payload=f'{{"v":{i % 7}}}') for i in range(280)]
    raw_frame(spark, *rows).repartition(5).write.parquet(path)
    raw = spark.read.schema(RAW_SCHEMA).parquet(path)
    for bits in (MAX_BITS, 4096):
        with staged_from_files(raw, max_bits=bits) as staged:
            assert {r.payload for r in staged.rows.collect()} == {'{"v":6}'}


def test_narrow_steps_read_narrow_columns(spark, tmp_path):
    path = str(tmp_path / "raw")
    many_copies(spark).write.parquet(path)
    raw = spark.read.schema(RAW_SCHEMA).parquet(path)

    def scanned(df):
        return df._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1:]

    for schema in scanned(repeated_ids(raw)):
        assert schema.splitlines()[0] == "struct<id:string,type:string,created_at:timestamp>"


def test_identical_copies_leave_one(spark, tmp_path):
    path = str(tmp_path / "raw")
    row = raw_row("1", payload='{"a":1}')
    for _ in range(3):
        raw_frame(spark, row, row).coalesce(1).write.mode("append").parquet(path)
    raw = spark.read.schema(RAW_SCHEMA).parquet(path)
    with staged_from_files(raw) as staged:
        assert staged.rows.count() == 1


def test_no_copies_need_no_join(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_frame(spark, raw_row("1"), raw_row("2")).write.parquet(path)
    with staged_from_files(spark.read.schema(RAW_SCHEMA).parquet(path)) as staged:
        assert staged.rows.count() == 2
        assert "Join" not in plan(staged.rows)


def test_dedup_of_a_composite_key(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 9), (1, 2, 3)], "a int, b int, t int")
    assert sorted(map(tuple, dedup_latest(df, ["a", "b"], "t").collect())) == [(1, 1, 9), (1, 2, 3)]


def test_objects_and_arrays_are_not_scalars(spark):
    texts = ['{"id":{"a":1},"login":["x"]}', '{"id":"{a","login":"[x"}', '{"id":7,"login":{}}', '{"id":[],"login":"l"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, j string")
    got = df.select("n", *json_texts("j", a="id", b="login")).orderBy("n").collect()
    assert [tuple(r)[1:] for r in got] == [(None, None), ("{a", "[x"), ("7", None), (None, "l")]


def test_id_filter_has_every_id_and_few_others(spark):
    ids = spark.range(4000).selectExpr("concat('id', id) AS id")
    others = spark.range(4000, 60_000).selectExpr("concat('id', id) AS id")
    made = id_filter(ids, 4000)
    assert made.bits == 1 << 16 and made.blocks.count() <= made.bits // BLOCK_BITS
    assert made.maybe(ids, "id").count() == 4000
    by_chance, out = made.split(others, "id")
    assert by_chance.count() < 0.01 * 56_000
    assert by_chance.unionAll(out).distinct().count() == 56_000
    full = id_filter(ids, 4000, max_bits=BLOCK_BITS)  # far too small: still no id is lost
    assert full.bits == BLOCK_BITS and full.maybe(ids, "id").count() == 4000


def test_filter_size_is_bounded(spark):
    assert bitmap_bits(0) == bitmap_bits(1) == BLOCK_BITS
    assert bitmap_bits(1000) == 1 << 14 and bitmap_bits(10**12) == MAX_BITS
    assert id_filter(spark.range(0).selectExpr("'x' AS id"), 0).maybe(
        spark.range(9).selectExpr("string(id) AS id"), "id"
    ).isEmpty()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_dates_and_hours_are_utc_in_any_session(spark, kind):
    df = spark.createDataFrame([(at("2024-05-01T01:30:00"),), (at("1969-12-31T23:30:00"),)], "t timestamp")
    # A wall clock of a spring night that New York's clocks leave out, when it has no zone.
    df = df.unionAll(spark.createDataFrame([(at("2024-03-10T02:30:00"),)], "t timestamp"))
    df = df.select(F.col("t").cast(kind))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [tuple(map(str, r)) for r in df.select(event_date("t"), hour_of_day("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [("2024-05-01", "1"), ("1969-12-31", "23"), ("2024-03-10", "2")]
