"""Files written and read back."""

import pathlib

import pytest

from footfall import EventSpec
from footfall.schema import TEST_COLUMNS, TRAIN_COLUMNS
from footfall.session import materialise, scratch_path, scratch_scope
from footfall.functions.cleaning import clean_events
from footfall.functions.timeparts import decode_timestamp
from footfall.operators import actions, distribution, sequence
from footfall.sources import events as source
from footfall.sources import sinks
from pyspark.sql import types as T

LINES = [
    ["7", "-", "a", "e", "x", "1", "ch", "v1", "T", "p$q", "c", "1546300800", "30", "1", "-", "rec_type_1", "12.5", "1546333200000", "0", "-", "0"],
    ["7", "m", "a", "e", "x", "1", "ch", "v2", "T", "p", "c", "1546300800", "30", "1", "1", "rec_type_2", "-", "1546336800500", "0", "1", "0"],
    ["3", "m", "-", "e", "x", "0", "ch", "v1", "S", "q", "c", "1546300800", "60", "0", "0", "rec_type_1", "3", "1546336800000", "0", "0", "0"],
]


def event_file(tmp_path, columns) -> str:
    path = tmp_path / "events.tsv"
    keep = [i for i, c in enumerate(TRAIN_COLUMNS) if c in columns]
    rows = [[f"any{i}" for i in keep], *[[line[i] for i in keep] for line in LINES]]
    path.write_text("\n".join("\t".join(r) for r in rows) + "\n")
    return str(path)


SPEC = EventSpec(user="UserId", tie=None)


@pytest.mark.parametrize("columns", [TRAIN_COLUMNS, TEST_COLUMNS])
def test_event_file_by_position(spark, tmp_path, columns):
    raw = source.load_events(spark, event_file(tmp_path, columns), columns)
    assert raw.columns == columns
    assert raw.count() == 3
    events = clean_events(decode_timestamp(raw), drop=("location",))
    counts = {r["UserId"]: r for r in actions.action_counts(events, SPEC).collect()}
    assert (counts["7"]["show_count"], counts["7"]["click_count"], counts["7"]["like_count"]) == (2, 1, 1)
    times = {r["UserId"]: r for r in distribution.time_of_day_stats(events, SPEC).collect()}
    assert times["7"]["time_play_mean"] == 9.5
    diffs = {r["UserId"]: r for r in sequence.time_diff_stats(events, SPEC).collect()}
    assert diffs["7"]["diff_time_play_max"] == 1.0 and diffs["3"]["diff_time_play_count"] == 0


def test_row_limit(spark, tmp_path):
    path = event_file(tmp_path, TRAIN_COLUMNS)
    assert source.load_events(spark, path, nrows=2).count() == 2
    taken = [r["UserId"] for r in source.load_events(spark, path, nrows=2).collect()]
    assert taken == [line[0] for line in LINES[:2]]
    ordered = [r["UserId"] for r in source.load_events(spark, path, nrows=3, spec=SPEC).collect()]
    assert ordered == sorted(line[0] for line in LINES)


def test_malformed_fields_stop_the_job(spark, tmp_path):
    path = pathlib.Path(event_file(tmp_path, TRAIN_COLUMNS))
    good = path.read_text()
    line = good.splitlines()[1].split("\t")
    for bad in (["x" if c == "play_stamp" else v for c, v in zip(TRAIN_COLUMNS, line)], line[:5]):
        path.write_text(good + "\t".join(bad) + "\n")
        with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
            source.load_events(spark, str(path)).collect()


def test_profile(spark, tmp_path):
    raw = source.load_events(spark, event_file(tmp_path, TRAIN_COLUMNS))
    assert tuple(source.profile_events(raw, SPEC).first()) == (3, 2)
    assert tuple(source.profile_events(raw, SPEC, approximate=True).first()) == (3, 2)


def test_index_column_is_dropped(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(",UserId,x\n0,1,2\n1,3,4\n".replace(",UserId", "Unnamed: 0,UserId", 1))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ["Unnamed: 0", "UserId", "x"]])
    table = source.load_table(spark, str(path), schema)
    assert table.columns == ["UserId", "x"] and table.count() == 2


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_table_round_trip(spark, tmp_path, fmt):
    table = spark.createDataFrame([(1, 0.5), (2, None)], "UserId long, x double")
    path = str(tmp_path / fmt)
    sinks.write_table(table, path, fmt)
    back = source.load_table(spark, path, table.schema, fmt)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, table.collect()), key=str)


def test_submission_file(spark, tmp_path):
    scores = spark.createDataFrame([(1, 0.03125), (2, 0.99999), (3, 0.5)], "user_id long, score double")
    path = tmp_path / "submission"
    sinks.write_submission(scores, str(path), "user_id", "score")
    lines = sorted(line for f in pathlib.Path(path).glob("*.csv") for line in f.read_text().split())
    assert lines == [f"{u},{s:.4f}" for u, s in [(1, 0.03125), (2, 0.99999), (3, 0.5)]]


def test_scratch_is_in_the_checkpoint_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != path


def test_no_local_scratch_on_a_cluster(monkeypatch):
    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Session:
        conf = Conf
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        scratch_path(Session, "x")


def test_scratch_of_a_scope_is_deleted(spark):
    with scratch_scope(spark):
        table = materialise(spark.range(3), "x")
        path = table.inputFiles()[0].removeprefix("file:")
        assert pathlib.Path(path).exists()
    assert not pathlib.Path(path).parent.exists()


def test_scopes_of_threads_are_apart(spark):
    import threading

    other: list[str] = []

    def job():
        other.append(materialise(spark.range(2), "other").inputFiles()[0].removeprefix("file:"))

    with scratch_scope(spark):
        thread = threading.Thread(target=job)
        thread.start()
        thread.join()
    assert pathlib.Path(other[0]).exists()


@pytest.mark.parametrize("split", ["200", "128m"])
def test_first_rows_follow_the_files(spark, tmp_path, split):
    rows = [["u"] * len(TRAIN_COLUMNS) for _ in range(60)]
    for i, row in enumerate(rows):
        for name, value in (("play_stamp", i), ("label", 0), ("launch_time", 1), ("video_length", 1)):
            row[TRAIN_COLUMNS.index(name)] = str(value)
    for k, part in enumerate((rows[:25], rows[25:31], rows[31:])):
        text = "\n".join("\t".join(r) for r in [TRAIN_COLUMNS, *part]) + "\n"
        (tmp_path / f"part-{k}.tsv").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        for n in (0, 1, 24, 25, 26, 31, 45, 60, 99):
            got = source.load_events(spark, str(tmp_path), nrows=n)
            assert sorted(r["play_stamp"] for r in got.select("play_stamp").collect()) == list(range(min(n, 60))), n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
