"""From an event file to a submission file."""

import pathlib

import numpy as np

from fixtures import stamp
from footfall.ml.trees import TreeSettings
from footfall.operators import pivots
from footfall.plans.jobs import feature_job, submission_job
from footfall.schema import TEST_COLUMNS, TRAIN_COLUMNS


def write_events(path, users, seed, columns):
    rng = np.random.default_rng(seed)
    lines = ["\t".join(columns)]
    for user in users:
        keen = user % 2
        for _ in range(int(rng.integers(3, 12))):
            row = {
                "UserId": f"u{user}", "gender": rng.choice(["-", "m", "f"]), "age": "a1", "edu": rng.choice(["x", "y"]),
                "location": "l", "label": keen, "install_channel": f"ch{rng.integers(0, 3)}", "video_id": f"v{rng.integers(0, 9)}",
                "video_type": f"T{rng.integers(0, 3)}", "video_tag": "a$b", "video_creator": f"c{rng.integers(0, 4)}",
                "launch_time": stamp(3, day=int(rng.integers(1, 9))) // 1000, "video_length": int(rng.integers(10, 90)),
                "show": 1, "click": int(rng.random() < 0.2 + 0.6 * keen), "rec_type": f"rec_type_{rng.integers(1, 4)}",
                "play_time_length": rng.choice(["-", "12.5", "30"]),
                "play_stamp": stamp(int(rng.integers(0, 24)), int(rng.integers(0, 60)), day=int(rng.integers(15, 20))),
                "comment": 0, "like": int(rng.random() < 0.3), "share": "-",
            }
            lines.append("\t".join(str(row[c]) for c in columns))
    path.write_text("\n".join(lines) + "\n")


def test_file_to_submission(spark, tmp_path):
    write_events(tmp_path / "train.tsv", range(120), 1, TRAIN_COLUMNS)
    write_events(tmp_path / "test.tsv", range(200, 230), 2, TEST_COLUMNS)
    train, test = str(tmp_path / "train"), str(tmp_path / "test")
    values, codes = feature_job(spark, str(tmp_path / "train.tsv"), train)
    feature_job(spark, str(tmp_path / "test.tsv"), test, train=False, values=values, codes=codes)
    a, b = spark.read.parquet(f"{train}/features"), spark.read.parquet(f"{test}/features")
    assert a.columns == b.columns
    assert (a.count(), b.count()) == (120, 30)
    assert spark.read.parquet(f"{train}/labels").count() == 120
    settings = TreeSettings(max_trees=4, depth=3, learning_rate=0.2, bins=16)
    result = submission_job(spark, train, test, str(tmp_path / "submission"), settings=settings)
    assert len(result.aucs) == 5 and result.mean_auc() > 0.7
    assert not {"UserId", "label", "fold"} & set(result.columns.features)
    assert sum(f.endswith("_ratio") and "_interval_" in f for f in result.columns.features) == 245
    lines = [line for f in pathlib.Path(tmp_path / "submission").glob("*.csv") for line in f.read_text().split()]
    assert len(lines) == 30 and all(len(line.split(",")[1]) == 6 for line in lines)


def test_click_vectors_reach_the_model_by_codes_of_train(spark, tmp_path):
    write_events(tmp_path / "train.tsv", range(60), 1, TRAIN_COLUMNS)
    write_events(tmp_path / "test.tsv", range(200, 220), 2, TEST_COLUMNS)
    text = (tmp_path / "test.tsv").read_text().replace("\tT0\t", "\tA_new\t")  # sorts before all values of train
    (tmp_path / "test.tsv").write_text(text)
    train, test = str(tmp_path / "train"), str(tmp_path / "test")
    values, codes = feature_job(spark, str(tmp_path / "train.tsv"), train)
    feature_job(spark, str(tmp_path / "test.tsv"), test, train=False, values=values, codes=codes)
    place = {(r["kind"], r["value"]): r["code"] for r in spark.read.parquet(f"{train}/item_codes").collect()}
    n_types = sum(kind == "video_type" for kind, _ in place)
    wanted = {}
    at = {c: TEST_COLUMNS.index(c) for c in TEST_COLUMNS}
    for line in text.splitlines()[1:]:
        row = line.split("\t")
        if row[at["click"]] == "1":
            user = wanted.setdefault(row[at["UserId"]], {})
            for kind, start in (("video_type", 0), ("install_channel", n_types)):
                if (kind, row[at[kind]]) in place:
                    i = start + place[kind, row[at[kind]]]
                    user[i] = user.get(i, 0) + 1
    rows = spark.read.parquet(f"{test}/features").select("UserId", "click_indices", "click_counts").collect()
    assert {r.UserId: dict(zip(r.click_indices or [], r.click_counts or [])) for r in rows if r.click_indices} == {u: c for u, c in wanted.items() if c}
    settings = TreeSettings(max_trees=2, depth=2, learning_rate=0.2, bins=16)
    result = submission_job(spark, train, test, str(tmp_path / "submission"), settings=settings)
    assert len(result.columns.clicks.placed) == len(place)
    assert result.models[0].numFeatures == len(result.columns.features) + result.columns.clicks.size


def test_many_values_become_vectors(spark, tmp_path, monkeypatch):
    """More values than columns are made for: the job goes on, with a vector per user beside the table."""
    monkeypatch.setattr(pivots, "MAX_COLUMNS", 4)
    monkeypatch.setattr(pivots.category_values, "__defaults__", (*pivots.category_values.__defaults__[:-1], 4))
    write_events(tmp_path / "train.tsv", range(40), 1, TRAIN_COLUMNS)
    values, codes = feature_job(spark, str(tmp_path / "train.tsv"), str(tmp_path / "train"))
    assert values is None and codes.size("edu") == 2
    vectors = spark.read.parquet(str(tmp_path / "train" / "sparse")).collect()
    clicks = sum(sum(r["counts"]) for r in vectors)
    lines = [line.split("\t") for line in (tmp_path / "train.tsv").read_text().splitlines()]
    clicked = [line for line in lines[1:] if line[TRAIN_COLUMNS.index("click")] == "1"]
    assert clicks == 2 * len(clicked)  # a video type and a channel each
    sizes = [len({line[TRAIN_COLUMNS.index(c)] for line in clicked}) for c in ("video_type", "install_channel")]
    assert {i for r in vectors for i in r["indices"]} == set(range(sum(sizes)))
