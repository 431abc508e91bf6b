"""Small event logs with known answers, and brute-force pandas versions of the operators."""

import datetime

import numpy as np
import pandas as pd

from footfall.functions.cleaning import clean_events
from footfall.functions.timeparts import decode_timestamp

RAW = (
    "user_id long, event_id long, play_stamp long, show string, click string, like string, share string, "
    "comment string, video_id string, video_tag string, video_creator string, video_type string, "
    "install_channel string, rec_type string, launch_time long, video_length int, play_time_length string"
)


def stamp(hour, minute=0, second=0, day=15, ms=0):
    at = datetime.datetime(2024, 1, day, hour, minute, second, tzinfo=datetime.timezone.utc)
    return int(at.timestamp()) * 1000 + ms


def log(spark, rows):
    """Rows as dicts; what they leave out gets a plain value."""
    plain = {
        "show": "0", "click": "0", "like": "0", "share": "0", "comment": "0", "video_id": "v1", "video_tag": "t1",
        "video_creator": "c1", "video_type": "A", "install_channel": "ch", "rec_type": "rec_type_1",
        "launch_time": stamp(0, day=1) // 1000, "video_length": 10, "play_time_length": "5",
    }
    names = [part.split()[0] for part in RAW.split(", ")]
    data = [tuple((plain | {"event_id": i} | row).get(n) for n in names) for i, row in enumerate(rows)]
    return clean_events(decode_timestamp(spark.createDataFrame(data, RAW)))


EDGE = [
    dict(user_id=1, play_stamp=stamp(10), show="1", video_id="v1", video_tag="t1$t2", video_type="A"),
    dict(user_id=1, play_stamp=stamp(10, 30), show="1", click="1", video_id="v1", video_tag="t1", video_type="B"),
    dict(user_id=1, play_stamp=stamp(10, 30), show="-", click="-", like="-", share="-", comment="-", video_id="v2",
         video_tag=None, video_type="A"),
    dict(user_id=1, play_stamp=stamp(14), show="1", click="1", like="1", video_id=None, video_tag="t1", video_type="A"),
    dict(user_id=1, play_stamp=stamp(21), show="1", click="1", video_id="v3", video_tag="t2", video_type="Z"),
    dict(user_id=2, play_stamp=stamp(0), show="1", video_id="v1", video_tag=None, video_type="A"),
]


def skewed_rows(seed=7, n=1500):
    """A log in which one user has two thirds of the events, many in one minute and at one stamp."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        user = 1 if rng.random() < 0.66 else int(rng.integers(2, 12))
        kind = rng.random()
        if user == 1 and kind < 0.3:
            at = stamp(9, 15)
        elif user == 1 and kind < 0.6:
            at = stamp(9, 15, int(rng.integers(0, 60)), ms=int(rng.integers(0, 1000)))
        else:
            at = stamp(int(rng.integers(0, 24)), int(rng.integers(0, 60)), int(rng.integers(0, 60)),
                       int(rng.integers(15, 20)), int(rng.integers(0, 1000)))
        rows.append(
            dict(
                user_id=user, play_stamp=at,
                show=str(int(rng.random() < 0.7)), click=str(int(rng.random() < 0.4)), like=str(int(rng.random() < 0.05)),
                video_id="hot" if rng.random() < 0.5 else (None if rng.random() < 0.1 else f"v{rng.integers(0, 30)}"),
                video_tag=None if rng.random() < 0.1 else f"t{rng.integers(0, 4)}$t{rng.integers(0, 4)}",
                video_creator=None if rng.random() < 0.1 else f"c{rng.integers(0, 5)}",
                video_type=f"type{rng.integers(0, 4)}",
                launch_time=stamp(0, day=int(rng.integers(1, 15))) // 1000,
            )
        )
    return rows


def ordered(events) -> pd.DataFrame:
    return events.toPandas().sort_values(["user_id", "play_stamp", "event_id"]).reset_index(drop=True)


def brute_stats(values: pd.Series) -> dict:
    return {
        "count": values.nunique(), "var": values.var(), "mean": values.mean(), "median": values.median(),
        "mad": (values - values.mean()).abs().mean(), "skew": values.skew(), "kurt": values.kurt(), "max": values.max(),
    }


def same(got, want, places=1e-6) -> bool:
    gone = got is None or (isinstance(got, float) and np.isnan(got))
    if want is None or (isinstance(want, (float, np.floating)) and np.isnan(want)):
        return gone
    return not gone and abs(float(got) - float(want)) <= places * max(1.0, abs(float(want)))
