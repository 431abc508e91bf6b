"""Event-log layout: column lists, types and the names the operators use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The event file's columns in order. The test file is the same without `label`.
TRAIN_COLUMNS = [
    "UserId", "gender", "age", "edu", "location", "label", "install_channel", "video_id",
    "video_type", "video_tag", "video_creator", "launch_time", "video_length", "show", "click",
    "rec_type", "play_time_length", "play_stamp", "comment", "like", "share",
]
TEST_COLUMNS = [c for c in TRAIN_COLUMNS if c != "label"]

MISSING = "-"
FLAGS = ("show", "click", "comment", "like", "share")
DEMOGRAPHICS = ("gender", "age", "edu")
REC_TYPES = ("rec_type_1", "rec_type_2", "rec_type_3")

_FILE_TYPES = {
    "label": T.IntegerType(),
    "launch_time": T.LongType(),
    "video_length": T.IntegerType(),
    "play_stamp": T.LongType(),
}


def event_file_schema(columns: list[str]) -> T.StructType:
    """Types of the event file; all that may hold the missing sign stays a string."""
    return T.StructType([T.StructField(c, _FILE_TYPES.get(c, T.StringType())) for c in columns])


@dataclass(frozen=True)
class EventSpec:
    """Names of the columns the operators read.

    `tie` is a unique event id. It orders events of one user with the same stamp and
    addresses single events; families that only aggregate work without it.
    """

    user: str = "user_id"
    ts: str = "ts"
    tie: str | None = "event_id"
    time_of_day: str = "play_time"
    play_stamp: str = "play_stamp"

    def in_slice(self, name: str) -> Column:
        """Condition for an action slice; `play` is every event."""
        return F.lit(True) if name == "play" else F.col(name) == 1

    def single(self) -> str:
        """The column that tells single events apart, for operators with a row per event."""
        if not self.tie:
            raise ValueError("rows per event need an event id: see sources.events.with_event_id")
        return self.tie

    def order_key(self) -> Column:
        return F.struct(self.ts, self.tie) if self.tie else F.struct(self.ts)


DEFAULT = EventSpec()
SLICES = ("play", "show", "click", "like")
