"""Streaming forms of the stages: clips that arrive as files are graded as they come, and
segments are joined across pauses with state by key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import quality


def grade_stream(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, **rules):
    """Grade every clip file in ``source`` once, in what is there now; the next run goes on."""
    clips = quality.grade(spark.readStream.schema(schema).json(source), **rules)
    return clips.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pause_groups(segments: DataFrame, gap: float = 1.0) -> DataFrame:
    """(key, start, end, n): runs of a key's ``segments`` (key, start, end) with pauses of at
    most ``gap``.  A run is given out when a later segment ends it; rows of a batch may come in
    any order, and state holds one open run for each key."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = list(state.get) if state.exists else None
        done = []
        for s, e in sorted(x for f in frames for x in zip(f["start"], f["end"], strict=True)):
            if run and s - run[1] <= gap:
                run = [run[0], max(run[1], e), run[2] + 1]
            else:
                if run:
                    done.append((key[0], *run))
                run = [s, e, 1]
        if run:
            state.update((float(run[0]), float(run[1]), int(run[2])))
        yield pd.DataFrame(done, columns=["key", "start", "end", "n"])

    return segments.groupBy("key").applyInPandasWithState(fold, "key string, start double, end double, n long", "start double, end double, n long", "append", GroupStateTimeout.NoTimeout)
