"""Alarms over metrics: each turns to ALARM and back to OK as its metric's periods breach its threshold.

A period's value is the sum or the maximum of a metric's points in it; it breaches if that is the threshold or more. A
period without points does not. An alarm is OK at first, is ALARM from the end of a breaching period on, and OK again from
the end of the next period that doesn't breach. `transitions` says so for metrics at rest, with joins of whole sets;
`transition_stream` for a stream of them, with state in RocksDB: open periods by alarm, and a timer at the end of each
period that must be judged, also where no point comes. Both give the same rows for the same points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..schemas import TS, S, struct

PERIOD_SECONDS = 300
TRANSITION = struct(alarm=S, at=TS, fromState=S, toState=S)
OK, ALARM = "OK", "ALARM"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Alarm:
    name: str
    metric: str
    statistic: str  # Sum or Maximum
    threshold: float = 1.0


#: The alarms of the studied system.
ALARMS = (
    Alarm("submission-orchestration-failed", "ExecutionsFailed", "Sum"), Alarm("kb-coordinator-errors", "Errors", "Sum"),
    Alarm("documents-stuck-ingesting", "DocumentsStuckInIngesting", "Maximum"), Alarm("submissions-stuck-non-terminal", "SubmissionsStuckNonTerminal", "Maximum"),
)


def watched(metrics: DataFrame, alarms: tuple[Alarm, ...]) -> DataFrame:
    """(alarm, sums, threshold, ts, value): a point for each alarm that watches its metric. metrics: (name, ts, value, ...)."""
    of = F.array(*(F.struct(F.lit(a.name).alias("alarm"), F.lit(a.metric).alias("metric"), F.lit(a.statistic == "Sum").alias("sums"), F.lit(float(a.threshold)).alias("threshold")) for a in alarms))
    mine = F.filter(of, lambda a: a["metric"] == F.col("name"))
    return metrics.where("ts is not null and value is not null").select(F.explode(mine).alias("a"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("double").alias("value")).select("a.alarm", "a.sums", "a.threshold", "ts", "value")


def transitions(metrics: DataFrame, until: Column, alarms: tuple[Alarm, ...] = ALARMS) -> DataFrame:
    """(alarm, at, fromState, toState) of all periods that end before `until`. A breaching period looks for its neighbours by join."""
    end = F.floor(F.unix_timestamp("ts") / PERIOD_SECONDS) * PERIOD_SECONDS + PERIOD_SECONDS
    per = watched(metrics, alarms).groupBy("alarm", "sums", "threshold", end.alias("end")).agg(F.sum("value").alias("sum"), F.max("value").alias("most"))
    breaching = per.where(F.when(F.col("sums"), F.col("sum")).otherwise(F.col("most")) >= F.col("threshold")).select("alarm", "end")
    before = breaching.select("alarm", (F.col("end") + PERIOD_SECONDS).alias("end"))
    row = lambda rows, a, b: rows.select("alarm", F.timestamp_seconds("end").alias("at"), F.lit(a).alias("fromState"), F.lit(b).alias("toState"))
    both = row(breaching.join(before, ["alarm", "end"], "left_anti"), OK, ALARM).unionByName(row(before.join(breaching, ["alarm", "end"], "left_anti"), ALARM, OK))
    return both.where(F.col("at") < until)


class AlarmStates(StatefulProcessor):
    """State of one alarm: its open periods' values, whether it is in ALARM, and the end of the last period judged so."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.periods = handle.getMapState("periods", "period long", "sum double, most double, sums boolean, threshold double")
        self.alarmed = handle.getValueState("alarmed", "last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() // 1000
        for frame in rows:
            ends = frame["ts"].astype("datetime64[us]").astype("int64") // (PERIOD_SECONDS * 1_000_000) * PERIOD_SECONDS + PERIOD_SECONDS
            for end, mine in frame.groupby(ends.to_numpy()):
                if int(end) < now:  # judged already
                    continue
                held = self.periods.getValue((int(end),)) if self.periods.containsKey((int(end),)) else (0.0, float("-inf"))
                first = mine.iloc[0]
                self.periods.updateValue((int(end),), (held[0] + float(mine["value"].sum()), max(held[1], float(mine["value"].max())), bool(first["sums"]), float(first["threshold"])))
                self.handle.registerTimer(int(end) * 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self.judged(key[0], timerValues.getCurrentWatermarkInMs())

    def judged(self, alarm: str, watermark: int) -> Iterator[pd.DataFrame]:
        """All periods that have ended, in order, those without points among them."""
        last = self.alarmed.get()[0] if self.alarmed.exists() else None
        over = sorted((k[0], v) for k, v in self.periods.iterator() if k[0] * 1000 < watermark)
        out = []
        for end, (total, most, sums, threshold) in over:
            if last is not None and last + PERIOD_SECONDS < end:
                out.append((alarm, last + PERIOD_SECONDS, ALARM, OK))
                last = None
            breaching = (total if sums else most) >= threshold
            if breaching != (last is not None):
                out.append((alarm, end, OK, ALARM) if breaching else (alarm, end, ALARM, OK))
            last = end if breaching else None
            self.periods.removeKey((end,))
        if last is not None and (last + PERIOD_SECONDS) * 1000 < watermark:
            out.append((alarm, last + PERIOD_SECONDS, ALARM, OK))
            last = None
        if last is None:
            self.alarmed.clear()
        else:
            self.alarmed.update((last,))
            self.handle.registerTimer((last + PERIOD_SECONDS) * 1000)
        if out:
            frame = pd.DataFrame(out, columns=TRANSITION.names)
            frame["at"] = pd.to_datetime(frame["at"], unit="s", utc=True).dt.tz_localize(None)
            yield frame

    def close(self) -> None:
        pass


def transition_stream(metrics: DataFrame, alarms: tuple[Alarm, ...] = ALARMS, late: str = "0 seconds") -> DataFrame:
    """The transitions of a stream of metrics (name, ts, value, ...). Points later than the newest less `late` are not seen.

    The session's time zone must be UTC, as workers see timestamps in it.
    """
    spark = metrics.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    points = watched(metrics, alarms).withWatermark("ts", late)
    return points.groupBy("alarm").transformWithStateInPandas(statefulProcessor=AlarmStates(), outputStructType=TRANSITION, outputMode="Append", timeMode="EventTime")
