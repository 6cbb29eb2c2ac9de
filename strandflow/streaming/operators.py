"""Streaming forms: stateless line filters, session islands, and islands with explicit state."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.filters import column_sum, score_threshold


def filter_lines(lines: DataFrame, columns: list[int], thresholds: list[float]) -> DataFrame:
    """score_threshold over a stream of lines."""
    return score_threshold(lines, columns, thresholds)


def sum_lines(lines: DataFrame, columns: list[int], name: str = "sum") -> DataFrame:
    return column_sum(lines, columns, name)


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour", key: str = "user_id", time: str = "ts", value: str = "value") -> DataFrame:
    """Islands in time: per key, events less than ``gap`` apart; late events within the watermark still count."""
    out = events.withWatermark(time, late).groupBy(F.col(key), F.session_window(time, gap).alias("w"))
    return out.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def stateful_islands(reads: DataFrame) -> DataFrame:
    """Islands of a stream of reads (chrom, strand, pos, pend) that comes in order of position.

    Only the open island of each chromosome and strand is state; position is the watermark: a read beyond the open
    island's end closes and emits it.  An open island is emitted by ``flush`` rows (pos null).
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, end, n = state.get if state.exists else (None, None, 0)
        out = []
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["pos", "pend"], na_position="last")
        for pos, pend in zip(rows["pos"], rows["pend"], strict=True):
            if pd.isna(pos):
                if start is not None:
                    out.append((*key, start, end, n))
                start, end, n = None, None, 0
            elif start is None:
                start, end, n = int(pos), int(pend), 1
            elif pos > end:
                out.append((*key, start, end, n))
                start, end, n = int(pos), int(pend), 1
            else:
                end, n = max(end, int(pend)), n + 1
        if start is None:
            state.remove()
        else:
            state.update((start, end, n))
        yield pd.DataFrame(out, columns=["chrom", "strand", "start", "end", "n"])

    schema = "chrom string, strand string, start long, end long, n long"
    return reads.groupBy("chrom", "strand").applyInPandasWithState(step, schema, "start long, end long, n long", "append", GroupStateTimeout.NoTimeout)


def merged_islands(reads: DataFrame) -> DataFrame:
    """Islands of a stream of reads (chrom, strand, pos, pend) that comes in any order.

    The islands so far of each chromosome and strand are state, as JSON; reads join and connect them.  A ``flush`` row
    (pos null), sent when the input has ended, emits them.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True)
        new = rows.dropna(subset="pos").astype({"pos": "int64", "pend": "int64"})
        found = [[p, e, 1] for p, e in zip(new["pos"].tolist(), new["pend"].tolist(), strict=True)]
        out: list[list[int]] = []
        for start, end, n in sorted((json.loads(state.get[0]) if state.exists else []) + found):
            if out and start <= out[-1][1]:
                out[-1][1:] = max(out[-1][1], end), out[-1][2] + n
            else:
                out.append([start, end, n])
        if len(new) < len(rows):
            state.remove()
        else:
            state.update((json.dumps(out),))
            out = []
        yield pd.DataFrame([(*key, *x) for x in out], columns=["chrom", "strand", "start", "end", "n"])

    schema = "chrom string, strand string, start long, end long, n long"
    return reads.groupBy("chrom", "strand").applyInPandasWithState(step, schema, "islands string", "append", GroupStateTimeout.NoTimeout)


#: Places of one entry of an island's state.
STATE_BIN = 1 << 12


def _merged(intervals: list[list[int]]) -> list[list[int]]:
    """[start, end, n] in order of start, with those that touch made one."""
    out: list[list[int]] = []
    for start, end, n in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1][1:] = max(out[-1][1], end), out[-1][2] + n
        else:
            out.append([start, end, n])
    return out


def _merged_before(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Touching reads of a batch as one row, for all chromosomes of it in one pass: there may be one to each row."""
    for pdf in batches:
        if pdf.empty:
            continue
        group = pdf.groupby(["chrom", "strand", "base"], dropna=False, sort=False).ngroup().to_numpy()
        pos, pend = pdf["pos"].to_numpy("int64"), pdf["pend"].to_numpy("int64")
        order = np.lexsort((pend, pos, group))
        group, pos, pend = group[order], pos[order], pend[order]
        # the greatest end so far in its group: groups are moved apart
        base = group * (pend.max() - pend.min() + 1)
        top = np.maximum.accumulate(pend + base) - base
        first = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (pos[1:] > top[:-1])])
        keys = pdf[["chrom", "strand", "base"]].iloc[order[first]].reset_index(drop=True)
        keys = keys.assign(**{c: [None if x != x else x for x in keys[c]] for c in ("chrom", "strand")})
        yield keys.assign(start=pos[first], end=np.maximum.reduceat(pend, first), n=np.diff(np.r_[first, len(pos)]))


def released_islands(reads: DataFrame, late: int) -> DataFrame:
    """Islands of a stream of reads (chrom, strand, place, pos, pend) that comes roughly in order of place, with state for
    the open ones alone.

    ``place`` is pos plus a number that is the same for a chromosome and strand: pos itself where all chromosomes advance
    together, or a place in the genome for sorted files.  It is event time, in milliseconds, and its watermark lies
    ``late`` behind the greatest start so far: an island that ends there is emitted and its state freed; reads that begin
    at or before the watermark come too late and are dropped.  Islands are state by bins of their starts, with a timer for
    each bin's last end.  Touching reads of a batch's partition are merged before the shuffle, so a chromosome with many
    reads sends few rows to its task.  Places are 0 or more; rows with a null place are dropped; equal reads each count.
    """

    class Islands(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.bins = handle.getMapState("islands", "bin long", "base long, start array<bigint>, end array<bigint>, n array<bigint>")

        @staticmethod
        def _read(value: tuple) -> tuple[int, list[list[int]]]:
            base, *columns = value
            return int(base), [list(map(int, x)) for x in zip(*columns, strict=True)]

        def _store(self, islands: list[list[int]], base: int) -> set[int]:
            """Write islands to their bins; the bins.  Each call of the state is a message to the JVM."""
            bins = set()
            for k, own in itertools.groupby(islands, key=lambda x: x[0] // STATE_BIN):
                starts, ends, n = map(list, zip(*own, strict=True))
                self.bins.updateValue((k,), (base, starts, ends, n))
                self.handle.registerTimer(max(ends) + base)
                bins.add(k)
            return bins

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
            parts = list(rows)
            new = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
            base = int(new["base"].iloc[0])
            found = _merged(list(map(list, zip(new["start"].tolist(), new["end"].tolist(), new["n"].tolist(), strict=True))))
            held = sorted(k for (k,) in self.bins.keys())
            first = found[0][0] // STATE_BIN
            # an island that reaches the first new one may begin in the last bin before it, not earlier: islands are apart
            low = max((k for k in held if k < first), default=first)
            touched = [k for k in held if low <= k <= max(i[1] for i in found) // STATE_BIN]
            islands = _merged(found + [i for k in touched for i in self._read(self.bins.getValue((k,)))[1]])
            stored = self._store(islands, base)
            for k in touched:
                if k not in stored:
                    self.bins.removeKey((k,))
            yield from ()

        def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
            mark, out = timerValues.getCurrentWatermarkInMs(), []
            # bins with what they hold come in one message
            for k, (base, islands) in sorted((key[0], self._read(value)) for key, value in self.bins.iterator()):
                closed, still = [i for i in islands if i[1] + base <= mark], [i for i in islands if i[1] + base > mark]
                out += closed
                if closed and not self._store(still, base):
                    self.bins.removeKey((k,))
            if out:
                yield pd.DataFrame([(*key, *i) for i in out], columns=["chrom", "strand", "start", "end", "n"])

        def close(self) -> None:
            pass

    # the first watermark is 0, so times start beyond it
    rows = reads.where("place IS NOT NULL AND pend IS NOT NULL").select("chrom", "strand", (F.col("place") - F.col("pos") + late + 1).alias("base"), "pos", "pend")
    rows = rows.mapInPandas(_merged_before, "chrom string, strand string, base long, start long, end long, n long")
    rows = rows.withColumn("at", F.timestamp_millis(F.col("start") + F.col("base"))).withWatermark("at", f"{late} milliseconds")
    schema = "chrom string, strand string, start long, end long, n long"
    return rows.groupBy("chrom", "strand").transformWithStateInPandas(Islands(), schema, "append", "eventTime")


#: The state store that keyed map state needs.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", conf: dict[str, str] | None = None) -> StreamingQuery:
    """Everything that is there now, written as Parquet.  ``conf``: settings of this run."""
    spark = stream.sparkSession
    old = {k: spark.conf.get(k, None) for k in conf or {}}
    for k, v in (conf or {}).items():
        spark.conf.set(k, v)
    try:
        q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return q
