"""Streams that keep state of their own: an exact trailing-window limiter and the fold of token events."""

from __future__ import annotations

import itertools
import json
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WAITING_ROWS = 10_000
BLOCK_PERIODS = 8


def _keyed_state(spark: SparkSession) -> None:
    """Custom state needs a store with column families; the setting holds for the session's next queries."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(setting, "") or ""):
        spark.conf.set(setting, PROVIDER)


class TrailingCalls(StatefulProcessor):
    """The calls of one service in one block of ``BLOCK_PERIODS`` periods: calls by second, with those of the period before, and the calls that aren't
    judged yet. A timer judges every second that the watermark has passed, since then all of its calls are known, and sets the next one, so a block
    has a few timers however many seconds it has. What there is leaves when the watermark passes the block's end."""

    def __init__(self, period: int, most: int) -> None:
        self.period, self.most, self.block = period, most, BLOCK_PERIODS * period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.calls = handle.getValueState("calls", "seconds array<long>, counts array<long>")
        self.waiting = handle.getListState("waiting", "second long, id string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.calls.get() or ([], [])
        counts = Counter(dict(zip(*held)))
        own: list[tuple] = []
        first = None
        for row in rows:
            second = row["second"]
            counts[second] += 1
            if row["own"]:
                first = second if first is None else min(first, second)
                own.append((second, row["id"]))
            if len(own) >= WAITING_ROWS:
                self.waiting.appendList(own)
                own = []
        if own:
            self.waiting.appendList(own)
        if first is not None:
            self.handle.registerTimer((first + 1) * 1000)
        self.calls.update((list(counts.keys()), list(counts.values())))
        self.handle.registerTimer((key[1] + 1) * self.block * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        ended = (key[1] + 1) * self.block * 1000 <= watermark
        waiting = list(self.waiting.get()) if self.waiting.exists() else []
        due = [call for call in waiting if (call[0] + 1) * 1000 <= watermark]
        left = [tuple(call) for call in waiting if (call[0] + 1) * 1000 > watermark]
        seconds, counts = zip(*sorted(zip(*(self.calls.get() or ([], []))))) if due else ((), ())
        if ended:
            self.calls.clear()
            self.waiting.clear()
        elif due:
            self.waiting.put(left) if left else self.waiting.clear()
        if left:
            self.handle.registerTimer((min(second for second, _ in left) + 1) * 1000)
        upto = [0, *itertools.accumulate(counts)]
        for second, id_ in due:
            earlier = upto[bisect_right(seconds, second)] - upto[bisect_right(seconds, second - self.period)] - 1
            yield Row(service=key[0], second=second, id=id_, earlier=earlier, can_proceed=earlier < self.most)

    def close(self) -> None:
        pass


def trailing_calls(events: DataFrame, service: str, time: str, event: str, period: int, calls_allowed: int, burst: int = 0, late: str = "10 minutes") -> DataFrame:
    """(service, second, id, earlier, can_proceed) of every call of a stream: what ``runs.rate_limited`` says of it in a batch.

    A call is judged once the watermark, ``late`` behind the latest time, has passed its second; later ones are dropped. A service's time is cut
    into blocks of ``BLOCK_PERIODS`` periods, which are groups of their own: a call goes to its block, in the block's last period to the next one too, to be
    counted there, so a busy service is dealt over tasks. State is one number a second of the blocks that the watermark hasn't passed, and the ids that wait.
    """
    _keyed_state(events.sparkSession)
    at = F.col(time).cast("timestamp")
    rows = events.select(F.col(service).cast("string").alias("service"), at.alias("at"), F.unix_seconds(at).alias("second"), F.col(event).cast("string").alias("id")).filter("at IS NOT NULL")
    seconds = BLOCK_PERIODS * period
    block = F.floor(F.col("second") / seconds).cast("long")
    ahead = F.when(F.pmod("second", F.lit(seconds)) >= seconds - period, F.struct((block + 1).alias("block"), F.lit(False).alias("own")))
    both = F.array_compact(F.array(F.struct(block.alias("block"), F.lit(True).alias("own")), ahead))
    rows = rows.select("service", "at", "second", "id", F.inline(both)).withWatermark("at", late)
    return rows.groupBy("service", "block").transformWithState(TrailingCalls(period, calls_allowed + burst), "service string, second long, id string, earlier long, can_proceed boolean", "append", "EventTime")


def _token_event(line: str) -> tuple[str, int | None] | None:
    """The token and the usage of a ``data:`` line; none where it is no event."""
    try:
        event = json.loads(line)
    except ValueError:
        return None
    choices = event.get("choices") if isinstance(event, dict) else None
    delta = choices[0].get("delta") if isinstance(choices, list) and choices and isinstance(choices[0], dict) else None
    token = delta.get("content") if isinstance(delta, dict) else None
    usage = event.get("usage") if isinstance(event, dict) else None
    used = usage.get("completion_tokens") if isinstance(usage, dict) else None
    return token if isinstance(token, str) else "", used if isinstance(used, int) else None


class TokenFold(StatefulProcessor):
    """A reply so far and the lines that came ahead of their turn. ``[DONE]`` in its turn gives the row; ``timeout`` seconds without a line give what there is. Timers go by the watermark."""

    def __init__(self, timeout: int, first: int) -> None:
        self.timeout, self.first = timeout, first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.early = handle.getMapState("early", "seq long", "ms long, line string")
        self.parts = handle.getListState("parts", "part string")
        self.reply = handle.getValueState("reply", "next long, ended boolean, first_ms long, last_ms long, tokens long, timer long")

    def _take(self, reply: list, ms: int, line: str, parts: list) -> None:
        data = line[5:].strip() if line.startswith("data:") else ""
        if data == "[DONE]":
            reply[1] = True
        elif data and (event := _token_event(data)) is not None:
            part, used = event
            if part:
                parts.append((part,))
                reply[2] = ms if reply[2] is None else min(reply[2], ms)
            reply[3] = ms if reply[3] is None else max(reply[3], ms)
            reply[4] = used if used is not None else reply[4]

    def _row(self, key, reply: list, complete: bool) -> Row:
        text = "".join(p[0] for p in self.parts.get()) if self.parts.exists() else ""
        decode = reply[3] - reply[2] if reply[2] is not None else None
        return Row(request_id=key[0], text=text, first_token_ms=reply[2], decode_ms=decode, completion_tokens=reply[4], complete=complete)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        reply = list(self.reply.get()) if self.reply.exists() else [self.first, False, None, None, None, None]
        given, came = not reply[1], list(rows)
        ahead = {row["seq"]: (row["ms"], row["line"]) for row in came if row["seq"] >= reply[0]} if given else {}
        parts: list = []
        while not reply[1]:
            turn = reply[0]
            if turn in ahead:
                ms, line = ahead.pop(turn)
            elif self.early.containsKey((turn,)):
                ms, line = self.early.getValue((turn,))
                self.early.removeKey((turn,))
            else:
                break
            self._take(reply, ms, line, parts)
            reply[0] += 1
        if parts:
            self.parts.appendList(parts)
        if not reply[1]:
            for seq, value in ahead.items():
                self.early.updateValue((seq,), value)
        if reply[5] is not None:
            self.handle.deleteTimer(reply[5])
        reply[5] = max(reply[5] or 0, timerValues.getCurrentWatermarkInMs() + 1, *(row["arrived"] + 1000 * self.timeout for row in came))
        self.handle.registerTimer(reply[5])
        self.reply.update(tuple(reply))
        if given and reply[1]:
            yield self._row(key, reply, True)
            self.early.clear()
            self.parts.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        reply = list(self.reply.get())
        if not reply[1]:
            parts: list = []
            for _, ms, line in sorted((k[0], *v) for k, v in self.early.iterator()):
                if not reply[1]:
                    self._take(reply, ms, line, parts)
            if parts:
                self.parts.appendList(parts)
            yield self._row(key, reply, reply[1])
        self.early.clear()
        self.parts.clear()
        self.reply.clear()

    def close(self) -> None:
        pass


def token_fold(lines: DataFrame, time: str, timeout: int = 600, late: str = "10 minutes", first: int = 0) -> DataFrame:
    """``event_stream_fold`` of a stream of ``(request_id, seq, ms, line)`` with the ``time`` at which each line came, whatever their order.

    Numbers run from ``first`` without a gap; a line ahead of its turn waits until the gap is closed. A reply comes out at its ``[DONE]``, with
    ``complete`` true; without a line for ``timeout`` seconds of the watermark (``late`` behind the latest time) with what has come. Lines behind
    the end are skipped, for as long.
    """
    _keyed_state(lines.sparkSession)
    at = F.col(time).cast("timestamp").alias("at")
    rows = lines.select(F.col("request_id").cast("string").alias("request_id"), F.col("seq").cast("long").alias("seq"), F.col("ms").cast("long").alias("ms"), "line", at, F.unix_millis(at).alias("arrived"))
    rows = rows.filter("at IS NOT NULL AND seq IS NOT NULL").withWatermark("at", late)
    return rows.groupBy("request_id").transformWithState(TokenFold(timeout, first), "request_id string, text string, first_token_ms long, decode_ms long, completion_tokens long, complete boolean", "append", "EventTime")
