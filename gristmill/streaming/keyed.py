"""Streams whose state lives per key in Spark's state store and expires."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

FINISHED = "request_id bigint, finish string, text string, tokens bigint"
OPEN = "closed boolean, tokens string"


def _finished(key, finish: str, tokens: dict[int, str], end: int | None) -> pd.DataFrame:
    texts = [text for seq, text in sorted(tokens.items()) if end is None or seq < end]
    return pd.DataFrame({"request_id": [key[0]], "finish": [finish], "text": ["".join(texts)], "tokens": [len(texts)]})


def assembled_requests(events: DataFrame, time: str | None = None, patience: int = 3_600_000) -> DataFrame:
    """Text, token count and ending of each request of a stream `(request_id, seq, kind, text)`, once it has ended.

    An open request holds its tokens by number, a finished one only a mark, so that events after its end open
    nothing. Tokens after the end are ignored, a token sent again counts once, null text is empty, rows without a
    number say nothing. `time` names a watermarked event-time column: a request leaves the state when the watermark
    is `patience` milliseconds past its last event, and if it was open it is given out with the ending `timeout`
    and what it has. Without `time` nothing expires. A batch changes the state of its own requests only.
    """
    def step(key, parts, state: GroupState):
        closed, held = state.get if state.exists else (False, "{}")
        tokens = {int(seq): text for seq, text in json.loads(held).items()}
        if state.hasTimedOut:
            state.remove()
            if not closed:
                yield _finished(key, "timeout", tokens, None)
            return
        end, latest = None, None
        for part in parts:
            if time and part["at"].notna().any():
                latest = max(int(part["at"].max()), latest or 0)
            for seq, kind, text in part.loc[part["seq"].notna(), ["seq", "kind", "text"]].itertuples(index=False):
                if kind == "token":
                    tokens.setdefault(int(seq), text or "")
                elif kind in ("complete", "error"):
                    end = min(end or (int(seq), kind), (int(seq), kind))
        if end and not closed:
            yield _finished(key, end[1], tokens, end[0])
        closed = closed or end is not None
        state.update((closed, "{}" if closed else json.dumps(tokens)))
        if time:
            watermark = state.getCurrentWatermarkMs()
            state.setTimeoutTimestamp(max((latest or watermark) + patience, watermark + 1))

    at = [F.col(time), F.unix_millis(F.col(time).cast("timestamp")).alias("at")] if time else []
    rows = events.select("request_id", "seq", "kind", "text", *at)
    return rows.groupBy("request_id").applyInPandasWithState(
        step, FINISHED, OPEN, "append", GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.NoTimeout
    )
