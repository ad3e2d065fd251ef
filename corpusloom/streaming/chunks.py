"""Chunked responses: splitting reasoning from content, collecting call fragments, holding back
incomplete characters. The functions take a batch or a streaming DataFrame alike unless noted."""

from __future__ import annotations

import codecs
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.functions import fixed
from corpusloom.functions.bind import let
from corpusloom.functions.text import after_first, before_first, lstrip_newlines
from corpusloom.operators.responses import call_spans, parse_response


def _ordered(piece: str, *order: str) -> Column:
    """Aggregate: pieces of a group joined in order."""
    listed = F.sort_array(F.collect_list(F.struct(*[F.col(o) for o in order], F.col(piece).alias("piece"))))
    return F.array_join(F.transform(listed, lambda x: x["piece"]), "")


def split_text(text: Column, thinking: bool = True) -> Column:
    """(reasoning, content, calls, finish_reason) of the text received so far.

    With ``thinking`` everything up to the close tag is reasoning and newlines right behind
    the tag are dropped; without it all text is content.
    """
    parsed = parse_response(text)
    closed = F.contains(text, F.lit(fixed.THINK_CLOSE))
    if thinking:
        reasoning = before_first(text, fixed.THINK_CLOSE)
        content = F.when(closed, lstrip_newlines(after_first(text, fixed.THINK_CLOSE))).otherwise(F.lit(""))
    else:
        reasoning, content = F.lit(""), text
    return let(
        parsed,
        lambda p: F.struct(
            reasoning.alias("reasoning"),
            content.alias("content"),
            p["calls"].alias("calls"),
            p["finish_reason"].alias("finish_reason"),
        ),
    )


def split_responses(chunks: DataFrame, thinking: bool = True) -> DataFrame:
    """One row per request from (request_id, seq, chunk), for chunks in any order.

    On a stream, use complete or update output mode. A response is bounded by the generation
    limit and is itself one output row.
    """
    whole = chunks.groupBy("request_id").agg(_ordered("chunk", "seq").alias("text"))
    return whole.select("request_id", "text", split_text(F.col("text"), thinking).alias("s")).select(
        "request_id", "text", "s.*"
    )


def join_call_fragments(fragments: DataFrame) -> DataFrame:
    """Tool calls from fragments (request_id, call_index, seq, id, name, arguments): each field is
    the fragments' text in order."""
    return fragments.groupBy("request_id", "call_index").agg(
        *[_ordered(c, "seq").alias(c) for c in ("id", "name", "arguments")]
    )


DELTA_SCHEMA = "request_id bigint, part int, kind string, text string"
STATE_SCHEMA = (
    "next_seq bigint, done boolean, held string, parts int, trimming boolean, waiting string, calls string"
)


def _held_tail(text: str) -> int:
    """Length of the longest suffix that could be the start of the close tag."""
    close = fixed.THINK_CLOSE
    return next((n for n in range(min(len(text), len(close) - 1), 0, -1) if close.startswith(text[-n:])), 0)


FINISHED = -1  # in place of the next sequence number


def stream_deltas(chunks: DataFrame, thinking: bool = True, at: str | None = None, idle_ms: int = 600_000) -> DataFrame:
    """Deltas of each response as soon as they are certain: (request_id, part, kind, text, calls,
    finish_reason), ``kind`` being reasoning, content or finish.

    Streaming only. Chunks are taken in sequence order; one that arrives early waits in the
    state until the gap closes. A null chunk ends the response: what is held back is given out,
    and a finish row tells the tool calls and the reason. A chunk that comes again, or after the end, changes
    nothing. Of a finished request a mark stays, so that late chunks don't open it anew. With ``at``, the event
    time column that has the watermark of ``chunks``, the mark goes when the watermark is ``idle_ms`` past the request's last
    chunk, and a request left open that long is ended the same way. While thinking, a tail that may be the start of the close tag is
    held back, so a tag cut across chunks is never shown as reasoning. The state per request
    is that tail, early chunks and the text from the first call tag on, not the response.
    """

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        next_seq, done, held, parts, trimming, waiting, calls = (
            state.get if state.exists else (0, not thinking, "", 0, False, "{}", "")
        )

        def expire() -> None:
            if at is not None:
                state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), *seen_ms, 0) + idle_ms)

        seen_ms: list[int] = []

        if next_seq == FINISHED:
            if state.hasTimedOut:
                state.remove()
            return
        early = {int(k): v for k, v in json.loads(waiting).items()}
        if state.hasTimedOut:  # what is missing won't come: the chunks behind the gap are let go
            early = {next_seq: None}
        else:
            for frame in frames:
                seen_ms += [int(frame[at].max().timestamp() * 1000)] if at else []
                for seq, chunk in zip(frame["seq"].astype(int), frame["chunk"].where(frame["chunk"].notna(), None)):
                    if seq >= next_seq:
                        early[seq] = chunk
        deltas = {"reasoning": "", "content": ""}
        ended = False
        while next_seq in early and not ended:
            chunk = early.pop(next_seq)
            ended = chunk is None
            text, held, next_seq = held + (chunk or ""), "", next_seq + 1
            if not done:
                before, tag, after = text.partition(fixed.THINK_CLOSE)
                if not tag:
                    keep = 0 if ended else _held_tail(text)
                    held = text[len(text) - keep :]
                    shown = text[: len(text) - keep]
                    deltas["reasoning"] += shown
                    calls += shown
                    continue
                deltas["reasoning"] += before
                done, trimming, text, calls = True, True, after, ""
            if trimming:
                text = text.lstrip("\n")
                trimming = not text
            deltas["content"] += text
            calls += text
        rows = [(kind, text) for kind, text in deltas.items() if text]
        # Keep the text from the first call tag on, or a tail that may be the start of one. Calls
        # inside closed thinking do not count, so the close tag starts over.
        opened = calls.find(fixed.CALL_OPEN)
        calls = calls[opened:] if opened >= 0 else calls[-(len(fixed.CALL_OPEN) - 1) :]
        if ended:
            rows.append(("finish", calls))
            if state.hasTimedOut:
                state.remove()
            else:
                state.update((FINISHED, True, "", 0, False, "{}", ""))
                expire()
        else:
            state.update((next_seq, done, held, parts + len(rows), trimming, json.dumps(early), calls))
            expire()
        if rows:
            yield pd.DataFrame(
                [(key[0], parts + i, kind, text) for i, (kind, text) in enumerate(rows)],
                columns=["request_id", "part", "kind", "text"],
            )

    limit = GroupStateTimeout.NoTimeout if at is None else GroupStateTimeout.EventTimeTimeout
    deltas = chunks.groupBy("request_id").applyInPandasWithState(
        update, DELTA_SCHEMA, STATE_SCHEMA, "append", limit
    )
    ending = F.col("kind") == "finish"
    calls = let(call_spans(F.col("text")), lambda c: F.when(F.size(c) > 0, c))
    return deltas.withColumn("calls", F.when(ending, calls)).select(
        "request_id",
        "part",
        "kind",
        F.when(~ending, F.col("text")).alias("text"),
        "calls",
        F.when(ending & F.col("calls").isNotNull(), F.lit("tool_calls")).when(ending, F.lit("stop")).alias("finish_reason"),
    )


def showable_prefix(pieces: Column) -> Column:
    """Longest leading part of a byte string (binary column) that is whole UTF-8.

    Everything behind it waits for more bytes. At most three bytes are held back.
    """
    n = F.length(pieces)
    candidates = F.array(*[F.substring(pieces, F.lit(1), n - k) for k in range(4)])
    valid = F.filter(candidates, lambda c: F.is_valid_utf8(c.cast("string")))
    return F.coalesce(F.get(valid, F.lit(0)), F.substring(pieces, 1, 0))


ORDERED_STATE = "next_seq bigint, waiting string, memo string"


def in_order(
    chunks: DataFrame, key: str, fields: list[str], schema: str, take: Callable[[dict, int, list | None], list[tuple]], at: str | None = None, idle_ms: int = 600_000
) -> DataFrame:
    """Rows (``key``, …``schema``) that ``take`` makes of each request's chunks (``key``, seq, …``fields``), one by one in sequence order.

    Streaming only. ``take(memo, seq, item)`` gets the request's memory (a dict of JSON values that it may change), and the fields as a list, binary
    ones as bytes; None when the request ends, which a chunk whose fields are all null says. A chunk that comes early waits in the state, one that
    comes again or after the end changes nothing. With ``at``, the event time column under the watermark of ``chunks``, a request that is silent until the
    watermark is ``idle_ms`` past its last chunk is ended without what is missing, and the mark of an ended one goes.
    """
    names = [key, *[f.split()[0] for f in schema.split(",")]]

    def pack(item: list) -> list:
        return [{"b": bytes(v).hex()} if isinstance(v, (bytes, bytearray)) else v for v in item]

    def unpack(item: list) -> list:
        return [bytes.fromhex(v["b"]) if isinstance(v, dict) else v for v in item]

    def plain(value):
        """A pandas value as a Python one."""
        if value is None or (not isinstance(value, (bytes, bytearray, str)) and pd.isna(value)):
            return None
        return value.item() if hasattr(value, "item") else value

    def update(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        next_seq, waiting, memo = state.get if state.exists else (0, "{}", "{}")
        if next_seq == FINISHED:
            if state.hasTimedOut:
                state.remove()
            return
        early, memo, seen_ms, rows, ended = json.loads(waiting), json.loads(memo), [], [], state.hasTimedOut
        for frame in () if ended else frames:
            seen_ms += [int(frame[at].max().timestamp() * 1000)] if at else []
            for seq, *item in zip(frame["seq"].astype(int), *[frame[f] for f in fields]):
                if seq >= next_seq:
                    early.setdefault(str(seq), pack([plain(v) for v in item]))
        while not ended and str(next_seq) in early:
            item = unpack(early.pop(str(next_seq)))
            ended = all(v is None for v in item)
            if not ended:
                rows += take(memo, next_seq, item)
                next_seq += 1
        if ended:
            rows += take(memo, next_seq, None)
        if state.hasTimedOut:
            state.remove()
        else:
            state.update((FINISHED, "{}", "{}") if ended else (next_seq, json.dumps(early), json.dumps(memo)))
            if at is not None:
                state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), *seen_ms, 0) + idle_ms)
        if rows:
            yield pd.DataFrame([(*group, *r) for r in rows], columns=names)

    limit = GroupStateTimeout.NoTimeout if at is None else GroupStateTimeout.EventTimeTimeout
    kind = chunks.schema[key].dataType.simpleString()
    return chunks.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, {schema}", ORDERED_STATE, "append", limit)


def stream_call_fragments(fragments: DataFrame, at: str | None = None, idle_ms: int = 600_000) -> DataFrame:
    """``join_call_fragments`` on a stream of fragments (request_id, seq, call_index, id, name, arguments), ``seq`` counting through the request.

    The calls of a request come out when it ends; see ``in_order`` for ends, repeats and late fragments. A fragment
    without call index begins a new call. The state is the calls so far.
    """

    def take(memo: dict, seq: int, item: list | None) -> list[tuple]:
        calls = memo.setdefault("calls", {})
        if item is None:
            return [(int(i), *parts) for i, parts in sorted(calls.items(), key=lambda c: int(c[0]))]
        index, *parts = item
        index = max(map(int, calls), default=-1) + 1 if index is None else int(index)
        call = calls.setdefault(str(index), ["", "", ""])
        calls[str(index)] = [old + (new or "") for old, new in zip(call, parts)]
        return []

    schema = "call_index bigint, id string, name string, arguments string"
    return in_order(fragments, "request_id", ["call_index", "id", "name", "arguments"], schema, take, at, idle_ms)


def stream_characters(pieces: DataFrame, at: str | None = None, idle_ms: int = 600_000) -> DataFrame:
    """(request_id, seq, text, shown) from byte pieces (request_id, seq, piece): the whole characters each piece completes, and how many
    the request has so far.

    Every byte is read once; the state holds the bytes of a character begun, three at most. Bytes that can't be part of a character become replacement
    characters, and so does a character cut off by the request's end.
    """

    def take(memo: dict, seq: int, item: list | None) -> list[tuple]:
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        decoder.setstate((bytes.fromhex(memo.get("held", "")), 0))
        text = decoder.decode(b"" if item is None else item[0], item is None)
        memo["held"], memo["shown"] = decoder.getstate()[0].hex(), memo.get("shown", 0) + len(text)
        return [(seq, text, memo["shown"])] if item is not None or text else []

    return in_order(pieces, "request_id", ["piece"], "seq bigint, text string, shown bigint", take, at, idle_ms)
