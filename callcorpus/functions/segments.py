"""Segment extraction from chat text and teacher replies."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col_of, py_strip

# Chat-template markers.
ASSISTANT_MARK = "<|im_start|>assistant\n"
USER_MARK = "<|im_start|>user\n"
END_MARK = "<|im_end|>"
# Code fences removed from teacher replies.
FENCE = "```"
JSON_FENCE = "```json"


def last_assistant_segment(c: Column | str) -> Column:
    """Text after the *last* assistant marker, cut at the first end marker, stripped.

    Without the marker the whole text is kept (and not cut)."""
    t = col_of(c)
    after = F.substring_index(t, ASSISTANT_MARK, -1)
    cut = F.substring_index(after, END_MARK, 1)
    return py_strip(F.when(F.instr(t, ASSISTANT_MARK) > 0, cut).otherwise(t))


def between_first(c: Column | str, marker: str, end: str = END_MARK) -> Column:
    """``t.split(marker)[1].split(end)[0]``; NULL when the marker is missing
    (the reference raises)."""
    t = col_of(c)
    part = F.substring_index(F.substring_index(t, marker, 2), marker, -1)
    return F.when(F.instr(t, marker) > 0, F.substring_index(part, end, 1))


def first_user_segment(c: Column | str) -> Column:
    return between_first(c, USER_MARK)


def strip_fences(c: Column | str) -> Column:
    """Trimmed content; a leading json-tagged fence removes every json-tagged fence and
    every bare fence; a leading bare fence removes every bare fence; trimmed again."""
    t = py_strip(col_of(c))
    fence, tagged = FENCE, JSON_FENCE
    return (
        F.when(t.startswith(tagged), py_strip(F.replace(F.replace(t, F.lit(tagged), F.lit("")), F.lit(fence), F.lit(""))))
        .when(t.startswith(fence), py_strip(F.replace(t, F.lit(fence), F.lit(""))))
        .otherwise(t)
    )


def chat_response_content(body: Column | str) -> Column:
    """struct(status, content) of an OpenAI-style chat response body."""
    b = col_of(body)
    has_error = F.coalesce(F.array_contains(F.json_object_keys(b), "error"), F.lit(False))
    content = F.get_json_object(b, "$.choices[0].message.content")
    n_choices = F.json_array_length(F.get_json_object(b, "$.choices"))
    status = F.when(has_error, F.lit("error")).when(F.coalesce(n_choices, F.lit(0)) > 0, F.lit("ok")).otherwise(F.lit("unexpected"))
    return F.struct(
        status.alias("status"),
        F.when(has_error, F.get_json_object(b, "$.error")).when(status == "ok", F.coalesce(content, F.lit(""))).alias("content"),
    )
