"""Answers of describing models and services: labels, JSON in fences, quota messages, motion phrases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and limits of a motion phrase, and what answers and messages are read by.
STILL, IN_PLACE, CAMERA, SUBJECT = "gần như tĩnh", "chuyển động tại chỗ", "camera lia sang", "chủ thể/vật di chuyển sang"
LEFT, RIGHT, UP, DOWN = "trái", "phải", "lên", "xuống"
LIGHT, MEDIUM, STRONG = "nhẹ", "vừa", "mạnh"
NO_TEXT = "(không có)"
ERROR_CODES = ("429", "503", "500", "403", "401", "400")
SEQUENCE_WORDS = ("ban đầu", "lúc đầu", "đầu tiên", "rồi ", "sau đó", "tiếp theo", "tiếp đó", "cuối cùng", "trước khi", "sau khi", "khi đó", "dần dần", "liền ", "ngay sau", "đang.{0,30}thì")
ERROR_OPENINGS = ("[lỗi", "[hết quota")
LABEL_LINE = r"^\s*[\-*•]?\s*(\d{1,2})\s*[|.):\-]\s*(.+?)\s*$"
DAILY_MARKS, DAILY_LIMIT, DAILY_RETRY = ("perday", "per day", "per_day"), 1000, 300
PERSON_WORDS = ("người", "đàn ông", "phụ nữ", "cô gái", "chàng trai", "cụ ông", "cụ bà")


def is_error_text(text: Column) -> Column:
    """Null, blank or beginning with a bracket, as failed answers do."""
    return F.coalesce(text.rlike(r"^\s*(\[|\z)"), F.lit(True))


def stripped(text: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def label_slots(raw: Column, n: Column) -> Column:
    """The n labels of a model's answer, '' where it has none.

    A line "k | text", "k. text", "k) text", "k: text" or "k - text", also with a bullet before it, fills slot k if that
    is 1..n and still empty. If no line is numbered, lines fill slots in order. A null or blank answer, and one that opens
    like an error, leaves all slots empty; another answer in brackets is text.
    """
    pattern = LABEL_LINE
    lines = F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), stripped), lambda x: x != "")
    numbered = F.filter(lines, lambda x: x.rlike(pattern))
    slots = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))

    def of(k: Column) -> Column:
        mine = F.filter(numbered, lambda x: F.regexp_extract(x, pattern, 1).try_cast("int") == k)
        return F.coalesce(F.regexp_extract(F.get(mine, F.lit(0)), pattern, 2), F.lit(""))

    by_number = F.transform(slots, of)
    in_order = F.transform(slots, lambda k: F.coalesce(F.get(lines, k - 1), F.lit("")))
    empty = F.transform(slots, lambda k: F.lit(""))
    failed = F.coalesce(stripped(raw).rlike("^(?:" + "|".join(x.replace("[", r"\[") for x in ERROR_OPENINGS) + ")"), F.lit(True))
    out = F.when(failed, empty).when(F.size(numbered) > 0, by_number).otherwise(in_order)
    return F.when(n < 1, F.array().cast("array<string>")).otherwise(out)


def fenced_query(raw: Column) -> Column:
    """Struct of query, distinct (clamped to 0..5) and note from the first { to the last } of an answer; null without a query."""
    body = F.regexp_extract(raw, r"(?s)(\{.*\})", 1)
    got = F.from_json(body, "query string, distinct int, note string")
    clamped = F.least(F.greatest(F.coalesce(got["distinct"], F.lit(0)), F.lit(0)), F.lit(5))
    return F.when(F.trim(got["query"]) != "", F.struct(F.trim(got["query"]).alias("query"), clamped.alias("distinct"), F.coalesce(got["note"], F.lit("")).alias("note")))


def quota_message(message: Column) -> Column:
    """Struct of retry_seconds, metric (the last part of its path, or "unknown"), limit and daily of a service's quota
    message. daily says that the quota is one of a day: by its words, by a limit of a thousand, or by a long wait."""
    retry = F.regexp_extract(message, r"retry in ([0-9.]+)s", 1).try_cast("double")
    path = F.regexp_extract(message, r"metric:\s*([^\s,]+)", 1)
    metric = F.when(path == "", "unknown").otherwise(F.substring_index(path, "/", -1))
    limit = F.regexp_extract(message, r"limit:\s*([0-9]+)", 1).try_cast("int")
    daily = F.lower(message).rlike("|".join(DAILY_MARKS)) | F.coalesce(limit >= DAILY_LIMIT, F.lit(False)) | F.coalesce(retry > DAILY_RETRY, F.lit(False))
    return F.struct(retry.alias("retry_seconds"), metric.alias("metric"), limit.alias("limit"), daily.alias("daily"))


def error_kind(kind: Column, message: Column) -> Column:
    """The error's type and, after a slash, the first known status code that its first 200 characters have."""
    head = F.substring(message, 1, 200)
    code = F.coalesce(*[F.when(head.contains(c), F.lit(c)) for c in ERROR_CODES])
    return F.concat(kind, F.coalesce(F.concat(F.lit("/"), code), F.lit("")))


def level(mag: Column) -> Column:
    return F.when(mag > 1.6, STRONG).when(mag > 0.8, MEDIUM).otherwise(LIGHT)


def motion_phrase(dx: Column, dy: Column, mag: Column, coherence: Column, still: float = 0.5) -> Column:
    """A motion in words. An axis counts if it moves by 0.1 and by 0.6 of the other; y grows downwards. A coherent flow
    is the camera's, which moves against it."""
    ax, ay = F.abs(dx), F.abs(dy)
    across, along = (ax >= 0.1) & (ax >= 0.6 * ay), (ay >= 0.1) & (ay >= 0.6 * ax)

    def way(flip: bool) -> Column:
        x = F.when(across, F.when((dx > 0) != F.lit(flip), RIGHT).otherwise(LEFT))
        y = F.when(along, F.when((dy > 0) != F.lit(flip), DOWN).otherwise(UP))
        return F.concat_ws("/", x, y)

    strength = F.concat(F.lit(" ("), level(mag), F.lit(")"))
    moved = F.when(coherence > 0.5, F.concat(F.lit(CAMERA + " "), way(True))).otherwise(F.concat(F.lit(SUBJECT + " "), way(False)))
    return F.when(mag < still, STILL).when(~(across | along), F.concat(F.lit(IN_PLACE), strength)).otherwise(F.concat(moved, strength))


def split_caption(text: Column, strip: Callable[[Column], Column] = F.trim) -> Column:
    """Struct of caption and seen: what a last line "TEXT:" lists, '' for none."""
    seen = strip(F.regexp_extract(text, r"(?s)\nTEXT:(.*)$", 1))
    return F.struct(strip(F.regexp_replace(text, r"(?s)\nTEXT:.*$", "")).alias("caption"), F.when(seen == NO_TEXT, "").otherwise(seen).alias("seen"))


def has_any(text: Column, words: tuple[str, ...]) -> Column:
    return F.lower(text).rlike("|".join(words))


def word_count(text: Column) -> Column:
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))


def prompt(n: Column, hint: Column, memory: Column) -> Column:
    """A labelling prompt for n pictures with what is known of the motion and of the scene so far."""
    parts = [F.format_string("Label %d pictures, one line each.", n), F.when(hint != "", F.concat(F.lit("Motion: "), hint)), F.when(memory != "", F.concat(F.lit("Before: "), memory))]
    return F.concat_ws("\n", *parts)
