"""Reusable column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import constants as K


def safe_date(text: Column) -> Column:
    """Date of an ISO text; NULL for NULL, empty and malformed text."""
    return text.try_cast("date")


def names_of(structs: Column, field: str = "name") -> Column:
    """Array of one field out of an array of structs. NULL arrays become empty; NULL names stay."""
    return F.coalesce(structs[field], F.array().cast("array<string>"))


def non_empty(text: Column) -> Column:
    return F.coalesce(F.length(text) > 0, F.lit(False))


def has_text(title: Column, overview: Column) -> Column:
    """Whether a catalogue row has anything to embed."""
    return overview.isNotNull() | non_empty(title)


def like_pattern(needle: Column) -> Column:
    """Pattern of a substring match. ``%`` and ``_`` stay wildcards; a backslash is a character like any other."""
    return F.concat(F.lit("%"), F.replace(needle, F.lit("\\"), F.lit("\\\\")), F.lit("%"))


def title_like(needle: Column, *titles: Column, literal: bool = False) -> Column:
    """Case-insensitive substring match on any of ``titles``.

    ``%`` and ``_`` in the needle act as wildcards unless ``literal`` is set. A NULL title never hides a match on another.
    """
    match = F.lit(False)
    for title in titles:
        if literal:
            hit = F.contains(F.lower(title), F.lower(needle))
        else:
            hit = F.call_function("like", F.lower(title), F.lower(like_pattern(needle)))
        match = match | F.coalesce(hit, F.lit(False))
    return match


def runtime_within(runtime: Column, bound: int | None) -> Column:
    """``runtime <= bound`` rejecting NULL; no bound when it is missing, zero or negative."""
    if not bound or bound <= 0:
        return F.lit(True)
    return runtime.isNotNull() & (runtime <= int(bound))


def has_genre(genres: Column, genre: str | None) -> Column:
    """Whole-element, case-insensitive membership; the needle is trimmed, NULL and empty arrays never match."""
    if not genre:
        return F.lit(True)
    wanted = genre.strip().lower()
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.exists(genres, lambda g: F.lower(g) == wanted), F.lit(False))


def snippet(text: Column, chars: int = K.SNIPPET_CHARS) -> Column:
    """First ``chars`` characters, with ``...`` only when something was cut. NULL stays NULL."""
    return F.when(F.length(text) > chars, F.concat(F.left(text, F.lit(chars)), F.lit("..."))).otherwise(text)


def summary_snippet(text: Column) -> Column:
    return F.coalesce(snippet(text), F.lit(""))


def clamp_score(score: Column) -> Column:
    return F.greatest(F.lit(K.SCORE_MIN), F.least(F.lit(K.SCORE_MAX), score.cast("int")))


def watch_status(status: Column) -> Column:
    return F.when(status.isin(*K.WATCH_STATUSES), status).otherwise(F.lit(K.WATCH_STATUSES[0]))


def short_reason(reason: Column) -> Column:
    return F.left(F.coalesce(reason, F.lit("")), F.lit(K.REASON_CHARS))


def genres_text(genres: Column) -> Column:
    """Display form of an array; NULL and empty give the empty text."""
    return F.coalesce(F.array_join(genres, ", "), F.lit(""))


def row_json(*columns) -> Column:
    """One JSON object per row; dates and timestamps are rendered as text."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
