"""One-pass routing: label rows by rule instead of uniting one filtered scan per label."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..rules import (
    Track,
    answer_tracks,
    grocery_tracks,
    office_tracks,
    pets_tracks,
    queue_tracks,
    reject_source_tracks,
    segment_tracks,
)
from ..schema import quoted


def _sql(label: str | int | None) -> str:
    if label is None:
        return "NULL"
    if isinstance(label, int):
        return str(label)
    return "'" + label.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _first_hit(track: Track, names: list[str]) -> Column:
    """Labels of the track's first rule that holds, as a struct; null when none does."""
    def labels(rule):
        fields = [f"{_sql(rule.labels[n])} AS {quoted(n)}" for n in names]
        return F.expr(f"struct({', '.join(fields)})")
    head, *rest = track
    return reduce(lambda case, rule: case.when(rule.when, labels(rule)), rest,
                  F.when(head.when, labels(head)))


def route(df: DataFrame, tracks: list[Track]) -> DataFrame:
    """Each row once per track with a hit, plus the labels of that hit.

    Labels replace columns of the same name. A row no track hits is dropped.
    """
    names = list(tracks[0][0].labels)
    for track in tracks:
        for rule in track:
            if set(rule.labels) != set(names):
                raise ValueError(f"labels {sorted(rule.labels)} differ from {sorted(names)}")
    kept = [c for c in df.columns if c not in names]
    hits = [_first_hit(track, names) for track in tracks]
    if len(hits) == 1:
        return (df.select(*kept, hits[0].alias("_hit")).where("_hit IS NOT NULL")
                .select(*kept, "_hit.*"))
    # A step of its own compiles the rules; within the generator they would be interpreted.
    return (df.select(*kept, F.array(*hits).alias("_hits"))
            .select(*kept, F.inline(F.array_compact("_hits"))))


def route_segment(df: DataFrame) -> DataFrame:
    return route(df, segment_tracks())


def route_reject_source(df: DataFrame) -> DataFrame:
    return route(df, reject_source_tracks())


def route_pets(df: DataFrame) -> DataFrame:
    return route(df, pets_tracks())


def route_grocery(df: DataFrame) -> DataFrame:
    return route(df, grocery_tracks())


def route_office(df: DataFrame) -> DataFrame:
    return route(df, office_tracks())


def route_reviews(df: DataFrame) -> DataFrame:
    """Type by answer, then segment by queue."""
    return route(route(df, answer_tracks()), queue_tracks())
