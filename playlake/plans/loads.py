"""Whole loads: raw files to staged rows, to a star schema or to lookup tables.

Three presets give the same five tables under different rules:

``keyed``      unique songs, first row per artist with whole coordinates, users merged field by field over plays,
               one time row per play, at most one song per play, ids counted from 1
``warehouse``  distinct rows, users as of their latest line on any page, every matching
               song, repeats within a second dropped, one time row per moment of the fact,
               required columns enforced, ids counted from 0
``lake``       distinct rows, users as of their latest play, every matching song, one time
               row per play, ids unique but with gaps, output partitioned by month
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import assert_unique, enforce_required, plays, read_numbered, write_numbered
from ..schemas import (
    ARTIST,
    CONSOLIDATED_COLUMNS,
    CORRUPT,
    FAULT,
    KEYED,
    SONG,
    SONGPLAY,
    STAGING_EVENTS,
    STAGING_SONGS,
    STAR,
    TIME,
    USERS,
    Table,
)
from ..sources import (
    FAULTY,
    checked_events,
    checked_songs,
    delete_folder,
    read_event_csv,
    read_parquet,
    refuse_faults,
    with_arrival,
    with_fault,
    write_consolidated,
    write_keyed,
    write_parquet,
)
from ..workspace import at_once
from . import keyed, star


@dataclass(frozen=True)
class Preset:
    unique_songs: bool = False
    one_artist_per_id: bool = False
    whole_coordinates: bool = False
    users: str = "latest_plays"
    precision: str = "s"
    match: str = "all"
    distinct_fact: bool = False
    distinct_time: bool = False
    time_of_fact: bool = False
    weekday: str = "sun0"
    key_mode: str = "dense"
    key_start: int = 0
    enforce: bool = False
    by_month: bool = False
    pattern: str | None = None


PRESETS = {
    "keyed": Preset(
        unique_songs=True,
        one_artist_per_id=True,
        whole_coordinates=True,
        users="upsert",
        precision="ms",
        match="first",
        weekday="mon0",
        key_start=1,
        pattern="*.json",
    ),
    "warehouse": Preset(
        users="latest_lines",
        distinct_fact=True,
        distinct_time=True,
        time_of_fact=True,
        enforce=True,
    ),
    "lake": Preset(weekday="sun1", key_mode="sparse", by_month=True),
}


def _checked(rows: DataFrame, schema: T.StructType, name: str, out: str, bad: str) -> DataFrame:
    """Rows with their faults, stored below ``out`` without the faulty ones.

    ``bad='fail'``: the first faulty row fails the load. ``bad='quarantine'``: faulty rows go to
    ``out/quarantine/name`` with the reason, the malformed line and the rest of the row.
    """
    if bad not in ("fail", "quarantine"):
        raise ValueError(f"bad must be 'fail' or 'quarantine', not {bad!r}")
    spark, path = rows.sparkSession, f"{out}/{name}"
    if bad == "fail":
        write_parquet(refuse_faults(rows), path)
        return read_parquet(spark, path, schema)
    write_parquet(rows, path)
    stored = read_parquet(spark, path, rows.schema)
    faulty = stored.filter(F.col(FAULT).isNotNull())
    row = F.to_json(F.struct(*schema.fieldNames())).alias("row")
    write_parquet(faulty.select(*FAULTY, row), f"{out}/quarantine/{name}")
    return stored.filter(F.col(FAULT).isNull()).select(schema.fieldNames())


def stage(
    spark: SparkSession,
    song_paths: str | Sequence[str],
    log_paths: str | Sequence[str],
    out: str,
    *,
    pattern: str | None = None,
    bad: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Parse the raw files once into typed Parquet below ``out``; (events, songs).

    Every file below the paths is read, or those whose name matches ``pattern``. Malformed lines
    and rows without a required column fail the load, or are set aside (see ``_checked``).
    """
    events = checked_events(spark, log_paths, pattern=pattern)
    songs = checked_songs(spark, song_paths, pattern=pattern)
    return tuple(at_once(
        partial(_checked, events, STAGING_EVENTS.schema, STAGING_EVENTS.name, out, bad),
        partial(_checked, songs, STAGING_SONGS.schema, STAGING_SONGS.name, out, bad),
    ))


def _users(log: DataFrame, preset: Preset) -> DataFrame:
    if preset.users == "upsert":
        return star.users_upsert(plays(log))
    if preset.users == "latest_lines":
        return star.users_latest(log, precision="s")
    return star.users_latest(plays(log), precision="ms")


def load_catalog(catalog: DataFrame, preset: str = "warehouse") -> dict[str, DataFrame]:
    """The song and artist tables of a preset, lazily."""
    rules = PRESETS[preset]
    return {
        SONG.name: star.songs(catalog, dedupe=not rules.unique_songs),
        ARTIST.name: star.artists(
            catalog, one_per_id=rules.one_artist_per_id, whole_coordinates=rules.whole_coordinates
        ),
    }


def load_activity(
    log: DataFrame, catalog: DataFrame, preset: str = "warehouse"
) -> dict[str, DataFrame]:
    """The users and time tables and the fact of a preset, the fact still without its key."""
    rules = PRESETS[preset]
    fact = star.songplays(
        log,
        catalog,
        match=rules.match,
        dedupe=rules.distinct_fact,
        precision=rules.precision,
    )
    moments = fact if rules.time_of_fact else star.log_times(plays(log), precision=rules.precision)
    return {
        USERS.name: _users(log, rules),
        SONGPLAY.name: fact,
        TIME.name: star.time_dimension(
            moments, distinct=rules.distinct_time, style=rules.weekday
        ),
    }


def _unnumbered(log: DataFrame, catalog: DataFrame, preset: str) -> dict[str, DataFrame]:
    tables = {**load_catalog(catalog, preset), **load_activity(log, catalog, preset)}
    if PRESETS[preset].enforce:
        tables = {t.name: enforce_required(tables[t.name], t.required) for t in STAR}
    return tables


def _numbered(fact: DataFrame, rules: Preset, scratch: str | None = None) -> DataFrame:
    return star.keyed_songplays(fact, rules.key_mode, start=rules.key_start, scratch=scratch)


def build_star(
    log: DataFrame, catalog: DataFrame, preset: str = "warehouse"
) -> dict[str, DataFrame]:
    """All five tables of a preset. Numbering the fact densely stores it, which runs a job."""
    tables = _unnumbered(log, catalog, preset)
    tables[SONGPLAY.name] = _numbered(tables[SONGPLAY.name], PRESETS[preset])
    return tables


def _partitions(table: Table, rules: Preset, by_id: bool | str) -> list[str]:
    if not rules.by_month:
        return []
    if table in (TIME, SONGPLAY):
        return ["year", "month"]
    if by_id and table == SONG:
        return ["year"] if by_id == "sorted" else ["year", "artist_id"]
    if by_id is True and table == USERS:
        return ["user_id"]
    return []


def _sorted_by(table: Table, rules: Preset, by_id: bool | str) -> list[str]:
    if not rules.by_month or by_id != "sorted":
        return []
    return {SONG.name: ["artist_id"], USERS.name: ["user_id"]}.get(table.name, [])


def _month_columns(table: Table) -> T.StructType:
    return T.StructType([
        *table.schema.fields,
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ])


def load_star(
    spark: SparkSession,
    song_paths: str | Sequence[str],
    log_paths: str | Sequence[str],
    out: str,
    preset: str = "warehouse",
    *,
    by_id: bool | str = False,
    pattern: str | None = None,
    bad: str = "fail",
    ids: str = "written",
) -> dict[str, DataFrame]:
    """Raw files to the five tables of a preset, written below ``out`` and read back.

    Each raw file is parsed once; a time table taken from the fact reads the written fact.
    All files below the paths are read, with the ``keyed`` preset those named ``*.json``;
    ``pattern`` names others. ``bad`` says what becomes of rows that can't be loaded (``stage``).
    ``by_id`` lays the lake's songs out by year and artist and its users by id. ``"sorted"``: songs in a
    folder per year in the order of their artists, users in the order of their ids, so that scans skip
    files by them. ``True``: one folder per value, to be used for few values only.

    Song play ids without gaps take a second write of the fact, unless ``ids="read"``: then the rows
    carry their place and get the id as they are read (``operators.read_numbered`` of ``out/songplay``).
    """
    if ids not in ("written", "read"):
        raise ValueError(f"ids must be 'written' or 'read', not {ids!r}")
    rules = PRESETS[preset]
    log, catalog = stage(
        spark, song_paths, log_paths, out, pattern=pattern or rules.pattern, bad=bad
    )
    tables = _unnumbered(log, catalog, preset)
    if rules.unique_songs:
        assert_unique(tables[SONG.name], SONG.key)
    scratch = f"{out}/_scratch"

    def write(table: Table) -> tuple[str, DataFrame]:
        rows, schema, path = tables[table.name], table.schema, f"{out}/{table.name}"
        if table == SONGPLAY and ids == "read" and rules.key_mode == "dense":
            plain = T.StructType(schema.fields[1:])
            write_numbered(rows.select(plain.fieldNames()), path)
            return table.name, read_numbered(spark, path, schema.fieldNames()[0], plain, rules.key_start)
        if table == SONGPLAY:
            # a folder of its own: a load that died may have left one
            rows = _numbered(rows, rules, f"{scratch}/{uuid.uuid4().hex}")
            if rules.by_month:
                rows, schema = star.with_year_month(rows), _month_columns(table)
        write_parquet(
            rows,
            path,
            partition_by=_partitions(table, rules, by_id),
            sort_by=_sorted_by(table, rules, by_id),
        )
        return table.name, read_parquet(spark, path, schema)

    first = [SONG, ARTIST, USERS, SONGPLAY, *([] if rules.time_of_fact else [TIME])]
    written = dict(at_once(*(partial(write, table) for table in first)))
    delete_folder(spark, scratch)
    if rules.time_of_fact:
        tables[TIME.name] = star.time_dimension(
            written[SONGPLAY.name], distinct=rules.distinct_time, style=rules.weekday
        )
        written.update([write(TIME)])
    return written


def load_lookup_tables(
    spark: SparkSession,
    csv_paths: str | Sequence[str],
    out: str,
    *,
    pattern: str | None = None,
    multiline: bool = False,
    bad: str = "fail",
) -> dict[str, DataFrame]:
    """Event CSV files to the consolidated file set and the three lookup tables.

    Every file below the paths is read, or those whose name matches ``pattern``. Rows that name an
    artist need a title and whole numbers as ids; ``bad`` says what becomes of others and of
    malformed lines, which include records with a line break inside unless ``multiline``.

    Where a key is written more than once the last row wins: by file, then by line. The
    files are parsed once, into Parquet that also keeps the place of each line; the
    consolidated CSV itself has no column for it.
    """
    raw = with_arrival(
        read_event_csv(spark, csv_paths, pattern=pattern, multiline=multiline, keep_corrupt=True)
    )
    wanted = raw.filter((F.col("artist") != "") | F.col(CORRUPT).isNotNull())
    checked = with_fault(wanted, ["song"], ["sessionId", "itemInSession", "userId"])
    rows = checked.select(*CONSOLIDATED_COLUMNS, "arrival", *FAULTY)
    schema = rows.drop(*FAULTY).schema
    events = _checked(rows, schema, "staging", out, bad)
    write_consolidated(events, f"{out}/events")
    builders = (keyed.session_library, keyed.user_activity, keyed.song_library)

    def write(table: Table, build: Callable) -> tuple[str, DataFrame]:
        path = f"{out}/{table.name}"
        rows = build(events, ["arrival.file", "arrival.block", "arrival.row"])
        write_keyed(rows, table, path, bloom=table.partition_key)
        return table.name, read_parquet(spark, path, table.schema)

    pairs = zip(KEYED, builders, strict=True)
    return dict(at_once(*(partial(write, table, build) for table, build in pairs)))
