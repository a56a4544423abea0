"""Rows that fail to parse: valid rows typed, broken ones with the reason.

Method: on the workers, the records of each report file are written to a CSV of
their own and read by DuckDB with reject tables; the line-level errors are
joined to the raw records, and the survivors come out typed. A record with
broken quoting would swallow the records after it in a file, so such records
are told apart first (RFC 4180 as one regular expression) and never enter it.
Batches stream through ``mapInArrow``: there is no shuffle, and a file that
holds a third of all rows is just many batches.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..session import ship

# The fields of a recovery report record, its endpoints and categories.
FIELDS = (
    "source_file", "recovered_file", "league", "season", "endpoint", "resource_id", "category", "success",
    "recovery_rule", "parse_error", "source_size_bytes", "output_size_bytes",
)
ENDPOINTS = (
    "teams", "team_stats", "offensive_stats", "defensive_stats", "scoring_stats", "special_teams_stats",
    "schedule", "standings", "rosters", "games", "players", "player_stats", "stats",
)
CATEGORIES = (
    "MALFORMED_GAME_DATA", "MALFORMED_STANDINGS_DATA", "PYTHON_LITERAL", "EMPTY_PLAYER_STATS", "VALID_JSON", "UNSUPPORTED",
)

_FIELD = r'(?:[^",\r\n]*|"(?:[^"]|"")*")'
QUOTING = rf"^{_FIELD}(?:,{_FIELD})*$"
TYPED = (
    "source_file string, recovered_file string, league string, season long, endpoint string, resource_id string, category string, "
    "success boolean, recovery_rule string, parse_error string, source_size_bytes long, output_size_bytes long"
)
SCHEMA = f"line_id long, reason string, {TYPED}"


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# The first rule that a structurally sound record breaks; null for a valid record.
_RULES = f"""case
  when source_file is null or source_file = '' then 'source_file is empty'
  when season <> '' and not regexp_full_match(season, '[0-9]{{4}}') then 'season is not four digits'
  when endpoint is null or endpoint not in ({_listed(ENDPOINTS)}) then 'endpoint is unknown'
  when category is null or category not in ({_listed(CATEGORIES)}) then 'category is unknown'
  when success is null or lower(success) not in ('true', 'false') then 'success is not a boolean'
  when source_size_bytes is null or not regexp_full_match(source_size_bytes, '[0-9]+')
    or try_cast(source_size_bytes as bigint) is null then 'source_size_bytes is not a long'
  when output_size_bytes <> '' and (not regexp_full_match(output_size_bytes, '[0-9]+')
    or try_cast(output_size_bytes as bigint) is null) then 'output_size_bytes is not a long'
end"""
_CASTS = {"season": "try_cast(nullif(season, '') as bigint)", "success": "lower(success) = 'true'"} | {
    c: f"try_cast(nullif({c}, '') as bigint)" for c in ("source_size_bytes", "output_size_bytes")
}
_TEXT = [c for c in FIELDS if c not in _CASTS]


def _select_typed() -> str:
    texts = [f"coalesce({c}, '') as {c}" for c in FIELDS]
    typed = [f"case when reason is null then {_CASTS[c] if c in _CASTS else f'nullif({c}, {chr(39) * 2})'} end as {c}" for c in FIELDS]
    return (
        f"select line_id, reason, {', '.join(typed)} from (select *, {_RULES} as reason from "
        f"(select cast(line_id as bigint) as line_id, {', '.join(texts)} from loaded))"
    )


def _read_rejecting(folder: str, by_file: dict[str, list[tuple[int, str]]]) -> tuple[pa.Table, dict[int, str]]:
    """The records of each file through DuckDB: typed rows, and the structural reason of each rejected line."""
    import duckdb

    paths, longest = [], 0
    for n, records in enumerate(by_file.values()):
        paths.append(os.path.join(folder, f"{n}.csv"))
        with open(paths[-1], "w", encoding="utf-8", newline="") as out:
            for line_id, text in records:
                # the mark at the end keeps DuckDB from passing over an empty last field that is one too many
                out.write(f"{line_id},{text},~\n")
                longest = max(longest, len(text.encode()) + 32)
    names = ", ".join(f"'{c}': 'VARCHAR'" for c in ("line_id", *FIELDS, "mark"))
    with duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "temp_directory": folder}) as con:
        con.execute(
            f"create temp table loaded as select * from read_csv([{', '.join(repr(p) for p in paths)}], columns = {{{names}}}, "
            f"header = false, auto_detect = false, delim = ',', quote = '\"', escape = '\"', strict_mode = true, null_padding = false, "
            f"new_line = '\\n', max_line_size = {max(2_000_000, 2 * longest)}, parallel = false, store_rejects = true)"
        )
        typed = con.sql(_select_typed()).to_arrow_table()
        errors = con.execute("select csv_line, min_by(error_type::varchar, column_idx) from reject_errors group by line, file_id, csv_line").fetchall()
    reasons = {
        "MISSING COLUMNS": "too few fields", "TOO MANY COLUMNS": "too many fields",
        "UNQUOTED VALUE": "broken quoting", "LINE SIZE OVER MAXIMUM": "line too long", "INVALID ENCODING": "invalid encoding",
    }
    return typed, {int(line.split(",", 1)[0]): reasons.get(kind, kind.lower()) for line, kind in errors}


def _parse(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    ids, texts = batch.column("line_id"), batch.column("line_text")
    sound = pc.fill_null(pc.match_substring_regex(texts, QUOTING), False)
    rows: list[pa.Table] = []
    # (line_id may repeat in foreign tables, so the position in the batch identifies a record here)
    by_file: dict[str, list[tuple[int, str]]] = defaultdict(list)
    broken: dict[int, str] = {}
    for n, (ok, text, file) in enumerate(zip(sound.to_pylist(), texts.to_pylist(), batch.column("report_file").to_pylist())):
        if text is None or text == "":
            broken[n] = "empty record"
        elif not ok or "\x00" in text:
            broken[n] = "broken quoting"
        else:
            by_file[file or ""].append((n, text))
    if by_file:
        with tempfile.TemporaryDirectory(prefix="reject-") as folder:
            typed, rejected = _read_rejecting(folder, by_file)
        rows.append(typed)
        seen = set(typed["line_id"].to_pylist())
        broken |= rejected
        broken |= {n: "not readable" for group in by_file.values() for n, _ in group if n not in seen and n not in broken}
    if broken:
        at = list(broken)
        rows.append(pa.table({"line_id": pa.array(at, pa.int64()), "reason": pa.array([broken[n] for n in at])} | {c: pa.nulls(len(at), schema.field(c).type) for c in FIELDS}))
    table = pa.concat_tables([r.cast(schema) for r in rows])
    table = table.set_column(0, "line_id", pc.take(ids, table["line_id"]))
    return table.combine_chunks().to_batches()[0]


_ARROW = pa.schema(
    [("line_id", pa.int64()), ("reason", pa.string())]
    + [(c, pa.bool_() if c == "success" else pa.int64() if c in ("season", "source_size_bytes", "output_size_bytes") else pa.string()) for c in FIELDS]
)


def load_report_lines(lines: DataFrame) -> DataFrame:
    """One row per record of ``lines`` (line_id, report_file, line_text): its typed fields, or the reason it is broken.

    ``reason`` is null exactly for valid records; the typed fields are null for
    broken ones, and an empty field is null. A null or empty record is broken
    ("empty record"). Repeated records each come out. Other columns of
    ``lines`` are left alone, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _parse(batch, _ARROW)

    ship(lines.sparkSession)
    narrow = lines.selectExpr("cast(line_id as long) line_id", "cast(report_file as string) report_file", "cast(line_text as string) line_text")
    return narrow.mapInArrow(run, SCHEMA)
