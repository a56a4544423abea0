"""SQL for the queries of this subpackage that SQL can express."""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160)"
_TOKENS = "'', '-', 'NULL', 'null', 'None', 'Not Reported', 'N/A', 'NR'"


def _value(column: str) -> str:
    return f"case when trim({column}, {_BLANKS}) not in ({_TOKENS}) then trim({column}, {_BLANKS}) end"


_FIELDS = ("player_name", "roster_number", "rushing_yards", "receiving_yards", "tackles_combined", "total_points")
_TEXT = _FIELDS[:2]

P5_SQL = f"""
with r as (
  select s.*, upper({_value("game_id")}) as g, upper({_value("team_id")}) as t, upper({_value("player_id")}) as p,
    coalesce(f.trust_rank, 2147483647) as trust
  from player_game_stats s left join feed_trust f on f.feed = s.feed),
k as (select *, count(*) over w as group_n, min(row_id) over w as group_row_id from r
  where league is not null and season is not null and g is not null and t is not null and p is not null
  window w as (partition by league, season, g, t, p)),
c as ({" union all ".join(f"select group_row_id, row_id, trust, loaded_at, '{f}' as field_name from k where group_n > 1 and {_value(f) if f in _TEXT else f} is not null" for f in _FIELDS)})
select group_row_id, field_name, row_id as source_row_id from c
qualify row_number() over (partition by group_row_id, field_name order by trust, loaded_at desc nulls last, row_id) = 1
"""

P5_RECORDS_SQL = f"""
with found as ({P5_SQL}),
v as (select found.group_row_id, found.field_name, case found.field_name {" ".join(f"when '{f}' then {_value(f) if f in _TEXT else f'cast({f} as varchar)'}" for f in _FIELDS)} end as value
  from found join player_game_stats s on s.row_id = found.source_row_id)
select any_value(league) as league, any_value(season) as season, any_value(upper({_value("game_id")})) as game_id, any_value(upper({_value("team_id")})) as team_id, any_value(upper({_value("player_id")})) as player_id, v.group_row_id,
  {", ".join(f"max(value) filter (field_name = '{f}') as {f}" for f in _FIELDS)}
from v join player_game_stats g on g.row_id = v.group_row_id group by v.group_row_id
"""

SQL: dict[str, str] = {"p5_found": P5_SQL, "p5_records": P5_RECORDS_SQL}
