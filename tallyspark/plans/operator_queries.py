"""One registered query per relational, cleaning, quality and audit operator, and the SQL to compare it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.documents import dynamic_ids, flatten_documents
from ..functions.people import first_initial, normalised_name, surname
from ..functions.stats import guarded_ratio, passer_rating
from ..functions.text import blank_to_null, id_key, name_key, preview, safe_number, valued
from ..operators import relational
from ..operators.repair import classify_response, recover_texts, recoverable
from ..session import materialise
from ..sources.tables import table
from .canonical import game_date, team_place

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
_STRIP = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160)"
_TOKENS = "'', '-', 'NULL', 'null', 'None', 'Not Reported', 'N/A', 'NR'"


def _value(c: str) -> str:
    return f"case when trim({c}, {_STRIP}) not in ({_TOKENS}) then trim({c}, {_STRIP}) end"


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@_query("select cast(o_orderkey as varchar) as o_orderkey, cast(o_orderdate as date) as o_orderdate, cast(o_totalprice as double) as o_totalprice, * exclude (o_orderkey, o_orderdate, o_totalprice) from orders")
def stage_typed_star_exclude(spark, d):
    head = {"o_orderkey": "string", "o_orderdate": "date", "o_totalprice": "double"}
    return relational.head_and_rest(table(spark, d, "orders"), [F.col(c).cast(t).alias(c) for c, t in head.items()], list(head))


@_query("select p_brand, p_name as part_name, * exclude (p_brand, p_name) from part")
def head_columns_reorder(spark, d):
    return relational.head_and_rest(table(spark, d, "part"), ["p_brand", F.col("p_name").alias("part_name")], ["p_brand", "p_name"])


@_query("select * from customer where c_mktsegment = 'BUILDING'")
def filter_constant_view(spark, d):
    return relational.constant_view(table(spark, d, "customer"), "c_mktsegment", "BUILDING")


@_query("select * from customer where c_acctbal < 0 or c_acctbal > 9000")
def filter_range_violation(spark, d):
    return table(spark, d, "customer").where(relational.outside("c_acctbal", 0, 9000))


@_query("select league, season, team_id from teams where tier is null or conference is null or division is null")
def filter_any_null(spark, d):
    return table(spark, d, "teams").where(relational.any_null(["tier", "conference", "division"])).select("league", "season", "team_id")


@_query("select event_id, event_type from events where event_type in ('click', 'purchase')")
def filter_set_membership(spark, d):
    return table(spark, d, "events").where(relational.one_of("event_type", ("click", "purchase"))).select("event_id", "event_type")


@_query("""
select l_orderkey, l_linenumber, coalesce(c_name, 'unknown') as customer_name,
  case when o_orderstatus = 'F' then 'closed' when o_orderstatus = 'O' then 'open' end as state, c_custkey is not null as has_customer
from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey""")
def left_join_enrich(spark, d):
    li, o, c = (table(spark, d, t) for t in ("lineitem", "orders", "customer"))
    orders = o.select("o_orderkey", "o_custkey", "o_orderstatus")
    joined = relational.enrich(relational.enrich(li, orders, "o_", [("l_orderkey", "o_orderkey")]), c.select("c_custkey", "c_name"), "c_", [("o_o_custkey", "c_custkey")])
    state = F.when(F.col("o_o_orderstatus") == "F", "closed").when(F.col("o_o_orderstatus") == "O", "open")
    name = F.coalesce("c_c_name", F.lit("unknown")).alias("customer_name")
    return joined.select("l_orderkey", "l_linenumber", name, state.alias("state"), F.col("c_c_custkey").isNotNull().alias("has_customer"))


@_query("""
select ts.row_id, s.wins, s.losses from team_season_stats ts left join standings s
  on ts.league = s.league and ts.season = s.season and lower(trim(ts.team_name)) = lower(trim(s.team_name))
""")
def left_join_expr_key(spark, d):
    ts, s = table(spark, d, "team_season_stats"), table(spark, d, "standings")
    joined = relational.enrich(ts, s, "s_", [("league", "league"), ("season", "season"), ("team_name", "team_name")], fold=True)
    return joined.select("row_id", F.col("s_wins").alias("wins"), F.col("s_losses").alias("losses"))


@_query("""
select o_orderkey, o_custkey, n_parts from orders
left join (select l_orderkey, count(distinct l_partkey) as n_parts from lineitem group by l_orderkey) on o_orderkey = l_orderkey
""")
def join_to_aggregate(spark, d):
    n = relational.distinct_counts(table(spark, d, "lineitem"), ["l_orderkey"], "l_partkey", "n_parts")
    joined = relational.enrich(table(spark, d, "orders"), n, "n_", [("o_orderkey", "l_orderkey")])
    return joined.select("o_orderkey", "o_custkey", F.col("n_n_parts").alias("n_parts"))


@_query("select distinct player_id from player_season_stats c where player_id is not null and not exists (select 1 from players p where p.player_id = c.player_id)")
def anti_join_fk(spark, d):
    return relational.anti_missing(table(spark, d, "player_season_stats"), table(spark, d, "players"), ["player_id"], ["player_id"], allow_null=True)


_LINES = f"select row_id, league, season, upper({_value('source_player_id')}) as source_player_id, upper({_value('player_id')}) as player_id from player_game_stats"


def _lines(spark, d):
    return table(spark, d, "player_game_stats").select("row_id", "league", "season", id_key("source_player_id").alias("source_player_id"), id_key("player_id").alias("player_id"))


@_query(f"select league, season, source_player_id, min(player_id) as player_id from ({_LINES}) where source_player_id is not null and player_id is not null group by all having count(distinct player_id) = 1")
def unique_mapping_lookup(spark, d):
    return relational.unique_mapping(_lines(spark, d), ["league", "season", "source_player_id"], "player_id")


@_query(f"""with x as ({_LINES}), u as (select league, season, source_player_id, min(player_id) as found from x where source_player_id is not null and player_id is not null group by all having count(distinct player_id) = 1)
select row_id, x.league, x.season, x.source_player_id, coalesce(player_id, found) as player_id from x left join u on x.league = u.league and x.season = u.season and x.source_player_id = u.source_player_id""")
def identity_propagation(spark, d):
    return relational.propagate_id(_lines(spark, d), ["league", "season", "source_player_id"], "player_id")


@_query(f"""with t as (select league, season, team_city, team_name, min(team_id) as found from teams group by all)
select row_id, s.league, s.season, s.team_city, s.team_name, coalesce({_value('team_id')}, found) as team_id from team_season_stats s left join t on s.league = t.league and s.season = t.season and s.team_city = t.team_city and s.team_name = t.team_name""")
def attach_id_coalesce(spark, d):
    keys = ["league", "season", "team_city", "team_name"]
    lookup = table(spark, d, "teams").groupBy(*keys).agg(F.min("team_id").alias("team_id"))
    return relational.attach_id(table(spark, d, "team_season_stats").select("row_id", *keys, valued("team_id").alias("team_id")), lookup, keys, "team_id")


@_query("select player_id, count(*) as n_rows from players group by player_id having count(*) > 1")
def duplicate_key_groups(spark, d):
    return relational.duplicate_groups(table(spark, d, "players"), ["player_id"])


# The columns of the standings, all of them.
_STANDING_COLUMNS = (
    "league", "season", "tier", "conference", "division", "region", "team_name", "team_logo", "wins", "losses", "ties", "win_pct", "points_for", "points_against", "home_record",
    "away_record", "conference_record", "division_record", "nonconference_record", "nondivision_record", "streak", "load_id", "loaded_at",
)


@_query(" union all ".join(f"select '{c}' as column_name, count(*) - count({c}) as n_null, count(*) as n_rows from standings" for c in _STANDING_COLUMNS))
def null_profile(spark, d):
    return relational.null_counts(table(spark, d, "standings"))


@_query("select event_type, user_id, count(*) as n from events group by all")
def group_count_multi_sorted(spark, d):
    return relational.counted(table(spark, d, "events"), ["event_type", "user_id"], "n")


_RATE = "least(greatest({}, 0.0), 2.375)"
_TERMS = ("(completions / attempts - 0.3) * 5.0", "(yards / attempts - 3.0) * 0.25", "tds / attempts * 20.0", "2.375 - ints / attempts * 25.0")


@_query(f"""
with q as (
  select l_suppkey, sum(l_quantity) as attempts, sum(case when l_returnflag = 'N' then l_quantity end) as completions, sum(l_linenumber) * 10.0 as yards,
    sum(case when l_linestatus = 'F' then 1 end) as tds, sum(case when l_returnflag = 'A' then 1 end) as ints
  from lineitem group by l_suppkey)
select l_suppkey, round(({' + '.join(_RATE.format(t) for t in _TERMS)}) / 6.0 * 100.0, 4) as rating, round(completions / attempts * 100.0, 4) as completion_pct
from q where attempts > 0
""")
def qb_rating(spark, d):
    li = table(spark, d, "lineitem")
    one = li.groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("attempts"), F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity"))).alias("completions"), (F.sum("l_linenumber") * 10.0).alias("yards"),
        F.sum(F.when(F.col("l_linestatus") == "F", 1)).alias("tds"), F.sum(F.when(F.col("l_returnflag") == "A", 1)).alias("ints"),
    )
    rating = F.round(passer_rating("attempts", "completions", "yards", "tds", "ints"), 4).alias("rating")
    return one.where("attempts > 0").select("l_suppkey", rating, F.round(guarded_ratio("completions", "attempts", 100.0), 4).alias("completion_pct"))


@_query("select player_id, " + ", ".join(f"arg_max({c}, (loaded_at, row_id)) filter ({c} is not null and loaded_at is not null) as {c}" for c in ("rushing_yards", "tackles", "passing_yards")) + " from player_season_stats group by player_id")
def last_non_null_merge(spark, d):
    rows = table(spark, d, "player_season_stats").withColumns({c: F.when(F.col("loaded_at").isNotNull(), F.col(c)) for c in ("rushing_yards", "tackles", "passing_yards")})
    return relational.last_non_null(rows, ["player_id"], ["rushing_yards", "tackles", "passing_yards"], ["loaded_at", "row_id"])


@_query("select user_id, string_agg(distinct event_type, ' | ' order by event_type) as kinds from events group by user_id")
def distinct_sorted_concat(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(relational.distinct_joined("event_type").alias("kinds"))


@_query("""select team_id, coalesce(a.n, 0) as raw, coalesce(b.n, 0) as attempted, greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) as outstanding from (select team_id, count(*) as n from rosters where team_id is not null group by 1) a
full join (select team_id, count(*) as n from player_season_stats where team_id is not null group by 1) b using (team_id)""")
def reconcile_counts(spark, d):
    counts = {name: table(spark, d, t).where("team_id is not null").groupBy("team_id").agg(F.count("*").alias("n")) for name, t in (("raw", "rosters"), ("attempted", "player_season_stats"))}
    return relational.reconcile(counts, "team_id").withColumn("outstanding", F.greatest(F.col("raw") - F.col("attempted"), F.lit(0).cast("long")))


@_query("select league, round(100.0 * count(*) filter (player_id is null) / count(*), 4) as missing_pct from player_season_stats group by league")
def ratio_of_counts(spark, d):
    return table(spark, d, "player_season_stats").groupBy("league").agg(F.round(relational.percentage(F.col("player_id").isNull()), 4).alias("missing_pct"))


@_query("select * exclude (loaded_at) from player_season_stats qualify row_number() over (partition by league, season, team_id, player_id order by row_id) = 1")
def keep_first_dedupe(spark, d):
    return relational.keep_first(table(spark, d, "player_season_stats"), ["league", "season", "team_id", "player_id"], ["row_id"]).drop("loaded_at")


@_query("select distinct event_type, user_id from events")
def full_row_dedupe(spark, d):
    return relational.distinct_rows(table(spark, d, "events").select("event_type", "user_id"))


@_query("select o_orderpriority, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) <= 3")
def top_n_per_group(spark, d):
    return relational.top_n(table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice"), ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@_query("select l_orderkey, l_linenumber, l_partkey as ref, 'part' as side from lineitem union all select l_orderkey, l_linenumber, l_suppkey, 'supplier' from lineitem")
def unpivot_union_all(spark, d):
    views = [{"ref": F.col(c), "side": F.lit(side)} for c, side in (("l_partkey", "part"), ("l_suppkey", "supplier"))]
    return relational.sides(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), views).select("l_orderkey", "l_linenumber", "ref", "side")


@_query("select c_custkey as id, cast(c_nationkey as varchar) as nation, c_mktsegment as segment, null as balance from customer union all by name select s_suppkey as id, s_name as nation, s_acctbal as balance, null as segment from supplier")
def diagonal_union(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nation"), F.col("s_acctbal").alias("balance"))
    return relational.union_diagonal([c, s])


@_query(f"select row_id, lower(trim(player_name, {_STRIP})) as name_key, case when trim(player_name, {_STRIP}) <> '' then trim(player_name, {_STRIP}) end as clean_name from player_game_stats")
def name_match_key(spark, d):
    return table(spark, d, "player_game_stats").select("row_id", name_key("player_name").alias("name_key"), blank_to_null("player_name").alias("clean_name"))


@_query("""
with n as (select player_id, nullif(trim(regexp_replace(lower(strip_accents(player_name)), '[^a-z0-9]+', ' ', 'g')), '') as normalized from players)
select player_id, normalized, split_part(normalized, ' ', -1) as surname, substr(normalized, 1, 1) as initial from n
""")
def normalize_name(spark, d):
    """Every player's name. DuckDB's strip_accents takes no ligatures and compatibility forms apart; such names are compared with NFKD in the tests."""
    named = table(spark, d, "players").select("player_id", normalised_name(F.col("player_name")).alias("normalized"))
    return named.select("player_id", "normalized", surname(F.col("normalized")).alias("surname"), first_initial(F.col("normalized")).alias("initial"))


@_query(r"""with f as (select doc_id, trim(regexp_replace(text, '[ \t\n\x0b\f\r]+', ' ', 'g')) as t from documents) select doc_id, case when length(t) > 240 then substr(t, 1, 237) || '...' else t end as preview from f""")
def preview_truncate(spark, d):
    return table(spark, d, "documents").select("doc_id", preview("text").alias("preview"))


@_query(f"select row_id, try_cast(trim(roster_number, {_STRIP}) as bigint) as number from player_game_stats")
def safe_cast(spark, d):
    return table(spark, d, "player_game_stats").select("row_id", safe_number("roster_number").alias("number"))


@_query("""
with g as (select game_id, season, date, row_number() over (partition by game_id order by loaded_at, date, season) as n, (day(date) % 3) as form from games)
select game_id, n, case when form = 0 then date else try_cast(season || strftime(date, '-%m-%d') as date) end as day from g
""")
def season_date_coalesce(spark, d):
    """Every game's date written in three ways, two of them without a year: those are of the season's year, and null if it lacks the day."""
    g = table(spark, d, "games")
    form = F.pmod(F.dayofmonth("date"), F.lit(3))
    typed = F.when(form == 0, F.date_format("date", "yyyy-MM-dd")).when(form == 1, F.date_format("date", "MMMM d")).otherwise(F.date_format("date", "MMM d"))
    n = F.row_number().over(Window.partitionBy("game_id").orderBy("loaded_at", "date", "season"))
    return g.select("game_id", n.alias("n"), game_date(typed, F.col("season")).alias("day"))


_IS_TIER = "coalesce(upper({0}) = 'WFA PRO' or upper({0}) like 'DIV %', false)"


@_query(f"""
select league, season, team_id,
  case when league = 'wfa' and {_IS_TIER.format('conf')} then conf when league = 'wfa' and {_IS_TIER.format('div')} then div end as tier,
  case when league = 'wnfc' then null when league = 'wfa' and {_IS_TIER.format('conf')} then div else conf end as conference,
  case when league = 'wfa' and ({_IS_TIER.format('conf')} or {_IS_TIER.format('div')}) then null else div end as division, region
from (select league, season, team_id, case when conference = 'National' then 'Div 2' else conference end as conf, division as div, region from teams)
""")
def hierarchy_case(spark, d):
    t = table(spark, d, "teams").select("league", "season", "team_id", F.when(F.col("conference") == "National", "Div 2").otherwise(F.col("conference")).alias("conf"), F.col("division").alias("div"), "region")
    return team_place(t)


@_query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_dynamic_key(spark, d):
    """The value under a key that is a letter and digits: the number is put into the key, as the source does with ids."""
    numbered = F.regexp_replace("props", '"k"', F.concat(F.lit('"k'), F.col("event_id").cast("string"), F.lit('"')))
    return table(spark, d, "events").select("event_id", dynamic_ids(numbered, "k").alias("k"))


@_query(f"""
select league, season, team_id, {_value('player_id')} as player_id, count(*) as n from rosters
where {_value('player_id')} is not null and league is not null and season is not null and team_id is not null group by all
""")
def json_flatten_nested(spark, d):
    """Rosters written as nested documents, one per team and season, and flattened again."""
    given = table(spark, d, "rosters").where("league is not null and season is not null and team_id is not null")
    r = given.withColumn("player_id", valued("player_id")).where("player_id is not null")
    # a document is one roster; rosters are split over documents by a hash so that none grows with the table
    part = F.pmod(F.xxhash64("player_id"), F.lit(8)).alias("part")
    people = F.collect_list(F.struct(F.col("player_id").alias("player1"), F.col("roster_number").alias("Number")))
    roster = F.struct(F.first("league").alias("league"), F.first("season").alias("season"), F.coalesce(F.first("team_name"), F.lit("")).alias("team"), people.alias("players"))
    docs = r.groupBy("league", "season", "team_id", part).agg(F.to_json(roster).alias("text"))
    file = F.concat_ws("/", "league", "season", "team_id", "part").alias("file")
    flat = flatten_documents(docs.select("league", "season", F.lit("rosters").alias("endpoint"), F.col("team_id").alias("resource_id"), file, "text"))
    keys = [F.col("league"), F.col("season"), F.col("fields")["team_id"].alias("team_id"), F.col("fields")["player_id"].alias("player_id")]
    return flat.where("table_name = 'rosters'").groupBy(*keys).agg(F.count("*").alias("n"))


# What marks a response without data.
_PHRASES = (
    "no data", "no records", "not found", "no roster", "no standings", "no stats", "no games", "nothing found", "does not exist", "doesn''t exist", "not available", "unavailable",
    "not yet published", "have not published", "has not published",
)
_NO_DATA = " or ".join(f"contains(lower(text), '{p}')" for p in _PHRASES)


@_query(f"select doc_id, coalesce(trim(text, {_STRIP}), '') = '' as empty, coalesce({_NO_DATA}, false) as no_data from documents")
def response_no_data(spark, d):
    """Two reasons of every document: null or blank, and one of the phrases."""
    docs = table(spark, d, "documents").select("doc_id", classify_response(F.col("text"), F.lit("rosters")).alias("reason"))
    return docs.select("doc_id", (F.col("reason") == "EMPTY").alias("empty"), (F.col("reason") == "NO_DATA").alias("no_data"))


# one response of each kind, by the number of the row: (reason, endpoint, text with the row's number in it)
_RESPONSES = (
    ("EMPTY", "games", " \n "),
    ("NO_DATA", "rosters", "Nothing found for {}, sorry"),
    ("EMPTY_PLAYER_STATS", "stats", '{{"row": {}, "player_stat_totals": [ {{ ] }}'),
    ("HTML_RESPONSE", "teams", "<html><p>{}</p></html>"),
    ("API_ERROR", "teams", "502 Bad Gateway, request {}"),
    ("VALID_JSON_MARKED_INVALID", "teams", '{{"row": {}}}'),
    ("PYTHON_LITERAL", "teams", "{{'row': ({}, None)}}"),
    ("MALFORMED_GAME_DATA", "games", '{{"row": [{},}}'),
    ("MALFORMED_STANDINGS_DATA", "standings", '{{"row": [{},}}'),
    ("MALFORMED_JSON", "teams", '{{"row": [{},}}'),
    ("TEXT_RESPONSE", "teams", "row {} of the list"),
    ("UNKNOWN", "teams", "\x01\x02\x03\x04{}"),
)
_RECOVERABLE = ("VALID_JSON_MARKED_INVALID", "PYTHON_LITERAL", "MALFORMED_GAME_DATA", "MALFORMED_STANDINGS_DATA", "MALFORMED_JSON")


@_query(
    "select row_id, reason, reason in (" + ", ".join(f"'{r}'" for r in _RECOVERABLE) + ") as recoverable from (select row_id, case row_id % 12 "
    + " ".join(f"when {n} then '{reason}'" for n, (reason, _, _) in enumerate(_RESPONSES)) + " end as reason from feed_rows)"
)
def response_classify(spark, d):
    """A response of each of the twelve kinds for every row."""
    at, number = F.pmod(F.col("row_id"), F.lit(12)).cast("int"), F.col("row_id").cast("string")
    bodies = []
    for _, _, body in _RESPONSES:
        before, after = (part.replace("{{", "{").replace("}}", "}") for part in body.split("{}")) if "{}" in body else (body, None)
        text = F.lit(before) if after is None else F.concat(F.lit(before), number, F.lit(after))
        bodies.append(text)
    endpoint = F.get(F.array(*[F.lit(e) for _, e, _ in _RESPONSES]), at)
    rows = table(spark, d, "feed_rows").select("row_id", F.get(F.array(*bodies), at).alias("text"), endpoint.alias("endpoint"))
    classed = rows.select("row_id", classify_response(F.col("text"), F.col("endpoint")).alias("reason"))
    return classed.select("row_id", "reason", recoverable(F.col("reason")).alias("recoverable"))


@_query("select row_id, payload as original, 'MALFORMED_STANDINGS_DATA' as category, true as success from feed_rows where payload is not null")
def json_repair(spark, d):
    """Payloads broken in three ways, by row, and repaired: the result must parse to the original."""
    rows = table(spark, d, "feed_rows").where("payload is not null")
    body = F.expr("substring(payload, 1, length(payload) - 1)")
    damaged = F.when(F.col("row_id") % 3 == 0, F.concat(body, F.lit(",}"))).when(F.col("row_id") % 3 == 1, F.concat("payload", F.lit("]}"))).otherwise(body)
    fixed = recover_texts(rows.select("row_id", "payload", damaged.alias("damaged"), F.lit("standings").alias("endpoint")), "damaged", "endpoint")
    same = F.try_parse_json("recovered").cast("string") == F.try_parse_json("payload").cast("string")
    return fixed.select("row_id", F.when(same, F.col("payload")).alias("original"), "category", "success")


@_query("select p_partkey, sha256(concat_ws('|', cast(p_partkey as varchar), coalesce(p_name, '\\N'), coalesce(p_brand, '\\N'))) as fingerprint from part")
def row_fingerprint(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", relational.fingerprint(p, ["p_partkey", "p_name", "p_brand"]).alias("fingerprint"))


@_query("select * exclude (o_orderdate), cast(o_orderdate as date) as order_day from orders")
def parquet_roundtrip(spark, d):
    back = materialise(table(spark, d, "orders"))
    return back.withColumn("order_day", F.to_date("o_orderdate")).drop("o_orderdate")
