"""A Spark data source over a league's web service, and the landing of its responses.

Requests are dealt to lanes, one partition each, and a lane asks for one after the
other with a pause between: the service sees at most lanes / delay requests a
second. One lane is the default. Use: spark.dataSource.register(LeagueService), then
spark.read.format("league_service").option("url", ...).option("requests", ...).load().
"""

from __future__ import annotations

import json
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import materialise, ship

# the data source is planned by a worker of its own, which is sent no package, so what it needs of this module travels by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The calls of the service, by the endpoint their documents are landed under, and what names their resource.
CALLS = {
    "teams": ("getleagueTeamsList", None), "schedule": ("getcurrentSeasonSchedule", None), "standings": ("getLeagueStandings", None), "rosters": ("getTeamRoster", "team"),
    "info": ("getRosterInfo", "UID"), "player_stats": ("getStatTotals", "UID"), "games": ("getGameStats", "game_id"), "team_stats": ("getTeamStats", None),
    "offensive_stats": ("getOffensiveStats", None), "defensive_stats": ("getDefensiveStats", None), "special_teams_stats": ("getSpecialTeamStats", None), "scoring_stats": ("getScoringStats", None),
}
RETRIED = (429, 500, 502, 503, 504)
SCHEMA = "endpoint string, league string, season long, resource_id string, text string, valid boolean, error string"


def query_of(request: dict) -> dict[str, str]:
    """The query of a request: endpoint, league, season, and resource_id, tier or week where given."""
    call, resource = CALLS[request["endpoint"]]
    query = {"URI": call, "league": request["league"], "season": request["season"]}
    if resource:
        query[resource] = request["resource_id"]
        if resource == "game_id":
            del query["league"]
    return query | {k: request[k] for k in ("tier", "week") if request.get(k) is not None}


def fetch(url: str, query: dict, timeout: float, delay: float, retries: int = 1) -> str:
    """The body of a GET, asked again after the states that pass; an empty body is an empty list."""
    for attempt in range(retries + 1):
        try:
            with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(query)}", timeout=timeout) as answer:
                body = answer.read().decode("utf-8", "replace")
            time.sleep(delay)
            return body if body.strip() else "[]"
        except urllib.error.HTTPError as e:
            if e.code not in RETRIED or attempt == retries:
                raise
        except urllib.error.URLError:
            if attempt == retries:
                raise
        time.sleep(2**attempt)
    raise AssertionError("unreachable")


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url = options["url"]
        self.timeout, self.delay = float(options.get("timeout", 30)), float(options.get("delay", 0.25))
        self.requests = json.loads(options["requests"])
        self.lanes = max(1, int(options.get("lanes", 1)))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.requests[n :: self.lanes]) for n in range(min(self.lanes, len(self.requests)))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for r in partition.value:
            head = (r["endpoint"], r["league"], int(r["season"]), r.get("resource_id"))
            try:
                text = fetch(self.url, query_of(r), self.timeout, self.delay)
            except Exception as e:  # a request that fails is a row with its error: the others go on
                yield (*head, None, False, str(e))
                continue
            try:
                json.loads(text)
                yield (*head, text, True, None)
            except ValueError as e:
                yield (*head, text, False, str(e))


class LeagueService(DataSource):
    """Options: url, requests (a JSON list), timeout and delay in seconds, lanes."""

    @classmethod
    def name(cls) -> str:
        return "league_service"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_requests(spark: SparkSession, url: str, requests: list[dict], **options: object) -> DataFrame:
    spark.dataSource.register(LeagueService)
    reader = spark.read.format("league_service").option("url", url).option("requests", json.dumps(requests))
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()


def landed_path(endpoint: str, league: str, season: int, resource: str | None, valid: bool) -> str:
    """Where a response lies under the raw folder; what is no JSON is kept as invalid text."""
    end = "json" if valid else "invalid.txt"
    if endpoint in ("info", "player_stats"):
        return f"{league}/{season}/players/{resource}/{'info' if endpoint == 'info' else 'stats'}.{end}"
    return f"{league}/{season}/{endpoint}/{resource}.{end}" if resource else f"{league}/{season}/{endpoint}.{end}"


LANDED = "endpoint string, league string, season long, resource_id string, valid boolean, error string, path string, named array<string>"


def next_resources(endpoint: str, text: str) -> list[str]:
    """The ids a document names that further requests are made of: teams of the league, games of the schedule, players of a roster."""
    from ..functions.documents import ids_of, values_of

    if endpoint == "teams":
        return list(dict.fromkeys(str(i) for i in values_of(json.loads(text), "id") if i not in (None, "")))
    pattern = {"schedule": "game", "rosters": "player"}.get(endpoint)
    return ids_of(json.loads(text), pattern) if pattern else []


def land(responses: DataFrame, raw: str) -> DataFrame:
    """Writes each response below ``raw``, a folder or URI that all executors reach; one row of LANDED for each, path null where the request failed.

    The rows are written once to the shared folder, so reading them again asks
    and writes nothing anew.
    """

    def run(batches):
        import pyarrow as pa

        from . import files

        for batch in batches:
            paths, named = [], []
            for r in batch.to_pylist():
                path = None
                if r["text"] is not None:
                    path = f"{raw.rstrip('/')}/{landed_path(r['endpoint'], r['league'], r['season'], r['resource_id'], r['valid'])}"
                    files.write_text(json.dumps(json.loads(r["text"]), indent=2, ensure_ascii=False) if r["valid"] else r["text"], path)
                paths.append(path)
                named.append(next_resources(r["endpoint"], r["text"]) if r["valid"] else [])
            kept = batch.select(["endpoint", "league", "season", "resource_id", "valid", "error"])
            yield kept.append_column("path", pa.array(paths, pa.string())).append_column("named", pa.array(named, pa.list_(pa.string())))

    ship(responses.sparkSession)
    return materialise(responses.mapInArrow(run, LANDED))


def extract_season(spark: SparkSession, url: str, raw: str, league: str, season: int, **options: object) -> DataFrame:
    """Lands all documents of a league's season: the league's own first, then those of the teams, games and players they name.

    Bodies are fetched and landed by the workers; what comes to the driver are
    the ids one season's documents name.
    """

    def fetched(requests: list[dict]) -> DataFrame:
        return land(read_requests(spark, url, [{"league": league, "season": season, **r} for r in requests], **options), raw)

    def named(landed: DataFrame, endpoint: str) -> list[str]:
        ids = landed.where(F.col("endpoint") == endpoint).select(F.explode("named").alias("id")).distinct().orderBy("id")
        return [r["id"] for r in ids.toLocalIterator()]

    first = fetched([{"endpoint": e} for e, (_, resource) in CALLS.items() if resource is None])
    second = fetched([{"endpoint": "rosters", "resource_id": t} for t in named(first, "teams")] + [{"endpoint": "games", "resource_id": g} for g in named(first, "schedule")])
    third = fetched([{"endpoint": e, "resource_id": p} for p in named(second, "rosters") for e in ("info", "player_stats")])
    return first.unionByName(second).unionByName(third).drop("named").select("endpoint", "league", "season", "resource_id", "valid", "path", "error")
