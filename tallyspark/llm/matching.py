"""Matching entities across sources without keys.

Method: candidates come from MinHash blocking over the letter pairs of every
name token and from the shirt number, always within the league, season and team
both sides name; each candidate pair gets similarity features; a logistic
regression trained on weak labels (lines that give both ids) turns them into a
probability, calibrated on labels held out from the training. The sample of
labelled entities that the model is fitted to is bounded; blocking, features
and scores cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import id_key, name_key, valued
from ..session import materialise
from .names import cached, name_likeness, tokens

HASHES = 4
FEATURES = ("like_mean", "like_max", "whole", "by_initial", "nameless", "number_same", "number_other", "lead", "number_lead")
SCOPE = ("league", "season", "team")


def number_of(column: str) -> Column:
    """A shirt number as people type it (7, 07, #7, No. 7); null where none is read."""
    return F.expr(f"try_cast(regexp_extract({column}, '^\\\\s*(?:#|No\\\\.?|no\\\\.?|nr\\\\.?)?\\\\s*0*([0-9]{{1,3}})\\\\s*$', 1) as int)")


@cached(200_000)
def token_minhashes(token: str) -> tuple[str, ...]:
    """One block name per hash function: the smallest hash of the token's letter pairs, its ends marked."""
    padded = f"^{token}$"
    pairs = {padded[i : i + 2] for i in range(len(padded) - 1)}
    return tuple(f"m{h}:{min(xxhash.xxh32_intdigest(p, seed=h) for p in pairs)}" for h in range(HASHES))


def block_keys(league: str, season: int, team: str, name: str | None, number: int | None) -> dict[int, int]:
    """Hashed blocks of one spelling with their weights: MinHashes of its tokens, and the number with the initials.

    Two spellings are compared if the blocks they share weigh 2 or more: two
    MinHashes, or one and the number, or the number alone where either has no name.
    """
    words = tokens(name) if name else ()
    out = {b: 1 for w in words if len(w) > 1 for b in token_minhashes(w)}
    if number is not None:
        out |= {f"n{number}:{w[0]}": 1 for w in words}
        out[f"n{number}:"] = 1 if words else 2
    place = f"{league}|{season}|{team}|"
    return {xxhash.xxh3_64_intdigest(place + b) - (1 << 63): w for b, w in out.items()}


def _with_blocks(df: DataFrame, keep: list[str]) -> DataFrame:
    """(*keep, block, weight): one row per block of each spelling."""
    kinds = {"league": "string", "season": "long", "team": "string", "source": "string", "player": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [block_keys(*r) for r in zip(*(batch.column(c).to_pylist() for c in (*SCOPE, "name", "number")))]
            rows = pa.array(np.repeat(np.arange(batch.num_rows), [len(b) for b in blocks]))
            taken = batch.select(keep).take(rows)
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array([k for b in blocks for k in b], pa.int64()), pa.array([w for b in blocks for w in b.values()], pa.int32())], [*keep, "block", "weight"])

    columns = list(dict.fromkeys([*SCOPE, "name", "number", *keep]))
    return df.select(*columns).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", block long, weight int")


def roster_people(rosters: DataFrame, players: DataFrame) -> DataFrame:
    """(league, season, team, player, number, name): the people of each roster, once each, under each name their id is known by."""
    people = players.select(id_key("player_id").alias("player"), valued("player_name").alias("name")).where("player is not null and player <> 'PTEAM' and name is not null").groupBy("player", "name").agg(F.lit(1).alias("one")).drop("one")
    rows = rosters.select("league", "season", id_key("team_id").alias("team"), id_key("player_id").alias("player"), number_of("roster_number").alias("number")).where("league is not null and season is not null and team is not null and player is not null and player <> 'PTEAM'")
    # a row without number adds nothing to one with it; numbers have three digits at most, so the sets are bounded
    numbered = rows.groupBy(*SCOPE, "player").agg(F.collect_set("number").alias("numbers")).select(*SCOPE, "player", F.explode_outer("numbers").alias("number"))
    return numbered.join(people, "player", "left").select(*SCOPE, "player", "number", "name")


def source_ids(stats: DataFrame) -> DataFrame:
    """(source, player, other, n): the smallest and largest player id of each source id's lines, null where no line has one."""
    lines = stats.select(id_key("source_player_id").alias("source"), id_key("player_id").alias("player")).where("source is not null")
    return lines.groupBy("source").agg(F.min("player").alias("player"), F.max("player").alias("other"), F.count("*").alias("n"))


def source_spellings(stats: DataFrame, rosters: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, league, season, team, name, number, n): the different spellings of the wanted source ids, with how many lines type them."""
    teams = (
        rosters.select("league", "season", id_key("team_id").alias("team_by_name"), name_key(valued("team_name")).alias("team_name"))
        .where("team_by_name is not null and team_name is not null").groupBy("league", "season", "team_name")
        .agg(F.min("team_by_name").alias("team_by_name"), F.max("team_by_name").alias("other")).where("team_by_name = other").drop("other")
    )
    lines = stats.select(
        id_key("source_player_id").alias("source"), "league", "season", id_key("team_id").alias("team"),
        F.when(id_key("team_id").isNull(), name_key(valued("team_name"))).alias("team_name"), valued("player_name").alias("name"), number_of("roster_number").alias("number"),
    ).where("source is not null and league is not null and season is not null")
    own = lines.join(wanted.select("source").hint("merge"), "source").groupBy(*lines.columns).agg(F.count("*").alias("n"))
    named = own.join(teams, ["league", "season", "team_name"], "left").withColumn("team", F.coalesce("team", "team_by_name")).where("team is not null")
    return named.groupBy("source", *SCOPE, "name", "number").agg(F.sum("n").alias("n"))


def _pair_evidence(spellings: DataFrame, people: DataFrame) -> DataFrame:
    """Features of (source, scope, player) candidates that meet in blocks, from all spellings of the source.

    The spellings that meet a candidate in no block count against it as well,
    so shares are of all the source's lines in the scope. Joins sort and merge:
    how many rows the blocks make can't be foretold.
    """
    left = _with_blocks(spellings, ["source", *SCOPE]).groupBy("source", *SCOPE, "block").agg(F.max("weight").alias("weight"))
    right = _with_blocks(people, ["player"]).withColumnRenamed("weight", "other_weight")
    pairs = left.join(right.hint("merge"), "block").groupBy("source", *SCOPE, "player").agg(F.sum(F.greatest("weight", "other_weight")).alias("shared")).where("shared > 1").drop("shared")
    met = pairs.join(people.withColumnsRenamed({"name": "roster_name", "number": "roster_number"}).hint("merge"), [*SCOPE, "player"]).join(spellings.hint("merge"), ["source", *SCOPE])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like, whole, initial = [], [], []
            for a, b in zip(batch.column("name").to_pylist(), batch.column("roster_name").to_pylist()):
                score, full, initials, left_over = name_likeness(a, b) if a and b else (0.0, 0, 0, 0)
                like.append(score * 0.95**left_over)
                whole.append(1.0 if score > 0 and full > 1 else 0.0)
                initial.append(1.0 if score > 0 and initials and full < 2 else 0.0)
            kept = [batch.column(c) for c in ("source", "league", "season", "team", "player", "name", "number", "roster_number", "n")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(like), pa.array(whole), pa.array(initial)], ["source", "league", "season", "team", "player", "name", "number", "roster_number", "n", "likeness", "whole", "initial"])

    scored = met.mapInArrow(compare, "source string, league string, season long, team string, player string, name string, number int, roster_number int, n long, likeness double, whole double, initial double")
    # a person known by several names or numbers counts by the closest
    best = scored.groupBy("source", *SCOPE, "player", "name", "number", "n").agg(F.max("likeness").alias("likeness"), F.max("whole").alias("whole"), F.max("initial").alias("initial"), F.max(F.col("number") == F.col("roster_number")).alias("same"), F.count("roster_number").alias("numbered"))
    n = F.sum("n")
    named = F.col("name").isNotNull()

    def share(what: Column) -> Column:
        return F.sum(F.when(what, F.col("n")).otherwise(0)) / n

    return best.groupBy("source", *SCOPE, "player").agg(
        n.cast("double").alias("lines"),
        F.coalesce(F.sum(F.when(named, F.col("likeness") * F.col("n"))) / F.sum(F.when(named, F.col("n"))), F.lit(0.0)).alias("like_mean"),
        F.max("likeness").alias("like_max"),
        (F.sum(F.col("whole") * F.col("n")) / n).alias("whole"),
        (F.sum(F.col("initial") * F.col("n")) / n).alias("by_initial"),
        share(~named).alias("nameless"),
        share(F.coalesce("same", F.lit(False))).alias("number_same"),
        share(F.col("number").isNotNull() & (F.col("numbered") > 0) & ~F.coalesce("same", F.lit(False))).alias("number_other"),
    )


def with_rivals(evidence: DataFrame) -> DataFrame:
    """Adds how far a candidate leads the best other one of its source, by name and by number."""
    scope = ["source", *SCOPE]
    # the highest value, how many candidates have it and the next lower one tell every candidate's best rival; no group is held
    first = evidence.groupBy(scope).agg(F.max("like_mean").alias("t"), F.max("number_same").alias("u"))
    joined = evidence.join(first.hint("merge"), scope)
    second = joined.groupBy(scope).agg(
        F.count_if(F.col("like_mean") == F.col("t")).alias("n_t"), F.max(F.when(F.col("like_mean") < F.col("t"), F.col("like_mean"))).alias("t2"),
        F.count_if(F.col("number_same") == F.col("u")).alias("n_u"), F.max(F.when(F.col("number_same") < F.col("u"), F.col("number_same"))).alias("u2"),
    )

    def lead(own: str, top: str, n: str, next_top: str) -> Column:
        return F.col(own) - F.when((F.col(own) < F.col(top)) | (F.col(n) > 1), F.col(top)).otherwise(F.coalesce(next_top, F.lit(0.0)))

    full = joined.join(second.hint("merge"), scope)
    return full.withColumns({"lead": lead("like_mean", "t", "n_t", "t2"), "number_lead": lead("number_same", "u", "n_u", "u2")}).drop("t", "u", "n_t", "t2", "n_u", "u2")


class MatchModel:
    """Standardised logistic regression with a calibrating second regression of its score."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, slope: float, offset: float):
        self.mean, self.scale, self.weights, self.slope, self.offset = mean, scale, weights, slope, offset

    def probability(self) -> Column:
        score = F.lit(float(self.weights[-1]))
        for name, m, s, w in zip(FEATURES, self.mean, self.scale, self.weights):
            score = score + (F.col(name) - F.lit(float(m))) / F.lit(float(s)) * F.lit(float(w))
        return 1.0 / (1.0 + F.exp(-(score * F.lit(self.slope) + F.lit(self.offset))))


# What is assumed where there are no labels to learn from: the name leads and the number doesn't contradict.
DEFAULT_MODEL = MatchModel(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.array([3.0, 1.5, 1.0, 0.5, 0.0, 2.0, -1.5, 3.0, 1.0, -4.0]), 1.0, 0.0)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 30) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + np.diag(keep)
        step = np.linalg.solve(h, x.T @ (y - p) - keep * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_model(features: np.ndarray, truth: np.ndarray, held: np.ndarray) -> MatchModel:
    """Trained on the rows not ``held``, calibrated on those held."""
    train = ~held
    if truth[train].sum() < 5 or (1 - truth[train]).sum() < 5:
        return DEFAULT_MODEL
    mean, scale = features[train].mean(axis=0), features[train].std(axis=0)
    scale[scale < 1e-6] = 1.0
    w = _logistic((features[train] - mean) / scale, truth[train], 1.0)
    slope, offset = 1.0, 0.0
    if held.sum() > 50 and 5 <= truth[held].sum() < held.sum() - 5:
        score = np.hstack([(features[held] - mean) / scale, np.ones((int(held.sum()), 1))]) @ w
        slope, offset = _logistic(score[:, None], truth[held], 1e-3)
    return MatchModel(mean, scale, w, float(max(slope, 0.05)), float(offset))


class SourceMatches:
    """The matches of source ids with rosters.

    ``labelled`` bounds the source ids the model is fitted to, ``labelled_lines``
    the lines that each of them may have: an id with more is no person, and
    isn't learned from. Both bound the sample alone; every id without a player is matched.
    """

    def __init__(self, stats: DataFrame, rosters: DataFrame, players: DataFrame, labelled: int = 6_000, labelled_lines: int = 1_000):
        ids = materialise(source_ids(stats).where(f"player is null or player = other and player <> 'PTEAM' and n <= {int(labelled_lines)}"))
        # the labelled sample: a bounded number of ids by the smallest hash
        sample = ids.where("player is not null").orderBy(F.xxhash64("source"), "source").limit(labelled).select("source", F.col("player").alias("truth"))
        wanted = materialise(ids.where("player is null").select("source", F.lit(None).cast("string").alias("truth")).unionByName(sample))
        people = roster_people(rosters, players)
        evidence = _pair_evidence(materialise(source_spellings(stats, rosters, wanted)), materialise(people))
        self.evidence = materialise(with_rivals(materialise(evidence)).join(wanted.hint("merge"), "source"))

    def model(self) -> MatchModel:
        rows = self.evidence.where("truth is not null").select("source", (F.col("player") == F.col("truth")).cast("double").alias("y"), *FEATURES).toArrow()
        if not rows.num_rows:
            return DEFAULT_MODEL
        x = np.column_stack([rows[f].to_numpy() for f in FEATURES]).astype(float)
        held = np.array([xxhash.xxh32_intdigest(s) % 5 == 0 for s in rows["source"].to_pylist()])
        return fit_model(x, rows["y"].to_numpy(), held)

    def scored(self) -> DataFrame:
        """(source_player_id, league, season, team_id, player_id, confidence, features) of every candidate pair."""
        return self.evidence.where("truth is null").drop("truth").withColumn("confidence", self.model().probability())

    def best(self, least: float = 0.5) -> DataFrame:
        """(source_player_id, player_id, confidence): of each source id without a player the most probable one, if at least ``least``.

        Ties go to the smaller player_id. Source ids whose lines name no team,
        or a team without a roster, and players on no roster get no row; so do
        ids whose lines carry neither name nor number.
        """
        per_player = self.scored().groupBy("source", "player").agg(F.max("confidence").alias("confidence"), F.max("lines").alias("lines"))
        chosen = (
            per_player.groupBy("source", "confidence", "lines").agg(F.min("player").alias("player"))
            .groupBy("source").agg(F.max(F.struct("confidence", "lines", "player")).alias("m"))
            .select("source", F.col("m.player").alias("player_id"), F.col("m.confidence").alias("confidence"))
        )
        return chosen.where(F.col("confidence") >= least).select(F.col("source").alias("source_player_id"), "player_id", "confidence")
