"""What the columns of the released tables mean."""

from __future__ import annotations

# The meaning of each column that has one beyond its name.
MEANINGS = {
    "league": "The league the row belongs to, wfa or wnfc.",
    "season": "The year of the season.",
    "team_id": "The id of the team, one and the same in all tables.",
    "team_number": "The number the source gives the team, if any.",
    "team_city": "The town or area the team names itself after.",
    "team_name": "The team's name without blanks around it.",
    "tier": "The level of play of a wfa team.",
    "conference": "The conference the team plays in, if any.",
    "division": "The division the team plays in, if any.",
    "region": "The region the team plays in, if any.",
    "player_id": "The id of the player as the rosters give it; null where no player was found.",
    "source_player_id": "The id game files give the player; it is of another kind than player_id.",
    "player_name": "The player's name as typed.",
    "roster_number": "The number on the player's shirt, as typed.",
    "position": "The position the roster gives the player.",
    "height": "The player's height, in whatever notation it was typed.",
    "weight": "The player's weight, in whatever notation it was typed.",
    "school": "The school or college the player names.",
    "hometown": "The town the player names.",
    "game_id": "The id of the game.",
    "season_type": "Whether the game is of the regular season or after it, where that can be told.",
    "week": "The week of the game within its part of the season.",
    "date": "The day of the game.",
    "visitor_team_name": "The team that travelled.",
    "visitor_score": "The points of the team that travelled.",
    "home_team_name": "The team that played at home.",
    "home_score": "The points of the team that played at home.",
    "opponent_id": "The id of the team played against.",
    "opponent_name": "The team played against.",
    "opponent_team_name": "The team played against, by the schedule.",
    "home_away": "Whether the player's team was at home or visiting, by the game file.",
    "game_location": "Whether the team was at home or away, by the schedule.",
    "wins": "Games won.",
    "losses": "Games lost.",
    "ties": "Games without a winner.",
    "win_pct": "The share of games won, 0 to 1.",
    "points_for": "Points the team made.",
    "points_against": "Points made against the team.",
    "home_record": "Results at home, as the source writes them.",
    "away_record": "Results away, as the source writes them.",
    "conference_record": "Results within the conference, as the source writes them.",
    "division_record": "Results within the division, as the source writes them.",
    "nonconference_record": "Results outside the conference, as the source writes them.",
    "nondivision_record": "Results outside the division, as the source writes them.",
    "streak": "The run of wins or losses the team is on, as the source writes it.",
    "team_logo": "Where the picture of the team's sign lies.",
    "passing_attempts": "Passes thrown.",
    "passing_completions": "Passes thrown and caught.",
    "passing_yards": "Yards won by passes thrown.",
    "pass_tds": "Touchdowns by passes thrown.",
    "passing_interceptions": "Passes thrown that the other team caught.",
    "rushing_carries": "Runs with the ball.",
    "rushing_yards": "Yards won by runs.",
    "receiving_catches": "Passes caught.",
    "receiving_yards": "Yards won by passes caught.",
    "receiving_tds": "Touchdowns by passes caught.",
    "tackles": "Tackles made alone, or as many as the source counts.",
    "tackle_assists": "Tackles helped with.",
    "tackles_combined": "Tackles made alone and helped with.",
    "sacks": "Tackles of the passer behind the line.",
    "tackles_for_loss": "Tackles that cost the other team yards.",
    "interceptions": "Passes of the other team caught.",
    "passes_deflected": "Passes of the other team knocked away.",
    "forced_fumbles": "Balls the other team was made to drop.",
    "fumble_recoveries": "Dropped balls picked up.",
    "total_points": "All points of the row's player or team.",
    "tds": "All touchdowns.",
    "two_point_conversions": "Tries for two points that succeeded.",
    "safety": "Safeties made.",
    "fg_attempts": "Field goals tried.",
    "fg_made": "Field goals made.",
    "pat_attempts": "Kicks after a touchdown tried.",
    "pat_made": "Kicks after a touchdown made.",
    "punts": "Punts kicked.",
    "kickoff_returns": "Kickoffs carried back.",
    "punt_returns": "Punts carried back.",
    "games_with_stats": "The number of games in which there are statistics of the player; games played may be more.",
    "games_scheduled": "The number of the team's games in the schedule.",
    "has_canonical_player": "Whether the row's player was found among the players.",
    "canonical_player_name": "The player's name in the table of players.",
}


def describe(column: str) -> str:
    """A column's meaning; of a column without one its name as words."""
    return MEANINGS.get(column, " ".join(w.upper() if w in ("id", "fg", "pat", "td", "tds", "pct") else w for w in column.split("_")).capitalize() + ".")
