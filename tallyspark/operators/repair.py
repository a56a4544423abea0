"""Repair of malformed JSON texts and classification of invalid responses.

Texts are repaired on the workers, one Arrow batch at a time; a repair is a
list of named steps tried in order, each on the result of the one before.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .relational import one_of

# a JSON string, closed or running to the end of the text
_STRING = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?\Z)', re.S)
_PAIR_OR_CONTROL = re.compile(r"\\.|[\x00-\x1f]", re.S)
_NAMED = {"\t": r"\t", "\n": r"\n", "\r": r"\r", "\b": r"\b", "\f": r"\f"}
_CLOSER = {"{": "}", "[": "]"}
NEAR_END = 12


def escape_controls(text: str) -> str:
    """Control characters inside double-quoted strings written as escapes; what follows a backslash stays as it is."""

    def written(part: re.Match) -> str:
        c = part[0]
        return c if len(c) > 1 else _NAMED.get(c, f"\\u{ord(c):04x}")

    return _STRING.sub(lambda quoted: _PAIR_OR_CONTROL.sub(written, quoted[0]), text)


def drop_trailing_commas(text: str) -> str:
    return re.sub(r",\s*(?=[}\]])", "", text)


def close_empty_arrays(text: str) -> str:
    """``[ }]`` is an empty array whose brackets were muddled."""
    return re.sub(r"\[\s*\}\s*\]", "[]", text)


def _delimiters(text: str) -> Iterator[tuple[int, str]]:
    blank = _STRING.sub(lambda m: " " * len(m[0]), text)
    return ((m.start(), m[0]) for m in re.finditer(r"[{}\[\]]", blank))


def missing_closers(text: str) -> str | None:
    """What closes the open delimiters, or null if nothing is open or the closers don't nest."""
    stack: list[str] = []
    for _, c in _delimiters(text):
        if c in _CLOSER:
            stack.append(c)
        elif stack and _CLOSER[stack[-1]] == c:
            stack.pop()
        else:
            return None
    return "".join(_CLOSER[c] for c in reversed(stack)) or None


def trim_extra_closers(text: str) -> str:
    """The text up to the end of its last complete root, if only closers, commas and blanks follow."""
    stack: list[str] = []
    end = None
    for at, c in _delimiters(text):
        if c in _CLOSER:
            stack.append(c)
        elif stack and _CLOSER[stack[-1]] == c:
            stack.pop()
            end = at if not stack else end
        elif end is None:
            return text
    return text[: end + 1] if end is not None and re.fullmatch(r"[\s,\]}]*", text[end + 1 :]) else text


def _parse(text: str) -> tuple[object, json.JSONDecodeError | None]:
    try:
        return json.loads(text), None
    except json.JSONDecodeError as e:
        return None, e


def _literal(text: str) -> tuple[object, str | None]:
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError) as e:
        return None, str(e)
    return value, None if isinstance(value, (dict, list, tuple, str, int, float, bool, type(None))) else f"unsupported literal {type(value).__name__}"


def _empty_player_stats(text: str, endpoint: str | None) -> bool:
    compact = re.sub(r"\s+", "", text)
    return endpoint == "stats" and '"player_stat_totals"' in compact and compact.endswith("[{]}")


def _is_literal(text: str) -> bool:
    return text.startswith(("{", "[", "(", "'", '"')) and _literal(text)[1] is None


def recovery_category(text: str, endpoint: str | None) -> str:
    """What kind of repair a text is up for; the endpoint is asked before the literal test."""
    body = text.strip()
    if not body:
        return "UNSUPPORTED"
    if _empty_player_stats(body, endpoint):
        return "EMPTY_PLAYER_STATS"
    if _parse(body)[1] is None:
        return "VALID_JSON"
    if endpoint in ("games", "standings"):
        return "MALFORMED_GAME_DATA" if endpoint == "games" else "MALFORMED_STANDINGS_DATA"
    return "PYTHON_LITERAL" if _is_literal(body) or _is_literal(escape_controls(body)) else "UNSUPPORTED"


def _after(steps: list[tuple[str, str]]) -> str:
    return "+".join(name for name, _ in steps)


def _repair_literal(text: str) -> tuple[object, str | None, str | None]:
    escaped = escape_controls(text)
    prefix = ["escape_raw_control_characters"] if escaped != text else []
    value, error = _parse(escaped)
    if value is not None:
        return value, "+".join(prefix) or "json_parse", None
    literal, why = _literal(escaped)
    if why is not None:
        return None, None, f"json: {error}; literal: {why}"
    try:
        return json.loads(json.dumps(literal, ensure_ascii=False)), "+".join([*prefix, "ast_literal_eval"]), None
    except (TypeError, ValueError) as e:
        return None, None, f"literal has no JSON form: {e}"


def _repair_game(text: str) -> tuple[object, str | None, str | None]:
    rules, now = [], text
    for name, step in (("escape_raw_control_characters", escape_controls), ("repair_malformed_empty_arrays", close_empty_arrays)):
        new = step(now)
        if new != now:
            rules.append(name)
        now = new
    value, error = _parse(now)
    if value is None:
        return None, "+".join(rules) or None, str(error) if error else "the value is null"
    return value, "+".join(rules) or "json_parse", None


def _repair_standings(text: str) -> tuple[object, str | None, str | None]:
    rules, now, errors = [], text, []
    for name, step in (("escape_raw_control_characters", escape_controls), ("remove_trailing_commas", drop_trailing_commas), ("trim_trailing_extra_closers", trim_extra_closers)):
        new = step(now)
        if new != now:
            rules.append(name)
            now = new
        elif errors:
            continue
        value, error = _parse(now)
        if value is not None:
            return value, "+".join(rules) or "json_parse", None
        errors.append(f"{name}: {error}")
    value, error = _parse(now)
    closers = missing_closers(now)
    if error is not None and closers and error.pos >= max(0, len(now.rstrip()) - NEAR_END):
        value, error = _parse(now.rstrip() + closers)
        if value is not None:
            return value, "+".join([*rules, f"append_missing_closers:{closers}"]), None
        errors.append(f"append_missing_closers: {error}")
    return None, "+".join(rules) or None, "; ".join(errors)


_REPAIRS = {"PYTHON_LITERAL": _repair_literal, "MALFORMED_GAME_DATA": _repair_game, "MALFORMED_STANDINGS_DATA": _repair_standings}


def recover(text: str, endpoint: str | None) -> dict:
    """category, success, recovery_rule, parse_error and the recovered JSON text; a JSON ``null`` counts as not recovered."""
    category = recovery_category(text, endpoint)
    if category not in _REPAIRS:
        return {"category": category, "success": False, "recovery_rule": None, "parse_error": None, "recovered": None}
    value, rule, error = _REPAIRS[category](text.strip())
    done = value is not None
    return {"category": category, "success": done, "recovery_rule": rule, "parse_error": None if done else error, "recovered": json.dumps(value, ensure_ascii=False, indent=2) if done else None}


# What marks a response that holds no data, a page of HTML, an error of the service.
NO_DATA = ("no data", "no records", "not found", "no roster", "no standings", "no stats", "no games", "nothing found", "does not exist", "doesn't exist", "not available", "unavailable", "have not yet published", "has not yet published", "have not published", "has not published", "not yet published", "no data avaiable yet", "no data available yet")
HTML = ("<!doctype html", "<html", "<body", "<head", "</html>")
API_ERROR = ("internal server error", "bad gateway", "service unavailable", "gateway timeout", "unauthorized", "forbidden", "too many requests", "rate limit", "error code", '"error"', "'error'", "exception", "traceback", "php warning", "php fatal")

# Which reasons a repair may be tried for, and what to do.
RECOVERABLE = ("VALID_JSON_MARKED_INVALID", "PYTHON_LITERAL", "MALFORMED_GAME_DATA", "MALFORMED_STANDINGS_DATA", "MALFORMED_JSON")
NOT_RECOVERABLE = ("EMPTY", "NO_DATA", "EMPTY_PLAYER_STATS", "HTML_RESPONSE", "API_ERROR", "TEXT_RESPONSE", "UNKNOWN")


def _parse_kind(text: str) -> str:
    body = text.strip()
    if _parse(body)[1] is None:
        return "json"
    return "literal" if _is_literal(body) else ""


@F.arrow_udf(T.StringType())
def parse_kind(texts: pa.Array) -> pa.Array:
    """json, literal or empty: the two tests of a text that only a parser can make."""
    return pa.array([_parse_kind(t or "") for t in texts.to_pylist()])


@F.arrow_udf(T.DoubleType())
def printable_share(texts: pa.Array) -> pa.Array:
    bodies = [(t or "").strip() for t in texts.to_pylist()]
    return pa.array([sum(c.isprintable() or c in "\r\n\t" for c in b) / len(b) if b else 0.0 for b in bodies])


def _any_of(text: Column, phrases: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | F.contains(text, F.lit(p))
    return found


def classify_response(text: Column, endpoint: Column) -> Column:
    """The reason a response was invalid, first matching rule; a null text is EMPTY.

    The order: EMPTY, NO_DATA, EMPTY_PLAYER_STATS, HTML_RESPONSE, API_ERROR,
    VALID_JSON_MARKED_INVALID, PYTHON_LITERAL, MALFORMED_* by endpoint,
    TEXT_RESPONSE, UNKNOWN.
    """
    body = F.coalesce(F.regexp_replace(text, r"^\s+|\s+$", ""), F.lit(""))
    low, compact = F.lower(body), F.regexp_replace(body, r"\s+", "")
    looks = F.substring(body, 1, 1).isin("{", "[") | (F.contains(body, F.lit(":")) & (F.contains(body, F.lit('"')) | F.contains(body, F.lit("'"))))
    ship()
    kind = parse_kind(body)
    return (
        F.when(body == "", "EMPTY")
        .when(_any_of(low, NO_DATA), "NO_DATA")
        .when((endpoint == "stats") & F.contains(compact, F.lit('"player_stat_totals"')) & F.endswith(compact, F.lit("[{]}")), "EMPTY_PLAYER_STATS")
        .when(_any_of(low, HTML), "HTML_RESPONSE")
        .when(_any_of(low, API_ERROR), "API_ERROR")
        .when(kind == "json", "VALID_JSON_MARKED_INVALID")
        .when(kind == "literal", "PYTHON_LITERAL")
        .when(looks & (endpoint == "games"), "MALFORMED_GAME_DATA")
        .when(looks & (endpoint == "standings"), "MALFORMED_STANDINGS_DATA")
        .when(looks, "MALFORMED_JSON")
        .when(printable_share(body) >= 0.95, "TEXT_RESPONSE")
        .otherwise("UNKNOWN")
    )


def recoverable(reason: Column) -> Column:
    return one_of(reason, RECOVERABLE)


def reason_level(reason: Column) -> Column:
    """The level of a finding about responses that can't be recovered."""
    return F.when(reason.isin("NO_DATA", "EMPTY", "EMPTY_PLAYER_STATS", "TEXT_RESPONSE"), "INFO").otherwise("WARNING")


RECOVERED = "category string, success boolean, recovery_rule string, parse_error string, recovered string"


def recover_texts(df: DataFrame, text: str, endpoint: str) -> DataFrame:
    """``df`` with the repair of each text; null texts are UNSUPPORTED."""
    ship(df.sparkSession)

    @F.pandas_udf(RECOVERED)
    def run(texts: pd.Series, endpoints: pd.Series) -> pd.DataFrame:
        rows = [recover(t or "", e) for t, e in zip(texts, endpoints)]
        return pd.DataFrame(rows, columns=["category", "success", "recovery_rule", "parse_error", "recovered"])

    return df.withColumn("_r", run(F.col(text), F.col(endpoint))).select("*", "_r.*").drop("_r")
