"""Variant spellings of names typed by people.

Method: a symmetric-delete neighbourhood index on name tokens. Every token is
filed under its first letters and all forms of them with one letter deleted, so
two tokens at a small edit distance meet. Persons are sent to workers by what
they must share, a home town or a school, and the index is built there, over the
persons of one town or school; towns and schools with too many persons are cut
by form and then into shares that all meet, so that no bucket is hot and the
size of one decides nothing. Candidates are then aligned token by token with an
optimal assignment that permits initials, short forms and spare middle names,
and weighed with the attributes. Persons with several ids are the classes of
the links.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce, wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import NULL_TOKENS, id_key, valued
from ..session import join_counted, materialise, shuffle_partitions
from .components import linked_classes
from .names import allowed_edits, cached, edits, fold, name_likeness, tokens

# Short forms of school kinds.
SCHOOL_WORDS = {"univ": "university", "uni": "university", "coll": "college", "hs": "high school", "sch": "school", "st": "state"}
_HUMAN_INCHES = (42, 90)
PREFIX = 4

PERSON = "person string, name string, town string, school string, height int, weight int"


def _value(text: str | None) -> str | None:
    text = (text or "").strip(" \t\r\n\f\x0b ")
    return None if text in NULL_TOKENS else text


def maybe(f: Callable[[str], object]) -> Callable[[str | None], object]:
    """``f`` for texts that are given, results kept: notations repeat."""
    kept = cached(200_000)(f)
    return wraps(f)(lambda text: None if text is None else kept(text))


@maybe
def inches(text: str | None) -> int | None:
    """5-4, 5'4", 5 ft 4, 5-04 or 64 as inches; cm where the number is that large; null where it is no height."""
    text = _value(text)
    if not text:
        return None
    m = re.match(r"^(\d)\s*(?:-|'|’|ft\.?|feet)\s*(\d{1,2})?\s*(?:\"|”|''|in\.?)?$", text)
    if m:
        n = int(m[1]) * 12 + int(m[2] or 0)
    elif m := re.match(r"^(\d{2,3})(?:\.\d+)?\s*(?:cm|in|\")?\.?$", text):
        n = int(m[1]) if int(m[1]) < 100 else round(int(m[1]) / 2.54)
    else:
        return None
    return n if _HUMAN_INCHES[0] <= n < _HUMAN_INCHES[1] else None


@maybe
def pounds(text: str | None) -> int | None:
    """165, 165 lbs, 165lb or 75 kg as pounds; 0 and other impossible weights are null."""
    m = re.match(r"^(\d{2,3})(?:\.\d+)?\s*(kg|lbs?|pounds)?\.?$", (_value(text) or "").lower())
    if not m:
        return None
    n = round(int(m[1]) * 2.2046) if m[2] == "kg" else int(m[1])
    return n if 60 <= n < 600 else None


@maybe
def place(text: str | None) -> str | None:
    """A town without case, accents, marks and what follows a comma."""
    text = _value(text)
    return re.sub(r"[^a-z]+", " ", fold(text.split(",")[0])).strip() or None if text else None


@maybe
def school_name(text: str | None) -> str | None:
    """A school without case, accents and marks, its short words written out."""
    text = _value(text)
    if not text:
        return None
    words = re.sub(r"[^a-z]+", " ", fold(text)).split()
    return " ".join(w if n == 0 else SCHOOL_WORDS.get(w, w) for n, w in enumerate(words)) or None


@cached(200_000)
def deletes(token: str) -> frozenset[str]:
    """The forms a token is filed under: its first letters, whole and with any one of them deleted; short tokens stay as they are.

    Two tokens one edit apart share a form wherever the edit is, and so do many
    that differ more, if they do so after their first letters.
    """
    head = token[:PREFIX]
    return frozenset([head, *(head[:i] + head[i + 1 :] for i in range(len(head)))]) if allowed_edits(len(token)) else frozenset([token])


def word_forms(name: str) -> set[str]:
    """All forms of a name's words; initials have none."""
    return {form for word in tokens(name) if len(word) > 1 for form in deletes(word)}


def clean_persons(players: DataFrame) -> DataFrame:
    """One row per id: its last loaded record, attributes brought to one notation. Ids and names that are no value are left out."""
    raw = ["player_name", "height", "weight", "school", "hometown"]
    newest = (
        players.select(id_key("player_id").alias("person"), "loaded_at", *[F.col(c).cast("string") for c in raw])
        .where("person is not null and person <> 'PTEAM'")
        .groupBy("person").agg(F.max(F.struct("loaded_at", *raw)).alias("r")).select("person", "r.*").drop("loaded_at")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in raw}
            names = [n if n and tokens(n) else None for n in map(_value, columns["player_name"])]
            read = [[f(x) for x in columns[c]] for c, f in (("hometown", place), ("school", school_name), ("height", inches), ("weight", pounds))]
            arrays = [batch.column("person"), *(pa.array(v, field.type) for v, field in zip([names, *read], list(_PERSON)[1:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=_PERSON).filter(arrays[1].is_valid())

    return newest.mapInArrow(run, PERSON)


_PERSON = pa.schema([("person", pa.string()), ("name", pa.string()), ("town", pa.string()), ("school", pa.string()), ("height", pa.int32()), ("weight", pa.int32())])


def common_words(persons: DataFrame, least: int = 5, share: float = 0.15) -> DataFrame:
    """(word): tokens that too many persons bear to be a typing error of a more frequent one.

    A word counts as common if at least ``least`` persons bear it and at least
    ``share`` of the bearers of the most borne word in its delete
    neighbourhood. Counted over all persons.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [w for name in batch.column("name").to_pylist() for w in set(tokens(name)) if len(w) > 1]
            yield pa.RecordBatch.from_pydict({"word": pa.array(out, pa.string())})

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(w, f, n) for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()) for f in deletes(w)]
            yield pa.RecordBatch.from_pydict({"word": pa.array([p[0] for p in pairs], pa.string()), "form": pa.array([p[1] for p in pairs], pa.string()), "n": pa.array([p[2] for p in pairs], pa.int64())})

    counted = persons.select("name").mapInArrow(words, "word string").groupBy("word").agg(F.count("*").alias("n"))
    spread = counted.mapInArrow(forms, "word string, form string, n long")
    top = spread.groupBy("form").agg(F.max("n").alias("top"))
    nearest = spread.where(F.col("n") >= least).join(top.hint("merge"), "form").groupBy("word", "n").agg(F.max("top").alias("top"))
    return nearest.where(F.col("n") >= F.col("top") * share).select("word")


def with_common_words(persons: DataFrame) -> DataFrame:
    """persons with ``common``: which of the person's own words are common."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(p, w) for p, name in zip(batch.column("person").to_pylist(), batch.column("name").to_pylist()) for w in set(tokens(name)) if len(w) > 1]
            yield pa.RecordBatch.from_pydict({"person": pa.array([p[0] for p in pairs], pa.string()), "word": pa.array([p[1] for p in pairs], pa.string())})

    # the collected set is of the words of one name
    mine = persons.select("person", "name").mapInArrow(words, "person string, word string")
    own = join_counted(mine, materialise(common_words(persons)), ["word"]).groupBy("person").agg(F.collect_set("word").alias("common"))
    return persons.join(own.hint("merge"), "person", "left")


def same_person(a: dict, b: dict) -> bool:
    """Whether two records, brought to one notation, are of one person.

    Heights may differ by an inch and weights by some fifteen pounds, towns by
    a typing error; a school or town that is another one parts them. The less
    the attributes say, the closer the names must be.
    """
    ha, hb, wa, wb = a["height"], b["height"], a["weight"], b["weight"]
    if ha is not None and hb is not None and abs(ha - hb) > 1 or wa is not None and wb is not None and abs(wa - wb) > 16:
        return False
    sure = (ha is not None and hb is not None) + (wa is not None and wb is not None)
    if a["school"] and b["school"] and a["school"] != b["school"]:
        return False
    school = bool(a["school"] and b["school"])
    town, slip = False, False
    if a["town"] and b["town"]:
        town = True
        if a["town"] != b["town"]:
            slip = True
            if edits(a["town"], b["town"], 2) > 2:
                return False
    places = town + school - 0.5 * slip
    common = tuple(sorted(set(a["common"] or ()) | set(b["common"] or ())))
    likeness, full, initials, left = name_likeness(a["name"], b["name"], common)
    if likeness <= 0:
        return False
    weak = full < 2
    if places >= 2:
        least = 0.5 if sure == 2 else 0.6 if sure == 1 else 0.75
        return likeness >= least and (not weak or initials > 0)
    if places >= 1:
        least = 0.6 if sure == 2 else 0.7 if sure == 1 else 0.9
        return likeness >= least and (not weak or initials > 0 and sure >= 1)
    return False


_RECORD = ("person", "name", "town", "school", "height", "weight", "common")
_FILED = "key long, block long, form_filed boolean, side int, person string, name string, town string, school string, height int, weight int, common array<string>"
_COLUMNS = [f.split()[0] for f in _FILED.split(", ")]


def _hash(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("|".join(map(str, parts))) - (1 << 63)


def _filed_by_form(rows: DataFrame) -> DataFrame:
    """``rows`` once for each form of a word of the name, under keys of their block and that form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [[_hash(block, form) for form in word_forms(name)] for name, block in zip(batch.column("name").to_pylist(), batch.column("block").to_pylist())]
            taken = batch.take(pa.array([n for n, own in enumerate(given) for _ in own], pa.int64()))
            yield taken.set_column(taken.schema.get_field_index("key"), "key", pa.array([k for own in given for k in own], pa.int64()))

    return rows.withColumn("form_filed", F.lit(True)).select(_COLUMNS).mapInArrow(run, _FILED)


def _parted(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of the keys that at most ``most`` rows have, the rows of the others with n, or nothing if there are none)."""
    hot = materialise(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most))
    if hot.isEmpty():
        return rows, None
    return join_counted(rows, hot.select("key"), ["key"], "left_anti").select(_COLUMNS), materialise(join_counted(rows, hot, ["key"]))


def _tiled(rows: DataFrame, most: int) -> DataFrame:
    """Rows of a key cut into shares of about ``most``, each share once with every other: no task holds more than two, and every pair still meets."""
    shares = F.ceil(F.col("n") / F.lit(most)).cast("int")
    own = F.pmod(F.xxhash64("person"), shares).cast("int")
    with_other = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), shares - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return with_other.withColumn("side", F.when(low != high, (F.col("own") == high).cast("int"))).withColumn("key", F.xxhash64("key", low, high)).select(_COLUMNS)


def filed_persons(persons: DataFrame, most: int) -> DataFrame:
    """Persons once per given attribute; where more than ``most`` share a key, they are filed so that fewer meet at once.

    Whole towns and schools first, where those that share a delete form of a
    word are compared; those with too many persons by these forms; forms with
    too many share by share. All three compare the same pairs, so how many
    persons share a key decides nothing.
    """
    attributes = F.array(*[F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), c)) for c in ("town", "school")])
    rows = persons.withColumn("block", F.explode(F.filter(attributes, lambda x: x.isNotNull()))).withColumns({"key": F.col("block"), "form_filed": F.lit(False), "side": F.lit(None).cast("int")}).select(_COLUMNS)
    filed, hot = _parted(rows, most)
    if hot is None:
        return filed
    cold, hot = _parted(materialise(_filed_by_form(hot)), most)
    filed = filed.unionByName(cold)
    return filed if hot is None else filed.unionByName(_tiled(hot, most))


def _near(at: list[int], height: np.ndarray, weight: np.ndarray, school: np.ndarray, side: list[int | None]) -> Iterator[tuple[int, int]]:
    """The pairs of positions whose heights and weights, where both are given, are near, whose schools are the same, and that a tile compares."""
    if len(at) > 24:
        own = np.array(at)
        for n, i in enumerate(at[:-1]):
            rest = own[n + 1 :]
            # a missing number is NaN, and no comparison with it holds
            far = (np.abs(height[rest] - height[i]) > 1) | (np.abs(weight[rest] - weight[i]) > 16) | (np.abs(school[rest] - school[i]) > 0)
            for j in rest[~far].tolist():
                if side[i] is None or side[i] != side[j]:
                    yield i, j
    else:
        for n, i in enumerate(at[:-1]):
            for j in at[n + 1 :]:
                if not (abs(height[i] - height[j]) > 1 or abs(weight[i] - weight[j]) > 16 or abs(school[i] - school[j]) > 0) and (side[i] is None or side[i] != side[j]):
                    yield i, j


def compare_filed(table: pa.Table) -> pa.Table:
    """(a, b), a < b: the persons of one person among those filed under the same keys that share a delete form of a word."""
    side, form_filed, names = (table[c].to_pylist() for c in ("side", "form_filed", "name"))
    height, weight = (table[c].cast(pa.float64()).to_numpy() for c in ("height", "weight"))
    # schools as numbers, NaN where none is given
    school = table["school"].combine_chunks().dictionary_encode().indices.cast(pa.float64()).to_numpy(zero_copy_only=False)
    filed: dict[int, list[int]] = {}
    for n, key in enumerate(table["key"].to_pylist()):
        filed.setdefault(key, []).append(n)
    pairs: set[tuple[int, int]] = set()
    for rows in filed.values():
        if len(rows) < 2:
            continue
        if form_filed[rows[0]]:
            pairs.update(_near(rows, height, weight, school, side))
            continue
        index: dict[str, list[int]] = {}
        for n in rows:
            for form in word_forms(names[n]):
                if form in index:
                    index[form].append(n)
                else:
                    index[form] = [n]
        for at in index.values():
            if len(at) > 1:
                pairs.update(_near(at, height, weight, school, side))
    used = sorted({n for pair in pairs for n in pair})
    record = dict(zip(used, table.select(_RECORD).take(pa.array(used, pa.int64())).to_pylist()))
    links = sorted({tuple(sorted((record[i]["person"], record[j]["person"]))) for i, j in pairs if same_person(record[i], record[j])})
    return pa.table({"a": pa.array([x[0] for x in links], pa.string()), "b": pa.array([x[1] for x in links], pa.string())})


def spelling_links(persons: DataFrame, most: int = 2_000) -> DataFrame:
    """(a, b), a < b: persons found to be one; a pair may come out once per attribute it shares."""
    filed = filed_persons(persons, most)
    # several keys go to a worker at once: a group holds some thousand rows whatever the number of keys
    groups = max(shuffle_partitions(persons.sparkSession), -(-filed.count() // (2 * most)))
    return filed.groupBy(F.pmod("key", F.lit(groups)).alias("g")).applyInArrow(compare_filed, "a string, b string")


def link_spellings(players: DataFrame, most: int = 2_000) -> DataFrame:
    """(person, class_id) of every id that shares its person with another id.

    players: (player_id, player_name, height, weight, school, hometown,
    loaded_at), further columns ignored. Ids differing in case or blanks are
    one id; repeated rows count once, the last loaded row speaks for its id.
    Ids without a name, and names without any letter or digit, are linked to
    nothing, nor are those with neither town nor school. Exact copies under
    many ids are represented by the smallest of them, so no group is expanded
    into pairs; they join it if the record says enough to be linked to one like
    itself, or is linked to another. ``most`` bounds the rows that are compared
    under one key before they are filed anew; it changes no result.
    """
    persons = materialise(clean_persons(players))
    shown = ["name", "town", "school", "height", "weight"]
    unique = materialise(with_common_words(persons.groupBy(*shown).agg(F.min("person").alias("person"), F.count("*").alias("copies"))))
    classes = materialise(linked_classes(spelling_links(unique, most)))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [r["class_id"] is not None or bool(r["town"] and r["school"] and (r["height"] is not None or r["weight"] is not None)) or same_person(r, r) for r in batch.to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    # copies that say enough to be linked to themselves are of one person; bare names are not
    copied = unique.where("copies > 1").join(classes.select(F.col("id").alias("person"), "class_id").hint("merge"), "person", "left")
    copied = materialise(copied.select(*_RECORD, "class_id").mapInArrow(told, copied.select(*_RECORD, "class_id").schema))
    given = copied.select(*[F.col(c).alias(f"x_{c}") for c in shown], F.coalesce("class_id", "person").alias("class_id"))
    members = join_counted(persons, given, [F.col(c).eqNullSafe(F.col(f"x_{c}")) for c in shown]).select("person", "class_id")
    return classes.select(F.col("id").alias("person"), "class_id").union(members).distinct()


def pairs_of_classes(classes: DataFrame) -> DataFrame:
    """(player_id_a, player_id_b) of all ids of one person, smaller first. A person has few ids; copies are a form of the result."""
    x, y = classes.alias("x"), classes.alias("y")
    return x.join(y, "class_id").where("x.person < y.person").select(F.col("x.person").alias("player_id_a"), F.col("y.person").alias("player_id_b"))


def spellings_of_persons(classes: DataFrame, typed: dict[str, DataFrame]) -> DataFrame:
    """(person, spelling, n_<source> of each source, main_spelling, likeness, agrees): the names typed for the ids of each person.

    classes: ``link_spellings``; typed: (player_id, player_name) by source. A
    person without links is its own id. The main spelling is the one typed most
    often in full words, ties by text. A spelling agrees if its aligned
    tokens make it a variant of the main one; names that are no value, and ids
    that are none, are left out, as is the line of a whole team.
    """
    counted = []
    for source, df in typed.items():
        rows = df.select(id_key("player_id").alias("id"), valued("player_name").alias("spelling")).where("id is not null and id <> 'PTEAM' and spelling is not null")
        counted.append(rows.groupBy("id", "spelling").agg(F.count("*").alias("n")).withColumn("source", F.lit(source)))
    rows = reduce(DataFrame.unionByName, counted)
    of_person = rows.join(classes.select(F.col("person").alias("id"), "class_id").hint("merge"), "id", "left").withColumn("person", F.coalesce("class_id", "id"))
    numbers = [F.coalesce(F.sum(F.when(F.col("source") == s, F.col("n"))), F.lit(0)).alias(f"n_{s}") for s in typed]
    known = materialise(of_person.groupBy("person", "spelling").agg(F.sum("n").alias("n"), *numbers))
    # a name of whole words before one with an initial
    whole = (~F.col("spelling").rlike(r"(?:^|\s)\p{L}(?:\.|\s|$)")).cast("int")
    main = known.groupBy("person").agg(F.max_by("spelling", F.struct(whole, "n", "spelling")).alias("main_spelling"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = [name_likeness(a, b)[0] for a, b in zip(batch.column("spelling").to_pylist(), batch.column("main_spelling").to_pylist())]
            yield batch.append_column("likeness", pa.array(like, pa.float64())).append_column("agrees", pa.array([x > 0 for x in like]))

    kept = known.drop("n").join(main.hint("merge"), "person")
    return kept.mapInArrow(compare, ", ".join(f"{name} {kind}" for name, kind in kept.dtypes) + ", likeness double, agrees boolean")
