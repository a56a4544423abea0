"""Names as people type them: tokens, small edit distances, and the alignment of two names."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache, wraps

# Common English short forms, each line one family of first names.
NICKNAMES = """
abigail abby abbie
alexandra alex lexi
antoinette toni nettie
brianna bri
cassandra cass cassie
catherine cathy
charlotte charlie lottie
christina chris tina chrissy
corinne cory
danielle dani
deborah deb debbie
denise dee
elizabeth liz beth betsy eliza lizzie betty
emily em
esther essie
florence flo
frances fran frankie
gabrielle gabby
gwendolyn gwen
isabella bella izzy
jacqueline jackie
jennifer jen jenny
jessica jess jessie
josephine jo josie
katherine kate kathy katie kat kathleen
kimberly kim
kristina kris
madeline maddie maddy
margaret maggie meg peggy marge
marisol mari
melissa mel missy
michaela mickey
michelle shelly
monique mo
natasha tasha nat
nicole nikki nicky
olivia liv
pamela pam
patricia pat patty tricia trish
penelope penny
philippa pip pippa
rebecca becky becca
regina gina
roberta bobbie
rosemary rosie
samantha sam sammie
selena lena
stephanie steph stevie
susannah susan sue susie
tabitha tabby
theresa teresa terri tess
valerie val
veronica ronnie
victoria vicky tori
vivian viv
whitney whit
wilhelmina willa billie mina minnie
winifred winnie
yolanda yoli
"""

FAMILIES: dict[str, frozenset[int]] = {}
for _n, _line in enumerate(NICKNAMES.split("\n")):
    for _name in _line.split():
        FAMILIES[_name] = FAMILIES.get(_name, frozenset()) | {_n}

INITIALS: dict[str, frozenset[str]] = {n: frozenset(m[0] for m in FAMILIES if FAMILIES[m] & of) for n, of in FAMILIES.items()}

SUFFIXES = frozenset("jr sr ii iii iv dr ms mrs mr miss".split())
_DIGITS = str.maketrans("01345", "oleas")
LONG = 400
FEW_WORDS, MANY_WORDS = 8, 40


def fold(text: str) -> str:
    """Lower case without accents; UTF-8 read as Latin put right, ligatures and compatibility forms taken apart."""
    if text.isascii():
        return text.lower()
    if "Ã" in text or "Â" in text:
        for codec in ("cp1252", "latin-1"):
            try:
                text = text.encode(codec).decode("utf-8")
                break
            except UnicodeError:
                continue
    flat = unicodedata.normalize("NFKD", text)
    return "".join(c for c in flat if not unicodedata.combining(c)).lower().replace("ß", "ss").replace("ø", "o").replace("ł", "l")


def cached(most: int) -> Callable[[Callable], Callable]:
    """A function of texts whose results are kept, up to ``most`` of them; long texts are worked out anew, so what is kept is bounded in bytes too."""

    def wrap(f: Callable) -> Callable:
        kept = lru_cache(maxsize=most)(f)

        @wraps(f)
        def run(text: str, *more: object) -> object:
            if len(text) > LONG or more and isinstance(more[0], str) and len(more[0]) > LONG:
                return f(text, *more)
            return kept(text, *more)

        return run

    return wrap


@cached(200_000)
def tokens(name: str) -> tuple[str, ...]:
    """The words of a name without bracketed nicknames; digits typed for letters put right, a glued name split at its capitals."""
    plain = name.split()
    if len(plain) > 1 and name.isascii() and all(map(str.isalpha, plain)):
        # plain words need none of what follows
        return tuple([w for w in name.lower().split() if w not in SUFFIXES])
    text = re.sub(r"\([^)]*\)|[\"“][^\"”]*[\"”]", " ", name).strip() or name.strip()
    if "Ã" not in text and not re.search(r"[\s,.]", text):
        text = re.sub(r"(?<=[a-zß-ÿ])(?=[A-ZÀ-Þ])", " ", text)
    words = re.findall(r"[^\W_]+", re.sub(r"['’`´]", "", fold(text)))
    words = [w if w.isalpha() else w.translate(_DIGITS) if re.search(r"[a-z]", w) else w for w in words]
    return tuple([w for w in words if w not in SUFFIXES])


@cached(500_000)
def edits(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions of neighbours, or most + 1 if it is greater. Only the band that ``most`` edits can reach is filled."""
    if a == b:
        return 0
    over = most + 1
    if abs(len(a) - len(b)) > most:
        return over
    before: dict[int, int] = {}
    row = {j: j for j in range(min(most, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {0: i} if i <= most else {}
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            d = min(row.get(j, over) + 1, new.get(j - 1, over) + 1, row.get(j - 1, over) + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before.get(j - 2, over) + 1)
            new[j] = d
        if min(new.values()) > most:
            return over
        before, row = row, new
    return min(row.get(len(b), over), over)


def allowed_edits(length: int) -> int:
    return 0 if length < 3 else 1 if length < 6 else 2 if length < 11 else 3


@cached(500_000)
def token_likeness(a: str, b: str) -> float:
    """1 for equal words, less for short forms, initials and typing errors, 0 for different words."""
    if a == b:
        return 1.0 if len(a) > 1 else 0.8
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if len(short) == 1:
        return 0.75 if long[0] == short else 0.7 if short in INITIALS.get(long, "") else 0.0
    if FAMILIES.get(a, frozenset()) & FAMILIES.get(b, frozenset()):
        return 0.95
    most = allowed_edits(len(long))
    d = edits(a, b, most)
    if d <= most:
        # of short words one edit says little
        return 1.0 - d / (len(long) + 1.0) * (1.0 if len(short) > 3 else 1.4)
    if len(short) >= 3 and long.startswith(short):
        return 0.88
    # short forms in -y or -ie, and those that keep the end of the name
    stem = short[:-2] if short.endswith("ie") else short[:-1] if short.endswith("y") else ""
    if len(stem) >= 3 and (long.startswith(stem) or stem[-1] == stem[-2] and long.startswith(stem[:-1])):
        return 0.86
    if len(short) >= 5 and long.endswith(short[1:]) and len(long) - len(short) >= 2:
        return 0.84
    return 0.0


def _assigned(like: list[list[float]]) -> list[tuple[int, int]]:
    """An optimal assignment of rows to columns, no more rows than columns, by shortest augmenting paths."""
    n, m = len(like), len(like[0])
    of_row, of_column, taken = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        taken[0], at = i, 0
        least, came, seen = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while taken[at]:
            seen[at], row, step, then = True, taken[at], float("inf"), 0
            for j in range(1, m + 1):
                if not seen[j]:
                    cost = -like[row - 1][j - 1] - of_row[row] - of_column[j]
                    if cost < least[j]:
                        least[j], came[j] = cost, at
                    if least[j] < step:
                        step, then = least[j], j
            for j in range(m + 1):
                if seen[j]:
                    of_row[taken[j]] += step
                    of_column[j] -= step
                else:
                    least[j] -= step
            at = then
        while at:
            taken[at], at = taken[came[at]], came[at]
    return [(taken[j] - 1, j - 1) for j in range(1, m + 1) if taken[j]]


def align(a: tuple[str, ...], b: tuple[str, ...]) -> list[tuple[int, int, float]]:
    """The pairs of tokens of an optimal assignment: the greatest sum of likenesses, each token used once.

    Names of more than ``MANY_WORDS`` words each are texts rather than names: their equal words are paired, others not.
    """
    if len(a) > len(b):
        return [(i, j, s) for j, i, s in align(b, a)]
    if len(a) > MANY_WORDS:
        spots = defaultdict(list)
        for j in range(len(b) - 1, -1, -1):
            spots[b[j]].append(j)
        return [(i, spots[x].pop(), 1.0) for i, x in enumerate(a) if spots[x]]
    like = [[token_likeness(x, y) for y in b] for x in a]
    if len(a) > FEW_WORDS:
        return [(i, j, like[i][j]) for i, j in sorted(_assigned(like)) if like[i][j] > 0]
    best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
    for i in range(len(a)):
        step: dict[int, tuple[float, tuple]] = {}
        for used, (total, pairs) in best.items():
            for choice in [(used, total, pairs)] + [(used | 1 << j, total + like[i][j], (*pairs, (i, j, like[i][j]))) for j in range(len(b)) if like[i][j] > 0 and not used >> j & 1]:
                if choice[0] not in step or step[choice[0]][0] < choice[1]:
                    step[choice[0]] = choice[1:]
        best = step
    return list(max(best.values(), key=lambda x: x[0])[1])


@cached(500_000)
def name_likeness(a: str, b: str, common: tuple[str, ...] = ()) -> tuple[float, int, int, int]:
    """(likeness of the aligned tokens, full words aligned, initials aligned, full words left over on the fuller side).

    The likeness is 0 if words of both names find no partner, if a name with a
    word to spare only matches by an initial, if no full words align at all, or
    if two aligned words differ although both are in ``common``, the words too
    frequent to be a typing error of one another. A name run together is
    compared as a whole.
    """
    x, y = tokens(a), tokens(b)
    if not x or not y:
        return 0.0, 0, 0, 0
    if len(x) != len(y) and (len(x) == 1 or len(y) == 1):
        whole_x, whole_y = "".join(x), "".join(y)
        if min(len(whole_x), len(whole_y)) > 5:
            d = edits(whole_x, whole_y, 2)
            if d <= 2:
                return 1.0 - d / (len(whole_y) + 1.0), 2, 0, 0
    pairs = align(x, y)
    in_x, in_y = {p[0] for p in pairs}, {p[1] for p in pairs}
    full = sum(1 for i, j, _ in pairs if len(x[i]) > 1 and len(y[j]) > 1)
    initials = len(pairs) - full
    spare_x, spare_y = [w for i, w in enumerate(x) if i not in in_x], [w for j, w in enumerate(y) if j not in in_y]
    if full > 1:
        # first name and surname are there, so an initial to spare is a middle one
        spare_x, spare_y = [w for w in spare_x if len(w) > 1], [w for w in spare_y if len(w) > 1]
    full_x, full_y = [w for w in spare_x if len(w) > 1], [w for w in spare_y if len(w) > 1]
    left = len(full_x) + len(full_y)
    by_initial_x = any(len(x[i]) == 1 < len(y[j]) for i, j, _ in pairs)
    by_initial_y = any(len(y[j]) == 1 < len(x[i]) for i, j, _ in pairs)
    if not full or full_x and spare_y or full_y and spare_x or full_x and by_initial_x or full_y and by_initial_y:
        return 0.0, full, initials, left
    score = 1.0
    for i, j, s in pairs:
        u, w = x[i], y[j]
        if len(u) > 1 and len(w) > 1:
            if u != w and u in common and w in common and not FAMILIES.get(u, frozenset()) & FAMILIES.get(w, frozenset()):
                return 0.0, full, initials, left
            score *= s
        else:
            score *= 0.97
    return score, full, initials, left
