"""Keyword-stuffed and link-list pages.

Method: a hidden Markov model labels the lines of a page as prose (code and
data included), link list, tag list or menu; a page is flagged by the share of
its characters in lines that are no prose. Emissions are Bernoulli over a few
line traits, started from stated priors and fitted by expectation
maximisation to a bounded sample of labelled pages, in which the lines of pages
that are no spam are held to be prose. The words that speak for tags are
learned from the same sample. The model is a few hundred numbers and words and
goes to the workers with the task; pages stream through them without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, spread

STATES = ("prose", "links", "tags", "menu")
TRAITS = ("url", "bare", "sentence", "code", "hashtags", "list", "vocabulary", "some_vocabulary", "repeats", "price", "bars", "labelled", "short", "lonely")

# Prior chance of each trait in a line of each state, and the weight of the prior in lines.
_PRIOR = {
    #                   prose links tags  menu
    "url":             (0.10, 0.97, 0.10, 0.05),
    "bare":            (0.01, 0.93, 0.04, 0.03),
    "sentence":        (0.35, 0.01, 0.01, 0.01),
    "code":            (0.55, 0.03, 0.04, 0.03),
    "hashtags":        (0.002, 0.01, 0.20, 0.02),
    "list":            (0.02, 0.02, 0.40, 0.50),
    "vocabulary":      (0.005, 0.20, 0.50, 0.40),
    "some_vocabulary": (0.02, 0.40, 0.65, 0.55),
    "repeats":         (0.10, 0.10, 0.85, 0.60),
    "price":           (0.01, 0.01, 0.20, 0.02),
    "bars":            (0.005, 0.01, 0.10, 0.85),
    "labelled":        (0.03, 0.001, 0.001, 0.001),
    "short":           (0.25, 0.30, 0.05, 0.20),
    "lonely":          (0.06, 0.0002, 0.01, 0.01),
}
_PRIOR_LINES = 60.0
_STAY = (0.95, 0.90, 0.90, 0.85)

_URL = re.compile(r"https?://[^\s\"'<>)\]]+")
_TAG = re.compile(r"</?[A-Za-z][^>]*>|<!--|-->|\[/?(?:url|img|b|i|link|size|color)\b[^\]]*\]", re.I)
_TOLD = re.compile(r"(?:alt|title|content|keywords?)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.I)
_CODE = re.compile(r"[{}=()\[\]$`\\]|;\s*$|\":|'\)|==|->|^\s*/\S+\s|^\s*[\"']|\w\.\w+\(|^\s*(?:-\s+)?[\w.]+:(?:\s|$)|^\s*(?:resolved|version|import|export|where|select|group by|left join|done|fi|for|test|cp|end|return)\b|@\^?\d|\w/\w+\.\w")
_LABELLED = re.compile(r"^[\s\-*]*[^\W\d][\w ]{2,24}:\s+https?://\S+$")
_SENTENCE = re.compile(r"[.!?。！？]['\")\]]*\s*(?:</\w+>\s*)*$")
_MARKS = re.compile(r"[*\-+•>]|\d+\.")
_WORD = re.compile(r"[^\W_]+")
_PRICE = re.compile(r"\bSKU\d|\b\d+[.,]\d\d\b")
_LEET = str.maketrans("013457", "oieast")


def message_and_added(text: str) -> list[str]:
    """The lines of a commit's message and the lines it adds, without their marks; a text that is no commit gives all its lines."""
    if not text.startswith("commit "):
        return text.split("\n")
    out, in_diff, header = [], False, True
    for line in text.split("\n"):
        if line.startswith("diff --git "):
            in_diff, header = True, True
        elif in_diff:
            if line.startswith("@@"):
                header = False
            elif line.startswith("+") and not (header and line.startswith("+++")):
                out.append(line[1:])
        elif line.startswith("    "):
            out.append(line[4:])
    return out


def _fold_word(word: str) -> str:
    """Lower case; digits typed in the middle of letters put right."""
    low = word.lower()
    return low.translate(_LEET) if not low.isdigit() and any(c.isdigit() for c in low) and sum(c.isdigit() for c in low) <= len(low) / 2 else low


def line_words(line: str) -> tuple[str, list[str]]:
    """(the text a reader sees, its words): addresses and mark-up taken away, texts in mark-up kept."""
    text = _URL.sub(" ", line) if "://" in line else line
    if "<" in text or "[" in text:
        told = " ".join(a or b for a, b in _TOLD.findall(text))
        text = _TAG.sub(" ", text) + " " + told
    return text, [_fold_word(w) for w in _WORD.findall(text)]


def page_traits(lines: list[str], vocabulary: frozenset[str]) -> list[int]:
    """The traits of each line, as bits in the order of TRAITS."""
    seen = [line_words(line) for line in lines]
    # one or two lines with addresses are hardly a list of links: a trait like others, weighed by the model
    few_links = sum("://" in line for line in lines) < 3
    counts = Counter(w for _, words in seen for w in words)
    out = []
    for line, (text, words) in zip(lines, seen):
        n = len(words)
        url = "://" in line
        sentence = n > 2 and _SENTENCE.search(line) is not None or "。" in line
        labelled = url and _LABELLED.match(line) is not None
        visible = text.strip()
        if url:
            visible = re.sub(r"^\s*(?:[*\-+•]|\d+\.)?\s*\[([^\]]*)\]\(\s*\)?\s*$", r"\1", visible)
        code = not sentence and _CODE.search(visible) is not None and "#" not in visible[:1]
        hashtags = line.count("#") > 1 and len(re.findall(r"(?:^|\s)#(?=\w*[^\W\d]{3})\w{4,}", line)) > 1
        pieces = max((len([p for p in re.split(mark, visible) if p.strip()]) for mark in (",", ";", r"\|", " / ", "[»·•]", "、")), default=0) if not url else 0
        listed = pieces > 3 and not code and not sentence and n <= 6 * pieces
        bars = pieces > 3 and not code and (visible.count("|") > 2 or visible.count(" / ") > 2 or "»" in visible)
        hits = n if hashtags else sum(w in vocabulary for w in words)
        repeats = n > 2 and not sentence and not code and sum(counts[w] > 3 for w in words) >= 0.4 * n
        out.append(
            url | (url and not labelled and not sentence and not code and n <= 12) << 1 | sentence << 2 | code << 3 | hashtags << 4 | listed << 5
            | (n > 1 and hits >= 0.5 * n) << 6 | (n > 1 and hits >= 0.25 * n) << 7 | repeats << 8 | (_PRICE.search(visible) is not None and not code) << 9 | bars << 10 | labelled << 11 | (n < 3) << 12 | (url and few_links) << 13
        )
    return out


class LineModel:
    """The hidden Markov model: four states, Bernoulli emissions over the traits."""

    def __init__(self, emissions: np.ndarray, start: np.ndarray, moves: np.ndarray, vocabulary: frozenset[str]):
        self.emissions, self.vocabulary = emissions, vocabulary
        self.log_start, self.log_moves = np.log(start), np.log(moves)
        self.kept: dict[int, list[float]] = {}
        # if beginning with prose and staying in it are the likeliest of all beginnings and moves, lines that each favour prose have the all-prose path as their best: every factor of it is the greatest there is
        self.prose_leads = bool(self.log_start[0] == self.log_start.max() and self.log_moves[0, 0] == self.log_moves.max())

    @staticmethod
    def prior(vocabulary: frozenset[str]) -> LineModel:
        emissions = np.array([_PRIOR[t] for t in TRAITS])
        moves = np.full((4, 4), 0.0)
        for s, stay in enumerate(_STAY):
            moves[s] = (1 - stay) / 3
            moves[s, s] = stay
        return LineModel(emissions, np.array([0.91, 0.03, 0.03, 0.03]), moves, vocabulary)

    def score(self, code: int) -> list[float]:
        if code not in self.kept:
            bits = np.array([code >> k & 1 for k in range(len(TRAITS))], dtype=bool)[:, None]
            self.kept[code] = np.log(np.where(bits, self.emissions, 1 - self.emissions)).sum(axis=0).tolist()
        return self.kept[code]

    def label(self, codes: list[int]) -> list[int]:
        """The most likely states of the lines (Viterbi)."""
        scores = [self.score(c) for c in codes]
        if self.prose_leads and all(s[0] >= max(s) for s in scores):
            return [0] * len(codes)
        moves = self.log_moves.tolist()
        best, back = [a + b for a, b in zip(self.log_start.tolist(), scores[0])], []
        for own in scores[1:]:
            came, new = [], []
            for s in range(4):
                k = max(range(4), key=lambda r: best[r] + moves[r][s])
                came.append(k)
                new.append(best[k] + moves[k][s] + own[s])
            back.append(came)
            best = new
        state = max(range(4), key=best.__getitem__)
        path = [state]
        for came in reversed(back):
            state = came[state]
            path.append(state)
        return path[::-1]

    def fitted(self, spam: list[list[int]], ham: dict[int, int], ham_pages: int, rounds: int = 8) -> LineModel:
        """Expectation maximisation over the lines of spam pages; those of ``ham_pages`` other pages, given as counts of their traits, stay prose."""
        model, spam = self, [codes for codes in spam if codes]
        traits = np.arange(len(TRAITS))
        bits = [(np.array(codes)[:, None] >> traits & 1).astype(float) for codes in spam]
        on, mass = self.emissions * _PRIOR_LINES, np.full(4, _PRIOR_LINES)
        moves, start = np.exp(self.log_moves) * _PRIOR_LINES, np.exp(self.log_start) * 20.0
        # the lines held to be prose count alike in every round
        for code, n in ham.items():
            on[:, 0] += n * (code >> traits & 1)
        lines = sum(ham.values())
        mass[0] += lines
        moves[0, 0] += lines - ham_pages
        start[0] += ham_pages
        for _ in range(rounds):
            new_on, new_mass, new_moves, new_start = on.copy(), mass.copy(), moves.copy(), start.copy()
            for codes, own in zip(spam, bits):
                gamma, pair = model._expected(codes)
                new_on += own.T @ gamma
                new_mass += gamma.sum(axis=0)
                new_start += gamma[0]
                new_moves += pair
            model = LineModel(np.clip(new_on / new_mass, 1e-4, 1 - 1e-4), new_start / new_start.sum(), new_moves / new_moves.sum(axis=1, keepdims=True), self.vocabulary)
        return model

    def _expected(self, codes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        own = np.exp(np.array([np.array(self.score(c)) - max(self.score(c)) for c in codes]))
        moves, n = np.exp(self.log_moves), len(codes)
        ahead, after = np.empty((n, 4)), np.ones((n, 4))
        ahead[0] = np.exp(self.log_start) * own[0]
        ahead[0] /= ahead[0].sum()
        for i in range(1, n):
            ahead[i] = ahead[i - 1] @ moves * own[i]
            ahead[i] /= ahead[i].sum()
        for i in range(n - 2, -1, -1):
            after[i] = moves @ (own[i + 1] * after[i + 1])
            after[i] /= after[i].sum()
        gamma = ahead * after
        gamma /= gamma.sum(axis=1, keepdims=True)
        pair = np.zeros((4, 4))
        for i in range(n - 1):
            step = ahead[i][:, None] * moves * (own[i + 1] * after[i + 1])[None, :]
            pair += step / step.sum()
        return gamma, pair


def page_words(lines: list[str], is_spam: bool) -> set[str]:
    """The words a labelled page is told by. The title of a message tells how it was committed rather than what it holds; sentences of spam pages are its prose."""
    return {w for line in lines[1:] if not (is_spam and _SENTENCE.search(line)) for w in line_words(line)[1] if len(w) > 1}


def learned_vocabulary(sample: DataFrame) -> frozenset[str]:
    """The words that far more spam pages than other pages of the sample hold; counted on the workers, only those words come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [(message_and_added(t), s == 1) for t, s in zip(batch.column("text").to_pylist(), batch.column("is_spam").to_pylist())]
            told = [(w, spam) for lines, spam in pages for w in page_words(lines, spam)]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in told], pa.string()), pa.array([spam for _, spam in told], pa.bool_())], ["word", "spam"])

    pages = sample.agg(F.count_if(F.col("is_spam") == 1).alias("spam"), F.count_if(F.col("is_spam") != 1).alias("ham")).first()
    counted = sample.select("text", "is_spam").mapInArrow(run, "word string, spam boolean").groupBy("word").agg(F.count_if("spam").alias("n"), F.count_if(~F.col("spam")).alias("m"))
    much = F.col("n") / F.lit(pages["spam"] + 1) > 6 * (F.col("m") + 0.5) / F.lit(pages["ham"] + 1)
    return frozenset(r["word"] for r in counted.where((F.col("n") > 2) & much).select("word").toLocalIterator())


def fit_line_model(documents: DataFrame, labels: DataFrame, most_pages: int = 4_000, most_chars: int = 20_000) -> LineModel:
    """A model fitted to at most ``most_pages`` labelled pages of at most ``most_chars`` characters, those of the smallest hashes.

    The pages stay on the workers; what comes to the driver of this bounded
    sample are learned words, the traits of the lines of spam pages, and how
    often each combination of traits is seen on the others. Without labels the
    stated priors are the model.
    """
    known = labels.where("doc_id is not null and is_spam is not null").groupBy("doc_id").agg(F.max("is_spam").alias("is_spam"))
    sample = materialise(
        documents.select("doc_id", "text").where(F.length("text") <= most_chars).join(known, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_pages).select("doc_id", "text", "is_spam")
    )
    vocabulary = learned_vocabulary(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for text in batch.column("text").to_pylist():
                lines = message_and_added(text)
                codes.append([c for c, line in zip(page_traits(lines, vocabulary), lines) if line.strip()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("is_spam"), pa.array(codes, pa.list_(pa.int32()))], ["doc_id", "is_spam", "codes"])

    traits = materialise(sample.selectExpr("doc_id", "cast(is_spam as int) is_spam", "text").mapInArrow(run, "doc_id long, is_spam int, codes array<int>").where("size(codes) > 0"))
    spam = [r["codes"] for r in traits.where("is_spam = 1").orderBy("doc_id").select("codes").toLocalIterator()]
    others = traits.where("is_spam <> 1")
    ham = {r["code"]: r["n"] for r in others.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n")).toLocalIterator()}
    return LineModel.prior(vocabulary).fitted(spam, ham, others.count())


def page_shares(text: str | None, model: LineModel) -> tuple[int, list[int]]:
    """(characters, characters by state) of the message and added lines; blank lines don't count."""
    lines = [x for x in message_and_added(text or "") if x.strip()]
    chars = [0, 0, 0, 0]
    if lines:
        for line, state in zip(lines, model.label(page_traits(lines, model.vocabulary))):
            chars[state] += len(line.strip())
    return sum(chars), chars


def score_pages(documents: DataFrame, model: LineModel) -> DataFrame:
    """(doc_id, n_chars, link_chars, tag_chars, menu_chars, share) of every document; share is of characters that are no prose.

    Null and empty texts, and those with nothing but blanks, have no
    characters and share 0. Texts of any length are labelled whole; repeated
    rows each come out; other columns are left out whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [page_shares(t, model) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in rows], pa.int64()), *(pa.array([c[s] for _, c in rows], pa.int64()) for s in (1, 2, 3)), pa.array([(n - c[0]) / n if n else 0.0 for n, c in rows])],
                ["doc_id", "n_chars", "link_chars", "tag_chars", "menu_chars", "share"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return spread(texts, "doc_id").mapInArrow(run, "doc_id long, n_chars long, link_chars long, tag_chars long, menu_chars long, share double")


def stuffed_pages(documents: DataFrame, labels: DataFrame, least: float = 0.5, **bounds: int) -> DataFrame:
    """Scores of the documents of whose characters more than ``least`` are no prose."""
    return score_pages(documents, fit_line_model(documents, labels, **bounds)).where(F.col("share") > least)
