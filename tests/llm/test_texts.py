"""Encoding, packing and stuffed pages on small fixtures."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

encoding = pytest.importorskip("tallyspark.llm.encoding")
from tallyspark.llm import packing, stuffing  # noqa: E402

tiktoken = pytest.importorskip("tiktoken")
PATTERN = encoding.WORDS


@pytest.fixture(scope="module")
def coders():
    path = encoding.vocabulary()
    own = encoding.CorpusEncoder(path)
    return own, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.automaton.ranks, special_tokens={})


TEXTS = ["", " ", "a", "Hello  world\n\n  don't  \t x", "naïve 日本語 テスト 🙂🙂 ​", "<|endoftext|>", "aaaaaaaaaaaaaaaaaaaaaaaa", "0123456789" * 30, "\x00\x01\x1f\x1c a", "İstanbul ß ﬁ", "x" * 5000]


def test_against_the_library(coders):
    own, library = coders
    for text in TEXTS:
        assert own.encode(text) == library.encode_ordinary(text)
        assert own.automaton.decode(own.encode(text)) == text.encode()
        assert own.count(text) == len(own.encode(text))
    assert own.encode(None) == []


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("abehint  '\n", max_size=40)))
def test_any_text_against_the_library(coders, text):
    own, library = coders
    text = text.encode("utf-8", "ignore").decode()
    assert own.encode(text) == library.encode_ordinary(text)


def test_encode_table(spark, coders):
    rows = [(1, "Hello world", "clash"), (2, None, "c"), (3, "", "c"), (1, "Hello world", "c"), (None, "a", "c"), (4, "word " * 200_000, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = [(r["doc_id"], r["ids"]) for r in encoding.encode_texts(df).collect()]
    assert sorted(got, key=str) == sorted([(i, coders[0].encode(t)) for i, t, _ in rows], key=str)
    assert {r["doc_id"]: r["n_tokens"] for r in encoding.count_tokens(df).where("doc_id is not null").collect()} == {1: 2, 2: 0, 3: 0, 4: len(coders[0].encode("word " * 200_000))}
    assert encoding.encode_texts(df.limit(0)).count() == 0


def packed(spark, sizes, kinds, **options):
    df = spark.createDataFrame([(i, n, "clash") for i, n in sizes], "doc_id long, n_tokens long, window string")
    return packing.pack(df, spark.createDataFrame(kinds, "container string, capacity_tokens int"), **options)


def test_packing_keeps_everything(spark):
    sizes = [(i, (i * 37) % 90) for i in range(600)] + [(1000, 950), (1001, 0), (1002, None), (1003, 300), (1004, -5), (1, 37)]
    out = packed(spark, sizes, [("small", 100), ("big", 400), ("none", 0), (None, 9)], partitions=20, most_open=4).collect()
    for name, room in (("small", 100), ("big", 400)):
        mine = [r for r in out if r["container"] == name]
        fill, pieces, tokens = {}, {}, {}
        for r in mine:
            fill[r["bin_id"]] = fill.get(r["bin_id"], 0) + r["n_tokens"]
            pieces.setdefault(r["doc_id"], []).append(r["piece_no"])
            tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["n_tokens"]
        assert max(fill.values()) <= room
        want = {}
        for i, n in sizes:
            want[i] = want.get(i, 0) + max(n or 0, 0)
        assert tokens == want
        assert all(len(p) == 1 for i, p in pieces.items() if want[i] <= room and i != 1)
    assert {r["container"] for r in out} == {"small", "big"}


def test_packing_leaves_little_room(spark):
    sizes = [(i, 1 + (i * 7919) % 300) for i in range(3000)]
    for r in packing.packing_waste(packed(spark, sizes, [("k", 256), ("l", 1024)], partitions=20)).collect():
        assert r["waste"] < 0.05 and r["n_bins"] >= r["least_bins"]


def test_packing_is_the_same_again(spark):
    sizes = [(i, 1 + (i * 7919) % 300) for i in range(300)]
    runs = [sorted(map(tuple, packed(spark, s, [("k", 256)], partitions=6).collect())) for s in (sizes, sizes[::-1])]
    assert runs[0] == runs[1] and packed(spark, [], [("k", 256)]).count() == 0


def commit(message, added=(), name="a.md"):
    body = "".join(f"    {line}\n" for line in message)
    diff = f"\ndiff --git a/{name} b/{name}\n--- a/{name}\n+++ b/{name}\n@@ -1 +1 @@\n" + "".join(f"+{line}\n" for line in added) + " kept\n-gone cheap buy\n" if added else ""
    return f"commit {'0' * 40}\nAuthor: A <a@b.test>\nDate:   2020-01-01\n\n{body}{diff}"


PROSE = ["The previous version kept a handle open and failed.", "It now reports the line that broke."]
LINKS = [f"* https://www.{w}.example/item/{n}" for n, w in enumerate(("oak", "ash", "elm", "fir", "yew", "bay"))]
WORDS = ["buy cheap watch, best watch, discount watch, cheap watch, watch sale"] * 5
PAGES = {
    1: (commit(["Fix it", "", *PROSE]), False),
    2: (commit(["Add page"], LINKS), True),
    3: (commit(["Add page"], WORDS), True),
    4: (commit(["Update", *PROSE * 6], WORDS[:1]), False),
    5: (commit(["Seed"], [f"insert into product (sku, name, price) values ('SKU{n}', 'cheap watch', {n}.99);" for n in range(10)], "p.sql"), False),
    6: (commit(["Redirects"], [f"/path/{n}  https://www.oak.example/{n}  301" for n in range(10)], "r.conf"), False),
    7: (commit(["Log"], [f"* Handle late files ([#{n}](https://oak.example/{n})). It now reports the line that broke." for n in range(8)]), False),
    8: (commit(["Tags"], ["#BuyCheapWatch #BestWatchSale #CheapBags"] * 4), True),
    9: (None, False), 10: ("", False), 11: ("   \n ", False), 12: (commit(["One link", LINKS[0]]), False),
    13: (commit(["Labels"], [f'  "item.{n}": "Cheap watch",' for n in range(20)], "menu.json"), False),
    14: (commit(["x"], LINKS * 2000), True),
}


def test_pages(spark):
    docs = spark.createDataFrame([(i, t, 0.5) for i, (t, _) in PAGES.items()] + [(2, PAGES[2][0], 0.5)], "doc_id long, text string, share double")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (5, 0), (None, 1), (99, 1), (6, None)], "doc_id long, is_spam int")
    for known in (labels, labels.limit(0)):
        got = sorted(r["doc_id"] for r in stuffing.stuffed_pages(docs, known).collect())
        assert got == sorted([i for i, (_, spam) in PAGES.items() if spam] + [2])
    assert stuffing.stuffed_pages(docs.limit(0), labels).count() == 0


def test_message_and_added_lines():
    assert stuffing.message_and_added(PAGES[2][0]) == ["Add page", *LINKS]
    assert stuffing.message_and_added("no commit\nat all") == ["no commit", "at all"]
