from __future__ import annotations

import random

import pytest

from wavequarry.llm import truncation

PLACES = "by the old mill;under the stone bridge;near the quiet harbour;behind the glass tower".split(";")
VERBS = "painted measured borrowed counted described".split()
THINGS = "lamp clock boat table instrument".split()


def name(rng):
    return rng.choice(["Tal", "Ver", "Osk", "Mir"]) + rng.choice(["bena", "dara", "fila", "goro"])


def sentence(rng):
    return f"{name(rng)} {rng.choice(VERBS)} the {rng.choice(THINGS)} of {name(rng)} {rng.choice(PLACES)}."


def headline(rng):
    return f"{name(rng)}: the {rng.choice(THINGS)} {rng.choice(PLACES)}"


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    rows, want = [], set()

    def add(text, source, cut=False):
        rows.append((len(rows), text, source, "clash", "clash"))
        if cut:
            want.add(len(rows) - 1)

    for k in range(300):
        text = " ".join(sentence(rng) for _ in range(rng.randrange(2, 5)))
        add(text, "prose")
        if k % 10 == 0:
            add(text[: text.rindex(" the ") + 6], "prose", True)  # a letter of the next word
        if k % 10 == 1:
            add(text[: text.rindex(" of ") + 3], "prose", True)  # behind a word
        if k % 10 == 2:
            add(text[: text.index(".") + 1], "prose")  # whole sentences are left
        if k % 10 == 3:
            add(text[:-1] + "…", "prose")  # a complete sentence
        if k % 10 == 4:
            add(text[: text.rindex(" the ") + 7] + "…", "prose", True)
        if k % 50 == 6:
            add(text[: text.rindex(" the ") + 6] + "\ufffd", "prose", True)  # half a character
        if k % 10 == 5:
            add(text + "​ ", "prose")
        add(headline(rng), "headlines")
        if k % 25 == 0:
            add("Talbena: the instrument by the o", "headlines", True)
    for text in (None, "", "  ", "​", " "):
        add(text, "prose")
    add(None, None)
    add(" ".join(sentence(rng) for _ in range(2000)), "prose")
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, raw string, t string"), want


def test_finds_the_cuts(tables):
    documents, want = tables
    found = [r["doc_id"] for r in truncation.truncated(documents).collect()]
    assert len(found) == len(set(found))
    missed, extra = want - set(found), set(found) - want
    assert len(missed) <= 0.05 * len(want) and len(extra) <= 0.05 * len(want), (missed, extra)


def test_rates(tables):
    documents, want = tables
    rates = {r["source"]: r for r in truncation.truncation_rates(documents).collect()}
    assert set(rates) == {"prose", "headlines"}
    assert abs(sum(r["cut"] for r in rates.values()) - len(want)) <= 0.1 * len(want)
    assert rates["headlines"]["share"] < rates["prose"]["share"] < 1


def test_empty(tables):
    documents, _ = tables
    assert truncation.truncated(documents.limit(0)).count() == 0
    assert truncation.truncation_rates(documents.limit(0)).count() == 0
    assert truncation.truncated(documents.where("text IS NULL OR trim(text) = ''")).count() == 0


def test_one_text(spark):
    one = spark.createDataFrame([(1, "A single complete text.", None), (1, "A single complete text.", None)], "doc_id bigint, text string, source string")
    assert truncation.truncated(one).count() == 0


def test_copies_do_not_vouch_for_each_other(spark):
    rng = random.Random(8)
    texts = [" ".join(sentence(rng) for _ in range(3)).replace(" of ", ", of ", 1) for _ in range(200)]
    cut = texts[0][: texts[0].rindex(" of ") + 3]
    comma = f"{texts[1][: texts[1].rindex(' of ')]},"
    rows = [(k, t, "prose") for k, t in enumerate(texts + 100 * [cut] + 100 * [comma])]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = [r["doc_id"] for r in truncation.truncated(documents).collect()]
    assert sorted(found) == list(range(200, 400))


def test_the_trigrams_decide(tables, monkeypatch):
    documents, _ = tables
    behind_a_word = {r["doc_id"] for r in documents.where("source = 'prose' AND text LIKE '% of'").collect()}
    assert len(behind_a_word) == 30
    assert behind_a_word <= {r["doc_id"] for r in truncation.truncated(documents).collect()}
    monkeypatch.setattr(truncation, "SEEN", 10**9)  # no trigram is frequent
    assert not behind_a_word & {r["doc_id"] for r in truncation.truncated(documents).collect()}


def test_headlines_cut_between_words(spark):
    rng = random.Random(9)
    rows = [(k, headline(rng), "headlines") for k in range(600)]
    rows += [(1000 + k, h[: h.index(" the ") + 4], "headlines") for k, h in ((k, headline(rng)) for k in range(5))]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert sorted(r["doc_id"] for r in truncation.truncated(documents).collect()) == list(range(1000, 1005))
