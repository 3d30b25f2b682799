from __future__ import annotations

import random

import pytest

from wavequarry.llm import leakage

PLACES = "by the old mill;under the stone bridge;near the quiet harbour;behind the glass tower".split(";")
VERBS = "painted measured borrowed sold counted".split()
THINGS = "lamp clock boat table bell".split()
STOCK = "Read the passage and choose the best answer."


def name(rng):
    return "".join(rng.choice(["Tal", "Ver", "Osk", "Mir", "Lun", "Pax", "Dro"]) if k == 0 else rng.choice(["ben", "dar", "fil", "gor", "mas", "nit", "sul"]) for k in range(3)) + rng.choice("aeiou")


def sentence(rng):
    return f"{name(rng)} {rng.choice(VERBS)} the {rng.choice(THINGS)} of {name(rng)} {rng.choice(PLACES)} in {name(rng)}, room {rng.randrange(100, 9999)}."


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    items = [(k, " ".join(([STOCK] if k % 2 else []) + [sentence(rng) for _ in range(4)]), "suite", 7) for k in range(12)]
    body = {k: t.replace(STOCK + " ", "") for k, t, *_ in items}
    docs, want = [], set()

    def add(text, *held):
        docs.append((len(docs), text, "clash", "clash"))
        want.update((len(docs) - 1, h) for h in held)

    filler = lambda n: " ".join(sentence(rng) for _ in range(n))
    for _ in range(60):
        add(filler(4))
    add(filler(2) + " " + body[0] + " " + filler(2), 0)
    add(" ".join(body[1].split(". ")[:3]) + ".", 1)  # three of four sentences
    add("​".join(body[2]).replace(" ", " ­ "), 2)  # invisible characters everywhere
    add(body[3].lower(), 3)
    words = body[4].split()
    for k in range(5, len(words), 9):
        words[k] = "changed"
    add(filler(1) + " " + " ".join(words), 4)
    parts = body[5].split(". ")
    add(parts[0] + ". " + parts[1] + ". (" + filler(1) + ") " + parts[2] + ". " + parts[3], 5)
    add(body[6] + " " + filler(150) + " " + body[7], 6, 7)  # very long
    mixed = body[8].split()
    rng.shuffle(mixed)
    add(" ".join(mixed))  # another order
    add(STOCK)
    add(STOCK + " " + filler(3))
    add(body[9].split(". ")[0] + ". " + filler(3))  # a quarter
    for text in (None, "", "   ", "\n", "7", "\U0001f642"):
        add(text)
    docs += [docs[60], (None, body[0], "", "")]
    items += [(100, None, "", 0), (101, "", "", 0), (102, "!", "", 0), (None, body[0], "", 0), items[0]]
    return spark.createDataFrame(docs, "doc_id bigint, text string, id string, key string"), spark.createDataFrame(items, "item_id bigint, text string, suite string, id int"), want


def test_finds_what_is_held(tables):
    documents, items, want = tables
    found = [(r["doc_id"], r["item_id"]) for r in leakage.leaked_items(documents, items).collect()]
    assert len(found) == len(set(found))
    assert set(found) == want


def test_empty(tables):
    documents, items, _ = tables
    assert leakage.leaked_items(documents.limit(0), items).count() == 0
    assert leakage.leaked_items(documents, items.limit(0)).count() == 0


def test_other_values_in_the_same_pattern_share_no_slots():
    rng = random.Random(3)
    names = leakage.Names([])
    a, b = "Talbena painted the lamp of Verdaru by the old mill.", "Oskfila painted the lamp of Mirgoro by the old mill."
    (ka, va), (kb, vb) = (leakage.template(leakage.tokens(t), names) for t in (a, b))
    assert ka == kb and not {v for v in va if v} & {v for v in vb if v}
    assert leakage.held_share(b, a, names) == 0.0
    assert leakage.held_share(sentence(rng) + " " + a, a, names) == 1.0


def test_items_must_be_bounded(tables):
    documents, items, _ = tables
    with pytest.raises(ValueError, match="more than"):
        leakage.leaked_items(documents, items, max_items=3)


def test_stretches_and_pieces_change_nothing(monkeypatch):
    rng = random.Random(5)
    names = leakage.Names([])
    item = " ".join(sentence(rng) for _ in range(6))
    filler = lambda n: " ".join(sentence(rng) for _ in range(n))
    document = filler(40) + " " + item.replace(". ", ". (" + filler(1) + ") ", 1) + " " + filler(40)
    whole = leakage.held_share(document, item, names)
    monkeypatch.setattr(leakage, "CELLS", 10)
    assert whole == leakage.held_share(document, item, names) == 1.0
    monkeypatch.setattr(leakage, "PIECE", 30)
    assert leakage.held_share(document, item, names) > 0.9


def test_very_long_texts():
    rng = random.Random(6)
    names = leakage.Names([])
    item = " ".join(sentence(rng) for _ in range(200))
    document = " ".join(sentence(rng) for _ in range(3000)) + item
    assert leakage.held_share(document, item, names) > 0.99


def test_items_without_slots(spark):
    rng = random.Random(9)
    words = [a + b for a in "bra cle dro fli gru".split() for b in "ner sto lim pax tid vo".split()]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    han = lambda n: "".join(rng.choice("山水火木金土日月星雨风雪花草鸟鱼") for _ in range(n))
    phrase = "it is widely known in the town and all around that"
    items = [(0, prose(40)), (1, han(60)), (2, phrase + " " + sentence(rng)), (3, prose(30))]
    docs = [f"{phrase} {prose(30)}" for _ in range(30)] + [han(80) for _ in range(30)]
    want = set()
    for item, text in items[:2]:
        half = text[: int(len(text) * 0.7)]
        for held in (text, half):
            want.add((len(docs), item))
            docs.append(f"{prose(20)} {held} {prose(20)}")
    for _ in range(40):  # one that many documents hold
        want.add((len(docs), 3))
        docs.append(f"{prose(20)} {items[3][1]}")
    documents = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    found = leakage.leaked_items(documents, spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def question(rng, people, places, number):
    a, b = people
    return (
        f"Early in the morning {a} carried {number} boxes from {places[0]} to {places[1]} and {b} counted them. After lunch {b} sold half of the {number} boxes "
        f"to {a} in {places[1]}. How many boxes does {a} bring back to {places[0]} when {b} keeps the rest?"
    )


@pytest.fixture(scope="module")
def renamed_tables(spark):
    rng = random.Random(21)
    items = [(1, question(rng, ("Talbena", "Oskdara"), ("Mirfila", "Lungora"), 480))]
    docs = [(k, " ".join(sentence(rng) for _ in range(3))) for k in range(30)]
    docs.append((100, docs[0][1] + " " + question(rng, ("Verniti", "Paxsulo"), ("Drobeni", "Talmasu"), 96) + " " + docs[1][1]))
    mixed = question(rng, ("Verniti", "Paxsulo"), ("Drobeni", "Talmasu"), 96).split()
    names = [k for k, w in enumerate(mixed) if w.strip(".?,")[:1].isupper() and w not in ("Early", "After", "How")]
    for k in names:  # a name of its own wherever one stands
        mixed[k] = name(rng)
    docs.append((101, " ".join(mixed)))
    documents = spark.createDataFrame(docs, "doc_id bigint, text string")
    return documents, spark.createDataFrame(items, "item_id bigint, text string")


def test_a_question_with_other_values_is_found_if_its_slots_are_consistent(renamed_tables):
    found = {(r["doc_id"], r["item_id"]) for r in leakage.leaked_items(*renamed_tables).collect()}
    assert (100, 1) in found


def test_slot_consistency_tells_renamed_from_mixed(renamed_tables, spark):
    documents, items = renamed_tables
    names = leakage.Names([items.first()["text"]])
    schema = "id bigint, key bigint, at int, total int, slots array<string>"
    leakage.arrow_batches(spark)
    ours = documents.withColumnRenamed("doc_id", "id").mapInArrow(leakage._windows(names), schema)
    theirs = items.withColumnRenamed("item_id", "id").mapInArrow(leakage._windows(names), schema).withColumnsRenamed({"id": "item_id", "slots": "item_slots"})
    matched = {r["id"]: r["matched"] for r in leakage.template_matches(ours, theirs).collect()}
    assert matched[100] == matched[101]  # the templates are the same
    pairs = spark.createDataFrame([(100, 1), (101, 1)], "id bigint, item_id bigint")
    slots = {r["id"]: r for r in leakage.consistent_windows(ours, theirs, pairs).collect()}
    assert len(slots[100]["consistent"]) == matched[100]
    assert len(slots[101]["consistent"]) < 0.6 * matched[101]
    assert slots[100]["renamed"]["verniti"] == "talbena" and slots[100]["renamed"]["96"] == "480"
