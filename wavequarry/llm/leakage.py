"""Evaluation texts that stand, whole or in part, inside training texts.

Texts are brought to templates: numbers, names and units become typed placeholders,
invisible characters and case go. Windows of template tokens of the corpus are
hash-joined with those of the evaluation items, whatever the values in their slots. Then
slots must be consistent: over all windows of a document and an item every value of the
item stands for one value of the document and the other way round, itself where that
occurs, and windows that disagree with this mapping do not count; so a common pattern
with other names in it says little, and a question with other names and numbers in it is
still found. A window without a slot counts unless it is a stock phrase: one that most
documents have without much else of the item.
Documents whose consistent windows cover enough of an item are candidates; a local
alignment of the whole document with the item, in the item's order and in one passage or
few, then measures the share of the item's letters and digits that it holds. Where most
windows of an item agree only under other values, the alignment takes the document's values for
those of the item that they stand for, and must hold more.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequarry.session import arrow_batches, cut, small_side

#: Tokens in a window.
WINDOW = 6
#: A candidate's consistent windows cover at least this share of the item's tokens ...
CANDIDATE_SHARE = 0.1
#: ... and a found document holds at least this share of its letters and digits.
LEAST_SHARE = 0.5
#: An item under other values takes this share of its windows, consistent with one mapping, and of its letters and digits under that mapping.
RENAMED_WINDOWS, RENAMED_SHARE = 0.6, 0.75
#: A passage holds at least so many letters and digits of the item.
PASSAGE_LETTERS = 12
#: At most so many passages make up the share.
PASSAGES = 4
#: Tokens of an item that are aligned at once, and cells of an alignment's table.
PIECE, CELLS = 1000, 4_000_000
#: Windows that stand in so many items are stock phrases (an instruction) and find no candidates.
STOCK_ITEMS = 3
#: A window without a slot is a stock phrase of the corpus unless at least half of the documents that have it cover this share of the item.
OWN_SHARE = 0.25
#: A capitalised word that stands in more than this share of the items is no name.
COMMON_SHARE = 0.02
#: Unit words that become one placeholder.
UNITS = frozenset("mm cm m km mg g kg ml l ms s min h hz khz mhz v mv uv µv a ma w kw pa kpa bar °c °f % px kb mb gb tb".split())
#: Window rows that a worker hands over at once; windows of an item whose flags make up one number; pairs that one task aligns.
BATCH_ROWS, FLAGS, ALIGNED = 20_000, 62, 200

#: Up to so many keys of the items' windows go to the tasks, which then leave out windows that would not join; the result is the same.
SENT_KEYS = 1_000_000

_TOKEN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]|(?:(?![\p{Han}\p{Hiragana}\p{Katakana}])[\p{L}\p{M}\p{N}])+|[%°]\p{L}?")
_INVISIBLE = regex.compile(r"\p{Cf}+")
_NUMBER = regex.compile(r"\p{N}+$")


def tokens(text: str) -> list[str]:
    """The words, digit runs and single ideographs of a text, without invisible characters, in compatibility form; case is kept."""
    return _TOKEN.findall(unicodedata.normalize("NFKC", _INVISIBLE.sub("", text)))


class Names:
    """What counts as a name: words with a capital, but for those that many items share (openings, common nouns).

    Words that the items only write with a capital are names in any case.
    """

    def __init__(self, texts: list[str]) -> None:
        upper: dict[str, int] = {}
        lower: set[str] = set()
        for text in texts:
            words = set(tokens(text))
            lower |= {w.casefold() for w in words if not w[0].isupper()}
            for word in {w.casefold() for w in words if w[0].isupper()}:
                upper[word] = upper.get(word, 0) + 1
        most = max(STOCK_ITEMS, COMMON_SHARE * len(texts))
        self.common = frozenset(w for w, n in upper.items() if n > most) | lower
        self.known = frozenset(upper) - self.common

    def __contains__(self, word: str) -> bool:
        plain = word.casefold()
        return plain in self.known or (word[0].isupper() and plain not in self.common and not (len(word) > 1 and word.isupper()))


def _slot(word: str, names: Names) -> tuple[str, str]:
    """A word's template token and the value of its slot (empty for a plain word)."""
    plain = word.casefold()
    kind = "<num>" if _NUMBER.match(word) else "<unit>" if plain in UNITS else "<name>" if word in names else plain
    return kind, "" if kind == plain else plain


def template(words: list[str], names: Names) -> tuple[list[str], list[str]]:
    """The template tokens of a text and, beside each, the value of its slot."""
    pairs = [_slot(w, names) for w in words]
    return [k for k, _ in pairs], [v for _, v in pairs]


def _codes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every ``width`` hashed template tokens in a row."""
    code = np.full(max(len(hashes) - width + 1, 0), width, dtype=np.uint64)
    for k in range(width):
        code = (code ^ (code >> np.uint64(29)) ^ hashes[k : k + len(code)]) * np.uint64(0x9E3779B97F4A7C15)
    return (code ^ (code >> np.uint64(32))).view(np.int64)


def _batch_codes(lengths: list[int], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of the windows of texts whose hashed tokens lie behind each other; a text shorter than a window is one."""
    size = np.array(lengths, dtype=np.int64)
    start = np.cumsum(size) - size
    left = np.repeat(start + size, size) - np.arange(len(hashes))
    places = np.flatnonzero(left >= WINDOW)
    parts = [(places, _codes(hashes, WINDOW)[places])]
    for width in range(1, WINDOW):
        short = start[size == width]
        parts.append((short, _codes(hashes, width)[short]))
    return np.concatenate([p for p, _ in parts]), np.concatenate([k for _, k in parts])


class _Slots(dict):
    """Words to their template token's hash and slot value."""

    def __init__(self, names: Names) -> None:
        self.names = names

    def __missing__(self, word: str) -> tuple[int, str]:
        kind, value = _slot(word, self.names)
        self[word] = xxhash.xxh64_intdigest(kind) - (1 << 63), value
        return self[word]


def _among(codes: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which codes are in ``ordered``."""
    if not len(ordered):
        return np.zeros(len(codes), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, codes), len(ordered) - 1)] == codes


def _windows(names: Names, wanted: np.ndarray | None = None):
    """(id, text) batches to (id, key, at, total, slots) rows, one for each window of a text; slots is empty where it has none.

    With ``wanted``, the sorted keys of all windows of the other side, those that no row of it would join stay out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def handed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()))
            out = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(out, names=["id", "key", "at", "total", "slots"])

        for batch in batches:
            slots = _Slots(names)  # of one batch, so it stays small
            ids = batch.column("id").to_pylist()
            texts = [[slots[w] for w in tokens(text)] if text else [] for text in batch.column("text").to_pylist()]
            flat = list(chain.from_iterable(texts))
            lengths = [len(t) for t in texts]
            places, codes = _batch_codes(lengths, np.fromiter((h for h, _ in flat), dtype=np.int64, count=len(flat)).view(np.uint64))
            kept = np.ones(len(places), dtype=bool) if wanted is None else _among(codes, wanted)
            order = np.argsort(places[kept], kind="stable")
            places, codes = places[kept][order], codes[kept][order]
            ends = np.cumsum(lengths)
            for place, code, text in zip(places.tolist(), codes.tolist(), np.searchsorted(ends, places, side="right").tolist(), strict=True):
                end, total = int(ends[text]), lengths[text]
                rows.append((ids[text], code, place - end + total, total, [v for _, v in flat[place : min(place + WINDOW, end)] if v]))
                if len(rows) >= BATCH_ROWS:
                    yield handed()
        if rows:
            yield handed()

    return run


def _align_part(item: np.ndarray, doc: np.ndarray, weight: np.ndarray, gap: float) -> tuple[float, list[int], int, int, int, int]:
    """Best local alignment: its score, the matched item positions and the spans (item from, to, doc from, to) it takes up."""
    rows, columns = len(item), len(doc)
    ramp = gap * np.arange(columns + 1)
    score = np.zeros((rows + 1, columns + 1))
    for i in range(rows):
        hit = np.where(doc == item[i], weight[i], -gap)
        best = np.maximum(0.0, score[i] - gap)
        best[1:] = np.maximum(best[1:], score[i, :-1] + hit)
        score[i + 1] = np.maximum(best, np.maximum.accumulate(best + ramp) - ramp)
    i, j = np.unravel_index(int(score.argmax()), score.shape)
    top, end_i, end_j, found = float(score[i, j]), int(i), int(j), []
    while i > 0 and j > 0 and score[i, j] > 1e-9:
        equal = doc[j - 1] == item[i - 1]
        if abs(score[i, j] - (score[i - 1, j - 1] + (weight[i - 1] if equal else -gap))) < 1e-6:
            i, j = i - 1, j - 1
            if equal:
                found.append(int(i))
        elif abs(score[i, j] - (score[i - 1, j] - gap)) < 1e-6:
            i -= 1
        else:
            j -= 1
    return top, found, int(i), end_i, int(j), end_j


def _align(item: np.ndarray, doc: np.ndarray, weight: np.ndarray, gap: float) -> tuple[list[int], int, int, int, int]:
    """Best local alignment with the whole document, in stretches that overlap by more than any alignment can reach."""
    reach = len(item) + int(weight.sum() / gap) + 2  # every token of the document beyond the item's costs a gap
    step = max(reach, CELLS // max(1, len(item)))
    best = None
    for start in range(0, max(1, len(doc)), step):
        found = _align_part(item, doc[start : start + step + reach], weight, gap)
        if best is None or found[0] > best[0] + 1e-9:
            best = (*found[:4], found[4] + start, found[5] + start)
    return best[1:]


def _holds_window(matched: list[int], own: Sequence[int], total: int) -> bool:
    """Whether the matched item positions hold all tokens of a window that starts at one of ``own``."""
    places = set(matched)
    return any(places.issuperset(range(at, min(at + WINDOW, total))) for at in own)


def held_share(document: str, item: str, names: Names, own: Sequence[int] = (), renamed: dict[str, str] | None = None) -> float:
    """The share of the item's letters and digits that the document holds in the item's order, in at most ``PASSAGES`` passages with a slot.

    Each passage must hold ``PASSAGE_LETTERS`` of them and a slot's value or a whole window
    that starts at one of the item's tokens ``own``. An item longer
    than ``PIECE`` tokens is held piece by piece, each in as many passages. ``renamed``
    has values of the document that stand for others of the item.
    """
    words = tokens(item)
    _, values = template(words, names)
    plain = [w.casefold() for w in words]
    code = {w: k for k, w in enumerate(dict.fromkeys(plain))}
    near = {"".join(sorted(w)): k for w, k in code.items() if len(w) > 4}  # swapped letters
    text = [w.casefold() for w in tokens(document)]
    text = [renamed.get(w, w) for w in text] if renamed else text
    whole = np.array([code.get(w, near.get("".join(sorted(w)), -1) if len(w) > 4 else -1) for w in text])
    target = np.array([code[w] for w in plain])
    weight = np.array([float(len(w)) for w in plain])
    slot = np.array([bool(v) for v in values])
    if not len(target) or not len(whole):
        return 0.0
    gap = 0.7 * weight.mean()
    held, reached = 0.0, 0
    for piece in range(0, len(target), PIECE):
        passages = 0
        open_parts = [(piece, min(piece + PIECE, len(target)), reached, len(whole))]
        while open_parts and passages < PASSAGES:
            a, b, c, d = open_parts.pop(0)
            if b - a < 1 or d - c < 1:
                continue
            found, i, end_i, j, end_j = _align(target[a:b], whole[c:d], weight[a:b], gap)
            matched = [a + k for k in found]
            letters = float(weight[matched].sum()) if matched else 0.0
            if letters < PASSAGE_LETTERS or not (slot[matched].any() or _holds_window(matched, own, len(target))):
                continue
            held += letters
            passages += int(slot[matched].any())  # one without a slot takes no other's place
            reached = max(reached, c + end_j)
            open_parts += [(a, a + i, c, c + j), (a + end_i, b, c + end_j, d)]
    return held / float(weight.sum())


def _measure(names: Names):
    """(text, item, own, renamed) batches to (id, item_id, share, renamed_share); the latter is 0 where no value stands for another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares, others = [], []
            for text, item, own, renamed in zip(*(batch.column(c).to_pylist() for c in ("text", "item", "own", "renamed")), strict=True):
                shares.append(held_share(text, item, names, own or ()))
                others.append(held_share(text, item, names, own or (), dict(renamed)) if renamed and shares[-1] < LEAST_SHARE else 0.0)
            columns = [batch.column("id"), batch.column("item_id"), *(pa.array(c, type=pa.float64()) for c in (shares, others))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "item_id", "share", "renamed_share"])

    return run


def _flagged(flags: str) -> Column:
    """The window numbers whose bits are set in the ``flags`` of the blocks of a pair."""
    of_block = lambda b: F.filter(F.sequence(b["block"] * FLAGS, b["block"] * FLAGS + FLAGS - 1), lambda a: F.getbit(b[flags], a % FLAGS) == 1)
    return F.flatten(F.transform("blocks", of_block))


def _covered(at: Column) -> Column:
    """The share of the item's tokens that the windows ``at`` cover; an item's windows are bounded by its length."""
    return F.size(F.array_distinct(F.flatten(F.transform(at, lambda a: F.sequence(a, a + WINDOW - 1))))) / F.col("total")


def template_matches(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Hash join of template windows: one row per document and item with a common template.

    id, item_id, total, blocks (flags of the item's windows that the document has with
    the same values, and of those without a slot) and matched, the number of the item's windows that
    the document has with any values.
    """
    block, bit = F.floor(F.col("at") / FLAGS).cast("int"), F.expr(f"shiftleft(1L, at % {FLAGS})")
    same = F.col("slots") == F.col("item_slots")
    flag = lambda where: F.bit_or(F.when(where, bit).otherwise(F.lit(0).cast("bigint")))
    rows = ours.select("id", "key", "slots").join(small_side(theirs), "key").withColumn("block", block)
    per_block = rows.groupBy("id", "item_id", "total", "block").agg(
        flag(same).alias("same"), flag(same & (F.size("item_slots") == 0)).alias("plain"), flag(F.lit(True)).alias("any")
    )
    blocks = F.collect_list(F.when(F.col("same") != 0, F.struct("block", "same", "plain"))).alias("blocks")
    return per_block.groupBy("id", "item_id", "total").agg(blocks, F.sum(F.bit_count("any")).alias("matched"))


def consistent_windows(ours: DataFrame, theirs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Slot consistency of ``pairs`` (id, item_id): consistent, the item's windows that agree with one mapping of values, and renamed.

    The mapping is one to one: each value of the item takes itself if the document has it
    in such a place, else the value it meets most often, and likewise the other way
    round. ``renamed`` maps values of the document to others that they stand for.
    """
    met = ours.select("id", "key", "slots").join(small_side(theirs), "key").join(small_side(pairs.select("id", "item_id")), ["id", "item_id"], "left_semi")
    met = cut(met.groupBy("id", "item_id", "at", "item_slots", "slots").agg(F.count("*").alias("n")))
    zipped = F.arrays_zip(F.col("item_slots").alias("theirs"), F.col("slots").alias("ours"))
    votes = met.select("id", "item_id", "n", F.explode(zipped).alias("v")).groupBy("id", "item_id", F.col("v.theirs").alias("theirs"), F.col("v.ours").alias("ours"))
    votes = votes.agg(F.struct((F.col("theirs") == F.col("ours")).alias("itself"), F.sum("n").alias("n")).alias("weight"))
    best = lambda df, key, value: df.groupBy("id", "item_id", key).agg(F.max(F.struct("weight", value)).alias("best")).select("id", "item_id", key, f"best.{value}", "best.weight")
    mapped = best(best(votes, "theirs", "ours"), "ours", "theirs")
    mapping = mapped.groupBy("id", "item_id").agg(F.map_from_entries(F.collect_list(F.struct("theirs", "ours"))).alias("mapping"))
    agrees = F.forall(zipped, lambda v: F.coalesce(F.try_element_at("mapping", v["theirs"]) == v["ours"], F.lit(False)))
    kept = met.join(mapping, ["id", "item_id"], "left").where(agrees)
    other = F.map_filter(F.first("mapping"), lambda theirs, ours: theirs != ours)
    swapped = F.map_from_entries(F.transform(F.map_entries(other), lambda e: F.struct(e["value"], e["key"])))
    return kept.groupBy("id", "item_id").agg(F.collect_set("at").alias("consistent"), swapped.alias("renamed"))


def leaked_items(documents: DataFrame, items: DataFrame, max_items: int = 100_000) -> DataFrame:
    """(doc_id, item_id, share) of every document that holds at least half of an item, or most of it under other values.

    ``documents`` has doc_id and text, ``items`` item_id and text; other columns are
    ignored. Null, empty and blank texts hold nothing and cannot be held; repeated rows
    count once, and of rows of an id that differ the smallest text counts. The items' capitalised
    words go to every task, so there may be at most ``max_items`` items (checked); the
    join itself broadcasts their windows only if they are counted to be few.
    """
    spark = documents.sparkSession
    arrow_batches(spark)
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL").groupBy(F.col("item_id").cast("bigint").alias("id")).agg(F.min("text").alias("text"))
    texts = [r[0] for r in items.select("text").limit(max_items + 1).collect()]
    if len(texts) > max_items:
        raise ValueError(f"more than {max_items} evaluation items")
    names = Names(texts)
    schema = "id bigint, key bigint, at int, total int, slots array<string>"
    theirs = items.mapInArrow(_windows(names), schema).select(F.col("id").alias("item_id"), "key", "at", "total", F.col("slots").alias("item_slots"))
    # the same template and values in several items: an instruction
    phrase = F.xxhash64("key", "item_slots")
    stock = theirs.groupBy(phrase.alias("phrase")).agg(F.count_distinct("item_id").alias("n")).where(F.col("n") >= STOCK_ITEMS)
    theirs = cut(theirs.withColumn("phrase", phrase).join(stock, "phrase", "left_anti").drop("phrase"))
    keys = [r[0] for r in theirs.select("key").distinct().limit(SENT_KEYS + 1).collect()]
    wanted = np.sort(np.array(keys, dtype=np.int64)) if len(keys) <= SENT_KEYS else None
    docs = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("id"), "text")
    many = F.col("matched") >= RENAMED_WINDOWS * F.greatest(F.col("total") - WINDOW + 1, F.lit(1))
    matches = template_matches(docs.mapInArrow(_windows(names, wanted), schema), theirs).where((F.size("blocks") > 0) | many)
    matches = cut(matches.select("id", "item_id", "total", _flagged("same").alias("same_at"), _flagged("plain").alias("plain_at"), many.alias("many")))
    plain = matches.select("item_id", _covered(F.col("same_at")).alias("covered"), F.explode("plain_at").alias("at")).groupBy("item_id", "at")
    own = plain.agg(F.avg((F.col("covered") >= OWN_SHARE).cast("double")).alias("with_more")).where(F.col("with_more") >= 0.5)
    own = cut(own.groupBy("item_id").agg(F.collect_list("at").alias("own")))
    none = F.array().cast("array<int>")
    matches = matches.join(small_side(own), "item_id", "left").withColumn("own", F.coalesce("own", none))
    telling = lambda at: F.array_except(at, F.array_except("plain_at", "own"))
    pairs = cut(matches.where((_covered(telling(F.col("same_at"))) >= CANDIDATE_SHARE) | F.col("many")))
    held = docs.join(small_side(pairs.select("id").distinct()), "id", "left_semi")
    held = cut(held.groupBy("id").agg(F.min("text").alias("text")))
    slots = consistent_windows(held.mapInArrow(_windows(names, wanted), schema), theirs, pairs)
    pairs = pairs.join(slots, ["id", "item_id"])
    most = F.size("consistent") >= RENAMED_WINDOWS * F.greatest(F.col("total") - WINDOW + 1, F.lit(1))
    pairs = cut(pairs.where((_covered(telling(F.col("consistent"))) >= CANDIDATE_SHARE) | most).select("id", "item_id", "own", F.when(most, F.col("renamed")).alias("renamed")))
    found = pairs.join(held, "id").join(small_side(items.select(F.col("id").alias("item_id"), F.col("text").alias("item"))), "item_id")
    tasks = max(spark.sparkContext.defaultParallelism, -(-pairs.count() // ALIGNED))
    measured = found.repartition(tasks, "id", "item_id").mapInArrow(_measure(names), "id bigint, item_id bigint, share double, renamed_share double")
    measured = measured.where((F.col("share") >= LEAST_SHARE) | (F.col("renamed_share") >= RENAMED_SHARE))
    return measured.select(F.col("id").alias("doc_id"), "item_id", F.greatest("share", "renamed_share").alias("share"))
