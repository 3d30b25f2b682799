"""Texts that were cut by a field limit or in transfer.

Only SQL expressions: every text becomes a list of tokens (words, single ideographs,
marks), and each position is counted with its word trigram, as inside or as the end of
the text, per source; texts with the same tokens count once. A text that ends neither with
a closing mark (one that often ends texts) nor with an ellipsis joins its last trigram
with these counts: where it is frequent inside the texts of its source but almost never
ends one, the text was cut there. A trigram counts with its words, with the kinds of its
first two words, and with three kinds, each only where it was seen often enough inside
texts, smoothed with the next coarser one; a rare trigram falls back on the kind of its
last token. Where kinds often end texts (headlines), only trigrams with a word in them
decide. A last word whose last letters are frequent inside words but almost never end one
was cut inside the word. Behind an ellipsis the trigram before it decides, by how often
another closing mark follows it anywhere. A text that ends in half a character is cut in
any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequarry.session import cut, small_side

#: A text whose last trigram ends texts of its source less often than this, by the share of its occurrences, is cut.
END_RATE = 0.1
#: A trigram counts as frequent inside texts from so many occurrences on.
SEEN = 20
#: Where more than this share of a kind of word ends a text (headlines), kinds alone say nothing.
HEADLINE_RATE = 0.05
#: A text with an ellipsis is cut if a closing mark follows the words before it less often than this.
CLOSE_RATE = 0.012
#: A last word whose last so many letters end words less often than this is cut; endings are taken to have been seen so many times more.
LETTERS, LETTER_RATE, LETTER_WEIGHT = 4, 0.02, 2.0
#: Weight of the coarser trigram, for ends of texts and before an ellipsis.
BACKOFF, CLOSE_BACKOFF = 10.0, 4.0
#: What stands for the bytes of a character that was cut in two.
BROKEN = "\ufffd"
#: A mark closes texts if it ends one in at least this share of its occurrences.
MARK_RATE = 0.05

_INVISIBLE = r"[\p{Cf}\x{FE00}-\x{FE0F}]"
_TOKEN = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]|(?:(?![\p{IsHan}\p{IsHiragana}\p{IsKatakana}])[\p{L}\p{N}][\p{M}]*)+|[^\s\p{Z}\p{C}\p{L}\p{N}\p{M}]"
#: The forms of a trigram from the finest to the coarsest; the last is its last token's kind alone.
_FORMS = (("a", "b", "c"), ("ka", "kb", "c"), ("ka", "kb", "kc"), ("kc",))


def text_tokens(text: Column) -> Column:
    """The tokens of a text, three dots as one ellipsis, invisible characters left out."""
    plain = F.regexp_replace(F.regexp_replace(text, _INVISIBLE, ""), r"\.{3,}", "…")
    return F.regexp_extract_all(plain, F.lit(_TOKEN), F.lit(0))


def _shape(token: Column) -> Column:
    """Numbers are one class of tokens, words with a capital another; every other token is its own, in lower case."""
    return F.when(token.rlike(r"^\p{N}+$"), F.lit("<n>")).when(token.rlike(r"^\p{Lu}"), F.lit("<N>")).otherwise(F.lower(token))


def _kind(shape: Column) -> Column:
    kind = F.when(shape.isin("<n>", "<N>", ""), shape).when(shape.rlike(r"^\p{IsHan}"), F.lit("<h>"))
    return kind.when(shape.rlike(r"^\p{IsLatin}"), F.lit("<w>")).when(shape.rlike(r"^\p{L}"), F.lit("<v>")).otherwise(shape)


def _with_kinds(grams: DataFrame) -> DataFrame:
    for c in "abc":
        grams = grams.withColumn(f"k{c}", _kind(F.col(c)))
    return grams


def _forms() -> Column:
    """Every form of a trigram as (level, p, q, r)."""
    parts = [(*(F.lit("") for _ in range(3 - len(form))), *(F.col(c) for c in form)) for form in _FORMS]
    return F.array(*(F.struct(F.lit(level).alias("level"), p.alias("p"), q.alias("q"), r.alias("r")) for level, (p, q, r) in enumerate(parts)))


def _look_up(lasts: DataFrame, grams: DataFrame, scope: tuple[str, ...], sums: tuple[str, ...]) -> DataFrame:
    """(key, source, last, mark, broken) of ``lasts`` with the sums of ``grams`` in every form of their trigram; only forms that they have are summed."""
    keys = [*scope, "level", "p", "q", "r"]
    asked = lasts.select("key", "source", "last", "mark", "broken", F.explode(_forms()).alias("f")).select("key", "source", "last", "mark", "broken", "f.*")
    asked = cut(asked)
    wanted = small_side(asked.select(*keys).distinct())
    found = grams.select(*scope, *sums, F.explode(_forms()).alias("f")).select(*scope, *sums, "f.*").join(wanted, keys, "left_semi")
    found = cut(found.groupBy(*keys).agg(*(F.sum(k).alias(k) for k in sums)))
    met = asked.join(small_side(found), keys, "left")
    at = lambda k, level: F.coalesce(F.max(F.when(F.col("level") == level, F.col(k))), F.lit(0)).alias(f"{k}{level}")
    return met.groupBy("key", "source").agg(*(F.first(c).alias(c) for c in ("last", "mark", "broken")), *(at(k, level) for k in sums for level in range(4)))


def _end_rate(own: float = 1.0) -> Column:
    """How often the trigram ends texts of the source, its own end not counted; null where no form of it is frequent inside texts."""
    ends = [F.greatest(F.col(f"terminal{k}") - own, F.lit(0.0)) for k in range(4)]
    inside = [F.col(f"internal{k}") for k in range(4)]
    last = ends[3] / F.greatest(ends[3] + inside[3], F.lit(1.0))
    headlines = last > HEADLINE_RATE
    rate = last
    for k in (2, 1, 0):
        frequent = (inside[k] >= SEEN) & (~headlines if k == 2 else F.lit(True))
        rate = F.when(frequent, (ends[k] + BACKOFF * rate) / (ends[k] + inside[k] + BACKOFF)).otherwise(rate)
    known = (inside[0] >= SEEN) | (inside[1] >= SEEN) | ((inside[3] >= SEEN) & ~headlines)
    return F.when(known, rate)


def _close_rate() -> Column:
    """How often a closing mark follows the trigram, over all sources."""
    rate = F.col("closed2") / F.greatest(F.col("internal2"), F.lit(1))
    for k in (1, 0):
        rate = (F.col(f"closed{k}") + CLOSE_BACKOFF * rate) / (F.col(f"internal{k}") + CLOSE_BACKOFF)
    return rate


def _letters(texts: DataFrame) -> DataFrame:
    """(ending, inside, ends): how often up to ``LETTERS`` last letters stand inside words and at their ends, over all whole words."""
    words = texts.select(F.explode(F.slice("raw", 1, F.greatest(F.size("raw") - 2, F.lit(0)))).alias("w")).where(_spelt(F.col("w")))
    words = words.groupBy(F.lower("w").alias("w")).count()
    place = F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.struct(i.alias("i"), _ending(F.col("w"), i).alias("e")))
    places = words.select("count", F.length("w").alias("n"), F.explode(place).alias("p"))
    of = lambda where: F.sum(F.when(where, F.col("count")).otherwise(0))
    return places.groupBy(F.col("p.e").alias("ending")).agg(of(F.col("p.i") < F.col("n")).alias("inside"), of(F.col("p.i") == F.col("n")).alias("ends"))


def _spelt(word: Column) -> Column:
    return word.rlike(r"^\p{L}") & ~word.rlike(r"^\p{IsHan}")


def _ending(word: Column, i: Column) -> Column:
    """The up to ``LETTERS`` letters of a word up to its ``i``-th, with a mark for its start."""
    return F.substring(F.concat(F.lit("^"), word), F.greatest(i - LETTERS + 2, F.lit(1)), F.least(i + 1, F.lit(LETTERS)))


def ending_scores(documents: DataFrame) -> DataFrame:
    """One row per text that ends without a closing mark: doc_id, source, broken (ends in half a character), end_rate,
    close_rate (only behind an ellipsis) and letter_rate (only of a last word whose letters are known)."""
    texts = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "text").where("text IS NOT NULL")
    texts = texts.withColumn("raw", text_tokens(F.col("text"))).where("size(raw) > 0")
    copies = cut(texts.select("doc_id", "source", F.md5(F.array_join("raw", " ")).alias("key"), "raw"))  # no token holds a space
    texts = cut(copies.groupBy("source", "key").agg(F.first("raw").alias("raw")))
    shaped = texts.withColumn("t", F.transform("raw", _shape))
    at = lambda i: F.coalesce(F.get("t", i), F.lit(""))
    # of what follows only marks matter; all words are one
    follows = lambda i: F.when(F.get("t", i).rlike(r"^[<\p{L}\p{N}]"), F.lit("")).otherwise(F.get("t", i))
    gram = lambda i: F.struct(at(i - 2).alias("a"), at(i - 1).alias("b"), at(i).alias("c"), follows(i + 1).alias("next"))
    grams = shaped.select("source", F.explode(F.transform(F.sequence(F.lit(0), F.size("t") - 1), gram)).alias("g")).select("source", "g.*")
    grams = cut(grams.groupBy("source", "a", "b", "c", "next").count())
    of = lambda where: F.sum(F.when(where, F.col("count")).otherwise(0))
    marks = grams.groupBy("c").agg(F.sum("count").alias("n"), of(F.col("next").isNull()).alias("ends"))
    marks = marks.where((F.col("ends") >= MARK_RATE * F.col("n")) & ~F.col("c").rlike(r"^[<\p{L}\p{N}]") & (F.col("c") != "…"))
    closing = small_side(cut(marks.select(F.col("c").alias("next"), F.lit(True).alias("closes"))))
    grams = grams.join(closing, "next", "left").withColumn("closed", F.when(F.col("closes"), F.col("count")).otherwise(0))
    grams = grams.withColumn("internal", F.when(F.col("next").isNotNull(), F.col("count")).otherwise(0)).withColumn("terminal", F.col("count") - F.col("internal"))
    grams = _with_kinds(grams.select("source", "a", "b", "c", "internal", "terminal", "closed"))
    n, dotted = F.size("t"), F.element_at("t", -1) == "…"
    back = F.when(dotted & (n > 1), F.lit(1)).otherwise(0)
    lasts = shaped.select(
        "key", "source", dotted.alias("dotted"), (F.element_at("t", -1) == BROKEN).alias("broken"), F.get("raw", n - 1 - back).alias("last"),
        at(n - 1 - back).alias("c"), at(n - 2 - back).alias("b"), at(n - 3 - back).alias("a"),
    )
    lasts = lasts.join(closing.select(F.col("next").alias("c"), F.col("closes").alias("mark")), "c", "left").where("dotted OR broken OR mark IS NULL")
    lasts = cut(_with_kinds(lasts))
    open_ends = _look_up(lasts.where("NOT dotted"), grams, ("source",), ("internal", "terminal"))
    dots = _look_up(lasts.where("dotted"), grams, (), ("internal", "closed"))
    kept = ["key", "source", "last", "mark", "broken"]
    none = F.lit(None).cast("double")
    scored = open_ends.select(*kept, F.when(F.col("mark").isNull(), _end_rate()).alias("end_rate"), none.alias("close_rate"))
    scored = scored.unionByName(dots.select(*kept, none.alias("end_rate"), _close_rate().alias("close_rate")))
    scored = cut(scored.withColumn("ending", F.when(F.col("mark").isNull() & _spelt(F.col("last")), _ending(F.lower("last"), F.length("last")))))
    letters = _letters(texts).join(small_side(cut(scored.select("ending").where("ending IS NOT NULL").distinct())), "ending", "left_semi")
    letter_rate = F.when(F.col("inside") > 0, (F.col("ends") + LETTER_WEIGHT) / (F.col("inside") + F.col("ends") + LETTER_WEIGHT))
    scored = scored.join(small_side(cut(letters)), "ending", "left").select("key", "source", "broken", "end_rate", "close_rate", letter_rate.alias("letter_rate"))
    return copies.select("doc_id", "source", "key").join(small_side(cut(scored)), ["source", "key"]).drop("key")


def truncated(documents: DataFrame) -> DataFrame:
    """(doc_id, source) of the texts that were cut, by :func:`ending_scores`.

    ``documents`` has doc_id, text and source; other columns are ignored. Null, empty
    and blank texts are not cut; a null source is a source of its own. Texts of a source
    with the same tokens are counted and judged once, so copies do not vouch for each
    other; each of their rows is returned.
    """
    cut_off = F.col("broken") | (F.col("end_rate") < END_RATE) | (F.col("close_rate") < CLOSE_RATE) | (F.col("letter_rate") < LETTER_RATE)
    return ending_scores(documents).where(cut_off).select("doc_id", "source")


def truncation_rates(documents: DataFrame) -> DataFrame:
    """Per source: texts, cut texts and their share."""
    texts = documents.where("text IS NOT NULL").groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("texts"))
    found = truncated(documents).groupBy("source").agg(F.count("*").alias("cut"))
    share = F.col("cut") / F.col("texts")
    return texts.join(found, "source", "left").select("source", "texts", F.coalesce("cut", F.lit(0)).alias("cut"), F.coalesce(share, F.lit(0.0)).alias("share"))


def _kind_sql(t: str) -> str:
    return (
        f"CASE WHEN {t} IN ('<n>', '<N>', '') THEN {t} WHEN regexp_matches({t}, '^\\p{{Han}}') THEN '<h>' "
        f"WHEN regexp_matches({t}, '^\\p{{Latin}}') THEN '<w>' WHEN regexp_matches({t}, '^\\p{{L}}') THEN '<v>' ELSE {t} END"
    )


#: The same result in DuckDB's SQL, for tests.
TRUNCATED_SQL = rf"""WITH d AS (SELECT doc_id, coalesce(source, '') AS source, regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(text,
    '[\p{{Cf}}\x{{FE00}}-\x{{FE0F}}]', '', 'g'), '\.{{3,}}', '…', 'g'), '([\p{{Han}}\p{{Hiragana}}\p{{Katakana}}])', ' \1 ', 'g'),
    '(?:[\p{{L}}\p{{N}}]\p{{M}}*)+|[^\s\p{{Z}}\p{{C}}\p{{L}}\p{{N}}\p{{M}}]') AS raw FROM documents WHERE text IS NOT NULL),
  u AS (SELECT DISTINCT source, raw FROM d WHERE len(raw) > 0),
  s AS (SELECT source, raw, len(raw) AS n, list_transform(raw, lambda w: CASE WHEN regexp_full_match(w, '\p{{N}}+') THEN '<n>' WHEN regexp_matches(w, '^\p{{Lu}}') THEN '<N>' ELSE lower(w) END) AS t FROM u),
  g AS (SELECT source, CASE WHEN i > 2 THEN t[i - 2] ELSE '' END AS a, CASE WHEN i > 1 THEN t[i - 1] ELSE '' END AS b, t[i] AS c, CASE WHEN i < n THEN t[i + 1] END AS nx
    FROM (SELECT source, t, n, unnest(range(1, n + 1)) AS i FROM s)),
  marks AS (SELECT c AS m FROM g WHERE NOT regexp_matches(c, '^[<\p{{L}}\p{{N}}]') AND c <> '…' GROUP BY c HAVING count(*) FILTER (nx IS NULL) >= {MARK_RATE} * count(*)),
  q AS (SELECT source, a, b, c, {_kind_sql('a')} AS ka, {_kind_sql('b')} AS kb, {_kind_sql('c')} AS kc, count(nx) AS i, count(*) - count(nx) AS t, count(m) AS h FROM g LEFT JOIN marks ON nx = m GROUP BY ALL),
  z AS (SELECT source, raw, t[-1] = '…' AS dotted, t[-1] = '{BROKEN}' AS broken, raw[e] AS last, t[e] AS c, CASE WHEN e > 1 THEN t[e - 1] ELSE '' END AS b, CASE WHEN e > 2 THEN t[e - 2] ELSE '' END AS a
    FROM (SELECT *, n - (CASE WHEN t[-1] = '…' AND n > 1 THEN 1 ELSE 0 END) AS e FROM s)),
  y AS (SELECT *, {_kind_sql('a')} AS ka, {_kind_sql('b')} AS kb, {_kind_sql('c')} AS kc FROM z),
  s3 AS (SELECT source, a, b, c, sum(i) AS i3, sum(t) AS t3 FROM q GROUP BY ALL), s2 AS (SELECT source, ka, kb, c, sum(i) AS i2, sum(t) AS t2 FROM q GROUP BY ALL),
  s1 AS (SELECT source, ka, kb, kc, sum(i) AS i1, sum(t) AS t1 FROM q GROUP BY ALL),
  s0 AS (SELECT source, kc, sum(i) AS i0, sum(t) AS t0 FROM q GROUP BY ALL),
  g3 AS (SELECT a, b, c, sum(i) AS j3, sum(h) AS h3 FROM q GROUP BY ALL), g2 AS (SELECT ka, kb, c, sum(i) AS j2, sum(h) AS h2 FROM q GROUP BY ALL), g1 AS (SELECT ka, kb, kc, sum(i) AS j1, sum(h) AS h1 FROM q GROUP BY ALL),
  w AS (SELECT lower(v) AS v, count(*) AS n FROM (SELECT unnest(raw[1 : greatest(n - 2, 0)]) AS v FROM s) WHERE regexp_matches(v, '^\p{{L}}') AND NOT regexp_matches(v, '^\p{{Han}}') GROUP BY 1),
  p AS (SELECT substring('^' || v, greatest(i - {LETTERS - 2}, 1) :: BIGINT, least(i + 1, {LETTERS}) :: BIGINT) AS ending, n, i < length(v) AS inner_ FROM (SELECT v, n, unnest(range(1, length(v) + 1)) AS i FROM w)),
  e AS (SELECT ending, coalesce(sum(n) FILTER (inner_), 0) AS inside, coalesce(sum(n) FILTER (NOT inner_), 0) AS ends FROM p GROUP BY ending),
  r AS (SELECT y.*, marks.m IS NULL AS open_, coalesce(inside,0) AS inside, coalesce(ends,0) AS ends,
    coalesce(i0,0) AS i0, greatest(coalesce(t0, 0) - 1, 0) AS t0, coalesce(i1,0) AS i1, greatest(coalesce(t1, 0) - 1, 0) AS t1, coalesce(i2,0) AS i2, greatest(coalesce(t2, 0) - 1, 0) AS t2, coalesce(i3,0) AS i3, greatest(coalesce(t3, 0) - 1, 0) AS t3,
    coalesce(j1,0) AS j1, coalesce(h1,0) AS h1, coalesce(j2,0) AS j2, coalesce(h2,0) AS h2, coalesce(j3,0) AS j3, coalesce(h3,0) AS h3
    FROM y LEFT JOIN s3 USING (source, a, b, c) LEFT JOIN s2 USING (source, ka, kb, c) LEFT JOIN s1 USING (source, ka, kb, kc) LEFT JOIN s0 USING (source, kc)
    LEFT JOIN g3 USING (a, b, c) LEFT JOIN g2 USING (ka, kb, c) LEFT JOIN g1 USING (ka, kb, kc) LEFT JOIN marks ON y.c = m
    LEFT JOIN e ON e.ending = CASE WHEN regexp_matches(last, '^\p{{L}}') AND NOT regexp_matches(last, '^\p{{Han}}')
      THEN substring('^' || lower(last), greatest(length(last) - {LETTERS - 2}, 1) :: BIGINT, least(length(last) + 1, {LETTERS}) :: BIGINT) END),
  f0 AS (SELECT *, t0 / greatest(t0 + i0, 1) AS r0 FROM r), f1 AS (SELECT *, CASE WHEN i1 >= {SEEN} AND r0 <= {HEADLINE_RATE} THEN (t1 + {BACKOFF} * r0) / (t1 + i1 + {BACKOFF}) ELSE r0 END AS r1 FROM f0),
  f2 AS (SELECT *, CASE WHEN i2 >= {SEEN} THEN (t2 + {BACKOFF} * r1) / (t2 + i2 + {BACKOFF}) ELSE r1 END AS r2 FROM f1),
  f AS (SELECT *, CASE WHEN dotted OR NOT open_ OR NOT (i3 >= {SEEN} OR i2 >= {SEEN} OR i0 >= {SEEN} AND r0 <= {HEADLINE_RATE}) THEN NULL WHEN i3 >= {SEEN} THEN (t3 + {BACKOFF} * r2) / (t3 + i3 + {BACKOFF}) ELSE r2 END AS end_rate,
    CASE WHEN dotted THEN (h3 + {CLOSE_BACKOFF} * (h2 + {CLOSE_BACKOFF} * h1 / greatest(j1, 1)) / (j2 + {CLOSE_BACKOFF})) / (j3 + {CLOSE_BACKOFF}) END AS close_rate,
    CASE WHEN open_ AND inside > 0 THEN (ends + {LETTER_WEIGHT}) / (inside + ends + {LETTER_WEIGHT}) END AS letter_rate FROM f2)
SELECT doc_id FROM d JOIN f USING (source, raw) WHERE broken OR end_rate < {END_RATE} OR close_rate < {CLOSE_RATE} OR letter_rate < {LETTER_RATE}"""
