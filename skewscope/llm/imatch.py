"""I-Match fingerprints with randomised lexicons; DataFrame functions only.

The lexicon is the band of terms whose document frequency lies between N^0.2 and N^0.8 (N rows): idf is
neither among the least nor the most. It is dealt at random, by a hash of the term, to ``SUBS`` sub-lexicons, so
every term of it belongs to one. A text's distinct terms of the lexicon are sorted; its fingerprint holds, for each sub-lexicon
that meets the text, a hash of its sorted terms in it. The likeness of two fingerprints is the share of sub-lexicons with
equal hashes among those that meet either text. A text without any term of the lexicon has a hash of the whole text instead.

Work: one pass counts the terms of all rows (partial aggregates). Then the rows are dealt once, texts and all, into ranges of
about ``RANGE_ROWS`` rows in descending doc_id, and all else happens where they lie: the next row, the edited text, the look-up of the terms
of both texts (the lexicon is broadcast up to ``BROADCAST_ROWS`` terms, joined by shuffle beyond), their hashes and the likeness to the
next row's. The first row of each range is dealt to the range before as well, as its end, so no text is sent twice otherwise and none is
broadcast. A doc_id with many rows (null too) has ranges of its own, cut by the hash of the text.

Defined results: a null text counts as empty; rows of one doc_id are ordered by their row hash and null doc_ids
come last; a single row is its own next; repeated rows get equal fingerprints; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skewscope.llm.common import read, save, whole_text
from skewscope.llm.decontaminate import SEPARATORS
from skewscope.llm.url_rules import LOWER, UPPER

SUBS = 32
LOW, HIGH = 0.2, 0.8
BROADCAST_ROWS = 1_000_000
#: Rows of a range, until there are MAX_RANGES of them; a doc_id of over HOT ranges' rows is cut (at most HOT_IDS such ids).
RANGE_ROWS, MAX_RANGES, HOT, HOT_IDS = 2_000, 100_000, 4, 10_000
_PLACE = ("part", "sub")


def distinct_terms(text: Column) -> Column:
    return F.array_remove(F.array_distinct(F.split(F.translate(text, UPPER, LOWER), SEPARATORS)), "")


def lexicon(rows: DataFrame, n: int) -> DataFrame:
    """Terms of ``text`` whose document frequency lies in the band: ``term`` and its sub-lexicon ``lex``."""
    df = rows.select(F.explode(distinct_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    number = F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 2), 16, 10).cast("int")
    return df.where(F.col("df").between(n ** LOW, n ** HIGH)).select("term", (number % SUBS).alias("lex"))


def in_sub(lex: Column, term: Column) -> Column:
    """A term of a sub-lexicon as ``fingerprint`` takes it: two hex digits, \\x01, the term (which holds no control characters)."""
    return F.concat(F.lpad(F.lower(F.hex(lex)), 2, "0"), F.lit("\x01"), term)


def fingerprint(terms: Column) -> Column:
    """``sub:hash`` per sub-lexicon, from an array of ``in_sub`` terms.

    A marker sorts before each sub-lexicon's terms; the sorted terms are joined to one text, which the markers part again.
    """
    marks = F.array(*[F.lit(f"{k:02x}\x00") for k in range(SUBS)])
    joined = F.array_join(F.sort_array(F.concat(terms, marks)), "\x02")  # sort_array: unlike array_sort, no lambda
    pieces = F.split(F.regexp_replace(joined, "\x02[0-9a-f]{2}\x01", " "), "\x02")  # 1f\x00 first second ..
    return F.transform(F.filter(pieces, lambda p: F.length(p) > 3), lambda p: F.concat(
        F.substring(p, 1, 2), F.lit(":"), F.substring(F.md5(F.substring(p, 5, 1 << 30).cast("binary")), 1, 8)))


def or_whole(prints: str, whole: Column) -> Column:
    """The print, or the hash of the whole text that stands in for an empty one."""
    return F.when(F.size(prints) > 0, F.col(prints)).otherwise(F.array(F.concat(F.lit("t:"), whole)))


def likeness(a: str, b: str) -> Column:
    slot = lambda x: F.transform(x, lambda s: F.substring(s, 1, 2))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(slot(a), slot(b))).cast("double")


def _in_ranges(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` with (part, sub): part rises with doc_id (-1: null), sub within a part with the row hash."""
    parts = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    most = max(HOT * RANGE_ROWS, n // HOT_IDS)
    per = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > most)
    hot = per.select(F.col("doc_id").alias("hot_id"), F.ceil(F.col("n") / RANGE_ROWS).alias("pieces")).collect()  # at most HOT_IDS
    cuts = set(rows.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts)) if parts > 1 else set()
    cuts |= {float(h["hot_id"]) + d for h in hot if h["hot_id"] is not None for d in (0, 1)}
    place = F.lit(0)
    if cuts:
        splits = [-math.inf, *sorted(cuts), math.inf]
        rows = Bucketizer(splits=splits, inputCol="_id", outputCol="_part").transform(
            rows.withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
        place = F.col("_part").cast("int")
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), -1).otherwise(place)).drop("_id", "_part")
    if not hot:
        return rows.withColumn("sub", F.lit(0))
    pieces = F.broadcast(rows.sparkSession.createDataFrame(hot, "hot_id long, pieces long"))
    rows = rows.join(pieces, F.col("doc_id").eqNullSafe(F.col("hot_id")), "left")
    share = F.col("row_hash").cast("double") / 2.0 ** 64 + 0.5
    sub = F.least(F.floor(share * F.col("pieces")), F.col("pieces") - 1)
    return rows.withColumn("sub", F.coalesce(sub, F.lit(0)).cast("int")).drop("hot_id", "pieces")


def with_next(docs: DataFrame) -> DataFrame:
    """part, sub, place, doc_id, row_hash, text, next_doc, next_text: the next row in descending doc_id, then the first.

    Where ``ends`` is set, the row is the first of the range after, which stands at the end of this one.
    """
    rows = whole_text(docs)
    rows = _in_ranges(rows, rows.count())
    # Per range its first row; it goes to the range before, the very first one to the last range.
    top = F.max(F.struct("doc_id", F.bitwise_not("row_hash").alias("h")))
    heads = save(rows.groupBy(*_PLACE).agg(top.alias("top")).select(
        *_PLACE, F.col("top.doc_id").alias("head_doc"), F.bitwise_not("top.h").alias("head_hash")))
    order = Window.orderBy(F.desc("part"), F.asc("sub"))  # over one small row per range
    last = F.last(F.struct(*_PLACE)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    goes = save(heads.select("head_doc", "head_hash", F.coalesce(F.lag(F.struct(*_PLACE)).over(order), last).alias("to")))
    small = F.broadcast(goes) if goes.count() <= BROADCAST_ROWS else goes
    met = rows.drop(*_PLACE).join(small, F.col("doc_id").eqNullSafe(F.col("head_doc")) & (F.col("row_hash") == F.col("head_hash")))
    ends = met.groupBy("to").agg(*[F.first(c).alias(c) for c in ("doc_id", "row_hash", "text")])
    both = rows.withColumn("ends", F.lit(False)).unionByName(
        ends.select("doc_id", "row_hash", "text", "to.part", "to.sub", F.lit(True).alias("ends")))
    w = Window.partitionBy(*_PLACE).orderBy("ends", F.desc_nulls_last("doc_id"), "row_hash")
    return both.select(*_PLACE, F.row_number().over(w).alias("place"), "ends", "doc_id", "row_hash", "text",
                       F.lead("doc_id").over(w).alias("next_doc"), F.lead("text").over(w).alias("next_text"))


def edit_table(docs: DataFrame) -> DataFrame:
    """``with_next`` with the edited text."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    return with_next(docs).withColumn("edited", F.when(~F.col("ends"), F.concat(
        F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))))


def imatch(docs: DataFrame) -> DataFrame:
    rows = whole_text(docs)
    lex = save(lexicon(rows, max(1, rows.count())))
    lex = F.broadcast(lex) if lex.count() <= BROADCAST_ROWS else lex
    whole = lambda c: F.md5(F.col(c).cast("binary"))
    own = F.struct("doc_id", "ends", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                   whole("text").alias("whole"), whole("edited").alias("edited_whole"))
    version = lambda c, v: F.transform(distinct_terms(F.coalesce(c, F.lit(""))), lambda t: F.struct(
        F.lit(v).alias("version"), t.alias("term")))
    terms = edit_table(docs).select(*_PLACE, "place", own.alias("own"), F.posexplode_outer(
        F.concat(version("text", 0), version("edited", 1))).alias("at", "x"))
    # What is not a term stands beside a row's first term only.
    terms = terms.select(*_PLACE, "place", F.when(F.coalesce("at", F.lit(0)) == 0, F.col("own")).alias("own"), "x.version", "x.term")
    met = terms.join(lex, "term", "left").where("lex IS NOT NULL OR own IS NOT NULL")
    held = in_sub(F.col("lex"), F.col("term"))
    of = lambda v: F.collect_list(F.when(F.col("version") == v, held))  # noqa: E731  (nulls are left out)
    both = met.groupBy(*_PLACE, "place").agg(F.first("own", ignorenulls=True).alias("own"), of(0).alias("t"), of(1).alias("e"))
    both = both.select(*_PLACE, "place", "own.*", fingerprint(F.col("t")).alias("p"), fingerprint(F.col("e")).alias("ep"))
    both = both.withColumn("p", or_whole("p", F.col("whole"))).withColumn("ep", or_whole("ep", F.col("edited_whole")))
    w = Window.partitionBy(*_PLACE).orderBy("place")
    out = both.withColumn("next_p", F.lead("p").over(w)).where("NOT ends")
    return out.select("doc_id", "n_chars", "edited_sha256", F.array_join("p", " ").alias("fingerprint"),
                      F.array_join("ep", " ").alias("edited_fingerprint"), likeness("p", "ep").alias("near_edited"),
                      likeness("p", "next_p").alias("near_next"))


def op7_imatch(spark, sf_dir: str) -> DataFrame:
    return imatch(read(spark, sf_dir, "documents"))


_TERMS = r"""list_distinct(list_filter(string_split_regex(translate({t}, '{u}', '{l}'), '{s}'), lambda w: w <> ''))"""


def _terms(t: str) -> str:
    return _TERMS.format(t=t, u=UPPER, l=LOWER, s=SEPARATORS)


_LIKE = """len(list_intersect({a}, {b})) / len(list_distinct(list_concat(list_transform({a}, lambda x: x[1:2]),
    list_transform({b}, lambda x: x[1:2]))))::DOUBLE"""
#: For tables without repeated or null doc_ids, as the given ones are.
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id DESC) AS k, count(*) OVER () AS n FROM d),
e AS (SELECT o.doc_id, o.text, p.doc_id AS next_doc, o.n,
             substr(o.text, 1, length(o.text) - length(o.text) // 2) || substr(p.text, 1, length(o.text) // 2) AS edited
      FROM o JOIN o p ON p.k = o.k % o.n + 1),
t AS (SELECT *, {_terms("text")} AS terms, {_terms("edited")} AS eterms FROM e),
lex AS (SELECT term, ('0x' || md5(term)[1:2])::BIGINT % {SUBS} AS sub
        FROM (SELECT unnest(terms) AS term, n FROM t) GROUP BY term, n
        HAVING count(*) BETWEEN pow(n, {LOW}) AND pow(n, {HIGH})),
x AS (SELECT doc_id, 0 AS v, unnest(terms) AS term FROM t UNION ALL SELECT doc_id, 1, unnest(eterms) FROM t),
s AS (SELECT doc_id, v, printf('%02x:', sub) || md5(string_agg(term, ' ' ORDER BY term))[1:8] AS part
      FROM x JOIN lex USING (term) GROUP BY doc_id, v, sub),
f AS (SELECT doc_id, v, list(part ORDER BY part) AS p FROM s GROUP BY doc_id, v),
q AS (SELECT t.doc_id, next_doc, text, edited, coalesce(a.p, ['t:' || md5(text)]) AS p,
             coalesce(b.p, ['t:' || md5(edited)]) AS ep
      FROM t LEFT JOIN f a ON a.doc_id = t.doc_id AND a.v = 0 LEFT JOIN f b ON b.doc_id = t.doc_id AND b.v = 1)
SELECT q.doc_id, length(q.text)::BIGINT AS n_chars, sha256(q.edited) AS edited_sha256,
       array_to_string(q.p, ' ') AS fingerprint, array_to_string(q.ep, ' ') AS edited_fingerprint,
       {_LIKE.format(a="q.p", b="q.ep")} AS near_edited, {_LIKE.format(a="q.p", b="z.p")} AS near_next
FROM q JOIN q z ON z.doc_id = q.next_doc
"""
