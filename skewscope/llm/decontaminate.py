"""Benchmark decontamination with a positional inverted index; DataFrame functions only.

``build_index`` stores the postings (document row, position, term) of the benchmark's terms over all
training text as a Parquet table. ``search`` takes windows of terms, ranks the terms of each by
how often they occur in the corpus, and intersects offset-adjusted position lists: first the
two rarest terms', then, inside the documents still in question, the others'. ``slop`` 0
gives exact phrases; with a larger one each term may stand up to that many positions from where the
phrase would put it (proximity matches).

Sizes: the term table and the lists' windows come from the benchmark; they are broadcast only up to
``BROADCAST_ROWS`` rows and joined by shuffle beyond it, as are the keys of the documents in question.
No list is gathered into one task: lists are rows, intersected by joins on (row, window, start).

Words are lower-cased (A-Z) runs outside of ASCII other than digits and letters. A window has ``size``
words of an item; an item of fewer words, but not none, is one window.

Defined results: null texts have no words and no hits; items without words or with a null item_id
match nothing in the list of items (their words still count as hits if the text is there); equal
windows of several items count for each of them; repeated rows get equal results; an empty benchmark
leaves all documents clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skewscope.llm.common import attach, decide, discard, read, save, whole_text
from skewscope.llm.url_rules import LOWER, UPPER

SIZE = 10
BROADCAST_ROWS = 1_000_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Stands after the last word of every document; no word can hold it.
END = "\n"


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), lambda w: w != "")


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def windows_of(benchmark: DataFrame, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """Saved tables: distinct windows (wid, words) and which items have them (wid, item_id)."""
    w = words(F.coalesce(F.col("text").cast("string"), F.lit("")))
    items = benchmark.select("item_id", w.alias("w")).where(F.size("w") > 0)
    rows = items.select("item_id", "w", F.explode(F.sequence(F.lit(1), F.greatest(
        F.lit(1), F.size("w") - size + 1))).alias("at")).select("item_id", F.slice("w", F.col("at"), size).alias("words"))
    windows = save(rows.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()))
    return windows, save(rows.join(windows, "words").select("wid", "item_id").distinct())


def build_index(docs: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Saved tables: terms (term, term_id) and postings (doc_id, row_hash, pos, term_id).

    The term END marks each row's end: its position is the row's number of words.
    """
    spark = docs.sparkSession
    found = windows.select(F.explode("words").alias("term")).distinct()
    terms = save(found.withColumn("term_id", F.monotonically_increasing_id() + 1)
                 .unionByName(spark.createDataFrame([(END, 0)], "term string, term_id long")))
    placed = whole_text(docs).select("doc_id", "row_hash", F.posexplode(
        F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("pos", "term"))
    return terms, save(placed.join(_small(terms), "term").select("doc_id", "row_hash", "pos", "term_id"))


def search(index: DataFrame, windows: DataFrame, terms: DataFrame, slop: int = 0) -> DataFrame:
    """doc_id, row_hash, wid, start of every match of a window (words) in the indexed text."""
    counts = index.where("term_id > 0").groupBy("term_id").agg(F.count("*").alias("n"))
    ranked = (windows.select("wid", F.size("words").alias("len"), F.posexplode("words").alias("off", "term"))
              .join(terms, "term").join(counts, "term_id", "left")
              .withColumn("rank", F.row_number().over(Window.partitionBy("wid").orderBy("n", "off"))))
    ranked = save(ranked.select("wid", "len", "off", "term_id", "rank"))

    def lists(which: DataFrame) -> DataFrame:
        return (index.join(_small(which), "term_id")
                .select("doc_id", "row_hash", "wid", "len", "rank", (F.col("pos") - F.col("off")).alias("start")))

    def meets(some: DataFrame, others: DataFrame) -> Column:
        same = some["doc_id"].eqNullSafe(others["o_doc"]) & (some["row_hash"] == others["o_hash"]) & (
            some["wid"] == others["o_wid"])
        if slop == 0:
            return same & (some["start"] == others["o_start"])
        return same & (some["bin"] == others["o_bin"]) & (F.abs(some["start"] - others["o_start"]) <= slop)

    def binned(df: DataFrame) -> DataFrame:
        """Starts within ``slop`` share a bin of the first with a neighbouring bin of the other."""
        if slop == 0:
            return df
        b = F.floor(F.col("o_start") / (slop + 1))
        return df.withColumn("o_bin", F.explode(F.array(b - 1, b, b + 1)))

    def other(df: DataFrame) -> DataFrame:
        return binned(df.select(F.col("doc_id").alias("o_doc"), F.col("row_hash").alias("o_hash"),
                                F.col("wid").alias("o_wid"), F.col("start").alias("o_start"), "rank"))

    first = lists(ranked.where("rank = 1")).where(F.col("start") >= (0 if slop == 0 else -slop)).drop("rank")
    if slop:
        first = first.withColumn("bin", F.floor(F.col("start") / (slop + 1)))
    second = other(lists(ranked.where("rank = 2")))
    # One-word windows have no second list.
    pairs = first.where("len > 1").join(second, meets(first, second), "leftsemi")
    open_ = save(pairs.unionByName(first.where("len = 1")))
    docs = open_.where("len > 2").select("doc_id", "row_hash").distinct()
    here = _small(docs.select(F.col("doc_id").alias("k_doc"), F.col("row_hash").alias("k_hash")))
    left = index.join(here, index["doc_id"].eqNullSafe(here["k_doc"]) & (index["row_hash"] == here["k_hash"]),
                      "leftsemi")
    # The remaining terms: each candidate expects them at their places; a bit for each one found.
    expected = open_.where("len > 2").join(
        _small(ranked.where("rank > 2").select("wid", "off", "term_id", "rank")), "wid")
    if slop == 0:
        at = expected.withColumn("p", F.col("start") + F.col("off"))
        met = at.join(left.select(F.col("doc_id").alias("o_doc"), F.col("row_hash").alias("o_hash"),
                                  F.col("pos").alias("o_pos"), F.col("term_id").alias("o_term")),
                      F.col("doc_id").eqNullSafe(F.col("o_doc")) & (F.col("row_hash") == F.col("o_hash"))
                      & (F.col("p") == F.col("o_pos")) & (F.col("term_id") == F.col("o_term")), "leftsemi")
    else:
        rest = other(left.join(_small(ranked.where("rank > 2")), "term_id").select(
            "doc_id", "row_hash", "wid", "rank", (F.col("pos") - F.col("off")).alias("start")))
        expected = expected.withColumnRenamed("rank", "want")
        met = expected.join(rest, meets(expected, rest) & (F.col("want") == F.col("rank")), "leftsemi") \
            .withColumnRenamed("want", "rank")
    key = ["doc_id", "row_hash", "wid", "len", "start"]
    full = (met.groupBy(*key).agg(F.countDistinct("rank").alias("n")).where(F.col("n") == F.col("len") - 2)
            .select(*key))
    return full.unionByName(open_.where("len <= 2").select(*key).distinct())


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per document row: doc_id, row_hash, n_words, n_hit, items (sorted ids as strings)."""
    windows, owners = windows_of(benchmark, size)
    terms, index = build_index(docs, windows)
    matches = save(search(index, windows, terms))
    hit = (matches.select("doc_id", "row_hash", "start", "len").distinct()
           .select("doc_id", "row_hash", F.explode(F.expr("sequence(start, start + len - 1)")).alias("p"))
           .distinct().groupBy("doc_id", "row_hash").agg(F.count("*").alias("n_hit")))
    items = (matches.select("doc_id", "row_hash", "wid").distinct().join(_small(owners), "wid")
             .groupBy("doc_id", "row_hash").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")))
    rows = save(index.where("term_id = 0").select("doc_id", "row_hash", F.col("pos").cast("long").alias("n_words")))
    discard(index)
    out = attach(attach(rows, hit, ["n_hit"]), items, ["items"])
    return out.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)),
                            "items": F.array_sort(F.coalesce("items", F.expr("cast(array() as array<string>)")))})


def op5_positional_index(spark, sf_dir: str) -> DataFrame:
    out = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any word inside a benchmark window, with their own columns."""
    found = contamination(docs, read(spark, sf_dir, "benchmark")).where("n_hit > 0")
    bad = found.select("doc_id", "row_hash", F.lit(True).alias("_llm_bad")).distinct()
    out = decide(docs, bad, ["_llm_bad"])
    return out.where(F.col("_llm_bad").isNull()).drop("_llm_bad")


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, array_to_string(w[k:k + {SIZE - 1}], ' ') AS win, least(len(w), {SIZE}) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {SIZE - 1}, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
dw AS (
  SELECT n, k, size, array_to_string(w[k:k + size - 1], ' ') AS win
  FROM (SELECT n, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
m AS (SELECT n, k, dw.size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
h AS (SELECT n, count(DISTINCT p) AS n_hit
      FROM (SELECT n, unnest(range(k, k + size)) AS p FROM (SELECT DISTINCT n, k, size FROM m)) GROUP BY n),
i AS (SELECT n, list(DISTINCT item_id::VARCHAR ORDER BY item_id::VARCHAR) FILTER (item_id IS NOT NULL) AS items
      FROM m GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (n) LEFT JOIN i USING (n)
"""
