"""Near-duplicates by b-bit MinHash, confirmed on full shingle sets.

1. Each text's distinct word shingles give 128 minima, kept in two forms: 32 band keys of 4 whole minima,
   and the lowest 2 bits of every minimum, packed into 4 longs.
2. Texts with equal shingle sets (size and two 64-bit sums of the set) form one class.
3. Classes that share a band key are candidates. First each is paired only with the least of its bucket (a star,
   never all pairs). Pairs whose collision-corrected similarity, from bit counts of the packed
   signatures, is at least ``0.8 - MARGIN`` are confirmed on the shingles themselves, and components built.
4. Buckets that still hold several components are joined with themselves on (bucket, size class), between
   components only, under the same estimate and an exact bound, and confirmed likewise: this finds what a star
   cannot. A component with most of a bucket's rows meets only those outside it, so large components cost no pairs of
   their own. The bound: each shingle flips one of ``PARITY`` bits of its set, so the bits in which two sets differ are never
   more than the shingles in which they do; pairs with too many are below the similarity for certain.
5. A bucket with more than ``HOT_PARTNERS`` partners for each class (texts of one template, say) is not joined: its classes get
   ``DEEP_BANDS`` narrower buckets of ``DEEP_ROWS`` fresh minima each, which unlike texts of one template hardly share, and those
   are joined in its place.

A pair at similarity 0.8 shares no band with probability 5e-8 and falls below the estimate's margin
with about 1e-7, and shares no narrow band with 4e-7; higher similarities are missed less. Buckets and classes are only aggregated or joined, never
gathered; no count of partners is capped.

Defined results: null and empty texts and texts without words have no shingles and link with nothing; a text
of fewer words than a shingle is one shingle; rows that repeat a doc_id count as one document; rows with a null
doc_id stay alone (component_id null, kept); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skewscope.llm.common import decide, discard, read, save, whole_text
from skewscope.llm.components import components

HASHES, BANDS, BITS = 128, 32, 2
PARITY = 2048
MARGIN = 0.22
#: A bucket whose classes have more partners in other components than this, on average, is replaced by narrower ones.
HOT_PARTNERS = 2_000
DEEP_BANDS, DEEP_ROWS = 130, 10
#: Buckets of fewer rows are joined as they are, without size classes and levels.
LARGE = 16
BROADCAST_ROWS = 1_000_000
_RNG = np.random.default_rng(20_240_607)
_MUL = (_RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_XOR = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def words(text: str) -> list[bytes]:
    """Runs of anything but the six ASCII blanks, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(found: list[bytes], size: int) -> np.ndarray:
    """64-bit hashes of the distinct ``size``-word shingles (fewer words: the whole sequence)."""
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    size = min(size, len(found))
    out = h[: len(h) - size + 1]
    for k in range(1, size):
        out = _mix(out) + h[k: len(h) - size + 1 + k]
    return np.unique(_mix(out))


def minima(hashes: np.ndarray, xor: np.ndarray = _XOR, mul: np.ndarray = _MUL) -> np.ndarray:
    low = np.full(len(xor), 0xFFFFFFFF, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    step = max(1, 2048 * HASHES // len(xor))
    for k in range(0, len(short), step):
        np.minimum(low, ((short[k:k + step, None] ^ xor) * mul).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, bands: int) -> np.ndarray:
    """One key for each of ``bands`` equal parts of the minima."""
    whole = low.reshape(bands, -1).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(whole.shape[1]):
        key = _mix(key) + whole[:, k]
    return _mix(key).view(np.int64)


def sketch(text: str, size: int) -> tuple:
    """n, sum, mixed sum, four longs of packed low bits, band keys, parity bits."""
    u = shingle_hashes(words(text), size)
    if not len(u):
        return 0, 0, 0, 0, 0, 0, 0, [], []
    low = minima(u)
    bits = (low[:, None] >> np.arange(BITS, dtype=np.uint32)) & np.uint32(1)
    packed = np.packbits(bits.astype(np.uint8).ravel()).view(np.int64)
    flips = np.bincount((u & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    parity = np.packbits(flips.astype(np.uint8)).view(np.int64)
    sums = np.array([u.sum(), _mix(u ^ _ODD).sum()], np.uint64).view(np.int64)
    return len(u), int(sums[0]), int(sums[1]), *map(int, packed), band_keys(low, BANDS).tolist(), parity.tolist()


SKETCH = ("doc_id long, row_hash long, n long, f1 long, f2 long, s0 long, s1 long, s2 long, s3 long, "
          "bands array<long>, parity array<long>")


def sketches(docs: DataFrame, size: int) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [sketch(t, size) for t in pdf["text"]]
            out = pd.DataFrame(got, columns=["n", "f1", "f2", "s0", "s1", "s2", "s3", "bands", "parity"])
            out.insert(0, "row_hash", pdf["row_hash"].to_numpy())
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield out

    return whole_text(docs).mapInPandas(rows, SKETCH)


def estimate(a: str, b: str) -> Column:
    """Collision-corrected similarity of two packed signatures (column prefixes ``a`` and ``b``)."""
    agree = F.lit(0)
    for k in range(4):
        differ = F.col(f"{a}s{k}").bitwiseXOR(F.col(f"{b}s{k}"))
        either = differ.bitwiseOR(F.shiftright(differ, 1)).bitwiseAND(F.lit(0x5555555555555555))
        agree = agree + 32 - F.bit_count(either)
    chance = 2.0 ** -BITS
    return (agree / float(HASHES) - chance) / (1 - chance)


def fits(a: str, b: str, percent: int) -> Column:
    """True where sizes allow ``percent`` and the estimate is not below it by more than ``MARGIN``."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (estimate(a, b) >= percent / 100 - MARGIN)


def surely_apart(a: str, b: str, percent: int) -> Column:
    """True where the parity bits of two sets prove their similarity to be below ``percent``."""
    differ = F.lit(0)
    for k in range(PARITY // 64):
        differ = differ + F.bit_count(F.col(f"{a}p{k}").bitwiseXOR(F.col(f"{b}p{k}")))
    return differ * (100 + percent) > (F.col(f"{a}n") + F.col(f"{b}n")) * (100 - percent)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def class_texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the classes ``nodes``."""
    known = _small(classes.select("node", "rep_hash").join(nodes, "node", "leftsemi"))
    texts = whole_text(docs)
    texts = texts.join(known, (texts["doc_id"] == known["node"]) & (texts["row_hash"] == known["rep_hash"]))
    return texts.select("node", "text").dropDuplicates(["node"])


def deep_buckets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, key) of narrower buckets, ``DEEP_BANDS`` bands of ``DEEP_ROWS`` minima of their own."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(7_031_907)
        mul = (rng.integers(0, 1 << 31, DEEP_BANDS * DEEP_ROWS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        xor = rng.integers(0, 1 << 32, DEEP_BANDS * DEEP_ROWS, dtype=np.uint32)
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                one = pdf.iloc[at:at + 1000]
                keys = [band_keys(minima(shingle_hashes(words(t), size), xor, mul), DEEP_BANDS) for t in one["text"]]
                yield pd.DataFrame({"node": np.repeat(one["node"].to_numpy(), DEEP_BANDS), "key": np.concatenate(keys)})

    return class_texts(nodes, classes, docs).mapInPandas(rows, "node long, key long")


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach ``percent`` of intersection over union."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = save(class_texts(nodes, classes, docs))
    both = (pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
            .join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def full(text: str) -> set:
            found = words(text)
            return set(zip(*(found[k:] for k in range(min(size, len(found))))))

        seen, last = None, None
        for pdf in batches:
            keep = []
            for ta, tb in zip(pdf["text_a"], pdf["text_b"]):
                if tb != seen:
                    seen, last = tb, full(tb)
                one = full(ta)
                met = len(one & last)
                keep.append(100 * met >= percent * (len(one) + len(last) - met))
            yield pdf.loc[keep, ["a", "b"]]

    return both.mapInPandas(check, "a long, b long")


def peeled(members: DataFrame) -> DataFrame:
    """(node, key, comp) with how to pair a bucket's rows across its components without pairing any component with itself.

    place: the component's number in its bucket, the largest first. peels: so many of the first hold more than half of the pairs of
    what is left when they are reached; each is met with all after it, at the level of its place, and only the
    rest with itself, at level ``peels``. As each such component has over half of the rows left, a row stands at few levels.
    """
    parts = members.groupBy("key", "comp").agg(F.count("*").cast("double").alias("n")).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("n", "comp"))).alias("parts"))
    start = F.struct(F.lit(0.0).alias("rows"), F.lit(0.0).alias("same"), F.lit(0).cast("long").alias("peels"))

    def larger(acc, x):
        rows, same = acc["rows"] + x["n"], acc["same"] + x["n"] * x["n"]
        return F.struct(rows.alias("rows"), same.alias("same"), F.when(
            (rows >= LARGE) & (2 * same > rows * rows), acc["peels"] + 1).otherwise(0).alias("peels"))

    places = (parts.withColumn("all", F.aggregate("parts", start, larger))
              .select("key", F.col("all.peels").alias("peels"), (F.col("all.rows") >= LARGE).alias("large"),
                      F.posexplode(F.reverse(F.col("parts.comp"))).alias("place", "comp")))
    return members.join(places.withColumn("place", F.col("place").cast("long")), ["key", "comp"])


def with_sketches(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The rows of ``peeled`` with the sizes, signatures and parity bits of their nodes, and a size class in large buckets."""
    # Sizes in ratio 0.8 or more differ by one class at most (a class spans a factor just above 1/0.8).
    step = float(np.log(100 / percent) * 1.01)
    bits = [F.col("parity")[k].alias(f"p{k}") for k in range(PARITY // 64)]
    return members.join(classes.select("node", "n", "s0", "s1", "s2", "s3", *bits), "node").withColumn(
        "class", F.when(F.col("large"), F.floor(F.log("n") / F.lit(step))).otherwise(0).cast("long"))


def halves(side: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join on a_key = b_key, a_level = b_level, a_class = b_class in which all components of a bucket meet."""
    # Columns that can't be null keep the join's code below the 8,000 bytes up to which the JVM compiles it.
    whole = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in side.columns if c not in ("large", "comp")]
    rows = side.select("large", *whole)
    sent = [c for c in rows.columns if c not in ("large", "peels")]
    a = rows.withColumn("level", F.least("place", "peels"))
    levels = F.when(F.col("place") >= F.col("peels"), F.expr("sequence(0, peels)")).when(
        F.col("place") > 0, F.expr("sequence(0, place - 1)"))
    b = rows.withColumn("level", F.explode(levels)).withColumn(
        "class", F.explode(F.expr("if(large, sequence(class - 1, class + 1), array(class))")))
    return tuple(x.select(*[F.col(c).alias(to + c) for c in [*sent, "level"]]) for x, to in ((a, "a_"), (b, "b_")))


def pairs_across(side: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one bucket, in two components, that may reach ``percent``."""
    a, b = halves(side)
    met = a.join(b, (F.col("a_key") == F.col("b_key")) & (F.col("a_level") == F.col("b_level")) & (F.col("a_class") == F.col("b_class"))
                 & (F.col("a_place") < F.col("b_place")) & fits("a_", "b_", percent) & ~surely_apart("a_", "b_", percent))
    return met.select(F.greatest("a_node", "b_node").alias("a"), F.least("a_node", "b_node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, hot_partners: int = HOT_PARTNERS) -> DataFrame:
    """doc_id, row_hash, n_shingles, component_id, kept of every row."""
    sk = save(sketches(docs, size))
    rep = F.min(F.struct("doc_id", "row_hash"))
    classes = save(sk.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "f1", "f2").agg(
        rep.alias("rep"), *[F.first(f"s{k}").alias(f"s{k}") for k in range(4)], F.first("bands").alias("bands"),
        F.first("parity").alias("parity"))
        .select(F.col("rep.doc_id").alias("node"), F.col("rep.row_hash").alias("rep_hash"), "n", "f1", "f2",
                "s0", "s1", "s2", "s3", "bands", "parity"))
    sig = classes.select("node", "n", "s0", "s1", "s2", "s3")

    buckets = classes.select("node", F.explode("bands").alias("key"))
    hubs = (buckets.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("c")).where("c > 1")
            .select("key", "hub"))
    members = save(buckets.join(hubs, "key"))  # only buckets with several classes
    stars = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    stars = (stars.join(sig.select(*[F.col(c).alias("a_" + c) for c in sig.columns]), F.col("a") == F.col("a_node"))
             .join(sig.select(*[F.col(c).alias("b_" + c) for c in sig.columns]), F.col("b") == F.col("b_node")))
    first = save(stars.where(fits("a_", "b_", percent)).select("a", "b"))
    comp = components(confirm(first, classes, docs, size, percent))

    stars_of = members

    def open_members(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(node, key, comp), and (key, partners) of the buckets with several components."""
        rows = rows.select("node", "key").join(comp, "node", "left").select("node", "key", F.coalesce("component", "node").alias("comp"))
        sizes = rows.groupBy("key", "comp").agg(F.count("*").cast("double").alias("n")).groupBy("key").agg(
            F.count("*").alias("comps"), F.sum("n").alias("c"), F.sum(F.col("n") * F.col("n")).alias("q"))
        return rows, sizes.where("comps > 1").select("key", ((F.col("c") * F.col("c") - F.col("q")) / F.col("c")).alias("partners"))

    members, open_keys = open_members(members)
    open_keys = save(open_keys)
    hot = F.col("partners") > hot_partners
    members = save(members.join(open_keys, "key").select("node", "key", "comp", "partners"))
    if open_keys.where(hot).count():
        deep = save(deep_buckets(members.where(hot).select("node").distinct(), classes, docs, size))
        narrow, narrow_keys = open_members(deep)
        members = members.where(~hot).drop("partners").unionByName(narrow.join(narrow_keys, "key", "leftsemi"))
    else:
        members = members.drop("partners")
    side = save(with_sketches(peeled(members), classes, percent))
    rest = save(pairs_across(side, percent))
    more = confirm(rest, classes, docs, size, percent)
    of = lambda x: comp.select(F.col("node").alias(x), F.col("component").alias("c" + x))
    more = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    outer = components(more).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    discard(stars_of, first, side, rest)

    ends = classes.select("node", "n", "f1", "f2").join(comp, "node", "left").withColumn(
        "component", F.coalesce("component", "node")).join(outer, "component", "left").select(
        "n", "f1", "f2", F.coalesce("whole", "component").alias("end"))
    out = sk.select("doc_id", "row_hash", "n", "f1", "f2").join(ends, ["n", "f1", "f2"], "left")
    end = F.when(F.col("doc_id").isNotNull(), F.coalesce("end", "doc_id"))
    return out.select("doc_id", "row_hash", F.col("n").alias("n_shingles"), end.alias("component_id"),
                      F.coalesce(F.col("doc_id") == end, F.lit(True)).alias("kept"))


def op1_bbit_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), size=2).drop("row_hash")


def dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles), with its own columns."""
    found = save(near_duplicates(docs))
    gone = found.where(~F.col("kept")).select("doc_id", "row_hash", F.lit(True).alias("_llm_gone")).distinct()
    out = decide(docs, gone, ["_llm_gone"]).where(F.col("_llm_gone").isNull()).drop("_llm_gone")
    again = found.where("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if again.isEmpty():
        return out
    # Rows that repeat a doc_id: the one with the least hash stays (empty texts link with nothing).
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    alone = F.col("doc_id").isNull() | (F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")) == 0)
    ranked = out.withColumn("_llm_alone", alone).withColumn("_llm_rank", F.row_number().over(
        Window.partitionBy("doc_id").orderBy("_llm_alone", F.xxhash64(text))))
    return ranked.where("_llm_alone OR _llm_rank = 1").drop("_llm_alone", "_llm_rank")


_W = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_W} AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM d),
classes AS (SELECT min(doc_id) AS node, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets)
            WHERE len(s) > 0 GROUP BY s),
x AS (SELECT node, n, unnest(s) AS t FROM classes),
df AS (SELECT t, count(*) AS c FROM x GROUP BY t),
pre AS (SELECT node, n, t FROM (SELECT node, n, x.t, row_number() OVER (PARTITION BY node ORDER BY c, x.t) AS k
                                FROM x JOIN df ON df.t = x.t) WHERE k <= n - ceil(0.8 * n) + 1),
cand AS (SELECT DISTINCT a.node AS a, b.node AS b, a.n AS an, b.n AS bn FROM pre a JOIN pre b
         ON a.t = b.t AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
links AS (SELECT a, b FROM (SELECT cand.*, len(list_intersect(p.s, q.s)) AS i FROM cand
          JOIN classes p ON p.node = a JOIN classes q ON q.node = b)
          WHERE 100 * i >= 80 * (an + bn - i)),
e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, other) AS (SELECT a, b FROM e UNION SELECT reach.node, e.b FROM reach JOIN e ON reach.other = e.a),
comp AS (SELECT node, least(node, min(other)) AS c FROM reach GROUP BY node)
SELECT sets.doc_id, len(sets.s)::BIGINT AS n_shingles,
       coalesce(comp.c, classes.node, sets.doc_id) AS component_id,
       sets.doc_id = coalesce(comp.c, classes.node, sets.doc_id) AS kept
FROM sets LEFT JOIN classes ON len(sets.s) > 0 AND classes.s = list_sort(sets.s) LEFT JOIN comp ON comp.node = classes.node
"""
