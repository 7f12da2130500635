"""Near-duplicate vectors by cross-polytope hashing, every candidate pair verified.

1. Rows of one label with equal components form a class, so copies are one vector from here on.
2. A vector is padded to D = 2^m components and turned ``K`` times by three fast Hadamard transforms with random signs;
   each turn's hash is the signed axis nearest to the result, K of them make a bucket of one table. ``K`` is the least with
   (2D)^K >= the classes of the largest label, so a bucket of unlike vectors stays small at every size.
3. Multiprobe: in each table a vector stands in its own bucket and in the ``PROBES`` buckets that the next best axis of
   one turn gives. Two vectors meet where the own bucket of one is among those of the other. The number of tables is set so that a pair
   just at the similarity meets nowhere with a chance of at most ``MISS`` (chance per table from seeded random pairs).
4. Only buckets in which classes can meet get vectors. A bucket of more than ``BLOCK`` classes is cut into blocks and every pair
   of blocks is a group of its own, so no task holds a bucket. Cosines are taken in double precision for all that meet in a group.
5. A pair may meet in several buckets; it counts in the least of them only, which both vectors' own buckets tell. So no
   pair is ever a row: a task returns, per class, how many vectors it found, and for the components a spanning forest.

Links are exact (none below the similarity); at the similarity itself 1 in 1/``MISS`` may be missed, above it fewer.

Defined results: a null label, a null or empty vector, one of zeros only and one with a null or non-finite component link with
nothing and stay; vectors of different lengths never link; every row is one vector, so rows that repeat a vec_id link like others,
exact copies included; a null vec_id is never a component's name unless nothing else is there; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.llm.common import discard, read, save
from skewscope.llm.components import components

SIMILARITY = 0.98
PROBES = 2
MISS = 1e-3
BLOCK = 512
#: Rows that a task verifies at a time.
CHUNK = 4096
_SEED = 20_011
_NONE = np.iinfo(np.int64).max
#: Random signs and table counts by their parameters; every process fills its own.
_DRAWN: dict[tuple, object] = {}


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, scaled to keep lengths; the row length is a power of two."""
    n, width, half = len(x), x.shape[1], 1
    while half < width:
        pair = x.reshape(n, -1, 2, half)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(n, width)
        half *= 2
    return x / math.sqrt(width)


def _signs(width: int, table: int, turn: int) -> np.ndarray:
    if (width, table, turn) not in _DRAWN:
        rng = np.random.default_rng([_SEED, width, table, turn])
        _DRAWN[width, table, turn] = rng.choice([-1.0, 1.0], size=(3, width))
    return _DRAWN[width, table, turn]


def _mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bucket_keys(x: np.ndarray, turns: int, table: int, salt: np.ndarray) -> np.ndarray:
    """Keys of one table, a row each: the own bucket first, then those of the probes. ``x`` holds unit vectors of 2^m components."""
    n, width = x.shape
    best, extra = [], []
    for turn in range(turns):
        y = x
        for sign in _signs(width, table, turn):
            y = hadamard(y * sign)
        both = np.concatenate([y, -y], 1)
        top = np.argpartition(-both, 1, axis=1)[:, :3] if both.shape[1] <= 3 else np.argpartition(-both, (0, 1, 2), axis=1)[:, :3]
        value = np.take_along_axis(both, top, 1)
        best.append(top[:, 0])
        for k in (1, 2):
            extra.append((value[:, 0] - value[:, k], turn, top[:, k]))
    code = np.stack(best, 1).astype(np.int64)
    scale = (2 * width) ** np.arange(turns, dtype=np.uint64)
    own = (code.astype(np.uint64) * scale).sum(1, dtype=np.uint64)
    keys = [own]
    order = np.argsort(np.stack([e[0] for e in extra], 1), axis=1, kind="stable")[:, :PROBES]
    turn_of = np.array([e[1] for e in extra])
    axis_of = np.stack([e[2] for e in extra], 1)
    row = np.arange(n)
    for p in range(order.shape[1]):
        t = turn_of[order[:, p]]
        new = axis_of[row, order[:, p]].astype(np.uint64)
        keys.append(own + (new - code[row, t].astype(np.uint64)) * scale[t])
    named = _mix(salt, table)
    return np.stack([_mix(named, k) for k in keys], 1).view(np.int64)


def family(width: int, classes: int, similarity: float) -> tuple[int, int]:
    """Turns per table and tables for vectors of ``width`` = 2^m components, ``classes`` of them in the largest label."""
    name = (width, classes, similarity, "family")
    if name not in _DRAWN:
        _DRAWN[name] = _family(width, classes, similarity)
    return _DRAWN[name]


def _family(width: int, classes: int, similarity: float) -> tuple[int, int]:
    turns = max(1, math.ceil(math.log(max(2, classes)) / math.log(2 * width) - 1e-9))
    rng = np.random.default_rng([_SEED, width, turns])
    u, w = rng.normal(size=(2, 2000, width))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w -= (w * u).sum(1, keepdims=True) * u
    v = similarity * u + math.sqrt(max(0.0, 1 - similarity ** 2)) * w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-300)
    salt = np.zeros(len(u), np.uint64)
    met = []
    for table in range(4):
        a, b = (bucket_keys(x, turns, table, salt) for x in (u, v))
        met.append(((a[:, :1] == b).any(1) | (b[:, :1] == a).any(1)).mean())
    chance = min(max(float(np.mean(met)) - 0.01, 0.005), 0.995)
    return turns, max(1, math.ceil(math.log(MISS) / math.log(1 - chance)))


def _unit(flat: np.ndarray, length: int) -> np.ndarray:
    """Rows of ``length`` components as unit vectors, padded to 2^m >= 2 of them."""
    x = flat.reshape(-1, length)
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    width = max(2, 1 << (length - 1).bit_length())
    return np.pad(x, ((0, 0), (0, width - length)))


def _all_keys(x: np.ndarray, salt: np.ndarray, classes: int, similarity: float) -> np.ndarray:
    """Rows x tables x (own bucket, probes)."""
    turns, tables = family(x.shape[1], classes, similarity)
    return np.stack([bucket_keys(x, turns, t, salt) for t in range(tables)], 1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the rows of each vector length and their unit vectors; needs columns ``v`` and ``label``."""
    v = batch.column(batch.schema.get_field_index("v"))
    sizes = np.diff(v.offsets.to_numpy())
    flat = v.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for length in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == length)
        take = (ends[at] - length)[:, None] + np.arange(length)
        yield at, _unit(flat[take], length)


def _salt(batch: pa.RecordBatch, at: np.ndarray) -> np.ndarray:
    label = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)[at]
    length = np.diff(batch.column(batch.schema.get_field_index("v")).offsets.to_numpy())[at]
    return _mix(label.astype(np.int64).view(np.uint64), length)


def vector_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with the key of their class (null: links with nothing), and saved: one row per class."""
    v = F.col("embedding").cast("array<double>")
    sound = F.col("label").isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    key = F.md5(F.concat_ws(",", F.col("label").cast("string"), F.transform(v, lambda x: (x + 0.0).cast("string"))).cast("binary"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"),
                          F.when(F.coalesce(sound, F.lit(False)), key).alias("key"))
    classes = rows.where("key is not null").groupBy("key").agg(
        F.coalesce(F.min("vec_id"), F.lit(_NONE)).alias("rep"), F.count("*").alias("size"), F.first("label").alias("label"),
        F.first("v").alias("v"))
    return rows.select("vec_id", "key"), save(classes)


def _places(classes: DataFrame, n: int, similarity: float) -> DataFrame:
    """bucket, id (a hash of the class key), own: every bucket that a class stands in."""
    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids = batch.column(0).to_numpy()
            for at, x in _by_length(batch):
                keys = _all_keys(x, _salt(batch, at), n, similarity)
                own = np.zeros(keys.shape, bool)
                own[:, :, 0] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(ids[at], keys[0].size)), pa.array(own.ravel())],
                    ["bucket", "id", "own"])

    return classes.select(F.xxhash64("key").alias("id"), "label", "v").mapInArrow(place, "bucket long, id long, own boolean")


def _met(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least bucket in which vectors with keys ``x`` and ``y`` (pairs x tables x places) meet."""
    def one(p, q):
        return np.where((p[:, :, :1] == q).any(2), p[:, :, 0], _NONE).min(1)

    return np.minimum(one(x, y), one(y, x))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least vertex that each of n vertices reaches by the edges."""
    least = np.arange(n)
    while True:
        now = least.copy()
        np.minimum.at(now, a, least[b])
        np.minimum.at(now, b, least[a])
        now = now[now]
        if (now == least).all():
            return least
        least = now


def _verify(batch: pa.Table, n: int, similarity: float) -> pa.RecordBatch:
    """Whole groups in; per class the vectors linked here, and a spanning forest of the links."""
    batch = batch.combine_chunks().to_batches()[0]
    col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
    code, names = pd.factorize(col["key"].to_numpy(zero_copy_only=False))
    bucket, lo, hi, block, size = (col[c].to_numpy() for c in ("bucket", "lo", "hi", "block", "size"))
    own = col["own"].to_numpy(zero_copy_only=False)
    count = np.zeros(len(names), np.int64)
    from_, to = [], []
    new = np.ones(len(code), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    group = np.cumsum(new) - 1
    sizes = np.bincount(group)

    def accept(a: np.ndarray, b: np.ndarray, keys: np.ndarray) -> None:
        for c in range(0, len(a), 50_000):  # pairs at a time
            p, q = a[c:c + 50_000], b[c:c + 50_000]
            here = _met(keys[p], keys[q]) == bucket[at[p]]
            p, q = code[at[p[here]]], code[at[q[here]]]
            np.add.at(count, p, size_of[q])
            np.add.at(count, q, size_of[p])
            from_.append(p)
            to.append(q)

    size_of = np.zeros(len(names), np.int64)
    size_of[code] = size
    label = col["label"].to_numpy()
    for at, x in _by_length(batch):
        few = sizes[group[at]] <= 48
        linked: list[tuple[np.ndarray, np.ndarray]] = []
        i = np.flatnonzero(few)
        step = 1
        while len(i):  # small groups: rows so many places apart, all groups at a time
            i = i[i + step < len(at)]
            i = i[group[at[i + step]] == group[at[i]]]
            j = i + step
            near = np.einsum("ij,ij->i", x[i], x[j]) >= similarity
            linked.append((i[near], j[near]))
            step += 1
        for g in np.unique(group[at[~few]]).tolist():
            i = np.flatnonzero(group[at] == g)
            a, b = np.nonzero(np.triu(x[i] @ x[i].T >= similarity, 1))
            linked.append((i[a], i[b]))
        a, b = (np.concatenate([x[k] for x in linked]) if linked else np.empty(0, np.int64) for k in (0, 1))
        p, q = at[a], at[b]
        fit = (own[p] | own[q]) & (label[p] == label[q]) & (code[p] != code[q]) & ((lo[p] == hi[p]) | (block[p] != block[q]))
        a, b = a[fit], b[fit]
        if len(a):
            used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
            keys = _all_keys(x[used], _salt(batch, at[used]), n, similarity)
            at = at[used]
            accept(place[:len(a)], place[len(a):], keys)
    f, t = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (from_, to))
    least = _forest(f, t, len(names))
    rep = np.zeros(len(names), np.int64)
    rep[code] = col["rep"].to_numpy()
    some, tree = np.flatnonzero(count), np.flatnonzero(least != np.arange(len(names)))
    left, right = np.concatenate([some, tree]), np.concatenate([some, least[tree]])
    linked = np.concatenate([count[some], np.zeros(len(tree), np.int64)])
    return pa.RecordBatch.from_arrays(
        [pa.array(rep[left]), pa.array(names[left], pa.string()), pa.array(rep[right]), pa.array(names[right], pa.string()),
         pa.array(linked)], ["a_rep", "a_key", "b_rep", "b_key", "n"])


def _whole_groups(parts: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.Table]:
    """Tables of about ``chunk`` rows of the sorted stream that end where a group ends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in parts:
        held.append(batch)
        rows += batch.num_rows
        if rows < chunk:
            continue
        table = pa.Table.from_batches(held)
        group = [table.column(c).to_numpy() for c in ("bucket", "lo", "hi")]
        new = np.flatnonzero(np.logical_or.reduce([g[1:] != g[:-1] for g in group])) + 1
        start = 0
        for end in new.tolist():
            if end - start >= chunk or end == new[-1]:
                yield table.slice(start, end - start)
                start = end
        held, rows = table.slice(start).to_batches(), table.num_rows - start
    if rows:
        yield pa.Table.from_batches(held)


def near_vectors(vectors: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows, classes = vector_classes(vectors)
    n = classes.groupBy("label", F.size("v").alias("d")).count().agg(F.max("count")).first()[0] or 0
    places = save(_places(classes, n, similarity))
    buckets = places.groupBy("bucket").agg(F.count("*").alias("n"), F.max("own").alias("any")).where("n > 1 and any")
    parts = F.ceil(F.col("n") / block).cast("long")
    own_block = F.pmod(F.col("id"), F.col("parts"))
    members = (places.join(buckets.select("bucket", parts.alias("parts")), "bucket")
               .withColumn("block", own_block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .select("bucket", "id", "own", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    full = members.join(classes.withColumn("id", F.xxhash64("key")), "id").select(
        "bucket", "lo", "hi", "block", "own", "key", "rep", "size", "label", "v")

    def verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(parts, CHUNK):
            yield _verify(table, n, similarity)

    found = save(full.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi").mapInArrow(
        verify, "a_rep long, a_key string, b_rep long, b_key string, n long"))
    discard(places)
    counts = found.where("n > 0").groupBy(F.col("a_key").alias("key")).agg(F.sum("n").alias("links"))
    node = lambda side: F.struct(F.col(f"{side}_rep").alias("rep"), F.col(f"{side}_key").alias("key"))
    parts_of = components(found.where("n = 0").select(node("a").alias("a"), node("b").alias("b")))
    least = parts_of.select(F.col("node.key").alias("key"), F.col("component.rep").alias("least"))
    by_class = (classes.select("key", "rep", "size").join(counts, "key", "left").join(least, "key", "left")
                .select("key", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                        F.coalesce("least", "rep").alias("least")))
    out = rows.join(by_class, "key", "left")
    component = F.coalesce(F.when(F.col("least") != _NONE, F.col("least")), F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))


def op13_cross_polytope(spark, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


#: Brute force over all pairs of one label.
SQL = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE len(a.e) = len(b.e)
        AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= {SIMILARITY}),
r(node, least) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.least FROM r JOIN l ON l.a = r.node),
c AS (SELECT node, min(least) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS k FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.k, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
