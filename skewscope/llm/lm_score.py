"""Cross-entropy difference of matched target and background bigram models.

Both models share one vocabulary (all words of all documents, known by a 64-bit hash), the same order and smoothing;
they differ only in what they count: the background all documents, the target those labelled good
(quality 1, not toxic). A document's score is the mean over its words
of target loss minus background loss (nats): the lower, the more it reads like the target.

P(w | v) = M * c(v, w) / c(v) + (1 - M) * (c(w) + A) / (N + A * V), or the second term alone (without 1 - M) where c(v) is 0. All pairs
are counted, c(v) being their sum, so each row of either model sums to 1 over the vocabulary. A document starts after a boundary word.

Nothing is collected, broadcast or left out, at any size:

1. Documents are packed into batches of about ``BATCH_WORDS`` coded words, written once.
2. A batch sends its distinct words and pairs with their counts, summed up in the batch, to ranges of the hash: one row per batch and range,
   the sorted keys as differences, so a key costs some 6 bytes and a count less than one.
3. A range adds up what its batches sent and answers each with the sums of its keys, in the batch's own order and without the keys.
4. A batch puts its answers together and scores its documents.

The number of ranges grows with the batches (``BATCHES_PER_RANGE``), so what a task holds does not. A frequent word or pair is one key of
each batch.

Defined results: null, empty and blank texts have no words and zeros; without good documents the target is uniform over
the vocabulary; repeated rows get equal scores (and count twice in the models); a doc_id with several labels is good if
any is; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.llm.common import read, save, whole_text

MIX, ADD = 0.7, 0.5
BROADCAST_ROWS = 1_000_000
BATCH_WORDS = 1_000_000
#: A batch has about as many distinct pairs as half its words, and a range as many keys as so many batches send in all.
BATCHES_PER_RANGE = 2
WORD, PAIR = 0, 1  # kinds of counted keys
COUNTS = {WORD: 4, PAIR: 2}  # n and good; for words also both as first of a pair
_BATCH = "batch long, doc_ids binary, absent binary, good binary, row_hashes binary, sizes binary, codes binary, ids binary"
_SENT = "kind int, span long, batch long, keys binary, counts binary, size long"
_ANSWER = "kind int, span long, batch long, counts binary, size long, n_distinct long, n_all double, n_good double"
_SCORES = "doc_id long, row_hash long, n_words long, ce_target double, ce_background double, score double"


def words(text: str) -> list[str]:
    return text.lower().split()


def _flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    good = (labels.where("doc_id IS NOT NULL AND quality = 1 AND coalesce(toxic, 0) = 0")
            .select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("good", F.lit(True)))
    good = F.broadcast(good) if good.count() <= BROADCAST_ROWS else good
    return whole_text(docs).join(good, "doc_id", "left").withColumn("good", F.coalesce("good", F.lit(False)))


def _packed(x: np.ndarray) -> bytes:
    """Numbers, byte by byte of their places, compressed: equal high bytes cost next to nothing."""
    return zlib.compress(np.ascontiguousarray(x.reshape(-1).view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 1)


def _unpacked(raw: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def _coded(each: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words by text, all words' places in the third, and the distinct words' hashes (the first is the boundary)."""
    sizes = np.array([len(x) for x in each], np.int64)
    code, distinct = pd.factorize(np.array([w for x in each for w in x], object))
    ids = pd.util.hash_array(np.asarray(distinct, object), categorize=False) if len(distinct) else np.zeros(0, np.uint64)
    return sizes, code.astype(np.int64) + 1, np.concatenate([np.zeros(1, np.uint64), ids])


def batches(flagged: DataFrame, batch_words: int) -> DataFrame:
    """Saved: whole documents as coded words, some ``batch_words`` words to a row (or one longer document)."""
    def row(batch: int, held: list) -> pd.DataFrame:
        sizes, code, ids = _coded([w for *_, w in held])
        flags = lambda k: np.array([h[k] for h in held], np.bool_).tobytes()
        return pd.DataFrame({
            "batch": [batch], "doc_ids": [np.array([h[0] or 0 for h in held], np.int64).tobytes()],
            "absent": [np.array([h[0] is None for h in held], np.bool_).tobytes()], "good": [flags(2)],
            "row_hashes": [np.array([h[1] for h in held], np.int64).tobytes()],
            "sizes": [sizes.tobytes()], "codes": [_packed(code.astype(np.uint32))], "ids": [ids.tobytes()]})

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch, held, n = TaskContext.get().partitionId() << 32, [], 0
        for pdf in parts:
            for d, h, g, t in zip(pdf["doc_id"].astype("Int64"), pdf["row_hash"], pdf["good"], pdf["text"]):
                held.append((None if d is pd.NA else int(d), h, g, words(t)))
                n += len(held[-1][-1]) + 1
                if n >= batch_words:
                    yield row(batch, held)
                    batch, held, n = batch + 1, [], 0
        if held:
            yield row(batch, held)

    return save(flagged.select("doc_id", "row_hash", "good", "text").mapInPandas(pack, _BATCH))


def _opened(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """sizes, code, ids and, by word, whether its document is good."""
    sizes = np.frombuffer(row.sizes, np.int64)
    return (sizes, _unpacked(row.codes, np.uint32).astype(np.int64), np.frombuffer(row.ids, np.uint64),
            np.repeat(np.frombuffer(row.good, np.bool_), sizes))


def _before(sizes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The word before each word; 0, the boundary, at the start of a document."""
    before = np.concatenate([code[:1], code[:-1]])
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    return before


def _distinct_pairs(sizes: np.ndarray, code: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the distinct pairs, each word's place among them and how often each occurs."""
    local, place, n = np.unique(_before(sizes, code) * len(ids) + code, return_inverse=True, return_counts=True)
    x = ids[local // len(ids)] * np.uint64(0x9E3779B97F4A7C15) + ids[local % len(ids)]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31)), place, n


def _spans(keys: np.ndarray, spans: int) -> np.ndarray:
    """The range of each key, rising with it."""
    return ((keys >> np.uint64(32)) * np.uint64(spans) >> np.uint64(32)).astype(np.int64)


def _sent(table: DataFrame, spans: dict[int, int]) -> DataFrame:
    """What each batch sends: per kind and range its keys in rising order and their counts."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for row in pdf.itertuples():
                sizes, code, ids, good = _opened(row)
                before = _before(sizes, code)
                total = lambda x, w=None: np.bincount(x, w, len(ids)).astype(np.int64)
                pairs, place, n = _distinct_pairs(sizes, code, ids)
                both = {WORD: (ids, [total(code), total(code, good), total(before), total(before, good)]),
                        PAIR: (pairs, [n, np.bincount(place, good, len(pairs)).astype(np.int64)])}
                out = []
                for kind, (keys, counts) in both.items():
                    order = np.argsort(keys, kind="stable")
                    keys = keys[order]
                    at = np.searchsorted(_spans(keys, spans[kind]), np.arange(spans[kind] + 1))
                    for span, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                        if a < b:
                            some = keys[a:b]
                            some = np.concatenate([some[:1], some[1:] - some[:-1]])
                            out.append((kind, span, row.batch, _packed(some), _packed(np.concatenate([c[order[a:b]] for c in counts])), b - a))
                yield pd.DataFrame(out, columns=["kind", "span", "batch", "keys", "counts", "size"])

    return table.select("batch", "good", "sizes", "codes", "ids").mapInPandas(run, _SENT)


def _answered(group: pd.DataFrame) -> pd.DataFrame:
    """The sums over all batches of one range, for each batch in the order of its keys."""
    kind = int(group["kind"].iloc[0])
    sizes = group["size"].to_numpy()
    keys = np.concatenate([np.cumsum(_unpacked(k, np.uint64), dtype=np.uint64) for k in group["keys"]])
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    first = np.flatnonzero(new)
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    sent = [_unpacked(c, np.int64).reshape(COUNTS[kind], -1) for c in group["counts"]]
    sums = [np.add.reduceat(np.concatenate([s[k] for s in sent])[order], first) for k in range(COUNTS[kind])]
    ends = np.cumsum(sizes)
    out = [_packed(np.concatenate([s[which[e - n:e]] for s in sums])) for e, n in zip(ends.tolist(), sizes.tolist())]
    words_, once = kind == WORD, np.arange(len(group)) == 0  # the range's own sums stand in its first row
    own = lambda x: np.where(once & words_, x, 0)
    return pd.DataFrame({"kind": kind, "span": group["span"], "batch": group["batch"], "counts": out, "size": sizes,
                         "n_distinct": own(int((sums[0] > 0).sum())), "n_all": own(float(sums[0].sum())), "n_good": own(float(sums[1].sum()))})


def _loss(seen, context, single, mix=MIX):
    """Negative log probability; ``seen`` is the pair's count, ``context`` that of its first word."""
    with np.errstate(divide="ignore", invalid="ignore"):
        share = np.where(context > 0, seen / np.maximum(context, 1), 0.0)
    part = np.where(context > 0, mix, 0.0)
    return -np.log(part * share + (1 - part) * single)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, batch_words: int = BATCH_WORDS,
                             batches_per_range: int = BATCHES_PER_RANGE) -> DataFrame:
    """doc_id, row_hash, n_words, ce_target, ce_background and score of every row."""
    table = batches(_flagged(docs, labels), batch_words)
    n = table.count()
    # Words are far fewer than pairs, so they need fewer ranges.
    spans = {PAIR: max(1, -(-n // batches_per_range)), WORD: max(1, -(-n // (8 * batches_per_range)))}
    answers = save(_sent(table, spans).groupBy("kind", "span").applyInPandas(_answered, _ANSWER))
    row = answers.agg(F.sum("n_all"), F.sum("n_good"), F.sum("n_distinct")).first()
    n_all, n_good, size = (float(x or 0) for x in row)

    def scored(batch: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = next(batch.itertuples())
        sizes, code, ids, _ = _opened(row)
        pairs, place, _ = _distinct_pairs(sizes, code, ids)
        counts = {}
        for kind, keys in ((WORD, ids), (PAIR, pairs)):
            mine = found[found["kind"] == kind].sort_values("span")
            got = [_unpacked(c, np.int64).reshape(COUNTS[kind], -1) for c in mine["counts"]]
            out = np.zeros((COUNTS[kind], len(keys)))
            out[:, np.argsort(keys, kind="stable")] = np.concatenate(got, 1) if got else 0
            counts[kind] = out
        before, doc = _before(sizes, code), np.repeat(np.arange(len(sizes)), sizes)
        counted = np.maximum(sizes, 1)
        single, first = counts[WORD][:2], counts[WORD][2:]
        background, target = (
            np.bincount(doc, _loss(pair[place], context[before], ((own + ADD) / (total + ADD * size or 1))[code]), len(sizes))
            for pair, context, own, total in zip(counts[PAIR], first, single, (n_all, n_good)))
        doc_id = pd.Series(np.frombuffer(row.doc_ids, np.int64)).astype("Int64").mask(np.frombuffer(row.absent, np.bool_))
        return pd.DataFrame({
            "doc_id": doc_id, "row_hash": np.frombuffer(row.row_hashes, np.int64), "n_words": sizes, "ce_target": target / counted,
            "ce_background": background / counted, "score": (target - background) / counted})

    return table.groupBy("batch").cogroup(answers.select("batch", "kind", "span", "counts").groupBy("batch")).applyInPandas(scored, _SCORES)


def op3_cross_entropy(spark, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("row_hash")
