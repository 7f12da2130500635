"""Lexical retrieval packing: token sequences filled with BM25 neighbours.

1. Texts are tokenised (an end id closes each document). Every whole window of ``size`` ids of a document is a
   sequence of its own; the remaining ids, fewer than ``size``, are the document's tail.
2. Document frequencies of all token ids over all whole documents are summed by Spark (one count per
   vocabulary entry, which bounds what reaches the driver).
3. Tails are dealt by a hash of the row into shards of about ``SHARD_DOCS`` documents. A shard keeps an inverted index
   of BM25 weights (corpus-wide idf, term counts of the whole documents). A seed queries it with all its terms; its best unused neighbours fill the
   window in order of score. The one that no longer fits is cut, and its rest seeds the next window.
4. The last window of a shard is cut into sequences of powers of two, so that no sequence needs padding.

Shards hold a bounded number of tails of bounded length whatever the input holds; equal documents spread like others.

Defined results: a null or empty text has the end id only; every row is packed, repeated rows each on their own; an
empty table gives no pieces.

Ids are those of the ``tokenizers`` file; they are computed with the same vocabulary as ranks (``tiktoken``), several
times faster, on a batch's distinct words with the blank before them (no token spans that boundary). The string of
an added token is that token's id, as there.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.llm.common import arrow_bytes, read, save, whole_text

SIZE, END_ID = 2048, 1
SHARD_DOCS = 512
#: Characters that are tokenised at a time.
BATCH_CHARS = 2_000_000
#: Bytes that are hashed at a time; each takes 32 bytes of sums meanwhile.
HASH_BYTES = 1 << 17
#: Bytes of the rows that a task and its worker exchange at a time; both hold them, the worker as texts too.
ARROW_BYTES = 8 << 20
#: First bytes of the white space of UTF-8 beyond ASCII.
_LEADS = np.array([0xC2, 0xE1, 0xE2, 0xE3], np.uint8)
#: Fixed value: the one added token of the vocabulary; its string in a text is one id.
ADDED = {"<|endoftext|>": 50256}
K1, B = 1.2, 0.75
_RNG = np.random.default_rng(1_931)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64)
_POWER = _RNG.integers(0, 1 << 63, 1 << 16, dtype=np.uint64) | np.uint64(1)


def encoder(ranks_path: str | None = None, pattern: str | None = None):
    """A tiktoken encoding of the 50k byte-level vocabulary (kept by tiktoken's own registry in a worker)."""
    import public_tokenizers
    import tiktoken
    from tiktoken import registry

    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in registry.ENCODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        registry.ENCODINGS[path] = tiktoken.Encoding(
            path, pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return registry.ENCODINGS[path]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all elements of stretches, one stretch after the other."""
    after = np.cumsum(sizes)
    return np.repeat(starts - (after - sizes), sizes) + np.arange(int(after[-1]) if len(after) else 0)


def _hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each stretch of ``data``; ``starts`` begins with 0 and leaves no gap."""
    out = np.zeros(len(starts), np.uint64)
    for low in range(0, len(data), HASH_BYTES):
        high = min(low + HASH_BYTES, len(data))
        first, after = int(np.searchsorted(starts, low, "right")) - 1, int(np.searchsorted(starts, high))
        begin = np.maximum(starts[first:after], low) - low
        place = np.arange(low, high) - np.repeat(starts[first:after], np.diff(begin, append=high - low))
        out[first:after] += np.add.reduceat(_BYTE[data[low:high]] * _POWER[place & 0xFFFF], begin)
    return out ^ (sizes.astype(np.uint64) << np.uint64(40))


class Tokens:
    """Ids of whole texts as little-endian unsigned 16-bit bytes (the vocabulary has 50,257 entries).

    No token spans the blank that begins a word, so a batch's distinct words, each with its blank, are encoded once, in
    one call; their lengths in bytes tell which ids are whose.
    """

    def __init__(self, encoding, added: dict[str, int] = ADDED):
        self.encoding, self.added = encoding, added
        self.width = np.array([len(t) for t in encoding.decode_tokens_bytes(list(range(encoding.n_vocab)))])
        self.marker = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u2").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Texts that hold an added token are encoded between and around it."""
        if self.marker is None or not any(m in t for t in texts for m in self.added):
            return self._encode(texts)
        out = []
        for t in texts:
            parts = self.marker.split(t)  # text, marker, text, ..
            ids = self._encode(parts[::2])
            marks = [np.array([self.added[m]], "<u2").tobytes() for m in parts[1::2]]
            out.append(b"".join(x for pair in zip(ids, [*marks, b""]) for x in pair))
        return out

    def distinct(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of ``data`` and how many each has: none where white space or nothing follows the blank."""
        second = np.where(sizes > 1, data[np.minimum(starts + 1, len(data) - 1)], 32)
        fit = (second > 32) & (second != 127)
        for k in np.flatnonzero(fit & np.isin(second, _LEADS)).tolist():
            fit[k] = not bytes(data[starts[k] + 1:starts[k] + 4]).decode("utf-8", "ignore")[:1].isspace()
        n = np.zeros(len(starts), np.int64)
        if not fit.any():
            return np.zeros(0, "<u2"), n
        ids = np.array(self.encoding.encode_ordinary(data[_spread(starts[fit], sizes[fit])].tobytes().decode()), "<u2")
        ends, until = np.cumsum(self.width[ids]), np.cumsum(sizes[fit])
        cut = np.searchsorted(ends, until) + 1
        if cut[-1] != len(ids) or (ends[cut - 1] != until).any():
            raise ValueError("a token spans two words")
        n[fit] = np.diff(cut, prepend=0)
        return ids, n

    def _encode(self, texts: list[str]) -> list[bytes]:
        raw = [t.encode() for t in texts]
        firsts = [r.partition(b" ")[0] for r in raw]
        data = np.frombuffer(b"".join(r[len(f):] for r, f in zip(raw, firsts)), np.uint8)
        starts = np.flatnonzero(data == 32)
        if not len(starts):
            return list(map(self.plain, texts))
        sizes = np.diff(starts, append=len(data))
        code, known = pd.factorize(_hashes(data, starts, sizes))
        at = np.empty(len(known), np.int64)
        at[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        ids, n = self.distinct(data, starts[at], sizes[at])
        flat = ids[_spread((np.cumsum(n) - n)[code], n[code])].tobytes()
        after = np.concatenate(([0], np.cumsum(n[code])))
        odd = np.concatenate(([0], np.cumsum(n[code] == 0)))
        until = np.searchsorted(starts, np.cumsum([len(r) - len(f) for r, f in zip(raw, firsts)]))
        out, begin = [], 0
        for t, first, end in zip(texts, firsts, until.tolist()):
            if odd[end] > odd[begin]:
                out.append(self.plain(t))
            else:
                out.append(self.plain(first.decode()) + flat[2 * int(after[begin]):2 * int(after[end])])
            begin = end
        return out


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


TOKENS = "row long, doc_id long, row_hash long, n long, heads binary, ids binary, bag binary"


def tokenized(docs: DataFrame, size: int = SIZE, all_ids: bool = False, ranks_path: str | None = None) -> DataFrame:
    """Saved: per row its count of ids, checksums of its whole windows, the ids of its tail and, if that is not the whole
    document, the document's bag: its distinct ids and how often each occurs.

    With ``all_ids`` the ids of the whole windows are kept too. Rows with a negative ``row`` hold a task's document
    frequencies (token id, count).
    """
    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        tokens = Tokens(encoder(ranks_path))
        df = np.zeros(1 << 16, np.uint32)
        end = np.array([END_ID], "<u2").tobytes()
        for pdf in parts:
            size_to = pdf["text"].str.len().cumsum().to_numpy()
            cuts = np.searchsorted(size_to, np.arange(BATCH_CHARS, size_to[-1] if len(pdf) else 0, BATCH_CHARS))
            for at, upto in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pdf)]):
                one = pdf.iloc[at:upto]
                out = []
                for raw in tokens.encode(one["text"].tolist()):
                    ids = np.frombuffer(raw + end, "<u2")
                    seen, count = np.unique(ids, return_counts=True)
                    df[seen] += 1
                    whole = len(ids) - len(ids) % size
                    heads = np.array([crc(ids[k:k + size]) for k in range(0, whole, size)], np.uint32)
                    bag = np.stack([seen, count]).astype(np.uint32).tobytes() if whole else b""
                    out.append((number, len(ids), heads.tobytes(), ids[0 if all_ids else whole:].tobytes(), bag))
                    number += 1
                done = pd.DataFrame(out, columns=["row", "n", "heads", "ids", "bag"])
                done["doc_id"] = one["doc_id"].astype("Int64").to_numpy()
                done["row_hash"] = one["row_hash"].to_numpy()
                yield done[["row", "doc_id", "row_hash", "n", "heads", "ids", "bag"]]
        seen = np.flatnonzero(df).astype(np.uint32)
        if len(seen):
            yield pd.DataFrame({"row": [-1], "doc_id": pd.array([None], "Int64"), "row_hash": [0], "n": [0], "heads": [b""],
                                "ids": [np.stack([seen, df[seen]]).tobytes()], "bag": [b""]})

    with arrow_bytes(docs.sparkSession, ARROW_BYTES):
        return save(whole_text(docs).mapInPandas(rows, TOKENS))


def idf(tokens: DataFrame, n_docs: int) -> np.ndarray:
    """BM25 idf by token id, from document frequencies over all documents."""
    def pairs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for raw in pdf["ids"]:
                token, count = np.frombuffer(raw, np.uint32).reshape(2, -1)
                yield pd.DataFrame({"token": token.astype(np.int32), "df": count.astype(np.int64)})

    rows = (tokens.where("row < 0").select("ids").mapInPandas(pairs, "token int, df long")
            .groupBy("token").agg(F.sum("df").alias("df")).collect())  # at most one row per vocabulary entry
    out = np.zeros(1 << 16, np.float32)
    for r in rows:
        out[r["token"]] = np.log1p((n_docs - r["df"] + 0.5) / (r["df"] + 0.5))
    return out


class Index:
    """Inverted index of a shard: BM25 weights by token, from each document's ids in any order, or its bag (ids and counts)."""

    def __init__(self, docs: list[np.ndarray], weights: np.ndarray):
        n = len(docs)
        bags = [k for k, d in enumerate(docs) if d.ndim == 2]
        plain = [k for k, d in enumerate(docs) if d.ndim == 1]
        sizes = np.array([d[1].sum() if d.ndim == 2 else len(d) for d in docs], np.int64)
        keys, counts = [], []
        if plain:
            key = np.concatenate([docs[k] for k in plain]).astype(np.int64) * n + np.repeat(plain, sizes[plain])
            key, tf = np.unique(key, return_counts=True)
            keys.append(key)
            counts.append(tf)
        for k in bags:
            keys.append(docs[k][0].astype(np.int64) * n + k)
            counts.append(docs[k][1].astype(np.int64))
        key, tf = np.concatenate(keys), np.concatenate(counts)
        if bags:
            order = np.argsort(key, kind="stable")
            key, tf = key[order], tf[order]
        token, self.doc = key // n, key % n
        norm = K1 * (1 - B + B * sizes / max(1.0, sizes.mean()))
        self.weight = (weights[token] * tf * (K1 + 1) / (tf + norm[self.doc])).astype(np.float32)
        self.begin = np.searchsorted(token, np.arange((1 << 16) + 1))
        self.n = n

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """BM25 of every document of the shard for the distinct terms of ``ids`` (or of a bag)."""
        terms = np.unique(ids) if ids.ndim == 1 else ids[0]
        begin, count = self.begin[terms], self.begin[terms.astype(np.int64) + 1] - self.begin[terms]
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return np.bincount(self.doc[at], self.weight[at], self.n)


def fill(tails: list[np.ndarray], docs: list[np.ndarray], weights: np.ndarray, size: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (tail, start, length); all but the last window hold exactly ``size`` ids.

    Seeds ask, and are found, by the ids of their whole documents ``docs``; equal scores go by place.
    """
    index = Index(docs, weights)
    unused = np.ones(len(tails), bool)
    windows, seed, begin = [], 0, 0
    unused[0] = False
    while seed is not None:
        window, room = [(seed, begin, len(tails[seed]) - begin)], size - len(tails[seed]) + begin
        near = iter(())
        if room and unused.any():
            score = np.where(unused, index.scores(docs[seed]), -1.0)
            near = iter(np.argsort(-score, kind="stable")[: int(unused.sum())].tolist())
        seed = None
        for other in near:
            part = min(room, len(tails[other]))
            window.append((other, 0, part))
            unused[other] = False
            room -= part
            if part < len(tails[other]):
                seed, begin = other, part
            if not room:
                break
        windows.append(window)
        if seed is None and unused.any():
            seed, begin = int(np.argmax(unused)), 0
            unused[seed] = False
    return windows


def _halves(window: list[tuple[int, int, int]], size: int) -> list[list[tuple[int, int, int]]]:
    """A window cut into sequences whose lengths are powers of two."""
    total, out, pieces = sum(p[2] for p in window), [], list(window)
    while total:
        room = min(size, 1 << (total.bit_length() - 1))
        total, part = total - room, []
        while room:
            tail, start, n = pieces.pop(0)
            take = min(n, room)
            part.append((tail, start, take))
            room -= take
            if take < n:
                pieces.insert(0, (tail, start + take, n - take))
        out.append(part)
    return out


PIECES = ("doc_id long, row_hash long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, ids array<int>")


def pack(docs: DataFrame, size: int = SIZE, shard_docs: int = SHARD_DOCS, with_ids: bool = False,
         ranks_path: str | None = None) -> DataFrame:
    """One row per piece: which ids of which row stand where; ``ids`` too if ``with_ids`` is set."""
    tokens = tokenized(docs, size, with_ids, ranks_path)
    rows = tokens.where("row >= 0")
    n_docs = rows.count()
    weights = idf(tokens, n_docs)
    shards = max(1, n_docs // shard_docs)

    def shard_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        shard, out = int(pdf["shard"].iloc[0]), []
        sequence = shard << 32
        kept = [np.frombuffer(x, "<u2") for x in pdf["ids"]]
        whole = [len(h) // 4 * size for h in pdf["heads"]]
        tails = [k[w:] if with_ids else k for k, w in zip(kept, whole)]
        for k, (heads, n) in enumerate(zip(pdf["heads"], pdf["n"])):
            for j, c in enumerate(np.frombuffer(heads, np.uint32).tolist()):
                ids = kept[k][j * size:(j + 1) * size].astype(np.int32) if with_ids else None
                out.append((k, j * size, size, c, int(n), sequence, 0, ids))
                sequence += 1
        some = [k for k, t in enumerate(tails) if len(t)]
        bags = {k: np.frombuffer(b, np.uint32).reshape(2, -1) for k, b in enumerate(pdf["bag"]) if len(b)}
        own = [bags.get(k, tails[k]) for k in some]
        windows = fill([tails[k] for k in some], own, weights, size) if some else []
        cut = [w for x in windows for w in ([x] if sum(p[2] for p in x) == size else _halves(x, size))]
        for window in cut:
            offset = 0
            for tail, start, length in window:
                k = some[tail]
                ids = tails[k][start:start + length]
                out.append((k, whole[k] + start, length, crc(ids), int(pdf["n"].iloc[k]), sequence, offset,
                            ids.astype(np.int32) if with_ids else None))
                offset += length
            sequence += 1
        done = pd.DataFrame(out, columns=["k", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
        done["doc_id"] = pdf["doc_id"].astype("Int64").to_numpy()[done["k"]]
        done["row_hash"] = pdf["row_hash"].to_numpy()[done["k"]]
        return done.drop(columns="k")

    shard = F.pmod(F.xxhash64("row", "row_hash", "doc_id"), F.lit(shards)).cast("int")
    return rows.withColumn("shard", shard).groupBy("shard").applyInPandas(shard_pieces, PIECES)


def op2_bm25_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents")).drop("row_hash", "ids")


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed documents, with their ids."""
    return pack(docs, with_ids=True).drop("row_hash")
