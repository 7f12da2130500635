"""The whole pipeline against plain Python over every row of the smallest tables."""

import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from skewscope.llm import pii, quality
from tests.conftest import SF001


def _accepted(spark, rows):
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    scores = quality.train(docs, labels).scores(quality.feature_matrix([t for _, t in rows]))
    return [r for r, s in zip(rows, scores) if s >= 0.5]


def _one_of_each_group(rows):
    """The least doc_id of each component of texts whose five-word shingles overlap by 0.8 or more."""
    sets = []
    for _, t in rows:
        w = t.encode().lower().split()
        sets.append(set(zip(*(w[k:] for k in range(min(5, len(w)))))))
    group = list(range(len(rows)))
    for a, s in enumerate(sets):
        for b, t in enumerate(sets[:a]):
            if s and t and 100 * len(s & t) >= 80 * len(s | t) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (d, _), g in zip(rows, group):
        least[g] = min(d, least.get(g, d))
    return [r for r, g in zip(rows, group) if r[0] == least[g]]


def _clean(rows, items):
    def words(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))

    windows = set()
    for t in items:
        w = words(t)
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9)) if w}
    sizes = {len(w) for w in windows}

    def hit(text):
        w = words(text)
        return any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    return [r for r in rows if not hit(r[1])]


def _luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def _personal(text):
    """(start, end, kind) of the base kinds."""
    digits = lambda x: re.sub("[^0-9]", "", x)
    kinds = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda x: True),
             ("ip", r"[0-9]+(?:\.[0-9]+){3}", lambda x: all(int(p) <= 255 for p in x.split("."))),
             ("card", r"[0-9](?:[ -]?[0-9])+", lambda x: 14 <= len(digits(x)) <= 19 and _luhn(digits(x))),
             ("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda x: 10 <= len(digits(x)) <= 15))
    return {(m.start(), m.end(), kind) for kind, pattern, ok in kinds for m in re.finditer(pattern, text) if ok(m[0])}


def _redacted(text, spans):
    out, at = "", 0
    for a, b, kind in sorted(spans):
        out += text[at:a] + f"[{kind.upper()}]" if a >= at else ""
        at = max(at, b)
    return out + text[at:]


def test_pipeline_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    items = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("text").collect()]
    kept = _clean(_one_of_each_group(_accepted(spark, rows)), items)
    assert 0 < len(kept) < len(rows)

    # The learned spans come from the operator; its base spans are found again here.
    spans = {r.doc_id: r.spans for r in pii.find_personal(
        spark.createDataFrame(kept, "doc_id long, text string")).collect()}
    for d, t in kept:
        assert {(s.start, s.end, s.kind) for s in spans[d] if s["rank"] < pii.N_BASE} == _personal(t)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: tokenizer.encode(_redacted(t, {(s.start, s.end, s.kind) for s in spans[d]}),
                                add_special_tokens=False).ids + [1] for d, t in kept}
    got, sequences = {}, {}
    for r in corpus_pipeline.run(spark, SF001).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert {d: sum((ids for _, ids in sorted(p)), []) for d, p in got.items()} == want
    for own in sequences.values():
        own.sort()
        sizes = [n for _, n in own]
        assert [o for o, _ in own] == np.cumsum([0, *sizes[:-1]]).tolist()
        assert sum(sizes) <= 2048 and sum(sizes) & (sum(sizes) - 1) == 0
