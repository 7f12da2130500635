"""Personal data by weak supervision; DataFrame functions and MLlib only.

1. Candidates: per text the base patterns (email, ip, card, phone) and looser ones (``email_like``,
   ``phone_like``, ``ssn_like``, ``ip6``), each with the votes of four labelers: pattern (its
   own validator), gazetteer (fixed lists of endings, prefixes and ranges), context (words before it) and
   shape (what touches it). A vote is 1, 0 (abstains) or -1.
2. Aggregation: votes are counted per (kind, pattern of votes), a table bounded by the number of
   patterns; expectation-maximisation on these counts estimates a prior per kind and each labeler's reliability.
3. Final span classifier: a logistic regression on span features, trained on all candidates
   weighted by their posteriors (again through counts of equal feature rows).

A base candidate that passes its validator is always reported; one that fails never is (it only teaches
the labelers); a looser candidate is reported where the classifier says 0.5 or more and it overlaps no base span.

Defined results: a null text counts as empty; rows without candidates have no spans; a table without
candidates needs no model; repeated rows get equal results. Base matches are leftmost and non-overlapping
per kind. Patterns are possessive and anchored at starts of runs, so time is linear in the text.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from skewscope.llm.common import decide, hits, join_spans, place, read, save, whole_text

#: Fixed patterns of the base kinds, in their order; ``\G`` lets a match start where the last one ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Looser kinds.
EMAIL_LIKE = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\[at\]|\(at\)|\{at\})\x20?[A-Za-z0-9-]++"
              r"(?:\x20?(?:\.|\[dot\]|\(dot\)|\{dot\})\x20?[A-Za-z0-9-]++)++")
PHONE_LIKE = r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
SSN_LIKE = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IP6 = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
KINDS = (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE), ("email_like", EMAIL_LIKE),
         ("phone_like", PHONE_LIKE), ("ssn_like", SSN_LIKE), ("ip6", IP6))
#: A character that every match of the kind holds.
NEEDS = {"email": "@", "phone": "[+]", "email_like": r"[\[({]", "ip6": ":"}
N_BASE = 4
LABELERS = ("pattern", "gazetteer", "context", "shape")

#: Gazetteer (fixed lists): address endings, issuer prefixes of cards, ranges that are nobody's address.
ENDINGS = r"(?i)\.(com|org|net|edu|gov|info|biz|io|de|fr|es|uk|eu|it|nl|ch|at|us|ca)\z"
ISSUERS = r"\A(4|5[1-5]|2[2-7]|3[4-9]|6)"
NOBODY = r"\A0*(0|10|127|169|192|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
FOR_WORDS = (r"(?i)(e-?mail|mail|contact|reach|phone|tel|call|mobile|fax|card|visa|credit|ssn|social security|"
             r"address|addr|ip|host|from|login|telefon|correo|courriel|kontakt)\W*\z")
AGAINST_WORDS = r"(?i)(version|ver|v|isbn|issn|order|invoice|ref|no|nr|page|figure|fig|section|doi|build)[.:#]?\s*\z"
CONTEXT = 24


def _passes(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(r"\A(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|\z)){4}\z")
    if kind == "card":
        # From the right, every second digit doubled, with the sum of its digits (fixed table).
        values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
            i % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)
        ).otherwise(c.cast("int")))
        total = F.aggregate(values, F.lit(0), lambda a, x: a + x)
        return F.length(digits).between(14, 19) & (total % 10 == 0)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "phone_like":
        return digits.rlike(r"\A[2-9]")
    if kind == "ssn_like":
        return ~hit.rlike(r"\A(000|666|9)|-00-|0000\z")
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _gazetteer(kind: str, hit: Column) -> Column:
    if kind.startswith("email"):
        return _vote(hit.rlike(ENDINGS), F.lit(False))
    if kind == "card":
        return _vote(hit.rlike(ISSUERS), ~hit.rlike(ISSUERS))
    if kind == "ip":
        return _vote(~hit.rlike(NOBODY), hit.rlike(NOBODY))
    if kind.startswith("phone"):
        return _vote(F.lit(False), hit.rlike(r"[^0-9]?000[^0-9]"))
    return F.lit(0)


def _candidates(text: str, kind: str, rank: int, spans: Column) -> Column:
    """Spans with votes and features."""
    def one(s):
        hit = s["hit"]
        before = F.substring(F.col(text), F.greatest(F.lit(1), s["start"] + 1 - CONTEXT),
                             F.least(F.lit(CONTEXT), s["start"]))
        after = F.substring(F.col(text), s["end"] + 1, 1)
        glued = before.rlike(r"[A-Za-z0-9]\z") | after.rlike(r"\A[A-Za-z0-9]")
        passes = _passes(kind, hit)
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
            passes.alias("passes"),
            F.struct(F.when(passes, 1).otherwise(-1).alias("pattern"), _gazetteer(kind, hit).alias("gazetteer"),
                     _vote(before.rlike(FOR_WORDS), before.rlike(AGAINST_WORDS)).alias("context"),
                     F.when(glued, -1).otherwise(1).alias("shape")).alias("votes"),
            F.least(F.lit(9), F.floor(F.length(hit) / 4).cast("int")).alias("size"),
            F.least(F.lit(9), F.floor(F.length(F.regexp_replace(hit, "[^0-9]", "")) / 2).cast("int")).alias("digits"),
            before.rlike(r"\A\z|[\s(]\z").alias("opens"))
    return F.transform(spans, one)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash and all candidates of the text (``found``)."""
    out = whole_text(docs)
    for kind, pattern in KINDS:
        out = out.withColumn(f"_h_{kind}", hits("text", pattern, NEEDS.get(kind, "[0-9]")))
    out = out.withColumns({f"_p_{kind}": place("text", pattern, F.col(f"_h_{kind}")) for kind, pattern in KINDS})
    found = F.concat(*[_candidates("text", kind, k, F.col(f"_p_{kind}")) for k, (kind, _) in enumerate(KINDS)])
    return out.select("doc_id", "row_hash", found.alias("found"))


def vote_counts(scanned: DataFrame) -> DataFrame:
    """Candidates per kind and pattern of votes: at most 8 kinds times 3^4 rows."""
    return (scanned.select(F.explode("found").alias("c")).select("c.kind", "c.votes.*")
            .groupBy("kind", *LABELERS).count())


def reliabilities(counts: list[Row], rounds: int = 30) -> dict[tuple, float]:
    """EM over the counted patterns: posterior of personal data by (kind, votes).

    Each labeler has one distribution over its three votes for either truth, each kind one prior.
    """
    keys = [(r["kind"], tuple(r[x] for x in LABELERS)) for r in counts]
    n = [r["count"] for r in counts]
    post = [(1 + sum(v > 0 for v in votes)) / (2 + sum(v != 0 for v in votes)) for _, votes in keys]
    for _ in range(rounds):
        prior, table = {}, {}
        for (kind, votes), c, p in zip(keys, n, post):
            a = prior.setdefault(kind, [1.0, 1.0])
            a[1] += c * p
            a[0] += c * (1 - p)
            for j, v in enumerate(votes):
                t = table.setdefault((j, v), [1.0, 1.0])
                t[1] += c * p
                t[0] += c * (1 - p)
        sums = [[sum(t[y] for (j, _), t in table.items() if j == k) for y in (0, 1)] for k in range(len(LABELERS))]
        post = []
        for kind, votes in keys:
            log = [math.log(prior[kind][y] / sum(prior[kind])) + sum(
                math.log(table[j, v][y] / sums[j][y]) for j, v in enumerate(votes)) for y in (0, 1)]
            post.append(1 / (1 + math.exp(max(-50.0, min(50.0, log[0] - log[1])))))
    return dict(zip(keys, post))


def _features(row, kinds=tuple(k for k, _ in KINDS)) -> list[float]:
    return [float(row["kind"] == k) for k in kinds] + [float(row[x]) for x in LABELERS] + [
        row["size"] / 10.0, row["digits"] / 10.0, float(row["opens"])]


def span_classifier(scanned: DataFrame) -> tuple[list[float], float] | None:
    """Coefficients and intercept of the final classifier, or None without candidates.

    Trains on the counts of equal feature rows (their number is bounded by the features' ranges).
    """
    posterior = reliabilities(vote_counts(scanned).collect())
    if not posterior:
        return None
    rows = (scanned.select(F.explode("found").alias("c"))
            .select("c.kind", "c.votes.*", "c.size", "c.digits", "c.opens")
            .groupBy("kind", *LABELERS, "size", "digits", "opens").count().collect())
    data = []
    for r in sorted(rows):
        p = posterior[r["kind"], tuple(r[x] for x in LABELERS)]
        x = Vectors.dense(_features(r))
        data += [(x, 1.0, float(r["count"] * p)), (x, 0.0, float(r["count"] * (1 - p)))]
    train = scanned.sparkSession.createDataFrame(data, ["features", "label", "weight"]).coalesce(1)
    model = LogisticRegression(weightCol="weight", regParam=0.01, maxIter=50).fit(train)
    return [float(c) for c in model.coefficients], float(model.intercept)


def _reported(model) -> Column:
    base = F.filter("found", lambda s: (s["rank"] < N_BASE) & s["passes"])
    if model is None:
        return base
    coefficients, intercept = model

    def yes(s):
        x = [(s["kind"] == k).cast("double") for k, _ in KINDS] + [s["votes"][v].cast("double") for v in LABELERS]
        x += [s["size"] / 10.0, s["digits"] / 10.0, s["opens"].cast("double")]
        z = F.lit(intercept)
        for c, f in zip(coefficients, x):
            z = z + F.lit(c) * f
        return (s["rank"] >= N_BASE) & s["passes"] & (z >= 0)

    more = F.filter("found", lambda s: yes(s) & ~F.exists(
        base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.concat(base, more)


def find_personal(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash and the reported ``spans`` (kind, rank, start, end) of every row."""
    scanned = save(scan(docs))
    model = span_classifier(scanned)
    slim = F.transform(_reported(model), lambda s: F.struct(
        s["kind"].alias("kind"), s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end")))
    return scanned.select("doc_id", "row_hash", slim.alias("spans"))


def op4_weak_pii(spark, sf_dir: str) -> DataFrame:
    found = find_personal(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < N_BASE)
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k, _ in KINDS[:N_BASE]],
                        F.sha2(join_spans(base), 256).alias("base_sha256"),
                        join_spans(F.col("spans")).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans merge."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc, s):
        cut = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                       F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), cut.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def pii_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data redacted; texts without any (and null texts) stay as they are."""
    found = find_personal(docs).where(F.size("spans") > 0).dropDuplicates(["doc_id", "row_hash"])
    out = decide(docs, found.withColumnRenamed("spans", "_llm_spans"), ["_llm_spans"])
    hit = F.col("_llm_spans").isNotNull()
    out = out.withColumn("text", F.when(hit, redact(F.col("text"), F.col("_llm_spans"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
