"""Secret scans: base patterns, and multipart credentials linked within scopes.

DataFrame functions only. One pass over each text finds the strong (base) spans and the parts
of credentials: access identifiers, secrets and endpoints. Parts are then interval-joined:
a weak secret is reported when an access identifier or endpoint stands within ``scope`` code
points of it, a weak access identifier when a secret does; weak parts alone are not. The join
is a semi join on (row, bin of ``scope`` code points), so no pairs are made, and one bin holds
at most ``scope`` parts, however many a document has.

Added kinds, after the base ones in the order of spans: ``weak_secret``, ``weak_access``.

Defined results: a null text counts as empty and has no spans; repeated rows get equal results;
an empty table gives no rows; a null doc_id is kept and never mixed up with another row of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewscope.llm.common import attach, hits, join_spans, place, read, save, whole_text

SCOPE = 200

#: Fixed patterns of the base kinds, in their order.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"

#: Parts that count only together.
WEAK_ACCESS = (r"""(?i:access[_-]?key[_-]?id|client[_-]?id|account[_-]?id|user[_-]?name)["']?\x20*[:=]\x20*["']?"""
               r"""[A-Za-z0-9@._+-]{3,}+|(?<![A-Z0-9])(?:AKIA|ASIA|AROA)[A-Z0-9]{8,13}+(?![A-Z0-9])""")
WEAK_SECRET = (r"""(?i:pwd|passphrase|auth[_-]?key|private[_-]?key|access[_-]?key)["']?\x20*[:=]\x20*["']?"""
               r"""[A-Za-z0-9+/_.=-]{4,}+|[A-Za-z0-9+/_-]{24,}+""")
#: A long run without a name must mix capitals, small letters and digits.
MIXED = r"[:=]|\A(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"
ENDPOINT = (r"""(?i:https?|postgres(?:ql)?|mysql|mongodb|redis|amqps?|ftp)://[^\s"'<>]{3,}+"""
            r"""|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{3,}+""")

SPAN = "array<struct<kind:string,rank:int,start:int,end:int>>"


def _kind(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"),
                                                 s["start"].alias("start"), s["end"].alias("end")))


def _apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others."""
    return F.filter(spans, lambda s: ~F.exists(
        others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: base spans, and the weak and complementary parts of credentials."""
    out = whole_text(docs)
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("wa", WEAK_ACCESS),
                          ("ws", WEAK_SECRET)):
        out = out.withColumn(f"_h_{name}", hits("text", pattern, "[:=]" if name == "assign" else None))
    none = F.expr("cast(array() as array<string>)")
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1))
    out = out.withColumn("_values", F.when(F.size("_h_assign") > 0, values).otherwise(none))
    out = out.withColumn("_assign", F.arrays_zip(place("text", ASSIGN, F.col("_h_assign")).alias("at"),
                                                 F.col("_values").alias("value")))
    long_value = lambda x: F.length(x["value"]) >= 12
    at = lambda x: x["at"]
    strong = F.transform(F.filter("_assign", long_value), at)
    short = F.transform(F.filter("_assign", lambda x: ~long_value(x) & (F.length(x["value"]) >= 4)), at)
    out = out.withColumn("base", F.concat(
        _kind(strong, "assign", 0), _kind(place("text", ACCESS, F.col("_h_access")), "access", 1),
        _kind(place("text", HEX, F.col("_h_hex")), "hex", 2)))
    weak_secret = F.concat(short, F.filter(place("text", WEAK_SECRET, F.col("_h_ws")),
                                           lambda x: x["hit"].rlike(MIXED)))
    out = out.withColumn("weak", F.concat(
        _kind(_apart(weak_secret, F.col("base")), "weak_secret", 3),
        _kind(_apart(place("text", WEAK_ACCESS, F.col("_h_wa")), F.col("base")), "weak_access", 4)))
    # Endpoints only count beside weak parts.
    out = out.withColumn("_h_ep", F.when(F.size("weak") > 0, hits("text", ENDPOINT)).otherwise(none))
    out = out.withColumn("ends", _kind(place("text", ENDPOINT, F.col("_h_ep")), "endpoint", 5))
    return out.select("doc_id", "row_hash", "base", "weak", "ends")


def link(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, row_hash, linked: the weak spans with a complementary part within ``scope``."""
    row = [F.col("doc_id"), F.col("row_hash")]
    some = scanned.where(F.size("weak") > 0)
    weak = some.select(*row, F.explode("weak").alias("w"))
    needs = F.when(F.col("w.kind") == "weak_secret", "identity").otherwise("secret")
    weak = weak.select(*row, "w", needs.alias("needs"), F.explode(F.expr(
        f"sequence(greatest(0, w.start - {scope}) div {scope}, (w.end + {scope}) div {scope})")).alias("bin"))
    parts = some.select(*row, F.explode(F.concat("base", "weak", "ends")).alias("p"))
    identity = F.col("p.kind").isin("access", "weak_access", "endpoint")
    parts = parts.select(
        F.col("doc_id").alias("p_doc"), F.col("row_hash").alias("p_hash"), "p",
        F.when(identity, "identity").otherwise("secret").alias("role"), F.explode(F.expr(
            f"sequence(cast(p.start div {scope} as bigint), cast(p.end div {scope} as bigint))")).alias("p_bin"))
    near = ((F.col("p.start") <= F.col("w.end") + scope) & (F.col("w.start") <= F.col("p.end") + scope)
            & ((F.col("p.start") != F.col("w.start")) | (F.col("p.end") != F.col("w.end"))))
    met = weak.join(parts, F.col("doc_id").eqNullSafe(F.col("p_doc")) & (F.col("row_hash") == F.col("p_hash"))
                    & (F.col("bin") == F.col("p_bin")) & (F.col("needs") == F.col("role")) & near, "leftsemi")
    return met.groupBy("doc_id", "row_hash").agg(F.collect_set("w").alias("linked"))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, row_hash, base spans and linked weak spans (arrays of kind, rank, start, end)."""
    scanned = save(scan(docs))
    out = attach(scanned.select("doc_id", "row_hash", "base"), link(scanned, scope), ["linked"])
    return out.withColumn("linked", F.coalesce("linked", F.lit(None).cast(SPAN), F.expr(f"cast(array() as {SPAN})")))


def op8_secret_links(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(join_spans(F.col("base")), 256).alias("base_sha256"),
        join_spans(F.concat("base", "linked")).alias("spans"))
