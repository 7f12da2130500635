"""Repeated rows, null keys, empty tables and ties of the span and rule operators."""

from pyspark.sql import functions as F

from skewscope.llm import decontaminate, imatch, pii, secret_links, url_rules

SECRETS = "client_id=abcd host=db.internal pwd: hunter22 token=abcdefghijkl1234"
PERSONAL = "call +44 20 7946 0958 or a@b.com, 10.0.0.1"


def _table(spark, texts):
    rows = [(1, texts[0]), (1, texts[0]), (1, texts[1]), (None, texts[0]), (None, texts[0]), (2, None), (3, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr(
        "*", "1 AS row_hash", "2 AS base", "3 AS linked", "4 AS kind")


def test_repeated_rows_and_null_ids_of_secrets(spark):
    got = secret_links.find_secrets(_table(spark, (SECRETS, "nothing"))).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(["1", "1", "1", "None", "None", "2", "3"])
    spans = {(str(r.doc_id), len(r.base), tuple(sorted(s.kind for s in r.linked))) for r in got}
    assert spans == {("1", 1, ("weak_access", "weak_secret")), ("None", 1, ("weak_access", "weak_secret")),
                     ("1", 0, ()), ("2", 0, ()), ("3", 0, ())}


def test_repeated_rows_and_null_ids_of_personal_data(spark):
    got = pii.find_personal(_table(spark, (PERSONAL, "nothing"))).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(["1", "1", "1", "None", "None", "2", "3"])
    base = {(str(r.doc_id), tuple(sorted((s.kind, s.start) for s in r.spans if s["rank"] < pii.N_BASE))) for r in got}
    found = (("email", 25), ("ip", 34), ("phone", 5))
    assert base == {("1", found), ("None", found), ("1", ()), ("2", ()), ("3", ())}


def test_rules_on_repeated_rows_ties_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None), (2, "http://b.a.com/x/y")],
                                  "page_id long, url string").withColumn("verdict", F.lit("?"))
    # Two rules of one length: block wins.
    rules = [url_rules.site_rule("a.com/x", "allow"), url_rules.site_rule("a.com/x", "block")]
    for per_pass in (10, 1):
        got = url_rules.judge_urls(pages, rules, per_pass=per_pass).collect()
        assert sorted((str(r.page_id), str(r._llm_rule), r._llm_verdict, r.verdict) for r in got) == [
            ("1", "a.com/x", "block", "?"), ("1", "a.com/x", "block", "?"), ("2", "a.com/x", "block", "?"), ("None", "None", "allow", "?")]
    assert url_rules.judge_urls(pages.where("false"), rules).collect() == []
    assert {r._llm_verdict for r in url_rules.judge_urls(pages, []).collect()} == {"allow"}


def test_fingerprints_of_one_row_and_of_copies(spark):
    one = spark.createDataFrame([(7, "some words here")], "doc_id long, text string")
    row = imatch.imatch(one).first()
    assert (row.n_chars, row.near_next) == (15, 1.0)
    copies = imatch.imatch(_table(spark, (SECRETS, "nothing"))).collect()
    assert len(copies) == 7 and len({r.fingerprint for r in copies if r.n_chars == len(SECRETS)}) == 1


def test_contamination_of_a_very_long_text(spark):
    item = " ".join(f"b{k}" for k in range(12))
    docs = spark.createDataFrame([(1, "x " * 50_000 + item + " y" * 50_000)], "doc_id long, text string")
    row = decontaminate.contamination(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).first()
    assert (row.n_words, row.n_hit) == (100_012, 12)
