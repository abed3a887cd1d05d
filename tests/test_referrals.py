"""Referral matching against brute force on awkward names."""

import random

import pytest
from pyspark.sql import functions as F

from retentia.operators.similarity import candidate_pairs, similar_names
from retentia.plans.referrals import match_referrals, unmatched_referrals


def grams(name):
    framed = f" {name} "
    return {framed[i : i + 3] for i in range(len(name))}


@pytest.mark.parametrize("least, shared", [(0.3, 3), (0.6, 2), (0.8, 3), (0.8, 1), (1.0, 3)])
def test_no_similar_pair_is_lost(spark, least, shared):
    rng = random.Random(13)
    words = ["acme", "data", "dato", "soft", "softs", "nord", "x", "ag", "größe", "12"]
    names = sorted({" ".join(rng.choice(words) for _ in range(rng.randrange(1, 5))) for _ in range(120)})
    ours, theirs = names[::2], names[1::3] + names[:4]
    frames = [spark.createDataFrame([(n,) for n in sorted(set(x))], "key string") for x in (ours, theirs)]
    got = {(r.asked, r.known): r.similarity for r in similar_names(*frames, least, shared).collect()}
    want = {(a, b): len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for a in ours for b in set(theirs)}
    assert got == {pair: s for pair, s in want.items() if s >= least}


def test_numbered_names_stay_apart(spark):
    """Names that differ by their number: the pairs that are compared grow with the names, not with their square."""
    counted = []
    for n in (1500, 6000):
        known = spark.range(n).select(F.format_string("customer %09d", "id").alias("key"))
        asked = spark.range(0, n, 3).select(F.format_string("customer %09d se", "id").alias("key"))
        counted.append(candidate_pairs(asked, known, 0.8).count())
    assert counted[1] < 8 * counted[0] and counted[1] < 0.002 * 6000 * 2000


def test_referrals(spark):
    customers = spark.createDataFrame(
        [("C3", "Acme Data GmbH", "a@x.com"), ("C2", "ACME-DATA, GmbH", "b@x.com"), ("C4", None, "a@x.com"), ("C5", "Nord", None), ("C6", "--", "")],
        "customer_id string, company_name string, email string",
    )
    asked = [
        ("R1", " A@X.com ", "Nord"), ("R2", "z@x.com", "acme data gmbh"), ("R3", None, "NORD."), ("R4", "", "--"),
        ("R5", None, None), ("R6", "b@x.com", None), ("R7", None, "South"), ("R3", None, "NORD."),
    ]
    referrals = spark.createDataFrame(asked, "referral_id string, email string, company_name string")
    matched = match_referrals(referrals, customers)
    rows = sorted((r.referral_id, r.customer_id, r.matched_by) for r in matched.collect() if r.matched_by)
    assert rows == [
        ("R1", "C3", "email"), ("R2", "C2", "company"), ("R3", "C5", "company"), ("R3", "C5", "company"), ("R6", "C2", "email"),
    ]
    assert sorted(r.referral_id for r in unmatched_referrals(matched).collect()) == ["R4", "R5", "R7"]
    assert match_referrals(referrals.limit(0), customers).count() == 0
    assert unmatched_referrals(match_referrals(referrals, customers.limit(0))).count() == len(asked)
