"""Matching against brute force: worked examples, every NULL combination, forced hot keys."""

import itertools
import random
from collections import Counter

import pytest

from firmalign.catalog.queries import queries
from firmalign.operators import gaps as g, matching as m, mutations as mu
from firmalign.operators.skew import MIN_HOT_ROWS, hot_keys
from firmalign.sources.fixtures import run_ts

RANK = {"EXACT_MATCH": 1, "PAYER_ID_ONLY": 2, "NAME_ONLY": 3, "NO_MATCH": 4}
VIA = {"fac": 1, "pro": 2, "elig": 3, "name": 4, None: 5}


def low(x):
    return None if x is None else x.lower()


def grade(variant, payer, name, ids, oa_name):
    """(status, via) of one joined row, by the definitions of each classifier."""
    hits = [kind for kind, i in zip(("fac", "pro", "elig"), ids) if payer is not None and payer == i]
    same = (low(name) or "") == (low(oa_name) or "")
    via = hits[0] if hits else None
    if variant == "v1":
        by_id = (payer or "") == (ids[0] or "")
        return ("EXACT_MATCH" if by_id and same else "PAYER_ID_ONLY" if by_id
                else "NAME_ONLY" if same else "NO_MATCH"), None
    if hits:
        return ("EXACT_MATCH" if same else "PAYER_ID_ONLY"), via
    if variant in ("preflight", "raw"):
        other = payer is not None and all(i is not None and i != payer for i in ids)
        return ("NAME_ONLY" if same and other else "NO_MATCH"), None
    return ("NAME_ONLY", "name") if same else ("NO_MATCH", None)


def joined(firms, oas, ids_of):
    """The OR join, row by row; firms without a match come with None."""
    for f in firms:
        some = False
        for o in oas:
            ids = ids_of(o)
            if (f[1] is not None and f[1] in [i for i in ids if i is not None]) or (
                    f[2] is not None and o[4] is not None and low(f[2]) == low(o[4])):
                some = True
                yield f, o, ids
        if not some:
            yield f, None, [None] * len(ids_of(oas[0]))


def null_matrix():
    firms = [(i, p, n) for i, (p, n) in enumerate(itertools.product(
        (None, "", "A", "B", "C", "Z"), (None, "", "One", "ONE", "Two")))]
    oas = [(100 + i, a, b, c, n) for i, (a, b, c, n) in enumerate(itertools.product(
        (None, "A", ""), (None, "B", "A"), (None, "C"), (None, "", "one", "Other")))]
    return firms, oas


def check_against_brute_force(firm_rows, oa_rows, firms, masters):
    multi = masters(oa_rows)
    single_rows = [r[:5] + (r[1],) for r in oa_rows]
    single = masters(single_rows)
    firm = firms(firm_rows)
    for variant, mode in (("v2", "multi"), ("preflight", "multi"), ("v1", "single"),
                          ("raw", "single")):
        oa = multi if mode == "multi" else single
        ids_of = (lambda o: list(o[1:4])) if mode == "multi" else (lambda o: [o[1]])
        rows = [(f[0], o and o[0], *grade(variant, f[1], f[2], ids, o and o[4]))
                for f, o, ids in joined(firm_rows, oa_rows, ids_of)]
        pairs = m.classify_matches(m.match_pairs(firm, oa, mode, "left"), variant, mode)
        via = ["matched_via"] if mode == "multi" else []
        got = [(r["firm_id"], r["oa_id"], r["match_status"], r["matched_via"] if via else None)
               for r in pairs.select("firm_id", "oa_id", "match_status", *via).collect()]
        want = rows if mode == "multi" else [(a, b, s, None) for a, b, s, _ in rows]
        assert Counter(got) == Counter(want), variant

        # Counting without pairs agrees with counting the pairs.
        lines = m.outcome_counts(firm, oa, mode, variant).collect()
        counted = {(r["firm_id"], r["match_status"], r["matched_via"]): r["n"] for r in lines}
        assert len(counted) == len(lines), "one line per firm, status and via"
        assert counted == Counter((a, s, w) for a, _, s, w in want), variant

        # The resolved row is the best pair.
        if variant != "preflight":
            best = {}
            for a, b, s, w in want:
                if b is not None:
                    key = (RANK[s], VIA[w] if mode == "multi" else 0, b)
                    best[a] = min(best.get(a, key), key)
            resolved = {r["firm_id"]: (RANK[r["match_status"]],
                                       VIA[r["matched_via"]] if mode == "multi" else 0, r["oa_id"])
                        for r in m.resolve_matches(firm, oa, mode, variant).collect()}
            assert resolved == best, variant
            full = m.with_master(firm, oa, m.resolve_matches(firm, oa, mode, variant), mode)
            assert {r["firm_id"]: r["oa_id"] for r in full.collect()} == {
                a: k[2] for a, k in best.items()}

    matched = {f[0] for f, o, _ in joined(firm_rows, oa_rows, lambda o: list(o[1:4])) if o}
    strict = {r["firm_id"] for r in g.garbage_firms(firm, multi, "strict").collect()}
    assert strict == {f[0] for f in firm_rows} - matched
    reference = Counter(f[0] for f, o, ids in joined(firm_rows, oa_rows, lambda o: list(o[1:4]))
                        if all(i is None for i in ids))
    assert {r["firm_id"]: r["joined_rows"]
            for r in g.garbage_firms(firm, multi).collect()} == reference
    used = {o[0] for _, o, _ in joined(firm_rows, oa_rows, lambda o: list(o[1:4])) if o}
    new = {r["firm_id"] for r in g.new_rows(multi, firm).collect()}
    assert new == {o[0] for o in oa_rows} - used


def test_null_matrix(firms, masters):
    check_against_brute_force(*null_matrix(), firms, masters)


def test_hot_keys_change_nothing(spark, firms, masters):
    rng = random.Random(7)
    firm_rows = [(i, rng.choice([None, "HOT", "HOT", f"A{i % 9}", f"B{i}"]),
                  rng.choice([None, "", "Hot Name", "Hot Name", f"n{i % 11}", f"m{i}"]))
                 for i in range(160)]
    oa_rows = [(1000 + i, rng.choice([None, "HOT", f"A{i % 9}"]), rng.choice([None, "HOT", f"B{i}"]),
                rng.choice([None, f"A{i % 7}"]), rng.choice([None, "hot name", f"n{i % 13}", f"x{i}"]))
               for i in range(60)]
    spark.conf.set(MIN_HOT_ROWS, "5")
    spark.conf.set("spark.sql.shuffle.partitions", "16")   # a fair share is 20 of 320 keys
    try:
        hot = hot_keys(m.firm_keys(firms(firm_rows), "in"), "key")
        assert "i:HOT" in hot and "n:hot name" in hot and hot["i:HOT"] > 1
        check_against_brute_force(firm_rows, oa_rows, firms, masters)
    finally:
        spark.conf.unset(MIN_HOT_ROWS)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


GOLDEN = [
    # firm payer id, firm name, master (fac, pro, elig, name), status, via, new id
    ("FAC001", "Aetna Inc", ("FAC001", "PRO001", None, "Aetna"), "PAYER_ID_ONLY", "fac", "FAC001"),
    ("OLD002", "Blue Cross", (None, "PRO002", "ELIG002", "Blue Cross"), "NAME_ONLY", "name", "PRO002"),
    ("PRO002", "Blue Cross", (None, "PRO002", None, "BCBS"), "PAYER_ID_ONLY", "pro", "PRO002"),
    ("ELIG003", "United Health", (None, None, "ELIG003", "UHC"), "PAYER_ID_ONLY", "elig", "ELIG003"),
]


@pytest.mark.parametrize("case", GOLDEN, ids=[c[0] for c in GOLDEN])
def test_worked_examples(case, firms, masters):
    payer, name, master, status, via, new_id = case
    row = mu.update_matched(firms([(1, payer, name)]), masters([(9, *master)]), run_ts()).first()
    assert (row["sync_status"], row["matched_via"], row["payer_id_new"]) == (status, via, new_id)
    assert (row["payer_id"], row["name"], row["name_new"]) == (payer, name, master[3])


def test_single_key_examples(firms, masters):
    firm = firms([(1, "PAYER001", "Aetna"), (2, "PAYER002", "Aetna Inc"), (3, "GARBAGE", "Test Payer")])
    oa = masters([(11, "F1", None, None, "Aetna", "PAYER001"), (12, "F2", None, None, "Aetna X", "PAYER002"),
                  (13, "F5", None, None, "Blue Cross", "PAYER005")])
    out = {r["firm_id"]: r for r in mu.update_matched(firm, oa, run_ts(), "single").collect()}
    assert out[1]["sync_status"] == "EXACT_MATCH" and out[1]["payer_id_fac"] == "F1"
    assert out[2]["sync_status"] == "PAYER_ID_ONLY" and out[2]["name"] == "Aetna Inc"
    assert out[3]["sync_status"] is None
    assert [r["firm_id"] for r in g.garbage_firms(firm, oa, "strict", "single").collect()] == [3]
    added = mu.insert_new(firm, oa, run_ts(), key_mode="single").where("firm_id > 3").collect()
    assert [(r["firm_id"], r["name"], r["sync_status"]) for r in added] == [
        (4, "Blue Cross", "NEW_FROM_OA")]


def test_prediction_matches_anchor(data):
    rows = m.match_prediction(data.firm, data.oa).collect()
    assert {(r["match_status"], r["matched_via"]): r["predicted_count"] for r in rows} == {
        ("EXACT_MATCH", "fac"): 36, ("EXACT_MATCH", "pro"): 27, ("EXACT_MATCH", "elig"): 13,
        ("PAYER_ID_ONLY", "fac"): 19, ("PAYER_ID_ONLY", "pro"): 1, ("PAYER_ID_ONLY", "elig"): 1,
        ("NAME_ONLY", "name"): 41, ("NO_MATCH", None): 18}


def test_two_sided_match_equals_the_one_sided_ones(spark, data, firms, masters):
    from firmalign.operators import gaps as g
    for firm, oa in ((data.firm, data.oa), (data.firm_ids, data.oa),
                     (firms([(1, None, None), (2, "", "x"), (3, "P", "p")]),
                      masters([(7, "P", None, None, None), (8, None, None, None, "X"), (9, None, None, None, None)]))):
        both = m.two_sided(firm, oa)
        one = m.match_profile(firm, oa)
        key = lambda df: sorted(map(tuple, df.select(*sorted(one.columns)).collect()), key=repr)
        assert key(both.profile) == key(one)
        ids = lambda df: sorted(r[0] for r in df.select("firm_id").collect())
        assert ids(both.new) == ids(g.new_ids(oa, firm))


def test_two_sided_match_splits_hot_keys(spark, firms, masters):
    from firmalign.operators.skew import MIN_HOT_ROWS
    firm = firms([(k, "HOT", f"n{k % 3}") for k in range(300)] + [(k, f"P{k}", None) for k in range(300, 320)])
    oa = masters([(k, "HOT", None, None, f"n{k}") for k in range(40)] + [(99, "Q", None, None, "none")])
    plain = m.two_sided(firm, oa)
    spark.conf.set(MIN_HOT_ROWS, "50")
    try:
        split = m.two_sided(firm, oa)
        assert split.hot["i:HOT"] > 1 and not plain.hot
        rows = lambda b: sorted(map(tuple, b.profile.collect()), key=repr)
        assert rows(plain) == rows(split)
        assert [r[0] for r in split.new.collect()] == [99]
    finally:
        spark.conf.unset(MIN_HOT_ROWS)


def check_details(data, query, wording):
    """Each joined row has its own text, also a second master row of the same firm."""
    firm_rows = [tuple(r) for r in data.firm.select("firm_id", "payer_id", "name").collect()]
    oa_rows = [(r[0], r[1], None, None, r[2])
               for r in data.oa1.select("firm_id", "payer_id", "name").collect()]
    expected = []
    for f, o, ids in joined(firm_rows, oa_rows, lambda o: [o[1]]):
        status, _ = grade("v1", f[1], f[2], ids, o and o[4])
        old_new = {"PAYER_ID_ONLY": (f[2], o and o[4]), "NAME_ONLY": (f[1], ids[0])}.get(status, ())
        text = None if None in old_new else wording[status].format(*old_new)
        expected.append((f[0], o and o[0], text))
    assert len(expected) > len({f for f, *_ in expected}) == len(firm_rows)
    got = queries()[query](data.spark, data.path).select("firm_id", "oa_id", "sync_details")
    assert Counter(map(tuple, got.collect())) == Counter(expected)


def test_v0_details_of_every_joined_row(data):
    check_details(data, "sync_details__v0", {
        "EXACT_MATCH": "Perfect match. Data synced from insurance_firm_oa.",
        "PAYER_ID_ONLY": 'Payer ID matches but name differs. Old: "{}", New: "{}"',
        "NAME_ONLY": 'Name matches but payer_id differs. Old: "{}", New: "{}"',
        "NO_MATCH": "No matching record found in insurance_firm_oa"})


def test_v1_details_of_every_joined_row(data):
    check_details(data, "sync_details__v1", {
        "EXACT_MATCH": "Perfect match. Old values preserved, new values in *_new columns.",
        "PAYER_ID_ONLY": 'Payer ID matches. Name differs - old: "{}", new: "{}"',
        "NAME_ONLY": 'Name matches. Payer ID differs - old: "{}", new: "{}"',
        "NO_MATCH": "Unknown"})
