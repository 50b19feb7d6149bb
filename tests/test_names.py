"""Trigram similarity against brute force."""

import random
import re

import pytest

from firmalign.operators import names as n


def grams(name):
    out = set()
    for word in re.findall(r"[^\W_]+", name.lower()):
        padded = f"  {word} "
        out |= {padded[i:i + 3] for i in range(len(padded) - 2)}
    return out


def score(a, b):
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 0.0


def some_names(seed, count):
    rng = random.Random(seed)
    words = ["blue", "cross", "shield", "health", "united", "care", "plan", "of", "a", "north",
             "south", "mutual", "Aetna", "Cigna", "group", "benefit", "Été"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
            + rng.choice(["", "", " Inc", f" #{rng.randint(1, 99):05d}"]) for _ in range(count)]


@pytest.fixture(scope="module")
def names():
    left, right = some_names(1, 70), some_names(2, 70)
    return left + left[:9] + [None, "", "x"], right + right[:5] + [left[3].upper(), None, "y"]


@pytest.mark.parametrize("threshold", [0.9, 0.6, 0.35])
def test_similar_names_finds_every_pair(names, firms, masters, threshold):
    left, right = names
    firm = firms([(i, f"P{i}", x) for i, x in enumerate(left)])
    oa = masters([(i, None, None, None, x) for i, x in enumerate(right)])
    got = {(r["firm_name"], r["oa_name"]): r["name_similarity"] for r in n.similar_names(
        n._distinct_names(firm, "firm"), n._distinct_names(oa, "oa"), threshold).collect()}
    want = {(a.lower(), b.lower()): score(a, b) for a in left if a for b in right if b}
    assert got == pytest.approx({k: s for k, s in want.items() if s > threshold})


@pytest.mark.parametrize("k", [5, 400])
def test_top_matches(names, firms, masters, k):
    left, right = names
    firm = firms([(i, f"P{i}", x) for i, x in enumerate(left)])
    oa = masters([(i, None, None, None, x) for i, x in enumerate(right)])
    every = [(-score(a, b), i, j) for i, a in enumerate(left) if a for j, b in enumerate(right) if b]
    want = sorted(x for x in every if 0.6 < -x[0] < 1.0)[:k]
    got = n.fuzzy_name_matches(firm, oa, k=k).collect()
    assert [(r["firm_id"], r["oa_id"]) for r in got] == [(i, j) for _, i, j in want]
    assert [r["name_similarity"] for r in got] == pytest.approx([-s for s, _, _ in want])


@pytest.mark.parametrize("lacking", [None, 1, 3])
def test_keys_of_any_length_find_every_pair(names, firms, masters, monkeypatch, lacking):
    """What a join costs follows the length of its keys, hot keys and samples; its pairs don't."""
    left, right = names
    firm = n._distinct_names(firms([(i, f"P{i}", x) for i, x in enumerate(left)]), "firm")
    oa = n._distinct_names(masters([(i, None, None, None, x) for i, x in enumerate(right)]), "oa")
    ranked = n.ranked_grams(firm, oa)
    every = {(a.lower(), b.lower()): score(a, b) for a in left if a for b in right if b}
    near = {(a, b) for a, b in every if lacking is None
            or max(len(grams(a) - grams(b)), len(grams(b) - grams(a))) <= lacking}
    some_key = ranked.rows.selectExpr("g[0] AS key").first()["key"]
    for threshold, length in [(0.9, 12), (0.6, 1), (0.6, 3), (0.35, 2)]:
        monkeypatch.setattr(n, "_key_length", lambda *a, length=length: (length, {some_key: 3}))
        got = {(r["firm_name"], r["oa_name"]): r["name_similarity"] for r in n.similar_names(
            firm, oa, threshold, ranked, first=lacking).collect()}
        assert got == pytest.approx({x: every[x] for x in near if every[x] > threshold})


def test_names_of_few_grams_meet_few_others(firms, masters, monkeypatch):
    """Names made of the same few grams, as numbered ones are: the join must not form all their pairs."""
    rng = random.Random(5)
    left, right = ([x for x in ("".join(rng.choice("abc") for _ in range(16)) for _ in range(1700))
                    if "aaa" not in x] for _ in range(2))
    right += [x.replace("aa", "aaa", 1) for x in left if "aa" in x][:30]
    firm = firms([(i, f"P{i}", x) for i, x in enumerate(left)])
    oa = masters([(i, None, None, None, x) for i, x in enumerate(right)])
    met, join = [], n.grid_join
    monkeypatch.setattr(n, "grid_join", lambda *a: met.append(join(*a)) or met[-1])
    monkeypatch.setattr(n, "_FEW_PAIRS", 0, raising=False)
    got = n.fuzzy_name_matches(firm, oa).collect()
    assert sum(pairs.count() for pairs in met) <= 10 * (len(left) + len(right))
    sets = [(j, grams(b)) for j, b in enumerate(right)]
    every = [(-len(a & b) / len(a | b), i, j) for i, a in enumerate(map(grams, left)) for j, b in sets]
    want = sorted(x for x in every if 0.6 < -x[0] < 1.0)[:20]
    assert [(r["firm_id"], r["oa_id"]) for r in got] == [(i, j) for _, i, j in want]
