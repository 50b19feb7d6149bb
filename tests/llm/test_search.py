"""Ranked search and spelling variants by brute force, quality votes by plain loops."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ODD, frame, prose

from firmalign.llm import neighbours, ranking, variants

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def as_sorted(rows):
    return sorted(rows, key=repr)


# --- ranked search

def items_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, item string")


def ranked_by_hand(rows, items, k=10):
    docs = [(i, Counter(TERM.findall(lower(t)))) for i, t in rows]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item_id, text in sorted(set((i, t or "") for i, t in items), key=repr):
        scores = []
        asked = Counter(TERM.findall(lower(text)))
        for doc_id, c, n in docs:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t, q in asked.items() if c[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, rank, None if gone else doc_id, -score)
                for rank, (score, gone, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return out


def some_items(corpus):
    rng = random.Random(3)
    items = [(k, prose(rng, rng.randint(1, 40))) for k in range(30)]
    return items + [(40, None), (41, ""), (None, corpus[0][1]), (42, corpus[5][1] * 2), (0, items[0][1]),
                    (0, "ba de ki"), (43, "nowhere"), (44, "same TEXT here"), (45, "ba"), (46, "ba 9 ba")]


@pytest.mark.parametrize("small", [False, True])
def test_ranked_search(spark, documents, corpus, odd, empty, small, monkeypatch):
    if small:        # many passes, groups, buckets and sorted runs
        for name, value in (("PASS_BYTES", 700), ("GROUP_ITEMS", 3), ("BUCKET", 8), ("SORTED", 5),
                            ("FOCUS", 2)):
            monkeypatch.setattr(ranking, name, value)
    rows = corpus + ODD + corpus[:30]
    items = some_items(corpus)
    both = documents.unionByName(odd).unionByName(frame(spark, corpus[:30]))
    got = ranking.search(both, items_frame(spark, items)).select("item_id", "rank", "doc_id", "score")
    assert as_sorted(map(tuple, got.collect())) == as_sorted(ranked_by_hand(rows, items))


def test_ranked_search_of_nothing(spark, documents, empty):
    some, none = items_frame(spark, [(1, "ba de")]), items_frame(spark, [])
    for docs, items in ((empty, some), (documents, none), (empty, none),
                        (documents, items_frame(spark, [(1, None)]))):
        out = ranking.search(docs, items)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_buckets_are_passed_over():
    """A long vector first, then many short ones: their buckets are never multiplied out."""
    group = ranking._groups([{0: 5, 1: 3}], 1, 2)[0]
    rows = np.repeat(np.arange(2000), 2)
    terms = np.tile([0, 1], 2000)
    impact = np.repeat(np.append(1000, np.arange(1999) % 7 + 1), 2)
    asked = []
    rescore = group._rescore
    group._rescore = lambda ids, docs, item, r, *rest: (asked.append(len(r)),
                                                        rescore(ids, docs, item, r, *rest))
    group.search(list(range(2000)), rows, terms, impact)
    assert list(group.rows()) == [(0, 0, 8000)] and sum(asked) <= ranking.BUCKET


@pytest.mark.parametrize("bucket, focus", [(1, 1), (8, 2), (256, 8)])
def test_bounds_lose_no_document(monkeypatch, bucket, focus):
    """The k best of random vectors, in several calls, against all inner products."""
    monkeypatch.setattr(ranking, "BUCKET", bucket)
    monkeypatch.setattr(ranking, "FOCUS", focus)
    monkeypatch.setattr(ranking, "GROUP_ITEMS", 4)
    monkeypatch.setattr(ranking, "GROUP_TERMS", 12)
    rng = np.random.default_rng(bucket)
    n_terms = 30
    queries = [{int(t): int(rng.integers(-500, 3000)) for t in rng.choice(n_terms, rng.integers(1, 9), False)}
               for _ in range(11)]
    groups = ranking._groups(queries, 5, n_terms)
    assert len(groups) > 2
    dense = np.where(rng.random((600, n_terms)) < .2, rng.integers(1, 900, (600, n_terms)), 0)
    for at in range(0, 600, 150):
        row, term = np.nonzero(dense[at:at + 150])
        for group in groups:
            group.search(list(range(at, at + 150)), row, term, dense[at:at + 150][row, term])
    got = sorted(r for g in groups for r in g.rows())
    hand = []
    for q, query in enumerate(queries):
        scores = sum(dense[:, t] * w for t, w in query.items())
        best = sorted((-s, d) for d, s in enumerate(scores.tolist()) if s > 0)[:5]
        hand += [(q, d, -s) for s, d in best]
    assert got == sorted(hand)


def test_ties_go_by_doc_id(spark):
    docs = frame(spark, [(k, "ba de ki") for k in (7, None, 3, -1, 3, 12)] + [(99, "lo mu tz " * 9)])
    got = ranking.search(docs, items_frame(spark, [(1, "ki")]), k=4).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [
        (1, -1), (2, 3), (3, 3), (4, 7)]


def test_op11_query(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, prose(rng, rng.randint(1, 60))) for k in range(50)]
    items = [(k, prose(rng, 12)) for k in range(8)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    items_frame(spark, items).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = ranking.op11_ranked_search(spark, str(tmp_path))
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert as_sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got.collect()) == \
        as_sorted(ranked_by_hand(rows, items))


# --- spelling variants

def differ_by_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same:] == b[same + 1:] if len(a) < len(b) else a[same + 1:] == b[same + 1:]


def variants_by_hand(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    form, out = {}, []
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and differ_by_one(v, w)] for w in n}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def spelled(rng, n_docs):
    """Documents of frequent words, rarer misspellings of them, and misspellings of those."""
    letters = "aabbñéc"
    base = ["".join(rng.choices(letters, k=rng.randint(7, 11))) for _ in range(25)]

    def slip(w):
        at, c = rng.randrange(len(w)), rng.choice(letters)
        return rng.choice([w[:at] + c + w[at:], w[:at] + w[at + 1:], w[:at] + c + w[at + 1:], c + w, w + c])
    rows = []
    for k in range(n_docs):
        text = []
        for _ in range(120):
            w = rng.choice(base)
            while rng.random() < 0.07:
                w = slip(w)
            text.append(rng.choice([w, w, w.title(), w.upper().replace("Ñ", "ñ")]))
        rows.append((k, rng.choice([" ", "1", "\n", " — "]).join(text)))
    # A chain: a frequent word, a misspelling of it, and a rare misspelling of that.
    rows += [(1000 + k, "kettledrum " * 30 + "ketledrum " * 2 + "ketledrun " * (k < 3)) for k in range(20)]
    return rows


@pytest.mark.parametrize("most_group", [variants.MOST_GROUP, 3])
def test_spelling_variants(spark, odd, most_group, monkeypatch):
    monkeypatch.setattr(variants, "MOST_INDEXED", 200)
    monkeypatch.setattr(variants, "MOST_SEARCHED", 50)
    rows = spelled(random.Random(2), 60) + ODD
    long = [(500, "ab" * 400 + " " + "ab" * 400), (501, "ab" * 399 + "c")] * 40
    got = variants.group_variants(frame(spark, rows + long).repartition(5), most_group)
    hand = variants_by_hand(rows + long)
    assert as_sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect())) == \
        as_sorted(hand)
    assert any(r[1] and r[2] != r[1] for r in hand), "some chain of forms"


def test_no_words(spark, empty):
    assert variants.group_variants(empty).count() == 0
    assert variants.group_variants(frame(spark, [(1, None), (2, "short words only")])).count() == 0


@pytest.mark.parametrize("at_once", [3, 1 << 15])
def test_near_words_of_a_chunk(monkeypatch, at_once):
    monkeypatch.setattr(variants, "MOST_SEARCHED", at_once)
    rng = random.Random(at_once)
    words = sorted({"".join(rng.choices("abÿ", k=rng.randint(7, 9))) for _ in range(150)})
    counts = {w: rng.randint(2, 9) for w in words}
    rows = []
    for w in words:
        for m in {len(w), len(w) - 1} - {6}:
            a = m // 2
            rows += [(f"L{m}{w[:a]}", w, counts[w], m, "L", a, m, 0),
                     (f"R{m}{w[a - m:]}", w, counts[w], m, "R", m - a, m, a)]
    got = {w: (n, best_n, best) for w, n, best_n, best in zip(*map(list, variants._searched(rows)))}
    hand = {}
    for w in words:
        near = [v for v in words if v != w and differ_by_one(v, w)]
        if near:
            best = min(near, key=lambda v: (-counts[v], v))
            hand[w] = (len(near), counts[best], best)
    assert got == hand and len(hand) > 20


def test_search_scheme_keeps_both_directions_in_step():
    rng = random.Random(6)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(7, 9))).encode("latin-1") for _ in range(200)})
    index = variants.Index(words)
    for turned in (index, index.turned()):
        own = [w[::-1] if turned.is_turned else w for w in words if len(w) == 8]
        codes = index.code[np.frombuffer(b"".join(own), np.uint8)].reshape(-1, 8).astype(np.int64)
        for kept in (3, 4):
            low, back, size = turned._matched(codes, kept)
            text, rev = turned.forward.text, turned.backward.text
            for k, w in enumerate(codes):
                pattern = [1, *w[:kept].tolist()]
                starts = turned.forward.suffixes[low[k]:low[k] + size[k]]
                ends = turned.backward.suffixes[back[k]:back[k] + size[k]]
                assert all(text[s:s + kept + 1].tolist() == pattern for s in starts)
                assert all(rev[s:s + kept + 1].tolist() == pattern[::-1] for s in ends)


def test_op13_query(spark, tmp_path):
    rows = spelled(random.Random(4), 30)
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = variants.op13_spelling_variants(spark, str(tmp_path))
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint",
                                "n_near": "bigint", "form_n": "bigint"}
    assert as_sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect())) == \
        as_sorted(variants_by_hand(rows))


# --- quality by nearest neighbours

def labelled(rng, n):
    """Prose, and junk of three kinds, with labels for most; every fifth id is held out by the rule."""
    rows, labels = [], []
    for k in range(n):
        good = k % 3 > 0
        text = prose(rng, rng.randint(20, 150))
        if not good:
            text = (" ".join(w for w in text.split()[:12] for _ in range(8)), text.upper().replace(" ", "!! "),
                    "\n".join([text[:40]] * 30))[k // 3 % 3]
        rows.append((k, text))
        if k % 7:
            labels.append((k, int(good), "x"))
    return rows, labels


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, label string")


def held(k):
    return zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 0


def shares_by_hand(text):
    """Feature -> share, by plain counting."""
    tokens = text.split()
    n, out = len(tokens), Counter()
    if not n:
        return {neighbours.NONE: 1.0}
    for t in tokens:
        shape, word = divmod(neighbours.token_code(t), neighbours.WORDS)
        out[shape] += 1 / n
        out[neighbours.SHAPES + word] += 1 / n
    out[neighbours.REPEATED] = sum(a == b for a, b in zip(tokens, tokens[1:])) / n
    out[neighbours.AGAIN] = (n - len(set(tokens))) / n
    lines = [x for x in text.split("\n") if x.strip()]
    out[neighbours.LINES] = (len(lines) - len(set(lines))) / len(lines)
    out[neighbours.SOME] = 1 / n
    out[neighbours.BANDS + min(n.bit_length(), 24)] = 0.5
    return out


def test_votes_equal_a_plain_loop():
    rng = random.Random(11)
    rows, labels = labelled(rng, 90)
    texts, codes = [t for _, t in rows] + ["", " \n", "x"], neighbours._Codes()
    shares = neighbours._shares(texts, codes)
    for row, text in zip(shares, texts):
        hand = shares_by_hand(text)
        assert np.allclose(row ** 2, [hand.get(f, 0) for f in range(neighbours.FEATURES)], atol=1e-9)
    known = [(k, y) for k, y, _ in labels]
    model = neighbours.train(shares[[k for k, _ in known]], np.array([y for _, y in known]))
    assert model.directions.shape == (neighbours.FEATURES, neighbours.DIMENSIONS)
    got = model.votes(model.latent(shares))
    for row, score in zip(model.latent(shares), got):
        sims = [(-round(float(np.dot(row, v)) * neighbours.STEPS), k) for k, v in enumerate(model.vectors)]
        near = sorted(sims)[:neighbours.NEIGHBOURS]
        votes = [(max(-s / neighbours.STEPS, 1e-3) ** neighbours.POWER, model.labels[k]) for s, k in near]
        assert score == pytest.approx(sum(w * y for w, y in votes) / sum(w for w, _ in votes), abs=2e-2)


def test_quality_of_held_out_texts(spark, odd, empty):
    rng = random.Random(12)
    rows, labels = labelled(rng, 400)
    docs = frame(spark, rows)
    # Labels of held-out ids are turned round: they must not be learnt from.
    labels = [(k, 1 - y if held(k) else y, x) for k, y, x in labels]
    noise = [(10_000, 1, "x"), (None, 0, "x"), (3, None, "x"), (4, 0, "x"), (4, 1, "x")]
    model = neighbours.fit(docs.repartition(4), labels_frame(spark, labels + noise + labels[:20]))
    scores = {r["doc_id"]: r["score"] for r in neighbours.score(docs, model).collect()}
    wrong = [k for k, _ in rows if held(k) and (scores[k] >= neighbours.LEAST_SCORE) != (k % 3 > 0)]
    assert len(wrong) <= 0.05 * sum(held(k) for k, _ in rows)
    again = neighbours.fit(docs.repartition(2), labels_frame(spark, labels + noise).repartition(3))
    assert np.array_equal(again.labels, model.labels)
    assert np.allclose(np.abs(again.vectors @ again.vectors.T), np.abs(model.vectors @ model.vectors.T), atol=1e-3)
    few = neighbours.fit(docs, labels_frame(spark, labels), most=5)
    assert len(few.labels) == 10 and sorted(few.labels) == [0] * 5 + [1] * 5

    got = neighbours.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    by_id = {}
    for r in got:
        assert by_id.setdefault(r["doc_id"], r["score"]) == pytest.approx(r["score"]) or r["doc_id"] is None
    assert neighbours.score(empty, model).count() == 0
    nothing = neighbours.fit(docs, labels_frame(spark, []))
    assert {r["score"] for r in neighbours.score(docs, nothing).collect()} == {0.5}
    one = neighbours.fit(docs, labels_frame(spark, [r for r in labels if r[1] == 1]))
    assert {r["score"] for r in neighbours.score(docs, one).collect()} == {1.0}
    assert len(neighbours.fit(empty, labels_frame(spark, labels)).labels) == 0


def test_op12_query(spark):
    from testing_paths import SF
    sf = SF.replace("sf0.001", "sf0.01")
    got = neighbours.op12_quality(spark, sf)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double",
                                "predicted": "int"}
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = got.collect()
    assert all(r["held_out"] == held(r["doc_id"]) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    asked = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in asked) >= 0.95 * len(asked)
