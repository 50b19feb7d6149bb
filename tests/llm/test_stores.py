"""Shards, the archive, main text of pages, and the pipeline."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest_llm import ODD, frame, prose
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from firmalign.llm import archive, sharding, templates

# --- shards


def check_shards(df, rows, shards):
    got = sharding.shard(df, shards).collect()
    size = lambda t: len((t or "").encode()) + 1
    by_text = defaultdict(set)
    slots = defaultdict(list)
    texts = Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        by_text[r["text_crc32"]].add(r["shard"])
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_shards(documents, corpus, odd, empty):
    got = check_shards(documents, corpus, 4)
    held = Counter()
    for r in got:
        held[r["shard"]] += r["size"]
    assert max(held.values()) - min(held.values()) <= 200
    check_shards(odd, ODD, 16)
    assert sharding.shard(empty).count() == 0


def test_small_groups_fill_what_large_ones_leave(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LARGE_PART", 4)
    monkeypatch.setattr(sharding, "BUCKET", 50)
    rng = random.Random(2)
    rows = [(k, "x" * rng.randint(1, 300)) for k in range(400)]
    rows += [(1000 + k, "y" * 3000) for k in range(3)] + [(2000 + k, "z") for k in range(200)]
    got = check_shards(frame(spark, rows), rows, 5)
    held = Counter()
    for r in got:
        held[r["shard"]] += r["size"]
    assert max(held.values()) - min(held.values()) < 0.05 * sum(held.values()) / 5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.lists(st.integers(20, 90), min_size=1, max_size=9))
def test_best_fit_takes_the_tightest_bin(sizes, room):
    sizes = sorted(sizes, reverse=True)
    bins, left = sharding.best_fit_decreasing(sizes, room)
    free = list(room)
    for size, k in zip(sizes, bins, strict=True):
        fitting = [r for r in free if r >= size]
        assert free[k] == (min(fitting) if fitting else max(free))
        free[k] -= size
    assert free == left


# --- archive

PAGES = "page_id bigint, url string, html string, digest string, path string, n string"


def page_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)


def records_by_hand(rows, dedup_from):
    largest = {}
    for page_id, _, html in rows:
        if page_id is not None:
            largest[html or ""] = max(page_id, largest.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        leader = largest.get(html or "")
        revisit = len(payload) >= dedup_from and leader is not None and page_id != leader
        out.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "revisit" if revisit else "response", leader if revisit else None))
    return out


@pytest.mark.parametrize("dedup_from", [0, 6])
def test_archive_gives_every_record_back(spark, tmp_path, dedup_from):
    rng = random.Random(7)
    rows = [(k, f"http://h/{k}", rng.choice(["same", "copy of a page", prose(rng, 30)]))
            for k in range(60)]
    rows += [(70, None, None), (71, "u", ""), (None, "v", "same"), (None, None, "only here"),
             (72, "a\r\nWARC-Type: x\r\n\r\n", "ü" * 70_000), (72, "again", "ü" * 70_000), (5, "t", "t5")]
    stored = archive.write_archive(page_frame(spark, rows), str(tmp_path), dedup_from=dedup_from)
    read = archive.read_records(stored, with_bytes=True).collect()
    got = [(r["page_id"], r["payload_bytes"], r["sha1"], r["record_type"], r["refers_to"])
           for r in read]
    assert sorted(got, key=repr) == sorted(records_by_hand(rows, dedup_from), key=repr)
    assert Counter(bytes(r["payload"]) for r in read) == Counter((t or "").encode() for *_, t in rows)
    n_payloads = sum(r["n_entries"] for r in stored.payloads.collect())
    assert n_payloads == len({t or "" for *_, t in rows})
    header = next(r["header"] for r in read if r["page_id"] == 0)
    assert header.startswith("WARC/1.1\r\nWARC-Type: re") and "http://h/0" in header


def test_damage_is_noticed_and_nothing_is_fine(spark, tmp_path):
    stored = archive.write_archive(page_frame(spark, [(1, "u", "abc" * 100)]), f"{tmp_path}/a")
    path = stored.payloads.first()["path"]
    data = bytearray(open(path, "rb").read())
    data[0:1] = b"0" if data[0:1] != b"0" else b"1"
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        archive.read_records(stored).collect()
    none = archive.write_archive(page_frame(spark, [(1, "u", "a")]).where("false"), f"{tmp_path}/b")
    assert archive.read_records(none).count() == 0


# --- main text

def page(title, blocks, host):
    body = "".join(f"<p>{b}" + "</p>" * (k % 2) for k, b in enumerate(blocks))
    side = "<div class='side-bar'><p>Popular things <a href='/x'>x</a></div>"
    frame_ = {
        "a.example": f"<nav><ul><li><a href=/>Home</a></ul></nav><article><h1>{title}</h1>{body}</article>{side}",
        "b.example": f"<div id=top class=header>{title[:3]} site</div><div class=wrap><div class=story>"
                     f"<h2>{title}</h2>{body}<ul class=more><li><a href=/1>{title} one</a>"
                     f"<li><a href=/2>two</a></ul></div>{side}</div><section class='comments'>"
                     f"<div><p>Nice {title} text</p></div></section>",
    }[host]
    return (f"<!DOCTYPE html><html><head><title>{title}</title><script>var a='</p><article>';</script>"
            f"<style>p{{}}</style></head><body><!-- note <p>x</p> -->{frame_}<footer>&copy; {title}</footer>"
            "</body></html>")


def test_main_text_of_templates(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for k in range(24):
        host = ("a.example", "b.example")[k % 2]
        title = f"Title {k} &amp; more"
        blocks = [prose(rng, rng.randint(30, 60)) for _ in range(rng.randint(2, 5))]
        rows.append((k, f"https://{host}/p/{k}?q", page(title, blocks, host)))
        expected[k] = "\n".join([f"Title {k} & more"] + [" ".join(b.split()) for b in blocks])
    rows += [(50, None, None), (51, "x", ""), (52, "https://c.example/", "plain &lt;text&gt; <b>only"),
             (None, "https://c.example/", "<main><p>one<br>two</p><form>no</form></main>"),
             (53, "https://c.example/", "<div><nav>menu</nav><p>lone <i>page</i>"), (53, "y", "<<<a<b 'x")]
    pages = page_frame(spark, rows)
    got = defaultdict(list)
    deduced = templates.deduce(pages)
    for r in templates.extract_text(pages, deduced).collect():
        got[r["page_id"]].append(r["text"])
    assert {k: got[k] for k in expected} == {k: [t] for k, t in expected.items()}
    assert got[50] == [""] and got[51] == [""] and got[52] == ["plain <text> only"]
    assert got[None] == ["one\ntwo"] and "lone page" in got[53] and len(got[53]) == 2
    by_host = {r["host"]: r for r in deduced.collect()}
    assert len(by_host["b.example"]["dropped"]) == 1 and by_host["a.example"]["article"] is not None
    none = pages.where("false")
    assert templates.extract_text(none, templates.deduce(none)).count() == 0


def test_the_article_slot_leaves_no_text_out(spark):
    """Headline or intro beside a body, lists of references in an article, constant text around it."""
    rng = random.Random(13)
    rows, expected = [], {}
    for k in range(24):
        intro, body, more = prose(rng, 20), prose(rng, 70), prose(rng, 15)
        links = "".join(f"<li><a href=/{j}>{prose(rng, 9)}</a>" for j in range(2))
        host, html, kept = [
            ("h", f"<article><h1>{intro}</h1><div class=body><p>{body}</div></article>", (intro, body)),
            ("i", f"<article><div class=intro>{intro}</div><div class=body>{body}</div></article>",
             (intro, body)),
            ("r", f"<article><div class=body>{body}</div><ul class=refs>{links}</ul></article>", None),
            ("c", f"<div>This page is part of our site</div><div class=wrap>{body}"
                  + (f"<div class=rare>{more}</div>" if k == 3 else "") + "</div>",
             (body, more) if k == 3 else (body,)),
        ][k % 4]
        rows.append((k, f"http://{host}.example/{k}", f"<html><body>{html}</body></html>"))
        expected[k] = re.sub(r"\s+", " ", re.sub("<[^>]*>", " ", html)) if kept is None else " ".join(kept)
    pages = page_frame(spark, rows)
    found = templates.extract_text(pages, templates.deduce(pages)).collect()
    assert {r["page_id"]: r["text"].split() for r in found} == {
        k: t.split() for k, t in expected.items()}


def test_names_count_whole_and_never_hold_the_article():
    text = lambda body: templates.main_text(f"<html><body>{body}</body></html>")
    article = "<article><h1>T</h1><p>Body text.</p></article>"
    assert text(f'<div class="content has-sidebar">{article}</div>') == "T\nBody text."
    assert text(f'<div id="sidebar">{article}</div>') == "T\nBody text."
    assert text('<article><section class="related-work"><p>Prior.</p></section><p>Now.</article>') == "Prior.\nNow."
    assert text('<main><div class="discussion-of-results">D.</div><div class="comment-list">nice</div></main>') == "D."
    assert text('<article><p class="cookie-notice">We use cookies<p>More <span class="ad">buy <span>now</span>'
                '</span>text.</article>') == "More text."
    assert text('<article><div class="header"><h1>H</h1></div><p>x</p></article>') == "H\nx"


def test_the_template_alone_finds_the_article(monkeypatch):
    """Without any fixed name: adverts and footers of every text lie outside the host's article slot."""
    import pandas as pd
    rng = random.Random(23)
    monkeypatch.setattr(templates, "CHROME_NAMES", frozenset())
    html, bodies = [], []
    for k in range(9):
        bodies.append(prose(rng, 40).replace("\n", " "))
        html.append(f"<html><body><div class=ad>{prose(rng, 6)}</div><article><p>{bodies[-1]}</p></article>"
                    f"<div class=sidebar>{prose(rng, 9)}</div></body></html>")
    roles = {}
    for page_id, text in enumerate(html):
        for role, parent, times, chars, links, said, main, own, words_ in templates.page_tokens(text):
            at = roles.setdefault(role, {"host": "h", "n_pages": len(html), "role": role, "parent": parent,
                                         "vector": 0, "support": 0, "chars": 0, "links": 0, "once": 0,
                                         "main": 0, "own": 0, "constant": False})
            at["vector"] ^= templates._signed(f"{page_id} {times}")
            at["support"] += 1
            at["chars"] += chars
            at["links"] += links
            at["once"] += times == 1
            at["main"] = max(at["main"], main)
            at["own"] += own
    article = int(templates._template(pd.DataFrame(list(roles.values()))).iloc[0]["article"])
    assert [templates.main_text(text, article) for text in html] == bodies


def test_classes_need_the_same_vector_and_valid_parents():
    import pandas as pd
    rows = pd.DataFrame([
        # role, parent, vector, support, chars, links, once
        (1, 0, 7, 10, 100, 0, 10), (2, 1, 7, 10, 90, 0, 10), (3, 2, 8, 10, 40, 0, 0),
        (4, 9, 7, 10, 99, 0, 10), (5, 2, 5, 6, 9, 9, 6)],
        columns=["role", "parent", "vector", "support", "chars", "links", "once"])
    rows["host"], rows["n_pages"] = "h", 10
    found = templates._template(rows).iloc[0]
    assert found["template"] == [1, 2, 3, 5] and found["article"] == 2 and found["dropped"] == [5]


# --- pipeline

SF = "/root/testdata/sf0.001"


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns, name
        seen.append(docs.count())
    toxic = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").count()
    assert seen == sorted(seen, reverse=True) and seen[3] == seen[4]
    assert seen[1] >= seen[0] - (seen[0] - toxic) // 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == seen[4]


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_pipeline_takes_odd_and_empty_tables(spark, tmp_path, request, kind):
    df = request.getfixturevalue(kind)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert (len(pieces) > 0) == (kind == "odd")
