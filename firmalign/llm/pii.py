"""Personal data by rules and by bootstrapped contextual extraction.

Rules find the seed entities: e-mail and IP addresses, card and phone numbers, and keys, long runs of
letters and digits mixed. Seeds and all other tokens that could be identifiers (they hold three
digits or an @) are instances; the words and marks around them make lexical patterns. The graph of
patterns and instances is scored in rounds: a pattern is as good as the share of its distinct
instances that are trusted, and an instance is trusted as far as its patterns together vouch for it.
Patterns that many different seeds share and that hardly match anything else then discover
identifiers no rule describes. A key alone is no personal data (it may be any checksum): it is found
where such a pattern has it, like any other token.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from firmalign.llm.common import cut_lineage, cut_rows, map_arrow, table, texts_of

KINDS = ("email", "ip", "card", "phone")
FOUND = "found"
#: A pattern counts from so many different seeds on; a round moves trust along one edge.
LEAST_SEEDS, ROUNDS, SMOOTHING, CONFIDENT = 3, 3, 1.0, 0.75
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number that doesn't fit from its first digit on doesn't fit from a later one either.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_HINT = re.compile(r"[0-9@]")
_MARKS = "\"'()[]{}<>,.;:!?|*&%$#="
#: A key: so many letters, digits, _ and - with a letter and a digit among them.
_KEY = re.compile(r"(?<![0-9A-Za-z_-])(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[0-9A-Za-z_-]{24,}(?![0-9A-Za-z_-])")
#: Words and single marks of a context, and how many of them on either side.
_CONTEXT, _REACH = re.compile(r"\w+|[^\w\s]"), 3
#: A seed of the rules, a key, any other instance.
OTHER, SEED, KEY = 0, 1, 2
FACTS = ("doc_id bigint, text_hash bigint, n_email bigint, n_ip bigint, n_card bigint, "
         "n_phone bigint, base string, starts array<int>, ends array<int>, seeds array<int>, "
         "instances array<bigint>, patterns array<bigint>")
_PER_INSTANCE = 4


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), sorted."""
    spans = []
    if "@" in text:
        spans += [(s, 0, e) for s, e in emails(text)]
    if _HINT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, FOUND)[k]}:{s}:{e}" for s, k, e in sorted(spans))


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts).encode("utf-8", "replace")) - (1 << 63)


def _around(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """The words and marks next to a place on either side, each whole, however long."""
    width = 40
    while True:
        low = max(0, start - width)
        before = [(m[0], m.start()) for m in _CONTEXT.finditer(text[low:start])]
        # A word at the edge of what was looked at may be a part of one.
        if low == 0 or len(before) > _REACH:
            break
        width *= 4
    after = []
    for match in _CONTEXT.finditer(text, end):
        after.append(match[0].lower())
        if len(after) == _REACH:
            break
    return [w.lower() for w, _ in before[-_REACH:]], after


def _patterns(text: str, start: int, end: int) -> list[int]:
    """Three words or marks before, two before, one on either side, two after. 0 where there are
    too few."""
    before, after = _around(text, start, end)
    return [_hash("before", *before) if len(before) == 3 else 0,
            _hash("before", *before[-2:]) if len(before) >= 2 else 0,
            _hash("around", before[-1], after[0]) if before and after else 0,
            _hash("after", *after[:2]) if len(after) >= 2 else 0]


def instances(text: str, base: list[tuple]) -> list[tuple[int, int, int]]:
    """(start, end, what it is) of all seeds, keys and tokens that could be identifiers."""
    out = [(s, e, SEED) for s, _, e in base]
    if _HINT.search(text):
        taken = [(s, e) for s, _, e in base]
        free = lambda start, end: not any(s < end and start < e for s, e in taken)
        keys = [(m.start(), m.end()) for m in _KEY.finditer(text) if free(m.start(), m.end())]
        out += [(s, e, KEY) for s, e in keys]
        taken += keys
        for m in _TOKEN.finditer(text):
            token = m[0].lstrip(_MARKS)
            start = m.end() - len(token)
            end = start + len(token.rstrip(_MARKS))
            part = text[start:end]
            if (len(part) >= 5 and ("@" in part or sum(map(str.isdigit, part)) >= 3)
                    and free(start, end)):
                out.append((start, end, OTHER))
    return out


def _facts(batches) -> Iterator[list]:
    for batch in cut_rows(batches):
        rows = []
        for doc_id, text, text_hash in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                           batch.column(2).to_pylist(), strict=True):
            base = base_spans(text)
            own = instances(text, base)
            counts = [sum(k == n for _, k, _ in base) for n in range(len(KINDS))]
            rows.append((doc_id, text_hash, *counts, joined(base), [s for s, _, _ in own],
                         [e for _, e, _ in own], [seed for _, _, seed in own],
                         [_hash(text[s:e].lower()) for s, e, _ in own],
                         [p for s, e, _ in own for p in _patterns(text, s, e)]))
        yield [list(c) for c in zip(*rows, strict=True)]


def extract(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts of every document, discovered spans: doc_id, text_hash, starts, ends).

    ``docs`` needs doc_id and text; other columns are ignored. A missing text is an empty one, a
    missing doc_id is kept, and repeated rows have the same spans. Texts of any length are read
    whole. An empty table gives no rows and no patterns.
    """
    facts = cut_lineage(map_arrow(docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"),
        _text_hash().alias("text_hash")), _facts, FACTS), "pii-facts")
    spots = facts.where(F.size("starts") > 0).select(
        "doc_id", "text_hash", "patterns", F.posexplode(F.arrays_zip(
            "starts", "ends", "seeds", "instances")).alias("at", "one")).select(
        "doc_id", "text_hash", F.col("one.starts").alias("start"), F.col("one.ends").alias("end"),
        F.col("one.seeds").alias("seed"), F.col("one.instances").alias("instance"),
        F.explode(F.slice("patterns", F.col("at") * _PER_INSTANCE + 1, _PER_INSTANCE)).alias(
            "pattern")).where("pattern != 0")
    edges = cut_lineage(spots.groupBy("pattern", "instance").agg(
        F.max((F.col("seed") != OTHER).cast("int")).alias("seed")), "pii-edges")
    good = _confident_patterns(edges)
    found = spots.where(F.col("seed") != SEED).join(good, "pattern").select(
        "doc_id", "text_hash", "start", "end").distinct().groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    return facts, cut_lineage(found.select(
        "doc_id", "text_hash", F.col("spans.start").alias("starts"),
        F.col("spans.end").alias("ends")), "pii-found")


def _confident_patterns(edges: DataFrame) -> DataFrame:
    """Patterns (pattern) that many seeds share and that are trusted after all rounds."""
    # A pattern of too few seeds can never be used, so it takes no part in the rounds.
    support = edges.groupBy("pattern").agg(F.sum("seed").alias("seeds")).where(
        F.col("seeds") >= LEAST_SEEDS).select("pattern")
    graph = cut_lineage(edges.join(support, "pattern"), "pii-graph")
    trust = graph.select("instance", F.col("seed").cast("double").alias("trust")).groupBy(
        "instance").agg(F.max("trust").alias("trust"))
    for _ in range(ROUNDS):
        patterns = cut_lineage(graph.join(trust, "instance").groupBy("pattern").agg(
            (F.sum("trust") / (F.count(F.lit(1)) + SMOOTHING)).alias("score")), "pii-patterns")
        doubt = F.sum(F.log1p(-F.col("score")))
        trust = cut_lineage(graph.join(patterns, "pattern").groupBy("instance").agg(
            F.greatest(F.max("seed").cast("double"), 1 - F.exp(doubt)).alias("trust")), "pii-trust")
    return patterns.where(F.col("score") >= CONFIDENT).select("pattern")


def find(docs: DataFrame) -> DataFrame:
    """Every document with its counts, its base spans and all spans, as texts of kind:start:end."""
    facts, found = extract(docs)
    same = [facts["doc_id"].eqNullSafe(found["doc_id"]), facts["text_hash"] == found["text_hash"]]
    extra = F.transform(F.arrays_zip(found["starts"], found["ends"]), lambda s: F.struct(
        s["starts"].alias("s"), F.lit(len(KINDS)).alias("k"), s["ends"].alias("e")))
    kinds = F.array(*[F.lit(k) for k in (*KINDS, FOUND)])
    base = F.transform(F.split("base", ","), lambda t: F.struct(
        F.get(F.split(t, ":"), F.lit(1)).cast("int").alias("s"),
        (F.array_position(kinds, F.get(F.split(t, ":"), F.lit(0))).cast("int") - 1).alias("k"),
        F.get(F.split(t, ":"), F.lit(2)).cast("int").alias("e")))
    base = F.when(F.col("base") != "", base).otherwise(F.array().cast(
        "array<struct<s:int,k:int,e:int>>"))
    text = F.array_join(F.transform(F.array_sort(F.concat(base, extra)), lambda x: F.concat_ws(
        ":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")
    return facts.join(found, same, "left").select(
        facts["doc_id"], "n_email", "n_ip", "n_card", "n_phone", "base",
        F.when(found["starts"].isNull(), F.col("base")).otherwise(text).alias("spans"))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with a kind's name in brackets for every span; overlapping spans become one."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += (text[at:start], f"[{(*KINDS, FOUND)[kind].upper()}]")
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """The documents with the same columns and their personal data masked; n_chars follows.

    A missing text stays missing and a missing doc_id is kept; every row stays, repeated ones alike.
    Columns may have any names; an empty table stays empty.
    """
    _, found = extract(docs)
    names = docs.columns
    longest = max(map(len, names)) * "_"     # longer than any column's name, so no column's name
    its_doc, its_text, its_starts, its_ends, own_hash = (
        longest + part for part in ("doc", "text", "starts", "ends", "hash"))
    extra = found.select(F.col("doc_id").alias(its_doc), F.col("text_hash").alias(its_text),
                         F.col("starts").alias(its_starts), F.col("ends").alias(its_ends))
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches):
            texts = [None if t is None else masked(t, base_spans(t) + [
                (s, len(KINDS), e) for s, e in zip(starts or (), ends or (), strict=True)])
                for t, starts, ends in zip(batch.column(at).to_pylist(),
                                           batch.column(its_starts).to_pylist(),
                                           batch.column(its_ends).to_pylist(), strict=True)]
            columns = batch.columns[:len(names)]
            columns[at] = pa.array(texts, columns[at].type)
            if "n_chars" in names:
                k = names.index("n_chars")
                columns[k] = pa.array([None if t is None else len(t) for t in texts],
                                      columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    keyed = docs.withColumn(own_hash, _text_hash())
    return keyed.join(extra, keyed["doc_id"].cast("bigint").eqNullSafe(extra[its_doc])
                      & (keyed[own_hash] == extra[its_text]), "left").select(
        *names, its_starts, its_ends).mapInArrow(run, docs.schema)


def _text_hash():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def op2_pii(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
