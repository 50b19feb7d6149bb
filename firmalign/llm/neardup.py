"""Near duplicates by a chosen-path similarity join over minwise tokens.

Documents with the same set of word shingles form one class, and the classes are joined. Each of
``TREES`` independent trees puts a class into a node by one minwise token. Two sets of similarity s
agree on a token with probability s. A class that shares nodes in fewer trees than a linked one
would leaves the join; the others, with a byte of each of ``CODES`` tokens, are dealt out by node.

A task walks down its nodes. A node of at most ``SMALL_NODE`` members is compared exhaustively, by
matrix products over one bit of each token and then by the bytes. A larger one branches: it draws a
token position of its own, and for three nodes in eight a second one, and its members follow the
tokens they have there. A pair of similarity 0.8 so stays together in 1.1 nodes for each one before
and is parted in all branches of a tree with probability 2/3 at most, in all trees with 6e-5; pairs
below 0.7 die out. Every candidate is confirmed on the full sets.

Candidates are sharpened by a longer sketch: the least shingle hash in each of ``FINE`` ranges, a byte
each, which for short texts is nearly the whole set.

Before that, members are compared with a few pivots of their node only and each follows the best
one and the one most agree with, in two rounds. Labels of the components found so far go along, a
node whose members all have one label needs no further look, and no pair within a component is
compared: a large group of near copies collapses in these rounds and never becomes a set of pairs.
Nodes of more than ``MOST_IN_TASK`` members branch before they are given to a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from firmalign.llm import textwords
from firmalign.llm.common import cut_lineage, cut_rows, map_arrow, table

SHINGLE, PERCENT = 4, 80
CODES, TREES, SMALL_NODE, MAX_DEPTH = 160, 24, 4096, 48
#: Of eight nodes so many draw a second position.
SECOND_IN_EIGHT = 3
#: Trees in which a class must share a node at all: of 24, a linked one misses 16 or more with a
#: probability below 1e-7.
LEAST_SHARED = 9
#: Share of equal bytes below which a pair isn't compared on its sets: at similarity 0.8 it is 4.7
#: standard deviations below the mean. The same for bits, which tell less, is 5.3 below.
LEAST_AGREEMENT, LEAST_BITS = 0.65, 0.55
#: Ranges of the longer sketch, and the share of equal bytes that a candidate needs there: again 4.7
#: standard deviations below 0.8.
FINE_BITS = 10
FINE, LEAST_FINE = 1 << FINE_BITS, 0.74
#: A pair met in so many earlier small nodes, by the bytes of its tokens, isn't handed on again. A byte
#: agrees by chance in one of 256, so three do where no token does once in 2e9.
MET_BEFORE = 3
#: Rounds with pivots only, and pivots of a node.
PIVOT_ROUNDS, PIVOTS = 3, 64
#: Members of a node, members handled together, and rows of a block of a comparison in a task.
MOST_IN_TASK, TOGETHER, ROWS = 1 << 16, 20_000, 1024
#: Candidates of a class compared in one task.
MOST_COMPARED = 10_000
#: Ids of classes that are broadcast at most, 24 bytes each.
MOST_BROADCAST = 500_000
_MULTIPLIERS = np.random.default_rng(11).integers(1, 1 << 63, CODES, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = np.random.default_rng(12).integers(0, 1 << 63, CODES, np.uint64)
CLASSES = ("doc_id bigint, n_shingles bigint, class bigint, tokens array<bigint>, codes binary, "
           "fine binary, text_hash bigint")


def shingle_sets(texts: pa.Array, length: int = SHINGLE) -> list[np.ndarray]:
    """The sorted hashes of the distinct shingles of each text."""
    words, bounds = textwords.word_hashes(texts, lower=True)
    hashes, at = textwords.run_hashes(words, bounds, length)
    cuts = np.searchsorted(at, bounds)
    out = []
    for k in range(len(bounds) - 1):
        low, high = bounds[k], bounds[k + 1]
        if high - low >= length:
            out.append(np.unique(hashes[cuts[k]:cuts[k + 1]]))
        else:                         # fewer words: the whole sequence, with its length
            whole = words[low:high]
            out.append(textwords.run_hashes(
                whole + np.uint64(len(whole)), np.array([0, len(whole)]), len(whole))[0]
                if len(whole) else whole)
    return out


def _class_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def _classes(length: int):
    def run(batches) -> Iterator[list]:
        for batch in cut_rows(batches, 2 << 20):
            sets = shingle_sets(batch.column(1), length)
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            tokens: list = [None] * len(sets)
            codes: list = [None] * len(sets)
            fine: list = [None] * len(sets)
            if len(full):
                flat = np.concatenate([sets[k] for k in full])
                for k, row in zip(full.tolist(), _fine(flat, sizes[full]), strict=True):
                    fine[k] = row.tobytes()
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                least = np.stack([np.minimum.reduceat((flat ^ o) * m, starts)
                                  for o, m in zip(_OFFSETS, _MULTIPLIERS, strict=True)], axis=1)
                own = textwords.mix(least).astype(np.uint8)
                for k, row, code in zip(full.tolist(), least[:, :TREES].view(np.int64), own, strict=True):
                    tokens[k], codes[k] = row, code.tobytes()
            yield [batch.column(0), sizes, [_class_id(s) if len(s) else None for s in sets], tokens,
                   codes, fine, batch.column(2)]
    return run


def _fine(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A byte of the least hash in each range for each set; 0 where a range is empty.

    ``flat`` holds the sets one after the other, each in ascending order.
    """
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = row * FINE + (flat >> np.uint64(64 - FINE_BITS)).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    out = np.zeros(len(sizes) * FINE, np.uint8)
    out[place[first]] = flat[first] % np.uint64(255) + np.uint64(1)
    return out.reshape(-1, FINE)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Linked are documents whose shingle sets have 100 * intersection >= percent * union; a component
    is named by its smallest doc_id. A missing or empty text has no shingles and is linked with
    nothing; a text of any length is read whole. Documents without a doc_id cannot name a component, and a set that only they have is
    linked with no other; component_id is then null and the rows are kept. Repeated rows each give
    a row. Other columns are ignored. An empty table gives no rows.
    """
    return _found(docs, shingle, percent).drop("text_hash")


def _found(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The near duplicates, with the hash of each row's text."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.col("text").cast("string").alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))
    rows = cut_lineage(map_arrow(source, _classes(shingle), CLASSES), "near-classes")
    # One document of each class stands for it, that of the smallest doc_id.
    classes = cut_lineage(rows.where("class IS NOT NULL").groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "text_hash")).alias("m"),
        F.max("n_shingles").alias("n"), F.first("tokens").alias("tokens"),
        F.first("codes").alias("codes"), F.first("fine").alias("fine")).select(
            "class", F.col("m.doc_id").alias("first"), F.col("m.text_hash").alias("text_hash"), "n",
            "tokens", "codes", "fine"), "near-unique")
    labels = _join(source, classes, shingle, percent)
    named = classes.select("class", "first").join(labels, "class", "left").withColumn(
        "label", F.coalesce("label", "class"))
    names = named.groupBy("label").agg(F.min("first").alias("component_id"))
    known = named.join(names, "label").select("class", "component_id")
    with_set = rows.where("class IS NOT NULL").select("doc_id", "n_shingles", "class", "text_hash").join(
        known, "class").drop("class")
    without = rows.where("class IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash")
    return with_set.unionByName(without).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, without all but one of each component.

    Of rows repeated with the same doc_id and text one stays. Texts without words and documents
    without a doc_id all stay. Columns may have any names; an empty table stays empty.
    """
    found = cut_lineage(_found(docs), "near-found")
    gone_id, gone_text = _unused(docs, "gone_id"), _unused(docs, "gone_text")
    # Of an id with several texts only the rows of the copied text go.
    gone = found.where(~F.col("kept") & F.col("component_id").isNotNull()
                       & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_text)).distinct()
    left = docs.join(gone, (F.col("doc_id").cast("bigint") == F.col(gone_id)) & (
        F.xxhash64(F.col("text").cast("string")) == F.col(gone_text)), "left_anti")
    repeated = found.where("kept AND doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    repeated = cut_lineage(repeated, "near-repeated")
    return left.join(repeated, "doc_id", "left_anti").unionByName(
        left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select(
        *docs.columns)


# ---------------------------------------------------------------- join
def _join(source: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(class, label) of all classes that have a confirmed link."""
    start = classes.select("class", F.posexplode("tokens").alias("tree", "token")).select(
        "class", "tree", F.xxhash64("tree", "token").alias("node"))
    shared = start.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = start.join(shared.select("node"), "node")
    met = members.groupBy("class").agg(F.count(F.lit(1)).alias("trees")).where(
        F.col("trees") >= LEAST_SHARED).select("class")
    met = cut_lineage(classes.drop("tokens").join(met, "class"),
                      "near-met")
    members = cut_lineage(members.join(met.select("class"), "class"), "near-nodes")

    labels = None
    for turn in range(PIVOT_ROUNDS):
        offers = _candidates(members, met, labels, percent, turn)
        best = offers.groupBy("class", "kind").agg(F.max_by("other", F.struct(
            "agree", "other")).alias("other"))
        links = _confirmed(_ordered(best, "class", "other"), met, source, shingle, percent)
        labels = _merged(labels, links)
    large = members.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where(
        F.col("size") > SMALL_NODE).select("node")
    branching = members.join(large, "node").groupBy("class").agg(
        F.bit_or(F.expr("shiftleft(1, tree)")).alias("branching"))
    met = cut_lineage(met.join(branching, "class", "left").withColumn(
        "branching", F.coalesce("branching", F.lit(0))), "near-met")
    pairs = _candidates(_in_bounds(members, met, labels), met, labels, percent, None)
    links = _confirmed(_ordered(pairs, "class", "other"), met, source, shingle, percent)
    return _merged(labels, links)


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("class"))
    return members.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))


def _mixed(known: DataFrame, least: int = 1) -> DataFrame:
    """Members of the nodes of more than ``least`` members that hold more than one component."""
    nodes = known.groupBy("node").agg(
        F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
    return known.join(nodes.where((F.col("size") > least) & (F.col("low") != F.col("high")))
                      .select("node"), "node")


def _in_bounds(members: DataFrame, met: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members, those of nodes too large for a task followed down to nodes that aren't."""
    done = None
    for _ in range(MAX_DEPTH):
        sizes = members.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
        large = cut_lineage(sizes.where(F.col("size") > MOST_IN_TASK).select("node"), "near-large")
        if large.isEmpty():
            break
        rest = members.join(large, "node", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        inside = _mixed(_labelled(members.join(large, "node"), labels)).drop("label")
        members = cut_lineage(_branch(inside, met), "near-nodes")
    return members if done is None else done.unionByName(members)


def _branch(members: DataFrame, met: DataFrame) -> DataFrame:
    """Each member follows its tokens at the one or two positions that its node draws."""
    draws = F.when(F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(8)) < SECOND_IN_EIGHT, 1).otherwise(0)
    place = (F.pmod(F.xxhash64("node", "pick"), F.lit(CODES - TREES)) + TREES + 1).cast("int")
    children = members.join(met.select("class", "codes"), "class").withColumn(
        "pick", F.explode(F.sequence(F.lit(0), draws))).withColumn("place", place).select(
        "class", F.lit(TREES).alias("tree"),
        F.xxhash64("node", "place", F.expr("substring(codes, place, 1)")).alias("node"))
    shared = children.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return children.join(shared.select("node"), "node")


def _candidates(members: DataFrame, met: DataFrame, labels: DataFrame | None, percent: int,
                turn: int | None) -> DataFrame:
    """(class, other, kind, agree) across components: in a turn with the pivots of a node, else all."""
    sketches = ["n", "codes"] + ["fine", "branching"] * (turn is None)
    known = _mixed(_labelled(members, labels)).join(met.select("class", *sketches), "class")
    dealt = known.select("node", "class", "label", *sketches, "tree").repartition(
        "node").sortWithinPartitions("node")
    found = map_arrow(dealt, _walk(percent, turn),
                      "class bigint, other bigint, kind int, agree int")
    return found if turn is not None else found.distinct()


def _walk(percent: int, turn: int | None):
    def run(batches) -> Iterator[list]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            kept.append(batch)
            if sum(b.num_rows for b in kept) >= TOGETHER:
                whole = pa.concat_batches(kept)
                nodes = whole.column(0).to_numpy()
                # The last node may go on in the next batch.
                end = int(np.searchsorted(nodes, nodes[-1]))
                if end:
                    yield _compared(whole.slice(0, end), percent, turn)
                kept = [whole.slice(end)]
        if kept:
            yield _compared(pa.concat_batches(kept), percent, turn)
    return run


def _compared(rows: pa.RecordBatch, percent: int, turn: int | None) -> list:
    nodes, ids, labels, n = (rows.column(k).to_numpy() for k in range(4))
    codes = np.frombuffer(b"".join(rows.column(4).to_pylist()), np.uint8).reshape(-1, CODES)
    bits = (codes & 1).astype(np.float32) * 2 - 1
    bounds = np.append(np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])), len(nodes))
    a, b, kinds = [], [], []
    for begin, end, node in zip(bounds[:-1].tolist(), bounds[1:].tolist(), nodes[bounds[:-1]].tolist()):
        node &= (1 << 64) - 1
        if turn is None:
            for inside in _leaves(np.arange(begin, end), node, labels, codes):
                for x, y in _close(inside, labels, bits):
                    a.append(x), b.append(y), kinds.append(np.zeros(len(x), np.int64))
        else:
            for kind, (x, y) in enumerate(_pivoted(np.arange(begin, end), node + turn, labels, bits)):
                a.append(x), b.append(y), kinds.append(np.full(len(x), kind))
    if not a:
        return [[], [], [], []]
    a, b, kinds = (np.concatenate(p) for p in (a, b, kinds))
    fit = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
    a, b, kinds = a[fit], b[fit], kinds[fit]
    if turn is None:
        fresh = _first_met(codes, rows.column("tree").to_numpy(), rows.column("branching").to_numpy(), a, b)
        a, b, kinds = a[fresh], b[fresh], kinds[fresh]
        # Each pair of classes once, in whichever nodes of this task it was met.
        x, y = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])
        first = np.unique(np.stack([x, y], 1), axis=0, return_index=True)[1] if len(a) else []
        a, b, kinds = a[first], b[first], kinds[first]
    agree = np.zeros(len(a), np.int64)
    for at in range(0, len(a), 1 << 15):
        cut = slice(at, at + (1 << 15))
        agree[cut] = np.count_nonzero(codes[a[cut]] == codes[b[cut]], axis=1)
    good = agree >= LEAST_AGREEMENT * CODES
    a, b, kinds, agree = a[good], b[good], kinds[good], agree[good]
    if turn is None:
        fine = np.frombuffer(b"".join(rows.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
        good = _finely_alike(fine, a, b)
        a, b, kinds, agree = a[good], b[good], kinds[good], agree[good]
        # Alike in every task that finds the pair.
        return [np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]), kinds.astype(np.int32),
                agree.astype(np.int32)]
    return [ids[a], ids[b], kinds.astype(np.int32), agree.astype(np.int32)]


def _first_met(codes: np.ndarray, tree: np.ndarray, branching: np.ndarray, a: np.ndarray,
               b: np.ndarray) -> np.ndarray:
    """Which pairs haven't met in ``MET_BEFORE`` earlier nodes, each compared exhaustively.

    Where tokens agree in an earlier tree the pair shares that node, too; if it was small it was
    compared there. Trees in which their nodes branch don't count. A pair of a node that branched
    before it came to this task, which has no tree, is always handed on.
    """
    good = np.zeros(len(a), bool)
    places = np.arange(TREES)
    for at in range(0, len(a), 1 << 16):
        x, y = a[at:at + (1 << 16)], b[at:at + (1 << 16)]
        branched = (branching[x] | branching[y])[:, None] >> places & 1
        own = tree[x][:, None]
        before = ((codes[x, :TREES] == codes[y, :TREES]) & (places < own) & (branched == 0)
                  & (own < TREES))
        good[at:at + (1 << 16)] = np.count_nonzero(before, 1) < MET_BEFORE
    return good


def _finely_alike(fine: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    good = np.zeros(len(a), bool)
    for at in range(0, len(a), 1 << 13):
        x, y = fine[a[at:at + (1 << 13)]], fine[b[at:at + (1 << 13)]]
        either = x | y
        same = np.count_nonzero((x == y) & (either > 0), axis=1)
        good[at:at + (1 << 13)] = same >= LEAST_FINE * np.count_nonzero(either, axis=1)
    return good


def _pivoted(inside: np.ndarray, seed: int, labels: np.ndarray, bits: np.ndarray):
    """(member, pivot) pairs: the pivot each member is closest to, and the one most are close to."""
    order = textwords.mix(inside.astype(np.uint64) + np.uint64(seed & (1 << 63) - 1))
    pivots = inside[np.argsort(order, kind="stable")[:PIVOTS]]
    alike = bits[inside] @ bits[pivots].T
    alike[labels[inside][:, None] == labels[pivots]] = -CODES
    near = alike >= LEAST_BITS * CODES
    closest, hub = alike.argmax(1), np.full(len(inside), np.where(near, alike, 0).sum(0).argmax())
    rows = np.arange(len(inside))
    for choice in (closest, hub):
        good = near[rows, choice]
        yield inside[good], pivots[choice[good]]


def _leaves(inside: np.ndarray, node: int, labels: np.ndarray, codes: np.ndarray) -> Iterator[np.ndarray]:
    """The nodes below a node that are small enough to be compared exhaustively."""
    stack = [(inside, node, 0)]
    while stack:
        inside, node, depth = stack.pop()
        if (labels[inside] == labels[inside[0]]).all():
            continue
        if len(inside) <= SMALL_NODE or depth == MAX_DEPTH:
            yield inside
            continue
        draw = _mixed_bits(node)
        for pick in range(1 + (draw >> 40) % 8 // (8 - SECOND_IN_EIGHT)):
            place = TREES + _mixed_bits(draw + pick + 1) % (CODES - TREES)
            column = codes[inside, place]
            order = np.argsort(column, kind="stable")
            cuts = np.flatnonzero(np.diff(column[order])) + 1
            for part in np.split(inside[order], cuts):
                if len(part) > 1:
                    stack.append((part, _mixed_bits(draw ^ (place << 8 | int(codes[part[0], place]))),
                                  depth + 1))


def _mixed_bits(x: int) -> int:
    return int(textwords.mix(np.array([x & (1 << 64) - 1], np.uint64))[0])


def _close(inside: np.ndarray, labels: np.ndarray, bits: np.ndarray) -> Iterator[tuple]:
    """Pairs across components that agree in enough bits, each once."""
    own, counts = np.unique(labels[inside], return_counts=True)
    # Members of the largest component needn't be compared with each other.
    rest = labels[inside] != own[counts.argmax()]
    ordered = np.append(inside[rest], inside[~rest])
    n_rest, columns = np.count_nonzero(rest), bits[ordered].T
    for at in range(0, n_rest, ROWS):
        rows = ordered[at:min(at + ROWS, n_rest)]
        r, c = np.nonzero(bits[rows] @ columns >= LEAST_BITS * CODES)
        good = (c > r + at) & (labels[rows[r]] != labels[ordered[c]])
        yield rows[r[good]], ordered[c[good]]


def _ordered(pairs: DataFrame, one: str, other: str) -> DataFrame:
    return pairs.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b"))


def _confirmed(pairs: DataFrame, met: DataFrame, source: DataFrame, shingle: int,
               percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar.

    The texts asked for are read once and sent to their pairs. The candidates of one class meet its
    text in one task, or in as many as they need.
    """
    pairs = cut_lineage(pairs.distinct(), "near-likely")
    wanted = pairs.select(F.col("a").alias("class")).unionByName(
        pairs.select(F.col("b").alias("class"))).distinct().join(
            met.select("class", "first", "text_hash"), "class")
    wanted = wanted.select("class", F.col("first").alias("doc_id"), "text_hash")
    if 2 * pairs.count() <= MOST_BROADCAST:
        wanted = F.broadcast(wanted)
    # Repeated rows of one doc_id and text are one.
    texts = cut_lineage(source.join(wanted, ["doc_id", "text_hash"]).groupBy("class").agg(
        F.min("text").alias("text")), "near-texts")
    tasks = F.ceil(F.col("n") / MOST_COMPARED).cast("int")
    split = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select("a", tasks.alias("tasks"))
    first = split.join(texts, F.col("a") == F.col("class")).select(
        "a", F.lit(None).cast("bigint").alias("b"), "text",
        F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"))
    second = pairs.join(split, "a").join(texts, F.col("b") == F.col("class")).select(
        "a", "b", "text", F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int").alias("task"))
    dealt = first.unionByName(second).repartition("a", "task").sortWithinPartitions(
        "a", "task", F.asc_nulls_first("b"))
    return cut_lineage(map_arrow(dealt.select("a", "b", "text"), _comparing(shingle, percent),
                                 "a bigint, b bigint"), "near-links")


def _comparing(shingle: int, percent: int):
    def run(batches) -> Iterator[list]:
        own = None
        for batch in cut_rows(batches, 2 << 20):
            found = []
            for a, b, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               shingle_sets(batch.column(2), shingle), strict=True):
                if b is None:
                    own = x
                    continue
                both = len(np.intersect1d(own, x, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(x) - both):
                    found.append((a, b))
            yield [list(c) for c in zip(*found, strict=True)] if found else [[], []]
    return run


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links: components of the graph of the labels so far."""
    if labels is None:
        return _components(links)
    for side in ("a", "b"):
        links = links.join(labels.select(F.col("class").alias(side), F.col("label").alias(
            f"label_{side}")), side, "left").withColumn(
                f"label_{side}", F.coalesce(f"label_{side}", side))
    bridges = cut_lineage(links.where("label_a != label_b").select("a", "b", "label_a", "label_b"),
                          "near-bridges")
    if bridges.isEmpty():
        return labels
    above = _components(_ordered(bridges, "label_a", "label_b").distinct()).select(
        F.col("class").alias("label"), F.col("label").alias("above"))
    alone = [bridges.select(F.col(c).alias("class"), F.col(f"label_{c}").alias("label"))
             for c in ("a", "b")]
    every = labels.unionByName(alone[0]).unionByName(alone[1]).distinct()
    return cut_lineage(every.join(above, "label", "left").select(
        "class", F.coalesce("above", "label").alias("label")), "near-labels")


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("class"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("class"), F.col("a").alias("other")))


def _components(links: DataFrame) -> DataFrame:
    """(class, label) of all linked classes: the smallest class that can be reached.

    Every round takes the smallest label among the neighbours and then the label of that label, so
    chains shorten by half.
    """
    edges = _both(links)
    labels = cut_lineage(edges.groupBy("class").agg(
        F.least(F.col("class"), F.min("other")).alias("label")), "near-labels")
    while True:
        near = edges.join(labels.withColumnRenamed("class", "other"), "other").groupBy("class").agg(
            F.min("label").alias("near"))
        best = labels.join(near, "class").select(
            "class", F.col("label").alias("old"), F.least("label", "near").alias("step"))
        far = labels.select(F.col("class").alias("step"), F.col("label").alias("far"))
        new = cut_lineage(best.join(far, "step", "left").select(
            "class", "old", F.least("step", F.coalesce("far", "step")).alias("label")),
            "near-labels")
        changed = new.where("old != label").isEmpty()
        labels = new.select("class", "label")
        if changed:
            return labels


def op7_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")
