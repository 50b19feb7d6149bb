"""Operators that work on names or on the sub-payer ids a firm stores itself."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, Window, functions as F

from ..functions import vocabulary as v
from ..functions.expressions import name_length_compare, quoted, space_count, whitespace_issue
from ..sources.versions import cut_lineage
from .skew import MIN_HOT_ROWS, grid_join, lookup

_WORD = r"([\p{L}\p{N}]+)"

# Fixed values of the similarity join; none of them decides which pairs are found.
_CELLS, _HASH_BITS = 4096, 48       # cells of gram counts; bits of a gram's hash below its rank
_RANKED_NAMES = 32_768              # names of a side that grams are counted in
_SAMPLED_NAMES, _SAMPLED_KEYS = 4096, 4_000_000     # names of a side that pairs are estimated from
_SIDES = ("left", "right")
_KEY_LENGTHS = (1, 2, 3, 4, 6, 8, 12, 16)
_MOST_KEYS = 50_000                 # keys of one name
_FEW_PAIRS = 1_000_000_000           # pairs of names up to which no length is looked for
_KEY_COST = 4                       # a key costs as much as so many pairs that meet


def whitespace_issues(firm: DataFrame) -> DataFrame:
    return firm.where(whitespace_issue()).select(
        "firm_id", "payer_id", quoted("name").alias("name_with_quotes"),
        space_count().alias("space_count"))


def whitespace_count(firm: DataFrame) -> DataFrame:
    return firm.agg(F.count_if(whitespace_issue()).alias("names_with_whitespace_issues"))


def trim_names(firm: DataFrame) -> DataFrame:
    return firm.withColumn("name", F.trim("name"))


# ---------------------------------------------------------------- lookups for review
def correct_id_by_name(firm: DataFrame, oa: DataFrame) -> DataFrame:
    """Firms matched by name only, with the payer id of the lowest master row of that name."""
    ids = oa.where("name IS NOT NULL").groupBy(F.lower("name").alias("lname")).agg(
        F.min_by("payer_id", "firm_id").alias("correct_payer_id_in_oa"))
    rows = firm.where(F.col("match_status") == v.NAME_ONLY).withColumn("lname", F.lower("name"))
    return lookup(rows, ids, "lname", "firm_id").drop("lname")


def name_only_review(firm: DataFrame, oa: DataFrame) -> DataFrame:
    return correct_id_by_name(firm, oa).select(
        "firm_id", F.col("name").alias("payer_name"),
        F.col("payer_id").alias("current_payer_id_in_firm"), "correct_name_from_oa",
        "correct_payer_id_in_oa", "match_details")


def payer_id_only_review(firm: DataFrame) -> DataFrame:
    """Firms matched by id only, telling which of the two names is longer."""
    return firm.where(F.col("match_status") == v.PAYER_ID_ONLY).select(
        "firm_id", "payer_id", F.col("name").alias("current_name_in_firm"),
        F.col("correct_name_from_oa").alias("correct_name_in_oa"), "match_details",
        name_length_compare("name", "correct_name_from_oa").alias("comparison"))


def _stored_ids(firm: DataFrame) -> DataFrame:
    rows = [F.struct(F.lit(kind).alias("kind"), F.col(c).alias("key"))
            for kind, c in zip(v.KINDS, v.ID_COLS)]
    return firm.select("firm_id", "payer_id", "name", *v.ID_COLS, F.inline(F.array(*rows)))


def sub_payer_probe(firm: DataFrame, oa: DataFrame) -> DataFrame:
    """Unmatched firms with the number of master rows carrying each of their stored ids."""
    rows = _stored_ids(firm.where(F.col("match_status") == v.NO_MATCH))
    per_id = (oa.where("payer_id IS NOT NULL").groupBy(F.col("payer_id").alias("key"))
              .agg(F.count(F.lit(1)).alias("n")))
    joined = lookup(rows, per_id, "key", "firm_id")
    counts = [F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
              .alias(f"{kind}_id_in_oa") for kind in v.KINDS]
    return joined.groupBy("firm_id", "payer_id", "name", *v.ID_COLS).agg(*counts)


def sub_payer_match(firm: DataFrame, oa: DataFrame) -> DataFrame:
    """Unmatched firms one of whose stored ids the master knows, with the lowest such id."""
    rows = _stored_ids(firm.where(F.col("match_status") == v.NO_MATCH))
    known = oa.where("payer_id IS NOT NULL").select(F.col("payer_id").alias("key")).distinct()
    return (lookup(rows, known, "key", "firm_id", how="left_semi")
            .groupBy("firm_id").agg(F.min("key").alias("matched_payer_id")))


# ---------------------------------------------------------------- trigram similarity
def trigrams(name):
    """Distinct 3-grams of a lower-cased name, each word padded by two blanks and one blank."""
    words = F.regexp_extract_all(name, F.lit(_WORD), 1)
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda p: F.transform(
        F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def _distinct_names(df: DataFrame, side: str) -> DataFrame:
    """Distinct names with their lowest row id: copies of a name are compared once."""
    return (df.where("name IS NOT NULL").groupBy(F.lower("name").alias("name"))
            .agg(F.min("firm_id").alias(f"{side}_min")))


class RankedGrams(NamedTuple):
    """Names of either side with their grams as numbers, the rarest first.

    ``rows`` holds name, the columns of both sides, ``left`` and ``right`` for the sides it is on, the
    numbers ``g``, how many they are (``n``) and a sketch of them, 64 bits that are each the parity of
    the numbers that fall on it (``bits``); ``sizes`` tells how many names a side has of each n.
    """
    rows: DataFrame
    sizes: dict[str, dict[int, int]]

    def of_size(self, least: int) -> RankedGrams:
        """Only the names with that many grams or more."""
        return RankedGrams(self.rows.where(F.col("n") >= least), {
            side: {n: c for n, c in sizes.items() if n >= least} for side, sizes in self.sizes.items()})


def _sampled(side: str, every: int):
    """True for one name of a side in so many, drawn by hash and independently of the other side."""
    return F.col(side) & (F.pmod(F.xxhash64("name", F.lit(side)), F.lit(every)) == 0)


def _gram_numbers(grams, common: list[int]):
    """The grams as numbers that sort by how common they are: a rank, then bits of their hash."""
    ranks = F.expr(f"cast(split('{','.join(map(str, common))}', ',') AS array<bigint>)")
    hashes = F.transform(grams, lambda gram: F.xxhash64(gram))
    return F.sort_array(F.transform(hashes, lambda h: F.shiftleft(
        F.get(ranks, h.bitwiseAND(F.lit(_CELLS - 1)).cast("int")), _HASH_BITS).bitwiseOR(
        h.bitwiseAND(F.lit((1 << _HASH_BITS) - 1)))))


def ranked_grams(left: DataFrame, right: DataFrame) -> RankedGrams:
    """The grams of every name, the rarest first. Ranked once and written, for any threshold.

    Any order that is the same for all names will do. It follows how often the hashes of grams fall
    into each of a fixed number of cells in some of the names, so it needs no join and no table of
    grams, and grams met nowhere among them count as rare.
    """
    seen = Observation("names")
    both = left.withColumn("left", F.lit(True)).join(
        right.withColumn("right", F.lit(True)), "name", "full").fillna(False, ["left", "right"])
    names = cut_lineage(both.observe(seen, F.count(F.lit(1)).alias("n")), "names")
    every = max(1, seen.get["n"] // _RANKED_NAMES)
    cell = F.xxhash64("gram").bitwiseAND(F.lit(_CELLS - 1))
    often = (names.where(_sampled("left", every) | _sampled("right", every))
             .select(F.explode(trigrams(F.col("name"))).alias("gram"))
             .groupBy(cell.alias("cell")).count().collect())    # one row per cell at most
    ranks = [0] * _CELLS
    for rank, row in enumerate(sorted(often, key=lambda r: (r["count"], r["cell"])), 1):
        ranks[row["cell"]] = rank
    rows = cut_lineage(
        names.where(F.col("name").rlike(_WORD))
        .withColumn("g", _gram_numbers(trigrams(F.col("name")), ranks))
        .withColumns({"n": F.size("g"), "bits": F.expr(
            "aggregate(g, 0L, (a, x) -> a ^ shiftleft(1L, int(x & 63)))")}), "name-grams")
    counts = rows.groupBy("n").agg(*[F.count_if(side).alias(side) for side in _SIDES]).collect()
    return RankedGrams(rows, {side: {r["n"]: r[side] for r in counts if r[side]} for side in _SIDES})


def _shared(n: int, threshold: float) -> int:
    """How many members a set of n shares at least with any set more similar than threshold."""
    return math.floor(threshold * n - 1e-9) + 1


def _keys(threshold: float, lacking: int | None, length: int):
    """The keys of a name: of ``length`` of its first members each, or of all that are certain.

    A set of n shares s members or more with another, so lacks n - s of its own there at most. The
    first ``length`` common members then lie within the first ``n - s + length`` of both sets. A key
    is the exclusive or of so many of these. The other set may be one that shares fewer than
    ``length`` members, which takes shorter keys.
    """
    def certain(n):
        s = f"int(floor({threshold!r}D * ({n}) - 1e-9D) + 1)"
        return s if lacking is None else f"greatest({s}, ({n}) - {lacking})"

    s, least = certain("n"), f"least({length}, {certain(certain('n'))})"
    part = f"slice(g, 1, n - {s} + j)"
    whole = f"aggregate({part}, 0L, (a, x) -> a ^ x)"
    # One member more with each step: (its place, the exclusive or so far), leaving out n - s at most.
    steps = (f"aggregate(sequence(1, j), array(struct(0 AS i, 0L AS x)), (a, step) -> flatten("
             f"transform(a, e -> transform(slice(g, e.i + 1, n - {s} - e.i + step), "
             f"(y, d) -> struct(e.i + d + 1 AS i, e.x ^ y AS x)))), a -> a.x)")
    one = (f"CASE n - {s} WHEN 0 THEN array({whole}) "
           f"WHEN 1 THEN transform(array({whole}), w -> transform({part}, x -> w ^ x))[0] "
           f"ELSE {steps} END")
    return F.expr(f"flatten(transform(sequence({least}, least({length}, {s})), j -> {one}))")


def _key_length(ranked: RankedGrams, threshold: float, lacking: int | None) -> tuple[int, dict]:
    """The length of keys at which keys and pairs cost least together; also the hot keys of it.

    Short keys are few but join many pairs, long ones the other way round. Keys are counted from the
    sizes of the sets, pairs estimated from some names. That decides what the join costs and where its
    rows go, never which pairs it finds.
    """
    sizes = ranked.sizes
    counts = {side: sum(sizes[side].values()) for side in _SIDES}
    if not all(counts.values()):
        return 1, {}

    def certain(n):
        return _shared(n, threshold) if lacking is None else max(_shared(n, threshold), n - lacking)

    def number(n, length):
        s = certain(n)
        return sum(math.comb(n - s + j, j) for j in range(min(length, certain(s)), min(length, s) + 1))

    largest = max(n for side in sizes.values() for n in side)
    lengths = [x for x in _KEY_LENGTHS if x == 1 or number(largest, x) <= _MOST_KEYS]
    if counts["left"] * counts["right"] <= _FEW_PAIRS:
        return lengths[:2][-1], {}
    keys = {x: sum(n * number(size, x) for side in sizes.values() for size, n in side.items())
            for x in lengths}
    lengths = [x for x in lengths if keys[x] <= 4 * _KEY_COST * keys[lengths[0]]]
    # As many names as a bounded number of keys allows.
    share = _SAMPLED_KEYS * sum(counts.values()) / sum(keys[x] for x in lengths)
    size = int(max(256, min(_SAMPLED_NAMES, share / 2)))
    every = {side: max(1, n // size) for side, n in counts.items()}
    some = ranked.rows.withColumns({side: _sampled(side, every[side]) for side in _SIDES}).where(
        "left OR right").select(*_SIDES, F.explode(F.array(*[
            F.struct(F.lit(x).alias("length"), _keys(threshold, lacking, x).alias("keys"))
            for x in lengths])).alias("k"))
    met = some.select(*_SIDES, "k.length", F.explode("k.keys").alias("key")).groupBy(
        "length", "key").agg(*[F.count_if(side).alias(side) for side in _SIDES])
    rows = sum(F.col(side) * every[side] for side in _SIDES)
    found = met.groupBy("length").agg(F.sum(F.col("left") * F.col("right")).alias("pairs"),
                                      F.max(rows).alias("most")).collect()    # one row per length
    cost = {r["length"]: r["pairs"] * every["left"] * every["right"] + _KEY_COST * keys[r["length"]]
            for r in found}
    most = {r["length"]: r["most"] for r in found}
    length = min(cost, key=lambda x: (cost[x], x))
    parts = int(ranked.rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fair = max(keys[length] / parts, int(ranked.rows.sparkSession.conf.get(MIN_HOT_ROWS, "100000")))
    if most[length] <= fair:
        return length, {}
    hot = met.where((F.col("length") == length) & (rows > fair)).select(
        "key", rows.alias("n")).collect()     # fewer keys than partitions lie above a fair share
    return length, {r["key"]: -(-r["n"] * parts // keys[length]) for r in hot}


def similar_names(left: DataFrame, right: DataFrame, threshold: float,
                  ranked: RankedGrams | None = None, equal: bool = True,
                  first: int | None = None) -> DataFrame:
    """All pairs of distinct names with similarity above ``threshold``, each once.

    Set-similarity join with prefix filtering. Two sets that agree above t share more than t times
    the size of either, so a few of the rarest members of both have several members in common. Names
    are joined on combinations of those, as long as it takes to keep chance meetings few (see
    ``_keys``). Sizes and sketches rule most pairs out before their grams are compared.
    Other columns of both sides are carried along; ``equal=False`` leaves out equal names. With
    ``first`` only pairs are found neither name of which lacks more than that many grams of the
    other, at little cost.
    """
    ranked = ranked_grams(left, right) if ranked is None else ranked
    length, hot = _key_length(ranked, threshold, first)
    rows = ranked.rows.withColumn("key", F.explode(_keys(threshold, first, length)))

    def side(df, tag, on):
        carried = [c for c in df.columns if c != "name"]
        return rows.where(on).select(
            "key", *carried, *[F.col(c).alias(f"{tag}_{c}") for c in ("name", "n", "bits")])

    pairs = grid_join(side(left, "firm", "left"), side(right, "oa", "right"), "key",
                      "firm_name", "oa_name", hot)
    if not equal:
        pairs = pairs.where("firm_name <> oa_name")
    # At most so many members belong to one set only.
    apart = (f"firm_n + oa_n - 2 * (floor({threshold / (1 + threshold)!r}D * (firm_n + oa_n) - 1e-9D) + 1)")
    if first is not None:
        apart = f"least({apart}, {2 * first} - abs(firm_n - oa_n))"
    # Sketches differ in no more bits than their sets have members that are not common to both.
    pairs = pairs.where(f"bit_count(firm_bits ^ oa_bits) <= {apart}")
    out = [c for df in (left, right) for c in df.columns if c != "name"]
    # Grams that a generator makes stay above it: filters on them aren't moved down into the join.
    scored = pairs.select("firm_name", "oa_name", *out).distinct().select("*", F.inline(F.array(F.struct(
        trigrams(F.col("firm_name")).alias("firm_g"), trigrams(F.col("oa_name")).alias("oa_g"))))).selectExpr(
        "firm_name", "oa_name", *out, "size(firm_g) AS firm_size", "size(oa_g) AS oa_size",
        "CAST(size(array_intersect(firm_g, oa_g)) AS DOUBLE) AS shared")
    if first is not None:
        scored = scored.where(f"greatest(firm_size, oa_size) - shared <= {first}")
    return (scored.selectExpr("firm_name", "oa_name", *out,
                              "shared / (firm_size + oa_size - shared) AS name_similarity")
            .where(F.col("name_similarity") > threshold))


def fuzzy_name_matches(firm: DataFrame, oa: DataFrame, lo: float = 0.6, hi: float = 1.0,
                       k: int = 20, first: int = 3) -> DataFrame:
    """The k most similar (firm, master row) pairs with similarity strictly between lo and hi.

    Pairs that lack one gram of each other at most are found first, then those that lack up to
    ``first``, then all others. The similarity of the worst of k pairs found is a bound that the true
    top k can't fall below, so a later join takes it for its threshold and leaves out the sizes for
    which an earlier one has found all such pairs; with none left it isn't made. The broad, costly
    threshold is reached only if there is nothing closer. Ties go to the lowest firm, then to the
    lowest master row.
    """
    left, right = _distinct_names(firm, "firm"), _distinct_names(oa, "oa")
    order = [F.desc("name_similarity"), "firm_min", "oa_min"]
    ranked = ranked_grams(left, right)
    bound, done, found = lo, -1, None
    largest = max((n for side in ranked.sizes.values() for n in side), default=0)
    for lacking in (1, first, None):
        # Up to ``done`` grams lacking, every pair above the bound is found.
        open_size = next((n for n in range(1, largest + 1) if n - _shared(n, bound) > done),
                         None if found is not None else 1)
        if open_size is None:
            break
        pairs = similar_names(left, right, bound, ranked.of_size(_shared(open_size, bound)),
                              equal=hi > 1.0, first=lacking)
        if found:
            pairs = pairs.unionByName(firm.sparkSession.createDataFrame(found, pairs.schema)).distinct()
        best = pairs.where(F.col("name_similarity") < hi).orderBy(*order).limit(k)
        # One row per name pair is enough: rows of later pairs sort after k earlier ones.
        found, schema = best.collect(), best.schema   # k rows at most
        done = lacking
        if len(found) == k:
            bound = max(lo, found[-1]["name_similarity"] - 1e-9)   # pairs as similar count, too
    best = firm.sparkSession.createDataFrame(found, schema)

    def lowest(df, names, tag):
        """The k lowest rows of each wanted name; ranked before the shuffle, so bounded."""
        wanted = best.select(F.col(names).alias("lname")).distinct()
        rows = df.select(F.lower("name").alias("lname"), F.col("firm_id").alias(f"{tag}_id"),
                         F.col("name").alias(f"{tag}_name_as_is"),
                         F.col("payer_id").alias(f"{tag}_payer_id"))
        rank = F.row_number().over(Window.partitionBy("lname").orderBy(f"{tag}_id"))
        return (rows.join(F.broadcast(wanted), "lname", "left_semi")    # k names at most
                .withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")
                .withColumnRenamed("lname", names))

    return (best.select("firm_name", "oa_name", "name_similarity")
            .join(lowest(firm, "firm_name", "firm"), "firm_name")
            .join(lowest(oa, "oa_name", "oa"), "oa_name")
            .orderBy(F.desc("name_similarity"), "firm_id", "oa_id").limit(k)
            .select("firm_id", "oa_id", F.col("firm_name_as_is").alias("insurance_firm_name"),
                    F.col("oa_name_as_is").alias("payers_oa_name"),
                    F.col("firm_payer_id").alias("insurance_firm_payer_id"),
                    F.col("oa_payer_id").alias("payers_oa_payer_id"), "name_similarity"))
