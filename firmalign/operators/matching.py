"""Match a dirty firm table to the clean master on any of several ids or on the name.

The reference condition is an OR over nullable columns. Here every alternative becomes a typed
key, so all joins are equi-joins:

* ``i:<id>``        the firm's payer id equals one of the master ids
* ``x:<id>+<name>`` ... and the names agree too (two missing names agree)
* ``n:<name>``      the lower-cased names are equal

``match_profile`` joins each firm with *per-key aggregates* of the master. It yields how many
master rows match in each way and the best one, without forming a single pair, so a key shared
by many firms and many master rows costs their sum, not their product. Only ``match_pairs``,
whose result is the pairs, forms them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import vocabulary as v
from ..functions.expressions import (
    canonical_payer_id, percent, rank_order, same_name)
from ..sources.versions import cut_lineage
from .skew import every_salt, grid_join, hot_keys, lookup, one_salt, salts_of, store_counted


def id_columns(key_mode: str) -> tuple[str, ...]:
    if key_mode == "multi":
        return v.ID_COLS
    if key_mode == "single":
        return ("payer_id",)
    raise ValueError(f"key_mode must be 'multi' or 'single', not {key_mode!r}")


def vias(key_mode: str) -> tuple[str, ...]:
    return v.KINDS if key_mode == "multi" else ("id",)


# ---------------------------------------------------------------- keys
def _id_key(c: str) -> str:
    return f"concat('i:', {c})"


def _both_key(c: str) -> str:
    return f"concat('x:', length({c}), ':', {c}, coalesce(lower(name), ''))"


def _name_key(c: str) -> str:
    return f"concat('n:', lower({c}))"


def _key_rows(rows: list[tuple[str, str, str | None]]) -> Column:
    """Explode (kind, key, via) triples into rows."""
    structs = ", ".join(
        f"struct('{kind}' AS kind, {key} AS key, "
        f"CAST({'NULL' if via is None else repr(via)} AS STRING) AS via)"
        for kind, key, via in rows)
    return F.expr(f"inline(array({structs}))")


def firm_keys(firm: DataFrame, kinds: str = "xin", alt_name: str | None = None) -> DataFrame:
    """One row per firm and kind of key.

    A firm without a value for some kind gets a key of its own there, which no master row has:
    it stays in an outer join without meeting all other such firms in one task. ``alt_name``
    names a column holding a second name, keyed as kind ``w``.
    """
    keys = {"x": _both_key("payer_id"), "i": _id_key("payer_id"), "n": _name_key("name")}
    rows = [(k, keys[k], None) for k in kinds]
    if alt_name:
        rows.append(("w", _name_key(alt_name), None))
    alone = "concat('-:', firm_id)"
    return firm.select("firm_id", "payer_id", "name", _key_rows(
        [(kind, f"coalesce({key}, {alone})", via) for kind, key, via in rows]))


def master_keys(oa: DataFrame, key_mode: str = "multi", kinds: str = "xin",
                keep: tuple = (), every_row: bool = False) -> DataFrame:
    """One row per master row and key. An id listed twice counts for its first column only.

    ``every_row`` gives rows without a name a key no firm has, so that each row has some key.
    """
    ids = id_columns(key_mode)
    rows = []
    for i, (c, via) in enumerate(zip(ids, vias(key_mode))):
        first = c
        for earlier in ids[:i]:
            first = f"IF({earlier} <=> {c}, NULL, {first})"
        if "i" in kinds:
            rows.append(("i", _id_key(first), via))
        if "x" in kinds:
            rows.append(("x", _both_key(first), via))
    if "n" in kinds:
        key = _name_key("name")
        rows.append(("n", f"coalesce({key}, concat('=:', firm_id))" if every_row else key, "name"))
    return (oa.select(F.col("firm_id").alias("oa_id"), *keep, _key_rows(rows))
            .where("key IS NOT NULL"))


_SORTS = ("void", "full", "empty")


def _marked_master(oa: DataFrame, key_mode: str) -> DataFrame:
    ids = id_columns(key_mode)
    return oa.selectExpr(
        "firm_id", "name", *ids, "name IS NOT NULL AS named",
        " AND ".join(f"{c} IS NULL" for c in ids) + " AS void",
        " AND ".join(f"{c} IS NOT NULL" for c in ids) + " AS full",
        f"coalesce({ids[0]} = '', false) AS empty")


def _index_aggs(key_mode: str) -> list[Column]:
    """What a key tells of its master rows; rows of firms, which have none of these, don't count."""
    groups = {via: f"via = '{via}'" for via in vias(key_mode) + ("name",)}
    groups.update({sort: sort for sort in _SORTS})
    aggs = ["count_if(named) AS n_named", "count_if(named AND full) AS n_named_full"]
    for name, hit in groups.items():
        aggs += [f"count_if({hit}) AS n_{name}", f"min(IF({hit}, oa_id, NULL)) AS best_{name}"]
    return [*map(F.expr, aggs)]


def master_index(oa: DataFrame, key_mode: str = "multi") -> DataFrame:
    """Per key: how many master rows carry it, of which sorts, and the lowest id of each."""
    keys = master_keys(_marked_master(oa, key_mode), key_mode, keep=("named",) + _SORTS)
    return keys.groupBy("key").agg(*_index_aggs(key_mode))


# ---------------------------------------------------------------- profile
def firm_hot_keys(firm: DataFrame, alt_name: str | None = None) -> dict:
    return hot_keys(firm_keys(firm, alt_name=alt_name), "key")


def match_profile(firm: DataFrame, oa: DataFrame, key_mode: str = "multi",
                  alt_name: str | None = None, hot: dict | None = None) -> DataFrame:
    """One row per firm: counts and best master rows by kind of match. No pairs are formed.

    ``x_<via>`` / ``i_<via>``: master rows whose id (and name) equals the firm's, by first
    matching id column; ``name``: master rows with the same name; ``both``: those of them whose
    id matches as well; ``void`` / ``full`` / ``empty``: same-name rows with no, every or an
    empty id. ``best_*`` hold the lowest master ``firm_id`` of a group.
    """
    keys = firm_keys(firm, alt_name=alt_name)
    joined = lookup(keys, master_index(oa, key_mode), "key", "firm_id", hot=hot, keyless=False)
    return joined.groupBy("firm_id", "payer_id", "name").agg(*_profile_aggs(key_mode)).selectExpr(
        "*", *_profile_totals(key_mode))


def _profile_aggs(key_mode: str) -> list[Column]:
    def at(kind, col, name):
        return f"max(IF(kind = '{kind}', {col}, NULL)) AS {name}"

    def number(kind, col, name):
        return f"coalesce(max(IF(kind = '{kind}', {col}, NULL)), 0) AS {name}"

    aggs = []
    for via in vias(key_mode):
        for kind in "xi":
            aggs += [number(kind, f"n_{via}", f"{kind}_{via}"),
                     at(kind, f"best_{via}", f"best_{kind}_{via}")]
    aggs += [number("n", "n_name", "same_name"), at("n", "best_name", "best_name"),
             at("w", "best_name", "best_alt"), at("w", "key", "alt_key")]
    for sort in _SORTS:
        aggs += [number("n", f"n_{sort}", sort), at("n", f"best_{sort}", f"best_{sort}")]
    aggs += [number("x", "n_named", "named"), number("x", "n_named_full", "named_full")]
    return [*map(F.expr, aggs)]


def _profile_totals(key_mode: str) -> list[str]:
    by_id = " + ".join(f"i_{via}" for via in vias(key_mode))
    return ["IF(name IS NULL, 0, named) AS both", "IF(name IS NULL, 0, named_full) AS both_full",
            f"{by_id} AS id_hits", f"{by_id} + same_name > 0 AS matched"]


@dataclass
class TwoSided:
    """Both tables matched in one go and written: see ``two_sided``."""
    profile: DataFrame      # one row per firm, as match_profile gives it
    new: DataFrame          # firm_id of the master rows no firm matches
    hot: dict               # hot keys of the firms, and their salts


def two_sided(firm: DataFrame, oa: DataFrame, key_mode: str = "multi",
              alt_name: str | None = None) -> TwoSided:
    """Match firms and master rows by one keyed join that serves both sides.

    The key rows of both tables are reduced to one row per key, with what ``match_profile`` needs
    of the master rows and the number of firms. Written, it also holds the exact number of rows of
    each key, so hot keys are known without a pass of their own. Both sides' rows then look their
    keys up together; a master row is new if none of its keys has a firm. Both tables are read
    twice, whatever is derived from the result later.
    """
    firm_rows = firm_keys(firm, alt_name=alt_name).select(
        F.lit("firm").alias("side"), F.col("firm_id").alias("id"), "payer_id", "name", "kind", "key")
    master_rows = master_keys(_marked_master(oa, key_mode), key_mode, keep=("named",) + _SORTS,
                              every_row=True)
    rows = firm_rows.unionByName(master_rows.withColumn("side", F.lit("master")),
                                 allowMissingColumns=True)
    found = "kind IN ('i', 'n')"     # a name given later and both values together are no more
    index, hot, firm_hot = store_counted(
        rows.where("NOT (startswith(key, '-:') OR startswith(key, '=:'))").groupBy("key").agg(
            *_index_aggs(key_mode), F.expr(f"count_if(side = 'firm' AND {found}) AS n_firms"),
            F.expr("count_if(side = 'firm') AS firm_rows"),
            F.expr(f"count_if(side = 'firm' OR {found}) AS all_rows")),
        "key", "match-index", "all_rows", "firm_rows")
    looked_up = firm_rows.unionByName(master_rows.where(found).select(
        F.lit("master").alias("side"), F.col("oa_id").alias("id"), "kind", "key"),
        allowMissingColumns=True)
    joined = lookup(looked_up, index, "key", "id", keyless=False, hot=hot)
    stored = cut_lineage(joined.groupBy("side", "id", "payer_id", "name").agg(
        *_profile_aggs(key_mode), F.coalesce(F.max("n_firms"), F.lit(0)).alias("firm_hits")),
        "match-profile")
    profile = stored.where("side = 'firm'").withColumnRenamed("id", "firm_id").drop(
        "side", "firm_hits").selectExpr("*", *_profile_totals(key_mode))
    new = stored.where("side = 'master' AND firm_hits = 0").select(F.col("id").alias("firm_id"))
    return TwoSided(profile, new, firm_hot)


def _blank(c) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def unmatched_outcome(variant: str) -> tuple[Column, Column]:
    """(status, via) a firm without any master row gets from each classifier."""
    nothing = F.lit(None).cast("string")
    no_name = _blank("name")
    if variant == "v2":
        return (F.when(no_name, v.NAME_ONLY).otherwise(v.NO_MATCH),
                F.when(no_name, "name").otherwise(nothing))
    if variant == "v1":
        no_id = _blank("payer_id")
        return (F.when(no_id & no_name, v.EXACT_MATCH).when(no_id, v.PAYER_ID_ONLY)
                .when(no_name, v.NAME_ONLY).otherwise(v.NO_MATCH), nothing)
    return F.lit(v.NO_MATCH), nothing


def outcome_counts(firm: DataFrame, oa: DataFrame, key_mode: str = "multi",
                   variant: str = "v2", how: str = "left",
                   profile: DataFrame | None = None) -> DataFrame:
    """(firm_id, match_status, matched_via, n): how many joined rows each firm yields.

    A firm has at most one line per status and via.
    """
    profile = match_profile(firm, oa, key_mode) if profile is None else profile
    tracked = variant in ("v2", "preflight")
    payer = F.col("payer_id")
    rest = F.col("same_name") - F.col("both")   # same name, other id
    blanks = F.lit(0)
    if variant == "v1":
        # Two missing (or empty) payer ids count as equal there.
        blanks = (F.when(payer.isNull(), F.col("void") + F.col("empty"))
                  .when(payer == "", F.col("void")).otherwise(0))
    lines = []
    for via in vias(key_mode):
        label = via if tracked else None
        exact, by_id = F.col(f"x_{via}"), F.col(f"i_{via}")
        lines += [(v.EXACT_MATCH, label, exact + blanks), (v.PAYER_ID_ONLY, label, by_id - exact)]
    if variant in ("preflight", "raw"):
        # These compare ids with !=, so a NULL on either side is no match.
        known = F.when(payer.isNotNull(), F.col("full") - F.col("both_full")).otherwise(0)
        lines += [(v.NAME_ONLY, None, known), (v.NO_MATCH, None, rest - known)]
    else:
        lines += [(v.NAME_ONLY, "name" if tracked else None, rest - blanks)]
    rows = [(F.lit(s), F.lit(via).cast("string"), n) for s, via, n in lines]
    if how == "left":
        rows.append((*unmatched_outcome(variant), F.when(F.col("matched"), 0).otherwise(1)))
    structs = [F.struct(s.alias("match_status"), via.alias("matched_via"),
                        n.cast("bigint").alias("n")) for s, via, n in rows]
    return profile.select("firm_id", F.inline(F.array(*structs))).where("n > 0")


def match_prediction(firm: DataFrame, oa: DataFrame, key_mode: str = "multi",
                     variant: str = "v2", how: str = "left") -> DataFrame:
    """Joined rows per status (and via) with their share, ranked.

    The share is of all firms, so fan-out can push the sum over 100 %; ``distinct_firms`` counts
    each firm once per line. With ``how='inner'`` the share is of the joined rows.
    """
    counts = outcome_counts(firm, oa, key_mode, variant, how)
    lines = counts.groupBy("match_status", "matched_via").agg(
        F.sum("n").alias("predicted_count"), F.count(F.lit(1)).alias("distinct_firms"))
    if how == "left":
        total = firm.agg(F.count(F.lit(1))).scalar()
    else:
        total = F.sum("predicted_count").over(Window.partitionBy())   # a handful of lines
    out = lines.withColumn("percentage", percent("predicted_count", total))
    out = out.orderBy(rank_order("match_status", v.MATCHED + (v.NO_MATCH,)), "matched_via")
    return out if variant in ("v2", "preflight") else out.drop("matched_via")


# ---------------------------------------------------------------- resolved matches
def resolve_matches(firm: DataFrame, oa: DataFrame, key_mode: str = "multi",
                    variant: str = "v2", profile: DataFrame | None = None,
                    hot: dict | None = None) -> DataFrame:
    """The one master row each matched firm takes: best status, then via, then lowest id."""
    if profile is None:
        profile = match_profile(firm, oa, key_mode, hot=hot)
    picks = []

    def add(status, via, kind, best):
        picks.append(F.when(best.isNotNull(), F.struct(
            F.lit(status).alias("match_status"), F.lit(via).cast("string").alias("matched_via"),
            F.lit(kind).alias("key_kind"), best.alias("oa_id"))))

    payer = F.col("payer_id")
    if variant == "v1":
        # A missing and an empty id count as equal there, so such a pair of one name is exact.
        blank = (F.when(payer.isNull(), F.least("best_void", "best_empty"))
                 .when(payer == "", F.col("best_void")))
        by_id = F.col("best_x_id")
        add(v.EXACT_MATCH, None, "i", F.when(blank.isNull() | (by_id < blank), by_id))
        add(v.EXACT_MATCH, None, "n", blank)
        add(v.PAYER_ID_ONLY, None, "i", F.col("best_i_id"))
        add(v.NAME_ONLY, None, "n", F.col("best_name"))
    elif variant == "raw":
        add(v.EXACT_MATCH, None, "i", F.col("best_x_id"))
        add(v.PAYER_ID_ONLY, None, "i", F.col("best_i_id"))
        add(v.NAME_ONLY, None, "n", F.when(payer.isNotNull(), F.col("best_full")))
        add(v.NO_MATCH, None, "n", F.col("best_name"))
    else:
        for via in v.KINDS:
            add(v.EXACT_MATCH, via, "i", F.col(f"best_x_{via}"))
        for via in v.KINDS:
            add(v.PAYER_ID_ONLY, via, "i", F.col(f"best_i_{via}"))
        add(v.NAME_ONLY, "name", "n", F.col("best_name"))
        add(v.NAME_ONLY, None, "w", F.col("best_alt"))
    out = ["firm_id", "payer_id", "name", "void", "alt_key"]
    return (profile.select(*out, F.coalesce(*picks).alias("m"))
            .where(F.col("m").isNotNull()).select(*out, "m.*"))


def with_master(firm: DataFrame, oa: DataFrame, resolved: DataFrame, key_mode: str = "multi",
                payload: tuple = v.PAYLOAD_COLS, hot: dict | None = None) -> DataFrame:
    """Resolved matches with the master row's columns, prefixed ``oa_``.

    A master row is taken by many firms only if one of its keys is hot among the firms, so that
    is what decides into how many salts it is split: a match by a key takes one of that key's
    salts, and a master row is repeated for the most salts any of its keys has.
    """
    if hot is None:
        hot = firm_hot_keys(firm)
    ids = id_columns(key_mode)
    cols = dict.fromkeys(("payer_id", "name") + ids + tuple(payload))
    right = oa.select(F.col("firm_id").alias("oa_id"),
                      *[F.col(c).alias(f"oa_{c}") for c in cols])
    if not hot:
        return resolved.join(right, "oa_id").drop("key_kind", "alt_key")
    matched_key = F.expr(f"CASE key_kind WHEN 'i' THEN {_id_key('payer_id')} "
                         f"WHEN 'n' THEN {_name_key('name')} WHEN 'w' THEN alt_key END")
    of_row = [F.expr(_id_key(f"oa_{c}")) for c in ids] + [F.expr(_name_key("oa_name"))]
    left = resolved.withColumn("_s", one_salt(salts_of(hot, matched_key), "firm_id"))
    right = right.withColumn("_s", every_salt(F.greatest(*[salts_of(hot, k) for k in of_row])))
    return left.join(right, ["oa_id", "_s"]).drop("_s", "key_kind", "alt_key")


def resolved_details(firm: DataFrame, oa: DataFrame) -> DataFrame:
    """Resolved matches with the values the firm will take."""
    hot = firm_hot_keys(firm)
    full = with_master(firm, oa, resolve_matches(firm, oa, hot=hot), payload=v.ID_COLS, hot=hot)
    return full.select(
        "firm_id", F.col("payer_id").alias("old_payer_id"), F.col("name").alias("old_name"),
        "oa_id", "match_status", "matched_via",
        canonical_payer_id([f"oa_{c}" for c in v.ID_COLS]).alias("new_payer_id"),
        F.col("oa_name").alias("new_name"))


# ---------------------------------------------------------------- pairs
def unmatched_firms(firm: DataFrame, oa: DataFrame, key_mode: str = "multi") -> DataFrame:
    """Firms no master row matches, by id or by name: (firm_id, payer_id, name)."""
    keys = firm_keys(firm, "in")
    known = (master_keys(oa, key_mode, "in").select("key").distinct()
             .withColumn("hit", F.lit(1)))
    return (lookup(keys, known, "key", "firm_id", keyless=False)
            .groupBy("firm_id", "payer_id", "name").agg(F.count("hit").alias("hits"))
            .where("hits = 0").drop("hits"))


def match_pairs(firm: DataFrame, oa: DataFrame, key_mode: str = "multi",
                how: str = "inner", payload: tuple = v.ID_COLS) -> DataFrame:
    """Every (firm, master row) pair that agrees on an id or on the name, each pair once.

    ``how='left'`` keeps firms without a master row. The result is the pairs themselves, so a
    key shared by m firms and n master rows yields m*n of them; both sides of such a key are
    split. Use ``match_profile`` where counts or the best row are enough.
    """
    ids = id_columns(key_mode)
    cols = tuple(dict.fromkeys(("payer_id",) + ids + tuple(payload)))
    left = firm_keys(firm, "in")
    right = master_keys(
        oa.select("firm_id", "name", *cols, *[F.col(c).alias(f"oa_{c}") for c in cols],
                  F.col("name").alias("new_name")),
        key_mode, "in", keep=tuple(f"oa_{c}" for c in cols) + ("new_name",))
    pairs = grid_join(left, right.drop("kind"), "key", "firm_id", "oa_id")
    id_hit = F.lit(False)
    for c in ids:
        id_hit = id_hit | F.coalesce(F.col("payer_id") == F.col(f"oa_{c}"), F.lit(False))
    pairs = pairs.where((F.col("kind") == "i") | ~id_hit)
    out = ["firm_id", F.col("payer_id").alias("old_payer_id"), F.col("name").alias("old_name"),
           "oa_id", "new_name", *[f"oa_{c}" for c in cols]]
    pairs = pairs.select(*out)
    if how == "left":
        bare = unmatched_firms(firm, oa, key_mode)
        pairs = pairs.unionByName(bare.select(
            "firm_id", F.col("payer_id").alias("old_payer_id"), F.col("name").alias("old_name")),
            allowMissingColumns=True)
    elif how != "inner":
        raise ValueError("how must be 'inner' or 'left'")
    return pairs


def classify_matches(pairs: DataFrame, variant: str = "v2", key_mode: str = "multi") -> DataFrame:
    """Add ``match_status``, ``matched_via`` and ``new_payer_id`` to joined rows.

    Variants keep their own NULL rules: ``v2``, ``preflight`` (strict ``!=`` against every id),
    ``v1`` (missing ids equal), ``raw`` (strict ``!=``), ``probe`` (plain name equality).
    """
    payer = F.col("old_payer_id")
    ids = [F.col(f"oa_{c}") for c in id_columns(key_mode)]
    names = same_name("old_name", "new_name")
    hit = payer == ids[0]
    for c in ids[1:]:
        hit = hit | (payer == c)
    if variant == "v1":
        hit = F.coalesce(payer, F.lit("")) == F.coalesce(ids[0], F.lit(""))
    status = F.when(hit & names, v.EXACT_MATCH)
    if variant in ("preflight", "raw"):
        other = payer != ids[0]
        for c in ids[1:]:
            other = other & (payer != c)
        status = status.when(hit & ~names, v.PAYER_ID_ONLY).when(names & other, v.NAME_ONLY)
    elif variant == "probe":
        status = status.when(hit, v.PAYER_ID_ONLY).when(
            F.lower("old_name") == F.lower("new_name"), v.NAME_ONLY)
    else:
        status = status.when(hit, v.PAYER_ID_ONLY).when(names, v.NAME_ONLY)
    out = pairs.withColumn("match_status", status.otherwise(v.NO_MATCH))
    if key_mode == "multi":
        via = F.when(payer == ids[0], "fac").when(payer == ids[1], "pro").when(
            payer == ids[2], "elig")
        if variant == "v2":
            via = via.when(names, "name")
        out = out.withColumn("matched_via", via)
    return out.withColumn("new_payer_id", canonical_payer_id(ids))
