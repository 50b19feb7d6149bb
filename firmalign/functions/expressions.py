"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from . import vocabulary as v


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def canonical_payer_id(ids=v.ID_COLS) -> Column:
    """First payer id present, facility before professional before eligibility."""
    return F.coalesce(*[_col(c) for c in ids])


def payer_source(style: str = "short", ids=v.ID_COLS) -> Column:
    """Which id supplies the canonical payer id, worded in one of the label styles."""
    *labels, fallback = v.SOURCE_STYLES[style]
    pairs = list(zip(ids, labels))
    out = F.lit(fallback).cast("string")
    for c, label in reversed(pairs):
        out = F.when(_col(c).isNotNull(), F.lit(label)).otherwise(out)
    return out


def name_key(c="name") -> Column:
    """Lower-cased name, empty for a missing one, so two missing names compare equal."""
    return F.coalesce(F.lower(_col(c)), F.lit(""))


def same_name(a, b) -> Column:
    return name_key(a) == name_key(b)


def all_null(cols) -> Column:
    return reduce(lambda x, y: x & y, [_col(c).isNull() for c in cols])


def any_null(cols) -> Column:
    return reduce(lambda x, y: x | y, [_col(c).isNull() for c in cols])


def percent(n, total) -> Column:
    """Share in percent with two decimals; NULL when the total is zero."""
    n, total = _col(n).cast("double"), _col(total).cast("double")
    return F.round(n * 100 / F.nullif(total, F.lit(0.0)), 2)


def ratio(n, total) -> Column:
    """Unrounded share in percent, for comparing with a band."""
    return _col(n).cast("double") * 100 / F.nullif(_col(total).cast("double"), F.lit(0.0))


def threshold_label(value, bands) -> Column:
    """Text of the first band the value satisfies; the last band is the fallback."""
    value = _col(value)
    ops = {">=": value.__ge__, "<=": value.__le__, "<": value.__lt__}
    *graded, (_, _, fallback) = bands
    out = F.lit(fallback)
    for op, bound, text in reversed(graded):
        out = F.when(ops[op](F.lit(bound)), F.lit(text)).otherwise(out)
    return out


def whitespace_issue(c="name") -> Column:
    """Inner double blank, leading blank or trailing blank."""
    c = _col(c)
    return c.contains("  ") | c.startswith(" ") | c.endswith(" ")


def space_count(c="name") -> Column:
    c = _col(c)
    return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))).cast("bigint")


def mismatch_type() -> Column:
    both, only_id, only_name, same = v.MISMATCH
    ids = F.col("payer_id") != F.col("payer_id_new")
    names = F.col("name") != F.col("name_new")
    return (F.when(ids & names, both).when(ids, only_id).when(names, only_name).otherwise(same))


def values_differ() -> Column:
    return (F.col("payer_id") != F.col("payer_id_new")) | (F.col("name") != F.col("name_new"))


def name_length_compare(ours, theirs) -> Column:
    longer, shorter, same = v.NAME_LENGTH
    a, b = F.length(_col(ours)), F.length(_col(theirs))
    return F.when(a < b, longer).when(a > b, shorter).otherwise(same)


def missing_id_label(style: str) -> Column:
    every, fac, pro, elig, other = v.MISSING_STYLES[style]
    out = F.when(all_null(v.ID_COLS), every)
    for c, label in zip(v.ID_COLS, (fac, pro, elig)):
        out = out.when(F.col(c).isNull(), label)
    return out.otherwise(other)


def completeness_count() -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("bigint") for c in v.ID_COLS])


def old_vs_new() -> Column:
    *labels, other = v.OLD_VS_NEW
    out = F.lit(other)
    for c, label in reversed(list(zip(v.ID_COLS + ("payer_id_new",), labels))):
        out = F.when(F.col("payer_id") == F.col(c), F.lit(label)).otherwise(out)
    return out


def review_reason() -> Column:
    mismatch, incomplete, no_id, no_name, other = v.REVIEW_REASONS
    return (
        F.when(F.col("sync_status").isin(*v.REVIEW), mismatch)
        .when(all_null(v.ID_COLS), incomplete)
        .when(F.col("payer_id_new").isNull(), no_id)
        .when(F.col("name_new").isNull(), no_name)
        .otherwise(other)
    )


def strip_status_prefix(c="sync_status") -> Column:
    c = _col(c)
    cut = F.substring(c, len(v.ACTIVE_PREFIX) + 1, 2**31 - 1)
    return F.when(c.startswith(v.ACTIVE_PREFIX), cut).otherwise(c)


def invalid_payer_predicate() -> Column:
    name = F.col("name")
    marked = reduce(lambda a, b: a | b, [name.contains(p) for p in v.INVALID_NAME_PARTS])
    return F.coalesce(F.col("payer_id").isNull() | name.isNull() | marked, F.lit(False))


def recently_synced(now, interval: str = "1 minute") -> Column:
    """Synced no longer than ``interval`` before ``now``."""
    return F.col("sync_status").isNotNull() & (
        F.col("last_synced_at") >= now - F.expr(f"INTERVAL {interval}"))


def impact_level(n) -> Column:
    n = _col(n)
    text = n.cast("string")
    return (
        F.when(n == 1, F.lit("1 patient affected"))
        .when(n.between(2, 10), F.concat(text, F.lit(" patients affected")))
        .otherwise(F.concat(text, F.lit(" patients affected - HIGH IMPACT")))
    )


def oa_match_status(c="sync_status") -> Column:
    yes, no = v.OA_MATCH
    return F.when(_col(c).isin(*v.MATCHED), yes).otherwise(no)


def via_description(c="matched_via") -> Column:
    out = F.lit(v.UNKNOWN_VIA)
    for via, text in v.VIA_DESCRIPTIONS.items():
        out = F.when(_col(c) == via, F.lit(text)).otherwise(out)
    return out


def rank_order(c, order=v.MATCHED) -> Column:
    """Position of a value in a custom sort order; everything else sorts last."""
    out = F.lit(len(order) + 1)
    for i, value in reversed(list(enumerate(order, 1))):
        out = F.when(_col(c) == value, F.lit(i)).otherwise(out)
    return out


def quoted(c) -> Column:
    return F.concat(F.lit('"'), _col(c), F.lit('"'))


def sync_details(style: str, status, via=None, old_id=None, old_name=None,
                 new_id=None, new_name=None) -> Column:
    """Audit text for one match; a NULL part makes the whole text NULL."""
    s = _col(status)
    # fixed values: the wording of each script generation
    if style == "feed":
        exact = F.concat(F.lit("Perfect match. Current payer_id: "), _col(old_id),
                         F.lit(", Correct name: "), _col(new_name))
        by_id = F.concat(F.lit("Payer ID matches but name differs. Current: "), quoted(old_name),
                         F.lit(", Correct: "), quoted(new_name))
        by_name = F.concat(F.lit("Name matches but payer_id differs. Current ID: "), _col(old_id),
                           F.lit(", Correct ID: "), _col(new_id))
        none, other = "No matching record found in payers_oa", "Unknown match status"
    elif style == "v0":
        exact = F.lit("Perfect match. Data synced from insurance_firm_oa.")
        by_id = F.concat(F.lit("Payer ID matches but name differs. Old: "), quoted(old_name),
                         F.lit(", New: "), quoted(new_name))
        by_name = F.concat(F.lit("Name matches but payer_id differs. Old: "), quoted(old_id),
                           F.lit(", New: "), quoted(new_id))
        none, other = "No matching record found in insurance_firm_oa", "Unknown"
    elif style == "v1":
        exact = F.lit("Perfect match. Old values preserved, new values in *_new columns.")
        by_id = F.concat(F.lit("Payer ID matches. Name differs - old: "), quoted(old_name),
                         F.lit(", new: "), quoted(new_name))
        by_name = F.concat(F.lit("Name matches. Payer ID differs - old: "), quoted(old_id),
                           F.lit(", new: "), quoted(new_id))
        none, other = "Unknown", "Unknown"
    elif style == "v2":
        exact = F.concat(F.lit("Perfect match. Matched via "), _col(via),
                         F.lit(". Old values preserved."))
        by_id = F.concat(F.lit("Payer ID matches via "), _col(via),
                         F.lit(". Name differs - old: "), quoted(old_name),
                         F.lit(", new: "), quoted(new_name))
        by_name = F.concat(F.lit("Name matches. Payer ID differs - old: "), quoted(old_id),
                           F.lit(", new: "), quoted(new_id))
        none, other = "Unknown match status", "Unknown match status"
    else:
        raise ValueError(f"unknown sync_details style: {style}")
    return (F.when(s == v.EXACT_MATCH, exact).when(s == v.PAYER_ID_ONLY, by_id)
            .when(s == v.NAME_ONLY, by_name).when(s == v.NO_MATCH, F.lit(none))
            .otherwise(F.lit(other)))
