"""Column names, statuses, labels and messages that results must carry."""

# --- fixed values: columns -------------------------------------------------
KINDS = ("fac", "pro", "elig")
ID_COLS = ("payer_id_fac", "payer_id_pro", "payer_id_elig")
ENROLLMENT_COLS = (
    "payer_id_fac_enrollment",
    "payer_id_pro_enrollment",
    "payer_id_elig_enrollment",
)
FLAG_COLS = (
    "non_par_fac", "non_par_pro", "non_par_elig",
    "secondary_ins_fac", "secondary_ins_pro", "secondary_ins_elig",
    "attachment_fac", "attachment_pro", "attachment_elig",
    "wc_auto_fac", "wc_auto_pro", "wc_auto_elig",
)
PAYLOAD_COLS = ID_COLS + ENROLLMENT_COLS + FLAG_COLS
MASTER_COLS = ("firm_id", "payer_id", "name") + PAYLOAD_COLS

# (column, Spark type, declared length or None)
TRACKING_SPEC = (
    ("payer_id_new", "string", 200),
    ("name_new", "string", 255),
    ("sync_status", "string", 50),
    ("sync_details", "string", None),
    ("last_synced_at", "timestamp", None),
    ("matched_via", "string", 10),
)
TRACKING_COLS = tuple(c for c, _, _ in TRACKING_SPEC)
TRACKING_SPEC_V0 = (
    ("facility_payer_id", "string", 50),
    ("professional_payer_id", "string", 50),
    ("eligibility_payer_id", "string", 50),
    ("match_status", "string", 50),
    ("match_details", "string", None),
    ("name_from_payers_oa", "string", 255),
    ("last_synced_at", "timestamp", None),
)

# --- fixed values: statuses ------------------------------------------------
EXACT_MATCH = "EXACT_MATCH"
PAYER_ID_ONLY = "PAYER_ID_ONLY"
NAME_ONLY = "NAME_ONLY"
NO_MATCH = "NO_MATCH"
NEW_FROM_OA = "NEW_FROM_OA"
RELOADED_FROM_OA = "RELOADED_FROM_OA"
SYNCED_LATE = "SYNCED_LATE"
CORRECTED_PAYER_ID_ONLY = "CORRECTED_PAYER_ID_ONLY"
CORRECTED_NAME_ONLY = "CORRECTED_NAME_ONLY"
MATCHED_VIA_SUB_PAYER = "MATCHED_VIA_SUB_PAYER"
INVALID_PAYER = "INVALID_PAYER"
ACTIVE_PREFIX = "ACTIVE_"
MIGRATED_PREFIX = "MIGRATED_"
MATCHED = (EXACT_MATCH, PAYER_ID_ONLY, NAME_ONLY)
REVIEW = (PAYER_ID_ONLY, NAME_ONLY)
PROBLEM = (PAYER_ID_ONLY, NAME_ONLY, NO_MATCH)

# --- fixed values: label families, values in fac / pro / elig / none order --
SOURCE_STYLES = {
    "short": ("fac", "pro", "elig", "none"),
    "via": ("fac", "pro", "elig", None),
    "from": ("From fac", "From pro", "From elig", "All NULL"),
    "from_v2": ("From fac", "From pro", "From elig", "NULL (all three are NULL)"),
    "using": ("Using fac", "Using pro", "Using elig", "All NULL"),
    "exists": ("fac exists", "pro exists", "elig exists", "All NULL"),
    "primary": ("fac", "pro", "elig", "none (all NULL)"),
}

# all missing / fac missing / pro missing / elig missing / otherwise
MISSING_STYLES = {
    "issue": (
        "All payer IDs are NULL",
        "Missing facility payer_id",
        "Missing professional payer_id",
        "Missing eligibility payer_id",
        "Some missing",
    ),
    "severity": (
        "CRITICAL: All payer IDs missing",
        "WARNING: Missing facility ID",
        "WARNING: Missing professional ID",
        "WARNING: Missing eligibility ID",
        "Minor issues",
    ),
    "missing_type": (
        "CRITICAL: All payer IDs missing",
        "Missing facility",
        "Missing professional",
        "Missing eligibility",
        "Multiple missing",
    ),
}

MISMATCH = ("Both differ", "Only payer_id differs", "Only name differs", "Match")
OLD_VS_NEW = ("Old = fac", "Old = pro", "Old = elig", "Old = new", "Different")
REVIEW_REASONS = (
    "Mismatch: Review names/IDs",
    "Incomplete: All payer IDs missing",
    "Missing: No payer_id_new assigned",
    "Missing: No name_new assigned",
    "Other: Review needed",
)
NAME_LENGTH = (
    "OA name is longer/detailed",
    "Firm name is longer/detailed",
    "Both same length",
)
OA_MATCH = ("Has OA match", "No OA match")
VIA_DESCRIPTIONS = {
    "fac": "Matched on facility payer ID",
    "pro": "Matched on professional payer ID",
    "elig": "Matched on eligibility payer ID",
    "name": "Matched on name only",
}
UNKNOWN_VIA = "Unknown"
USAGE = ("In Claims", "Patient Only")

# exact / payer id only / name only / no match
PREVIEW_ACTIONS = (
    "✓ EXACT (will update)",
    "⚠ PAYER_ID_ONLY (will update)",
    "⚠ NAME_ONLY (will update)",
    "✗ NO_MATCH (will delete & reinsert)",
)
PREVIEW_TYPES = ("✓ EXACT", "⚠ PAYER_ID_ONLY", "⚠ NAME_ONLY", "✗ NO_MATCH")
NO_MATCH_REASON = "Not found in insurance_firm_oa"

STATUS_CATEGORIES = (
    (EXACT_MATCH, "Perfect Matches (EXACT)"),
    (PAYER_ID_ONLY, "Needs Review (PAYER_ID_ONLY)"),
    (NAME_ONLY, "Needs Review (NAME_ONLY)"),
    (NEW_FROM_OA, "New Records (NEW_FROM_OA)"),
    (None, "Other/Unknown"),
)
PAYER_TYPE_NAMES = ("Facility Payer IDs", "Professional Payer IDs", "Eligibility Payer IDs")
DASHBOARD_METRICS = (
    "Total Records", "Exact Matches", "Needs Review", "New from OA",
    "Has fac ID", "Has pro ID", "Has elig ID",
)
COLUMN_ORIGINS = ("★ ORIGINAL (preserved)", "✓ NEW (added)", "✓ FROM OA", "✓ FLAG FROM OA", "OTHER")

# --- fixed values: verdicts ------------------------------------------------
# (comparison, bound, text) read top down; the last entry is the fallback.
EXACT_BANDS = (
    (">=", 80, "✓ EXCELLENT: >80% exact matches"),
    (">=", 60, "✓ GOOD: >60% exact matches"),
    (">=", 40, "⚠ FAIR: >40% exact matches - some manual cleanup needed"),
    (None, None, "⚠ POOR: <40% exact matches - significant manual cleanup needed"),
)
REVIEW_BANDS = (
    ("<=", 10, "✓ EXCELLENT: <10% need review"),
    ("<=", 20, "✓ GOOD: <20% need review"),
    (None, None, "⚠ ATTENTION: >20% need review"),
)
ROW_DIFF_BANDS = (
    ("<=", 0, "✓ EXCELLENT: Row counts match perfectly"),
    ("<=", 5, "✓ GOOD: Small difference acceptable"),
    (None, None, "⚠ REVIEW: Row count difference needs investigation"),
)
ROW_DIFF_SUMMARY = (
    ("<=", 0, "✓ Perfect match"),
    ("<=", 5, "⚠ Small difference (acceptable)"),
    (None, None, "⚠ Significant difference - review"),
)
ROW_DIFF_INSERT = (
    ("<=", 0, "✓ Perfect match - counts are equal"),
    ("<=", 5, "⚠ Close match - small difference expected"),
    (None, None, "⚠ Significant difference - review remaining records"),
)
ALL_THREE_BANDS = (
    (">=", 95, "✓ EXCELLENT"),
    (">=", 80, "✓ GOOD"),
    (None, None, "⚠ NEEDS ATTENTION"),
)
QUALITY_BANDS = (
    (">=", 95, "✓ EXCELLENT"),
    (">=", 80, "✓ GOOD"),
    (">=", 60, "⚠ FAIR"),
    (None, None, "⚠ POOR"),
)
INCOMPLETE_BANDS = (
    ("<=", 0, "✓ ALL RECORDS COMPLETE"),
    ("<=", 5, "⚠ Few incomplete records"),
    (None, None, "⚠ MANY incomplete records - review needed"),
)
ORPHAN_BANDS = (
    ("<=", 0, "✓ NO ORPHANS - All patient records valid"),
    ("<", 10, "⚠ LOW ORPHAN COUNT - Review needed"),
    (None, None, "❌ HIGH ORPHAN COUNT - Critical issue"),
)
INTEGRITY_BANDS = (
    ("<=", 0, "✓ 100% INTEGRITY"),
    ("<", 1, "✓ >99% INTEGRITY"),
    ("<", 5, "⚠ >95% INTEGRITY"),
    (None, None, "❌ <95% INTEGRITY - CRITICAL"),
)
UNUSED_BANDS = (
    ("<=", 0, "✓ ALL FIRMS HAVE PATIENT REFERENCES"),
    ("<", 10, "⚠ <10% firms unused"),
    (None, None, "⚠ MANY FIRMS UNUSED - Review if these are needed"),
)
IMPACT_BANDS = (
    ("<=", 0, "✓ SAFE TO DELETE (no patient impact)"),
    ("<", 10, "⚠ LOW IMPACT - Review manually"),
    (None, None, "⚠ HIGH IMPACT - Use Option B or C"),
)
REMAINING_BANDS = (
    ("<=", 0, "✓ All garbage deleted"),
    (None, None, "⚠ Some garbage remains (has patient references)"),
)
UNSYNCED_BANDS = (
    ("<=", 0, "✓ All records have been synced"),
    (None, None, "⚠ Some records not synced - may need manual review"),
)
FIRM_QUALITY_BANDS = (
    (">=", 70, "✓ EXCELLENT: Most firms have exact matches"),
    (None, None, "⚠ REVIEW: Some firms need manual review"),
)
STRATEGY = (
    "✓ USE OPTION A: Safe deletion (no patient impact)",
    "⚠ USE OPTION A: Safe deletion (low impact - review manually)",
    "⚠ USE OPTION B: Reassign then delete (all can be reassigned)",
    "⚠ USE OPTION B: Reassign + Option A combo (some cannot be reassigned)",
)
ALL_REFERENCED = "✓ ALL REFERENCED FIRMS EXIST"
SOME_UNREFERENCED = ("⚠ SOME REFERENCED FIRMS MISSING: ", " firms not referenced")
NO_ORPHANS = "✓ EXCELLENT: No orphaned patient records"
SOME_ORPHANS = ("⚠ ACTION NEEDED: ", " orphaned patient records")
CLEANUP_VERDICT = ("✓ SUCCESS: No orphaned records", "⚠️ WARNING: Some orphaned records exist")
COLUMNS_FOUND = ("✓ ALL {n} COLUMNS FOUND", "✗ MISSING: ", " COLUMNS")
SETUP_VERDICT = ("✓ SETUP VERIFIED - ALL COLUMNS PRESENT", "✗ SETUP INCOMPLETE - MISSING COLUMNS")

VENN_CATEGORIES = (
    "Firms with Claims",
    "Firms in Patient Insurance (no claims)",
    "Firms not used at all",
    "Total firms in database",
)
QUALITY_SEGMENTS = ("Firms with Claims", "Firms with Patients Only", "Firms Not Used")
PLAN_STEPS = (
    ("1. Firms in Claims", "Keep and update with OA data", "Critical - These have submitted claims"),
    ("2. Firms in Patient Insurance only", "Keep and update with OA data",
     "Important - Patients mapped but no claims yet"),
    ("3. Firms not used", "DROP and reload from OA", "Safe - Not referenced anywhere"),
)
SAFETY_STEPS = (
    ("Firms with Claims", "Will be KEPT and UPDATED"),
    ("Firms with Patients only", "Will be KEPT and UPDATED"),
    ("Firms not used", "Will be DELETED and RELOADED"),
)

# --- fixed values: patterns ------------------------------------------------
FEED_PATTERNS = {
    "professional_payer_id": ("Professional",),
    "facility_payer_id": ("Institutional", "Facility"),
    "eligibility_payer_id": ("Eligibility",),
}
INVALID_NAME_PARTS = ("TEST", "DEMO")
