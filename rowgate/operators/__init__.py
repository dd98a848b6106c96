"""Table operators. Each takes and returns DataFrames; names of columns are arguments."""

from rowgate.operators.audit import audit_change, constraint_audit, constraint_counts
from rowgate.operators.changes import apply_inserts, apply_patch, patch_outcome
from rowgate.operators.checks import check_email, coerce_types, fill_defaults, validate_rows
from rowgate.operators.deletes import (
    delete_by_key,
    delete_cascade,
    delete_detach,
    delete_outcome,
    delete_restrict,
    delete_rows,
    restricted_roots,
)
from rowgate.operators.identity import (
    claims_filter,
    kid_match,
    location_id,
    login_outcome,
    require_role,
    roles_union,
)
from rowgate.operators.keys import assign_ids, duplicate_keys, first_on_all, insert_if_absent, unique_conflict
from rowgate.operators.links import (
    Parent,
    Path,
    children_pages,
    children_summary,
    fk_check,
    fk_orphans,
    insert_with_lookup_value,
    navigate_to_many,
    navigate_to_one,
)
from rowgate.operators.lookups import (
    lookup_by_alt_key,
    lookup_by_key,
    owner_or_admin,
    taken_by_other,
    touched_rows,
)
from rowgate.operators.users import register_users, update_profile

__all__ = [
    "Parent",
    "Path",
    "apply_inserts",
    "apply_patch",
    "assign_ids",
    "check_email",
    "children_pages",
    "children_summary",
    "claims_filter",
    "coerce_types",
    "audit_change",
    "constraint_audit",
    "constraint_counts",
    "delete_by_key",
    "delete_cascade",
    "delete_detach",
    "delete_outcome",
    "delete_restrict",
    "delete_rows",
    "duplicate_keys",
    "fill_defaults",
    "first_on_all",
    "fk_check",
    "fk_orphans",
    "insert_if_absent",
    "insert_with_lookup_value",
    "kid_match",
    "location_id",
    "login_outcome",
    "lookup_by_alt_key",
    "lookup_by_key",
    "navigate_to_many",
    "navigate_to_one",
    "owner_or_admin",
    "patch_outcome",
    "register_users",
    "require_role",
    "restricted_roots",
    "roles_union",
    "taken_by_other",
    "touched_rows",
    "unique_conflict",
    "update_profile",
    "validate_rows",
]
