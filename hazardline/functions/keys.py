"""Group keys, status flags and change-set access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardline.functions.timefn import col_
from hazardline.params import DEAD_STATUSES

__all__ = [
    "group_key", "fallback_group_key", "tenure_training", "tenure_correction",
    "status_new", "status_present", "alive_flag", "as_variant", "change_set_variant", "safe_ratio", "iff",
]


def group_key(facility, freight, plan, tenure) -> Column:
    """F14 facility-freight-plan-tenure; any NULL part gives a NULL key (not concat_ws)."""
    parts = [col_(facility), col_(freight), col_(plan), col_(tenure)]
    out = []
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit("-"))
        out.append(p.cast("string"))
    return F.concat(*out)


def fallback_group_key(facility, plan, tenure) -> Column:
    """F15 the same key with freight 0 (all freights of the facility)."""
    return group_key(facility, F.lit(0), plan, tenure)


def tenure_training(user_tenure) -> Column:
    """F17 IFF(tenure <= 3, tenure, 4): NULL tenure falls to 4."""
    t = col_(user_tenure)
    return F.when(t <= 3, t).otherwise(F.lit(4))


def tenure_correction(raw) -> Column:
    """F16 LEAST(1 + weeks, 4) with warehouse NULL semantics (NULL stays NULL)."""
    r = col_(raw)
    return F.when(r.isNull(), F.lit(None).cast("int")).otherwise(F.least(r, F.lit(4)))


def as_variant(change_set, is_variant: bool = False) -> Column:
    """The change set as VARIANT: used as is when stored as VARIANT, else parsed from JSON text."""
    return col_(change_set) if is_variant else F.try_parse_json(col_(change_set))



def status_new(v) -> Column:
    """F18 CHANGE_SET:status[1] as text (NULL when absent or not an array); ``v`` is VARIANT."""
    return F.try_variant_get(col_(v), "$.status[1]", "string")


def status_present(v) -> Column:
    """F19 CHANGE_SET:status IS NOT NULL; a JSON null still counts as present; ``v`` is VARIANT."""
    return F.try_variant_get(col_(v), "$.status", "variant").isNotNull()


def alive_flag(new_status) -> Column:
    """P7 dead statuses -> FALSE; anything else, including NULL -> TRUE."""
    return F.when(col_(new_status).isin(*DEAD_STATUSES), F.lit(False)).otherwise(F.lit(True))


def safe_ratio(num, den) -> Column:
    """P10 num / NULLIF(den, 0) (ANSI division by zero would raise)."""
    return col_(num) / F.nullif(col_(den), F.lit(0))


def iff(cond, a, b) -> Column:
    """P8 IFF(cond, a, b): NULL condition takes the else branch."""
    return F.when(col_(cond), col_(a) if not isinstance(a, (int, float)) else F.lit(a)).otherwise(
        col_(b) if not isinstance(b, (int, float)) else F.lit(b))


def change_set_variant(df) -> Column:
    """The ``change_set`` column of ``df`` as VARIANT (parsed only if stored as text)."""
    return as_variant("change_set", dict(df.dtypes).get("change_set") == "variant")
