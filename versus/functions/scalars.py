"""Column-level scalar functions (#12-#13, #18, #22-#24, #31, #80-#84).

Every function returns a ``Column`` built from built-in expressions, so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (BLUE_SIDE, RED_SIDE, ROLE_ALIASES, ROLE_ORDER,
                         SLOT_ROLE_FALLBACK, UNKNOWN_ROLE, UNUSABLE_ROLE_TEXT)

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def coerce_numeric(col: ColumnOrName) -> Column:
    """String or number to double; anything unparseable becomes NULL (#13)."""
    return _c(col).try_cast("double")


def coerce_int(col: ColumnOrName) -> Column:
    """To a nullable bigint through double, as a numeric parse would (#12).

    Fractional inputs that are not whole numbers become NULL (a nullable
    integer cannot hold them).
    """
    as_double = _c(col).try_cast("double")
    return F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))


def finite_or_null(col: ColumnOrName) -> Column:
    """NaN and +/-inf become NULL (#31, first half)."""
    c = _c(col).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def binarize(col: ColumnOrName) -> Column:
    """1 when the numeric value is > 0, else 0; NULL and bad strings give 0 (#18)."""
    return (F.coalesce(_c(col).try_cast("double"), F.lit(0.0)) > 0).cast("int")


def infer_side(slot: ColumnOrName, slots_per_side: int = 5) -> Column:
    """Side id from the player slot: slot <= n is side 100, else 200; NULL stays NULL (#22)."""
    s = _c(slot)
    return F.when(s.isNull(), F.lit(None).cast("bigint")).when(
        s <= slots_per_side, F.lit(BLUE_SIDE).cast("bigint")).otherwise(F.lit(RED_SIDE).cast("bigint"))


def fill_side(side: ColumnOrName, slot: ColumnOrName, slots_per_side: int = 5) -> Column:
    """Keep a present side id, infer it from the slot only where missing (#22)."""
    return F.coalesce(coerce_int(side), infer_side(slot, slots_per_side))


def side_flag(side: ColumnOrName) -> Column:
    """1 for side 100 (#23)."""
    return F.coalesce((_c(side) == BLUE_SIDE).cast("int"), F.lit(0))


def safe_ratio(num: ColumnOrName, den: ColumnOrName, floor: float = 1e-6) -> Column:
    """num / max(den, floor) with NULL treated as 0 on both sides (#24)."""
    n = F.coalesce(_c(num).cast("double"), F.lit(0.0))
    d = F.coalesce(_c(den).cast("double"), F.lit(0.0))
    return n / F.greatest(d, F.lit(float(floor)))


def team_player_slot(slot: ColumnOrName, slots_per_side: int = 5) -> Column:
    """((slot - 1) mod n) + 1, NULL stays NULL (#81)."""
    return F.pmod(_c(slot).cast("bigint") - 1, F.lit(slots_per_side)) + 1


def _literal_map(mapping: dict) -> Column:
    items = []
    for key, value in mapping.items():
        items.extend([F.lit(key), F.lit(value)])
    return F.create_map(*items)


def role_alias(value: ColumnOrName) -> Column:
    """Canonical role for one raw text, NULL when unusable or unrecognized."""
    text = F.lower(F.regexp_replace(_c(value).cast("string"), r"^\s+|\s+$", ""))
    usable = ~text.isin(*UNUSABLE_ROLE_TEXT)
    return F.when(usable, F.element_at(_literal_map(ROLE_ALIASES), text))


def normalize_role(*values: ColumnOrName, slot: ColumnOrName | None = None,
                   slots_per_side: int = 5) -> Column:
    """First recognized role among ``values``, else the slot's default role, else 'unknown' (#80)."""
    candidates = [role_alias(v) for v in values]
    if slot is not None:
        candidates.append(F.element_at(_literal_map(SLOT_ROLE_FALLBACK),
                                       team_player_slot(slot, slots_per_side).cast("int")))
    candidates.append(F.lit(UNKNOWN_ROLE))
    return F.coalesce(*candidates)


def role_rank(role: ColumnOrName) -> Column:
    """Draft order of a canonical role; anything else ranks 99 (#82)."""
    return F.coalesce(F.element_at(_literal_map(ROLE_ORDER), _c(role)), F.lit(99))


def sigmoid(margin: ColumnOrName) -> Column:
    """Logistic link from a decision margin to a score in (0, 1) (#83)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(margin).cast("double")))


def clip_probability(p: ColumnOrName, eps: float = 1e-15) -> Column:
    """Clamp a score to [eps, 1 - eps] (#84)."""
    return F.least(F.greatest(_c(p).cast("double"), F.lit(eps)), F.lit(1.0 - eps))


def value_or_label(value: ColumnOrName, mapping: dict, prefix: str = "ID:") -> Column:
    """Literal value map with a ``prefix + value`` default for unmapped keys (#32)."""
    mapped = F.element_at(_literal_map(mapping), _c(value))
    return F.coalesce(mapped, F.concat(F.lit(prefix), _c(value).cast("string")))
