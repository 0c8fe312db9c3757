"""Column expressions: titles, ordinal codes, bins, bands, formatting.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen; small lookup tables become map literals
that Catalyst folds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that results depend on (must equal the reference's tables).
# Honorific -> title group, 18 entries, in the reference's order.
TITLE_GROUPS = {
    "Mr": "Mr",
    "Miss": "Miss",
    "Mrs": "Mrs",
    "Master": "Master",
    "Dr": "Officer",
    "Rev": "Officer",
    "Col": "Officer",
    "Major": "Officer",
    "Mlle": "Miss",
    "Countess": "Royalty",
    "Ms": "Mrs",
    "Lady": "Royalty",
    "Jonkheer": "Royalty",
    "Don": "Royalty",
    "Dona": "Royalty",
    "Mme": "Mrs",
    "Capt": "Officer",
    "Sir": "Royalty",
}
DEFAULT_TITLE = "Mr"
TITLE_CODES = {"Mr": 0, "Miss": 1, "Mrs": 2, "Master": 3, "Officer": 4, "Royalty": 5}
SEX_CODES = {"male": 0, "female": 1}
PORT_CODES = {"S": 0, "C": 1, "Q": 2}
# Honorific pattern: a space, letters, then a literal dot; first match wins.
TITLE_PATTERN = r" ([A-Za-z]+)\."
# Age bands: right-closed edges 0, 12, 18, 35, 60, 120 -> codes 0..4.
AGE_BAND_EDGES = [0.0, 12.0, 18.0, 35.0, 60.0, 120.0]
# Confidence bands on the unrounded positive-class probability.
CONFIDENCE_HIGH = (0.75, 0.25)
CONFIDENCE_MEDIUM = (0.60, 0.40)
# Placeholders for absent text fields of a record.
DEFAULT_NAME = "Doe, Mr. John"
DEFAULT_TICKET = "UNKNOWN"
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """Double NaN -> NULL, so NaN counts as missing everywhere."""
    c = _col(c).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def map_literal(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def honorific(name: str | Column) -> Column:
    """First `` Word.`` group of a name; '' when there is none."""
    return F.regexp_extract(_col(name), TITLE_PATTERN, 1)


def title_group(name: str | Column, groups: Mapping[str, str] = TITLE_GROUPS,
                default: str = DEFAULT_TITLE) -> Column:
    """Honorific mapped to its group; unknown or missing -> ``default``."""
    return F.coalesce(map_literal(groups)[honorific(name)], F.lit(default))


def encode(c: str | Column, codes: Mapping, default: int = 0) -> Column:
    """Ordinal recode through a small map literal; unknown -> ``default``."""
    return F.coalesce(map_literal(codes)[_col(c)], F.lit(default)).cast("int")


def family_size(sibsp: str | Column, parch: str | Column) -> Column:
    return (_col(sibsp) + _col(parch) + F.lit(1)).cast("int")


def alone(family: str | Column) -> Column:
    return (_col(family) == 1).cast("int")


def right_closed_bin(x: str | Column, edges: Sequence[float],
                     include_lowest: bool = False, outside: Column | None = None) -> Column:
    """Bin index for right-closed bins (e0,e1], (e1,e2], ...

    With ``include_lowest`` the first bin is [e0, e1].  Values outside the
    edges get ``outside`` (NULL by default).
    """
    x = _col(x)
    edges = [float(e) for e in edges]
    if len(edges) < 2:
        return outside if outside is not None else F.lit(None).cast("int")
    inner = F.array(*[F.lit(e) for e in edges[1:-1]])
    idx = F.size(F.filter(inner, lambda e: e < x)).cast("int")
    low_ok = (x >= F.lit(edges[0])) if include_lowest else (x > F.lit(edges[0]))
    in_range = low_ok & (x <= F.lit(edges[-1]))
    return F.when(in_range, idx).otherwise(outside if outside is not None else F.lit(None))


def age_band(age: str | Column, edges: Sequence[float] = AGE_BAND_EDGES) -> Column:
    """Right-closed age bands; 0 is taken into the first band (see README)."""
    return right_closed_bin(age, edges, include_lowest=True)


def fare_category(fare: str | Column, edges: Sequence[float]) -> Column:
    """Right-closed learned bins, lowest edge included, out of range -> 0."""
    return right_closed_bin(fare, edges, include_lowest=True, outside=F.lit(0)).cast("int")


def confidence(prob: str | Column) -> Column:
    p = _col(prob)
    hi, lo = CONFIDENCE_HIGH
    mhi, mlo = CONFIDENCE_MEDIUM
    return (F.when((p >= hi) | (p <= lo), "High")
             .when((p >= mhi) | (p <= mlo), "Medium")
             .otherwise("Low"))


def logistic(margin: str | Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(margin)))


def linear_margin(coefficients: Mapping[str, float], intercept: float = 0.0) -> Column:
    """intercept + sum(w_i * x_i) as one codegen'd expression."""
    m = F.lit(float(intercept))
    for name, w in coefficients.items():
        m = m + F.lit(float(w)) * F.col(name).cast("double")
    return m


def model_key(stage: str | Column, name: str | Column) -> Column:
    """``stage__name`` with spaces turned into '_' and lower-cased."""
    s = _col(stage) if isinstance(stage, Column) else F.lit(stage)
    n = _col(name) if isinstance(name, Column) else F.lit(name)
    return F.concat_ws("__", s, F.lower(F.replace(n, F.lit(" "), F.lit("_"))))


def percent_text(share: str | Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", _col(share) * F.lit(100.0))
