"""Column-level building blocks: names, roles, encodings, arithmetic features, bins.

All of these are native Catalyst expressions (no Python UDF), so they stay
inside whole-stage codegen and run where the data is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- names / roles

_NAME_RUN = re.compile(r"[^A-Za-z0-9_]+")


def clean_name(name: str) -> str:
    """Every run of characters outside [A-Za-z0-9_] becomes one underscore."""
    return _NAME_RUN.sub("_", name)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns with :func:`clean_name`; refuse silent duplicates."""
    new = [clean_name(c) for c in df.columns]
    dup = {n for n in new if new.count(n) > 1}
    if dup:
        raise ValueError(f"column names collide after cleaning: {sorted(dup)}")
    return df.toDF(*new)


def numerical_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric (and boolean) columns, in schema order."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in ex
            and isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def categorical_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if f.name not in ex
            and isinstance(f.dataType, T.StringType)]


def select_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keep key/label columns plus the numeric ones, drop the rest."""
    keep = list(keep)
    return df.select(*keep, *numerical_cols(df, exclude=keep))


def drop_columns_like(df: DataFrame, pattern: str) -> DataFrame:
    """Drop every column whose name contains ``pattern`` (leakage guard)."""
    return df.drop(*[c for c in df.columns if pattern in c])


def split_xy(df: DataFrame, target: str) -> tuple[DataFrame, str]:
    """Keys, not positions: features and label stay in one frame; return the label name."""
    if target not in df.columns:
        raise KeyError(target)
    return df, target


# ---------------------------------------------------------------- encodings

# fixed values: season names and their codes
SEASON_CODES = {"Spring": 0, "Summer": 1, "Fall": 2, "Winter": 3}


def ordinal_encode(c: Column | str, mapping: Mapping[str, int], default: int = -1) -> Column:
    """Map string values to integer codes; empty, null and unknown give ``default``."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, F.col(c) if isinstance(c, str) else c), F.lit(default))


def encode_seasons(df: DataFrame, marker: str = "_Season",
                   mapping: Mapping[str, int] = SEASON_CODES) -> DataFrame:
    """Encode every column whose name contains ``marker``."""
    cols = [c for c in df.columns if marker in c]
    return df.withColumns({c: ordinal_encode(c, mapping) for c in cols}) if cols else df


def fill_constant(df: DataFrame, cols: Sequence[str], value=-1) -> DataFrame:
    """Explicit missing marker for the given columns."""
    present = [c for c in cols if c in df.columns]
    return df.fillna(value, subset=present) if present else df


def label_map(c: Column | str, labels: Mapping[int, str], missing: str = "Missing") -> Column:
    """Integer code to text, null to ``missing``."""
    m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_element_at(m, col), F.lit(missing))


def order_code(c: Column | str, order: Sequence[str]) -> Column:
    """Position of a category in a custom order (for ordered categoricals)."""
    return ordinal_encode(c, {v: i for i, v in enumerate(order)}, default=len(order))


# ---------------------------------------------------------------- arithmetic features

def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """a / b with null (not an error, not inf) on a zero or null denominator."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(a.cast("double"), b.cast("double"))


def feature_products(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """{out: (a, b)} -> out = a*b (null-propagating).  Missing inputs skip the feature."""
    ok = {k: (a, b) for k, (a, b) in spec.items() if a in df.columns and b in df.columns}
    return df.withColumns({k: F.col(a).cast("double") * F.col(b).cast("double")
                           for k, (a, b) in ok.items()}) if ok else df


def feature_ratios(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """{out: (a, b)} -> out = a/b, zero denominator gives null."""
    ok = {k: (a, b) for k, (a, b) in spec.items() if a in df.columns and b in df.columns}
    return df.withColumns({k: safe_ratio(a, b) for k, (a, b) in ok.items()}) if ok else df


# fixed values: the engineered survey features (name: (left, right))
SURVEY_PRODUCTS = {
    "BMI_Age": ("Physical_BMI", "Basic_Demos_Age"),
    "Internet_Hours_Age": ("PreInt_EduHx_computerinternet_hoursday", "Basic_Demos_Age"),
    "BMI_Internet_Hours": ("Physical_BMI", "PreInt_EduHx_computerinternet_hoursday"),
    "BFP_BMR": ("BIA_BIA_Fat", "BIA_BIA_BMR"),
    "BFP_DEE": ("BIA_BIA_Fat", "BIA_BIA_DEE"),
    "BMI_PHR": ("Physical_BMI", "Physical_HeartRate"),
}
SURVEY_RATIOS = {
    "BFP_BMI": ("BIA_BIA_Fat", "BIA_BIA_BMI"),
    "FFMI_BFP": ("BIA_BIA_FFMI", "BIA_BIA_Fat"),
    "FMI_BFP": ("BIA_BIA_FMI", "BIA_BIA_Fat"),
    "LST_TBW": ("BIA_BIA_LST", "BIA_BIA_TBW"),
    "BMR_Weight": ("BIA_BIA_BMR", "Physical_Weight"),
    "DEE_Weight": ("BIA_BIA_DEE", "Physical_Weight"),
    "SMM_Height": ("BIA_BIA_SMM", "Physical_Height"),
    "Muscle_to_Fat": ("BIA_BIA_SMM", "BIA_BIA_FMI"),
    "Hydration_Status": ("BIA_BIA_TBW", "Physical_Weight"),
    "ICW_TBW": ("BIA_BIA_ICW", "BIA_BIA_TBW"),
}
# fixed values: columns given an explicit -1 missing marker (option, off by default)
SURVEY_FILL_COLS = [
    "Basic_Demos_Sex", "FGC_FGC_CU", "FGC_FGC_CU_Zone",
    "FGC_FGC_GSD_Zone", "FGC_FGC_PU_Zone", "FGC_FGC_SRL_Zone",
    "FGC_FGC_GSND_Zone", "FGC_FGC_SRR_Zone", "FGC_FGC_TL_Zone",
]


# ---------------------------------------------------------------- bins

# fixed values: severity cut points on the 0-100 total score
SEVERITY_CUTS = (30.0, 50.0, 80.0)


def ordinal_bin(c: Column | str, cuts: Sequence[float], right: bool = False,
                labels: Sequence[int] | None = None, open_ends: bool = True) -> Column:
    """Bin a numeric column on sorted ``cuts``.

    ``right=False``: left-closed bins (-inf,c0), [c0,c1), ... [cn,inf).
    ``right=True`` : right-closed bins (-inf,c0], (c0,c1], ... (cn,inf).
    ``open_ends=False`` keeps only the inner bins (outside -> null), the
    ``pd.cut(x, cuts)`` behaviour.  Null in gives null out.
    """
    col = F.col(c) if isinstance(c, str) else c
    cuts = list(cuts)
    n_bins = len(cuts) + 1 if open_ends else len(cuts) - 1
    labels = list(labels) if labels is not None else list(range(n_bins))
    if len(labels) != n_bins:
        raise ValueError("labels must have one entry per bin")
    edges = ([-math.inf] + cuts + [math.inf]) if open_ends else cuts
    expr = None
    for i in range(n_bins):
        lo, hi = edges[i], edges[i + 1]
        if right:
            cond = (col > lo) & (col <= hi) if lo != -math.inf else (col <= hi)
        else:
            cond = (col >= lo) & (col < hi) if hi != math.inf else (col >= lo)
        if lo == -math.inf and hi == math.inf:
            cond = col.isNotNull()
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr


def scaled_class(score: Column | str, weight: float | Column = 1.0,
                 cuts: Sequence[float] = SEVERITY_CUTS) -> Column:
    """score * weight, then left-closed bins (the score -> class step)."""
    s = F.col(score) if isinstance(score, str) else score
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    return ordinal_bin(s * w, cuts, right=False)


def round_half_even(c: Column | str) -> Column:
    """Nearest integer, ties to even (regression output -> class)."""
    return F.rint(F.col(c) if isinstance(c, str) else c)


# ---------------------------------------------------------------- row-wise helpers

def row_sum(cols: Sequence[str]) -> Column:
    """Sum across columns skipping nulls; all-null gives 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])


def row_null_count(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols])


def any_null(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def all_present(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def keep_if_complete(value: Column | str, cols: Sequence[str]) -> Column:
    """Value only where every one of ``cols`` is present, else null."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(all_present(cols), v)


# fixed values: integer-total class boundaries (<=30, 31..49, 50..79, >=80)
CERTAIN_CUTS = (31.0, 50.0, 80.0)


def certain_class(total: Column | str, n_missing: Column, per_item_max: int = 5,
                  cuts: Sequence[float] = CERTAIN_CUTS) -> Column:
    """Severity class only if the unanswered items could not change it.

    ``max = total + per_item_max * n_missing``; the class is the left-closed
    bin of ``total`` on ``cuts`` and is kept only when ``max`` falls in the
    same bin (with the default cuts: <=30 -> 0, 31..49 -> 1, 50..79 -> 2,
    >=80 -> 3 for integer totals), otherwise null.
    """
    t = F.col(total) if isinstance(total, str) else total
    mx = t + F.lit(per_item_max) * n_missing
    bt, bm = ordinal_bin(t, cuts), ordinal_bin(mx, cuts)
    return F.when(bt == bm, bt)


def weighted_average(cols: Sequence[str], weights: Sequence[float]) -> Column:
    """Σ w_i p_i / Σ w_i across columns."""
    if len(cols) != len(weights):
        raise ValueError("one weight per column")
    tot = float(sum(weights))
    if tot == 0:
        raise ValueError("weights sum to zero")
    return reduce(lambda a, b: a + b, [F.col(c) * F.lit(float(w)) for c, w in zip(cols, weights)]) / F.lit(tot)


def round6(c: Column | str, digits: int = 6) -> Column:
    """Half-up decimal rounding built from IEEE operations only.

    ``floor(x * 10^d + 0.5) / 10^d`` gives bit-identical results in every
    engine (``round`` differs between engines on near-ties), so reported
    figures can be compared by hash.
    """
    col = F.col(c) if isinstance(c, str) else c
    s = float(10 ** digits)
    return (F.floor(col.cast("double") * F.lit(s) + F.lit(0.5)) / F.lit(s)).cast("double")
