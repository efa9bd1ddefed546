"""Column-expression builders.

Pure ``Column -> Column`` helpers: they add no job and no shuffle, stay inside
whole-stage codegen and can be used in any ``select``/``withColumns``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------
# Sentinel for "never contacted before" in the days-since-contact column.
NEVER_CONTACTED = 999
# Confidence bands of a single verdict (probability lower bounds).
VERY_HIGH_BAND = 0.60
HIGH_BAND = 0.35
# Expected value of one call: value of a subscriber and cost of one call.
EV_SUBSCRIBER_VALUE = 200.0
EV_CALL_COST = 5.0
# Scoring sanitiser: NaN / Inf become 0, values are clipped to +-1e9.
SANITISE_LIMIT = 1e9
# Documented non-linear bins: (edges, labels); bins are right-closed.
FIXED_BINS = {
    "age": ([0, 30, 45, 60, float("inf")], ["young", "prime", "middle", "senior"]),
    "campaign": ([0, 2, 5, float("inf")], ["low", "moderate", "high"]),
    "euribor3m": ([float("-inf"), 1.5, 3.5, float("inf")], ["low_rate", "mid_rate", "high_rate"]),
}
# Months and weekdays in calendar order (the data holds them as strings).
MONTH_ORDER = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
WEEKDAY_ORDER = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
# Reason codes of a scored lead (positive and negative drivers).
STRONG_MONTHS = ["mar", "sep", "oct", "dec"]
HIGH_VALUE_JOBS = ["retired", "student"]


def _c(col: str | Column) -> Column:
    return F.col(f"`{col}`") if isinstance(col, str) else col


# ---------------------------------------------------------------------------
# Sentinel handling
# ---------------------------------------------------------------------------
def contacted_flag(col: str | Column = "pdays", sentinel: int = NEVER_CONTACTED) -> Column:
    """1 when the value is a real day count, 0 for the sentinel (NULL stays NULL)."""
    return (_c(col) != F.lit(sentinel)).cast("int")


def sentinel_log(col: str | Column = "pdays", sentinel: int = NEVER_CONTACTED) -> Column:
    """log1p(days) for real values, 0.0 for the sentinel."""
    c = _c(col)
    return F.when(c != F.lit(sentinel), F.log1p(c.cast("double"))).when(c == F.lit(sentinel), F.lit(0.0))


def sentinel_split(
    df: DataFrame,
    col: str = "pdays",
    sentinel: int = NEVER_CONTACTED,
    flag_col: str = "was_previously_contacted",
    log_col: str = "pdays_log",
    drop: bool = True,
) -> DataFrame:
    """Replace a sentinel-coded column by a contacted flag and a log-days column."""
    out = df.withColumns({flag_col: contacted_flag(col, sentinel), log_col: sentinel_log(col, sentinel)})
    return out.drop(col) if drop else out


# ---------------------------------------------------------------------------
# Binning
# ---------------------------------------------------------------------------
def cut_bins(col: str | Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]``; values outside every bin give NULL.

    Returns the label when given, else the 1-based bin index.
    """
    c = _c(col)
    if labels is not None and len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        val = F.lit(labels[i]) if labels is not None else F.lit(i + 1)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def bin_label(col: str | Column, edges: Sequence[float]) -> Column:
    """Interval text ``(lo, hi]`` of a right-closed bin, NULL outside."""
    labels = [f"({_fmt(edges[i])}, {_fmt(edges[i + 1])}]" for i in range(len(edges) - 1)]
    return cut_bins(col, edges, labels)


def _fmt(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def fixed_bins(df: DataFrame, columns: Sequence[str] | None = None, suffix: str = "_bin") -> DataFrame:
    """Add the documented domain bins (age, campaign, euribor3m) as label columns."""
    cols = [c for c in (columns or FIXED_BINS) if c in df.columns]
    return df.withColumns({f"{c}{suffix}": cut_bins(c, *FIXED_BINS[c]) for c in cols})


def equal_width_index(col: str | Column, lo: Column, hi: Column, n: int) -> Column:
    """Bin index 1..n of equal-width bins over [lo, hi], right-closed.

    The lowest edge is widened so ``lo`` itself falls into bin 1; inner edges
    are ``lo + i*(hi-lo)/n``.  Written as a count of edges below the value so
    values that sit exactly on an edge land where right-closed bins put them.
    """
    c = _c(col)
    step = (hi - lo) / F.lit(n)
    idx = F.lit(1)
    for i in range(1, n):
        idx = idx + F.when(c > F.lit(i) * step + lo, 1).otherwise(0)
    return F.when(c.isNotNull() & ~F.isnan(c.cast("double")), idx)


def cap_value(col: str | Column, upper: float) -> Column:
    """Upper clip; NULL stays NULL and NaN stays NaN."""
    c = _c(col)
    return F.when((c > F.lit(upper)) & ~F.isnan(c), F.lit(upper)).otherwise(c)


# ---------------------------------------------------------------------------
# Scores -> decisions
# ---------------------------------------------------------------------------
def threshold_predict(prob: str | Column, threshold: float | Column) -> Column:
    """1 when ``prob >= threshold`` else 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (_c(prob) >= t).cast("int")


def confidence_band(prob: str | Column, threshold: float) -> Column:
    p = _c(prob)
    t = float(threshold)
    return (
        F.when(p >= F.lit(VERY_HIGH_BAND), "Very High Confidence")
        .when(p >= F.lit(HIGH_BAND), "High Confidence")
        .when(p >= F.lit(t), "Moderate Confidence")
        .when(p >= F.lit(t * 0.5), "Low Confidence")
        .otherwise("Very Low")
    )


def expected_value(prob: str | Column) -> Column:
    """Expected dollars of one call: p*200 - (1-p)*5."""
    p = _c(prob)
    return p * F.lit(EV_SUBSCRIBER_VALUE) - (F.lit(1.0) - p) * F.lit(EV_CALL_COST)


def verdict_columns(prob: str | Column, threshold: float) -> dict[str, Column]:
    """The columns of a verdict: call flag, verdict text, action, band, expected value."""
    call = _c(prob) >= F.lit(float(threshold))
    return {
        "will_subscribe": call,
        "verdict": F.when(call, "LIKELY TO SUBSCRIBE").otherwise("UNLIKELY TO SUBSCRIBE"),
        "action": F.when(call, "Recommended Action: Call this customer").otherwise(
            "Recommended Action: Skip — focus resources elsewhere"
        ),
        "confidence": confidence_band(prob, threshold),
        "expected_value": expected_value(prob),
    }


def verdict(df: DataFrame, prob: str = "probability", threshold: float = 0.30) -> DataFrame:
    return df.withColumns(verdict_columns(prob, threshold))


def reason_codes(
    poutcome: str = "poutcome",
    contact: str = "contact",
    euribor: str = "euribor3m",
    job: str = "job",
    month: str = "month",
    campaign: str = "campaign",
    age: str = "age",
    pdays: str = "pdays",
    housing: str = "housing",
    loan: str = "loan",
    employed: str = "nr.employed",
) -> tuple[Column, Column]:
    """Positive and negative reason lists of a lead as two ``array<string>`` columns.

    A missing value behaves like the absent-key default of a single lookup:
    euribor 5 / 0, campaign 0 / 99, age 0, pdays 999, employed 5200.
    """
    col = lambda n: F.col(f"`{n}`")  # noqa: E731  (names may contain dots)
    eur = col(euribor)
    camp = col(campaign)
    ag = F.coalesce(col(age), F.lit(0))
    pd_ = F.coalesce(col(pdays), F.lit(NEVER_CONTACTED))
    emp = F.coalesce(col(employed), F.lit(5200.0))
    title = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))
    pos = F.array_compact(
        F.array(
            F.when(col(poutcome) == "success", F.lit("Previous campaign: Success")),
            F.when(F.coalesce(col(contact) == "cellular", F.lit(False)), F.lit("Mobile contact")),
            F.when(F.coalesce(eur, F.lit(5.0)) < 2, F.lit("Low interest rates")),
            F.when(col(job).isin(*HIGH_VALUE_JOBS), F.concat(title(col(job)), F.lit(" - high-value"))),
            F.when(col(month).isin(*STRONG_MONTHS), F.concat(F.lit("Strong month ("), title(col(month)), F.lit(")"))),
            F.when(
                ~(F.coalesce(camp, F.lit(0)) > 5) & (F.coalesce(camp, F.lit(99)) <= 2),
                F.lit("Fresh lead (2 or fewer calls)"),
            ),
            F.when(ag > 60, F.lit("Senior (60+)")).when(ag < 30, F.lit("Young (<30)")),
            F.when((pd_ > 0) & (pd_ < 30), F.lit("Recently contacted")),
            F.when((col(housing) == "no") & (col(loan) == "no"), F.lit("No existing loans")),
            F.when(emp < 5100, F.lit("Receptive market")),
        )
    )
    neg = F.array_compact(
        F.array(
            F.when(col(poutcome) == "failure", F.lit("Previous campaign: Failed")),
            F.when(~F.coalesce(col(contact) == "cellular", F.lit(False)), F.lit("Landline contact")),
            F.when(~(F.coalesce(eur, F.lit(5.0)) < 2) & (F.coalesce(eur, F.lit(0.0)) > 4), F.lit("High interest rates")),
            F.when(
                F.coalesce(camp, F.lit(0)) > 5,
                F.concat(camp.cast("string"), F.lit(" calls - diminishing returns")),
            ),
        )
    )
    return pos, neg


# ---------------------------------------------------------------------------
# Sanitising numerics before scoring
# ---------------------------------------------------------------------------
def sanitised(col: str | Column, limit: float = SANITISE_LIMIT) -> Column:
    """NULL, NaN, +-Inf -> 0, then clip to [-limit, limit]."""
    c = _c(col).cast("double")
    bad = c.isNull() | F.isnan(c) | c.isin(float("inf"), float("-inf"))
    return F.greatest(F.least(F.when(bad, F.lit(0.0)).otherwise(c), F.lit(limit)), F.lit(-limit))


def quoted(name: str) -> Column:
    """Column reference that tolerates dots in the name."""
    return F.col(f"`{name}`")
