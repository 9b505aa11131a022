"""Scalar rules as Column expressions; all of them stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.96


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def rnd(c, digits: int) -> Column:
    """Round half up, tolerant to float noise from the order of a distributed sum.

    ``F.round`` looks at the shortest decimal form, so 0.12345 and
    0.12344999999999999 (the same mean, added up in another order) would give
    different answers; the small shift makes both go up. NaN and infinities pass
    through, and so, to the last bit, do values without digits left to round. The argument is named
    once, so nested roundings do not multiply the generated code; adding 0.0
    turns a negative zero into zero.
    """
    scale = float(10**digits)
    return (F.rint(_c(c).cast("double") * scale + 1e-7) + 0.0) / F.lit(scale)


def clamp(c, lo, hi) -> Column:
    """NULL stays NULL (least/greatest alone would skip it)."""
    c = _c(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), c)))


def ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(~F.isnan(c), c)


def wilson_bounds(successes, n, z: float = Z95) -> tuple[Column, Column]:
    """Wilson score interval, clamped to [0, 1], 4 digits; (0, 0) for n = 0."""
    s, n = _c(successes).cast("double"), _c(n).cast("double")
    p = F.try_divide(s, n)
    denom = 1 + F.try_divide(F.lit(z * z), n)
    centre = (p + F.try_divide(F.lit(z * z), 2 * n)) / denom
    spread = (
        z
        * F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(z * z), 4 * n * n))
        / denom
    )
    lo = F.when(n == 0, 0.0).otherwise(rnd(F.greatest(F.lit(0.0), centre - spread), 4))
    hi = F.when(n == 0, 0.0).otherwise(rnd(F.least(F.lit(1.0), centre + spread), 4))
    return lo, hi


# Coefficients of the rational erf approximation 7.1.26 in
# Abramowitz & Stegun, absolute error below 1.5e-7.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def norm_cdf(z) -> Column:
    """Standard normal CDF; Spark has no erf."""
    x = F.abs(_c(z)) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + ERF_P * x)
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = t * (a + poly)
    erf = 1.0 - poly * F.exp(-x * x)
    return 0.5 * (1.0 + F.when(_c(z) < 0, -erf).otherwise(erf))


def proportion_p_value(share, n, against: float = 0.5) -> Column:
    """Two-sided z-test of a share against a fixed proportion."""
    se = F.greatest(F.sqrt(F.lit(against * (1 - against)) / _c(n)), F.lit(1e-10))
    return 2.0 * (1.0 - norm_cdf(F.abs(_c(share) - against) / se))


def bucket_right_open(value, edges: list[tuple[str, float, float]]) -> Column:
    """Label of the first [lo, hi) that holds the value."""
    value = _c(value)
    out = None
    for label, lo, hi in edges:
        cond = (value >= lo) & (value < hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def bucket_right_closed(value, edges: list[tuple[str, float, float]]) -> Column:
    """Label of the first (lo, hi] that holds the value."""
    value = _c(value)
    out = None
    for label, lo, hi in edges:
        cond = (value > lo) & (value <= hi)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def keyword_category(text, keywords: list[tuple[str, str]]) -> Column:
    """Category of the first contained keyword; empty text is 'unknown', no hit 'other'."""
    text = _c(text)
    out = F.when(text.isNull() | (text == ""), "unknown")
    for word, category in keywords:
        out = out.when(F.contains(F.lower(text), F.lit(word)), category)
    return out.otherwise("other")


# Keyword order decides which category wins.
ENTRY_TRIGGERS = [
    ("pullback", "pullback"),
    ("vwap", "vwap"),
    ("support", "support"),
    ("time_expiry", "time_expiry"),
]
POST_TRADE_TRIGGERS = ENTRY_TRIGGERS + [("expiry", "time_expiry")]
EXIT_RULES = [
    (w, w)
    for w in (
        "trailing_stop",
        "profit_take",
        "time_decay",
        "collapse",
        "signal_exit",
        "research_exit",
        "momentum",
    )
]


def fill_hour(fill_time) -> Column:
    """Hour of ISO text (date, T, clock) or of a plain clock text; NULL if malformed."""
    clock = F.element_at(F.split(_c(fill_time), "T"), -1)
    return F.element_at(F.split(clock, ":"), 1).try_cast("int")


def time_of_day(fill_time) -> Column:
    hour = fill_hour(fill_time)
    return (
        F.when(hour.isNull(), "unknown")
        .when(hour < 10, "early (pre-10)")
        .when(hour < 12, "morning (10-12)")
        .when(hour < 14, "midday (12-14)")
        .otherwise("afternoon (14+)")
    )


def direction_of(ret, band: float = 0.005) -> Column:
    """UP / FLAT / DOWN with strict limits; ``band`` is in the unit of the return."""
    ret = _c(ret)
    return (
        F.when(ret.isNull(), F.lit(None).cast("string"))
        .when(ret > band, "UP")
        .when(ret < -band, "DOWN")
        .otherwise("FLAT")
    )


def net_signal(p_up, p_down) -> Column:
    """p_up - p_down; anything not numeric counts as 0."""
    def as_number(c):
        return F.coalesce(_c(c).cast("string").try_cast("double"), F.lit(0.0))

    return as_number(p_up) - as_number(p_down)


def conviction_of(alpha) -> Column:
    alpha = _c(alpha)
    return (
        F.when(alpha >= 0.02, "rising").when(alpha <= -0.01, "declining").otherwise("stable")
    )


def drift_class(training_ic, production_ic, noise: float = 0.005) -> Column:
    t, p = _c(training_ic), _c(production_ic)
    flipped = ((t > noise) & (p < -noise)) | ((t < -noise) & (p > noise))
    return (
        F.when(flipped, "sign_flip")
        .when((F.abs(t) > noise) & (F.abs(p) < noise), "decayed")
        .otherwise("stable")
    )


# --- technical scores -------------------------------------------------------

def rsi_score(rsi, regime) -> Column:
    """Linear between oversold (full marks) and overbought (0); bands per regime."""
    regime = _c(regime)
    cautious = regime.isin("bear", "caution")
    top = F.when(regime == "bull", 80.0).otherwise(70.0)
    bottom = F.when(cautious, 40.0).otherwise(30.0)
    full = F.when(cautious, 65.0).otherwise(100.0)
    r = F.coalesce(_c(rsi), F.lit(50.0))
    return (
        F.when(r >= top, 0.0).when(r <= bottom, full).otherwise(full * (top - r) / (top - bottom))
    )


def macd_score(cross, above_zero) -> Column:
    cross, above = F.coalesce(_c(cross), F.lit(0.0)), F.coalesce(_c(above_zero), F.lit(False))
    return (
        F.when(cross == 1.0, F.when(above, 100.0).otherwise(70.0))
        .when(cross == -1.0, F.when(above, 30.0).otherwise(0.0))
        .otherwise(F.when(above, 60.0).otherwise(40.0))
    )


def average_distance_score(pct) -> Column:
    """Four linear pieces over the percent distance from a moving average."""
    p = _c(pct)
    return (
        F.when(p.isNull(), 50.0)
        .when(p >= 5, F.least(F.lit(100.0), 80.0 + (p - 5) * (20.0 / 15.0)))
        .when(p >= 0, 50.0 + p * 6.0)
        .when(p > -5, 50.0 + p * 4.0)
        .otherwise(F.greatest(F.lit(0.0), 30.0 - (F.abs(p) - 5) * 1.5))
    )


def momentum_score(momentum, percentile=None) -> Column:
    fallback = F.coalesce(clamp(50.0 + _c(momentum) * 3.0, 0, 100), F.lit(50.0))
    return fallback if percentile is None else F.coalesce(_c(percentile), fallback)


def technical_score(rsi, cross, above_zero, ma50, ma200, momentum, percentile, regime) -> Column:
    total = (
        rsi_score(rsi, regime) * 0.25
        + macd_score(cross, above_zero) * 0.20
        + average_distance_score(ma50) * 0.20
        + average_distance_score(ma200) * 0.20
        + momentum_score(momentum, percentile) * 0.15
    )
    return rnd(clamp(total, 0, 100), 2)


# --- grades -----------------------------------------------------------------

# Lowest score of each letter.
LETTER_BANDS = [
    (90, "A"), (80, "A-"), (73, "B+"), (65, "B"), (58, "B-"), (50, "C+"),
    (42, "C"), (35, "C-"), (28, "D+"), (20, "D"), (0, "F"),
]


def letter(score) -> Column:
    score = _c(score)
    out = F.when(score.isNull(), "N/A")
    for floor, name in LETTER_BANDS:
        out = out.when(score >= floor, name)
    return out.otherwise("F")


def pct_grade(pct, baseline, ceiling) -> Column:
    """baseline -> 30, ceiling -> 95, linear, clamped."""
    b, c = F.lit(baseline) if not isinstance(baseline, Column) else baseline, (
        F.lit(ceiling) if not isinstance(ceiling, Column) else ceiling
    )
    pct = _c(pct)
    return F.when(pct.isNotNull() & (b == c), 50.0).otherwise(
        clamp(30.0 + F.try_divide(pct - b, c - b) * 65.0, 0, 100)
    )


def lift_grade(lift, floor, ceiling) -> Column:
    """floor -> 0, zero -> 40, ceiling -> 100."""
    f = F.lit(floor) if not isinstance(floor, Column) else floor
    c = F.lit(ceiling) if not isinstance(ceiling, Column) else ceiling
    lift = _c(lift)
    below = F.when(f == 0, 40.0).otherwise(40.0 * (1.0 - F.try_divide(lift, f)))
    above = F.when(c == 0, 40.0).otherwise(40.0 + 60.0 * F.try_divide(lift, c))
    return clamp(F.when(lift <= 0, below).when(lift > 0, above), 0, 100)


def ic_grade(ic) -> Column:
    return clamp(20.0 + _c(ic) * 700.0, 0, 100)


def ratio_grade(value, target) -> Column:
    """0 -> 0, target -> 80, 1 -> 100."""
    t = F.lit(target) if not isinstance(target, Column) else target
    v = _c(value)
    return (
        F.when(v <= 0, 0.0)
        .when(v >= 1.0, 100.0)
        .when(v <= t, 80.0 * (v / t))
        .when(v > t, 80.0 + 20.0 * F.try_divide(v - t, 1.0 - t))
    )


# --- position sizing --------------------------------------------------------

def sector_multiplier(rating, overweight, market_weight, underweight) -> Column:
    r = _c(rating)
    return (
        F.when(r == "overweight", _c(overweight))
        .when(r == "underweight", _c(underweight))
        .otherwise(_c(market_weight))
    )


def conviction_multiplier(conviction, declining) -> Column:
    return F.when(_c(conviction) == "declining", _c(declining)).otherwise(1.0)


def upside_multiplier(upside, least_upside, penalty) -> Column:
    return F.when(_c(upside) < _c(least_upside), _c(penalty)).otherwise(1.0)


def atr_multiplier(atr_pct, enabled, target_risk, floor, ceiling) -> Column:
    a = _c(atr_pct)
    raw = F.least(F.greatest(F.try_divide(_c(target_risk), a), _c(floor)), _c(ceiling))
    return F.when(_c(enabled) & (a > 0), raw).otherwise(1.0)


def confidence_multiplier(confidence, p_up, enabled, base, span, use_p_up, blend) -> Column:
    conf = F.when(_c(enabled) & _c(confidence).isNotNull(),
                  _c(base) + _c(span) * clamp(confidence, 0, 1)).otherwise(1.0)
    mixed = conf * (1 - _c(blend)) + (0.7 + 0.6 * clamp(p_up, 0, 1)) * _c(blend)
    return F.when(_c(use_p_up) & _c(p_up).isNotNull(), mixed).otherwise(conf)


def staleness_multiplier(age_days, enabled, cadence, decay, floor) -> Column:
    late = F.greatest(F.lit(0), _c(age_days) - _c(cadence)).cast("double")
    return F.when(_c(enabled) & (late > 0),
                  F.greatest(1.0 - _c(decay) * late, _c(floor))).otherwise(1.0)


def earnings_multiplier(days_to_earnings, enabled, within_days, reduction) -> Column:
    d = _c(days_to_earnings)
    return F.when(_c(enabled) & (d >= 0) & (d <= _c(within_days)),
                  1.0 - _c(reduction)).otherwise(1.0)


def coverage_multiplier(coverage, enabled, floor) -> Column:
    c = _c(coverage)
    return F.when(_c(enabled) & c.isNotNull(),
                  F.greatest(clamp(c, 0, 1), _c(floor))).otherwise(1.0)


# Drawdown tiers, shallow to deep, as (drawdown, multiplier).
DRAWDOWN_TIERS = [(-0.02, 0.75), (-0.04, 0.50), (-0.06, 0.25)]


def drawdown_multiplier(drawdown, breaker, tiers=None) -> Column:
    """Multiplier of the deepest breached tier; 0 at the circuit breaker."""
    dd = _c(drawdown)
    out = F.when(dd <= -_c(breaker), 0.0)
    for limit, mult in reversed(tiers or DRAWDOWN_TIERS):
        out = out.when(dd <= limit, mult)
    return out.otherwise(1.0)


def signal_age_days(trading_date, signal_date) -> Column:
    return F.datediff(_c(trading_date), _c(signal_date))


def random_trials_needed(top_fraction, confidence) -> Column:
    """Draws needed to hit the best ``top_fraction`` of a grid with ``confidence``."""
    return F.ceil(F.log(1 - _c(confidence)) / F.log(1 - _c(top_fraction)))


def automatic_trials(grid_size, share: float = 0.25, least: int = 50, most: int = 400) -> Column:
    n = _c(grid_size)
    return F.least(F.greatest(F.lit(least), F.least(F.ceil(n * share), F.lit(most))), n)


def hit_probability(trials, top_fraction: float = 0.05) -> Column:
    return 1 - F.pow(F.lit(1 - top_fraction), _c(trials))
