"""Defaults shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# Column names, labels and numbers that results depend on.
FEATURES = ("ret_1d_w", "zscore_7", "ret_std_7", "ret_std_30", "ma_gap_7", "ma_gap_30")

CALM = "Calm / normal"
CHOPPY = "Choppy high-vol sideways"
SELLOFF = "Sell-off / drawdown"
BLOWOFF = "Blow-off rally / parabolic"
BULL = "Bull impulse"
REGIMES = (CALM, CHOPPY, SELLOFF, BLOWOFF, BULL)

# Column that holds each regime's share of the entities on a date.
BREADTH_COLUMNS = {
    CALM: "frac_calm",
    CHOPPY: "frac_choppy",
    SELLOFF: "frac_sello",
    BLOWOFF: "frac_blowoff",
    BULL: "frac_bull",
}

EXPERIMENT_ORDER = ("B0", "G1", "S1", "S2", "A1", "J1", "C1", "R1", "P1", "P2", "X5", "X10")
STEPS = tuple(range(1, 8))
THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
ARROW = " → "

EXCLUDED_SYMBOLS = ("USDT", "USDC")
LEAD_SYMBOL = "BTC"
EVENT_DATE = "2020-03-12"
SEED = 42


@dataclass(frozen=True)
class FeatureSettings:
    """Numbers that shape the rolling features."""

    short: int = 7
    long: int = 30
    winsor_low: float = 0.025
    winsor_high: float = 0.975
    sigma_floor: float = 1e-4
    min_short: int = 5
    min_long: int = 10
    burn_in: int = 14
    log_returns: bool = True
    accuracy: int = 10_000


ANOMALY_Z = 3.0
WIDESPREAD_DOWN = 5
TOP_K = 10
