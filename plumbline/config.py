"""Test parameters. Plain driver-side values that become column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class GrossRange:
    fail: tuple[float, float]
    suspect: tuple[float, float]


@dataclass(frozen=True)
class Attenuated:
    suspect: float
    fail: float
    check: str  # "range" or "std"


@dataclass(frozen=True)
class Inversion:
    suspect: float
    fail: float


@dataclass(frozen=True)
class VariableTests:
    gross_range: GrossRange | None = None
    rate_of_change: float | None = None
    attenuated: Attenuated | None = None
    inversion: Inversion | None = None


@dataclass(frozen=True)
class QueryRule:
    """Rows where ``predicate`` (Spark SQL) holds get ``value`` in ``columns``."""

    predicate: str
    columns: tuple[str, ...]
    value: int


@dataclass(frozen=True)
class DoCap:
    variables: tuple[str, ...] = ("dissolved_oxygen_ml_l", "rinko_do_ml_l")
    bin_size: float = 1.0
    suspect: float = 0.2
    fail: float = 0.5
    ratio: float = 0.5
    min_bins: int = 30


@dataclass(frozen=True)
class StationDepth:
    suspect_ratio: float = 1.1
    fail_ratio: float = 1.25
    suspect_range: float = 30.0
    fail_range: float = 50.0


# Thresholds per variable.
_OXYGEN_ML = VariableTests(GrossRange((0, 20), (1, 15)), 3, Attenuated(0.1, 0.01, "range"))
_VERTICAL = VariableTests(GrossRange((0, 12000), (0, 12000)))
VARIABLE_TESTS = {
    "c_star_at": VariableTests(attenuated=Attenuated(0.002, 0.0001, "range")),
    "conductivity": VariableTests(GrossRange((-0.1, 100), (0, 100))),
    "depth": _VERTICAL,
    "dissolved_oxygen_ml_l": _OXYGEN_ML,
    "dissolved_oxygen_percent": VariableTests(
        GrossRange((-1, 200), (0, 170)), 30, Attenuated(0.1, 0.01, "range")),
    "flc": VariableTests(GrossRange((-0.5, 150), (-0.1, 80))),
    "par": VariableTests(GrossRange((-2, 100000), (-1, 50000)), attenuated=Attenuated(0.05, 0.02, "std")),
    "pressure": _VERTICAL,
    "rinko_do_ml_l": _OXYGEN_ML,
    "salinity": VariableTests(GrossRange((0, 45), (2, 42)), 5),
    "sigma0": VariableTests(inversion=Inversion(-0.005, -0.03)),
    "temperature": VariableTests(GrossRange((-2, 100), (-2, 40)), 5),
    "turbidity": VariableTests(GrossRange((-0.1, 10000), (0, 1000)), attenuated=Attenuated(0.01, 0.001, "range")),
}

# Which test columns feed which variable, besides its own.
AGGREGATION_DEFAULT = (
    "bottom_hit_test",
    "depth_in_station_range_test",
    "pressure_qartod_gross_range_test",
    "depth_qartod_gross_range_test",
    "hakai_short_static_deployment_test",
)
AGGREGATION_EXTRA = {
    "temperature": ("sigma0_qartod_density_inversion_test",),
    "salinity": ("sigma0_qartod_density_inversion_test",),
    "conductivity": ("sigma0_qartod_density_inversion_test",),
    "dissolved_oxygen_ml_l": ("dissolved_oxygen_ml_l_hakai_do_cap_test",),
    "dissolved_oxygen_percent": (
        "dissolved_oxygen_ml_l_hakai_do_cap_test", "dissolved_oxygen_ml_l_hakai_no_soak_test"),
}

# Sensors known to sit under water at the wrong place.
_NATURE_TRUST = "organization = 'NATURE TRUST' AND sensors_submerged = '{where}' AND {var} IS NOT NULL"
QUERY_RULES = (
    QueryRule(_NATURE_TRUST.format(where="Mid", var="par"), ("par_hakai_sensor_mid_submerged_test",), 4),
    QueryRule(_NATURE_TRUST.format(where="Bottom", var="par"), ("par_hakai_sensor_bottom_submerged_test",), 4),
    QueryRule(
        _NATURE_TRUST.format(where="Bottom", var="dissolved_oxygen_ml_l"),
        ("dissolved_oxygen_percent_hakai_sensor_bottom_submerged_test",
         "dissolved_oxygen_ml_l_hakai_sensor_bottom_submerged_test"), 4),
)

# Documented only, run on request: spike thresholds (suspect, fail) and the position test.
SPIKE = {
    "dissolved_oxygen_ml_l": (0.5, 1.0),
    "dissolved_oxygen_percent": (20.0, 40.0),
    "rinko_do_ml_l": (0.5, 1.0),
    "c_star_at": (0.5, 1.0),
    "salinity": (0.5, 1.0),
}
LOCATION_RANGE_M = 3000.0
LOCATION_BBOX = (-180.0, -90.0, 180.0, 90.0)

DEFAULT_STAGES = ("8_binAvg", "8_rbr_processed")
QCED_STAGE = "9_qc_auto"


@dataclass(frozen=True)
class UserTest:
    """A test of your own that looks at most ``back`` rows up and ``ahead`` rows down its profile.

    ``fn`` adds columns; its windows are ``layout.ordered(df)``, so that they also hold where a large cast is cut.
    """

    fn: Callable[[DataFrame], DataFrame]
    back: int = 0
    ahead: int = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.fn(df)


@dataclass(frozen=True)
class QCConfig:
    variables: dict[str, VariableTests] = field(default_factory=lambda: VARIABLE_TESTS)
    do_cap: DoCap = DoCap()
    station_depth: StationDepth = StationDepth()
    par_shadow_min: float = 5.0
    query_rules: tuple[QueryRule, ...] = QUERY_RULES
    aggregation_default: tuple[str, ...] = AGGREGATION_DEFAULT
    aggregation_extra: dict[str, tuple[str, ...]] = field(default_factory=lambda: AGGREGATION_EXTRA)
    include_par_shadow: bool = False  # let par_shadow_test feed par
    bad_value_text: bool = False  # also name the bad-value test in the text flag
    # Tests of your own: a ``UserTest``, or a function that adds a column to rows laid out by ``layout.per_cast``, where a
    # large cast is cut into chunks, so whole-group work goes through the helpers of ``layout``. A column
    # named ``{var}_hakai_...`` or ``{var}_qartod_...`` feeds that variable's flags.
    user_tests: tuple[Callable[[DataFrame], DataFrame], ...] = ()

    def tested(self) -> list[str]:
        return list(self.variables)
