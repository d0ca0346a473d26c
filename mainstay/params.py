"""Parameters of the analysis as frozen records. Defaults are the documented values."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Flags, codes and texts that results are compared by.
FIRST_SEGMENT_ID = 40_000_000
INSPECTION_CURRENT = 1
INSPECTION_NO_INSTALL_DATE = 2
INSPECTION_BEFORE_INSTALL = 3
INSPECTION_NONE = 4
ACTION_IN_REPLACEMENT = 0
ACTION_NOTHING = 1
ACTION_SPOT = 3
STATUS_TBAB = "TBAB"
STATUS_ABAN = "ABAN"
STATUS_PEND = "PEND"
STATUS_NEW = "NEW"
MATERIAL_CHANGE = "MATERIAL"
MATERIAL_VARIES = "VARIES"
MATERIAL_VSP = "MAT-VSP"
MATERIAL_PREFIX = "MAT-"
STAMP_ORIGINAL_VSP = "1_VSP"
STAMP_ORIGINAL = "1_"
STAMP_REPLACED = "2_"
SAGGING_SEVERITIES = ("A25", "B50", "CUW")
OVALING_SEVERITIES = ("BRKO", "OS")
OWNER = "BES"
OWNER_REMARKS = ("BES", "_BES")
LATERAL_CODE = 1012
LATERAL_EXCLUDED = (1083, 1084, 1085, 1086)
FREEWAY_STREET_CODES = (1110, 1121, 1122, 1123, 1200)
MAINTAINED_UNITS_SANITARY = ("saml", "csml", "csint", "saint", "csdet", "csotn", "embpg")
MAINTAINED_UNITS_STORM = ("stml", "csml", "csint", "saint", "csdet", "csotn", "embpg")
ALTERNATE_GRADE = "OFID"
BAD_SCORE = 1000.0


@dataclass(frozen=True)
class LifeRules:
    sd_years: float = 0.1
    sd_age: float = 0.25
    sd_floor: float = 5.0
    replacement_sd_share: float = 0.2
    replacement_sd_floor: float = 3.0
    replacement_age: float = 40.0
    risk_start_year: int = 1975
    risk_horizon: int = 240
    risk_max_sd: int = 50
    discount: float = 1.025
    whole_years: int = 120
    whole_sd: int = 12
    liner_years: int = 60
    liner_sd: int = 6
    spot_years: int = 30
    spot_sd: int = 4
    line_at_year: int = 30
    emergency_factor: float = 1.4
    present_value_cap: float = 0.6
    whole_weight: float = 0.25
    liner_weight: float = 0.36
    liner_early_share: float = 0.66
    liner_late_factor: float = 3.0


@dataclass(frozen=True)
class Windows:
    spot_years: int = 20
    line_years: int = 40
    liner_life: int = 60


@dataclass(frozen=True)
class Markups:
    general: float = 0.10
    waste: float = 0.05
    contingency: float = 0.25
    management: float = 0.15
    design: float = 0.20
    public: float = 0.03
    startup: float = 0.01

    @property
    def conditions(self) -> float:
        return 1.0 + self.general + self.waste

    @property
    def reserve(self) -> float:
        return 1.0 + self.contingency

    @property
    def delivery(self) -> float:
        return 1.0 + self.management + self.design + self.public + self.startup


@dataclass(frozen=True)
class UnitCosts:
    water_per_inch: float = 7.9126
    water_base: float = 74.093
    crossing: float = 5000.0
    hazard: float = 50.0
    hazard_length: float = 50.0
    mitigation: float = 150_000.0
    mitigation_width: float = 25.0
    asphalt_removal: float = 8.12
    extra_width: float = 1.0
    base_depth: float = 0.6666667
    base_course: float = 29.52
    patch_eight_inch: float = 55.77
    patch_six_inch: float = 44.27
    patch_four_inch: float = 28.62
    zone_inches: float = 18.0
    fill: float = 27.3
    backfill: float = 70.55
    saw_length: float = 4.0
    saw_cost: float = 4.21
    spoil_factor: float = 1.2
    haul: float = 4.72
    shoring_area: float = 2.0
    shoring_cost: float = 2.57
    shoring_depth: float = 18.0
    boring: float = 566.95
    boring_growth: float = 0.0119
    bore_depth: float = 25.0
    base_index: float = 8090.0
    current_index: float = 9835.0
    jacking_index: float = 9500.0
    lateral: float = 5000.0
    lateral_emergency: float = 1.4
    lateral_index: float = 1.7375
    liner_days: float = 3.0
    liner_cleaning: float = 3.0
    liner_adjustment: float = 1.2


@dataclass(frozen=True)
class TimeRates:
    hours_per_day: float = 8.0
    excavate_per_day: float = 140.0
    pave_per_day: float = 250.0
    crossing_days: float = 0.5
    fast_bore: float = 100.0
    slow_bore: float = 50.0
    small_bore: float = 24.0
    large_bore: float = 60.0
    grout_days: float = 2.0
    cipp_days: float = 3.0
    spot_depth: float = 20.0
    shallow_spot: float = 4.0
    deep_spot: float = 8.0
    traffic_street: float = 1.0
    traffic_arterial: float = 2.0
    traffic_major: float = 3.0
    shallow_trench: float = 20.0
    small_bypass: float = 15.0
    manhole_per_day: float = 10.0
    manhole_min_depth: float = 10.0
    lateral_width: float = 4.0
    lateral_length: float = 10.0
    pit_area: float = 460.0
    bore_depth: float = 25.0


# The desktop form of the time rates differs in the bypass depth and the startup markup.
DESKTOP_TIMES = replace(TimeRates(), shallow_trench=1.0, bore_depth=1.0)
DESKTOP_MARKUPS = replace(Markups(), startup=0.1)


@dataclass(frozen=True)
class FlowRules:
    fraction: float = 0.2
    unit_factor: float = 1.486
    roughness: float = 0.013
    default_slope: float = 0.005


@dataclass(frozen=True)
class TrafficCosts:
    street: float = 500.0
    arterial: float = 1000.0
    major: float = 3000.0
    freeway: float = 0.0


@dataclass(frozen=True)
class ConsequenceCosts:
    """Unit costs of the consequence layers; they come from the caller's constants."""

    emergency_factor: float = 1.4
    lateral_repair: float = 5000.0
    regulatory_fine: float = 2000.0
    flooding_cost: float = 9000.0
    flooding_events: float = 2.0
    sinkhole_freeway: float = 250_000.0
    sinkhole_major: float = 120_000.0
    sinkhole_residential: float = 40_000.0
    public_building: float = 15_000.0
    spill_near_school: float = 8000.0
    spill_far_school: float = 3000.0
    repair_length: float = 10.0
