"""Decisions that the data model leaves open, in one place."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    as_of: str = "2001-08-02"
    active_threshold: int = 80
    inactive_threshold: int = 80
    amber_from: int = 65
    name_weight: float = 0.40
    phone_weight: float = 0.35
    postcode_weight: float = 0.25
    tier_a: int = 70
    tier_b: int = 55
    tier_low: int = 40
    points_new: int = 10
    points_ownership: int = 8
    points_review: int = 5
    new_days: int = 60
    window_days: int = 90
    thin_below: int = 5_000
    growing_from: int = 10
    food_sic: str = "56"
    not_food_types: tuple[str, ...] = ("PROMO",)
    icp_weekly: float = 597.0
    icp_orders_a_week: float = 2.0
    urgent_days: int = 7
    medium_days: int = 30
    daily_cap: float = 5.0
    unit_cost: float = 0.05
    district_target: float = 2.0
    prefix: str = "LD"
    # Fixed values: (term, category, negated) of complaints in reviews; a negated term counts only behind a negation ("no stock"), the others only without one.
    lexicon: tuple[tuple[str, str, bool], ...] = field(
        default=(
            ("arrived", "supply", True), ("delayed", "supply", False), ("delivered", "supply", True), ("late", "supply", False), ("shortage", "supply", False),
            ("sold", "stock", False), ("stock", "stock", True), ("unavailable", "stock", False),
            ("burnt", "quality", False), ("cold", "quality", False), ("fresh", "quality", True), ("soggy", "quality", False), ("stale", "quality", False),
            ("inconsistent", "consistency", False), ("missing", "consistency", False), ("varies", "consistency", False), ("wrong", "consistency", False),
        )
    )
    negations: tuple[str, ...] = ("never", "no", "not", "without", "isn't", "wasn't", "didn't")
    negation_window: int = 3


DEFAULT = Config()
# The enumerations of the data model.
ENUMS: dict[str, tuple[str, ...]] = {
    "user_role": ("owner", "admin", "management", "telesales", "developer"),
    "territory_item_type": ("outer_code", "inner_sector", "pasted_list", "delivery_boundary_upload", "expansion_list"),
    "run_type": ("weekly", "manual_test", "trigger_sweep"),
    "run_status": ("queued", "running", "complete", "failed", "blocked", "archived"),
    "ignored_reason": ("ACTIVE_MATCH", "DISSOLVED", "OUT_OF_AREA", "NOT_FOOD", "LOW_SCORE", "NO_FSA", "OTHER"),
    "priority_tier": ("A", "B", "Low", "Ignore"),
    "lead_status": ("new", "contacted", "converted", "dead"),
    "export_status": ("draft", "approved", "exported", "archived"),
    "suppression_match": ("brand", "phone", "postcode"),
    "membership_type": ("in_area", "expansion"),
    "pc_granularity": ("area", "district", "sector", "unit"),
    "worked_status": ("open", "in_progress", "contacted", "no_answer", "converted", "dead"),
    "trigger_urgency": ("high", "medium", "low"),
    "verify_state": ("unverified", "fsa_only", "fsa_ch", "rejected"),
}
