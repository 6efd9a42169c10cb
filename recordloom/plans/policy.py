"""Policies: validated settings of the operators, with the defaults of the curation funnel."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path

MODES = ("FULL", "TRIAGE", "INDEX_ONLY", "SUSPENDED")
ROUTES = ("INTEGRITY_REVIEW", "FETCH_CANDIDATE", "RESERVE", "CATALOG_ONLY")


def _by_mode(*values):
    return field(default_factory=lambda: dict(zip(MODES, values, strict=True)))


class PolicyError(ValueError):
    """A policy that can't be used."""


class _Policy:
    """Loading, validation and a digest that changes with any setting."""

    @classmethod
    def load(cls, path: str | Path | None = None):
        """From a JSON file of some of the settings; the defaults without one."""
        given = json.loads(Path(path).read_text()) if path and Path(path).is_file() else {}
        unknown = set(given) - {f.name for f in fields(cls)}
        if unknown:
            raise PolicyError(f"unknown settings: {sorted(unknown)}")
        made = cls(**given)
        made.check()
        return made

    def digest(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    def check(self) -> None:
        for f in fields(self):
            value = getattr(self, f.name)
            if isinstance(value, Mapping) and f.name.endswith(("_by_mode", "_caps", "_modifiers")) and set(value) != set(MODES):
                raise PolicyError(f"{f.name} needs exactly the modes {MODES}")
            for v in value.values() if isinstance(value, Mapping) else [value]:
                if isinstance(v, (int, float)) and not isinstance(v, bool) and v < 0 and not f.name.endswith("weights"):
                    raise PolicyError(f"{f.name} is negative")


@dataclass(frozen=True)
class TriagePolicy(_Policy):
    """Scores of title paths, thresholds of routes, caps and the saturation penalty."""

    fetch: int = 80
    reserve: int = 65
    bypass: int = 92
    soft_caps: dict = _by_mode(30, 20, 10, 0)
    reserve_caps: dict = _by_mode(50, 50, 25, 0)
    saturation_matches: int = 20
    saturation_prevalence: float = 0.35
    saturation_penalty: int = 12
    saturation_paths: tuple = ("RESOURCE_BENCHMARK", "PROSPECTIVE_LONGITUDINAL", "OBSERVATIONAL_DESIGN", "SURVEY")
    #: The score of each path.
    scores: dict = field(default_factory=lambda: {
        "INTEGRITY_EVENT": 100, "GUIDANCE": 92, "CORRECTION_EVENT": 90, "EVIDENCE_SYNTHESIS": 88, "RANDOMIZED_TRIAL": 86, "REPLICATION_VALIDATION": 84,
        "SAFETY_SIGNAL": 82, "RESOURCE_BENCHMARK": 80, "PROSPECTIVE_LONGITUDINAL": 74, "OBSERVATIONAL_DESIGN": 66, "SURVEY": 58, "PRIMARY_METADATA": 50,
        "CASE_REPORT": 42, "PROTOCOL": 38, "EDITORIAL": 25,
    })
    pmcid_bonus: int = 6
    pmid_bonus: int = 2
    doi_bonus: int = 1
    specific_tokens: int = 12
    very_specific_tokens: int = 20

    def check(self) -> None:
        super().check()
        if not self.reserve < self.fetch <= self.bypass <= 100:
            raise PolicyError("thresholds must rise from reserve to fetch to bypass, 100 at most")


@dataclass(frozen=True)
class ProcessingPolicy(_Policy):
    """Limits by processing mode."""

    source_limits_by_mode: dict = _by_mode(500, 500, 500, 0)
    page_limits_by_mode: dict = _by_mode(1000, 250, 100, 100)
    triage_page_limits_by_mode: dict = _by_mode(250, 250, 100, 100)
    translation_by_mode: dict = _by_mode("ALL", "DEFERRED", "NONE", "NONE")
    triage_threshold: int = 1000


@dataclass(frozen=True)
class ShortlistPolicy(_Policy):
    """Target, capture bands, caps and near-duplicate limit of the diversified selection."""

    target: int = 300
    neutral_percentile: float = 50.0
    unknown_rate: float = 0.75
    #: Least percentile and capture rate of each band, highest first.
    bands: tuple = ((90.0, 1.0), (75.0, 0.9), (50.0, 0.8), (0.0, 0.7))
    capture_modifiers: dict = _by_mode(1.0, 0.45, 0.2, 0.0)
    journal_caps: dict = _by_mode(40, 60, 8, 0)
    topic_soft_caps: dict = _by_mode(6, 12, 2, 0)
    topic_hard_caps: dict = _by_mode(12, 24, 4, 0)
    near_duplicate: float = 0.82
    signature_tokens: int = 4
    eligible: tuple = ("FETCH_CANDIDATE", "RESERVE")
    independent: tuple = ("FETCH_CANDIDATE",)

    def check(self) -> None:
        super().check()
        least = [b[0] for b in self.bands]
        if least != sorted(least, reverse=True) or least[-1] != 0:
            raise PolicyError("bands must fall to a floor of zero")


@dataclass(frozen=True)
class FirstShortlistPolicy(_Policy):
    """The first selection, across journals: floors, then soft and hard caps by journal, path, category and topic."""

    target: int = 48
    hold_target: int = 144
    journal_caps: dict = _by_mode(4, 8, 2, 0)
    hold_caps_by_mode: dict = _by_mode(12, 24, 4, 0)
    near_duplicate: float = 0.72
    signature_tokens: int = 4
    topic_cap: int = 2
    hold_topic_cap: int = 4
    backfill: bool = True
    sources: tuple = ("FETCH_CANDIDATE",)
    #: Categories in order, with their floors, soft caps and hard caps.
    categories: dict = field(default_factory=lambda: {
        "clinical_medicine": (10, 14, 18), "interdisciplinary": (6, 10, 12), "sport_nutrition_fitness": (6, 8, 10), "llm_research": (5, 8, 10), "human_ai": (5, 6, 8),
        "sport_science": (3, 4, 5), "chemistry": (0, 4, 5), "physics_astronomy": (0, 4, 5), "uncategorized": (0, 6, 8),
    })
    #: Paths in order, with their floors, soft caps and hard caps.
    paths: dict = field(default_factory=lambda: {
        "GUIDANCE": (2, 4, 4), "EVIDENCE_SYNTHESIS": (6, 10, 14), "RANDOMIZED_TRIAL": (6, 10, 14), "REPLICATION_VALIDATION": (4, 6, 8), "SAFETY_SIGNAL": (4, 7, 10), "RESOURCE_BENCHMARK": (4, 6, 10),
        "PROSPECTIVE_LONGITUDINAL": (3, 5, 8), "OBSERVATIONAL_DESIGN": (2, 3, 6), "SURVEY": (1, 2, 4), "PROTOCOL": (0, 1, 2), "CASE_REPORT": (0, 1, 2),
    })

    def check(self) -> None:
        super().check()
        for name in ("categories", "paths"):
            if any(not 0 <= floor <= soft <= hard for floor, soft, hard in getattr(self, name).values()):
                raise PolicyError(f"{name}: floors can't pass soft caps, nor those hard caps")


@dataclass(frozen=True)
class ReviewPolicy(_Policy):
    """Priorities of abstracts for full texts."""

    target: int = 120
    journal_caps: dict = _by_mode(20, 30, 4, 0)
    least_characters: int = 250
    percentile_weight: float = 0.1
    candidate_bonus: int = 8
    unknown_path: int = 50
    near_duplicate: float = 0.85
    #: The base of each path, and the weight of each signal.
    path_base: dict = field(default_factory=lambda: {
        "GUIDANCE": 80, "EVIDENCE_SYNTHESIS": 80, "RANDOMIZED_TRIAL": 80, "SAFETY_SIGNAL": 78, "REPLICATION_VALIDATION": 76, "PROSPECTIVE_LONGITUDINAL": 70,
        "RESOURCE_BENCHMARK": 68, "OBSERVATIONAL_DESIGN": 64, "SURVEY": 55, "PROTOCOL": 40, "CASE_REPORT": 45,
    })
    signal_weights: dict = field(default_factory=lambda: {
        "METHODS_SECTION": 5, "RESULTS_SECTION": 7, "SAMPLE_SIZE": 5, "EFFECT_ESTIMATE": 5, "REGISTRATION": 4, "MULTICENTER_OR_EXTERNAL_VALIDATION": 4,
        "LIMITATIONS": 2, "DATA_OR_CODE_AVAILABILITY": 2, "SHORT_ABSTRACT": -8, "NO_RESULT_SIGNAL": -6,
    })


#: What each path's full text should report.
CHECKLISTS = {
    "RANDOMIZED_TRIAL": ("METHODS_SECTION", "RESULTS_SECTION", "RANDOMIZATION", "SAMPLE_SIZE", "PRIMARY_OUTCOME", "EFFECT_ESTIMATE", "REGISTRATION", "ALLOCATION_CONCEALMENT", "MASKING", "INTENTION_TO_TREAT", "ATTRITION_OR_MISSING", "LIMITATIONS"),
    "EVIDENCE_SYNTHESIS": ("METHODS_SECTION", "RESULTS_SECTION", "SEARCH_STRATEGY", "RISK_OF_BIAS_METHOD", "EFFECT_ESTIMATE", "HETEROGENEITY", "REGISTRATION", "LIMITATIONS"),
    "PROSPECTIVE_LONGITUDINAL": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE", "FOLLOW_UP", "EFFECT_ESTIMATE", "CONFOUNDING_ADJUSTMENT", "ATTRITION_OR_MISSING", "LIMITATIONS"),
    "OBSERVATIONAL_DESIGN": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE", "EFFECT_ESTIMATE", "CONFOUNDING_ADJUSTMENT", "ATTRITION_OR_MISSING", "LIMITATIONS"),
    "REPLICATION_VALIDATION": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE", "EFFECT_ESTIMATE", "EXTERNAL_VALIDATION", "LIMITATIONS"),
    "RESOURCE_BENCHMARK": ("METHODS_SECTION", "RESULTS_SECTION", "DATA_OR_CODE_AVAILABILITY", "EXTERNAL_VALIDATION", "LIMITATIONS"),
    "SAFETY_SIGNAL": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE", "EFFECT_ESTIMATE", "LIMITATIONS"),
    "GUIDANCE": ("METHODS_SECTION", "RECOMMENDATION_LANGUAGE", "CONFLICT_OF_INTEREST", "FUNDING"),
    "SURVEY": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE", "LIMITATIONS"),
    "PROTOCOL": ("METHODS_SECTION", "REGISTRATION", "PRIMARY_OUTCOME"),
    "CASE_REPORT": ("RESULTS_SECTION", "LIMITATIONS"),
    "DEFAULT": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE", "EFFECT_ESTIMATE", "LIMITATIONS"),
}
#: Which of it is critical.
CRITICAL = {
    "RANDOMIZED_TRIAL": ("METHODS_SECTION", "RESULTS_SECTION", "RANDOMIZATION", "SAMPLE_SIZE", "PRIMARY_OUTCOME", "EFFECT_ESTIMATE"),
    "EVIDENCE_SYNTHESIS": ("METHODS_SECTION", "RESULTS_SECTION", "SEARCH_STRATEGY", "RISK_OF_BIAS_METHOD"),
    "PROSPECTIVE_LONGITUDINAL": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE", "FOLLOW_UP"),
    "OBSERVATIONAL_DESIGN": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE", "CONFOUNDING_ADJUSTMENT"),
    "REPLICATION_VALIDATION": ("METHODS_SECTION", "RESULTS_SECTION", "EXTERNAL_VALIDATION"),
    "RESOURCE_BENCHMARK": ("METHODS_SECTION", "RESULTS_SECTION", "DATA_OR_CODE_AVAILABILITY"),
    "SAFETY_SIGNAL": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE"),
    "GUIDANCE": ("METHODS_SECTION", "RECOMMENDATION_LANGUAGE", "CONFLICT_OF_INTEREST"),
    "SURVEY": ("METHODS_SECTION", "RESULTS_SECTION", "SAMPLE_SIZE"),
    "PROTOCOL": ("METHODS_SECTION", "REGISTRATION"),
    "CASE_REPORT": ("RESULTS_SECTION",),
    "DEFAULT": ("METHODS_SECTION", "RESULTS_SECTION"),
}


@dataclass(frozen=True)
class EvaluationPolicy(_Policy):
    """Weights of the reporting audit and caps of what is featured."""

    target: int = 36
    journal_caps: dict = _by_mode(8, 12, 2, 0)
    coverage_weight: float = 24.0
    gap_penalty: float = 6.0
    high_bonus: float = 4.0
    moderate_bonus: float = 2.0
    high_coverage: float = 0.75
    moderate_coverage: float = 0.5
    checklists: dict = field(default_factory=lambda: dict(CHECKLISTS))
    critical: dict = field(default_factory=lambda: dict(CRITICAL))

    def check(self) -> None:
        super().check()
        if "DEFAULT" not in self.checklists or set(self.critical) != set(self.checklists):
            raise PolicyError("every checklist needs its critical signals, and DEFAULT must be there")
