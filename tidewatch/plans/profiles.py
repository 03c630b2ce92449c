"""Training profiles and their parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from tidewatch.schemas import (
    ACCEPTANCE_THRESHOLD,
    BASE_MODEL_FEATURES,
    ENRICHED_MODEL_FEATURES,
    ENRICHED_PROFILE_START,
)

SEED = 42


@dataclass(frozen=True)
class BoostedParams:
    """Softmax gradient boosting, trees grown to their depth level by level."""

    trees: int = 500
    max_depth: int = 5
    learning_rate: float = 0.05
    subsample: float = 0.9
    feature_share: float = 0.9
    l2: float = 1.0
    bins: int = 64
    class_weight_power: float = 0.5
    acceptance_threshold: float = ACCEPTANCE_THRESHOLD


@dataclass(frozen=True)
class ForestParams:
    """Softmax gradient boosting, trees grown best-first up to a number of leaves.

    Class weights always use the square root.
    """

    trees: int = 500
    max_depth: int = 5
    learning_rate: float = 0.05
    leaves: int = 31
    subsample: float = 0.9
    feature_share: float = 0.9
    l2: float = 1.0
    bins: int = 64
    acceptance_threshold: float = ACCEPTANCE_THRESHOLD
    class_weight_power: float = field(default=0.5, init=False)


@dataclass(frozen=True)
class SequenceParams:
    """Recurrent network over the scaled rows of a sequence window."""

    length: int = 24
    hidden: int = 64
    epochs: int = 12
    block_size: int = 256
    learning_rate: float = 0.001
    acceptance_threshold: float = ACCEPTANCE_THRESHOLD


@dataclass(frozen=True)
class Profile:
    name: str
    features: list[str]
    start: str | None = None
    newest_first: bool = False
    writes_baseline: bool = False


BOOSTED = Profile("boosted", BASE_MODEL_FEATURES, writes_baseline=True)
FOREST = Profile("forest", BASE_MODEL_FEATURES)
ENRICHED = Profile(
    "enriched",
    ENRICHED_MODEL_FEATURES,
    start=ENRICHED_PROFILE_START,
    newest_first=True,
    writes_baseline=True,
)
SEQUENCE = Profile(
    "sequence", ENRICHED_MODEL_FEATURES, start=ENRICHED_PROFILE_START, newest_first=True
)
PROFILES = {p.name: p for p in (BOOSTED, FOREST, ENRICHED, SEQUENCE)}
