"""Scores and bands as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, weights and penalties that results depend on.
EVIDENCE_THRESHOLD, QUALITY_THRESHOLD = 0.55, 0.50
PENALTIES = {
    "citation.phantom_fbrf": 25, "phenotype.weak_input_grounding": 8, "bullet.near_duplicate": 8, "confidence.all_null": 20, "confidence.over_confident": 3,
    "specificity.too_low": 0, "bullet_count.out_of_range": 12, "omim.phantom": 25, "omim.missed": 0, "cohort_outlier": 10,
}
ACCEPT_FROM, REDO_BELOW, OUTLIER_PENALTY = 90, 70, 6
QUADRANTS = ("STRONG", "NOVEL_LEAD", "LIKELY_NOT", "CANT_RULE_OUT")


def annotation_quality(bullets: Column, refs: Column, pubs: Column, has_human: Column, has_mouse: Column, has_disease: Column) -> Column:
    """Weighted saturating log counts and flags, less 0.15 for a stub of three bullets or fewer, in [0, 1]."""

    def part(n: Column, cap: int) -> Column:
        return F.least(F.lit(1.0), F.log1p(F.coalesce(n, F.lit(0)).cast("double")) / math.log1p(cap))

    def flag(c: Column) -> Column:
        return F.when(F.coalesce(c, F.lit(False)), 1.0).otherwise(0.0)

    raw = 0.30 * part(bullets, 30) + 0.25 * part(refs, 25) + 0.20 * part(pubs, 500) + 0.10 * flag(has_human) + 0.10 * flag(has_mouse) + 0.05 * flag(has_disease)
    stub = F.when(F.coalesce(bullets, F.lit(0)) <= 3, 0.15).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw - stub))


def quadrant(evidence: Column, quality: Column, e: float = EVIDENCE_THRESHOLD, q: float = QUALITY_THRESHOLD) -> Column:
    return (
        F.when((evidence >= e) & (quality >= q), "STRONG").when(evidence >= e, "NOVEL_LEAD").when(quality >= q, "LIKELY_NOT").otherwise("CANT_RULE_OUT")
    )


def quadrant_order(label: Column) -> Column:
    return F.array_position(F.array(*[F.lit(q) for q in QUADRANTS]), label)


def issue_score(codes: Column, penalties: dict[str, int] | None = None) -> Column:
    """100 less the penalties of an array of issue codes (unknown codes: none), not below 0."""
    table = F.create_map(*[F.lit(x) for kv in (penalties or PENALTIES).items() for x in kv])
    lost = F.aggregate(F.coalesce(codes, F.array().cast("array<string>")), F.lit(0), lambda a, c: a + F.coalesce(F.element_at(table, c), F.lit(0)))
    return F.greatest(F.lit(0), 100 - lost)


def band(score: Column) -> Column:
    return F.when(score >= ACCEPT_FROM, "accept").when(score >= REDO_BELOW, "audit").otherwise("redo")


def publication_tier(pubs: Column) -> Column:
    return F.when(pubs >= 500, "A").when(pubs >= 50, "B").otherwise("C")


def is_complex(pubs: Column, abstracts: Column, chars: Column) -> Column:
    return (pubs >= 50) | (abstracts >= 15) | (chars >= 50_000)


def half_even(x: Column, step: float) -> Column:
    """``x`` to the nearest multiple of ``step``, halves to even."""
    return F.bround(x / step) * step
