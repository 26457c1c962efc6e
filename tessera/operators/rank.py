"""Two-dimensional candidate ranking: evidence by similarity, quality by annotation, quadrants, one plan for all regions at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scoring import EVIDENCE_THRESHOLD, QUALITY_THRESHOLD, QUADRANTS, annotation_quality, half_even, quadrant, quadrant_order
from tessera.operators.intervals import overlap_join
from tessera.operators.lookup import top_per_group


def region_members(regions: DataFrame, entities: DataFrame, id_: str) -> DataFrame:
    """(region columns, entity columns) for entities in each region; a region without r6 coordinates (null or 0) uses its r5 ones.

    Regions have chr, start_r6, end_r6, start_r5, end_r5; entities chr, start, end and chr_r5, start_r5, end_r5.
    """
    r6 = (F.coalesce("start_r6", F.lit(0)) != 0) & (F.coalesce("end_r6", F.lit(0)) != 0)
    regions = regions.select(id_, F.col("chr").alias("__c"), F.when(r6, F.col("start_r6")).otherwise(F.col("start_r5")).alias("__s"), F.when(r6, F.col("end_r6")).otherwise(F.col("end_r5")).alias("__e"), r6.alias("__r6"))
    own = ("__c", "__s", "__e")
    a = overlap_join(regions.where("__r6"), entities, own, ("chr", "start", "end"))
    b = overlap_join(regions.where("not __r6"), entities, own, ("chr_r5", "start_r5", "end_r5"))
    return a.unionByName(b).drop(*own, "__r6")


def with_flags(entities: DataFrame, key: str, flags: dict[str, DataFrame]) -> DataFrame:
    """``entities`` with a boolean for each relation: whether the key has a row there."""
    for name, rows in flags.items():
        marks = rows.select(key).distinct().withColumn(name, F.lit(True))
        entities = entities.join(marks, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return entities


def rank_two_ways(candidates: DataFrame, evidence: Column, group: list[str], id_: str, start: str, counts: tuple[str, str, str], flags: tuple[str, str, str],
                  top: int | None = None, thresholds: tuple[float, float] = (EVIDENCE_THRESHOLD, QUALITY_THRESHOLD)) -> DataFrame:
    """Candidates with evidence, quality, quadrant and rank in their group: quadrant first, then evidence + 0.3 quality, ties by start and id."""
    q = annotation_quality(*[F.col(c) for c in counts], *[F.col(f) for f in flags])
    rows = candidates.withColumn("evidence", F.round(evidence, 6)).withColumn("quality", F.round(q, 6))
    rows = rows.withColumn("quadrant", quadrant(F.col("evidence"), F.col("quality"), *thresholds))
    order = Window.partitionBy(*group).orderBy(quadrant_order(F.col("quadrant")), F.desc(F.round(F.col("evidence") + 0.3 * F.col("quality"), 6)), start, id_)
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top) if top else ranked


def quadrant_counts(ranked: DataFrame, group: list[str]) -> DataFrame:
    """A count for each quadrant, zero where there is none."""
    return ranked.groupBy(*group).agg(*[F.count(F.when(F.col("quadrant") == q, 1)).alias(q) for q in QUADRANTS])


#: The categories that a short list of bullets prefers, in this order; all others come after them.
CATEGORY_ORDER = ("longevity", "stress_response", "disease_model", "behavior", "metabolism", "development")


def top_bullets(bullets: DataFrame, key: str, n: int = 3, preference: tuple[str, ...] = CATEGORY_ORDER) -> DataFrame:
    """The ``n`` bullets of each entity by category, then the longest evidence, then id."""
    place = F.array_position(F.array(*[F.lit(c) for c in preference]), F.coalesce("category", F.lit("")))
    return top_per_group(bullets, [key], [F.when(place > 0, place).otherwise(99), F.desc(F.length(F.coalesce("evidence_text", F.lit("")))), F.col("bullet_id")], n)


def shared_order(min_ev: str = "min_ev", max_ev: str = "max_ev", bullets: str = "n_bullets", refs: str = "n_refs") -> list[Column]:
    """Order of shared candidates: evidence in steps of 0.05 (halves to even), then annotation, then the better evidence."""
    return [F.desc(F.round(half_even(F.col(min_ev), 0.05), 2)), F.desc(bullets), F.desc(refs), F.desc(max_ev)]
