"""Markdown reports of small results. Each collects only rows that a limit or a fixed set of regions bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.render import markdown
from tessera.operators import quality, rank
from tessera.plans.facade import Atlas


def table(df: DataFrame, columns: list[str] | None = None, limit: int = 50) -> str:
    shown = df.select(*(columns or df.columns)).limit(limit)
    return markdown(shown.columns, shown.collect())


def overlaps(atlas: Atlas) -> str:
    """Headline and table of overlapping regions, those of different families first."""
    pairs = atlas.qtl_overlaps().persist()
    try:
        return _overlaps(pairs)
    finally:
        pairs.unpersist()


def _overlaps(pairs: DataFrame) -> str:
    n, crossing = pairs.agg(F.count("*"), F.count(F.when(F.col("is_cross"), 1))).first()
    body = table(pairs.orderBy(F.desc("is_cross"), F.desc("overlap_bp"), "id_a", "id_b"), ["id_a", "id_b", "chr", "overlap_start", "overlap_end", "overlap_bp", "n_items"])
    return f"# Overlapping regions\n\n{n} pairs, {crossing} across families.\n\n{body}\n"


def region(atlas: Atlas, name: str, top: int = 10, phenotype: str | None = None) -> str:
    """One region: quadrant counts and its best candidates with their leading bullets."""
    ranked = atlas.qtl_rank([name], phenotype, None).persist()
    try:
        return _region(atlas, ranked, name, top)
    finally:
        ranked.unpersist()


def _region(atlas: Atlas, ranked: DataFrame, name: str, top: int) -> str:
    counts = rank.quadrant_counts(ranked, ["id"])
    best = ranked.where(F.col("rank") <= top)
    lead = rank.top_bullets(atlas.t["bullets"].join(best.select("fbgn"), "fbgn", "left_semi"), "fbgn", 1).select("fbgn", F.col("phenotype").alias("lead"))
    rows = best.join(lead, "fbgn", "left").orderBy("rank")
    return f"# {name}\n\n{table(counts)}\n\n{table(rows, ['rank', 'symbol', 'quadrant', 'evidence', 'quality', 'lead'], top)}\n"


def entity(atlas: Atlas, name: str) -> str:
    rows = atlas.gene(name).collect()
    if not rows:
        return f"# {name}\n\nnot found\n"
    g = rows[0]
    parts = [f"# {g['symbol']} ({g['fbgn']})", markdown(["category", "phenotype", "confidence"], [(b["category"], b["phenotype"], b["confidence"]) for b in g["bullets"]])]
    parts.append(markdown(["reference", "year"], [(r["fbrf"], r["year"]) for r in g["refs"]]))
    return "\n\n".join(parts) + "\n"


def quality_summary(scores: DataFrame, issues: DataFrame) -> str:
    return f"# Quality\n\n{table(quality.summary(scores, 'qa_score'))}\n\n{table(quality.histogram(issues))}\n"


def before_after(before: DataFrame, after: DataFrame, group: str, item: str) -> str:
    """What two rankings of the same groups share: added, dropped and stable items and the stability."""
    from tessera.operators.dedup import compare_lists

    a = before.groupBy(group).agg(F.collect_set(item).alias("b"))
    b = after.groupBy(group).agg(F.collect_set(item).alias("a"))
    none = F.array().cast("array<string>")
    d = a.join(b, group, "full").select(group, compare_lists(F.coalesce("b", none), F.coalesce("a", none)).alias("d"))
    rows = d.select(group, *[F.array_join(f"d.{c}", ", ").alias(c) for c in ("added", "dropped", "stable")], F.round("d.stability", 3).alias("stability")).orderBy(group)
    return table(rows)
