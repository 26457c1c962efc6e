"""Deterministic quality checks of entity documents: issues, scores, cohort outliers, audits.

Every check is ``rows -> (entity, code, severity, item, detail)``; they are unioned and scored in one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scoring import OUTLIER_PENALTY, issue_score, publication_tier
from tessera.functions.text import REFERENCE, content_tokens
from tessera.operators.dedup import near_duplicates

#: Expected bullet counts by publication tier.
TIER_RANGES = {"A": (18, 36), "B": (5, 33), "C": (0, 26)}


def _issue(df: DataFrame, key: str, code: str, severity: str, item: Column | None = None, detail: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(F.col(key).alias("entity"), F.lit(code).alias("code"), F.lit(severity).alias("severity"), (none if item is None else item.cast("string")).alias("item"), (none if detail is None else detail.cast("string")).alias("detail"))


def phantom_citations(citations: DataFrame, known: DataFrame, key: str = "fbgn", value: str = "value", item: str = "bullet_id", code: str = "citation.phantom_fbrf") -> DataFrame:
    """Cited ids that are not among the ids (key, value) that the entity's input held."""
    missing = citations.join(known.select(key, value).distinct(), [key, value], "left_anti")
    return _issue(missing, key, code, "error", F.col(item), F.col(value))


def ids_in_text(sections: DataFrame, key: str, text: str, pattern: str = REFERENCE) -> DataFrame:
    """(key, value): the reference ids that occur in free text."""
    return sections.select(key, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).alias("value"))


def weak_grounding(bullets: DataFrame, inputs: DataFrame, key: str, phenotype: str, text: str, item: str, least: int = 2) -> DataFrame:
    """Bullets that share fewer than ``least`` content words with the entity's input text."""
    rows = bullets.join(inputs.select(key, content_tokens(F.col(text)).alias("__in")), key)
    shared = F.size(F.array_intersect(content_tokens(F.col(phenotype)), F.col("__in")))
    return _issue(rows.where((shared < least) & (F.size(content_tokens(F.col(phenotype))) > 0)), key, "phenotype.weak_input_grounding", "warn", F.col(item), shared)


def repeated_bullets(bullets: DataFrame, key: str = "fbgn", item: str = "bullet_id", phenotype: str = "phenotype") -> DataFrame:
    rows = bullets.withColumn("__tokens", content_tokens(F.col(phenotype)))
    found = near_duplicates(rows, [key, "category", "direction"], item, item, "__tokens")
    keyed = rows.select(key, item).join(found, item)
    return _issue(keyed, key, "bullet.near_duplicate", "warn", F.col(item), F.col("earlier"))


def distributions(bullets: DataFrame, key: str = "fbgn") -> DataFrame:
    """confidence.all_null, confidence.over_confident (over 95 % of at least 10 rated) and specificity.too_low (over 85 % of at least 10)."""
    n = bullets.groupBy(key).agg(
        F.count("*").alias("n"), F.count("confidence").alias("rated"), F.count(F.when(F.col("confidence") == "high", 1)).alias("high"),
        F.count(F.when(F.col("text_specificity") == "low", 1)).alias("low"),
    )
    a = _issue(n.where("rated = 0"), key, "confidence.all_null", "error", None, F.col("n"))
    b = _issue(n.where("rated >= 10 and high / rated > 0.95"), key, "confidence.over_confident", "info", None, F.col("high"))
    c = _issue(n.where("n >= 10 and low / n > 0.85"), key, "specificity.too_low", "info", None, F.col("low"))
    return a.unionByName(b).unionByName(c)


def bullet_counts(entities: DataFrame, key: str = "fbgn", pubs: str = "n_pubs_total", bullets: str = "n_bullets", stub: str | None = None) -> DataFrame:
    """Entities whose number of bullets is outside their publication tier's range; stubs (no bullet and no phenotype row) are exempt."""
    tier = publication_tier(F.coalesce(F.col(pubs), F.lit(0)))
    bad = F.lit(False)
    for name, (low, high) in TIER_RANGES.items():
        bad = bad | ((tier == name) & ~F.col(bullets).between(low, high))
    rows = entities.where(bad if stub is None else bad & ~F.col(stub))
    return _issue(rows, key, "bullet_count.out_of_range", "warn", None, F.col(bullets))


def omim_consistency(mentioned: DataFrame, linked: DataFrame, key: str = "fbgn", value: str = "omim_id") -> DataFrame:
    """Disease ids in text and not among the links (phantom), and the reverse (missed)."""
    m, k = mentioned.select(key, value).where(F.col(value).isNotNull()).distinct(), linked.select(key, value).where(F.col(value).isNotNull()).distinct()
    a = _issue(m.join(k, [key, value], "left_anti"), key, "omim.phantom", "error", None, F.col(value))
    return a.unionByName(_issue(k.join(m, [key, value], "left_anti"), key, "omim.missed", "info", None, F.col(value)))


def scores(entities: DataFrame, issues: DataFrame, key: str = "fbgn") -> DataFrame:
    """entity, n_issues, codes, qa_score of every entity; one without issues keeps 100."""
    found = issues.groupBy("entity").agg(F.count("*").alias("n_issues"), F.array_sort(F.collect_list("code")).alias("codes"))
    rows = entities.select(F.col(key).alias("entity")).join(found, "entity", "left")
    return rows.select("entity", F.coalesce("n_issues", F.lit(0)).alias("n_issues"), "codes", issue_score(F.col("codes")).alias("qa_score"))


def cohort_outliers(df: DataFrame, value: str, score: str, at: float = 3.0, least: int = 5) -> DataFrame:
    """``df`` with z (distance to the median in sample standard deviations), is_outlier, and the score less 6 for outliers."""
    one = df.agg(F.median(value).alias("__m"), F.stddev_samp(value).alias("__s"), F.count(value).alias("__n"))
    z = F.when((F.col("__n") >= least) & (F.col("__s") > 0), F.abs(F.col(value) - F.col("__m")) / F.col("__s"))
    rows = df.join(F.broadcast(one)).withColumn("z", F.round(z, 6)).drop("__m", "__s", "__n")  # one: a single row
    out = F.coalesce(F.col("z") > at, F.lit(False))
    return rows.withColumn("is_outlier", out).withColumn(score, F.when(out, F.greatest(F.lit(0), F.col(score) - OUTLIER_PENALTY)).otherwise(F.col(score)))


def summary(df: DataFrame, score: str) -> DataFrame:
    """Least, greatest, median, mean and sample deviation of a score."""
    return df.agg(F.count("*").alias("n"), F.min(score).alias("least"), F.max(score).alias("greatest"), F.median(score).alias("median"), F.round(F.avg(score), 6).alias("mean"), F.round(F.stddev_samp(score), 6).alias("deviation"))


def histogram(issues: DataFrame) -> DataFrame:
    return issues.groupBy("code", "severity").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")


def schema_drift(bullets: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Entities where a field is missing in every bullet, or in some."""
    n = bullets.groupBy(key).agg(F.count("*").alias("n"), *[F.count(F.when(F.col(f).isNull(), 1)).alias(f"__{f}") for f in fields])
    rows = None
    for f in fields:
        whole = _issue(n.where(F.col(f"__{f}") == F.col("n")), key, f"schema_drift.missing_{f}", "error", None, F.col("n"))
        some = _issue(n.where((F.col(f"__{f}") > 0) & (F.col(f"__{f}") < F.col("n"))), key, f"schema_drift.partial_missing_{f}", "warn", None, F.col(f"__{f}"))
        rows = whole.unionByName(some) if rows is None else rows.unionByName(whole).unionByName(some)
    return rows


def _norm(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def quotes_not_found(bullets: DataFrame, inputs: DataFrame, key: str, evidence: str, text: str, item: str, share: float = 0.8) -> DataFrame:
    """Quoted passages (15 to 300 characters) of the evidence that the input does not hold: neither whole, nor each part
    between ellipses, bars, slashes, semicolons and "and", nor ``share`` of its words."""
    quotes = F.regexp_extract_all(evidence, F.lit('["“]([^"”]{15,300})["”]'), F.lit(1))
    each = bullets.select(key, item, F.explode(quotes).alias("quote")).join(inputs.select(key, F.concat(F.lit(" "), _norm(F.col(text)), F.lit(" ")).alias("__in")), key)
    parts = F.filter(F.transform(F.split("quote", r"\.\.\.|…|\||/|;|\band\b"), _norm), lambda p: F.length(p) > 0)
    words = F.array_distinct(F.split(_norm(F.col("quote")), " "))
    held = F.filter(words, lambda w: F.contains(F.col("__in"), F.concat(F.lit(" "), w, F.lit(" "))))
    found = F.contains("__in", _norm(F.col("quote"))) | F.forall(parts, lambda p: F.contains(F.col("__in"), p)) | (F.size(held) >= share * F.size(words))
    return _issue(each.where(~found), key, "quote.not_found", "warn", F.col(item), F.col("quote"))


def lint(bullets: DataFrame, categories: tuple[str, ...], directions: tuple[str, ...], levels: tuple[str, ...], least: int = 5) -> DataFrame:
    """Bullets with enumerations coerced, their lint codes, and without those whose phenotype is too short."""
    code = lambda cond, name: F.when(F.coalesce(cond, F.lit(True)), F.lit(name))
    codes = F.array_compact(F.array(
        code(~F.col("category").isin(*categories), "category.coerced"), code(~F.col("direction").isin(*directions), "direction.invalid"),
        F.when(F.col("confidence").isNotNull() & ~F.col("confidence").isin(*levels), F.lit("confidence.invalid")),
        code(F.length(F.trim("phenotype")) < least, "phenotype.too_short"), code(F.trim("evidence_text") == "", "evidence.missing"),
    ))
    fixed = bullets.withColumn("lint", codes)
    fixed = fixed.withColumn("category", F.when(F.col("category").isin(*categories), F.col("category")).otherwise("other"))
    fixed = fixed.withColumn("direction", F.when(F.col("direction").isin(*directions), F.col("direction")).otherwise("unknown"))
    fixed = fixed.withColumn("confidence", F.when(F.col("confidence").isin(*levels), F.col("confidence")))
    return fixed.where(~F.array_contains("lint", "phenotype.too_short"))


def inference_bullets(bullets: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """Bullets inferred from orthologs that keep the contract: low confidence, "inference from", and a term of the entity verbatim."""
    listed = terms.groupBy(key).agg(F.collect_set(F.lower("term")).alias("__terms"))
    rows = bullets.join(listed, key)
    ok = (F.col("confidence") == "low") & F.contains(F.lower("evidence_text"), F.lit("inference from")) & F.exists("__terms", lambda t: F.contains(F.lower(F.col("evidence_text")), t))
    return rows.where(ok).drop("__terms")


# Names of input sections in evidence, and words of disease names that tell nothing.
SECTION_NAME = r"\b([a-z_]+_sub|CURATOR NOTES)\b"
DISEASE_STOP = ("phase", "syndrome", "advanced", "type", "familial", "early", "late")


def phantom_sections(bullets: DataFrame, sections: DataFrame, key: str, evidence: str, item: str) -> DataFrame:
    """Sections that evidence names and the entity's input lacks. ``sections``: key, section, text; an empty text is no section."""
    named = F.transform(F.array_distinct(F.regexp_extract_all(evidence, F.lit(SECTION_NAME), F.lit(1))), lambda s: F.when(s == "CURATOR NOTES", "other_comments_sub").otherwise(s))
    cited = bullets.select(key, item, F.explode(F.array_distinct(named)).alias("section"))
    have = sections.where(F.length(F.trim("text")) > 0).select(key, "section").distinct()
    return _issue(cited.join(have, [key, "section"], "left_anti"), key, "phantom_section", "error", F.col(item), F.col("section"))


def unsourced_diseases(diseases: DataFrame, inputs: DataFrame, key: str, name: str, text: str) -> DataFrame:
    """Linked diseases of whose names no telling word (four letters or more) occurs in the entity's input text."""
    words = F.filter(F.array_distinct(F.regexp_extract_all(F.lower(name), F.lit("[a-z]{4,}"), F.lit(0))), lambda w: ~w.isin(*DISEASE_STOP))
    rows = diseases.select(key, name, words.alias("__w")).join(inputs.select(key, F.lower(text).alias("__in")), key, "left")
    held = F.exists("__w", lambda w: F.contains(F.coalesce(F.col("__in"), F.lit("")), w))
    return _issue(rows.where((F.size("__w") > 0) & ~held), key, "disease_unsourced", "warn", None, F.col(name))


def level_counts(bullets: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """entity, field, value, n: how often each value of each column occurs; a null or empty one counts as missing."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("missing")).alias("value")) for c in columns]))
    return bullets.select(F.col(key).alias("entity"), pairs.alias("p")).groupBy("entity", "p.field", "p.value").agg(F.count("*").alias("n"))


def verdicts(docs: DataFrame) -> DataFrame:
    """fbgn, n_errors, n_lint, verdict: FAIL if a constraint is broken or bullet ids repeat, else WARN with lint, else PASS."""
    from tessera.schemas import violations

    ids = F.transform("bullets", lambda b: b["id"])
    repeated = F.coalesce(F.size(ids) - F.size(F.array_distinct(ids)), F.lit(0))
    rows = docs.select("fbgn", (F.size(violations()) + F.greatest(repeated, F.lit(0))).cast("long").alias("n_errors"), F.greatest(F.size("_lint"), F.lit(0)).cast("long").alias("n_lint"))
    return rows.withColumn("verdict", F.when(F.col("n_errors") > 0, "FAIL").when(F.col("n_lint") > 0, "WARN").otherwise("PASS"))


def latencies(calls: DataFrame, level: str, seconds: str, ok: str) -> DataFrame:
    """level, n_ok, n_fail, and the median, least and greatest seconds of the calls that succeeded."""
    good = F.when(F.col(ok), F.col(seconds))
    return calls.groupBy(level).agg(F.count(good).alias("n_ok"), F.count(F.when(~F.col(ok), 1)).alias("n_fail"), F.round(F.median(good), 6).alias("median_s"), F.min(good).alias("least_s"), F.max(good).alias("most_s"))
