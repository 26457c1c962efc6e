"""Explicit schemas, enumerations and row constraints of the entity documents and relations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The enumerations and identifier formats of the entity documents.
CATEGORIES = (
    "behavior", "morphology", "lifespan_aging", "development", "reproduction", "metabolism", "immune", "sensory_neural",
    "stress_response", "disease_model", "expression_pattern", "other",
)
DIRECTIONS = ("loss_of_function", "gain_of_function", "either", "unknown")
LEVELS = ("high", "medium", "low")
ENTITY_ID = r"^FBgn[0-9]{7}$"
BULLET_ID = r"^FBgn[0-9]{7}:b[0-9]{2,}$"

ORTHOLOG = "symbol string, entrez_id string, diopt_score long, diopt_max long, name string"
DISEASE = "name string, omim_id string, do_id string, source string, via_ortholog struct<species: string, symbol: string, diopt_score: long>"
CITATION = (
    "type string, value string, label string, quote string, species string, section_enum string, year long, miniref string, pmid string, doi string, title string, "
    "id string, section string, term string, symbol string"
)
BULLET = (
    f"id string, category string, phenotype string, direction string, evidence_text string, citations array<struct<{CITATION}>>, confidence string, "
    "text_specificity string, tissues array<string>, life_stages array<string>, alleles array<string>, source string"
)
REFERENCE = "fbrf string, title string, miniref string, year long, pmid string, doi string, pubmed_url string, doi_url string, source_url string"
MODEL = "provider string, model_id string, harness string"
SOURCE = "n_pubs_total long, n_abstracts_used long, input_tokens long, output_tokens long"
CROSS_SPECIES = f"human_orthologs array<struct<{ORTHOLOG}>>, mouse_orthologs array<struct<{ORTHOLOG}>>, human_disease_links array<struct<{DISEASE}>>, mouse_phenotype_links array<string>"
#: An entity document: scalars, nested bullets with citations, references, orthologs, diseases and lint.
ENTITY = (
    "schema_version string, fbgn string, symbol string, distilled_at string, snapshot string, notes string, "
    "synonyms array<struct<synonym: string, type: string, is_current: boolean>>, "
    f"model struct<{MODEL}>, source struct<{SOURCE}>, "
    f"bullets array<struct<{BULLET}>>, "
    f"references array<struct<{REFERENCE}>>, "
    "go_slim map<string, array<string>>, "
    f"cross_species struct<{CROSS_SPECIES}>, "
    "_lint array<struct<code: string, severity: string, message: string>>"
)
QTL = (
    "id string, qtl_label string, study_drug string, drug_family string, chr string, peak_r6 long, start_r6 long, end_r6 long, peak_r5 long, start_r5 long, end_r5 long, "
    "neg_log_p double, h2 string, gene_count long, release_orig string, phenotype string, pmc_url string"
)


def violations(row: str = "") -> Column:
    """Array of struct<path, message> of the constraints that an entity document breaks (required, const, pattern, enum, length)."""
    p = f"{row}." if row else ""
    c = lambda name: F.col(p + name)
    checks = [
        ("schema_version", F.coalesce(c("schema_version") != "1.2", F.lit(True)), "is not 1.2"),
        ("fbgn", ~F.coalesce(c("fbgn").rlike(ENTITY_ID), F.lit(False)), "has the wrong form"),
        ("symbol", F.coalesce(F.length(c("symbol")) < 1, F.lit(True)), "is missing"),
        ("bullets", c("bullets").isNull(), "is missing"),
        ("model.provider", c("model.provider").isNull(), "is missing"),
    ]
    each = F.transform(F.coalesce(c("bullets"), F.array().cast(f"array<struct<{BULLET}>>")), lambda b: F.array_compact(F.array(
        F.when(~F.coalesce(b["id"].rlike(BULLET_ID), F.lit(False)), F.lit("id has the wrong form")),
        F.when(~F.coalesce(b["category"].isin(*CATEGORIES), F.lit(False)), F.lit("category is not in the enumeration")),
        F.when(~F.coalesce(b["direction"].isin(*DIRECTIONS), F.lit(False)), F.lit("direction is not in the enumeration")),
        F.when(F.coalesce(F.length(b["phenotype"]) < 5, F.lit(True)), F.lit("phenotype is shorter than 5")),
        F.when(b["confidence"].isNotNull() & ~b["confidence"].isin(*LEVELS), F.lit("confidence is not in the enumeration")),
    )))
    top = F.array_compact(F.array(*[F.when(bad, F.struct(F.lit(path).alias("path"), F.lit(m).alias("message"))) for path, bad, m in checks]))
    deep = F.flatten(F.transform(each, lambda ms, i: F.transform(ms, lambda m: F.struct(F.concat(F.lit("bullets/"), i.cast("string")).alias("path"), m.alias("message")))))
    return F.concat(top, deep)
