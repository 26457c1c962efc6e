"""Projections of entity inputs and documents: trimmed bundles, size accounts, per-entity summaries, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sections an audit sees, and the caps of its input.
AUDIT_SECTIONS = ("phenotypes_sub", "alleles_main_sub", "hdm_sub", "other_comments_sub", "auto_summary")
ABSTRACT_CHARS, SUMMARY_CHARS = 1500, 600


def compact(bundle: DataFrame, sections: tuple[str, ...] = AUDIT_SECTIONS) -> DataFrame:
    """``bundle`` (sections map, abstracts array<struct<pmid, abstract>>) as an auditor sees it: named sections, shortened abstracts and summary."""
    cut = lambda k: SUMMARY_CHARS if k == "auto_summary" else None
    kept = F.map_filter("sections", lambda k, v: k.isin(*sections) & (F.length(F.trim(v)) > 0))
    kept = F.transform_values(kept, lambda k, v: F.when(k == "auto_summary", F.substring(v, 1, cut("auto_summary"))).otherwise(v))
    abstracts = F.transform("abstracts", lambda a: a.withField("abstract", F.substring(a["abstract"], 1, ABSTRACT_CHARS)))
    return bundle.withColumn("sections", kept).withColumn("abstracts", abstracts)


def sizes(bundle: DataFrame, key: str) -> DataFrame:
    """key, chars of all sections and abstracts, and how many have text."""
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + F.length(F.coalesce(x, F.lit("")))).alias
    texts = F.transform("abstracts", lambda a: a["abstract"])
    filled = lambda xs: F.size(F.filter(xs, lambda x: F.length(F.trim(x)) > 0)).cast("long")
    return bundle.select(key, total(F.map_values("sections"))("section_chars"), total(texts)("abstract_chars"), filled(F.map_values("sections")).alias("n_sections"), filled(texts).alias("n_abstracts"))


def summaries(docs: DataFrame) -> DataFrame:
    """One row of counts for each entity document."""
    flat = lambda f: F.size(F.flatten(F.transform("bullets", lambda b: F.coalesce(b[f], F.array())))).cast("long")
    links = F.col("cross_species.human_disease_links")
    return docs.select(
        "fbgn", F.greatest(F.size("bullets"), F.lit(0)).cast("long").alias("n_bullets"), flat("citations").alias("n_citations"), flat("tissues").alias("n_tissues"),
        F.greatest(F.size(links), F.lit(0)).cast("long").alias("n_diseases"), F.size(F.filter(links, lambda d: d["omim_id"].isNotNull())).cast("long").alias("n_omim"),
        F.greatest(F.size("_lint"), F.lit(0)).cast("long").alias("n_lint"),
    )


def inference_prompt(symbol: Column, orthologs: Column, diseases: Column) -> Column:
    """Text on an entity without own evidence: 15 terms an ortholog with short definitions, 5 diseases with 5 terms each.

    ``orthologs``: array<struct<symbol, terms array<struct<term, definition>>>>; ``diseases``: array<struct<name, terms array<string>>>.
    """
    term = lambda t: F.concat(F.lit("  - "), t["term"], F.coalesce(F.concat(F.lit(": "), F.substring(t["definition"], 1, 150)), F.lit("")))
    one = lambda o: F.concat_ws("\n", o["symbol"], F.array_join(F.transform(F.slice(o["terms"], 1, 15), term), "\n"))
    ill = lambda d: F.concat(F.lit("* "), d["name"], F.lit(" ["), F.array_join(F.slice(d["terms"], 1, 5), "; "), F.lit("]"))
    return F.concat_ws("\n", F.concat(F.lit("Entity: "), symbol), F.array_join(F.transform(orthologs, one), "\n"), F.array_join(F.transform(F.slice(diseases, 1, 5), ill), "\n"))


def aliases(synonyms: Column, symbol: Column, n: int = 6) -> Column:
    """The first ``n`` synonyms to show: neither the symbol itself nor secondary ids."""
    shown = F.filter(synonyms, lambda s: (s["synonym"] != symbol) & (F.coalesce(s["type"], F.lit("")) != "secondary_fbgn"))
    return F.slice(F.array_distinct(F.transform(shown, lambda s: s["synonym"])), 1, n)


def shown_citations(citations: Column, base: str = "https://example.org/ref/") -> Column:
    """array<struct<label, url>> of the publications cited: label by short reference, else id; link by PMID, DOI, id."""
    url = lambda c: F.coalesce(F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), F.nullif(c["pmid"], F.lit("")), F.lit("/")), F.concat(F.lit("https://doi.org/"), F.nullif(c["doi"], F.lit(""))), F.concat(F.lit(base), c["value"]))
    return F.transform(F.filter(citations, lambda c: c["type"] == "fbrf"), lambda c: F.struct(F.coalesce(F.nullif(c["miniref"], F.lit("")), c["value"]).alias("label"), url(c).alias("url")))
