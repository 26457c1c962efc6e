"""Text of prompts, sections, links and reports, as column expressions and thin renderers of small results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def link(pmid: Column, doi: Column, ref: Column, base: str = "https://example.org/ref/") -> Column:
    """A citation's link: by PMID, else DOI, else reference id; null without any."""
    return F.coalesce(F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), present(pmid), F.lit("/")), F.concat(F.lit("https://doi.org/"), present(doi)), F.concat(F.lit(base), present(ref)))


def listed(items: Column, each, sep: str = "\n", cap: int | None = None) -> Column:
    """Rendered items of an array, the first ``cap``, joined."""
    return F.array_join(F.transform(F.slice(items, 1, cap) if cap else items, each), sep)


def entity_text(symbol: Column, name: Column, summary: Column, bullets: Column, terms: Column, notes: Column, cap: int = 14_000, least: int = 1500) -> Column:
    """The text that an entity's vector is made of: head, terms and notes first, bullets in what is left of ``cap`` but at least ``least`` characters."""
    head = F.concat_ws("\n", F.concat_ws(" ", symbol, present(name)), F.substring(summary, 1, 600), F.array_join(F.slice(terms, 1, 15), "; "), F.substring(notes, 1, 300))
    blob = F.array_join(F.transform(bullets, lambda b: F.substring(b, 1, 200)), "\n")
    room = F.greatest(F.lit(least), F.lit(cap) - F.length(head))
    return F.substring(F.concat_ws("\n", head, F.substring(blob, F.lit(1), room)), 1, cap)


def interaction_summary(edges: DataFrame, key: str, partner: str, kind: str, reference: str, position: str, cap: int = 60) -> DataFrame:
    """key and text: edges grouped by partner and kind, with count and first reference, largest groups first."""
    from tessera.operators.lookup import top_per_group

    groups = edges.groupBy(key, partner, kind).agg(F.count("*").alias("n"), F.min_by(reference, position).alias("ref"))
    top = top_per_group(groups, [key], [F.desc("n"), F.col(partner), F.col(kind)], cap)
    line = F.concat(F.col(partner), F.lit(" ("), F.col(kind), F.lit(") x"), F.col("n").cast("string"), F.coalesce(F.concat(F.lit(" ["), F.col("ref"), F.lit("]")), F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return top.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


def phenotype_lines(rows: DataFrame, key: str, position: str, columns: list[str], scan: int = 400, keep: int = 200) -> DataFrame:
    """key and text of distinct phenotype rows: the first ``scan`` rows of a key are looked at, repeats go, the first ``keep`` stay.

    Rows of one position are ordered by their columns.
    """
    from tessera.operators.dedup import first_wins
    from tessera.operators.lookup import top_per_group

    order = [F.col(position), *[F.col(c) for c in columns]]
    some = top_per_group(rows, [key], order, scan, "__scan")
    once = first_wins(some, [F.col(key), *[F.col(c) for c in columns]], [position])
    kept = top_per_group(once, [key], order, keep, "__keep")
    ordered = F.array_sort(F.collect_list(F.struct("__keep", F.concat_ws(" | ", *columns).alias("line"))))
    return kept.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


def allele_lines(rows: DataFrame, key: str, position: str, cap: int = 60) -> DataFrame:
    """key and text: the described alleles among the first ``cap`` rows (allele, description, reference) of a key."""
    from tessera.operators.lookup import top_per_group

    some = top_per_group(rows, [key], [F.col(position), F.col("allele")], cap, "__place").where(F.coalesce("description", F.lit("")) != "")
    line = F.concat(F.lit("  \u2022 "), F.col("allele"), F.lit(": "), F.col("description"), F.coalesce(F.concat(F.lit(" <"), present(F.col("reference")), F.lit(">")), F.lit("")))
    return _text(some, key, line)


def partner_lines(edges: DataFrame, symbols: DataFrame, key: str, cap: int = 60) -> DataFrame:
    """key and text: physical partners (partner, assay) with the most evidence first, by symbol (id, symbol) or else id, three assays each."""
    from tessera.operators.dossier import named_partner
    from tessera.operators.lookup import top_per_group

    groups = edges.groupBy(key, "partner").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(present(F.col("assay")))).alias("assays"))
    top = top_per_group(groups, [key], [F.desc("n"), F.col("partner")], cap, "__place").join(symbols.select(F.col("id").alias("partner"), "symbol"), "partner", "left")
    name = F.concat(F.lit("  \u2022 "), named_partner(F.col("symbol"), F.col("partner")), F.lit(" ("), F.col("partner"), F.lit(")"))
    assays = F.when(F.size("assays") > 0, F.concat(F.lit(" \u2014 "), F.array_join(F.slice("assays", 1, 3), "; "))).otherwise("")
    return _text(top, key, F.concat(name, assays, F.when(F.col("n") > 1, F.concat(F.lit(" ("), F.col("n").cast("string"), F.lit(" evidence rows)"))).otherwise("")))


def disease_lines(rows: DataFrame, key: str, position: str, cap: int = 40) -> DataFrame:
    """key and text: distinct disease annotations (do_term, qualifier, allele, ortholog, evidence, reference) among the first ``cap`` rows of a key."""
    from tessera.operators.dedup import first_wins
    from tessera.operators.lookup import top_per_group

    same = ["do_term", "qualifier", "allele", "ortholog", "evidence"]
    order = [F.col(position), *[F.col(c) for c in same]]
    once = first_wins(top_per_group(rows, [key], order, cap, "__place"), [F.col(key), *[F.col(c) for c in same]], ["__place"])
    part = lambda before, c, after="": F.coalesce(F.concat(F.lit(before), present(F.col(c)), F.lit(after)), F.lit(""))
    line = F.concat(F.lit("  \u2022 "), "do_term", F.lit(" ("), F.coalesce(present(F.col("qualifier")), F.lit("model of")), F.lit(")"), part(" via allele ", "allele"), part(" [ortholog: ", "ortholog", "]"), part(" \u2014 ", "evidence"), part(" <", "reference", ">"))
    return _text(once, key, line)


def _text(rows: DataFrame, key: str, line: Column) -> DataFrame:
    """key and text: the rows' lines in order of ``__place``."""
    ordered = F.array_sort(F.collect_list(F.struct("__place", line.alias("line"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


# The headings of the sections of a model's input, in order.
SECTION_HEADS = {
    "function": "FUNCTION", "phenotypes_sub": "PHENOTYPES (FlyBase curated)", "alleles_main_sub": "ALLELES", "hdm_sub": "HUMAN DISEASE MODELS (OMIM + experimental evidence)", "other_comments_sub": "CURATOR NOTES",
    "summary_genetic_interactions_sub": "GENETIC INTERACTIONS", "summary_physical_interactions_sub": "PHYSICAL INTERACTIONS", "pathways_sub": "PATHWAYS", "gene_class_sub": "GENE CLASS",
}


def input_message(entity: Column, summary: Column, terms: Column, sections: Column, abstracts: Column) -> Column:
    """A model's input: the entity, its summary, its terms (map of domain to names), sections with more than five characters under their
    headings, and abstracts (array of structs fbrf, title, abstract)."""
    domains = F.array_join(F.transform(F.array_sort(F.map_entries(terms)), lambda e: F.concat(F.lit("  "), e["key"], F.lit(": "), F.when(F.size(e["value"]) > 0, F.array_join(e["value"], ", ")).otherwise("(none)"))), "\n")
    blocks = []
    for name, head in SECTION_HEADS.items():
        body = F.trim(F.element_at(sections, name))
        blocks.append(F.when(F.length(body) > 5, F.concat(F.lit(f"## {head}\n"), body, F.lit("\n"))))
    shown = F.transform(F.filter(abstracts, lambda a: F.coalesce(a["abstract"], F.lit("")) != ""), lambda a: F.concat_ws("\n", F.concat_ws(" ", F.lit("###"), a["fbrf"], a["title"]), a["abstract"]))
    return F.concat_ws("\n", F.concat(F.lit("# GENE: "), entity), F.concat(F.lit("## AUTO SUMMARY\n"), F.coalesce(summary, F.lit("")), F.lit("\n")), F.concat(F.lit("## GENE ONTOLOGY\n"), domains), *blocks, F.array_join(shown, "\n"))


def shrink(bundle: DataFrame, level: int) -> DataFrame:
    """A smaller input: fewer abstracts (10, then 5), sections cut to half their lines but at least 40, then to 30 lines."""
    lines = lambda v: F.split(v, "\n")
    keep = lambda v: F.greatest(F.lit(40), F.floor(F.size(lines(v)) / 2).cast("int")) if level == 1 else F.lit(30)
    sections = F.transform_values("sections", lambda k, v: F.array_join(F.slice(lines(v), F.lit(1), keep(v)), "\n"))
    return bundle.withColumn("abstracts", F.slice("abstracts", 1, 10 if level == 1 else 5)).withColumn("sections", sections)


def markdown(columns: list[str], rows: Iterable) -> str:
    """A Markdown table of a small collected result."""
    clean = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    return "\n".join(lines + ["| " + " | ".join(clean(x) for x in r) + " |" for r in rows])
