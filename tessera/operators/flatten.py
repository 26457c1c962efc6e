"""Entity documents to flat relations, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def genes(docs: DataFrame, r6: DataFrame | None = None, r5: DataFrame | None = None) -> DataFrame:
    """One row per entity with counts; coordinates of two releases joined on the left by id (missing: null)."""
    rows = docs.select(
        "fbgn", "symbol", F.col("notes"), F.col("model.provider").alias("provider"), F.col("model.model_id").alias("model_id"), F.col("model.harness").alias("harness"),
        F.col("source.n_pubs_total").alias("n_pubs_total"), F.coalesce(F.size("bullets"), F.lit(0)).alias("n_bullets"), F.greatest(F.size("references"), F.lit(0)).alias("n_refs"), "schema_version", "distilled_at",
        F.concat_ws(" ", F.slice(F.transform("bullets", lambda b: b["phenotype"]), 1, 3)).alias("summary"),
    )
    for table, end in ((r6, ""), (r5, "_r5")):
        if table is not None:
            rows = rows.join(table.select("fbgn", *[F.col(c).alias(c + end) for c in ("chr", "start", "end", "strand")]), "fbgn", "left")
    return rows


def synonyms(docs: DataFrame) -> DataFrame:
    return docs.select("fbgn", F.inline("synonyms")).select("fbgn", "synonym", "type", F.coalesce("is_current", F.lit(False)).alias("is_current"))


def synonyms_of_any_kind(rows: DataFrame, key: str, column: str) -> DataFrame:
    """key, synonym, type, is_current of a JSON array whose items are objects or, as in older documents, plain strings (type unknown, current)."""
    each = rows.select(key, F.explode(F.from_json(column, "array<string>")).alias("x"))
    field = lambda f: F.get_json_object("x", f"$.{f}")
    plain = ~F.col("x").startswith("{")
    return each.select(key, F.when(plain, F.col("x")).otherwise(field("synonym")).alias("synonym"), F.when(plain, "unknown").otherwise(field("type")).alias("type"),
                       F.when(plain, True).otherwise(F.coalesce(field("is_current") == "true", F.lit(False))).alias("is_current"))


def index_genes(docs: DataFrame) -> DataFrame:
    """The older index's row of an entity: snapshot, notes, counts of bullets and lint, versions and tokens."""
    count = lambda c: F.greatest(F.size(c), F.lit(0)).cast("long")
    return docs.select("fbgn", "symbol", "snapshot", "notes", count("bullets").alias("n_bullets"), count("_lint").alias("n_lint"), "schema_version", "distilled_at", F.col("source.input_tokens").alias("input_tokens"), F.col("source.output_tokens").alias("output_tokens"))


def bullets(docs: DataFrame) -> DataFrame:
    """A row per bullet; (fbgn, bullet_id) is the natural key."""
    each = docs.select("fbgn", F.explode("bullets").alias("b"))
    return each.select("fbgn", F.col("b.id").alias("bullet_id"), "b.category", "b.phenotype", "b.direction", "b.evidence_text", "b.confidence", "b.text_specificity")


def citations(docs: DataFrame) -> DataFrame:
    """A row per citation; older key names stand in for a missing value."""
    each = docs.select("fbgn", F.explode("bullets").alias("b")).select("fbgn", F.col("b.id").alias("bullet_id"), F.explode("b.citations").alias("c"))
    value = F.coalesce("c.value", "c.id", "c.section", "c.term", F.when(F.col("c.symbol").isNotNull(), F.concat_ws(":", "c.species", "c.symbol")))
    return each.select("fbgn", "bullet_id", "c.type", value.alias("value"), "c.miniref", "c.year", "c.pmid", "c.doi", "c.title")


def _tags(docs: DataFrame, field: str, name: str, by_bullet: bool) -> DataFrame:
    each = docs.select("fbgn", F.explode("bullets").alias("b")).select("fbgn", F.col("b.id").alias("bullet_id"), F.explode(f"b.{field}").alias(name))
    return each if by_bullet else each.select("fbgn", name)


def tissues(docs: DataFrame, by_bullet: bool = False) -> DataFrame:
    """Tags with repeats kept, by entity or by bullet."""
    return _tags(docs, "tissues", "tissue", by_bullet)


def life_stages(docs: DataFrame, by_bullet: bool = False) -> DataFrame:
    return _tags(docs, "life_stages", "stage", by_bullet)


def alleles(docs: DataFrame) -> DataFrame:
    return _tags(docs, "alleles", "allele", True)


def references(docs: DataFrame) -> DataFrame:
    return docs.select("fbgn", F.inline("references"))


def orthologs(docs: DataFrame) -> DataFrame:
    def of(species: str) -> DataFrame:
        each = docs.select("fbgn", F.lit(species).alias("species"), F.explode(f"cross_species.{species}_orthologs").alias("o"))
        return each.select("fbgn", "species", "o.symbol", "o.entrez_id", "o.diopt_score", "o.name")

    return of("human").unionByName(of("mouse"))


def diseases(docs: DataFrame) -> DataFrame:
    each = docs.select("fbgn", F.explode("cross_species.human_disease_links").alias("d"))
    return each.select("fbgn", "d.name", "d.omim_id", F.col("d.via_ortholog.symbol").alias("via_symbol"), F.col("d.via_ortholog.species").alias("via_species"), F.col("d.via_ortholog.diopt_score").alias("via_diopt"), "d.source")


def mouse_phenotypes(docs: DataFrame) -> DataFrame:
    return docs.select("fbgn", F.explode("cross_species.mouse_phenotype_links").alias("phenotype"))


def go_slim(docs: DataFrame) -> DataFrame:
    return docs.select("fbgn", F.explode("go_slim").alias("domain", "terms")).select("fbgn", "domain", F.explode("terms").alias("term"))


def search_documents(docs: DataFrame) -> DataFrame:
    """The text that keyword search indexes: symbol, summary, all bullets in order, notes; null becomes empty."""
    blob = F.array_join(F.transform("bullets", lambda b: F.concat_ws(" ", b["phenotype"], b["evidence_text"])), "\n")
    first = F.concat_ws(" ", F.slice(F.transform("bullets", lambda b: b["phenotype"]), 1, 3))
    return docs.select("fbgn", _or_empty("symbol").alias("symbol"), F.coalesce(first, F.lit("")).alias("summary"), F.coalesce(blob, F.lit("")).alias("bullets_text"), _or_empty("notes").alias("notes"))


RELATIONS = {
    "genes": genes, "synonyms": synonyms, "bullets": bullets, "citations": citations, "tissues": tissues, "life_stages": life_stages, "refs": references,
    "orthologs": orthologs, "diseases": diseases, "mouse_phenotypes": mouse_phenotypes, "go_slim": go_slim, "search": search_documents,
}


def nested(parent: DataFrame, key: str, children: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """``parent`` with each child relation as an array of structs: name -> (rows, order columns, columns). Childless keys get empty arrays.

    Each child is grouped once, so the plan has one shuffle a relation and no lookup per row. A parent's children meet in one
    row, so they must be what one document can hold (curated records of an entity, not a log).
    """
    out = parent
    for name, (rows, order, columns) in children.items():
        # each column is moved once
        held = [*order, *[c for c in columns if c not in order]]
        sorted_ = F.array_sort(F.collect_list(F.struct(*held)))
        grouped = rows.groupBy(key).agg((sorted_ if held == columns else F.transform(sorted_, lambda x: F.struct(*[x[c].alias(c) for c in columns]))).alias(name))
        out = out.join(grouped, key, "left")
        out = out.withColumn(name, F.coalesce(name, F.array().cast(out.schema[name].dataType)))
    return out


def by_category(rows: DataFrame, key: str, category: str, order: list[str], columns: list[str]) -> DataFrame:
    """Rows regrouped by (key, category), null as "other"; arrays in the given order."""
    items = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in [*order, *[c for c in columns if c not in order]]])))
    return rows.groupBy(key, F.coalesce(category, F.lit("other")).alias(category)).agg(F.count("*").alias("n"), items.alias("items"))


def number_bullets(docs: DataFrame, least: int = 5) -> DataFrame:
    """Bullet ids from the original position; a bullet whose phenotype is too short goes, but its number is used up."""
    numbered = F.transform("bullets", lambda b, i: b.withField("id", F.format_string("%s:b%02d", F.col("fbgn"), i + 1)))
    return docs.withColumn("bullets", F.filter(numbered, lambda b: F.length(F.trim(F.coalesce(b["phenotype"], F.lit("")))) >= least))
