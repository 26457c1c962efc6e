"""Canonical entity documents: assembly from relations, cleaning, cross-species enrichment, inferred bullets, storage.

A document's own arrays are rewritten in place by higher-order functions; only enrichment joins, as it looks up other tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedup import folded
from tessera.operators.flatten import nested
from tessera.operators.lookup import top_per_group


def _flag(c: Column) -> Column:
    return (F.coalesce(c.cast("string"), F.lit("")) != "").cast("int")


def best_of_each(items: Column, key: Callable[[Column], Column], completeness: Callable[[Column], list[Column]]) -> Column:
    """The array with one item a key, in order of first use: the most complete one, the first among equals. Empty keys go."""
    ranked = F.transform(items, lambda x, i: F.struct(key(x).alias("k"), F.struct(*completeness(x), -i).alias("r"), x.alias("x")))
    keys = F.filter(F.array_distinct(F.transform(items, key)), lambda k: k.isNotNull())
    return F.transform(keys, lambda k: F.array_max(F.transform(F.filter(ranked, lambda z: z["k"] == k), lambda z: F.struct(z["r"], z["x"])))["x"])


def clean_orthologs(items: Column) -> Column:
    """One record a trimmed symbol: with an id, then by score, then by the length of its name."""
    return best_of_each(items, lambda o: F.nullif(F.trim(o["symbol"]), F.lit("")), lambda o: [_flag(o["entrez_id"]), F.coalesce(o["diopt_score"], F.lit(0)), F.length(F.coalesce(o["name"], F.lit("")))])


def clean_diseases(items: Column) -> Column:
    """One record a disease id and folded name: with an id, then with the ortholog it came by, then by the length of its source."""
    via = lambda d, f: _flag(d["via_ortholog"][f])
    return best_of_each(items, lambda d: F.struct(F.coalesce(d["omim_id"], F.lit("")), folded(F.coalesce(d["name"], F.lit("")))),
                        lambda d: [_flag(d["omim_id"]), via(d, "symbol"), via(d, "species"), F.length(F.coalesce(d["source"], F.lit("")))])


def clean_bullets(items: Column) -> Column:
    """The first bullet of each (phenotype, evidence), both trimmed."""
    text = lambda b, f: F.trim(F.coalesce(b[f], F.lit("")))
    return best_of_each(items, lambda b: F.struct(text(b, "phenotype"), text(b, "evidence_text")), lambda b: [F.lit(0)])


# The prefix that was written without a species, and what tells the species.
UNTOLD_PREFIX = r"(?i)^INFERENCE from mouse\|human ortholog ([^:]+):"
SPECIES_MARKS = (("[MP:", "mouse"), ("[HP:", "human"), ("MP:", "mouse"), ("HP:", "human"))


def told_evidence(source: Column, evidence: Column) -> Column:
    """Evidence of an inferred bullet with its species in the prefix, where a term in the rest tells it; else as it is."""
    text = F.trim(evidence)
    body = F.regexp_replace(text, UNTOLD_PREFIX, "")
    species = F.coalesce(*[F.when(F.contains(body, F.lit(mark)), F.lit(name)) for mark, name in SPECIES_MARKS])
    fits = (source == "ortholog_inference") & text.rlike(UNTOLD_PREFIX) & species.isNotNull()
    return F.when(fits, F.concat(F.lit("INFERENCE from "), species, F.lit(" ortholog "), F.trim(F.regexp_extract(text, UNTOLD_PREFIX, 1)), F.lit(":"), body)).otherwise(evidence)


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` cleaned, with n_bullets and ``counts``: a struct of how many orthologs, diseases and bullets there were and are, and repaired prefixes."""
    cs = F.col("cross_species")
    size = lambda xs: F.greatest(F.size(xs), F.lit(0)).cast("long")
    told = F.transform("bullets", lambda b: b.withField("evidence_text", told_evidence(b["source"], b["evidence_text"])))
    species = cs.withField("human_orthologs", clean_orthologs(cs["human_orthologs"])).withField("mouse_orthologs", clean_orthologs(cs["mouse_orthologs"])).withField("human_disease_links", clean_diseases(cs["human_disease_links"]))
    rows = docs.withColumn("told", told)
    rows = rows.withColumn("new_species", species).withColumn("new_bullets", clean_bullets(F.col("told")))
    repaired = F.size(F.filter(F.zip_with("bullets", "told", lambda a, b: ~a["evidence_text"].eqNullSafe(b["evidence_text"])), lambda x: x)).cast("long")
    both = lambda c: size(c["human_orthologs"]) + size(c["mouse_orthologs"])
    counts = F.struct(
        both(cs).alias("ortho_before"), both(F.col("new_species")).alias("ortho_after"), size(cs["human_disease_links"]).alias("disease_before"), size(F.col("new_species.human_disease_links")).alias("disease_after"),
        size(F.col("bullets")).alias("bullets_before"), size(F.col("new_bullets")).alias("bullets_after"), F.coalesce(repaired, F.lit(0)).alias("inference_repaired"),
    )
    rows = rows.withColumn("counts", counts).withColumn("n_bullets", size(F.col("new_bullets")))
    new = {"cross_species": F.col("new_species"), "bullets": F.col("new_bullets")}
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns if c not in ("counts", "n_bullets")], "n_bullets", "counts")


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    """One row: documents, changed documents, and the sums of all counts."""
    c = lambda f: F.col(f"counts.{f}")
    changed = (c("ortho_before") != c("ortho_after")) | (c("disease_before") != c("disease_after")) | (c("bullets_before") != c("bullets_after")) | (c("inference_repaired") > 0)
    names = [f.name for f in cleaned.schema["counts"].dataType.fields]
    return cleaned.agg(F.count("*").alias("documents"), F.count(F.when(changed, 1)).alias("changed"), *[F.coalesce(F.sum(c(f)), F.lit(0)).alias(f) for f in names])


def assemble(tables: dict[str, DataFrame]) -> DataFrame:
    """Documents from relations: genes with their synonyms, numbered bullets (tags and citations inside), references, orthologs and diseases.

    The inverse of flattening: each relation is grouped once by its key.
    """
    cite = [f for f in ("type", "value", "miniref", "year", "pmid", "doi", "title") if f in tables["citations"].columns]
    own = nested(tables["bullets"], "bullet_id", {
        "citations": (tables["citations"].select("bullet_id", *cite), ["type", "value"], cite), "tissues": (tables["tissues"].select("bullet_id", "tissue"), ["tissue"], ["tissue"]),
        "life_stages": (tables["life_stages"].select("bullet_id", "stage"), ["stage"], ["stage"]),
    })
    own = own.withColumn("id", F.col("bullet_id")).withColumn("tissues", F.transform("tissues", lambda x: x["tissue"])).withColumn("life_stages", F.transform("life_stages", lambda x: x["stage"]))
    names = [f.split(":")[0].split(" ")[0] for f in ("id", "category", "phenotype", "direction", "evidence_text", "confidence", "text_specificity", "tissues", "life_stages", "citations")]
    species = lambda s: tables["orthologs"].where(F.col("species") == s)
    o = ["symbol", "entrez_id", "diopt_score", "name"]
    docs = nested(tables["genes"].select("fbgn", "symbol", "notes", "schema_version", "distilled_at"), "fbgn", {
        "synonyms": (tables["synonyms"], ["synonym", "type"], ["synonym", "type", "is_current"]), "bullets": (own, ["bullet_id"], names), "refs": (tables["refs"], ["fbrf"], ["fbrf", "title", "miniref", "year", "pmid", "doi"]),
        "human": (species("human"), o, o), "mouse": (species("mouse"), o, o), "diseases": (tables["diseases"], ["name", "omim_id"], ["name", "omim_id", "source"]),
    })
    cross = F.struct(F.col("human").alias("human_orthologs"), F.col("mouse").alias("mouse_orthologs"), F.col("diseases").alias("human_disease_links"))
    return docs.withColumn("cross_species", cross).withColumnRenamed("refs", "references").drop("human", "mouse", "diseases")


def canonical_json(docs: DataFrame, key: str = "fbgn") -> DataFrame:
    """key, json (one line) and its SHA-256: what a document is stored and compared by."""
    line = F.to_json(F.struct(*[F.col(c) for c in docs.columns]))
    return docs.select(key, line.alias("json")).withColumn("sha256", F.sha2("json", 256))


def write_documents(docs: DataFrame, path: str, key: str = "fbgn") -> None:
    """JSON lines below ``path``, a folder for each two-digit MD5 prefix of the key; the commit protocol makes it all or nothing."""
    lines = canonical_json(docs, key).withColumn("shard", F.substring(F.md5(F.col(key)), 1, 2))
    lines.repartition("shard").select("shard", F.col("json").alias("value")).write.mode("overwrite").partitionBy("shard").text(path)


def _terms(pairs: DataFrame, ids: DataFrame, dictionary: DataFrame, by: str, id_: str, cap: int, columns: list[str]) -> DataFrame:
    """fbgn and a map from ``by`` to the terms of its first ``cap`` ids, those that the dictionary knows."""
    hits = top_per_group(pairs.join(ids.select(by, id_).distinct(), by), ["fbgn", by], [F.col(id_)], cap, "n").drop("n")
    known = hits.join(dictionary, id_)
    lists = known.groupBy("fbgn", by).agg(F.array_sort(F.collect_list(F.struct(id_, *columns))).alias("terms"))
    return lists.groupBy("fbgn").agg(F.map_from_entries(F.collect_list(F.struct(by, "terms"))).alias("found"))


def _with_terms(items: str, by: str, name: str, none: Column) -> Column:
    """The items with a field ``name``: what the map ``found`` has for their ``by``."""
    return F.transform(items, lambda x: x.withField(name, F.coalesce(F.element_at(F.col("found"), F.coalesce(x[by], F.lit(""))), none)))


def enrich(docs: DataFrame, mp_terms: DataFrame, mouse: DataFrame, hp_terms: DataFrame, human: DataFrame, diseases: DataFrame, cap: int = 20, disease_cap: int = 12) -> DataFrame:
    """``docs`` with the phenotype terms of their orthologs and diseases: mgi_phenotypes by symbol, hpo_phenotypes by gene id, hpo_terms by disease id.

    ``mp_terms``: mp_id, term, definition; ``mouse``: symbol, mp_id; ``hp_terms``: hp_id, term, definition; ``human``: entrez_id, hp_id;
    ``diseases``: omim_id, hp_id. Ids are taken in order, ``cap`` at most, before unknown ones go. Definitions are cut to 300 characters.
    """
    short = lambda df: df.withColumn("definition", F.substring(F.coalesce("definition", F.lit("")), 1, 300))
    out = docs
    steps = (("mouse_orthologs", "symbol", mouse, short(mp_terms), "mp_id", cap, ["term", "definition"], "mgi_phenotypes"), ("human_orthologs", "entrez_id", human, short(hp_terms), "hp_id", cap, ["term", "definition"], "hpo_phenotypes"),
             ("human_disease_links", "omim_id", diseases, hp_terms.drop("definition"), "hp_id", disease_cap, ["term"], "hpo_terms"))
    for field, by, ids, dictionary, id_, n, columns, name in steps:
        pairs = docs.select("fbgn", F.explode(F.array_distinct(F.col(f"cross_species.{field}.{by}"))).alias(by)).where(F.coalesce(by, F.lit("")) != "")
        found = _terms(pairs, ids, dictionary, by, id_, n, columns)
        out = out.join(found, "fbgn", "left")
        none = F.array().cast(out.schema["found"].dataType.valueType)
        out = out.withColumn("cross_species", F.col("cross_species").withField(field, _with_terms(f"cross_species.{field}", by, name, none))).drop("found")
    return out


def attached(enriched: DataFrame) -> DataFrame:
    """One row: orthologs and diseases, and how many got terms."""
    has = lambda field, name: F.coalesce(F.size(F.filter(f"cross_species.{field}", lambda x: F.size(x[name]) > 0)), F.lit(0))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    size = lambda field: F.greatest(F.size(f"cross_species.{field}"), F.lit(0))
    return enriched.agg(
        F.count("*").alias("documents"), total(size("mouse_orthologs"), "mouse"), total(has("mouse_orthologs", "mgi_phenotypes"), "mouse_with_terms"), total(size("human_orthologs"), "human"),
        total(has("human_orthologs", "hpo_phenotypes"), "human_with_terms"), total(size("human_disease_links"), "diseases"), total(has("human_disease_links", "hpo_terms"), "diseases_with_terms"),
    )


def inference_state(enriched: DataFrame) -> DataFrame:
    """fbgn, state: already enriched, no ortholog material, or ready for inference; and its distinct ``terms``."""
    names = lambda field, inner: F.flatten(F.transform(F.coalesce(f"cross_species.{field}", F.array()), lambda x: F.transform(x[inner], lambda p: p["term"])))
    terms = F.array_sort(F.array_distinct(F.array_compact(F.concat(names("mouse_orthologs", "mgi_phenotypes"), names("human_orthologs", "hpo_phenotypes"), names("human_disease_links", "hpo_terms")))))
    done = F.exists(F.coalesce("bullets", F.array().cast(enriched.schema["bullets"].dataType)), lambda b: b["source"] == "ortholog_inference")
    rows = enriched.select("fbgn", done.alias("done"), terms.alias("terms"))
    return rows.select("fbgn", F.when(F.col("done"), "already enriched").when(F.size("terms") == 0, "no ortholog material").otherwise("ready").alias("state"), "terms")


def append_inference(docs: DataFrame, bullets: DataFrame) -> DataFrame:
    """``docs`` with inferred bullets (fbgn, phenotype, evidence_text, category, direction) appended, numbered inf:ID:bNN, and a lint entry that counts them."""
    made = bullets.groupBy("fbgn").agg(F.array_sort(F.collect_list(F.struct("phenotype", "evidence_text", "category", "direction"))).alias("new"))
    rows = docs.join(made, "fbgn", "left")
    kind = docs.schema["bullets"].dataType
    have = {"phenotype", "evidence_text", "category", "direction"}
    empty = {"citations", "tissues", "life_stages", "alleles"}

    def one(b: Column, i: Column) -> Column:
        given = {"id": F.format_string("inf:%s:b%02d", F.col("fbgn"), i + 1), "source": F.lit("ortholog_inference"), "confidence": F.lit("low"), "text_specificity": F.lit("low")}
        fields = [(b[f.name] if f.name in have else F.array() if f.name in empty else given.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in kind.elementType.fields]
        return F.struct(*fields)

    added = F.concat(F.coalesce("bullets", F.array().cast(kind)), F.transform("new", one))
    note = F.struct(F.lit("inference.ortholog_bullets_added").alias("code"), F.lit("info").alias("severity"), F.concat(F.lit("Added "), F.size("new").cast("string"), F.lit(" inference bullets")).alias("message"))
    lint = F.concat(F.coalesce("_lint", F.array().cast(docs.schema["_lint"].dataType)), F.array(note))
    new = {"bullets": F.when(F.col("new").isNull(), F.col("bullets")).otherwise(added), "_lint": F.when(F.col("new").isNull(), F.col("_lint")).otherwise(lint)}
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])
