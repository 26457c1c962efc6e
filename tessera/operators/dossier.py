"""Raw dossiers: everything that the bulk tables say on an entity, as one nested document, and its text.

Cells of the bulk tables are read by column expressions; the document is one grouped join a relation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tessera.operators.dedup import last_wins
from tessera.operators.flatten import nested
from tessera.operators.lookup import top_per_group

# Identifier formats in cells of the bulk tables.
STAGE = r"FBdv:(\d+)|(?<![:\d])(\d{8})(?!\d)"
PARTNER = r"flybase:([^|()]+)\(gene name\)"
REFERENCE = r"FBrf\d{7}"
EXPRESSION_TOP, SYNONYMS = 15, 25


def stage_id(cells: Column) -> Column:
    """The stage of a row: the number behind FBdv:, or one of eight digits alone, in the first cell that has either; else empty."""
    found = F.transform(cells, lambda x: F.concat(F.regexp_extract(x, STAGE, 1), F.regexp_extract(x, STAGE, 2)))
    return F.coalesce(F.get(F.filter(found, lambda x: x != ""), F.lit(0)), F.lit(""))


def first_reference(cells: Column) -> Column:
    """The first reference id in any cell; else empty."""
    found = F.transform(cells, lambda x: F.regexp_extract(x, REFERENCE, 0))
    return F.coalesce(F.get(F.filter(found, lambda x: x != ""), F.lit(0)), F.lit(""))


def allele_description(cells: Column) -> Column:
    """The longest free text from the fifth cell on (more than 15 characters with a space, no id, no number); the first among equals."""
    texts = F.filter(F.transform(F.slice(cells, F.lit(5), F.greatest(F.size(cells) - 4, F.lit(0))), lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("back"), x.alias("x"))),
                     lambda s: (s["n"] > 15) & F.contains(s["x"], F.lit(" ")) & ~s["x"].rlike("^(?:FB|GO:)") & ~s["x"].rlike("^[0-9]+$"))
    return F.coalesce(F.array_max(texts)["x"], F.lit(""))


def partner_symbol(cell: Column) -> Column:
    """The gene name in a cell of aliases; empty without one."""
    return F.regexp_extract(F.coalesce(cell, F.lit("")), PARTNER, 1)


def named_partner(symbol: Column, id_: Column) -> Column:
    """A partner by its symbol, else by its id."""
    return F.coalesce(F.nullif(F.trim(symbol), F.lit("")), id_)


def endpoints(a: Column, b: Column) -> Column:
    """The distinct ids of both ends of an interaction, each a list a|b."""
    return F.filter(F.array_union(F.split(a, r"\|"), F.split(b, r"\|")), lambda x: x != "")


def dossiers(genes: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """One document a gene (fbgn, symbol) of seventeen fields. ``parts``, all keyed by fbgn, may lack some:

    names (fullname, synonyms array), snapshots (text), best_summaries (text), auto_summaries (text), alleles (allele, fbal, class, desc, pos),
    genotypes (genotype, phenotype, stage, fbrf, pos), genetic (gene, interactor, type, fbrf, pos), physical (partner, method, pos),
    go (aspect, qualifier, go_id, evidence, ref, pos), rpkm (sample, rpkm), human (symbol, diopt, disease, pos), mouse (symbol, diopt, pos),
    publications (fbrf, pmid, pmcid, cite).
    """
    out = genes.select("fbgn", "symbol")
    for name, columns in (("names", ["fullname", "synonyms"]), ("snapshots", ["text"]), ("best_summaries", ["text"]), ("auto_summaries", ["text"])):
        field = {"names": None, "snapshots": "snapshot", "best_summaries": "best_summary", "auto_summaries": "auto_summary"}[name]
        if name in parts:
            rows = parts[name].select("fbgn", *([F.col("text").alias(field)] if field else columns))
            out = out.join(rows, "fbgn", "left")
        elif field:
            out = out.withColumn(field, F.lit(None).cast("string"))
        else:
            out = out.withColumn("fullname", F.lit(None).cast("string")).withColumn("synonyms", F.array().cast("array<string>"))
    out = out.select(*[F.slice("synonyms", 1, SYNONYMS).alias(c) if c == "synonyms" else F.coalesce(c, F.lit("")).alias(c) if c not in ("fbgn", "symbol") else F.col(c) for c in out.columns])
    shape = {
        "alleles": ("alleles", ["pos"], ["allele", "fbal", "class", "desc"]), "genotype_phenotype": ("genotypes", ["pos"], ["genotype", "phenotype", "stage", "fbrf"]),
        "genetic_interactions": ("genetic", ["pos"], ["gene", "interactor", "type", "fbrf"]), "physical_interactions": ("physical", ["first_position"], ["partner", "method"]),
        "go": ("go", ["late", "pos"], ["aspect", "qualifier", "go_id", "evidence", "ref"]), "expression_top": ("rpkm", ["n"], ["sample", "rpkm"]),
        "human_orthologs": ("human", ["pos"], ["symbol", "diopt", "disease"]), "mouse_orthologs": ("mouse", ["pos"], ["symbol", "diopt"]), "pubs": ("publications", ["fbrf"], ["fbrf", "pmid", "pmcid", "cite"]),
    }
    children = {}
    for field, (name, order, columns) in shape.items():
        if name not in parts:
            continue
        rows = parts[name]
        if name == "physical":  # a partner once, at its first place, with its last method
            rows = last_wins(rows, ["fbgn", "partner"], "pos")
        elif name == "go":  # electronic annotations come last
            rows = rows.withColumn("late", (F.col("evidence") == "IEA").cast("int"))
        elif name == "rpkm":
            rows = top_per_group(rows, ["fbgn"], [F.desc("rpkm"), F.col("sample")], EXPRESSION_TOP, "n")
        elif name == "publications":
            rows = rows.dropDuplicates(["fbgn", "fbrf"])
        children[field] = (rows, order, columns)
    out = nested(out, "fbgn", children)
    if "pubs" in out.columns:  # all are counted; those with an id are listed, latest id first
        out = out.withColumn("n_pubs", F.size("pubs").cast("long")).withColumn("pubs", F.reverse(F.filter("pubs", lambda p: (F.coalesce(p["pmid"], F.lit("")) != "") | (F.coalesce(p["pmcid"], F.lit("")) != ""))))
    return out


def coverage_gap(dossier: DataFrame, docs: DataFrame) -> DataFrame:
    """fbgn, n_bullets, n_total, n_used, gap: publications that the entity's document did not use."""
    have = docs.select("fbgn", F.greatest(F.size("bullets"), F.lit(0)).cast("long").alias("n_bullets"), F.col("source.n_pubs_total").alias("total"), F.col("source.n_abstracts_used").alias("used"))
    rows = dossier.select("fbgn", "n_pubs").join(have, "fbgn", "left")
    total = F.coalesce(F.nullif("total", F.lit(0)), "n_pubs", F.lit(0))
    return rows.select("fbgn", F.coalesce("n_bullets", F.lit(0)).alias("n_bullets"), total.alias("n_total"), F.coalesce("used", F.lit(0)).alias("n_used"), (total - F.coalesce("used", F.lit(0))).alias("gap"))


def text(d: Row) -> str:
    """One dossier (a collected row) as Markdown."""
    d = d.asDict()
    block = lambda title, items, show: [f"## {title} ({len(items)})", *[f"- {show(x)}" for x in items], ""]
    mark = lambda x, shape: shape.format(x) if x else ""
    out = [f"# {d['symbol']} ({d['fbgn']})", ""]
    out += [x for x in (d.get("fullname"), d.get("snapshot") or d.get("best_summary")) if x] + [""]
    sections = (
        ("Human orthologs", "human_orthologs", lambda o: f"{o['symbol']} {o['diopt']}{mark(o['disease'], ': {}')}"), ("Mouse orthologs", "mouse_orthologs", lambda o: f"{o['symbol']} {o['diopt']}"),
        ("Alleles", "alleles", lambda a: f"{a['allele']} ({a['fbal']}){mark(a['class'], ', {}')}: {(a['desc'] or 'no description')[:240]}"),
        ("Genotypes and phenotypes", "genotype_phenotype", lambda g: f"{g['genotype']}: {g['phenotype']}{mark(g['stage'], ' [{}]')}{mark(g['fbrf'], ' <{}>')}"),
        ("Genetic interactions", "genetic_interactions", lambda g: f"{g['gene']}, {g['type']}, {g['interactor']}{mark(g['fbrf'], ' <{}>')}"), ("Physical interactions", "physical_interactions", lambda p: f"{p['partner']}{mark(p['method'], ' ({})')}"),
        ("Annotations", "go", lambda g: f"[{g['aspect']}] {g['qualifier']} {g['go_id']} ({g['evidence']}; {g['ref']})"), ("Expression", "expression_top", lambda x: f"{x['sample']}: {x['rpkm']}"),
        ("Publications", "pubs", lambda p: f"{p['cite'] or p['fbrf']}{mark(p['pmid'], ' PMID:{}')}{mark(p['pmcid'], ' {}')}"),
    )
    for title, field, show in sections:
        if d.get(field):
            out += block(title, d[field], show)
    return "\n".join(out)
