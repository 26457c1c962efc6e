"""Delimited bulk tables, coordinate maps, region files and id lists, all with explicit columns.

Bulk tables are plain tab-separated text (a quote is a character like any other) with comment lines; a row that is too
short for its table is left out. Compressed files cannot be split, so rows are dealt anew after reading when ``spread`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.positions import parse_location


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``value`` of each row by a generator, which no filter is pushed through: it is made once, not again for each of its uses above."""
    return df.select(F.explode(F.array(value)).alias(name))


def tsv_rows(spark: SparkSession, path: str | DataFrame, least: int = 1, comments: tuple[str, ...] = ("#",), spread: int | None = None) -> DataFrame:
    """``c``: the cells of each row with at least ``least`` of them. ``path`` may be a DataFrame of lines (value)."""
    lines = path if isinstance(path, DataFrame) else spark.read.text(path)
    if spread:
        lines = lines.repartition(spread)
    keep = F.trim("value") != ""
    for mark in comments:
        keep = keep & ~F.col("value").startswith(mark)
    cells = _once(_once(lines, F.col("value"), "value").where(keep), F.split(F.regexp_replace("value", r"\r$", ""), "\t"), "c")
    return cells.where(F.size("c") >= least)


def cell(k: int) -> Column:
    return F.trim(F.get("c", F.lit(k)))


def blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def annotation_ids(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, symbol, synonyms: secondary ids, the annotation id (current) and secondary annotation ids, typed."""
    split = lambda k: F.filter(F.split(F.coalesce(cell(k), F.lit("")), ","), lambda x: F.trim(x) != "")
    typed = lambda xs, kind, now: F.transform(xs, lambda x: F.struct(F.trim(x).alias("synonym"), F.lit(kind).alias("type"), F.lit(now).alias("is_current")))
    own = F.when(cell(4) != "", F.array(cell(4))).otherwise(F.array().cast("array<string>"))
    rows = tsv_rows(spark, path, 5)
    return rows.select(cell(2).alias("fbgn"), cell(0).alias("symbol"), F.concat(typed(split(3), "secondary_fbgn", False), typed(own, "annotation_id", True), typed(split(5), "secondary_annotation_id", False)).alias("synonyms"))


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, text: the last row of each id wins. Rows of a file keep their order; several files follow each other by name."""
    at = F.monotonically_increasing_id()
    lines = path.withColumn("at", F.struct(at)) if isinstance(path, DataFrame) else spark.read.text(path).select("value", F.struct("_metadata.file_path", "_metadata.file_block_start", at.alias("n")).alias("at"))
    cells = F.split("value", "\t")
    rows = lines.where((F.size(cells) >= 2) & ~F.col("value").startswith("#"))
    return rows.groupBy(F.trim(cells[0]).alias("fbgn")).agg(F.max_by(F.trim(F.regexp_replace(cells[1], r"\r$", "")), "at").alias("text"))


def names(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, fullname, synonyms: full names and symbol synonyms (lists a|b), in this order."""
    listed = lambda k: F.filter(F.split(F.coalesce(cell(k), F.lit("")), r"\|"), lambda x: x != "")
    return tsv_rows(spark, path, 4).select(cell(0).alias("fbgn"), cell(3).alias("fullname"), F.concat(listed(4), listed(5)).alias("synonyms"))


def best_summaries(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, text: the last cell of rows of four cells or more."""
    return tsv_rows(spark, path, 4).select(cell(0).alias("fbgn"), F.trim(F.element_at("c", -1)).alias("text"))


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, symbol, text, without the placeholder that asks for contributions."""
    return tsv_rows(spark, path, 5).select(cell(0).alias("fbgn"), cell(1).alias("symbol"), cell(4).alias("text")).where(~F.col("text").startswith("Contributions welcome"))


def alleles_of(spark: SparkSession, path: str) -> DataFrame:
    """fbal, allele, fbgn, symbol, where both ids have their prefixes."""
    rows = tsv_rows(spark, path, 4).select(cell(0).alias("fbal"), cell(1).alias("allele"), cell(2).alias("fbgn"), cell(3).alias("symbol"))
    return rows.where(F.col("fbal").startswith("FBal") & F.col("fbgn").startswith("FBgn"))


def genotype_phenotypes(spark: SparkSession, path: str, alleles: DataFrame) -> DataFrame:
    """fbgn, genotype, phenotype, qualifier, reference: each row once for every gene whose alleles it lists."""
    ids = F.array_distinct(F.regexp_extract_all(cell(1), F.lit(r"FBal\d{7}"), F.lit(0)))
    rows = tsv_rows(spark, path, 4).withColumn("row", F.xxhash64("c"))
    each = rows.select("row", F.explode(ids).alias("fbal"), cell(0).alias("genotype"), cell(2).alias("phenotype"), blank(cell(4)).alias("qualifier"), blank(cell(6)).alias("reference"))
    return each.join(alleles.select("fbal", "fbgn").distinct(), "fbal").drop("fbal").distinct().drop("row")


def allele_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, allele, text, reference of the 21-column table, where there is a text."""
    return tsv_rows(spark, path, 21).select(cell(3).alias("fbgn"), cell(0).alias("allele"), blank(cell(18)).alias("text"), blank(cell(19)).alias("reference")).where("text is not null")


def human_orthologs(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, symbol, hgnc, diopt_score, diseases: the ID[NAME] pairs of the last column."""
    pair = r"(\d+)\[([^\]]+)\]"
    ids, names = (F.regexp_extract_all(F.coalesce(cell(7), F.lit("")), F.lit(pair), F.lit(k)) for k in (1, 2))
    diseases = F.transform(F.arrays_zip(ids.alias("i"), names.alias("n")), lambda d: F.struct(d["i"].alias("omim_id"), d["n"].alias("name")))
    return tsv_rows(spark, path, 6).select(cell(0).alias("fbgn"), cell(4).alias("symbol"), blank(cell(2)).alias("hgnc"), cell(5).try_cast("long").alias("diopt_score"), diseases.alias("diseases"))


def disease_models(spark: SparkSession, path: str) -> DataFrame:
    return tsv_rows(spark, path, 12).select(cell(0).alias("fbgn"), cell(1).alias("symbol"), cell(3).alias("qualifier"), cell(4).alias("do_id"), cell(5).alias("do_term"), blank(cell(7)).alias("allele"), blank(cell(9)).alias("evidence"), blank(cell(11)).alias("reference"))


def representative_publications(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, pos, fbrf, pmid: the curated list in order; the first PMID of an item counts."""
    each = tsv_rows(spark, path, 3).select(cell(0).alias("fbgn"), F.posexplode(F.split(cell(2), ",")).alias("pos", "item"))
    return each.select("fbgn", "pos", F.regexp_extract("item", r"(FBrf\d{7})", 1).alias("fbrf"), blank(F.regexp_extract("item", r"PMID:(\d+)", 1)).alias("pmid")).where("fbrf <> ''")


def entity_publications(spark: SparkSession, path: str) -> DataFrame:
    return tsv_rows(spark, path, 3).select(cell(0).alias("fbgn"), cell(2).alias("fbrf"), blank(cell(3)).alias("pmid"))


def publications(spark: SparkSession, path: str) -> DataFrame:
    """fbrf, pmid, doi, type, miniref and its first four-digit number as year."""
    year = F.nullif(F.regexp_extract(cell(5), r"(\d{4})", 1), F.lit("")).cast("int")
    return tsv_rows(spark, path, 6).select(cell(0).alias("fbrf"), blank(cell(1)).alias("pmid"), blank(cell(3)).alias("doi"), cell(4).alias("type"), cell(5).alias("miniref"), year.alias("year"))


def both_ways(edges: DataFrame, a: str, b: str, *pairs: tuple[str, str]) -> DataFrame:
    """Edges and their reverses, from one pass over the edges; ``pairs`` are further columns that swap."""
    swap = {a: b, b: a} | {x: y for x, y in pairs} | {y: x for x, y in pairs}
    turned = F.struct(*[F.col(swap.get(c, c)).alias(c) for c in edges.columns])
    return edges.select(F.inline(F.array(F.struct(*edges.columns), turned)))


def genetic_interactions(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, partner, symbol, partner_symbol, type, reference in both directions; lists of ids (a|b) are spread."""
    ids = lambda k: F.explode(F.filter(F.split(cell(k), r"\|"), lambda x: x != ""))
    rows = tsv_rows(spark, path, 6).withColumn("fbgn", ids(1)).withColumn("partner", ids(3))
    edges = rows.select("fbgn", "partner", cell(0).alias("symbol"), cell(2).alias("partner_symbol"), cell(4).alias("type"), cell(5).alias("reference"))
    return both_ways(edges, "fbgn", "partner", ("symbol", "partner_symbol"))


def physical_interactions(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, partner, method, reference from PSI-MITAB, both directions, no self-loops. The method is the text of its last parenthesis."""
    end = lambda k: F.regexp_extract(F.concat_ws("|", cell(k), cell(k + 2)), r"(FBgn\d{7})", 1)
    method = F.regexp_replace(F.element_at(F.split(cell(6), r"\("), -1), r"\)$", "")
    edges = tsv_rows(spark, path, 12).select(end(0).alias("fbgn"), end(1).alias("partner"), method.alias("method"), blank(cell(8)).alias("reference"))
    return both_ways(edges, "fbgn", "partner").where("fbgn <> '' and partner <> '' and fbgn <> partner")


def alliance_orthologs(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, species, id, symbol: rows with a fly gene on one side and a human or mouse gene on the other, turned so that the fly is first."""
    fly = lambda k: F.col("c")[k].startswith("FB:")
    other = lambda k: F.col("c")[k].rlike("^(HGNC|MGI):")
    rows = tsv_rows(spark, path, 10).where((fly(0) & other(4)) | (fly(4) & other(0)))
    pick = lambda a, b: F.when(fly(0), cell(a)).otherwise(cell(b))
    id_ = pick(4, 0)
    return rows.select(F.regexp_replace(pick(0, 4), "^FB:", "").alias("fbgn"), F.when(id_.startswith("HGNC:"), "human").otherwise("mouse").alias("species"), id_.alias("id"), pick(5, 1).alias("symbol"))


def coordinate_map(spark: SparkSession, path: str, organism: str | None = "Dmel") -> DataFrame:
    """fbgn, symbol, chr, start, end, strand. With an organism column (six columns) rows of others are left out."""
    if organism is None:
        rows, k = tsv_rows(spark, path, 5), 0
    else:
        rows, k = tsv_rows(spark, path, 6).where(cell(0) == organism), 1
    return rows.select(cell(k + 1).alias("fbgn"), cell(k).alias("symbol"), parse_location(cell(k + 4)).alias("l")).where("l is not null").select("fbgn", "symbol", "l.*")


def coordinates(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, chr, start, end, strand of a table with a header; rows with bad numbers are left out."""
    rows = spark.read.csv(path, sep="\t", header=True, schema="fbgn string, chr string, start string, end string, strand string")
    return rows.withColumn("start", F.col("start").try_cast("long")).withColumn("end", F.col("end").try_cast("long")).dropna(subset=["fbgn", "start", "end"])


def regions(spark: SparkSession, path: str) -> DataFrame:
    """chr, start, end, label of a BED-like file (tabs, or else white space); rows without numbers (headers) are left out."""
    lines = (path if isinstance(path, DataFrame) else spark.read.text(path)).where((F.trim("value") != "") & ~F.col("value").startswith("#"))
    cells = F.when(F.contains("value", F.lit("\t")), F.split("value", "\t")).otherwise(F.split(F.trim("value"), r"\s+"))
    rows = lines.select(cells.alias("c")).where(F.size("c") >= 3)
    rows = rows.select(cell(0).alias("chr"), cell(1).try_cast("long").alias("start"), cell(2).try_cast("long").alias("end"), blank(cell(3)).alias("label")).dropna(subset=["start", "end"])
    return rows.withColumn("label", F.coalesce("label", F.concat("chr", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))))


def id_list(spark: SparkSession, path: str, prefix: str = "FBgn") -> DataFrame:
    """fbgn: the ids of a list file, each once; comments behind an id are not kept."""
    first = F.get(F.split(F.trim("value"), r"\s+"), F.lit(0))
    lines = path if isinstance(path, DataFrame) else spark.read.text(path)
    return lines.select(first.alias("fbgn")).where(F.col("fbgn").startswith(prefix)).distinct()


def mammalian_phenotypes(spark: SparkSession, path: str) -> DataFrame:
    return tsv_rows(spark, path, 3).select(cell(0).alias("mp_id"), cell(1).alias("term"), cell(2).alias("definition")).where(F.col("mp_id").startswith("MP:"))


def mouse_phenotypes(spark: SparkSession, path: str) -> DataFrame:
    """symbol, mp_id, each pair once; a cell may list several alleles, of which the symbol before the bracket counts."""
    each = tsv_rows(spark, path, 4).select(F.explode(F.split(cell(0), r"[,/\s]+")).alias("a"), cell(3).alias("mp_id"))
    return each.select(F.regexp_extract("a", r"^([A-Za-z0-9-]+)", 1).alias("symbol"), "mp_id").where("symbol <> ''").distinct()


def human_phenotypes(spark: SparkSession, path: str) -> DataFrame:
    """symbol, hp_id, term of a table with a header line."""
    return tsv_rows(spark, path, 3).where(~F.lower(cell(0)).isin("ncbi_gene_id", "entrez-gene-id")).select(cell(1).alias("symbol"), cell(2).alias("hp_id"), cell(3).alias("term"))


def disease_phenotypes(spark: SparkSession, path: str) -> DataFrame:
    """omim_id (prefix stripped), hp_id."""
    return tsv_rows(spark, path, 4).where(cell(0).startswith("OMIM:")).select(F.substr(cell(0), F.lit(6)).alias("omim_id"), cell(3).alias("hp_id"))


def go_annotations(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, go_id, evidence, aspect of a GAF file; non-electronic evidence first is the caller's order."""
    return tsv_rows(spark, path, 9, ("!", "#")).select(cell(1).alias("fbgn"), cell(4).alias("go_id"), cell(6).alias("evidence"), cell(8).alias("aspect"))


def expression(spark: SparkSession, path: str) -> DataFrame:
    """fbgn, sample, rpkm."""
    return tsv_rows(spark, path, 8).select(cell(1).alias("fbgn"), cell(6).alias("sample"), cell(7).try_cast("double").alias("rpkm")).dropna(subset=["rpkm"])
