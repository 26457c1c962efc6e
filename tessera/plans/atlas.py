"""Building, storing and exporting the relational atlas of a corpus of entity documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import flatten, ranked
from tessera.operators.search import by_term, postings


#: The fields of the keyword search.
SEARCHED = ["symbol", "summary", "bullets_text", "notes"]


def build(docs: DataFrame, path: str, r6: DataFrame | None = None, r5: DataFrame | None = None, shards: int | None = None) -> None:
    """Write every relation below ``path``. Interval data is clustered by (chr, start) and the text index by term, so Parquet statistics skip row groups."""
    for name, make in flatten.RELATIONS.items():
        rows = make(docs, r6, r5) if name == "genes" else make(docs)
        if name == "genes" and "chr" in rows.columns:
            rows = rows.repartitionByRange("chr", "start").sortWithinPartitions("chr", "start")
        rows.write.mode("overwrite").parquet(f"{path}/{name}")
    search = docs.sparkSession.read.parquet(f"{path}/search")
    ranked.build(search, "fbgn", SEARCHED, path, stemmed=True, parts=shards)


def load(spark: SparkSession, path: str, views: bool = False) -> dict[str, DataFrame]:
    """The relations by name; as temporary views too if asked."""
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in [*flatten.RELATIONS, *ranked.TABLES]}
    if views:
        for n, df in tables.items():
            df.createOrReplaceTempView(n)
    return tables


def build_index(docs: DataFrame, path: str) -> None:
    """The older index below ``path``: entities with lint counts, bullet-level tags, and postings of bullets (phenotype, evidence)."""
    tables = {name: flatten.RELATIONS[name](docs) for name in ("synonyms", "bullets", "citations", "orthologs", "diseases", "mouse_phenotypes", "go_slim")}
    tables |= {"genes": flatten.index_genes(docs), "tissues": flatten.tissues(docs, True), "life_stages": flatten.life_stages(docs, True), "alleles": flatten.alleles(docs)}
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")
    by_term(postings(docs.sparkSession.read.parquet(f"{path}/bullets"), "bullet_id", ["phenotype", "evidence_text"])).write.mode("overwrite").parquet(f"{path}/postings")


def write_regions(rows: DataFrame, path: str, form: str = "tsv") -> None:
    """The entities of many regions as tab-separated text with a header, or as JSON lines, in order of label and start."""
    ordered = rows.orderBy("label", "start", "fbgn")
    (ordered.write.mode("overwrite").json(path) if form == "json" else ordered.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path))


def shard_of(key: Column) -> Column:
    """The shard of a key: the first two digits of its MD5."""
    return F.substring(F.md5(key), 1, 2)


def sharded(df: DataFrame, key: str, path: str) -> None:
    """Point-readable storage: a folder for each of 256 two-digit MD5 prefixes of the key."""
    df.withColumn("shard", shard_of(F.col(key))).repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def read_one(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """The rows of one key; only its folder is read."""
    import hashlib

    return spark.read.parquet(path).where((F.col("shard") == hashlib.md5(value.encode()).hexdigest()[:2]) & (F.col(key) == value)).drop("shard")


def bed_lines(rows: DataFrame, group: str, start: str, end: str, name: list[str], score: str) -> DataFrame:
    """value: BED6 lines of the rows with a group; the strand is always "+"."""
    line = F.concat_ws("\t", group, F.col(start).cast("string"), F.col(end).cast("string"), F.concat_ws("|", *name), F.col(score).cast("string"), F.lit("+"))
    return rows.where(F.col(group).isNotNull()).select(group, start, line.alias("value"))


def export_bed(rows: DataFrame, path: str, group: str = "chr", start: str = "start", end: str = "end", name: tuple[str, ...] = ("fbgn", "symbol"), score: str = "n_bullets") -> None:
    """BED6 files in global order of (group, start): a range sort, no single task."""
    bed_lines(rows, group, start, end, list(name), score).orderBy(group, start, "value").select("value").write.mode("overwrite").text(path)


#: Entities that one row of an inverted index holds at most, about.
PAGE = 10_000


def _pages(rows: DataFrame, keys: list[str], entity: str = "fbgn") -> DataFrame:
    """The keys, page and entities (sorted): a value that very many entities share has several pages, so no row grows with the corpus."""
    rows = rows.select(*keys, entity).distinct()
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / PAGE).cast("int").alias("__of"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    paged = rows.alias("a").join(sizes.alias("b"), same).select(*[F.col(f"a.{k}") for k in keys], F.pmod(F.xxhash64(F.col(f"a.{entity}")), F.col("b.__of")).cast("int").alias("page"), F.col(f"a.{entity}"))
    return paged.groupBy(*keys, "page").agg(F.array_sort(F.collect_list(entity)).alias("entities"))


def inverted(tables: dict[str, DataFrame], path: str) -> None:
    """JSON indices: catalog, flat bullets, and entities by category, disease and ortholog (in pages of about ``PAGE``)."""
    genes, bullets = tables["genes"], tables["bullets"]
    cats = bullets.groupBy("fbgn").agg(F.array_sort(F.collect_set("category")).alias("categories"))
    out = {
        "catalog": genes.select("fbgn", "symbol", "n_bullets", "n_refs").join(cats, "fbgn", "left"), "bullets_flat": bullets,
        "by_category": _pages(bullets, ["category"]), "by_disease": _pages(tables["diseases"], ["omim_id", "name"]), "by_ortholog": _pages(tables["orthologs"], ["species", "symbol"]),
    }
    for name, df in out.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
