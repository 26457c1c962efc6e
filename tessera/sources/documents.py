"""Entity JSON, log lines, ontologies, Markdown tables, HTML pages and article XML."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.positions import parse_interval, parse_position
from tessera.schemas import ENTITY


def entities(spark: SparkSession, path: str) -> DataFrame:
    """Entity documents, one JSON object a file; files that do not parse are left out."""
    rows = spark.read.schema(f"{ENTITY}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return rows.where("fbgn is not null and _corrupt_record is null").drop("_corrupt_record")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def stanzas(spark: SparkSession, path: str) -> DataFrame:
    """kind and fields (tag -> its values in order) of the stanzas of an OBO file: the reader splits at stanza heads, so files of any length are dealt out.

    Values lack their comments (" ! ...") and trailing modifiers ("{...}") outside of quotes and lie as they are otherwise, escapes
    included (``unescaped``); an escaped line end continues a line; lines without a tag, and the header before the first stanza, are left out.
    """
    text = spark.read.option("lineSep", "\n[").text(path).withColumn("kind", F.regexp_extract("value", r"^\[?(\w+)\]", 1)).where("kind <> ''")
    lines = F.filter(F.split(F.regexp_replace("value", r"\\\r?\n", ""), r"\r?\n"), lambda x: x.rlike(r"^[\w-]+:"))
    plain = lambda x: F.regexp_extract(x, r'^[\w-]+:\s*((?:"(?:[^"\\]++|\\.)*+"|\\.|(?!\s+!|\s*\{)[^"\\])*+)', 1)
    tagged = F.transform(lines, lambda x: F.struct(F.substring_index(x, ":", 1).alias("tag"), F.trim(plain(x)).alias("value")))
    rows = text.select("kind", tagged.alias("l"))
    tags = F.array_distinct(F.col("l.tag"))
    values = F.transform(tags, lambda t: F.transform(F.filter("l", lambda x: x["tag"] == t), lambda x: x["value"]))
    return rows.select("kind", F.map_from_arrays(tags, values).alias("fields"))


def unescaped(value: Column) -> Column:
    """A value or quoted text of a stanza with its escapes resolved: line end, blank, tab, and any other character as it is."""
    special = F.replace(F.replace(F.replace(value, F.lit("\\W"), F.lit(" ")), F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n"))
    return F.regexp_replace(special, r"\\(.)", "$1")


def quoted(value: Column) -> Column:
    """The text in quotes at the start of a value, escapes as they are; null if there is none."""
    return F.nullif(F.regexp_extract(value, r'^"((?:[^"\\]++|\\.)*+)"', 1), F.lit(""))


def _first(tag: str) -> Column:
    return F.get(F.col("fields")[tag], F.lit(0))


def _terms(spark: SparkSession, path: str) -> DataFrame:
    rows = stanzas(spark, path).where("kind = 'Term'").withColumn("id", F.nullif(_first("id"), F.lit("")))
    return rows.where(F.col("id").isNotNull() & ~F.coalesce(_first("is_obsolete") == "true", F.lit(False)))


def ontology(spark: SparkSession, path: str) -> DataFrame:
    """id, term, definition of the [Term] stanzas of an OBO file that are not obsolete."""
    return _terms(spark, path).select("id", F.nullif(_first("name"), F.lit("")).alias("term"), quoted(_first("def")).alias("definition"))


def ontology_links(spark: SparkSession, path: str) -> DataFrame:
    """id, relation, target of the terms that are not obsolete: is_a, and the relationships by their own names."""
    up = F.transform(F.coalesce(F.col("fields")["is_a"], F.array()), lambda x: F.struct(F.lit("is_a").alias("relation"), F.substring_index(x, " ", 1).alias("target")))
    other = F.transform(F.coalesce(F.col("fields")["relationship"], F.array()), lambda x: F.struct(F.substring_index(x, " ", 1).alias("relation"), F.get(F.split(x, r"\s+"), F.lit(1)).alias("target")))
    return _terms(spark, path).select("id", F.explode(F.concat(up, other)).alias("l")).select("id", "l.relation", "l.target")


def ontology_synonyms(spark: SparkSession, path: str) -> DataFrame:
    """id, pos, synonym (escapes resolved), scope of the terms that are not obsolete; without a scope, it is RELATED."""
    each = _terms(spark, path).select("id", F.posexplode(F.coalesce(F.col("fields")["synonym"], F.array())).alias("pos", "v"))
    scope = F.regexp_extract("v", r'^"(?:[^"\\]++|\\.)*+"\s+(EXACT|BROAD|NARROW|RELATED)\b', 1)
    return each.select("id", "pos", unescaped(quoted(F.col("v"))).alias("synonym"), F.when(scope == "", "RELATED").otherwise(scope).alias("scope"))


# Study drugs, their families and links.
DRUG_FAMILIES = {
    "Carboplatin": "chemo", "Gemcitabine": "chemo", "Methotrexate": "chemo", "Malathion": "pesticide", "Zinc oxide": "heavy_metal", "Caffeine": "xenobiotic",
}
DRUG_LINKS = {
    "Carboplatin": "https://pmc.ncbi.nlm.nih.gov/articles/PMC4174942/", "Gemcitabine": "https://pmc.ncbi.nlm.nih.gov/articles/PMC4174942/",
    "Methotrexate": "https://pmc.ncbi.nlm.nih.gov/articles/PMC3737169/", "Malathion": "https://pmc.ncbi.nlm.nih.gov/articles/PMC9713458/",
    "Zinc oxide": "https://pmc.ncbi.nlm.nih.gov/articles/PMC12606420/", "Caffeine": "https://pmc.ncbi.nlm.nih.gov/articles/PMC8893256/",
}


def region_table(spark: SparkSession, path: str | DataFrame, families: dict[str, str] | None = None, links: dict[str, str] | None = None) -> DataFrame:
    """Labelled regions of a Markdown table of nine cells: label, drug, chr, peak, interval, -log10 P, h2 or gene count, release, phenotype.

    The coordinates of a row fill the columns of its own release; ids are drug_label (without the word
    oxide), unlabelled rows get letters in the order of the file. ``path`` may be a DataFrame of lines (line, value).
    """
    from tessera.operators.lookup import letters

    lines = path if isinstance(path, DataFrame) else spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line"))
    lines = lines.where(F.trim("value").startswith("|"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("value"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = lines.select("line", cells.alias("c")).where((F.size("c") == 9) & ~F.col("c")[0].rlike(r"^:?-+:?$") & (F.lower(F.col("c")[0]) != "qtl"))
    c = lambda k: F.col("c")[k]
    value = lambda k: F.when(~c(k).isin("—", "-", ""), c(k))
    family, url = (F.element_at(F.create_map(*[F.lit(x) for kv in of.items() for x in kv]), c(1)) for of in (families or DRUG_FAMILIES, links or DRUG_LINKS))
    span, r6 = parse_interval(c(4)), F.lower(c(7)) != "r5"
    peak = parse_position(F.regexp_replace(c(3), r"\s*\([^)]*\)$", ""))
    genes = F.regexp_extract(c(6), r"^([\d,]+)(?:\s*genes?)?$", 1)
    out = rows.select(
        "line", c(0).alias("qtl_label"), c(1).alias("study_drug"), F.coalesce(family, F.lit("other")).alias("drug_family"), c(2).alias("chr"),
        *[F.when(r6 if rel == "r6" else ~r6, v).alias(f"{name}_{rel}") for rel in ("r6", "r5") for name, v in (("peak", peak), ("start", span["start"]), ("end", span["end"]))],
        value(5).try_cast("double").alias("neg_log_p"), F.when(c(6).rlike("%$"), c(6)).alias("h2"), F.replace(genes, F.lit(","), F.lit("")).try_cast("long").alias("gene_count"),
        F.when(r6, "r6").otherwise("r5").alias("release_orig"), c(8).alias("phenotype"), url.alias("pmc_url"), F.replace(F.lower(c(1)), F.lit(" oxide"), F.lit("")).alias("slug"),
    )
    return letters(out, "slug", "qtl_label", ["line"]).drop("slug")


class _Sections(HTMLParser):
    """Texts of the elements with given ids (or tag names), nested elements included."""

    VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))

    def __init__(self, ids: set[str], tags: set[str]) -> None:
        super().__init__(convert_charrefs=True)
        self.ids, self.tags, self.open, self.found, self.hidden = ids, tags, [], {}, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.VOID:
            return
        name = dict(attrs).get("id")
        name = name if name in self.ids else tag if tag in self.tags else None
        self.open.append((tag, name))
        self.hidden += tag in ("script", "style")
        if name:
            self.found.setdefault(name, [])

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.hidden -= sum(t in ("script", "style") for t, _ in self.open[k:])
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        if not self.hidden and data.strip():
            for name in {n for _, n in self.open if n}:
                self.found[name].append(data.strip())


def section_texts(pages: DataFrame, page_id: str, html_column: str, ids: tuple[str, ...] = (), tags: tuple[str, ...] = ()) -> DataFrame:
    """page_id, section, text: the text of elements by id or tag name. HTML needs a parser: Arrow batches, one pass a page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page, source in zip(b[page_id], b[html_column], strict=True):
                parser = _Sections(set(ids), set(tags))
                parser.feed(source or "")
                rows += [(page, name, " ".join(parts)) for name, parts in parser.found.items()]
            yield pd.DataFrame(rows, columns=["page_id", "section", "text"])

    kind = pages.schema[page_id].dataType.simpleString()
    return pages.select(page_id, html_column).mapInPandas(run, f"page_id {kind}, section string, text string")


def embedded_json(text: str, marker: str) -> str | None:
    """The bracketed JSON value behind ``marker``, HTML entities resolved, or None."""
    plain = html.unescape(text)
    at = plain.find(marker)
    if at < 0:
        return None
    starts = [k for k in (plain.find("[", at + len(marker)), plain.find("{", at + len(marker))) if k >= 0]
    if not starts:
        return None
    try:
        value, _ = json.JSONDecoder().raw_decode(plain, min(starts))
    except ValueError:
        return None
    return json.dumps(value)


def embedded_values(pages: DataFrame, page_id: str, html_column: str, marker: str, schema: str) -> DataFrame:
    """page_id and value: the embedded JSON of each page, parsed with ``schema``."""

    @F.pandas_udf("string")
    def extract(column: pd.Series) -> pd.Series:
        return column.map(lambda t: embedded_json(t or "", marker))

    return pages.select(page_id, F.from_json(extract(html_column), schema).alias("value"))


def links(pages: DataFrame, page_id: str, html_column: str) -> DataFrame:
    """page_id, pos, href of the anchors, by pattern: inside whole-stage code."""
    found = F.regexp_extract_all(html_column, F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))
    return pages.select(page_id, F.posexplode(found).alias("pos", "href"))


def best_orthologs(pages: DataFrame, page_id: str, html_column: str, pattern: str, n: int) -> DataFrame:
    """page_id, symbol, score: pairs (symbol, score) by a pattern with two groups, the best of each symbol, the ``n`` best a page."""
    from tessera.operators.lookup import top_per_group

    pairs = F.arrays_zip(*[F.regexp_extract_all(html_column, F.lit(pattern), F.lit(k)).alias(name) for k, name in ((1, "symbol"), (2, "score"))])
    each = pages.select(page_id, F.explode(pairs).alias("p")).select(page_id, "p.symbol", F.col("p.score").try_cast("long").alias("score"))
    best = each.groupBy(page_id, "symbol").agg(F.max("score").alias("score"))
    return top_per_group(best, [page_id], [F.desc("score"), F.col("symbol")], n)


#: An article as far as it is read; its parts stand in the record itself or in its citation.
_PARTS = "Journal struct<Title: string, JournalIssue: struct<PubDate: struct<Year: string, MedlineDate: string>>, PubDate: struct<Year: string, MedlineDate: string>>, ArticleTitle string, Abstract struct<AbstractText: array<string>>, AbstractText array<string>"
ARTICLE = f"PMID string, {_PARTS}, MedlineCitation struct<PMID: string, Article: struct<{re.sub(r'(^|, )(Journal|ArticleTitle|Abstract|AbstractText) ', r'\1\2: ', _PARTS)}>>, _corrupt_record string"
#: Mark-up inside of texts, which stays as text where a string is read.
INLINE_TAGS = r"</?(?:b|i|u|sub|sup|sc|DispFormula|mml:\w+)(?:\s[^<>]*)?/?>"


def articles(spark: SparkSession, path: str) -> DataFrame:
    """pmid, title, year, journal, abstract (its parts joined, mark-up stripped) of article XML, by Spark's XML source with a nested schema.

    Only the fields read are made; entities are resolved by the parser. What is not well-formed ends its file: the articles before it stay.
    """
    rows = spark.read.schema(ARTICLE).format("xml").option("rowTag", "PubmedArticle").option("mode", "PERMISSIVE").load(path).where("_corrupt_record is null")
    plain = lambda c: F.trim(F.regexp_replace(c, INLINE_TAGS, ""))
    own = lambda p: F.coalesce(F.col(f"MedlineCitation.Article.{p}"), F.col(p))
    date = lambda c: F.coalesce(*[F.col(f"{x}Journal.{y}PubDate.{c}") for x in ("MedlineCitation.Article.", "") for y in ("JournalIssue.", "")])
    year = F.regexp_extract(F.concat_ws(" ", date("Year"), date("MedlineDate")), r"(\d{4})", 1).try_cast("int")
    parts = F.transform(F.coalesce(own("Abstract.AbstractText"), own("AbstractText")), plain)
    text = lambda c: F.nullif(plain(c), F.lit(""))
    return rows.select(F.coalesce("MedlineCitation.PMID", "PMID").alias("pmid"), text(own("ArticleTitle")).alias("title"), year.alias("year"), text(own("Journal.Title")).alias("journal"),
                       F.nullif(F.array_join(F.filter(parts, lambda x: x != ""), " "), F.lit("")).alias("abstract"))


def fetch_missing(wanted: DataFrame, cache: DataFrame, key: str, fetch: Callable[[list[str]], dict[str, str | None]], batch: int = 100) -> DataFrame:
    """key, payload of the wanted keys that the cache lacks, fetched in batches; a key without an answer is kept with null, so it is not asked again.

    ``fetch`` runs in tasks, so the number of partitions bounds the calls at a time. Append the result to the cache table.
    """
    todo = wanted.select(F.col(key).cast("string").alias("key")).distinct().join(cache.select(F.col("key")), "key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = b["key"].tolist()
            for at in range(0, len(keys), batch):
                some = keys[at : at + batch]
                got = fetch(some)
                yield pd.DataFrame({"key": some, "payload": [got.get(k) for k in some]})

    return todo.mapInPandas(run, "key string, payload string")


def retrying(get: Callable[[str], bytes], attempts: int = 4, least_bytes: int = 1, pause: Callable[[int], None] = lambda n: None) -> Callable[[list[str]], dict[str, str | None]]:
    """A ``fetch`` for ``fetch_missing`` from a getter of one key: failed or too short answers are asked for again, ``pause`` is called before each
    further attempt, and a key without a good answer gets null."""

    def fetch(keys: list[str]) -> dict[str, str | None]:
        out: dict[str, str | None] = {}
        for key in keys:
            out[key] = None
            for n in range(attempts):
                if n:
                    pause(n)
                try:
                    body = get(key)
                except Exception:  # any failure of a remote is a reason to ask again
                    continue
                if len(body) >= least_bytes:
                    out[key] = body.decode("utf-8", "replace")
                    break
        return out

    return fetch


def location_from_summary(summary: Column) -> Column:
    """struct<chr, start, end> of "Gene sequence location is X:a..b", else null: a fallback where the coordinate map has no row."""
    p = r"[Ss]equence location is (\w+):(\d+)\.\.(\d+)"
    return F.when(summary.rlike(p), F.struct(F.regexp_extract(summary, p, 1).alias("chr"), F.regexp_extract(summary, p, 2).cast("long").alias("start"), F.regexp_extract(summary, p, 3).cast("long").alias("end")))
