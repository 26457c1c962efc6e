"""Named query verbs over a loaded atlas; each returns a DataFrame. ``python -m tessera.plans.facade ATLAS VERB ARGS`` prints JSON lines."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.positions import parse_region
from tessera.operators import flatten, intervals, lookup, rank, ranked, vectors
from tessera.operators import search as text_search
from tessera.operators.vector_store import VectorStore
from tessera.plans import atlas


class Atlas:
    """The relations of ``plans.atlas.load``; optionally embeddings (fbgn, embedding), regions (qtls), an embedder of query texts, and a store
    of the embeddings (ids in fbgn), which then answers semantic searches."""

    def __init__(self, tables: dict[str, DataFrame], embeddings: DataFrame | None = None, qtls: DataFrame | None = None, embed: Callable[[str], list[float]] | None = None, store: VectorStore | None = None) -> None:
        self.t, self.embeddings, self.qtls, self.embed, self.store = tables, embeddings, qtls, embed, store
        self.spark: SparkSession = tables["genes"].sparkSession

    def stats(self) -> DataFrame:
        n = F.count("*")
        t = self.t
        return lookup.statistics({
            "genes": (t["genes"], {"n": n, "with_location": F.count("chr") if "chr" in t["genes"].columns else F.lit(0)}),
            "bullets": (t["bullets"], {"n": n}), "citations": (t["citations"], {"n": n}), "refs": (t["refs"], {"n": n, "distinct": F.countDistinct("fbrf")}),
            "orthologs": (t["orthologs"], {"n": n}), "diseases": (t["diseases"], {"n": n, "distinct": F.countDistinct("omim_id")}),
        })

    def resolve(self, names: list[str], orthologs: bool = False) -> DataFrame:
        """query, id, tier: by exact id, symbol, synonym (current ones first), and then, if asked, ortholog symbol (best score first)."""
        asked = self.spark.createDataFrame([(n,) for n in names], "query string")
        g, s = self.t["genes"], self.t["synonyms"]
        tiers = [(g, "fbgn", "fbgn", []), (g, "symbol", "fbgn", []), (s, "synonym", "fbgn", [~F.col("is_current")])]
        if orthologs:
            tiers.append((self.t["orthologs"], "symbol", "fbgn", [-F.coalesce("diopt_score", F.lit(-1))]))
        return lookup.resolve(asked, tiers)

    def index_stats(self) -> DataFrame:
        """Counts of the whole index, and groups of bullets by category and confidence and of orthologs by species, as metric and value."""
        n, t = F.count("*"), self.t
        whole = lookup.statistics({
            "genes": (t["genes"], {"n": n}), "bullets": (t["bullets"], {"n": n}), "citations": (t["citations"], {"n": n, "references": F.countDistinct(F.when(F.col("type") == "fbrf", F.col("value")))}),
            "tissues": (t["tissues"], {"n": n, "distinct": F.countDistinct("tissue")}), "orthologs": (t["orthologs"], {"n": n}), "diseases": (t["diseases"], {"n": n, "with_omim": F.count("omim_id")}), "go_slim": (t["go_slim"], {"n": n}),
        })
        group = lambda table, c: t[table].groupBy(F.concat(F.lit(f"{table}.{c}="), F.coalesce(c, F.lit(""))).alias("metric")).agg(n.alias("value"))
        return whole.unionByName(group("bullets", "category")).unionByName(group("bullets", "confidence")).unionByName(group("orthologs", "species"))

    def gene(self, name: str) -> DataFrame:
        """One entity with its child relations nested: synonyms current first, references latest first, distinct tags."""
        ids = [r["id"] for r in self.resolve([name]).collect()]  # one at most: as a literal it reaches the scans, their buckets and statistics
        own = {k: v.where(F.col("fbgn").isin(ids)) for k, v in self.t.items() if "fbgn" in v.columns}
        year = -F.coalesce("year", F.lit(-9999))
        children = {
            "synonyms": (own["synonyms"].withColumn("o", (~F.col("is_current")).cast("int")), ["o", "synonym"], ["synonym", "type", "is_current"]),
            "bullets": (own["bullets"], ["bullet_id"], ["bullet_id", "category", "phenotype", "direction", "evidence_text", "confidence"]),
            "citations": (own["citations"], ["bullet_id", "value"], ["bullet_id", "type", "value", "pmid", "doi"]),
            "refs": (own["refs"].withColumn("o", year), ["o", "fbrf"], ["fbrf", "title", "miniref", "year", "pmid", "doi"]),
            "orthologs": (own["orthologs"].withColumn("o", -F.coalesce("diopt_score", F.lit(-1))), ["species", "o", "symbol"], ["species", "symbol", "diopt_score"]),
            "diseases": (own["diseases"], ["name"], ["name", "omim_id", "via_symbol"]),
            "tissues": (own["tissues"].distinct(), ["tissue"], ["tissue"]), "life_stages": (own["life_stages"].distinct(), ["stage"], ["stage"]),
        }
        return flatten.nested(own["genes"], "fbgn", children)

    def search(self, query: str, category: str | None = None, direction: str | None = None, confidence: str | None = None, tissue: str | None = None, limit: int = 20) -> DataFrame:
        """Keyword search; facets are independent: different bullets may satisfy each."""
        b = self.t["bullets"].withColumnRenamed("fbgn", "doc")
        facets = [b.where(F.col(c) == v) for c, v in (("category", category), ("direction", direction), ("confidence", confidence)) if v]
        if tissue:
            facets.append(self.t["tissues"].where(lookup.same(F.col("tissue"), tissue)).withColumnRenamed("fbgn", "doc"))
        if "impacts" in self.t:
            hits = ranked.StoredIndex(self.t, stemmed=True).search(query, limit, facets)
        else:
            hits = text_search.search(self.t["search"], "fbgn", atlas.SEARCHED, query, limit, None, facets, stemmed=True)
        body = self.t["search"].select(F.col("fbgn").alias("doc"), "symbol", "bullets_text")
        words = [w.lower() for w in query.replace('"', " ").split()]
        return hits.join(body, "doc", "left").withColumn("snippet", text_search.snippet(F.col("bullets_text"), words)).drop("bullets_text").orderBy(F.desc("score"), "doc")

    def _by(self, table: str, predicate: Column, order: list[Column], limit: int | None, columns: list[str] | None = None) -> DataFrame:
        g = self.t["genes"].select("fbgn", F.col("symbol").alias("gene"), "n_bullets")
        return lookup.reverse(self.t[table], predicate, g, "fbgn", ["fbgn", "gene", "n_bullets", *(columns or [])], order, limit)

    def phenotype(self, query: str, confidence: str | None = None, category: str | None = None, limit: int = 20) -> DataFrame:
        """Keyword search over bullets (phenotype and evidence), best first, with a snippet of the phenotype."""
        facets = [F.col(c) == v for c, v in (("confidence", confidence), ("category", category)) if v]
        b = self.t["bullets"]
        only = [b.where(lookup.facet(facets)).select(F.col("bullet_id").alias("doc"))] if facets else []
        hits = text_search.search(b, "bullet_id", ["phenotype", "evidence_text"], query, limit, None, only)
        words = [w.lower() for w in query.replace('"', " ").split()]
        rows = hits.join(b.select(F.col("bullet_id").alias("doc"), "fbgn", "category", "confidence", "text_specificity", "phenotype"), "doc", "left")
        rows = rows.join(self.t["genes"].select("fbgn", F.col("symbol").alias("gene")), "fbgn", "left")
        return rows.withColumn("hit", text_search.snippet(F.col("phenotype"), words, 16, ("\u00ab", "\u00bb"))).drop("phenotype").orderBy(F.desc("score"), "doc")

    def keyword(self, text: str, limit: int = 20) -> DataFrame:
        """Bullets whose phenotype and evidence hold the text, in order of their ids."""
        held = F.contains(F.lower(F.concat_ws(" ", "phenotype", "evidence_text")), F.lit(text.lower()))
        return self.t["bullets"].where(held).orderBy("bullet_id").limit(limit)

    def omim(self, number: str, limit: int | None = None) -> DataFrame:
        return self._by("diseases", F.col("omim_id") == number, [F.col("gene"), F.col("fbgn")], limit, ["name"])

    def ortholog_of(self, species: str, symbol: str, limit: int | None = 200) -> DataFrame:
        """Entities with an ortholog of the species, by its symbol or its gene id."""
        named = lookup.same(F.col("symbol"), symbol) | (F.col("entrez_id") == symbol)
        return self._by("orthologs", (F.col("species") == species) & named, [F.col("diopt_score").desc_nulls_last(), F.col("fbgn")], limit, ["symbol", "diopt_score"])

    def citing(self, ref: str, limit: int | None = 500) -> DataFrame:
        """Bullets that cite a reference."""
        return self.bullets_by("citations", (F.col("type") == "fbrf") & (F.col("value") == ref), None, limit)

    def bullets_in(self, category: str, confidence: str | None = None, limit: int = 50) -> DataFrame:
        """Bullets of a category (and confidence)."""
        own = (F.col("category") == category) if confidence is None else (F.col("category") == category) & (F.col("confidence") == confidence)
        return self.t["bullets"].where(own).orderBy("bullet_id").limit(limit)

    def disease(self, text: str, limit: int | None = 200) -> DataFrame:
        return self._by("diseases", (F.col("omim_id") == text) | lookup.containing(F.col("name"), text), [F.col("gene"), F.col("fbgn")], limit, ["name", "omim_id"])

    def ortholog(self, symbol: str, limit: int | None = 200) -> DataFrame:
        return self._by("orthologs", lookup.same(F.col("symbol"), symbol), [F.col("diopt_score").desc_nulls_last(), F.col("fbgn")], limit, ["species", "symbol", "diopt_score"])

    def paper(self, ref: str, limit: int | None = 500) -> DataFrame:
        return self._by("refs", (F.col("fbrf") == ref) | (F.col("pmid") == ref), [F.col("gene"), F.col("fbgn")], limit, ["fbrf", "title"])

    def tissue(self, name: str, limit: int = 500) -> DataFrame:
        return self._by("tissues", lookup.same(F.col("tissue"), name), [F.desc("n_bullets"), F.col("fbgn")], limit)

    def category(self, name: str, confidence: str | None = None, limit: int = 500) -> DataFrame:
        g = self.t["genes"].select("fbgn", "symbol", "n_bullets")
        return lookup.in_category(self.t["bullets"], g, name, "fbgn", confidence).orderBy(F.desc("n_in_cat"), "fbgn").limit(limit)

    def go(self, text: str, limit: int | None = 200) -> DataFrame:
        return self._by("go_slim", lookup.containing(F.col("term"), text), [F.col("gene"), F.col("fbgn")], limit, ["domain", "term"])

    def bullets_by(self, table: str, predicate: Column, facets: list[Column] | None = None, limit: int | None = 50) -> DataFrame:
        """Bullets by a bullet-level tag relation (tissues, life stages, alleles, citations with bullet_id), the first by id; with no limit all, in no order."""
        keys = self.t[table].where(predicate).select("fbgn", "bullet_id").distinct()
        found = self.t["bullets"].where(lookup.facet(facets or [])).join(keys, ["fbgn", "bullet_id"], "left_semi")
        return found if limit is None else found.orderBy("bullet_id").limit(limit)

    def region(self, region: str, release: str = "r6") -> DataFrame:
        found = parse_region(region)
        if not found:
            return self.spark.createDataFrame([(f"bad region: {region}",)], "error string")
        on = ("chr", "start", "end") if release == "r6" else ("chr_r5", "start_r5", "end_r5")
        return intervals.overlaps(self.t["genes"], *found, on).orderBy(on[1], "fbgn")

    def regions(self, asked: DataFrame) -> DataFrame:
        """Entities for each of many regions (chr, start, end, label) in one join."""
        r = asked.select("label", F.col("chr").alias("__c"), F.col("start").alias("__s"), F.col("end").alias("__e"))
        return intervals.overlap_join(r, self.t["genes"], ("__c", "__s", "__e")).drop("__c", "__s", "__e").orderBy("label", "start", "fbgn")

    def lift(self, region: str, source: str = "r5") -> DataFrame:
        target = ("chr", "start", "end") if source == "r5" else ("chr_r5", "start_r5", "end_r5")
        inside = self.region(region, source)
        if "error" in inside.columns:
            return inside
        start = "start_r5" if source == "r5" else "start"
        return intervals.lift(inside.withColumn("region", F.lit(region)), ["region"], target, [start, "fbgn"])

    def _query(self, text: str) -> Column:
        if self.embeddings is None:
            raise ValueError("this atlas has no embeddings")
        if self.embed is not None:
            return vectors.literal(self.embed(text))
        dims = len(self.embeddings.select("embedding").first()[0])
        return vectors.hashed_embedding(F.lit(text), dims)

    def _nearest(self, text: str, limit: int, ids: DataFrame | None = None) -> DataFrame:
        """fbgn, score of the most similar entities, among ``ids`` if given."""
        query = self._query(text)
        if self.store is None:
            return vectors.semantic_topk(self.embeddings, query, limit, "fbgn", ids=ids)
        return self.store.topk(self.spark.range(1).select(query.alias("q")).first()["q"], limit, ids, "fbgn")

    def semantic(self, text: str, limit: int = 20) -> DataFrame:
        hits = self._nearest(text, limit)
        return vectors.with_metadata(hits, self.t["genes"].select("fbgn", "symbol", "n_bullets"), "fbgn", "left").orderBy(F.desc("score"), "fbgn")

    def semantic_filtered(self, text: str, predicates: list[Column], limit: int = 20, mode: str = "post") -> DataFrame:
        """Facets that one bullet must satisfy together. ``post``: after the limit, so fewer rows may come back; ``pre``: before."""
        own = self.t["bullets"].where(lookup.facet(predicates))
        if mode == "pre":
            return self._nearest(text, limit, own)
        return vectors.post_filtered(self._nearest(text, limit), own, "fbgn")

    def ask(self, text: str, region: str | None = None, release: str = "r6", limit: int = 10) -> DataFrame:
        members = self.region(region, release) if region else self.t["genes"]
        if "error" in members.columns or not text:
            return members
        return vectors.with_metadata(self._nearest(text, limit, members), members, "fbgn").orderBy(F.desc("score"), "fbgn")

    def qtl_list(self, by: str = "significance") -> DataFrame:
        """Regions: those of the newer release first and the most significant first, ties by id; or ``by`` id."""
        strength = F.coalesce("neg_log_p", F.lit(0.0))
        return self.qtls.orderBy("id") if by == "id" else self.qtls.orderBy(F.col("release_orig") == "r5", F.desc(strength), "id")

    def qtl_overlaps(self, only: str | None = None) -> DataFrame:
        """Overlapping pairs with the number of entities in the common part, longest overlap first."""
        pairs = intervals.pair_overlaps(self.qtls, "id", "id", ("chr", "start_r6", "end_r6"), "drug_family")
        if only:
            pairs = pairs.where((F.col("id_a") == only) | (F.col("id_b") == only))
        return intervals.count_inside(pairs, self.t["genes"], "chr", ("chr", "start", "end"), "fbgn").orderBy(F.desc("overlap_bp"), "o_a", "o_b").drop("o_a", "o_b")

    def qtl_rank(self, ids: list[str] | None = None, phenotype: str | None = None, top: int | None = 20) -> DataFrame:
        """Two-dimensional ranking of the entities in each region; all regions in one plan. ``phenotype`` replaces the regions' own."""
        asked = self.qtls.where(F.col("id").isin(ids)) if ids else self.qtls
        dims = len(self.embeddings.select("embedding").first()[0])
        text = F.lit(phenotype) if phenotype else F.col("phenotype")
        query = asked.select("id", vectors.hashed_embedding(text, dims).alias("query")) if self.embed is None or not phenotype else asked.select("id", vectors.literal(self.embed(phenotype)).alias("query"))
        members = rank.region_members(asked, self.t["genes"], "id")
        human = self.t["orthologs"].where("species = 'human'")
        members = rank.with_flags(members, "fbgn", {"has_human": human, "has_mouse": self.t["mouse_phenotypes"], "has_disease": self.t["diseases"]})
        rows = members.join(self.embeddings.select("fbgn", "embedding"), "fbgn", "left").join(query, "id")
        ev = F.coalesce(vectors.cosine(F.col("embedding"), F.col("query")), F.lit(0.0))
        return rank.rank_two_ways(rows, ev, ["id"], "fbgn", "start", ("n_bullets", "n_refs", "n_pubs_total"), ("has_human", "has_mouse", "has_disease"), top).drop("embedding", "query")

    def qtl_shared(self, a: str, b: str, top: int | None = 20) -> DataFrame:
        """Entities in the common part of two regions, scored against both phenotypes; an error row if there is none."""
        rows = {r["id"]: r for r in self.qtls.where(F.col("id").isin(a, b)).collect()}  # two rows at most
        for name in (a, b):
            if name not in rows:
                return self.spark.createDataFrame([(f"not found: {name}",)], "error string")
        x, y = rows[a], rows[b]
        message = "different chr" if x["chr"] != y["chr"] else "missing coordinates" if not all((x["start_r6"], x["end_r6"], y["start_r6"], y["end_r6"])) else None
        start, end = (max(x["start_r6"], y["start_r6"]), min(x["end_r6"], y["end_r6"])) if message is None else (0, 0)
        if message or start > end:
            return self.spark.createDataFrame([(message or "no overlap",)], "error string")
        members = intervals.overlaps(self.t["genes"], x["chr"], start, end)
        scored = vectors.two_query_scores(self.embeddings.join(members.select("fbgn"), "fbgn", "left_semi"), self._query(x["phenotype"]), self._query(y["phenotype"]), "fbgn", "embedding")
        found = members.join(scored, "fbgn").orderBy(*rank.shared_order(), "fbgn")
        return found if top is None else found.limit(top)


VERBS = ("phenotype", "keyword", "omim", "ortholog_of", "citing", "bullets_in", "index_stats", "stats", "resolve", "gene", "search", "disease", "ortholog", "paper", "tissue", "category", "go", "region", "lift", "semantic", "ask", "qtl_list", "qtl_overlaps", "qtl_rank", "qtl_shared")


def main(args: list[str]) -> int:
    from tessera.plans.atlas import load
    from tessera.session import session

    if len(args) < 2 or args[1] not in VERBS:
        print(f"usage: ATLAS {{{'|'.join(VERBS)}}} [ARG...] [name=value...]", file=sys.stderr)
        return 2
    spark = session()
    atlas = Atlas(load(spark, args[0]))
    plain = [a for a in args[2:] if "=" not in a]
    named = dict(a.split("=", 1) for a in args[2:] if "=" in a)
    call = [plain] if args[1] == "resolve" else plain
    for row in getattr(atlas, args[1])(*call, **{k: int(v) if v.isdigit() else v for k, v in named.items()}).toJSON().toLocalIterator():
        print(row)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
