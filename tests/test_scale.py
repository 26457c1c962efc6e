"""Results that once differed where tables or numbers are large."""

from __future__ import annotations

import random
import time

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.functions import positions
from tessera.operators import intervals, lookup


def test_letters_go_on_past_a_byte(spark):
    df = spark.range(60_000).select("id", F.lit("a").alias("g"), F.lit("").alias("label")).withColumnRenamed("id", "pos")
    got = dict(lookup.letters(df, "g", "label", ["pos"]).select("pos", "id").collect())
    code = lambda n: 64 + n + (0x800 if 64 + n >= 0xD800 else 0)
    assert all(got[n - 1] == "a_" + chr(code(n)) for n in (1, 26, 64, 191, 192, 1200, 55_231, 55_232, 60_000))
    assert len(set(got.values())) == 60_000


def test_megabases_are_rounded_by_their_binary_value(spark):
    ns = [1_000_000, 1_005_000, 1_015_000, 1_025_000, 1_125_000, 1_375_000, 1_995_000, 1_234_565_000, 999_995_000, 2_675_000, 99_999_999_995_000, *[12_345 * 1000 * k for k in range(1, 400)]]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in ns], "n long").select(positions.format_bp(F.col("n"))).collect()]
    assert got == [f"{n / 1_000_000:.2f} Mb" for n in ns]


def same_as_sql(spark, name: str, folder: str, tables: list[str]) -> int:
    """Rows of the query on the folder, which are those of its SQL."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    found = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    want = sorted(map(repr, found.fetchall()))
    assert sorted(repr(tuple(r)) for r in entry.queries()[name](spark, folder).select(*columns).collect()) == want
    return len(want)


def test_positions_of_large_keys(spark, tmp_path):
    keys = spark.range(400).select(F.col("id").alias("o_orderkey"), (F.col("id") * 2500).alias("o_custkey"))
    keys.write.parquet(f"{tmp_path}/orders.parquet")
    assert same_as_sql(spark, "parsed_positions", str(tmp_path), ["orders"]) == 400


def test_short_intervals_do_not_meet_in_the_bins_of_a_long_one(spark):
    n = 100_000
    df = spark.range(n).select("id", F.lit("x").alias("chr"), (F.col("id") * 1000 + 1).alias("start"), (F.col("id") * 1000 + 5).alias("end"))
    df = df.unionByName(spark.createDataFrame([(n, "x", 1, 2**40)], "id long, chr string, start long, end long"))
    began = time.monotonic()
    assert intervals.pair_overlaps(df, "id", "id", width="levels").count() == n
    assert time.monotonic() - began < 60  # all pairs of n in one bin take minutes


def made(rng: random.Random, n: int) -> list[tuple]:
    out = []
    for k in range(n):
        start = rng.choice([rng.randrange(-300, 300), rng.randrange(10**6), rng.randrange(-(10**9), 10**9)])
        out.append((k, rng.choice("xyz"), start, start + rng.choice([0, 1, 2, 7, 8, 300, 10**6, 10**9])))
    return [*out, (n, "x", -(2**60), 2**60), (n + 1, "x", 10, 9), (n + 2, None, 1, 2), (n + 3, "x", None, 2), (n + 4, "w", 5, 6)]


def test_aggregates_of_overlaps_equal_the_join(spark):
    rng = random.Random(7)
    a, b = made(rng, 300), made(rng, 400)
    want = {}
    for i, g, s, e in a:
        hit = [j for j, h, t, f in b if g and g == h and None not in (s, t) and s <= e and t <= f and e >= t and s <= f]
        if hit:
            want[i] = (len(hit), min(hit), max(hit))
    da, db = spark.createDataFrame(a, "i long, g string, s long, e long"), spark.createDataFrame(b, "j long, h string, t long, f long")
    got = intervals.overlap_aggregates(da, db, ("g", "s", "e"), ("h", "t", "f"), ["i"], "j")
    assert {r["i"]: (r["n"], r["least"], r["most"]) for r in got.collect()} == want and len(want) > 250
    none = intervals.overlap_aggregates(da, db.where("false"), ("g", "s", "e"), ("h", "t", "f"), ["i"], "j")
    assert none.columns == ["i", "n", "least", "most"] and none.count() == 0


def test_counts_in_pairs_equal_the_join(spark):
    rng = random.Random(8)
    rows, things = made(rng, 150), made(rng, 200)
    df, items = (spark.createDataFrame(x, "id long, chr string, start long, end long") for x in (rows, things))
    got = {(r["id_a"], r["id_b"]): r["n_items"] for r in intervals.pair_counts(df, "id", "id", items, width="levels").collect()}
    plain = intervals.count_inside(intervals.pair_overlaps(df, "id", "id", width="levels"), items, "chr", ("chr", "start", "end"), "id", "levels")
    want = {(r["id_a"], r["id_b"]): r["n_items"] for r in plain.collect()}
    assert got == want
    assert len(got) > 200


def test_dense_events_are_counted_without_a_join(spark, tmp_path):
    """4000 events of one minute make 8 million pairs in 32 thousand million triples."""
    rows = spark.range(4000).select(F.col("id").alias("event_id"), F.lit("e").alias("event_type"), (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, (id % 60) + 0.5)")).alias("ts"), F.col("id").alias("user_id"), F.lit(1.0).alias("value"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    began = time.monotonic()
    found = entry.queries()["pair_overlap_counts"](spark, str(tmp_path)).agg(F.count("*"), F.min("n_items"), F.max("n_items")).first()
    assert tuple(found) == (4000 * 3999 // 2, 4000, 4000) and time.monotonic() - began < 120


def test_copies_are_dealt_and_met_together(spark, tmp_path):
    """200 copies of 20 events within an hour: rows are joined by their times, and the pairs of copies follow one another, so that they take less than a byte a pair as Parquet (1.7 where each row is joined by itself)."""
    rows = spark.range(4000).select(F.col("id").alias("event_id"), F.lit("e").alias("event_type"), (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id % 20 * 173 + 0.5)")).alias("ts"), F.expr("id * id % 7").alias("user_id"), F.lit(1.0).alias("value"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    n = same_as_sql(spark, "pair_overlap", str(tmp_path), ["events"])
    assert n == 20 * 200 * 199 // 2 + 19 * 200 * 200
    entry.queries()["pair_overlap"](spark, str(tmp_path)).write.parquet(f"{tmp_path}/pairs")
    assert sum(x.stat().st_size for x in (tmp_path / "pairs").glob("*.parquet")) < n


def test_packed_pairs_equal_the_plain_ones(spark):
    rng = random.Random(9)
    rows = [(f"i{k}", (k * 7919) % 1009, g, s, e, rng.choice(["u", "v", None])) for k, (_, g, s, e) in enumerate(made(rng, 120) * 4)]
    rows += [(f"j{k}", 2000 + k, "x", 50, 60, "u") for k in range(90)] + [("none", None, "x", 50, 60, "u"), (None, 3000, "x", 50, 60, "v")]
    df = spark.createDataFrame(rows, "id string, o long, chr string, start long, end long, fam string").withColumn("c", F.col("start") * 2)
    for width in (10**9, "levels", None):
        few = df.where("abs(start) < 1000000000 and end - start <= 1000000000 and start <= end") if width != "levels" else df
        plain, packed = (intervals.pair_overlaps(few, "id", "o", label="fam", width=width, carried=("c",), together=t) for t in (None, 30))
        assert packed.columns == plain.columns and packed.dtypes == plain.dtypes
        assert "posexplode" in packed._jdf.queryExecution().toString() and "posexplode" not in plain._jdf.queryExecution().toString()
        want = sorted(map(repr, plain.collect()))
        assert sorted(map(repr, packed.collect())) == want and len(want) > 5000


def test_intervals_that_do_not_repeat_are_joined_as_they_are(spark):
    df = spark.range(500).select("id", F.lit("x").alias("chr"), (F.col("id") + 1).alias("start"), (F.col("id") + 2).alias("end"))
    pairs = intervals.pair_overlaps(df, "id", "id", width=10, together=30)
    assert "posexplode" not in pairs._jdf.queryExecution().toString() and pairs.count() == 499
    assert intervals.pair_overlaps(df.where("false"), "id", "id", width=10, together=30).count() == 0


def test_dense_copies_are_dealt_by_their_pairs(spark, tmp_path, monkeypatch):
    """2000 events of five hours in 100 copies are a few kB where they are dealt, which adaptive execution gave to one task with all pairs."""
    monkeypatch.setattr(intervals, "PAIRS", 5_000, raising=False)
    rows = spark.range(2000).select(F.col("id").alias("event_id"), F.lit("e").alias("event_type"), (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id % 20 * 900 + 0.5)")).alias("ts"), F.expr("id * id % 7").alias("user_id"), F.lit(1.0).alias("value"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    assert same_as_sql(spark, "pair_overlap", str(tmp_path), ["events"]) == 20 * 100 * 99 // 2
    found = entry.queries()["pair_overlap"](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(found) > 4 and max(r["count"] for r in found) < 99_000 / 2
    plan = entry.queries()["pair_overlap"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and plan.count("ENSURE_REQUIREMENTS") <= plan.count("ObjectHashAggregate") + plan.count("HashAggregate")  # the join deals nothing again


def test_a_large_class_is_cut(spark):
    df = spark.range(5000).select("id", F.lit("x").alias("chr"), F.when(F.col("id") < 4990, 7).otherwise(F.col("id")).alias("start"), F.lit(9000).alias("end"))
    got = intervals._classes(df, ("chr", "start", "end"), ["id"], 100).collect()
    assert sorted(x for r in got for x in r["id"]) == list(range(5000)) and all(r["id"] == sorted(r["id"]) for r in got)
    assert 40 <= sum(r["start"] == 7 for r in got) <= 50 and max(len(r["id"]) for r in got) < 200


def test_no_row_limit_where_all_are_asked_for(spark):
    from tessera.plans.facade import Atlas

    n = 10_050
    genes = spark.range(n).select(F.format_string("FBgn%07d", "id").alias("fbgn"), F.lit("s").alias("symbol"), F.lit(1).alias("n_bullets"))
    tables = {"genes": genes, "diseases": genes.select("fbgn", F.lit("ill").alias("name"), F.lit("000020").alias("omim_id"))}
    tables["bullets"] = genes.select("fbgn", F.col("fbgn").alias("bullet_id"))
    tables["alleles"] = tables["bullets"].withColumn("allele", F.lit("al3"))
    a = Atlas(tables)
    assert a.omim("000020").count() == n == a.disease("ill", None).count() == a.bullets_by("alleles", F.col("allele") == "al3", None, None).count()
    assert a.omim("000020", 7).count() == 7 == a.bullets_by("alleles", F.col("allele") == "al3", None, 7).count()


def test_documents_of_several_relations_are_made_once(spark, smallest):
    from tessera import catalog_entities
    from tessera.catalog import Tables

    for name, rows in catalog_entities.atlas(Tables(spark, smallest)).t.items():
        assert "from_json" not in rows._jdf.queryExecution().toString(), name


def test_relations_make_no_more_of_a_document_than_they_read(spark, smallest):
    from tessera import catalog_entities, schemas
    from tessera.catalog import Tables

    t = Tables(spark, smallest)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    own = catalog_entities.relations(t, "genes", "bullets", "diseases", "orthologs")
    assert "l_partkey" not in plan(own["diseases"]) and "l_partkey" not in plan(own["orthologs"])
    assert "l_quantity" in plan(own["bullets"]) and plan(own["genes"]).count("lambda x_") < plan(own["bullets"]).count("lambda x_")
    docs = catalog_entities.entities(t)
    assert [f"{f.name}:{f.dataType.simpleString()}" for f in docs.schema] == [f"{f.name}:{f.dataType.simpleString()}" for f in spark.createDataFrame([], schemas.ENTITY).schema]
    assert plan(docs).count("Aggregate") == 1 and "from_json" not in plan(docs)


def test_nested_moves_each_column_once(spark):
    from tessera.operators import flatten

    rows = spark.createDataFrame([(1, 2, "b", 5), (1, 1, "a", 6), (1, 2, "b", 4)], "k int, n int, s string, v int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    doc = flatten.nested(parent, "k", {"c": (rows, ["n", "s"], ["s", "v", "n"]), "d": (rows, ["n"], ["n", "s", "v"])})
    assert sorted((r["k"], [tuple(x) for x in r["c"]], [tuple(x) for x in r["d"]]) for r in doc.collect()) == [(1, [("a", 6, 1), ("b", 4, 2), ("b", 5, 2)], [(1, "a", 6), (2, "b", 4), (2, "b", 5)]), (2, [], [])]
    plan = flatten.nested(parent, "k", {"c": (rows, ["n", "s"], ["s", "v", "n"])})._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct(n," in plan and "struct(o," not in plan


def test_cells_of_a_line_are_split_once(spark, smallest):
    plan = entry.queries()["source_physical_interactions"](spark, smallest)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(regexp_replace(") == 1 and plan.count("Relation [") == 1


def test_texts_move_before_they_become_words(spark):
    from tessera.operators import search

    docs = spark.createDataFrame([(1, "b a b"), (2, None), (1, "a"), (None, "a")], "d long, t string")
    found = search.postings(docs, "d", ["t"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")  # the plan is printed from the top
    assert sorted(((r["doc"], r["term"], r["tf"], r["positions"]) for r in found.collect()), key=str) == [(1, "a", 2, [0, 1]), (1, "b", 2, [0, 2]), (None, "a", 1, [0])]


def test_an_index_is_built_without_a_row_a_place(spark, tmp_path, monkeypatch):
    """Postings made from arrays are those of ``search.postings``, also where documents are cut, long, repeated, without words or without an id; impacts follow from the stored postings."""
    from tessera.operators import ranked, search

    monkeypatch.setattr(ranked, "WORDS", 50)
    rng = random.Random(3)
    rows = [(rng.choice([k, k, 7, None]), rng.choice(["a b a", None, ""]), " ".join(rng.choices(["a", "b", "é", "zz9", "Ünder"], k=rng.choice([0, 1, 30, 200])))) for k in range(200)]
    for name, docs, fields in (("two", spark.createDataFrame(rows, "d long, t string, u string"), ["t", "u"]), ("one", spark.createDataFrame([(str(d), u) for d, _, u in rows], "d string, u string").repartition(3), ["u"])):
        counted = ranked._counted(docs, "d", fields, False)
        assert "Generate" not in counted._jdf.queryExecution().executedPlan().toString()
        want = sorted(map(repr, search.postings(docs, "d", fields).collect()))
        assert sorted(map(repr, counted.select("doc", "field", "term", "tf", "positions").collect())) == want and len(want) > 100
        path = f"{tmp_path}/{name}"
        ranked.build(docs, "d", fields, path, parts=3)
        assert sorted(x.name for x in (tmp_path / name).iterdir()) == ["impacts", "levels", "postings", "totals"]
        index = ranked.StoredIndex.load(spark, path)
        assert sorted(map(repr, index.postings.select("doc", "field", "term", "tf", "positions").collect())) == want
        whole = index.postings.where("doc IS NOT NULL").groupBy("doc", "term").agg(F.sum("tf").alias("tf"))
        lengths = whole.groupBy("doc").agg(F.sum("tf").alias("len"))
        assert sorted(map(repr, index.impacts.select("doc", "term", "tf", "len").collect())) == sorted(map(repr, whole.join(lengths, "doc").select("doc", "term", "tf", "len").collect()))


def test_the_impacts_take_no_exchange(spark, tmp_path, monkeypatch):
    """The texts are dealt once and their words by ranges once; a second exchange of all words for the impacts, and a second run of what a dealing by ranges samples, once took most of the time."""
    from pyspark.sql import DataFrameWriter

    from tessera.operators import ranked

    plans, write = {}, DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path, *a, **k: (plans.update({path.rsplit("/", 1)[1]: w._df._jdf.queryExecution().executedPlan().toString()}), write(w, path, *a, **k))[1])
    ranked.build(spark.createDataFrame([(1, "b a b"), (2, "a")], "d long, t string"), "d", ["t"], str(tmp_path))
    assert "Exchange" not in plans["impacts"] and plans["postings"].count("Exchange") == 1 and "MapInArrow" not in plans["postings"]
