from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import langid
from tessera.llm.queries import op3_language_id, page_languages


def test_held_out_accuracy(spark, smallest, documents):
    """Profiles see a few rows; the text's likelihood alone names the others."""
    rows = langid.identify(documents, sample=10).select("lang", "__text_language", "__language", "__accepted").collect()
    assert len(rows) == documents.count()
    assert sum(r["lang"] == r["__text_language"] for r in rows) >= 0.98 * len(rows)
    assert sum(r["lang"] == r["__language"] for r in rows) >= 0.99 * len(rows)
    assert all(r["__accepted"] for r in rows)


def test_query_keeps_all_documents(spark, smallest, documents):
    rows = op3_language_id(spark, smallest).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in documents.select("doc_id").collect()}
    assert all(0 <= r["posterior"] <= 1 for r in rows)


def test_pages_by_declaration_suffix_and_host(spark, smallest):
    rows = page_languages(spark, smallest).collect()
    assert len(rows) == spark.read.parquet(f"{smallest}/pages.parquet").count()
    assert {r["suffix"] for r in rows} == {"com", "net", "org"}
    assert sum(r["declared"] == r["language"] for r in rows if r["declared"]) >= 0.9 * sum(r["declared"] is not None for r in rows)


def test_markup(spark):
    df = spark.createDataFrame([("<HTML class=x LANG='pt-BR'><p>a<b>c</p>&amp;<style>p{}</style>d<script>e",), ("<html><a lang=fr>x" + "<script" * 30_000,), (None,)], "h string")
    got = [tuple(r) for r in df.select(langid.markup_language(F.col("h")), langid.markup_text(F.col("h"))).collect()]
    assert [x for x, _ in got] == ["pt-BR", None, None] and got[0][1].split() == ["a", "c", "d"] and got[1][1].split() == ["x"] and got[2][1] is None


def normal(logs: list[float]) -> list[float]:
    top = max(logs)
    exps = [math.exp(x - top) for x in logs]
    return [x / sum(exps) for x in exps]


def test_posterior_against_plain_arithmetic(spark, documents):
    """Text scores are taken from the profiles trigram by trigram; priors and reliabilities are summed row by row."""
    rng = random.Random(6)
    docs = [(r["doc_id"], r["text"][: rng.choice((6, 15, 60, 900))], rng.choice((r["lang"], r["lang"], "en", None, "xx")), rng.choice(("http://a.de/x", "b.fr", "c.fr", "host", None, f"h{r['doc_id'] % 9}.es"))) for r in documents.collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = {r["row"]["doc_id"]: r for r in langid.classify(df, sample=64).collect()}
    rows = df.select("doc_id", "text", langid.tag_of("lang").alias("d"))
    names, profiles, undetermined = langid.fit_profiles(rows, "text", "d", F.xxhash64(F.lit(7), "doc_id"), 64)
    n, host, suffix, tag, logs = len(names), {}, {}, {}, {}
    for k, text, lang, url in docs:
        host[k] = url and url.removeprefix("http://").split("/")[0]
        suffix[k] = host[k].rpartition(".")[2] if host[k] and "." in host[k] else None
        tag[k] = lang
        grams = langid.trigrams(text).tolist()
        scale = min(len(grams), langid.TEMPER) / max(1, len(grams))
        logs[k] = [sum(float(profiles[g][j]) for g in grams) * scale for j in range(n)] + [undetermined * len(grams) * scale] if grams else None
    p = {k: normal(x[:n]) for k, x in logs.items() if x}
    total = [sum(x[j] for x in p.values()) + 1 for j in range(n)]
    overall = [x / sum(total) for x in total]
    count = lambda of, value: [sum(x[j] for k, x in p.items() if of[k] == value) for j in range(n)]
    smooth = lambda c, strength, to: [(c[j] + strength * to[j]) / (sum(c) + strength) for j in range(n)]
    by_suffix = {s: smooth(count(suffix, s), langid.SUFFIX_ROWS, overall) for s in set(suffix.values()) - {None}}
    by_host = {h: smooth(count(host, h), langid.HOST_ROWS, by_suffix.get(h.rpartition(".")[2] if "." in h else None, overall)) for h in {host[k] for k in p} - {None}}
    by_tag = {d: count(tag, d) for d in names}
    said = {d: [(by_tag[d][j] + langid.RELIABILITY_ROWS / n) / (sum(by_tag[e][j] for e in names) + langid.RELIABILITY_ROWS) for j in range(n)] for d in names}
    for k in logs:
        if not logs[k]:
            assert got[k]["language"] == "und" and not got[k]["accepted"]
            continue
        prior, known = by_host.get(host[k], overall), said.get(tag[k])
        fused = [logs[k][j] + math.log(prior[j]) + (math.log(known[j]) if known else 0) for j in range(n)]
        fused.append(logs[k][n] + math.log(1e-3) - (math.log(n) if known else 0))
        want = normal(fused)
        assert got[k]["posterior"] == pytest.approx(max(want), rel=1e-6)
        assert got[k]["language"] == [*names, "und"][want.index(max(want))]


def test_priors_decide_short_text_and_junk_is_undetermined(make_docs, documents):
    texts = {lang: [r["text"] for r in documents.where(F.col("lang") == lang).limit(25).collect()] for lang in ("de", "fr")}
    rows = [(k, t, "de", "a.example.de") for k, t in enumerate(texts["de"])] + [(100 + k, t, "fr", "b.example.fr") for k, t in enumerate(texts["fr"])]
    rows += [(200, "en", None, "a.example.de"), (201, "en", None, "b.example.fr"), (202, None, "de", "a.example.de"), (203, "12 34 !!", "de", None), (204, "", None, None), (None, texts["de"][0], "xx", None)]
    rows += [(205, "xqzvk wqxzj kqvxz zzqxw vkqjx qxzwv jjqzx kvvqx " * 8, None, None), (206, texts["fr"][0], "de", "a.example.de"), (206, texts["fr"][0], "de", "a.example.de")]
    got: dict = {}
    for r in langid.identify(make_docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["__language"], r["__accepted"]))
    assert [got[k][0][0] for k in (200, 201)] == ["de", "fr"]
    assert all(got[k] == [("und", False)] for k in (202, 203, 204, 205))
    assert got[206] == [("fr", True)] * 2 and got[None] == [("de", True)]
    assert got[0] == [("de", True)] and got[100] == [("fr", True)]


def invented(rng: random.Random, letters: str):
    """A language of 400 words of some letters: a function that makes a text of so many words."""
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    return lambda n: " ".join(rng.choice(words) for _ in range(n))


def test_a_tag_of_one_row_does_not_accept_undetermined_text(make_docs):
    rng = random.Random(4)
    a, b, rare = invented(rng, "abcdefg"), invented(rng, "defghijk"), invented(rng, "lmnop")
    rows = [(k, (a, b)[k % 2](150), "ab"[k % 2] * 2, None) for k in range(2 * langid.SAMPLE)] + [(9000, rare(12), "xx", None)]
    junk = ["".join(rng.choice("qrstuvwxyz ") for _ in range(400)) for _ in range(20)] + ["".join(chr(rng.randrange(0x3B1, 0x3C9)) for _ in range(300)) for _ in range(5)]
    rows += [(10_000 + k, t, None, None) for k, t in enumerate(junk)]
    got = {r["doc_id"]: r["__language"] for r in langid.identify(make_docs(rows)).collect()}
    assert {got[10_000 + k] for k in range(25)} == {"und"}
    assert got[0] == "aa" and got[1] == "bb" and got[9000] == "xx"


def test_every_declared_language_has_a_profile(make_docs):
    rng = random.Random(5)
    names = [f"{x}{y}" for x in "abcdefgh" for y in "klmnopqrs"]  # 72 languages, each with letters of its own
    rows = []
    for k, name in enumerate(names):
        text = invented(rng, "".join(chr(0x4E00 + 10 * k + c) for c in range(10)))
        tags = (name, name.upper(), f" {name}-XY", f"{name}_Abcd")
        rows += [(100 * k + c, text(60), tags[c % 4], None) for c in range(8 if k else 4)]
    got = {r["doc_id"]: (r["__language"], r["__accepted"]) for r in langid.identify(make_docs(rows)).collect()}
    assert got == {r[0]: (names[r[0] // 100], True) for r in rows}


def test_no_declarations_and_empty(make_docs):
    rows = langid.identify(make_docs([(1, "some text", None, "x")])).collect()
    assert [(r["__language"], r["__accepted"]) for r in rows] == [("und", False)]
    docs = make_docs([(1, "a", "de")]).limit(0)
    assert langid.identify(docs).collect() == []


def test_trigrams():
    assert len(langid.trigrams("")) == 0 and len(langid.trigrams("12 ... 3")) == 0
    assert langid.trigrams("A, b").tolist() == langid.trigrams("a b").tolist() == langid.trigrams("  a\n--\nB ").tolist()


def test_suffix(spark):
    df = spark.createDataFrame([("http://x.Example.DE:80/a.fr",), ("src1",), (None,), ("a.b.fr",), ("https://h/x.de",)], "u string")
    assert [r[0] for r in df.select(langid.suffix_of(F.col("u"))).collect()] == ["de", None, None, "fr", None]


def test_tags(spark):
    tags = ["en", "EN-us", " de_AT ", "zh-Hant-TW", "x-klingon-a", "i-navajo", "und", "UND-x", "", " ", None, "e", "english and german", "lang=\"fr\"", "e" * 9, "12"]
    df = spark.createDataFrame([(t,) for t in tags], "lang string")
    assert [r[0] for r in df.select(langid.tag_of("lang")).collect()] == ["en", "en", "de", "zh", "x-klingon", "i-navajo", *[None] * 10]


def test_thousands_of_tags_share_a_profile(spark, monkeypatch):
    """Tags beyond the most frequent ones stay among the answers: by their declaration, their host, or as the most declared one."""
    import random

    rng = random.Random(3)
    monkeypatch.setattr(langid, "PROFILES", 2)
    words = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))
    rows = [(k, words("abcde", 40), "en", "a") for k in range(60)] + [(100 + k, words("fghij", 40), "de", "b") for k in range(60)]
    rows += [(200 + k, words("uvwxy", 40), "q" + "abcdefgh"[k % 8] + "x", f"h{k % 8}") for k in range(32)] + [(300, words("uvwxy", 40), "qzx", "h0")] * 5
    rows += [(400, words("uvwxy", 40), None, "h3"), (401, words("uvwxy", 40), None, None), (402, words("abcde", 40), "qax", "a"), (403, words("uvwxy", 40), "en", "h2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["row"]["doc_id"]: (r["language"], r["text_language"], r["accepted"]) for r in langid.classify(df).collect()}
    assert all(got[k] == ("en", "en", True) for k in range(60)) and all(got[100 + k] == ("de", "de", True) for k in range(60))
    assert all(got[200 + k][0] == "q" + "abcdefgh"[k % 8] + "x" for k in range(32)) and got[300][0] == "qzx"
    assert got[400][0] == "qdx" and got[401] == ("qzx", "qzx", True) and got[402][0] == "en" and got[403][0] == "qcx"


@pytest.mark.parametrize("tags", [150, 3000])
def test_the_plan_does_not_grow_with_the_tags(spark, tags):
    tag = lambda k: "".join("abcdefghijklmnopqrstuvwxyz"[k // 26**j % 26] for j in range(4))
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('text number ', id, ' of some words') AS text", "cast(null as string) AS source").withColumn("lang", F.element_at(F.array(*[F.lit(tag(k)) for k in range(150)]), (F.col("doc_id") % 150 + 1).cast("int")) if tags == 150 else F.concat(F.lit("x-"), F.col("doc_id").cast("string")))
    found = langid.classify(df, kept=["doc_id", "lang"])
    assert found.count() == 3000 and len(found._jdf.queryExecution().optimizedPlan().toString()) < 100_000
