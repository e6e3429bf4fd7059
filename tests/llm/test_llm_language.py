import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import docs, empty, odd  # noqa: F401
from tracemill.llm import language as L

WORDS = {"aa": "bana cana dana fana gana", "bb": "xiru yiru ziru wiru viru"}


@pytest.fixture
def model(spark):
    rows = [(i, " ".join(np.random.default_rng(i).permutation((WORDS[l] + " ").split() * 3)), l) for i, l in enumerate(["aa", "bb"] * 10)]
    return L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def page(i, url, text, lang=None):
    return (i, url, f"<!DOCTYPE html><html{f' lang={lang}' if lang else ''}><head><script>viru viru</script></head><body><p>{text}</p></body></html>")


def brute(model, rows):
    """The fusion in numpy, for rows of (id, text, declared, suffix, host, domain)."""
    n = len(model.languages)
    scorer = L.Scorer(model)
    logs = np.array([scorer.texts([r[1]])[0] for r in rows])
    soft = lambda x: np.exp(x - x.max(axis=-1, keepdims=True)) / np.exp(x - x.max(axis=-1, keepdims=True)).sum(axis=-1, keepdims=True)
    own = soft(logs)
    prior = (own.sum(axis=0) + L.EVEN_WEIGHT / n) / (len(rows) + L.EVEN_WEIGHT)
    out = []
    for k, row in enumerate(rows):
        others = lambda c: sum((own[j] for j, r in enumerate(rows) if j != k and r[c] is not None and r[c] == row[c]), np.zeros(n))
        domain, host = others(5), others(4)
        of_domain = (domain + L.HOST_WEIGHT * prior) / (domain.sum() + L.HOST_WEIGHT)
        of_host = (host + L.HOST_WEIGHT * of_domain) / (host.sum() + L.HOST_WEIGHT)
        total = logs[k] + np.log(of_host)
        for c in (2, 3):
            if row[c] is not None:
                total = total + np.log((others(c) + L.EVEN_WEIGHT * prior) / ((len(rows) + L.EVEN_WEIGHT) * prior))
        out.append((row[0], model.languages[int(soft(total).argmax())], soft(total).max()))
    return out


PAGES = [
    page(1, "http://a.site.aa/x", "bana cana dana", "aa"),
    page(2, "http://a.site.aa/y", "fana", "aa"),
    page(3, "http://b.site.aa/y", "", None),
    page(4, "http://c.other.bb/", "xiru yiru", "bb"),
    page(5, "http://c.other.bb:80/q?z", "", "BB-x"),
    page(6, "odd address", "viru wiru", None),
    (7, None, None),
    page(2, "http://a.site.aa/y", "fana", "aa"),
]


def test_fusion_equals_brute_force(spark, model):
    rows = L.identify_pages(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    plain = [(r.page_id, r.text, r.declared, r.suffix, r.host, r.domain) for r in rows.collect()]
    assert plain[0][2:] == ("aa", "aa", "a.site.aa", "site.aa") and plain[4][2] == "bb"
    got = sorted((r.page_id, r.language, r.confidence) for r in L.identify(model, rows).collect())
    want = sorted(brute(model, plain))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])
    by_id = {g[0]: g[1] for g in got}
    # No text: the host and the declared language decide.
    assert by_id[3] == "aa" and by_id[5] == "bb"


def test_odd_rows_and_empty_tables(spark, model, odd, empty):
    assert L.identify(model, L.identify_documents(odd)).count() == odd.count()
    assert L.identify(model, L.identify_documents(empty)).count() == 0
    none = L.fit(empty)
    assert none.languages == []
    got = L.identify(none, L.identify_documents(odd)).collect()
    assert len(got) == odd.count() and all(r.language is None for r in got)


def test_query_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = L.op9_language_fusion(spark, sf).collect()
    docs = {r.doc_id: r.language for r in rows if r.doc_id is not None}
    assert docs.keys() == langs.keys()
    assert sum(docs[i] == l for i, l in langs.items()) > 0.98 * len(langs)
    assert sum(r.page_id is not None for r in rows) == spark.read.parquet(f"{sf}/pages.parquet").count()


def test_accuracy_on_rows_not_fitted(spark):
    """Documents of a fold the model never saw, copies of fitted texts left out."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = L.fit(docs.where(~held))
    unseen = docs.where(held).join(docs.where(~held).select("text").distinct(), "text", "left_anti")
    want = {r.doc_id: r.lang for r in unseen.select("doc_id", "lang").collect()}
    got = {r.doc_id: r.language for r in L.identify(model, L.identify_documents(unseen)).collect()}
    assert got.keys() == want.keys() and len(want) > 100
    right = sum(got[i] == want[i] for i in want)
    print(right, len(want))
    assert right / len(want) > 0.95
