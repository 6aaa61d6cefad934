"""Fusion of language evidence, against plain Python and on pages whose language is known."""
import math
from collections import defaultdict

import numpy as np

from corpusprep.llm.langid import Evidence, address, declared, features, fit, identify, visible

SENTENCES = {
    "en": "the quick brown fox jumps over the lazy dog while children are playing in the garden with their mother and father",
    "de": "der schnelle braune fuchs springt über den faulen hund während die kinder mit ihrer mutter und ihrem vater im garten spielen",
    "fr": "le rapide renard brun saute par dessus le chien paresseux pendant que les enfants jouent dans le jardin avec leur mère",
}


def tables(spark):
    docs = [(i, t, lang) for i, (lang, t) in enumerate(list(SENTENCES.items()) * 4)] + [(90, None, "en"), (91, "xx", None), (None, "the dog", "en")]
    page = lambda lang, text: f'<html lang="{lang}"><body><nav>menu</nav><article><p>{text}</p></article></body></html>'
    pages = [(i, f"https://www.a.example.{'de' if lang == 'de' else 'com'}/{i}", page(lang, " ".join(SENTENCES[lang].split()[i % 5:])))
             for i, lang in enumerate(["en", "de", "fr", "en", "de", "de", "en", "en"])]
    pages += [(50, None, None), (51, "nonsense", ""), (52, "http://www.a.example.de/q", "<p>12 34</p>"), (None, "http://127.0.0.1:80/", page("fr-CA", SENTENCES["fr"])),
              (3, pages[3][1], pages[3][2]), (54, "https://x.example.com", page("zz", SENTENCES["en"]))]
    return (spark.createDataFrame(pages, "page_id long, url string, html string"), pages,
            spark.createDataFrame(docs, "doc_id long, text string, lang string"))


def test_parts():
    assert declared('<HTML xml:lang="De-AT">') == "de" and declared("<p>") is None
    assert declared("<html><meta http-equiv='Content-Language' content='fr'>") == "fr"
    assert address("HTTPS://u@WWW.Ex.ample.org:8/x") == ("www.ex.ample.org", "ample.org", "org")
    assert address("http://127.0.0.1/") == ("127.0.0.1", "127.0.0.1", None) and address(None) == ("", "", None)
    assert visible("<nav>a</nav><main><p>b &amp; c</p></main>") == "b & c" and visible("<nav>a</nav>") == "a"


def test_posteriors_equal_plain_bayes(spark):
    pages, rows, docs = tables(spark)
    how = Evidence()
    names, logs = fit(docs, "lang", "text", "doc_id", how)
    assert names == ["de", "en", "fr"]
    got = identify(pages, docs).collect()
    page = []
    for _, url, html in rows:
        with np.errstate(over="ignore"):
            _, b = features([visible(html or "").encode()], how)
        ll = how.temper * logs[:, b].sum(axis=1)
        ll -= ll.max()
        r = np.exp(ll) / np.exp(ll).sum()
        host, domain, suffix = address(url)
        d = declared(html or "")
        page.append((ll, r, {"s": d if d in names else "?" if d else "-", "z": suffix or "-", "h": host, "d": domain}, len(b)))
    sums = defaultdict(lambda: np.zeros(3))
    for _, r, at, _ in page:
        sums["all"] += r
        for k, v in at.items():
            sums[k, v] += r
    want = []
    for (key, *_), (ll, r, at, n) in zip(rows, page, strict=True):
        rest = {k: sums[k, v] - r for k, v in at.items()}
        every, a, e = sums["all"] - r, how.strength, how.smoothing
        p = (every + a / 3) / (every.sum() + a)
        for k in "dh":
            p = (rest[k] + a * p) / (rest[k].sum() + a)
        zones = len({x[2]["z"] for x in page})
        logp = ll + np.log((rest["s"] + e) / (every + e * 5)) + np.log((rest["z"] + e) / (every + e * zones)) + np.log(p)
        want.append((str(key), names[int(np.argmax(logp))], round(float(1 / np.exp(logp - logp.max()).sum()), 4), names[int(np.argmax(ll))] if n else None))
    assert sorted((str(r["page_id"]), r["lang"], round(r["probability"], 4), r["text_lang"]) for r in got) == sorted(want, key=str) or \
        all(math.isclose(x[2], y[2], abs_tol=2e-4) and x[:2] == y[:2] for x, y in zip(
            sorted(((str(r["page_id"]), r["lang"], r["probability"]) for r in got), key=str), sorted((w[:3] for w in want), key=str), strict=True))
    by = {r["page_id"]: r for r in got}
    assert by[54]["lang"] == "en" and by[None]["lang"] == "fr" and by[52]["text_lang"] is None and by[52]["lang"] is not None


def test_empty_tables(spark):
    pages, _, docs = tables(spark)
    assert identify(pages.limit(0), docs).collect() == []
    assert {r["lang"] for r in identify(pages, docs.limit(0)).collect()} == {None}


def test_declared_language_of_generated_pages(spark):
    sf = "/root/testdata/sf0.01"
    got = identify(spark.read.parquet(f"{sf}/pages.parquet"), spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert sum(r["lang"] == r["declared"] for r in got) >= 0.99 * len(got)
    assert sum(r["text_lang"] == r["declared"] for r in got) >= 0.98 * len(got)  # without the other evidence
