"""Operators on single texts: extraction, rules, languages, pieces, urls, licences, chat, packing."""

import hashlib
import itertools
import random
import re
import textwrap
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkstream.llm import chat, htmltext, langid, licences, linecrf, packing, pieces, urlrules
from sparkstream.llm.common import held_out, ngram_hashes, viterbi, word_hashes

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id bigint, text string, lang string, kept string, score string"
ODD = [None, "", " \n\t ", "word", "word", "a" * 70_000, "x\0y", "日本語 text", "é" * 3]


def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, clashing column names."""
    rows = [(i, t, "en", "clash", "clash") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[3], (None, "null id", None, None, None)], DOCS)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(60):
        labels = int(rng.integers(1, 4))
        lengths = rng.integers(0, 7, size=int(rng.integers(1, 6)))
        scores = rng.normal(size=(int(lengths.sum()), labels))
        move = rng.normal(size=(labels, labels))
        got = viterbi(scores, lengths, move, chunk=int(rng.integers(1, 5)))
        at = 0
        for n in lengths:
            part, path = scores[at : at + n], got[at : at + n]
            at += n
            value = lambda p: sum(part[i, k] for i, k in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))
            every = [()]
            for _ in range(n):
                every = [(*p, k) for p in every for k in range(labels)]
            assert value(tuple(path)) == pytest.approx(max(map(value, every)))


def test_word_and_ngram_hashes_tell_texts_apart():
    texts = ["a b c d e f", None, "", "  a  b\tc d\ne f ", "a b", "b a", "é x", "a b c d e f g"]
    words, counts = word_hashes(texts)
    assert counts.tolist() == [6, 0, 0, 6, 2, 2, 2, 7]
    assert (words[:6] == words[6:12]).all()
    grams, per_text = ngram_hashes(words, counts, 5)
    assert per_text.tolist() == [2, 0, 0, 2, 1, 1, 1, 3]
    assert (grams[:2] == grams[2:4]).all() and grams[4] != grams[5]
    assert set(grams[:2]) < set(grams[7:])


# ---------------------------------------------------------------- pieces


def test_pieces_equal_the_library():
    enc = pieces.PrefixEncoder(MODEL)
    rng = random.Random(5)
    alphabet = " ▁\n\tab theTHE01é日本😀\x00<s>ñ　"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [" " * n + "a" + " " * (n // 2) for n in range(70)]
    texts += ["".join(rng.choice(list(enc.ids)) for _ in range(rng.randint(1, 20))) for _ in range(500)]
    for text in texts:
        assert enc.encode(text)[:-1] == enc.library.encode(text), repr(text)
        assert enc.encode(text)[-1] == enc.library.eos_id()


def test_pieces_forget_without_changing(monkeypatch):
    monkeypatch.setattr(pieces, "CHUNKS", 3)
    monkeypatch.setattr(pieces, "PAIRS", 5)
    enc = pieces.PrefixEncoder(MODEL)
    text = "the quick brown fox jumps over the lazy dog the quick brown fox"
    assert enc.encode(text)[:-1] == enc.library.encode(text)


def test_piece_digests(spark):
    got = {r["doc_id"]: r for r in pieces.digests(odd_docs(spark), MODEL, with_ids=True).collect()}
    lib = pieces.encoder(MODEL).library
    for i, text in enumerate(ODD):
        ids = [*lib.encode(text or ""), lib.eos_id()]
        assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert pieces.digests(odd_docs(spark), MODEL).count() == len(ODD) + 2
    assert pieces.digests(odd_docs(spark).limit(0), MODEL).count() == 0
    both = pieces.decode_column(pieces.encode_column(odd_docs(spark), MODEL), MODEL)
    assert all(r["decoded"] == (r["text"] or "") for r in both.collect())


# ---------------------------------------------------------------- html


PAGE = """<!DOCTYPE html><html><head><title>Never</title><style>p{}</style><script>var a="<p>no</p>"</script></head><body>
<header><a href="/">Home</a> Site</header><nav><ul><li><a href="/a">Menu of the site and of all it has to offer to you</a></ul></nav>
<div id="sidebar"><p>Side text that is as long as the text of an article and has the stop words of it.</p></div>
<div class="cookie-notice">We use cookies &amp; more.</div>
<article><header><h1>Title &lt;1&gt;</h1><span>by someone</span></header><p><b>One<br>two
   three&nbsp;four <a href=x>linked</a>.<p>Five &eacute; &#x41;</p><aside>Pull quote</aside><!-- not this -->
<form><label>Mail</label><input></form><ul><li>Point</li></ul><div class="ad">Buy</div><section class="reader-comments"><p>Nice</p></section></article>
<footer>Foot</footer><div class="comments"><h2>Comments</h2><p>Great post, I think that it is one of the best of the web.</p></div>"""


def test_article_without_its_surroundings():
    assert htmltext.main_text(PAGE) == "Title <1> One two three four linked. Five é A Point"


def test_pages_without_an_article():
    long = "This is the text of the page, and it is as long as it has to be for the rules to see what it is."
    junk = "Zork blip quux zork blip quux zork blip quux zork blip quux zork blip quux zork blip quux"
    page = f"<div><p>{long}</p><p>Short.</p><p>{long}</p><p>{junk}</p><p>Tail</p></div>"
    assert htmltext.main_text(page) == f"{long} Short. {long} {junk} Tail"  # no stop words, but nothing speaks against it
    code = "Numbers 1 2 3 Kubernetes Docker Postgres Kafka Redis Nginx Terraform Ansible Prometheus Grafana"
    assert htmltext.main_text(f"<div><p>{code}</p><p>{long}</p></div>") == f"{code} {long}"
    assert htmltext.main_text("plain text & more") == "plain text & more"
    for page in (None, "", "<p></p>", "<", "<!--", "<script>x", "</p></div>"):
        assert htmltext.main_text(page) in ("", "<")


def test_pages_in_other_languages_and_dense_text():
    polish = "Rząd zdecydował podnieść podatki dla dużych przedsiębiorstw, podczas gdy obywatele żądają lepszych usług."
    russian = "Правительство решило повысить налоги для крупных предприятий, а граждане требуют лучших услуг и школ."
    chinese = "政府决定提高在通信行业经营的大型企业的税收，而公民则要求为他们的子女提供更好的服务和更好的学校。" * 2
    links = "<ul><li>" + "".join(f'<a href="/{i}">Odnośnik numer {i}</a> ' for i in range(12)) + "</ul>"
    for text in (polish, russian, chinese):
        assert htmltext.main_text(f"<div>{links}<h1>Top</h1><p>{text}</p><p>Short.</p><p>{text}</p>{links}</div>") == f"Top {text} Short. {text}"
        assert htmltext.main_text(f"<article><p>{text}</p></article>") == text
    long = "This is the text of the page, and it is as long as it has to be for the rules to see what it is."
    names = "Present: Anna Kowalska, Bob Miller, Chen Wei, Dora Novak, Emil Brandt, Finn Olsen, Gina Rossi and Hugo Weber, Oslo 1994."
    assert htmltext.main_text(f"<div><p>{long}</p><p>{names}</p><p>{long}</p></div>") == f"{long} {names} {long}"
    assert htmltext.main_text(f"<div><p>{names}</p></div>") == names


def test_wrappers_named_after_what_is_beside_them():
    long = "This is the text of the page, and it is as long as it has to be for the rules to see what it is."
    junk = '<div class="related-posts"><article><p>' + long.replace("text", "teaser") + "</p></article></div>"
    for name in ("elementor-widget-container", "page-with-sidebar", "right-sidebar", "content-sidebar-wrap", "header-fixed",
                 "search-results", "widget", "nav-open", "sidebar_left"):
        assert htmltext.main_text(f'<div class="{name}"><article><p>{long}</p></article></div>') == long, name
        assert htmltext.main_text(f'<div id="{name}"><main><p>{long}</p></main></div>{junk}') == long, name
        if name != "widget":
            assert htmltext.main_text(f'<h1>Top</h1><div class="{name}"><p>{long}</p></div>').endswith(long), name
    for tag in ("main", "article"):
        assert htmltext.main_text(f'<{tag} class="site-main social share-post"><p>{long}</p></{tag}>{junk}') == long
    comments = '<ol class="comment-list"><li><article class="comment-body"><p>' + long.replace("text", "comment") + "</p></article></ol>"
    assert htmltext.main_text(f"<main><article><p>{long}</p></article>{comments}</main>") == long
    assert htmltext.main_text(f"<div><p>{long}</p></div>{comments.replace('article', 'div')}") == long
    assert htmltext.main_text(f'<div class="page" hidden><article><p>{long}</p></article></div>') == ""


def test_second_pass_takes_the_nearest_label():
    block = htmltext.Block("x", "page", 0, 0, False)
    good, bad, open_ = htmltext.GOOD, htmltext.BAD, htmltext.UNSURE
    labels = [good, open_, open_, open_, bad]
    assert htmltext.second_pass([block] * 5, labels) == [True, True, True, False, False]


def test_extract_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "clash"), (2, None, None, "clash"), (2, None, None, "clash")], "page_id bigint, url string, html string, text string"
    )
    got = htmltext.extract(pages, ["page_id", "url"]).collect()
    assert sorted((r["page_id"], r["n_chars"]) for r in got) == [(1, 51), (2, 0), (2, 0)]
    assert htmltext.extract(pages.limit(0), ["page_id", "url"]).count() == 0


def test_registered_pages_equal_the_markup(spark, sf_dir):
    import html

    from sparkstream.llm.queries import op1_html_extraction
    from sparkstream.tables import load

    want = {}
    for r in load(spark, sf_dir, "pages").collect():
        inside = r["html"].split("<article>", 1)[1].split("</article>", 1)[0]
        plain = re.sub(r"</?b>", "", re.sub(r"</?(p|br|h1)>", " ", inside))
        want[r["page_id"]] = " ".join(html.unescape(plain).split())
    assert {r["page_id"]: r["text"] for r in op1_html_extraction(spark, sf_dir).collect()} == want


# ---------------------------------------------------------------- quality


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    copied = sum(x in lines[:i] for i, x in enumerate(lines))
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, copied, len(hit)


def test_base_counts(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab# |\n\t\x0b é") for _ in range(rng.randint(0, 150))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD[:5], *texts])], "doc_id bigint, text string")
    model = linecrf.Crf(np.zeros(len(linecrf.FEATURES)), np.zeros((2, 2)))
    for r in linecrf.judge(docs, model).collect():
        want = plain_counts([*ODD[:5], *texts][r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_line_labels_of_held_out_documents(spark, sf_dir):
    """Fitted on one half of the labelled documents, the verdicts on the other half agree with the labels."""
    from sparkstream.tables import load

    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = linecrf.learn(docs, labels.where("doc_id % 2 = 0"))
    test = linecrf.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in test]) > 0.9
    assert all(r["kept"] for r in test if r["quality"]) or np.mean([r["kept"] for r in test if r["quality"]]) > 0.95


def test_fit_of_long_texts_is_bounded():
    """One text of 200 000 lines among many: the fit takes stretches of it, and the model still tells the lines apart."""
    assert linecrf.stretches(0) == [] and linecrf.stretches(300, 256) == [(0, 256), (256, 300)]
    some = linecrf.stretches(200_000, 256, 8)
    assert len(some) == 8 and some[0] == (0, 256) and some[-1][1] == 200_000
    good = [f"An ordinary line of prose number {i} with some words in it.\n" * 3 for i in range(40)]
    bad = ["$$$ BUY NOW !!! ### CLICK <<< HERE >>>\n" * 5 for _ in range(39)]
    model = linecrf.fit_crf([*good, *bad, "### $$$ BUY\n" * 200_000], [True] * 40 + [False] * 40, rounds=40)
    _, _, _, shares = linecrf.measure([good[0] * 30, bad[0] * 30], model, 0.5)
    assert shares[0] > 0.9 and shares[1] < 0.1


def plain_likelihood(lines, labels, weights, move):
    """The log-likelihood of a label sequence by listing all sequences."""
    score = lambda path: sum(float(x @ weights) * k for x, k in zip(lines, path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
    every = [score(p) for p in itertools.product((0, 1), repeat=len(lines))]
    return score(labels) - np.logaddexp.reduce(every)


def test_fit_climbs_the_likelihood():
    """The fitted weights reach the likelihood, counted by brute force, that plain ascent on it reaches."""
    texts = ["Good prose line here.\nAnother fine line 7.\nBUY $$$ NOW", "BUY $$$ NOW\n### !!!\nfine line", "Fine line.\n$$ $$", "## ## ##"]
    good = [True, False, True, False]
    model = linecrf.fit_crf(texts, good, rounds=3000, penalty=0.02)
    known = {line for t, g in zip(texts, good) if g for line in t.split("\n")}
    cases = []
    for t, g in zip(texts, good):
        lines, copied = linecrf.lines_of(t)
        cases.append((linecrf.matrix(lines, copied), tuple(int(g or line in known) for line in lines)))
    total = sum(len(y) for _, y in cases)

    def value(point):
        weights, move = point[:-4], point[-4:].reshape(2, 2)
        return sum(plain_likelihood(x, y, weights, move) for x, y in cases) / total - 0.01 * float(point @ point)

    climbed = np.zeros(len(model.weights) + 4)
    for _ in range(400):
        climbed += [(value(climbed + step) - value(climbed - step)) / 2e-4 for step in 1e-4 * np.eye(len(climbed))]
    fitted = value(np.concatenate([model.weights, model.move.ravel()]))
    assert value(0 * climbed) + 0.2 < value(climbed) and fitted > value(climbed) - 2e-3


def test_quality_odd_rows(spark):
    docs = odd_docs(spark)
    model = linecrf.learn(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    rows = linecrf.judge(docs, model).collect()
    assert len(rows) == len(ODD) + 2 and all(r["base_failed"] and not r["kept"] for r in rows)
    kept = linecrf.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == 0
    assert linecrf.judge(docs.limit(0), model).count() == 0


# ---------------------------------------------------------------- languages


def test_languages(spark, sf_dir):
    from sparkstream.tables import load

    docs = load(spark, sf_dir, "documents")
    model = langid.learn(docs, ~held_out(F.col("doc_id")))
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    texts = {r["lang"]: r["text"] for r in docs.where("length(text) > 900 and text not like '%!!%' and text not like '%***%'").collect()}
    one, two = texts["de"][:800], texts["es"][:800]
    mixed = spark.createDataFrame([(7, one + "\n" + two)], "doc_id bigint, text string")
    spans = langid.spans(mixed, model).orderBy("start").collect()
    assert [s["lang"] for s in spans[:2]] == ["de", "es"] and abs(spans[1]["start"] - len(one)) < 40
    assert sum(s["stop"] - s["start"] for s in spans if s["lang"] == "es") > 600


def test_language_scripts_and_odd_rows(spark):
    rows = [(i, t, "ru" if i % 2 else "en", "x", "y") for i, t in enumerate(["the cat and the dog", "кошка и собака бежали"] * 6)]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.learn(docs, F.lit(True))
    assert model.languages == ["en", "ru"]
    assert langid.word_scores(["dog", "cobaka", "собака"], model)[2, 0] < -1000
    got = {r["doc_id"]: r for r in langid.predict(odd_docs(spark), model).where("doc_id is not null").collect()}
    assert [got[i]["lang_pred"] for i in range(3)] == ["und"] * 3 and got[3]["lang_pred"] == "en"
    marks = spark.createDataFrame([(1, "1234 ²³ _ ½ !!")], "doc_id bigint, text string")
    assert langid.predict(marks, model).first()["lang_pred"] == "und" and langid.spans(marks, model).count() == 0
    assert langid.predict(docs.limit(0), model).count() == 0
    none = langid.learn(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(odd_docs(spark), none).collect()} == {"und"}
    kept = langid.keep_known(odd_docs(spark), model)
    assert kept.columns == odd_docs(spark).columns and kept.where("text is null or trim(text) = ''").count() == 0


def test_languages_that_were_not_learned(spark, sf_dir):
    from sparkstream.tables import load

    docs = load(spark, sf_dir, "documents").where("length(text) > 200")
    model = langid.learn(docs, ~held_out(F.col("doc_id")) & (F.col("lang") != "es"))
    held = docs.where(held_out(F.col("doc_id")))
    known, other = held.where("lang <> 'es'"), held.where("lang = 'es'")
    assert other.count() >= 5 and langid.keep_known(other, model).count() == 0
    assert langid.keep_known(known, model).count() >= 0.97 * known.count()
    rng = random.Random(6)
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(120))
    german = docs.where("lang = 'de' and not text like '%!!%'").orderBy("doc_id").first()["text"][:200]
    cyrillic = "кошка и собака бежали "
    texts = [cyrillic * 9, "日本語 中文 한국어", noise, german, german + " " + cyrillic * 20, cyrillic + german[:30]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(rows, model).collect()}
    assert got[0] == got[1] == (model.languages[0], 0.0)  # letters, but of no learned script
    assert got[3][0] == "de" and got[3][1] > 0.9 and got[4][0] == "de" and got[4][1] < 0.5
    assert [r["doc_id"] for r in langid.keep_known(rows, model).collect() if r["doc_id"] < 5] == [3]
    spans = langid.spans(rows.where("doc_id in (0, 5)"), model).collect()
    assert [(s["doc_id"], s["lang"]) for s in spans] == [(5, "de")] and spans[0]["start"] == len(cyrillic)


# ---------------------------------------------------------------- urls


def test_url_rules_against_every_rule(spark):
    rules = [
        ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
        ("c.com", "", "allow"), ("b.c.com", "/x", "block"), ("b.c.com", "/x/y", "allow"), ("net", "/es/", "allow"),
    ]
    rng = random.Random(4)
    urls = [None, "", "x", "://", "http://", "http://COM/", "https://c.com?q", "http://c.com#f", "http://.com/", "http://com./"]
    for _ in range(300):
        host = ".".join(rng.choice(["a", "b", "c", "www", "example", "COM", "com", "net"]) for _ in range(rng.randint(1, 4)))
        urls.append("http://" + host + rng.choice(["", "/", "/en/1", "/x", "/x/y/z", "/es/?a=1", "?x", "#y"]))
    urls += urls[:15]

    def want(url):
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
            host = host.lower()
        fit = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, 0, None, "allow"))
        return host, path, best[2], best[3]

    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id bigint, url string, rule string")
    table = urlrules.rule_table(spark, rules)
    for salts in (1, 5):
        got = urlrules.judge(df, table, ["page_id"], salts=salts).collect()
        assert len(got) == len(urls)
        for r in got:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == want(urls[r["page_id"]]), urls[r["page_id"]]
    none = spark.createDataFrame([], table.schema)
    assert {r["verdict"] for r in urlrules.judge(df, none, ["page_id"]).collect()} == {"allow"}
    assert urlrules.judge(df.limit(0), table, ["page_id"]).count() == 0


def test_hostile_markup_takes_linear_time():
    """Pages of a megabyte of unclosed quotes, stray end tags and deep nesting take seconds, and large numbers do not fail."""
    pages = [
        "<a '" * 250_000, "<a '" * 250_000 + ">", "<a \"'" * 200_000 + ">", "<p title='>' " * 80_000, "<a " * 300_000,
        "<div>" * 100_000 + "</section>" * 50_000, "<div><article>" * 40_000 + "</main>" * 40_000, "<!--" * 200_000, "<![CDATA[" * 100_000,
        "</" * 400_000, "<script>" * 100_000, "&" * 500_000, "&#" + "9" * 500_000 + ";", "a=" + " " * 500_000, "<p " + "a= " * 300_000 + ">",
    ]
    for page in pages:
        began = time.process_time()
        htmltext.blocks_of(page)
        assert time.process_time() - began < 8, page[:20]
    text = lambda page: " ".join(b.text for b in htmltext.blocks_of(page))
    assert text("<p title='a>b' id=\"x>y\">in</p>it's <b c=\"d'e\">out</b>") == "in it's out"
    assert text("one <b two='>three") == "one three" and text("1 < 2 and <b no end") == "1 < 2 and <b no end"
    assert text(f"&#{'9' * 5000};&#{'0' * 5000}65;&#x{'0' * 50}42;&#x1F600;&amp;") == "\ufffdAB\U0001f600&"


# ---------------------------------------------------------------- licences


def test_licences(spark):
    mit = licences.KNOWN[0][1]
    texts = {
        1: "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " , "),
        2: "prose\n  licensed under the apache Licence - version 2.0\n(c) someone\nAll rights reserved",
        3: mit + " and more",
        4: None, 5: "", 6: "All rights reserved.", 7: "license " * 30_000,
    }
    docs = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()] + [(6, texts[6], "clash")], "doc_id bigint, text string, licence string")
    got = {r["doc_id"]: tuple(r)[1:] for r in licences.scan(docs).collect()}
    assert got[1] == ("MIT", "MIT", 1)
    assert got[2] == (None, "Apache-2.0,reserved", 2)
    assert got[3] == (None, "", 0) and got[4] == (None, "", 0) and got[5] == (None, "", 0) and got[7] == (None, "", 0)
    assert got[6] == ("reserved", "reserved", 2)
    assert licences.scan(docs.limit(0)).count() == 0
    assert all(re.search(licences.KEY, t.lower()) for _, t in licences.KNOWN)
    digests = [(r["licence"], r["digest"]) for r in licences.known_table(spark).collect()]
    assert len({d for _, d in digests}) == len(digests), "no text stands for two licences"


def test_licence_texts_in_any_wrapping(spark):
    """Full texts wrapped at every width, with copyright lines of several kinds and comment marks, are still known."""
    names = ("MIT", "BSD-3-Clause", "BSD-2-Clause", "Unlicense", "Zlib", "MPL-2.0", "GPL-3.0-or-later")
    full = {name: max((t for n, t in licences.KNOWN if n == name), key=len) for name in names}
    owners = ("Copyright (c) 2020 Somebody", "Copyright 1999-2024 The Authors. All rights reserved.", "© Somebody", "(c) 2001 A. Body",
              "Copyright [yyyy] [name of owner]", "Copyright Somebody, 2011", "")
    rows, want = [], {}
    for name, text in full.items():
        for width in range(50, 100):
            lines = textwrap.wrap(text, width)
            mark = ("", "# ", " * ", "// ")[width % 4]
            want[len(rows)] = name
            rows.append((len(rows), "\n".join(mark + line for line in [owners[width % len(owners)], "", *lines])))
    got = {r["doc_id"]: r["licence"] for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == want


def test_licence_notices(spark):
    texts = [
        ("// SPDX-License-Identifier: Apache-2.0\nint x;", "Apache-2.0"), ("# spdx-license-identifier: MIT", "MIT"),
        ("This project is licensed under the BSD 3-Clause Licence", "BSD-3-Clause"), ("released under the Apache License 2.0", "Apache-2.0"),
        ("copyright notices must be kept\nCopyright holders be liable", ""), ("(c) You must retain all copyright notices", ""),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["notices"] for r in licences.scan(docs).collect()} == {i: n for i, (_, n) in enumerate(texts)}
    kept = docs.where("doc_id >= 4").select(licences.canonical(F.col("text")).alias("c")).collect()
    assert {r["c"] for r in kept} == {"copyright notices must be kept copyright holders be liable", "c you must retain all copyright notices"}


# ---------------------------------------------------------------- chat


RECORDS = {
    "prompt_response": ('{"response":"B","prompt":"A"}', [("user", "A"), ("assistant", "B")]),
    "instruction_input": ('{"instruction":"I","input":null,"output":"O"}', [("user", "I"), ("assistant", "O")]),
    "messages": ('{"messages":[{"role":"system","content":null},{"content":"x","role":"USER"}]}', [("system", ""), ("USER", "x")]),
    "system_conversations": ('{"system":"S","conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
                             [("system", "S"), ("user", "q"), ("assistant", "a")]),
    None: ('{"who":"knows"}', [(None, None)]),
}


def test_layouts_by_fingerprint(spark):
    rows = [(i, text) for i, (text, _) in enumerate(RECORDS.values())]
    df = spark.createDataFrame([*rows, (9, None)], "id bigint, raw string").withColumn("record", F.parse_json("raw"))
    got = {}
    for r in chat.canonical_turns(df, ["id"]).orderBy("id", "place").collect():
        got.setdefault(r["id"], []).append((r["layout"], r["role"], r["text"]))
    for i, (name, (_, turns)) in enumerate(RECORDS.items()):
        assert got[i] == [(name, *t) for t in turns]
    assert got[9] == [(None, None, None)]


def test_chat_round_trip(spark):
    rng = random.Random(8)
    bits = ["<", "|", "\\", ">", "im_start", "<|im_end|>", "<|im_start|>user\n", "\n", "x", "<\\|", "é"]
    said = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    roles = ["user", "assistant", "a\nb\\n", "<|im_end|>", ""]
    rows = [(i // 7, i % 7, rng.choice(roles), t) for i, t in enumerate(said)]
    df = spark.createDataFrame([*rows, (99, 0, "user", None), (None, 1, None, "null id")], "conv_id bigint, turn bigint, role string, text string")
    segments = chat.formatted(df, ["conv_id", "turn"])
    want, text = {}, {}
    for c, t, r, s in sorted(rows):
        want.setdefault(c, []).append((r, s))
    for r in segments.where("conv_id < 99").orderBy("conv_id", "turn").collect():
        text[r["conv_id"]] = text.get(r["conv_id"], "") + r["segment"]
    assert {c: chat.parse(t) for c, t in text.items()} == want
    for r in chat.digests(segments, ["turn"]).where("conv_id < 99").collect():
        turns = want[r["conv_id"]]
        loss = "".join(s for role, s in turns if role == "assistant")
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r["n_turns"], r["loss_chars"], r["formatted_chars"]) == (len(turns), len(loss), len(text[r["conv_id"]]))
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(segments, ["turn"]).count() == len(want) + 2
    assert chat.digests(segments.limit(0), ["turn"]).count() == 0


def test_roles_of_a_table_stay(spark):
    rows = [(1, 0, "human", "q"), (1, 1, "gpt", "a"), (1, 2, "Assistant", "b"), (1, 3, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = chat.canonical_turns(chat.table_records(df, ["conv_id", "turn"]), ["conv_id", "turn"])
    assert [r["role"] for r in turns.orderBy("turn").collect()] == [r[2] for r in rows]
    got = chat.digests(chat.formatted(turns, ["conv_id", "turn", "place"]), ["turn", "place"]).first()
    assert got["loss_sha256"] == hashlib.sha256(b"c").hexdigest() and got["loss_chars"] == 1
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in rows).encode()).hexdigest()


# ---------------------------------------------------------------- packing


def test_best_fit_against_a_plain_search():
    rng = random.Random(6)
    for _ in range(150):
        width = rng.randint(1, 40)
        sizes = [rng.randint(1, width) for _ in range(rng.randint(0, 60))]
        rooms, rows = [], packing.best_fit(sizes, width)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fit = min((r for r in range(len(rooms)) if rooms[r] >= sizes[i]), key=lambda r: rooms[r], default=None)
            if fit is None:
                rooms.append(width)
                fit = len(rooms) - 1
            rooms[fit] -= sizes[i]
        assert sorted(x for r in rows for x in r) == list(range(len(sizes)))
        assert sorted(sum(sizes[i] for i in r) for r in rows) == sorted(width - r for r in rooms)
    with pytest.raises(ValueError):
        packing.best_fit([5], 4)


def test_packing_loses_nothing(spark):
    ranks, end = public_tokenizers.path("byte_bpe_50k.tiktoken"), 50256
    docs = odd_docs(spark)
    packed = packing.pack(docs, ranks, end, end, width=64, window=500)
    for r in packed.collect():
        assert len(r["ids"]) == 128 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= 64
        assert r["resets"] == r["cu_seqlens"][:-1] and len(r["doc_ids"]) == len(r["parts"]) == len(r["resets"])
        places = packing.position_ids(r["cu_seqlens"], 64)
        assert [i for i in range(r["n_tokens"]) if places[i] == 0] == r["resets"]
    parts = {}
    for r in packing.unpack(packed, 64).collect():
        parts.setdefault(r["doc_id"], []).append((r["part"], bytes(r["ids"])))
    encoding = packing._encoding(ranks)
    for i, text in enumerate(ODD):
        copies = 2 if i == 3 else 1
        ids = np.frombuffer(b"".join(x for _, x in sorted(parts[i])), "<u2").tolist()
        assert ids == [*encoding.encode_ordinary(text or ""), end] * copies
    assert packing.pack(docs.limit(0), ranks, end, end).count() == 0
    assert isinstance(packed.schema["ids"].dataType, T.BinaryType)
