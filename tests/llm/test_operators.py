"""Training-data operators against brute force, exact round trips, held-out
accuracy and awkward inputs (nulls, empty texts, repeated rows, clashing
column names, empty tables)."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm_brute import brute_links
from tidecast.llm import (bpe_automaton, exact_dedup, html_extract, langid, license_scan, ngram_join, packing, quality_lines,
                          queries, textvec, toxicity, wordpiece_count)

SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, kept string, key string, size string, bucket string, n_words string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def local(docs):
    return [(r.doc_id, r.text, r.lang) for r in docs.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"word{i % 977}x{i}" for i in range(60_000)) + "."
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty."
    rows = [(1, None, None), (2, "", "en"), (3, " \t\n", "en"), (4, base, "en"), (4, base, "en"), (5, base.replace(" ", "  "), "en"),
            (None, base, "en"), (None, None, None), (6, "12 34 !!", "en"), (7, long, "en"), (8, "two", "fr"), (9, "two", None), (10, "le la les des une", "fr")]
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# -- exact dedup -------------------------------------------------------------

def test_filters_are_lossless_and_merge():
    rng = np.random.default_rng(5)
    parts, want = [], defaultdict(int)
    for _ in range(4):
        keys, counts = np.unique(rng.integers(0, 1 << 54, 900).astype(np.uint64) // np.uint64(3 << 40), return_counts=True)
        counts = counts * rng.integers(1, 70_000, len(counts))
        decoded = exact_dedup.cqf_decode(exact_dedup.cqf_encode(keys, counts, 54), 54)
        assert (decoded[0] == keys).all() and (decoded[1] == counts).all()
        parts.append(decoded)
        for k, c in zip(keys.tolist(), counts.tolist()):
            want[k] += c
    keys, counts = exact_dedup.cqf_merge(parts)
    assert dict(zip(keys.tolist(), counts.tolist())) == want


def test_exact_groups_odd_rows(odd, nothing):
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(odd).collect()), key=str)
    want = sorted([(1, 1, 3, True), (2, 1, 3, False), (None, 1, 3, False), (3, 3, 1, True), (4, 4, 4, True), (4, 4, 4, False), (5, 4, 4, False),
                   (None, 4, 4, False), (6, 6, 1, True), (7, 7, 1, True), (8, 8, 2, True), (9, 8, 2, False), (10, 10, 1, True)], key=str)
    assert got == want
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert sorted(str(r.doc_id) for r in exact_dedup.drop_exact_copies(odd).collect()) == sorted(["1", "3", "4", "6", "7", "8", "10"])


# -- n-gram join ---------------------------------------------------------------

@pytest.mark.parametrize("chunk", [512, 3])
def test_ngram_links_match_brute_force(spark, local, chunk):
    rng = random.Random(2)
    rows = sorted((i, t) for i, t, _ in local[:250])
    words = rows[0][1].split()[:120]
    for k in range(40):  # a group of many different near copies: several chunks
        copy = list(words)
        copy[rng.randrange(len(copy))] = f"new{k}"
        rows.append((10_000 + k, " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_links(frame, chunk=chunk).collect())
    assert got == sorted(brute_links(rows))


def test_ngram_links_odd_rows(odd, nothing):
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_links(odd).collect()), key=str)
    assert got == sorted([(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 2), (4, 4, 2), (5, 4, 2), (None, None, 0), (None, None, 0),
                          (6, 6, 0), (7, 7, 0), (8, 8, 1), (9, 8, 1), (10, 10, 0)], key=str)
    assert ngram_join.ngram_links(nothing).count() == 0


def test_near_copies_go_by_row(spark):
    words = {k: [f"{k}{i}" for i in range(60)] for k in "abcd"}
    text = lambda k, *changes: " ".join(f"new{i}" if i in changes else w for i, w in enumerate(words[k]))
    rows = [(1, text("a")), (1, text("a")), (2, text("a", 59)), (2, text("b")), (None, text("a", 0)), (None, text("a", 1)),
            (7, text("c")), (7, text("c", 59)), (None, text("d")), (None, text("d", 59)), (None, text("d", 0)), (None, None), (5, ""), (5, ""), (5, " \n")]
    left = ngram_join.drop_near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    kinds = sorted((str(r.doc_id), (r.text or "").split(" ")[-1][:1].strip() and (r.text.split()[1][0])) for r in left)
    assert kinds == sorted([("1", "a"), ("2", "b"), ("7", "c"), ("None", "d"), ("None", ""), ("5", ""), ("5", ""), ("5", "")])


def test_band_choice_reaches_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999


# -- BPE ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def coders():
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.vocabulary("word_bpe_49k.json")
    theirs = tokenizers.Tokenizer.from_file(path)
    theirs.no_truncation()
    theirs.no_padding()
    return bpe_automaton.BpeAutomaton(path), theirs


def library(theirs, text):
    ids = theirs.encode(text, add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), theirs.decode(ids, skip_special_tokens=False)


def test_bpe_equals_the_library(coders, local):
    mine, theirs = coders
    rng = random.Random(9)
    texts = [t for _, t, _ in local[:150]] + ["", " ", "<|endoftext|>a<|startoftext|> b", "ΑΣΣ Σ İi don't we'll", "a" * 5000, "日本語 テキスト ́é", "x\x1cy\x85z"]
    texts += ["".join(rng.choice("aaabehinorst' ") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    for text in texts:
        out = mine.encode(text)
        assert out == library(theirs, text), text[:60]
        assert mine.decode([int(i) for i in out[1].split()]) == out[2]


def test_bpe_rows(odd, nothing):
    path = queries.vocabulary("word_bpe_49k.json")
    rows = bpe_automaton.bpe_codes(odd, path, keep_tokens=True).collect()
    assert len(rows) == odd.count() and bpe_automaton.bpe_codes(nothing, path).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r.ids_sha256 == empty and r.n_tokens == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert all(hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() == r.ids_sha256 for r in rows)


# -- quality, language, toxicity -------------------------------------------------

def test_repeated_words_match_brute_force(local):
    for _, text, _ in local[:200] + [(0, "a b c d e f g h " * 3, ""), (0, "a " * 30, "")]:
        w = text.split()
        seen = defaultdict(list)
        for i in range(len(w) - 7):
            seen[tuple(w[i:i + 8])].append(i)
        want = len({p for v in seen.values() if len(v) > 1 for i in v for p in range(i, i + 8)})
        assert quality_lines.repeated_words([text.encode()])[0] == want


def test_quality_odd_rows(odd, nothing):
    rows = {r.doc_id: r for r in quality_lines.quality_verdicts(odd).collect() if r.doc_id is not None}
    assert rows[1].base_failed and not rows[3].kept and rows[4].kept and rows[7].kept and rows[7].n_words == 60_000
    assert quality_lines.quality_verdicts(odd).count() == odd.count() and quality_lines.keep_good(nothing).count() == 0
    assert quality_lines.keep_good(odd).columns == odd.columns
    assert "Home | About" not in quality_lines.clean("A good line.\nHome | About | Contact\nbare words without an end")[0]


def test_language_on_held_out(spark):
    rows = queries.op1_language(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97


def test_marginals_match_enumeration():
    rng = np.random.default_rng(3)
    emit, moves, start, lengths = rng.random((9, 3)) + 0.1, rng.random((3, 3)) + 0.1, rng.random(3) + 0.1, np.array([5, 1, 3])
    got, at = langid.forward_backward(emit.copy(), moves, start, lengths), 0
    pairs = np.zeros((3, 3))
    for n in lengths:
        want, mass = np.zeros((n, 3)), 0.0
        for path in itertools.product(range(3), repeat=int(n)):
            p = start[path[0]] * np.prod([emit[at + t, s] for t, s in enumerate(path)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:])])
            mass += p
            for t, s in enumerate(path):
                want[t, s] += p
        assert np.allclose(got[at:at + n], want / mass)
        at += n
    one = langid._expected_pairs(emit[:5], moves, start, np.array([5]))
    assert np.isclose(one.sum(), 4) and pairs.sum() == 0


def test_code_switched_words_get_their_language(local):
    train = [r for r in local if zlib.crc32(str(r[0]).encode()) % 4 != 2][:300]
    tagger = langid.Tagger(langid.fit([r[1] for r in train], [r[2] for r in train]))
    text = {lang: next(t for i, t, k in local if k == lang and len(t) > 900 and zlib.crc32(str(i).encode()) % 4 == 2) for lang in ("en", "fr")}
    mixed = text["en"].split()[:40] + text["fr"].split()[:40]
    spans = tagger.spans(" ".join(mixed))
    label = [lang for a, b, lang in spans for _ in range(b - a)]
    assert np.mean([x == ("en" if i < 40 else "fr") for i, x in enumerate(label)]) > 0.85


def test_language_and_toxicity_odd_rows(odd, nothing, spark):
    model = langid.train(odd)
    rows = {r.doc_id: r for r in langid.tag_languages(odd, model, with_spans=True).collect()}
    assert {rows[i].lang_pred for i in (1, 2, 3, 6)} == {"und"} and rows[10].lang_pred in ("en", "fr")
    assert langid.train(nothing) == {"labels": []} and langid.keep_identified(nothing, model).count() == 0
    assert {r.lang_pred for r in langid.tag_languages(odd, {"labels": []}).collect()} == {"und"}
    labels = spark.createDataFrame([(4, 1), (8, 0), (None, 1), (9, None)], "doc_id bigint, toxic int")
    for known in (labels, labels.where("toxic = 0"), labels.limit(0)):
        scored = toxicity.score_toxicity(odd, toxicity.train(odd, known)).collect()
        assert len(scored) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_texts_stay_without_a_language_model(odd, docs):
    kept = langid.keep_identified(odd, langid.train(odd.where("lang is null")), min_score=0.0).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["4", "4", "5", "None", "7", "8", "9", "10"])
    assert len(langid.train(docs, max_docs=2)["labels"]) == 2  # the bound on rows


def test_toxicity_fit_is_the_least_loss():
    rng = np.random.default_rng(3)
    x = rng.random((60, 25)) < 0.3
    x[7] = False  # a row without features
    y, value, ridge = (rng.random(60) < 0.4).astype(float), rng.normal(size=25) * 2, 1e-2
    w, bias = toxicity.solve(np.concatenate([np.flatnonzero(r) for r in x]), x.sum(axis=1), value, y, ridge)
    dense = x * value
    loss = lambda w, b: np.mean(np.logaddexp(0, dense @ w + b) - y * (dense @ w + b)) + ridge / 2 * (w @ w)
    slow, at = np.zeros(25), 0.0
    for _ in range(20_000):  # plain gradient descent on the dense matrix
        error = 1 / (1 + np.exp(-(dense @ slow + at))) - y
        slow, at = slow - 0.1 * (dense.T @ error / 60 + ridge * slow), at - 0.1 * error.mean()
    assert abs(loss(w, bias) - loss(slow, at)) < 1e-5 and np.abs(w - slow).max() < 0.02


def test_toxicity_on_held_out(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = [r for r in queries.op7_toxicity(spark, SMALL).join(labels, "doc_id").collect() if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93


# -- HTML, packing, licences, pieces --------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a='</p>x';</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href=x>Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title &amp; more</h1><p>First <b>bold</b>
 text.<p>Second&nbsp;one, with <a href=y>a link</a>.<aside>Side</aside><p>Third.</p><div class="ad">Buy</div></article>
<form><input name=q>Search</form><div id="comments"><p>Nice article</p></div><footer>&copy; us</footer></body></html>"""


def test_html_rules(spark):
    assert html_extract.main_text(PAGE) == "Title & more\nFirst bold text.\nSecond one, with a link.\nThird."
    prose = "The cat is on the mat and it was a very nice day for all of the people who were there, and that is what we have to say about it. " * 2
    page = f"<body><div><a href=1>Home</a> <a href=2>News</a></div><p>{prose}</p><p>Short one.</p><p>{prose}</p><p><a href=3>Imprint</a></p></body>"
    assert html_extract.main_text(page) == f"{prose.strip()}\nShort one.\n{prose.strip()}"
    frame = spark.createDataFrame([(1, "u", None, "x"), (1, None, "", "x"), (None, "u", PAGE, "x"), (2, "u", "<p><b>x", "x"), (3, "u", "<<<>&am", "x")], "page_id bigint, url string, html string, text string")
    rows = html_extract.extract_pages(frame).collect()
    assert len(rows) == 5 and all(r.n_chars == len(r.text) for r in rows) and html_extract.extract_pages(frame.limit(0)).count() == 0


def test_html_article_is_a_prior_only():
    prose = "The cat is on the mat and it was a very nice day for all of the people who were there, and that is what we have to say about it. " * 2
    links = "".join(f"<li><a href={i}>Another headline about shoes and hats number {i} of this series, with more words</a> 3 Jan</li>" for i in range(3))
    page = (f"<article><h2>Teaser</h2><p>A lead.</p></article><div><p>{prose}</p><p>Short one.</p><p>{prose}</p></div><p>Last updated</p>"
            f"<article><h2>Next</h2><p>{prose}</p><ul class=x>{links}</ul></article><p>Call us</p>")
    assert html_extract.main_text(page) == "\n".join(["Teaser", "A lead.", prose.strip(), "Short one.", prose.strip(), "Next", prose.strip()])


@pytest.mark.parametrize("start, end", [
    ('<div class="content-sidebar-wrap">', "</div>"), ('<div class="has-sidebar no-comments">', "</div>"), ("<form action=/>", "</form>"),
    ('<form action=/><div class="content-sidebar-wrap">', "</div></form>"), ('<div class="page search">', "</div>"),
    ('<div class="widget"><article>', "</article></div>"), ("<aside><main>", "</main></aside>")])
def test_html_hinted_container_round_the_page(start, end):
    prose = "The cat is on the mat and it was a very nice day for all of the people who were there, and that is what we have to say about it. " * 4
    side = "The shop is open on all of the days of the week, and it is in the centre of the town. " * 6
    page = (f'<html><head><title>No</title><meta name=x><body><div class="sidebar">{side}</div>{start}<p>{prose}</p><p>{prose}</p><div class="ad">Buy</div>'
            f'<p>{prose}</p>{end}<div id="comments"><article class="comment">{side}</article></div><footer>&copy; us</footer></body></html>')
    assert html_extract.main_text(page) == "\n".join([prose.strip()] * 3)


@pytest.mark.parametrize("lang, prose", [
    ("", "यह एक बहुत लंबा वाक्य है जिसमें कोई अंग्रेज़ी शब्द नहीं है और जो केवल पाठ की लंबाई से पहचाना जाना चाहिए। "),
    ("pl", "Kot siedzi na dywanie, a wszyscy ludzie przyszli zobaczyć, jak wygląda jego nowy dom nad rzeką. "),
    ("", "Kissa istuu matolla ja kaikki ihmiset tulivat katsomaan, miltä sen uusi koti joen rannalla näyttää. ")])
def test_html_language_without_stop_list(lang, prose):
    long = (prose * 4).strip()
    links = "".join(f"<li><a href={i}>{prose}</a></li>" for i in range(3))
    page = f"<html lang='{lang}'><body><ul>{links}</ul><p>{long}</p><p>{prose}</p><p>{long}</p><p><a href=1>x</a></p></body></html>"
    assert html_extract.main_text(page) == "\n".join([long, prose.strip(), long])
    keywords = "shoes hats coats shirts socks scarves gloves belts wallets watches rings " * 4
    assert html_extract.main_text(f"<html lang=en-GB><body><p>{keywords}</p></body></html>") == ""


def test_buckets_are_optimal():
    rng = np.random.default_rng(1)
    for _ in range(20):
        h = rng.integers(0, 4, 14)
        h[0] = 0
        lengths = np.flatnonzero(h)
        pad = lambda ends: sum(h[x] * (min(e for e in ends if e >= x) - x) for x in lengths)
        for k in (1, 2, 4):
            ends = packing.optimal_buckets(h, k)
            best = min(pad([*c, lengths[-1]]) for r in range(k) for c in itertools.combinations(lengths[:-1], r))
            assert len(ends) <= k and pad(ends) == best


def test_packing_keeps_every_token(odd, nothing, docs):
    for frame, options in ((odd, {}), (docs, {"slice_rows": 40, "context": 256, "budget": 1024})):
        rows = packing.pack(frame, **options).collect()
        want = sum(len((r.text or "").encode().split()) for r in frame.collect())
        assert sum(r.n_tokens for r in rows) == want
        places = {(r.bucket, r.batch_id, r.slot) for r in rows}
        assert len(places) == len(rows) and all(r.n_tokens <= r.bucket_len and r.slot < r.batch_size for r in rows)
        budget = options.get("budget", packing.BUDGET)
        assert all(r.batch_size * r.bucket_len <= budget for r in rows)
        for bucket in {r.bucket for r in rows}:  # all batches but the last are full
            own = [r for r in rows if r.bucket == bucket]
            assert max(r.batch_id for r in own) == (len(own) - 1) // own[0].batch_size
    assert packing.pack(nothing).count() == 0


def test_license_scan_finds_planted_notices(spark, docs, local, odd):
    notices = re.compile("|".join(re.escape(license_scan.TEMPLATES[k].rstrip(".")) for k in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT")))
    want = sorted((i, m.start(), m.end()) for i, t, _ in local for m in notices.finditer(t))
    assert sorted((r.doc_id, r.first_char, r.end_char) for r in license_scan.license_matches(docs).collect()) == want
    index = license_scan.TemplateIndex(license_scan.TEMPLATES)
    edited = license_scan.TEMPLATES["MIT-text"].replace("without restriction", "with no limits").replace("publish, ", "")
    found = list(license_scan.scan_texts(["é. " + edited + " End.", None, ""], index))
    assert [f[1] for f in found] == ["MIT-text"] and 0.9 < found[0][2] < 1 and found[0][4] == 3
    assert license_scan.license_matches(odd).count() == 0


def test_license_scan_finds_every_occurrence():
    index = license_scan.TemplateIndex(license_scan.TEMPLATES)
    short = license_scan.TEMPLATES["MIT"]
    spans = lambda text: [(f[1], text[f[4]:f[5]]) for f in license_scan.scan_texts([text], index)]
    assert spans(f"{short} {short}") == [("MIT", short[:-1])] * 2
    names = ["left-pad", "numpy", "a", "some package", "tool", "x y z", "last"]
    listed = "\n".join(f"{n} {short}" for n in names)
    assert spans(listed) == [("MIT", short[:-1])] * len(names)
    whole = license_scan.TEMPLATES["GPL-3.0"]
    edited = whole.replace("licensed", "released")[:-1]
    assert spans(f"{edited}. {whole} {edited}") == [("GPL-3.0", x) for x in (edited, whole[:-1], edited)]
    words = license_scan.TEMPLATES["MIT-text"].split()
    third = len(words) // 3  # seven words put in twice: the middle diagonal alone reaches both
    text = " ".join(words[:third] + ["added"] * 7 + words[third:2 * third] + ["added"] * 7 + words[2 * third:])
    assert [(f[1], f[2]) for f in license_scan.scan_texts([text], index)] == [("MIT-text", 1.0)]


def test_license_templates_are_told_apart():
    index = license_scan.TemplateIndex(license_scan.TEMPLATES)
    inside = {"Apache-2.0-header": {"Apache-2.0"}, "MIT-full-text": {"MIT-text"}}
    for name, text in license_scan.TEMPLATES.items():
        found = {f[1]: f[2] for f in license_scan.scan_texts([f"Some words before. {text} Words after."], index)}
        assert found.pop(name) == 1 and set(found) == inside.get(name, set()), (name, found)
    assert {"LGPL-3.0-header", "AGPL-3.0-header", "ISC-text", "CC0-1.0", "EPL-2.0", "Unlicense-text", "BSD-3-Clause-text"} <= set(index.names)


def test_piece_counts_match_greedy_search(docs, local, odd, nothing):
    path = queries.vocabulary("byte_bpe_50k.json")
    rng = random.Random(4)
    pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(40)]
    heads, tails = set(pieces[:20]), set(pieces[20:])
    automaton = wordpiece_count.LongestMatch(sorted(heads), sorted(tails))

    def greedy(word):
        n, i, own = 0, 0, heads
        while i < len(word):
            j = next((j for j in range(len(word), i, -1) if word[i:j] in own), None)
            if j is None:
                return 1
            i, n, own = j, n + 1, tails
        return n

    for _ in range(3000):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
        assert automaton.count(word) == greedy(word), word
    rows = wordpiece_count.piece_counts(odd, path).collect()
    assert len(rows) == odd.count() and wordpiece_count.piece_counts(nothing, path).count() == 0
    assert all(r.n_pieces >= r.n_words for r in wordpiece_count.piece_counts(docs, path).collect())


def test_word_hashes_tell_words_apart(local):
    seen = {}
    for _, text, _ in local[:50]:
        w = textvec.words([text.encode()])
        for h, word in zip(w.hashes.tolist(), text.encode().split()):
            assert seen.setdefault(h, word) == word


# -- hostile pages -----------------------------------------------------------

HOSTILE = {
    "quotes": "<a " + '"' * 1_000_000, "open tags": "<a " * 330_000, "open quotes": "<a '\"" * 200_000, "scripts": "<script " * 120_000,
    "roots": "<html " * 170_000, "deep": "<div>x" * 170_000, "stray ends": "<div>" * 100_000 + "</p>" * 120_000,
    "links and paragraphs": "<a>" * 150_000 + "<p>" * 150_000, "long name": '<div class="' + "advert_" * 140_000 + '">x',
    "marks": "<!" * 500_000, "values": '<a x="' * 160_000, "names": ('<div class="ad wrap">' + "word " * 15) * 10_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_take_linear_time(name):
    import time
    before = time.process_time()
    html_extract.main_text(HOSTILE[name])
    assert time.process_time() - before < 15  # seconds for a megabyte; a quadratic scan takes hours


def test_tags_without_end_leave_the_text_after_them():
    prose = "This is the text of the page that we want to have and it is long enough to be taken for prose by all of the rules. " * 3
    for tag in ("<a ", "<a href='x", '<p class="a" "', "<b x=1"):
        assert prose.strip() in html_extract.main_text(f"<article><p>{prose}</p>{tag}<p>{prose}</p></article>")
    assert html_extract.main_text(f'<article><p title="a > b">{prose}</p></article>') == prose.strip()
    assert html_extract.main_text(f"<article><script>if (a < b) {{}}</SCRIPT ><p>{prose}</p><style>p{{}}") == prose.strip()


def test_every_code_point_is_coded_as_the_library_does():
    """Each code point inside a word, decomposed, and marks in both orders."""
    import unicodedata
    from tokenizers import Tokenizer
    path = queries.vocabulary("word_bpe_49k.json")
    library, coder = Tokenizer.from_file(path), bpe_automaton.automaton(path)
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}b " for c in points[i:i + 500]) for i in range(0, len(points), 500)]
    loose = [unicodedata.normalize("NFD", c) for c in points if unicodedata.normalize("NFD", c) != c]
    marks = [c for c in points if unicodedata.combining(c)]
    texts += [" ".join(loose[i:i + 500]) for i in range(0, len(loose), 500)]
    texts += [" ".join(f"q{c}̣ q́{c} a{c}́" for c in marks[i:i + 100]) for i in range(0, len(marks), 100)]
    for text in texts:
        assert coder.encode(text)[1] == " ".join(map(str, library.encode(text, add_special_tokens=False).ids)), text[:60]


def test_texts_without_a_letter_are_undetermined(spark):
    rows = [(i, t, None) for i, t in enumerate(["½ ² ①", "², 3²", "Ⅷ", "12 _ !", "٣", "", "²le²", "ª"])]
    rows += [(None, f"the house of the king and the {w}", "en") for w in ("sea", "land", "sky", "sun")] * 3
    rows += [(None, f"la maison du roi et la {w}", "fr") for w in ("mer", "terre", "lune", "nuit")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(docs)
    assert sorted(model["labels"]) == ["en", "fr"]  # null ids are learned from
    got = {r.doc_id: r.lang_pred for r in langid.tag_languages(docs.where("doc_id is not null"), model).collect()}
    assert [got[i] == "und" for i in range(8)] == [True] * 6 + [False] * 2


def test_many_languages_are_all_learned(spark):
    rows = [(i, f"w{i % 260}x w{i % 260}y common w{i % 260}z", f"l{i % 260:03}") for i in range(520)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert len(langid.train(docs)["labels"]) == 260


# -- quality rules of other scripts, wrapped lines, phrases ------------------

def quality_cases():
    hindi = "यह एक अच्छा और साफ़ पाठ है जिसमें कई शब्द हैं।\n" * 1 + "दूसरा वाक्य भी साफ़ है और उसमें भी कई शब्द हैं जो पढ़े जा सकते हैं।\nतीसरी पंक्ति भी यहाँ है।"
    chinese = "\n".join(f"这是 第{i}个 很好 的 句子 它有 一些 词。" for i in range(8))
    urdu = "\n".join(f"یہ ایک صاف جملہ {i} ہے جو{i} پڑھا جا{i} سکتا ہے۔" for i in range(6))
    wrapped = ("The first sentence of this text was wrapped by hand\nin the middle of its words, as old mail programs did\n"
               "with everything that was longer than the screen. The\nsecond one goes on like that and then comes to an end.")
    phrase = "This page is about rivers and lakes in the far north of the country, and about the people there. Click here to read. " \
             "The water is cold in spring and the ice goes late in most years, as everybody knows well."
    menu = "\n".join(["home about contact imprint help", "shop cart order login profile", "news sport weather travel food"] * 3)
    return {"hindi": (hindi, True), "chinese": (chinese, True), "urdu": (urdu, True), "wrapped": (wrapped, True), "phrase": (phrase, True),
            "menu": (menu, False), "code": ("\n".join(f"function f{i}() {{ return x{i} ; }} end of code line" for i in range(9)), False),
            "null": (None, False), "empty": ("", False), "blanks": (" \n\t\n", False)}


def test_quality_keeps_clean_prose_of_any_script(spark):
    import duckdb
    import pyarrow as pa
    cases = quality_cases()
    rng = random.Random(8)
    lines = [line for text, _ in cases.values() if text for line in text.split("\n")] + ["", "  ", "Ends here.", "goes on", "{x}", "lorem ipsum.", "A. javascript b. C!"]
    texts = [t for t, _ in cases.values()] + ["\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 12))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, quality_lines.quality_verdicts(docs).collect()))
    assert {name: got[i][-1] for i, name in enumerate(cases)} == {name: kept for name, (_, kept) in cases.items()}
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": pa.array(texts, pa.string())}))
    cols = [f.split()[0] for f in quality_lines.SCHEMA.split(", ")]
    assert got == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({queries.SQL['op8_quality']})").fetchall())


def test_a_phrase_costs_its_sentence_only():
    text, words, lost, _ = quality_lines.clean("Good words here. Click here now. More good words.\nread more.")
    assert (words, lost) == (11, 5) and text == "Good words here. More good words."
