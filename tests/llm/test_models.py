"""Personal data, main text, token counts, secrets and language-model scores."""

import base64
import contextlib
import hashlib
import html
import math
import os
import random
import re
import threading
from collections import Counter
from itertools import product
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from offerlens.llm import lm_score, main_text, pii, secret_scan, token_counts
from offerlens.llm.crf import Crf
from offerlens.llm.queries import LLM_QUERIES
from offerlens.staging import stage_root

from .conftest import LOWER, WORD

KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    "assign": (r"(?ia:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def digits(m):
    return re.sub("[^0-9]", "", m[0])


def luhn(number):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(number))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text, kinds):
    found = [(m.start(), i, m.end(), kind) for i, kind in enumerate(kinds) for m in re.finditer(KINDS[kind][0], text) if KINDS[kind][1](m)]
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()


@pytest.mark.parametrize("module,kinds", [(pii, ("email", "ip", "card", "phone")), (secret_scan, ("assign", "access", "hex"))])
def test_fixed_patterns_on_random_strings(module, kinds):
    draw = random.Random(2)
    pieces = ["@", ".", "a.b", "x@y.z", "1.2.3.4", "+", "12", "4539148803436467", " ", "-", "(", ")", "555", "256", "token", "Password",
              "=", ":", '"', "'", "abcdef", "AKIA", "ABCDEFGHIJKLMNOPQ", "0a1b2c3d4e5f0a1b2c3d4e5f", "api_key", "é", "\n", "00", "ſecret", "7"]
    for _ in range(6000):
        text = "".join(draw.choices(pieces, k=draw.randint(1, 14)))
        assert module.base_spans(text) == plain_spans(text, kinds), text


def test_personal_data(run, odd_documents, no_documents, spark, sf_dir):
    kinds = ("email", "ip", "card", "phone")
    for docs in (odd_documents, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = run("op3_personal_data", documents=docs)
        expected = Counter()
        for r in docs.select("doc_id", "text").collect():
            spans = plain_spans(r.text or "", kinds)
            expected[(r.doc_id, *(sum(k == kind for _, _, k in spans) for kind in kinds), sha(spans))] += 1
        assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == expected
    assert run("op3_personal_data", documents=no_documents) == []


def test_context_finds_unseen_identifiers(run, spark):
    draw = random.Random(4)
    rows = [(i, f"order {draw.randrange(90)} call me on +1 ({draw.randrange(100, 999)}) 555-{draw.randrange(1000, 9999)} today") for i in range(40)]
    rows += [(100, "please call me on 640-555-0188 today"), (101, "the code 640-555-0189 is old"), (102, "call me on Monday")]
    rows.append(rows[-3])
    found = run("op3_personal_data", documents=spark.createDataFrame(rows, "doc_id long, text string"))
    by_id = {r.doc_id: r for r in found}
    assert by_id[100].spans == "phone:18:30" and by_id[100].n_phone == 0 and by_id[100].n_found == 1
    assert by_id[101].spans == "" and by_id[102].spans == "" and sum(r.doc_id == 100 for r in found) == 2
    assert all(r.spans.startswith("phone:") and r.n_phone == 1 for r in found if r.doc_id < 40)


def test_frequent_words_are_no_patterns(run, spark):
    """The word before every card is one that mostly stands before other words."""
    filler = "the house and the tree and the road and the river "
    rows = [(i, filler + f"and the 45391488034364{67 if i < 40 else 68} {'xyz'[i % 3]}{i} {filler}") for i in range(45)]
    found = run("op3_personal_data", documents=spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(r.n_card for r in found) == 40 and sum(r.n_found for r in found) == 0


def test_words_frequent_in_other_texts_are_no_patterns(run, spark):
    """The word before every phone number stands mostly in texts that hold no identifier."""
    rows = [(i, f"on +1 ({i + 100}) 555-{i + 1000}") for i in range(40)] + [(100, "on 640-555-0188")]
    found = run("op3_personal_data", documents=spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.n_found for r in found}[100] == 1
    rows += [(i, "he sat on the wall and on the roof") for i in range(200, 400)]
    found = run("op3_personal_data", documents=spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(r.n_phone for r in found) == 40 and sum(r.n_found for r in found) == 0


def test_places_are_those_of_all_texts(spark):
    texts = spark.createDataFrame([("on a wall on",), ("(On) a.",), ("",), ("wall",)] * 3, "text string")
    patterns = spark.createDataFrame([(p,) for p in ("1< on", "> wall", "1< a", "2< on a", "2< no a")], "pattern string")
    assert {r.pattern: r.there for r in pii._places_in(texts, patterns).collect()} == {"1< on": 9, "> wall": 6, "1< a": 6, "2< on a": 6}


def test_context_finds_identifiers_of_several_words(run, spark):
    rows = [(i, f"order now call me on +1 ({i + 100}) 555-{i + 1000} today") for i in range(40)]
    texts = {100: "640 555 0188", 101: "(640) 555-0188", 102: "0049 30 1234567", 103: "640.555.0188"}
    rows += [(i, f"please call me on {text} today") for i, text in texts.items()]
    rows += [(i, f'{{"id":"a{i}","phone":"+1 (640) 555-{i}","name":"x"}}') for i in range(1000, 1040)]
    rows += [(200, '{"id":"b","phone":"640-555-0188","name":"x"}')]
    rows += [(i, f"mail to user{i}@example.com now") for i in range(2000, 2040)] + [(201, f"mail to {'x' * 120}@host now")]
    spans = {r.doc_id: r.spans for r in run("op3_personal_data", documents=spark.createDataFrame(rows, "doc_id long, text string"))}
    for i, text in texts.items():
        assert spans[i] == f"phone:18:{18 + len(text)}", i
    assert spans[200] == "phone:19:31" and spans[201] == "email:8:133"


def test_candidates_are_whole_runs():
    text = "x40 640 555 0188 and 12 345 678abc or (12345678), 2019. 640 555 0188; \"k\":\"1234-5678\""
    assert {text[a:b] for a, b in pii.candidates(text, [])} >= {"640 555 0188", "12345678", "1234-5678"}
    assert [pii.candidates("1" * 300_000, [])] == [[(0, 300_000)]]


def test_graph_scores_by_hand(spark):
    edges = spark.createDataFrame(
        [(p, v, "k") for p, v in [("p", "a"), ("p", "b"), ("p", "c"), ("p", "new"), ("q", "new"), ("q", "z"), ("r", "z")]],
        "pattern string, value string, kind string",
    )
    seeds = spark.createDataFrame([(v, "k") for v in "abc"], "value string, kind string")
    patterns, values = pii.scored(edges, seeds, rounds=1)
    assert {r.pattern: round(r.score, 6) for r in patterns.collect()} == {"p": 0.6}
    assert {r.value: round(r.score, 6) for r in values.collect()} == {"a": 1, "b": 1, "c": 1, "new": 0.6}


# The conditional random field


def test_viterbi_and_marginals_by_enumeration():
    draw = np.random.default_rng(0)
    model = Crf(("x", "y", "z"), emit=np.zeros((1, 3)), move=draw.normal(size=(3, 3)), start=draw.normal(size=3))
    scores = draw.normal(size=(5, 3))

    def total(path):
        return model.start[path[0]] + sum(scores[t, k] for t, k in enumerate(path)) + sum(model.move[a, b] for a, b in zip(path, path[1:], strict=False))

    paths = list(product(range(3), repeat=5))
    assert tuple(model.decode(scores)) == max(paths, key=total)
    weights = np.exp([total(p) for p in paths])
    single, double, first = model._marginals(scores[None], np.ones((1, 5), dtype=bool))
    for t, k in product(range(5), range(3)):
        assert single[0, t, k] == pytest.approx(sum(w for w, p in zip(weights, paths, strict=True) if p[t] == k) / weights.sum())
    assert double.sum() == pytest.approx(4) and first.sum() == pytest.approx(1)
    assert model.decode(scores[:0]) == []


def test_main_text_of_the_pages(spark, sf_dir):
    """The article element's blocks; the field has to find them through its features."""
    rows = LLM_QUERIES["op4_main_text"](spark, sf_dir).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script><body><header><h1>Site</h1></header>
<div class="cookie-notice"><p>We use cookies to make this site better for everybody.</p></div><nav><ul><li><a href=/>Home</a></ul></nav>
<{tag}><h2>Title  here</h2><p>First paragraph &amp; its&nbsp;text, with <b>bold</b><br>and more.<p>Second one.
<div class="advert"><p>Buy now and pay later with this offer.</p></div><p>Third paragraph follows here.</p>
<form><label>Mail</label><input></form></{end}><aside><p>Read our other stories on this matter.</p></aside>
<section class="comments"><p>Great article, I liked it very much.</p></section><footer>&copy; 2024</footer>"""


@pytest.mark.parametrize("tag", ["article", "main", 'div id="content"', 'div class="post-body"'])
def test_main_text_of_other_layouts(spark, sf_dir, tag):
    model = main_text.fit_on(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    page = PAGE.replace("{tag}", tag).replace("{end}", tag.split()[0])
    assert main_text.main_text(page, model) == (
        "Title here\nFirst paragraph & its text, with bold and more.\nSecond one.\nThird paragraph follows here."
    )


#: Start and end of the article, none of them in the lists that the field is trained with.
LAYOUTS = {
    "bare": ("", ""), "div": ("<div>", "</div>"), "class": ('<div class="texte">', "</div>"), "id": ('<section id="lead">', "</section>"),
    "post": ('<div class="post">', "</div>"), "nested": ('<div><div class="c12">', "</div></div>"), "section": ("<section>", "</section>"),
    "cell": ("<table><tr><td>", "</td></tr></table>"), "artikel": ('<div class="artikel">', "</div>"), "center": ("<center>", "</center>"),
    "columns": ('<div class="row"><div class="col8">', "</div></div>"), "wrapper": ('<div class="wrapper"><section class="inhalt">', "</section></div>"),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_main_text_where_all_pages_have_another_layout(spark, layout):
    """Block precision and recall, with no page to learn the layout from."""
    start, end = LAYOUTS[layout]
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    told = pages.withColumn("html", F.replace(F.replace("html", F.lit("<article>"), F.lit(start)), F.lit("</article>"), F.lit(end)))
    found = {r.page_id: r.text for r in main_text.extract(told, main_text.fit_on(told)).collect()}
    hit = taken = wanted = 0
    for page_id, page in pages.select("page_id", "html").collect():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", article))
        right, own = Counter(filter(None, blocks)), Counter(filter(None, found[page_id].split("\n")))
        hit, taken, wanted = hit + sum((right & own).values()), taken + sum(own.values()), wanted + sum(right.values())
    assert hit >= 0.95 * taken and hit >= 0.95 * wanted


def test_pages_of_any_depth_and_length(run, spark):
    deep = "".join(f"<div class=c{i}>a" for i in range(50_000))
    stray = "<figure>" * 100_000 + "</p>" * 100_000 + "<article><p>One.</article>"
    long = "<article>" + "<p>Some words of a paragraph, one more time.</p>" * 25_000 + "</article>"
    frame = spark.createDataFrame([(1, "u", deep), (2, "u", stray), (3, "u", long)], "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in run("op4_main_text", pages=frame)}
    assert texts[3].count("\n") == 24_999 and texts[2] == "One." and 1 in texts


def test_training_takes_both_ends_of_labelled_pages():
    paragraphs = "".join(f"<p>Paragraph {i}.</p>" for i in range(200))
    made = main_text.training_blocks(f"<nav>Menu</nav><article>{paragraphs}</article><footer>{'End ' * 2000}</footer>")
    assert len(made) == main_text.TRAIN_BLOCKS and made[0][0] == "Menu" and made[0][3] == 0 and made[1][3] == 1
    assert len(made[-1][0]) == main_text.TRAIN_CHARS and made[-1][3] == 0
    assert main_text.training_blocks("<div><p>Nothing says where the article is.</div>") == []


@pytest.mark.parametrize("icon", ['<svg class="icon"/>', "<math/>", '<svg><path d="M0"/><g></svg>', '<svg class="a">', "<template><p>no"])
def test_icons_hide_no_text(icon):
    page = f"<body><header>{icon}</header><article><p>One <svg/>and <math><mi>a</mi><mo>=</mo>b</math> two.<p>Last.</article><svg></svg>"
    assert [text for text, _, _ in main_text.blocks(page)] == ["One and a=b two.", "Last."]


def test_text_of_buttons_and_objects_is_left_to_the_field():
    page = "<article><p>One.<button>Two</button><object>Three</object><script>no</script><select><option>no</select></article>"
    assert [text for text, _, _ in main_text.blocks(page)] == ["One.", "Two", "Three"]


def test_main_text_of_odd_pages(run, spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<article><p>cut off te"), (4, "u", "plain"), (5, "u", "<!-- never closed <p>a"),
             (6, "u", "<p>" * 3000 + "x" * 100_000), (None, "u", "<article><p>a</article>"), (3, "u", "<article><p>cut off te")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    rows = run("op4_main_text", pages=frame)
    assert len(rows) == len(pages)
    texts = {r.page_id: r.text for r in rows}
    assert texts[1] == texts[2] == texts[5] == "" and texts[3] == "cut off te"
    assert run("op4_main_text", pages=frame.where("false")) == []


def test_secrets(run, odd_documents, no_documents, spark, sf_dir):
    kinds = ("assign", "access", "hex")
    for docs in (odd_documents, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = run("op7_secret_scan", documents=docs)
        expected = Counter()
        for r in docs.select("doc_id", "text").collect():
            spans = plain_spans(r.text or "", kinds)
            expected[(r.doc_id, *(sum(k == kind for _, _, k in spans) for kind in kinds), sha(spans))] += 1
        assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == expected
    assert run("op7_secret_scan", documents=no_documents) == []


def test_secret_field_on_held_out_windows(spark, sf_dir):
    """Trained on the table's sample, judged on drawn secrets and harmless numbers it has not seen."""
    model = secret_scan.fit_on(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    draw = random.Random(77)
    found = wrong = 0
    for _ in range(200):
        key = draw.choice(secret_scan.OTHER_KEYS)
        secret = "".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789", k=draw.randint(20, 40)))
        text = f"some words before {key} {secret} and some after"
        spans = secret_scan.found_spans(text, model, secret_scan.base_spans(text)) + secret_scan.base_spans(text)
        found += any(a <= text.index(secret) and b >= text.index(secret) + len(secret) for a, b, _ in spans)
        text = f"in the year {draw.randrange(1500, 2100)} there were {draw.randrange(10**6)} of them at 10.{draw.randrange(99)}.0.1 here"
        wrong += bool(secret_scan.found_spans(text, model, []))
    assert found >= 180 and wrong <= 10


MIXED = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
#: Forms that training never shows, with the secret in braces.
PLANTED = ["glpat-{20}", "npm_{36}", "SG.{22}", "https://admin:{12}@db.example.com/x", "Server=db;Pwd={14};Database=x",
           "private_key = {40}", "Bearer {32}", "amqps://svc:{24}@queue/vhost"]
HARMLESS = ["2024-05-03T10:14:09Z", "2023-11-17 08:30:12.250", "{h8}-{h4}-{h4}-{h4}-{h12}", "v1.14.2-rc.3", "getUserByNumber", "/var/log/app/app.log.1",
            "https://www.example.com/a/481516?q=word", "report_20240503_final.pdf", "23.09.2024", "ISBN 978-3-1614-8410-0", "1,234,567.89"]


def test_planted_secrets_and_lookalikes(spark):
    """Recall of at least 0.9 and false alarms below 0.05 for every form."""
    model = secret_scan.fit_on(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    draw = random.Random(41)
    words = "over the years many people found their way to this small town near water".split()

    def around(middle):
        return f"{' '.join(draw.choices(words, k=6))} ", middle, f" {' '.join(draw.choices(words, k=6))}"

    for form in PLANTED:
        found = 0
        for _ in range(60):
            secret = "".join(draw.choices(MIXED, k=int(re.search(r"\{(\d+)\}", form)[1])))
            text = "".join(around(re.sub(r"\{\d+\}", secret, form)))
            base, at = secret_scan.base_spans(text), text.index(secret)
            found += any(a < at + len(secret) and b > at for a, b, _ in base + secret_scan.found_spans(text, model, base))
        assert found >= 54, (form, found)
    wrong = 0
    for form in HARMLESS * 20:
        shown = re.sub(r"\{h(\d+)\}", lambda m: "".join(draw.choices("0123456789abcdef", k=int(m[1]))), form)
        wrong += bool(secret_scan.found_spans("".join(around(shown)), model, []))
    assert wrong < 0.05 * 20 * len(HARMLESS)


def test_key_words_anywhere_in_long_tokens():
    token = "x" * 100_000 + "password"
    assert "key:passw" in secret_scan.features(token, [(0, len(token))], 0)[0]


def test_spans_apart_from_many_others():
    draw = random.Random(2)
    for _ in range(300):
        base = sorted((a, a + draw.randint(1, 9), "hex") for a in draw.sample(range(200), 12))
        places = sorted(draw.sample(range(200), 24))
        found = [(a, b, "secret") for a, b in zip(places[::2], places[1::2], strict=True)]
        assert secret_scan._apart(found, base) == [f for f in found if not any(f[0] < d and f[1] > c for c, d, _ in base)]


def test_secrets_without_digits_get_windows():
    for text in ("Bearer abcdefgh", "İstanbul Bearer abcdefgh", "the passphrase = abcdefgh", "ACCESS_KEY=abcdefgh", "see QwErTyUiOpAsDfGhJk here"):
        assert any(text[a:b] in ("abcdefgh", "QwErTyUiOpAsDfGhJk") for tokens in secret_scan.windows(text) for a, b in tokens), text
    assert list(secret_scan.windows("plain words and an uncharacteristically long one")) == []


# Token counts


def test_tokens_add_up_and_round_trip(run, spark, sf_dir, odd_documents, no_documents):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(token_counts.VOCABULARY).read_bytes().splitlines())}
    coding = tiktoken.Encoding("test", pat_str=token_counts.SPLIT, mergeable_ranks=ranks, special_tokens={})
    for docs in (odd_documents, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        texts = docs.select("doc_id", "text").collect()
        rows = run("op6_token_counts", documents=docs)
        totals, chars = Counter(), Counter()
        for r in rows:
            totals[r.doc_id] += r.n_tokens
            chars[r.doc_id] += r.end_char - r.start_char
        expected, lengths = Counter(), Counter()
        for r in texts:
            expected[r.doc_id] += len(coding.encode_ordinary(r.text or ""))
            lengths[r.doc_id] += len(r.text or "")
        assert {k: v for k, v in totals.items() if v} == {k: v for k, v in expected.items() if v}
        assert {k: v for k, v in chars.items() if v} == {k: v for k, v in lengths.items() if v}
        assert {r.doc_id for r in rows} == {r.doc_id for r in texts}
    assert run("op6_token_counts", documents=no_documents) == []


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution_against_brute_force(rule):
    draw = np.random.default_rng(6)
    for _ in range(300):
        ends = np.cumsum(draw.integers(1, 6, draw.integers(1, 30)))
        inner = np.unique(draw.integers(1, ends[-1] + 1, 6))
        bounds = np.concatenate(([0], inner[inner < ends[-1]], [ends[-1]]))
        expected, crossing = np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1)
        for a, b in zip(np.concatenate(([0], ends[:-1])), ends, strict=True):
            parts = np.array([max(0, min(b, hi) - max(a, lo)) for lo, hi in zip(bounds, bounds[1:], strict=False)])
            crossing += (parts > 0) & ((parts > 0).sum() > 1)
            if rule == "split":
                expected += parts / (b - a)
            else:
                expected[np.argmax(parts > 0) if rule == "start" else parts.argmax()] += 1
        shares, touched = token_counts.attribute(ends, bounds, rule)
        assert np.allclose(shares, expected) and (touched == crossing).all()


def test_unknown_rule(odd_documents):
    with pytest.raises(ValueError):
        token_counts.section_counts(odd_documents, "half")


# Language-model scores


def base_of(docs):
    tokens = [(d, WORD.findall((t or "").translate(LOWER)) + [None]) for d, t in docs]
    held = {d: crc32(str(d).encode() if d is not None else b"") % 10 == 0 for d, _ in docs}
    counts = Counter(w for d, words in tokens for w in words if not held[d])
    n, v = sum(counts.values()), len(counts)
    return Counter(
        (d, held[d], len(words), sum(counts[w] > 0 for w in words), n,
         round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), 5))
        for d, words in tokens
    )


@pytest.mark.parametrize("share", [lm_score.FREQUENT_SHARE, 64])
def test_lm_base_scores(run, spark, sf_dir, odd_documents, share, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT_SHARE", share)
    for docs in (odd_documents, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = run("op8_context_mixing", documents=docs)
        found = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)
        assert found == base_of([(r.doc_id, r.text) for r in docs.collect()])


def test_lm_beats_its_base_on_held_out_documents(spark, sf_dir):
    rows = LLM_QUERIES["op8_context_mixing"](spark, sf_dir).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(r.bits_per_byte > 0 for r in rows)


def test_lm_probabilities_add_up():
    """Over all buckets and, within each, all known words and one unknown."""
    draw = np.random.default_rng(8)
    mixer = lm_score.Mixer.untrained([draw.integers(0, 50, (size, 2)).astype(np.float32) for size in lm_score.SLOTS])
    tokens = draw.integers(0, 2**62, 4000, dtype=np.int64).view(np.uint64)
    buckets = lm_score.bucket_of(tokens)
    one_each = tokens[np.unique(buckets, return_index=True)[1]]
    assert len(one_each) == 256
    before = tokens[:2]
    total = 0.0
    for token in one_each:
        stream = np.array([*before, token])
        bits, slots = lm_score.slots_of(stream, np.array([0, 3]))
        p = mixer.predictor()(slots)
        total += np.where(bits == 1, p, 1 - p)[2].prod()
    assert total == pytest.approx(1, abs=1e-4)
    counts = np.array([5, 3, 1])
    norm = counts.sum() + lm_score.SMOOTH * (len(counts) + 1)
    assert ((counts + lm_score.SMOOTH).sum() + lm_score.SMOOTH) / norm == pytest.approx(1)


def test_lm_edges(run, no_documents, spark):
    assert run("op8_context_mixing", documents=no_documents) == []
    held = [i for i in range(100) if crc32(str(i).encode()) % 10 == 0]
    docs = spark.createDataFrame([(i, "a b c") for i in held], "doc_id long, text string")
    rows = run("op8_context_mixing", documents=docs)
    assert len(rows) == len(held) and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in rows)


def test_lm_contexts_are_exact(spark, odd_documents):
    """Counts of every context against brute force, whether it is joined or broadcast."""
    rows = [(r.doc_id, WORD.findall((r.text or "").translate(LOWER)) + [None]) for r in odd_documents.collect()]
    hashes = {}

    def hashed(words):
        text = " ".join(w for w in words if w)
        _, tokens, bounds = next(lm_score.tokens_of(pa.array([text])))
        hashes.update(zip(words, tokens.view(np.int64).tolist(), strict=True))
        return lm_score.bucket_of(tokens)

    counts, total = [Counter() for _ in range(3)], Counter()
    for doc_id, words in rows:
        held = crc32(str(doc_id).encode() if doc_id is not None else b"") % 10 == 0
        ids = ["start", "start", *words]
        for i, bucket in enumerate(hashed(words).tolist()):
            earlier, before = ids[i], ids[i + 1]
            total[(before, earlier, bucket)] += 1
            for k in range(9) if not held else ():
                for count, context in zip(counts, (before, (before, earlier), earlier), strict=True):
                    count[(context, k, bucket >> (8 - k))] += 1
    hashes["start"] = int(np.array(lm_score._START).view(np.int64))
    names = {v: k for k, v in hashes.items()}
    texts = odd_documents.selectExpr("coalesce(text, '') as text", "crc32(cast(coalesce(string(doc_id), '') as binary)) % 10 = 0 as held_out")
    found, _, n = lm_score.context_counts(texts.repartition(5))
    found = found.collect()
    assert n == sum(total.values()) and len(found) == len(total)
    for r in found:
        before, earlier = names[r.before], names[r.earlier]
        assert r.total == total[(before, earlier, r.bucket)]
        for path, count, context in zip((r.by_before, r.by_both, r.by_earlier), counts, (before, (before, earlier), earlier), strict=True):
            assert path == [count[(context, k, r.bucket >> (8 - k))] for k in range(9)]


def test_lm_learns_contexts_of_a_large_vocabulary(run, spark):
    """Every second word follows from the one before; there are more contexts than any table of fixed size would hold."""
    draw = random.Random(3)
    pairs = [f"a{i} b{draw.randrange(30_000)}" for i in range(30_000)]
    rows = [(i, " ".join(draw.choices(pairs, k=300))) for i in range(600)]
    scores = [r for r in run("op8_context_mixing", documents=spark.createDataFrame(rows, "doc_id long, text string")) if r.held_out]
    gain = sum(r.score - r.base_score for r in scores) / sum(r.n_tokens for r in scores)
    assert gain > 0.9


def test_lm_learns_from_every_training_token(spark):
    """No document or token is left out: more documents, and a longer one, than any sample of fixed size."""
    draw = random.Random(9)
    rows = [(False, " ".join(draw.choices("abcdefgh", k=40))) for _ in range(400)] + [(True, "a b c " * 50)]
    rows.append((False, " ".join(draw.choices("stuvwxyz", k=160_000))))
    texts = spark.createDataFrame(rows, "held_out boolean, text string").repartition(6)
    triples, none, _ = lm_score.context_counts(texts)
    mixer = lm_score.Mixer.untrained([none])
    n = sum(len(text.split()) + 1 for held, text in rows if not held)
    seen = lm_score._summed(triples, (*mixer.refined.shape, 2), mixer.outcomes)
    assert seen[..., 0].sum() == pytest.approx(8 * n) and none[1].sum() == n
    slopes = lm_score._summed(triples, (*mixer.weights.shape, 5), mixer.slopes)
    whole = np.zeros_like(slopes)
    for r in triples.where("train > 0").collect():
        paths = [np.array([p], dtype=np.float32) for p in (r.by_before, r.by_both, r.by_earlier)]
        whole += mixer.slopes(np.array([r.bucket]), paths, np.array([float(r.train)]))
    assert np.allclose(slopes, whole, rtol=1e-4, atol=1e-2)
    learnt = lm_score.learn(triples, none)
    after = lm_score._summed(triples, (*mixer.weights.shape, 5), learnt.slopes)
    pull = after[:, :, 0] - lm_score.RIDGE * (learnt.weights - 0.3)
    assert np.abs(pull).max() < 1e-2 * np.abs(slopes[:, :, 0]).max()


def test_lm_needs_few_bytes_of_disk_a_token(run, spark):
    """Shuffle files and staged tables of any moment; rows for each triple and its counts took several times as much."""
    draw = random.Random(4)
    vocabulary, weights = [f"w{i}" for i in range(5000)], [1 / (i + 2) for i in range(5000)]
    docs = spark.createDataFrame([(i, " ".join(draw.choices(vocabulary, weights, k=1000))) for i in range(500)], "doc_id long, text string")
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [*local, stage_root(spark).removeprefix("file:")]

    def used():
        total = 0
        for folder in folders:
            for path, _, names in os.walk(folder):
                for name in names:
                    with contextlib.suppress(OSError):  # a file may go meanwhile
                        total += os.stat(f"{path}/{name}").st_size
        return total

    before, seen, done = used(), [0], threading.Event()

    def watch():
        while not done.wait(0.02):
            seen.append(used())

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert len(run("op8_context_mixing", documents=docs)) == 500
    finally:
        done.set()
        watcher.join()
    assert max(seen) - before < 25 * 500 * 1001
