"""Cases where an operator once did less than its whole job."""

import random

import numpy as np
import pyarrow as pa

from tabularium.llm import decontam, htmltext, pii
from tabularium.llm.words import split_words


def spans_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["spans"] for r in sorted(pii.find_personal_data(docs).collect(), key=lambda r: r["doc_id"])]


# ---- personal data ----


def test_op1_trusted_instances_induce_patterns(spark):
    """ids behind the seeds' pattern lead to a pattern without seeds, its ids to a third, and so on."""
    labels = ["member account:", "cust no.", "file ref", "case key"]
    texts = [f"w{i} member account: u{i}@mail.example.org bye" for i in range(40)]
    chain = []
    for k, label in enumerate(labels):
        own = [f"K{k}0000{i}77" for i in range(4)]
        texts += [f"x {label} {v} y" for v in own + chain]
        texts += [f"x {label} {v} y" for v in chain for _ in range(12)]
        chain = own
    got = spans_of(spark, [*texts, "the number 98765432 alone"])
    assert all("id:" in s for s in got[40:-1]) and got[-1] == ""


def test_op1_glued_keys_quotes_and_brackets(spark):
    texts = [f'w{i} account: u{i}@mail.example.org and id="v{i}@mail.example.org" bye' for i in range(40)]
    forms = ["x account: (AB1234567) y", 'x account: "AB1234568" y', "x account:AB1234569 y", "x id=AB1234560 y", "x id='AB1234561' y"]
    got = spans_of(spark, [*texts, *forms])
    for text, spans in zip(forms, got[40:]):
        at = text.index("AB")
        assert spans == f"id:{at}:{at + 9}"


def test_op1_contexts_are_words_that_are_counted():
    """Both tokenisations agree, and no context occurs less often than instances follow it."""
    rng = random.Random(4)
    bits = ["ab", "é", "id=", '"', "(", ")", ": ", " ", "\n", "no.", "+4930123456", "x@y.zz", "1.2.3.4", "AB1234567", "-", ".", "%", "_", "|", "mailto:"]
    column = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    want = [[pii._lower(w) for w in pii._WORD.findall(t)] for t in column]
    words = split_words(pii.context_words(pa.array(column)), lower=True)
    assert np.diff(words.cuts).tolist() == list(map(len, want))
    for text, own in zip(column, want):
        followed = {}
        for *_, patterns in pii.instances(text, pii.base_spans(text)):
            for p in patterns:
                followed[tuple(p)] = followed.get(tuple(p), 0) + 1
        for p, n in followed.items():
            p = p[1:] if p[0] == pii.AFTER else p
            assert n <= sum(tuple(own[k : k + len(p)]) == p for k in range(len(own)))


def brute_ids(texts):
    """The pattern-instance graph in plain dictionaries: values trusted in the end."""
    edges, seeds, shapes, base = {}, set(), {}, set()
    for t in texts:
        for _, _, v, is_base, seed, patterns in pii.instances(t, pii.base_spans(t)):
            shapes[v] = pii.shape(v)
            seeds |= {v} if seed else set()
            base |= {v} if is_base else set()
            for p in map(tuple, patterns):
                edges.setdefault(p, {}).setdefault(v, 0)
                edges[p][v] += 1
    words = [[pii._lower(w) for w in pii._WORD.findall(t)] for t in texts]
    total = lambda p: sum(tuple(w[k : k + len(p)]) == p for w in words for k in range(len(w)))
    trusted, totals = set(), {}
    while True:
        score = {}
        for p, values in edges.items():
            if len(values) < 3 or all(v in base for v in values):
                continue
            ours = [v for v in values if v in seeds or v in trusted]
            shaped = [v for v in values if shapes[v] == 1]
            if len(ours) < 3 and len(shaped) < 10:
                continue
            n = totals.setdefault(p, total(p[1:] if p[0] == pii.AFTER else p))
            alone = sum(values[v] for v in shaped) / n
            c = max(sum(values[v] for v in ours) / n if len(ours) >= 3 else 0, alone if len(shaped) >= 10 and alone >= 0.9 else 0)
            for v in values if c >= 0.3 else ():
                if v not in base:
                    score[v] = 1 - (1 - score.get(v, 0.0)) * max(1e-9, 1 - c)
        now = {v for v, x in score.items() if x * shapes[v] >= 0.8}
        if len(now) <= len(trusted):
            return now
        trusted = now


def planted(rng):
    """Texts with identifiers of unseen form behind labels, the spans of these, and decoys."""
    word = lambda: "".join(rng.choice("abcdehinorst") for _ in range(rng.randint(2, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    forms = {
        "member account: %s,": lambda: rng.choice([f"u{rng.randint(0, 9999)}@mail.example.org", f"AB{rng.randint(10**6, 10**7)}"]),
        'token = "%s"': lambda: "a1b2" + hexa(36),
        "reachable as %s now": lambda: rng.choice([f"+49 30 {rng.randint(10**5, 10**6)}", f"max_{word()}{rng.randint(0, 99)}"]),
        "<serial>%s</serial>": lambda: f"{rng.randint(10**7, 10**8)}",
    }
    texts, spans = [], []
    for k in range(400):
        form = rng.choice(list(forms))
        value = forms[form]()
        head = some(rng.randint(0, 60)) + " " + form[: form.index("%")]
        texts.append(head + value + form[form.index("%") + 2 :] + " " + some(rng.randint(0, 60)))
        spans.append((len(head), len(head) + len(value)))
    texts += [f"{some(20)} {rng.choice([hexa(40), str(rng.randint(10**6, 10**8)), 'camelCase', some(1)])} {some(20)}" for _ in range(200)]
    return texts, spans


def test_op1_against_an_independent_scorer_and_planted_identifiers(spark):
    texts, planted_spans = planted(random.Random(8))
    want = brute_ids(texts)
    got = spans_of(spark, texts)
    for text, spans in zip(texts, got):
        ids = [f"id:{a}:{b}" for a, b, v, base, _, _ in pii.instances(text, pii.base_spans(text)) if not base and v in want]
        assert [s for s in spans.split(",") if s.startswith("id:")] == ids
    unseen = [(s, f"id:{a}:{b}") for s, t, (a, b) in zip(got, texts, planted_spans) if not pii.base_spans(t)]
    found = sum(span in s.split(",") for s, span in unseen)
    assert len(unseen) > 200 and found >= 0.9 * len(unseen)
    assert sum("id:" in s for s in got[400:]) <= 2


def test_op1_tokens_and_words_are_those_of_the_patterns():
    rng = random.Random(14)
    bits = ["ab", "é", "id=", '"', "(", ": ", " ", "\n", "no.", "x@y.zz", "AB1", "-", ".", "_", "/", "aB", "z" * 70, "7", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        want = [m.span() for m in pii._TOKEN.finditer(text)]
        got = list(pii._token_spans(text))
        assert set(got) <= set(want) and all(not pii.shape(text[a:b]) for a, b in set(want) - set(got))
        assert pii._signs(pa.array([text]))[0] or not got
        words = [m.span() for m in pii._WORD.finditer(text)]
        for at in range(len(text) + 1):
            assert pii._words_before(text, at) == [w for w in words if w[1] <= at][-2:][::-1]
            assert pii._words_after(text, at) == [w for w in words if w[0] >= at][:2]


def test_op1_given_identifiers_are_seeds(spark):
    texts = [f"x code name {v} y" for v in ("Red_Fox", "Blue_Owl", "Old_Crow", "New_Swan")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r["spans"] == "" for r in pii.find_personal_data(docs).collect())
    found = pii.find_personal_data(docs, known=["Red_Fox", "Blue_Owl", "Old_Crow"]).collect()
    assert all(r["spans"].startswith("id:12:") for r in found)


def test_op1_long_contexts_and_long_numbers(spark):
    far = "z" * 5000
    texts = [f"w{i} member {far}: u{i}@mail.example.org bye" for i in range(6)]
    got = spans_of(spark, [*texts, f"x member {far}: AB1234567 y", "0" * 5000 + ".1.1.1", "1.2.3." + "0" * 6000 + "255"])
    assert got[6].startswith("id:") and got[7] == "ip:0:5006" and got[8] == "ip:0:6009"


# ---- html ----


def main_text(page):
    found = htmltext.blocks(page)
    return htmltext.text_at(found, htmltext.best_path(found)).split("\n")


BODY = "body words " * 40


def test_op2_keeps_title_and_lead_around_the_body():
    side = "<div><a href=/>Home page</a></div><footer><p>us</p></footer>"
    inner = f"<h1>Title</h1><p>The lead of it.</p><div class=body><p>{BODY}</p><p>{BODY}</p></div>"
    want = ["Title", "The lead of it.", BODY.strip(), BODY.strip()]
    for page in (f"<article>{inner}</article>", f"<main><div>{inner}</div></main>", f"<div class=post>{inner}</div>"):
        assert main_text(f"<html><body>{side}{page}</body></html>") == want


def test_op2_parts_of_a_text_are_no_winners():
    for part in ("blockquote", "section"):
        page = f"<body><div class=post><h1>Title</h1><p>First short words.</p><{part}><p>{BODY * 5}</p></{part}><{part}><p>Other part.</p></{part}></div></body>"
        assert main_text(page) == ["Title", "First short words.", (BODY * 5).strip(), "Other part."]
    page = f"<body><div class=post><p>Before the table.</p><table><tr><td><p>{BODY}</p></td></tr></table></div></body>"
    assert main_text(page) == ["Before the table.", BODY.strip()]


def test_op2_wrappers_with_names_of_furniture_keep_the_text():
    text = f"<p>{BODY}</p><p>{BODY}</p>"
    want = [BODY.strip()] * 2
    for open_, close in (("<div class='content has-sidebar'>", "</div>"), ("<div id=page class=header-fixed>", "</div>"), ("<form>", "</form>"), ("<div class=sidebar><main>", "</main></div>"), ("<div class=search>", "</div>")):
        assert main_text(f"<body>{open_}{text}{close}<div class=cookie-notice><p>We use cookies.</p></div></body>")[:2] == want
    assert main_text(f"<body><article><header><h1>Title</h1></header>{text}<figure><figcaption>Caption</figcaption></figure></article></body>") == ["Title", *want, "Caption"]


def test_op2_furniture_stays_out():
    page = f"<body><header><p>Site</p></header><form><p>Mail</p></form><div class=site-footer><p>Imprint</p></div><div id=comments><article class=comment><p>{BODY * 3}</p></article></div><div class=post><p>{BODY}</p></div></body>"
    assert main_text(page) == [BODY.strip()]


def test_op2_comments_and_adverts_in_article_elements():
    for name in ("comment", "ad", "comment reply-1"):
        assert main_text(f"<body><article><p>{BODY}</p><article class='{name}'><p>words of others</p></article></article></body>") == [BODY.strip()]
        assert main_text(f"<body><article><p>{BODY}</p></article><article class='{name}'><p>{BODY * 3}</p></article></body>") == [BODY.strip()] or name == "ad"


def test_op2_names_that_articles_use_too():
    page = "<body><article><p>{}</p><div class=form><p>Poem form</p></div><div class=related>{}</div><div class=search><input><p>Find</p></div></article></body>"
    assert main_text(page.format(BODY, "<p>Related work in prose</p>")) == [BODY.strip(), "Poem form", "Related work in prose"]
    assert main_text(page.format(BODY, "<a href=/x>Other page</a>")) == [BODY.strip(), "Poem form"]


def test_op2_deep_pages_stay_small():
    import time
    import tracemalloc

    tracemalloc.start()
    began = time.time()
    for page in ("<div class=abcdefghij>" * 20000 + "x", "<div>" * 3000 + "</x>" * 20000 + "x", "<p><b>" * 20000 + "x", "<div class='content has-sidebar'>" * 3000 + "x"):
        assert main_text(page) == ["x"]
    assert time.time() - began < 60 and tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_op2_generated_pages_give_their_known_text():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh&<é") for _ in range(rng.randint(1, 8)))
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    for _ in range(300):
        want, body = [], []
        for _ in range(rng.randint(1, 8)):
            text = " ".join(word() for _ in range(rng.randint(8, 40)))
            want.append(text)
            tag = rng.choice(["p", "h2", "blockquote", "li", "pre", "section", "div class=part-7", "figcaption", "td"])
            inner = rng.choice(["{}", "<b>{}</b>", "<span class=ad-hoc>{}", " {}\n"]).format(esc(text).replace(" ", rng.choice([" ", "\n  ", "<br>"])))
            body.append(f"<{tag}>{inner}</{tag.split()[0]}>")
        wrap = rng.choice(["<article>{}</article>", "<main><div>{}</div></main>", "<div id=page class='site-main'><article class=post-3>{}</article></div>", "<article><div class=body>{}</div></article>"])
        around = ["<nav><a href=/>Home</a></nav>", "<header><p>Site</p></header>", "<div class=ad>Buy <b>now</b></div>", "<div class=cookie-notice><p>We use them.</p></div>", "<script>var p='<p>x</p>'</script>", "<aside><p>More</p></aside>", "<footer><p>Us</p></footer>", "<div id=comments><p>I agree</p></div>", "<form><input><p>Mail</p></form>"]
        rng.shuffle(around)
        k = rng.randint(0, len(around))
        assert main_text(f"<html><body>{''.join(around[:k])}{wrap.format(''.join(body))}{''.join(around[k:])}</body></html>") == want


def test_op2_test_pages_against_another_parser(spark):
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.blocks = 0, [""]

        def handle_starttag(self, tag, attrs):
            self.inside += tag == "article"
            self.blocks += [""] if tag in ("p", "h1", "h2", "li", "ul", "blockquote", "div") else []
            self.blocks[-1] += " " if tag == "br" else ""

        def handle_endtag(self, tag):
            self.inside -= tag == "article"
            self.blocks += [""] if tag in ("p", "h1", "h2", "li", "ul", "blockquote", "div", "article") else []

        def handle_data(self, data):
            self.blocks[-1] += data if self.inside else ""

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html_of = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    for r in htmltext.extract(pages).collect():
        parser = Article()
        parser.feed(html_of[r["page_id"]])
        parser.close()
        assert r["text"].split("\n") == [" ".join(b.split()) for b in parser.blocks if b.split()]


# ---- decontamination ----


def test_op9_an_edited_last_sentence_does_not_hide_a_copy():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, f"{text(40)}{part}{text(5)}.") for i, part in enumerate([". ", "\n"] * 10)]
    index = decontam.Index(items)
    for k, (_, item) in enumerate(items):
        edited = item.split(" ")
        edited[-2] = "changed"
        for copy in (item, " ".join(edited), item.rsplit(" ", 1)[0]):
            assert list(index.search([f"{text(50)} {copy} {text(50)}"])[0]) == [k]
    assert not any(index.search([text(300) for _ in range(20)]))


def brute_leaks(docs, items):
    """The definition in plain Python: passages of two stretches, BM25 as a share of the item's own, overlap around the passage."""
    import math
    import re
    from collections import Counter

    def words(t):
        return [w for w in re.sub(r"[\x00-\x7f]", lambda m: m[0] if m[0].isalnum() else " ", t.casefold()).split(" ") if w]

    probes = []
    for k, (_, t) in enumerate(items):
        w = words(t)
        for lo in range(0, max(1, len(w)), decontam.PROBE_WORDS):
            p = w[lo : lo + decontam.PROBE_WORDS]
            if len(p) >= 5 or not lo and p:
                probes.append((k, Counter(p), len(p)))
    longest, mean = max(n for *_, n in probes), sum(n for *_, n in probes) / len(probes)
    held = Counter(t for _, c, _ in probes for t in c)
    idf = {t: math.log1p((len(probes) - d + 0.5) / (d + 0.5)) for t, d in held.items()}
    weights = [{t: idf[t] * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * n / mean)) for t, f in c.items()} for _, c, n in probes]
    runs = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    def share(part, around):
        w = words(part)
        n = min(5, len(w))
        return len(runs(w, n) & runs(around, n)) / len(runs(w, n)) if w else 1.0

    found = {}
    for d, t in docs:
        w = words(t or "")
        for a in range(0, len(w), longest):
            passage = set(w[a : a + 2 * longest])
            for (k, _, _), weight in zip(probes, weights):
                score = sum(x for t, x in weight.items() if t in passage) / sum(weight.values())
                if score < 0.8 - 1e-9 or score <= found.get((d, items[k][0]), 0):
                    continue
                item = items[k][1]
                parts = decontam.question_and_answer(item)
                reach = sum(len(runs(words(p), min(5, len(words(p))))) for p in parts) + 10
                around = w[max(0, a - reach) : a + 2 * longest + reach]
                near = tuple(share(p, around) for p in parts)
                if not decontam.marked_answer(item):
                    near = max(near, (share(item, around),) * 2, key=min)
                if min(near) >= 0.8:
                    found[d, items[k][0]] = score
    return set(found)


def test_op9_against_its_own_definition(spark, monkeypatch):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdef") for _ in range(3)) for _ in range(150)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, f"{text(rng.randint(4, 150))}{rng.choice(['? ', ' Answer: ', '. ', chr(10), ' '])}{text(rng.randint(1, 12))}") for i in range(30)]
    docs = [(d, text(rng.randint(0, 200))) for d in range(30)] + [(30, None), (31, "")]
    for d in range(40, 120):
        copy = rng.choice(items)[1].split(" ")
        for _ in range(rng.randint(0, len(copy) // 12)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        docs.append((d, f"{text(rng.randint(0, 150))} {' '.join(copy)} {text(rng.randint(0, 150))}"))
    want = brute_leaks(docs, items)
    assert len(want) > 40
    pages, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(pages, bench).collect()}
    assert got == want
    clean = {r["doc_id"] for r in decontam.clean_documents(pages, bench).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in want}


def test_op9_slices_by_bytes_in_few_passes(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SLICE_BYTES", 300)
    monkeypatch.setattr(decontam, "AT_ONCE", 2)
    texts = [" ".join(f"i{k}w{j}" for j in range(20)) for k in range(7)] + ["long " * 200 + " ".join(f"z{j}" for j in range(30))]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    assert len(list(decontam._slices(items))) > 3
    docs = spark.createDataFrame([(k, f"before {t} after") for k, t in enumerate(texts)] + [(99, "none of it")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, items).collect()} >= {(k, k) for k in range(7)}
    assert [r["doc_id"] for r in decontam.clean_documents(docs, items).collect()] == [99]


def test_op9_question_and_answer_are_both_needed():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    for mark in ("?", " Answer:"):
        question = text(60)
        index = decontam.Index([(0, f"{question}{mark} {text(6)}"), *((i, text(40)) for i in range(1, 9))])
        assert index.search([f"{text(20)} {question}{mark} {text(6)} {text(20)}"]) == [{}]
