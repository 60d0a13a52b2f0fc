"""Pages, URLs, benchmark windows, passages and pieces against brute force or round trips."""

import collections
import html
import itertools
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import read
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.htmltext import Page, extract, main_text, shared
from tidemark.llm.pieces import MODEL, Encoder, decoded, encoded, vocabulary
from tidemark.llm.queries import QUERIES
from tidemark.llm.substrings import align, chains, common_length, fragments, split
from tidemark.llm.urlfilter import url_filter

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def text_of(page):
    return "\n\n".join(Page(page).texts)


def test_blocks():
    page = """<html><head><title>t</title></head><body><nav>menu</nav><div class="ad">buy</div><article><h1>A &amp; B</h1>
    <p>one  two<br>three <b>bold<p>next &lt;x&gt;<script>var t="</p>";</script><ul><li>a<li>b</ul><div class="comments"><p>reader</p></div></article>
    <aside>side</aside><form><p>mail</p></form><footer>foot</footer>"""
    assert text_of(page) == "A & B\n\none two three bold\n\nnext <x>\n\na\n\nb"
    assert text_of(None) == text_of("") == "" and text_of("plain text") == "plain text"
    assert text_of("<p>a <!-- x --> b") == "a b" and text_of("<p>unclosed <b") == "unclosed"
    # Quotes count around values only; one that is never closed ends with its tag; what isn't a tag is text.
    assert text_of("<p title=it's>x y</p>") == text_of("<p title='a>b' class=\"q>\">x y</p>") == text_of("<p title='open>x y</p>") == "x y"
    assert text_of("1 < 2 <3 </ x>") == "1 < 2 <3 </ x>" and text_of('<div class="header-story"><p>text</p></div>') == "text"
    assert text_of("<p>a<![CDATA[ b > c ]]>d<!-- open") == "ad" and text_of("<article><div>a</section>b</article></p>c") == "a\n\nb\n\nc"


def test_scan_is_linear():
    import time

    began = time.time()
    for page in ("<a " * 1_700_000, "<a b='" * 800_000, "<a b=\"c'>" * 500_000, "<div>" * 300_000 + "</span>" * 300_000, "<article><p>" * 200_000 + "</div></p>" * 200_000, "<!--" * 1_000_000, "<script>" * 500_000, "= " * 2_000_000):
        Page(page)
    assert time.time() - began < 25


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(9))] for _ in range(2))
        got = sorted(shared(a, b))
        best = max((len(c) for n in range(len(a) + 1) for c in itertools.combinations(range(len(a)), n) if is_sub([a[i] for i in c], b)), default=0)
        assert len(got) == best and is_sub([a[i] for i in got], b)


def is_sub(x, y):
    it = iter(y)
    return all(c in it for c in x)


def test_template_of_neighbours_is_deleted(spark):
    page = lambda k: f"<body><div>Site name</div><p>story {k}</p><div>About us</div></body>"
    rows = [(k, f"http://h.example/a/{k}", page(k), 1) for k in range(5)] + [(9, None, None, 1), (10, "no url", "", 1), (11, "http://other/", page(1), 1)]
    got = {r.page_id: r for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int"), 1).collect()}
    assert all(got[k].text == f"story {k}" and got[k].n_chars == 7 for k in range(5))
    assert got[9].text == got[10].text == "" and got[9].n_chars == 0 and got[11].text == "Site name\n\nstory 1\n\nAbout us"
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    assert main_text(Page("a"), "", [(Page("a"), "")]) == "a"


def test_differencing_decides_and_does_not_depend_on_partitions(spark):
    """Unmarked pages: template before, behind and between; an article at two addresses; repeated rows; a line that articles quote."""
    story = lambda k: "".join(f"<p>story {k} part {i}</p>" for i in range(4)) + "<p>quoted line</p>"
    page = lambda k, more="": f"<body><div id=page><div>Site name</div><div><h2>Title {k}</h2>{story(k)}</div><div><p>About us</p><p>Imprint{more}</p></div></div>"
    rows = [(k, f"http://h.example/a/{k:02}", page(k)) for k in range(12)] + [(100, "http://h.example/a/05", page(5)), (101, "http://h.example/a/05", page(5)), (102, "http://h.example/a/05?x", page(5, " "))]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: "\n\n".join([f"Title {k}", *[f"story {k} part {j}" for j in range(4)], "quoted line"]) for i, k in [*[(k, k) for k in range(12)], (100, 5), (101, 5), (102, 5)]}
    for inputs, parts in ((1, 1), (3, 3), (50, 50), (7, None)):
        assert {r.page_id: r.text for r in extract(docs.repartition(inputs), parts).collect()} == want


def test_pages_without_marks_keep_the_same_text(spark):
    p = read(spark, MIDDLE, "pages", "page_id", "url", "html")
    bare = p.withColumn("html", F.regexp_replace("html", "(</?)article", "$1div"))
    want = {r.page_id: r.text for r in extract(p).collect()}
    got = {r.page_id: r.text for r in extract(bare).collect()}
    alone = [i for i in want if got[i] != want[i]]
    assert len(want) == 250 and not alone, alone


def test_pages_hold_their_article(spark):
    import html
    import re

    p = pd.read_parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r.text for r in QUERIES["op5_html_text"](spark, SMALL).collect()}
    for i, h in zip(p.page_id, p.html, strict=True):
        inner = re.search(r"(?s)<article>(.*?)</article>", h)[1].replace("<br>", " ")
        want = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[i] == "\n\n".join(x for x in want if x)


def test_url_rules(spark):
    rules = spark.createDataFrame([("a.net", "/", "block"), ("NET", "/x", "allow"), ("b.a.net", "/x/y", "allow"), ("a.net", "/x/", "allow"), (None, "/", "block"), ("", "/", "block"), ("net", "/long/path", "block"), ("net", "/long/path", "allow")], "host string, path string, verdict string")
    urls = ["http://a.net/", "https://W.A.net/x/1", "http://b.a.net/x/y/z?q", "http://xa.net/x", "http://net", "a.net/x", None, "http://c.net/long/path", "http://a.net.org/", "x://A.NET/long/path#f"]
    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(None, "http://a.net/q", "clash"), (0, urls[0], "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = collections.defaultdict(list)
    for r in url_filter(df, rules, rows=3).collect():
        got[r.page_id].append((r.rule, r.verdict))
    want = {0: [("a.net/", "block")] * 2, 1: [("a.net/x/", "allow")], 2: [("b.a.net/x/y", "allow")], 3: [("net/x", "allow")], 4: [(None, "allow")], 5: [(None, "allow")], 6: [(None, "allow")], 7: [("net/long/path", "block")], 8: [(None, "allow")], 9: [("net/long/path", "block")], None: [("a.net/", "block")]}
    assert dict(got) == want
    assert url_filter(df.limit(0), rules).collect() == [] and {r.verdict for r in url_filter(df, rules.limit(0), default="block").collect()} == {"block"}


def test_many_url_rules_equal_brute_force(spark):
    """100,000 nested rules, 20,000 of them on one host, and a third of all URLs on that host."""
    rng = np.random.default_rng(8)
    label = lambda n: [f"{x}" for x in rng.integers(0, n, 100_000)]
    host = [f"h{a}.d{b}.t{c}" if c != "0" else f"d{b}.t0" for a, b, c in zip(label(3), label(40), label(4), strict=True)]
    host = ["hot.t1" if k % 5 == 0 else h for k, h in enumerate(host)]
    path = ["/" + "/".join(x[:n]) for n, *x in zip(rng.integers(0, 4, 100_000), label(30), label(30), label(9), strict=True)]
    block = rng.integers(0, 2, 100_000) == 1
    table: dict = {}
    for h, p, b in zip(host, path, block, strict=True):
        table[h, p] = max(table.get((h, p), ""), "block" if b else "allow")
    urls = [f"http://{'www.hot.t1' if k % 3 == 0 else 'x.' * (k % 2) + host[k * 7]}{path[k * 11]}{'/more' * (k % 4 == 0)}" for k in range(3000)]

    def judge(url):
        h, p = re.match(r"http://([^/]*)(.*)", url).groups()
        labels = h.split(".")
        found = [(len(x) + n, len(x), x, p[:n]) for i in range(len(labels)) for x in [".".join(labels[i:])] for n in range(len(p) + 1) if (x, p[:n]) in table]
        return (max(found)[2] + max(found)[3], table[max(found)[2:]]) if found else (None, "allow")

    rules = spark.createDataFrame(pd.DataFrame({"host": host, "path": path, "verdict": np.where(block, "block", "allow")}))
    df = spark.createDataFrame(pd.DataFrame({"page_id": range(3000), "url": urls}))
    for rows in (100, 200_000):
        got = {r.page_id: (r.rule, r.verdict) for r in url_filter(df, rules, rows=rows).collect()}
        assert got == {k: judge(u) for k, u in enumerate(urls)}


def test_contamination_equals_brute_force(spark):
    import math

    d, b = pd.read_parquet(f"{MIDDLE}/documents.parquet"), pd.read_parquet(f"{MIDDLE}/benchmark.parquet")
    shingles = lambda w: [b" ".join(w[i : i + 5]) for i in range(len(w) - 4)]
    items = {i: split(t) for i, t in zip(b.item_id, b.text, strict=True)}
    df = collections.Counter(x for w in items.values() for x in set(shingles(w)))
    weight = lambda x: math.log(1 + len(items) / max(df[x], 1))
    want = {}
    for doc, t in zip(d.doc_id, d.text, strict=True):
        w = split(t)
        own = shingles(w)
        for i, item in items.items():
            theirs = collections.Counter(shingles(item))
            if theirs.keys().isdisjoint(own):
                continue
            met = list(itertools.accumulate((x in theirs for x in own), initial=0))
            for at in range(-len(item) + 5, len(w) - 4):  # every window of the text, cut at its ends
                lo, hi = max(0, at), min(at + len(item), len(w))
                if met[max(lo, hi - 4)] - met[lo] < len(theirs) / 2:
                    continue
                a = collections.Counter(own[lo : hi - 4])
                s = sum(min(a[x], theirs[x]) * weight(x) for x in a | theirs) / sum(max(a[x], theirs[x]) * weight(x) for x in a | theirs)
                if s >= 0.8:
                    want[doc, i] = max(want.get((doc, i), 0), s)
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(read(spark, MIDDLE, "documents", "doc_id", "text"), read(spark, MIDDLE, "benchmark", "item_id", "text")).collect()}
    assert got.keys() == want.keys() and len(got) > 10 and all(abs(got[k] - want[k]) < 1e-5 for k in got)


def test_short_items_and_repeated_words(spark):
    docs = spark.createDataFrame([(1, "they say the SECRET answer forty two and more"), (2, "spam " * 40_000), (3, "answer secret"), (4, "secret answer forty")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "secret answer forty two"), (2, "spam " * 30), (3, "secret answer"), (4, "nowhere")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.first_word, r.words, r.similarity) for r in contaminated(docs, items).collect())
    assert got == [(1, 1, 3, 4, 1.0), (1, 3, 3, 2, 1.0), (2, 2, 0, 30, 1.0), (4, 3, 0, 2, 1.0)]


def test_chains_and_alignment():
    import numpy as np

    x = np.array([0, 6, 12, 40, 46, 100]), np.array([10, 16, 22, 51, 57, 5])
    f = fragments(*x)
    assert [tuple(int(v) for v in r) for r in f] == [(0, 17, 10, 27, 3), (40, 51, 51, 62, 2), (100, 105, 5, 10, 1)]
    assert sorted(chains(f)) == [(0, 51, 10, 62), (100, 105, 5, 10)]
    rng = random.Random(5)
    for _ in range(100):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert common_length(a, b) == t[-1][-1]
    a = [str(i) for i in range(60)]
    b = [*"xyz", *a[:20], "q", *a[21:], *"uvw"]
    assert align(a, b, [(25, 30, 28, 33)]) == (0, 60, 59 / 60)
    # Between runs of equal words the common subsequence counts, whatever the order in which overlapping runs come.
    a, b = [str(i) for i in range(30)], [*map(str, range(10)), "x", "11", "y", *map(str, range(13, 30))]
    assert align(a, b, [(2, 9, 2, 9), (14, 25, 14, 25)]) == (0, 30, 28 / 30)


def test_repeats_equal_brute_force(spark):
    d = pd.read_parquet(f"{MIDDLE}/documents.parquet")
    words = dict(zip(d.doc_id, map(split, d.text), strict=True))
    cover = {i: [False] * len(w) for i, w in words.items()}
    for r in QUERIES["op10_substrings"](spark, MIDDLE).collect():
        assert r.ref_doc_id < r.doc_id and r.words >= 40 and r.similarity >= 0.8
        cover[r.doc_id][r.first_word : r.first_word + r.words] = [True] * r.words
    seen, total, missed = {}, 0, 0
    for i, w in words.items():
        own, hit = {}, set()
        for p in range(len(w) - 50 + 1):
            k = tuple(w[p : p + 50])
            if k in seen:
                hit.update(range(p, p + 50))
            own.setdefault(k, i)
        seen |= {k: v for k, v in own.items() if k not in seen}
        total += len(hit)
        missed += sum(not cover[i][p] for p in hit)
    assert total > 10_000 and missed < 0.002 * total


@pytest.fixture(scope="module")
def encoder():
    return Encoder(vocabulary())


def test_segmentations_equal_exhaustive_search(encoder):
    def all_of(u):
        if not u:
            return [(0.0, [])]
        out = []
        for k in range(1, len(u) + 1):
            hit = encoder.piece.get(u[:k])
            if hit or k == 1:
                ids, s = ([hit[0]], hit[1]) if hit else (encoder._fallback(u[0]), encoder.unknown)
                out += [(s + t, ids + i) for t, i in all_of(u[k:])]
        return out

    for u in ("▁hello", "▁thtion", "▁▁x", "réeux", "日本", "\n", "▁"):
        want = sorted((-s, i) for s, i in all_of(u))[:6]
        got = encoder.best_of(u, 6)
        assert [round(s, 9) for s, _ in got] == [round(-s, 9) for s, _ in want]
        (ids, score, _), = encoder.encode([u.replace("▁", " ")[1:]]) if u.startswith("▁") and len(u) > 1 else [encoder.encode(["x"])[0]]
        if u.startswith("▁") and len(u) > 1 and len(encoder.units(u.replace("▁", " ")[1:])) == 1:
            assert abs(score - got[0][0]) < 1e-9


def test_equals_the_library_on_the_same_pieces(encoder):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(open(MODEL, "rb").read())
    m.trainer_spec.model_type = 1
    value = {i: s for i, s in encoder.piece.values()}
    for i, p in enumerate(m.pieces):
        p.score = value.get(i, p.score)
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    texts = pd.read_parquet(f"{SMALL}/documents.parquet").text.tolist()
    for (ids, score, best), t in zip(encoder.encode(texts, 3), texts, strict=True):
        theirs = lib.encode(t, out_type=int, add_bos=False)
        assert abs(sum(value[i] for i in theirs if i in value) - sum(value[i] for i in ids.tolist() if i in value)) < 1e-2
        assert abs(best[0][0] - score) < 1e-9 and best[0][0] >= best[1][0] >= best[2][0]
    assert [i for _, i in encoder.best_of("▁hello", 4)] == lib.nbest_encode("hello", nbest_size=4, out_type=int, add_bos=False)


def test_text_nbest_equals_combination_of_units(encoder):
    for t in ("hello there world", "a b", "x"):
        per = [encoder.best_of(u, 5) for u in encoder.units(t)]
        want = sorted((sum(s for s, _ in c) for c in itertools.product(*per)), reverse=True)[:5]
        got = [s for s, _ in encoder.encode([t], 5)[0][2]]
        assert len(got) == min(5, len(want)) and all(abs(a - b) < 1e-9 for a, b in zip(got, want, strict=False))


def test_text_nbest_gives_the_ids_of_each_segmentation(spark, encoder):
    texts = ["hello there world", "a b", "x", "", "日本 naïve 😀"]
    for t in texts:
        per = [encoder.best_of(u, 5) for u in encoder.units(t)]
        every = {tuple(i for _, part in c for i in part): sum(s for s, _ in c) for c in itertools.product(*per)}
        ids, _, best = encoder.encode([t], 5)[0]
        assert best[0][1].tolist() == ids.tolist() and len({tuple(i.tolist()) for _, i in best}) == len(best) == min(5, len(every))
        assert all(abs(every[tuple(i.tolist())] - s) < 1e-9 and encoder.decode(i.tolist()) == t for s, i in best)
    for row in encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        assert row.nbest[0].ids == row.ids and all(b.pieces == len(b.ids) and encoder.decode(b.ids) == texts[row.doc_id] for b in row.nbest)


def test_round_trip(spark):
    docs = read(spark, SMALL, "documents", "doc_id", "text")
    e = encoded(docs)
    assert e.filter("NOT round_trip").count() == 0
    assert decoded(e.select("doc_id", "ids")).exceptAll(docs).isEmpty()
