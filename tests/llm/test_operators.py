"""Operators of the training-data subpackage against brute force, on small tables with awkward rows."""

import base64
import hashlib
import itertools
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from factline.llm import bpe, components, exact_dedup, html_text, language, media, mixing, quality, simhash, suffix_tree, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, id string, fp string, row string, digest string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def sample(n=120, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(r.choice(WORDS) for _ in range(r.randrange(60)))
        rows.append((i, text, r.choice(["en", "de", None]), r.choice(["s1", "s2", "sé3", None])))
    rows += [(1000, None, None, None), (1001, "", "en", "s1"), (None, "no id", "en", "s1"), (None, "no id", "en", "s1"), (5, rows[5][1], "en", "s1"), (5, rows[5][1], "en", "s1")]
    rows += [(2000 + i, "same text over and over", "de", "s2") for i in range(40)]
    rows += [(3000, "word " * 30000, "en", "s1"), (3001, " \t\n\x0b ", "de", None), (3002, "x", "de", "s2")]
    return [(i, t, la, s, None if t is None else len(t), "clash", "clash", "clash", "clash", "clash") for i, t, la, s in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, empty):
    got = exact_dedup.exact_dedup(docs, counters=3).collect()
    groups = {}
    for row in sample():
        groups.setdefault(hashlib.sha256((row[1] or "").encode()).hexdigest(), []).append(row[0])
    assert Counter(r.text_sha256 for r in got) == Counter({k: len(v) for k, v in groups.items()})
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(groups.keys())
    kept = exact_dedup.drop_exact_duplicates(docs, counters=3)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0


def test_heavy_hitters_are_all_found(spark):
    values = ["a"] * 300 + ["b"] * 200 + [str(i) for i in range(500)]
    random.Random(1).shuffle(values)
    found = {r.key for r in exact_dedup.heavy_hitters(spark.createDataFrame([(v,) for v in values], "key string").repartition(7), "key", 15).collect()}
    assert {"a", "b"} <= found and len(found) <= 16


def brute_fingerprint(text, n=4):
    words = bytes((text or ""), "utf-8").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps, radius):
    label = list(range(len(fps)))
    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius and label[a] != label[b]:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = [new if x == old else x for x in label]
    return label


def test_simhash(docs, empty):
    rows = sample()
    fps = [brute_fingerprint(r[1]) for r in rows]
    label = brute_components(fps, 4)
    least = {x: min((r[0] for r, y in zip(rows, label, strict=True) if x == y and r[0] is not None), default=None) for x in set(label)}
    want = Counter((r[0], f"{fp:016x}", least[x]) for r, fp, x in zip(rows, fps, label, strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    assert Counter(map(tuple, simhash.near_duplicates(docs, chunk=3).collect())) == want
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def jaccard(a, b, n=5):
    sets = []
    for text in (a, b):
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or {tuple(words)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def edited(r, words, changes):
    words = list(words)
    for _ in range(changes):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("chunk", [4096, 8])
def test_similar_texts_are_dropped(spark, docs, chunk):
    """Against the Jaccard index of all pairs: near copies go, texts that share less stay, one of each group stays."""
    r = random.Random(12)
    texts, groups = [], []
    for g in range(40):
        base = [f"w{r.randrange(3000)}" for _ in range(r.randrange(80, 300))]
        for _ in range(r.randrange(1, 7)):
            texts.append(edited(r, base, r.randrange(3)))
            groups.append(g)
        texts.append(" ".join(base[: len(base) // 2]) + " " + " ".join(f"w{r.randrange(3000)}" for _ in range(len(base) // 2)))
        groups.append(None)  # shares a half
    df = spark.createDataFrame([(i, t, "a", "b", 1, "c", "c", "c", "c", "c") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    kept = {x.doc_id for x in simhash.drop_near_duplicates(df, chunk=chunk).collect()}
    near = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if jaccard(texts[i], texts[j]) >= 0.8]
    assert len(near) > 100 and sum(i in kept and j in kept for i, j in near) <= 0.03 * len(near)
    assert all(i in kept for i in range(len(texts)) if groups[i] is None)
    assert all(any(i in kept for i in range(len(texts)) if groups[i] == g) for g in range(40))
    some = simhash.drop_near_duplicates(docs)
    assert some.columns == docs.columns
    assert Counter(x.text or "" for x in some.collect()).most_common(1)[0][1] == 1


def test_sketches_in_pieces(monkeypatch):
    data = " ".join(f"w{i % 700}" for i in range(2000)).encode()
    whole = simhash.wide_sketch(data)
    monkeypatch.setattr(simhash, "_PIECE", 100)
    assert all(np.array_equal(a, b) for a, b in zip(whole, simhash.wide_sketch(data), strict=True))
    h = {xxhash.xxh64_intdigest(" ".join(f"w{(i + k) % 700}" for k in range(5)), seed=42) for i in range(700)}
    bits = [simhash._remixed(np.array([x], np.uint64), 0)[0] for x in sorted(h)]
    assert int(whole[0][0]) == sum(1 << b for b in range(64) if sum(int(x) >> b & 1 for x in bits) * 2 > len(bits))


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_links_of_close_fingerprints(spark, blocks, monkeypatch):
    r = random.Random(blocks)
    fps = [r.getrandbits(64) for _ in range(60)]
    fps += [f ^ sum(1 << b for b in r.sample(range(64), r.randrange(1, 7))) for f in fps for _ in range(3)]
    fps = sorted(set(fps))
    monkeypatch.setattr(simhash, "blocks_for", lambda n, radius: blocks)
    edges = simhash.link_fingerprints(spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long"), chunk=16)
    roots = {x.node: x.root for x in components.connected_components(edges).collect()}
    found = [roots.get(f - (1 << 64) if f >> 63 else f, f) for f in fps]
    want = brute_components(fps, 4)
    assert len(set(zip(found, want, strict=True))) == len(set(found)) == len(set(want))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body class="has-sidebar">
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Home page</a></li></ul></nav><div class="ad">Buy this now, it is cheap and good for all of you.</div>
<article><header><h1>A title</h1></header><p>First&nbsp;paragraph &amp; <b>more   text</b>, of a length that shows.<br><p>Second paragraph has some words as well,
over two lines.</p><div><p>Short.</p></div><aside>Related things that are elsewhere</aside></article>
<div id="comments"><p>A reader says something long about the article, with many words.</p></div><form>Name <input></form><footer>&copy; Someone</footer></body></html>"""


def test_html_text(spark):
    want = "A title\nFirst paragraph & more text, of a length that shows.\nSecond paragraph has some words as well, over two lines.\nShort."
    rows = [(1, PAGE), (2, None), (3, ""), (4, "plain words &lt;here&gt;"), (5, PAGE[: PAGE.index("</article>")]), (6, "<p>" + "long text " * 50000 + "</p>"), (7, "<<>&#x0;<p<")]
    got = {r.page_id: r.text for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, html string"), out_col="text").collect()}
    assert got[1] == want and got[2] == "" and got[3] == "" and got[4] == "plain words <here>"
    assert got[5] == want and got[6] == ("long text " * 50000).strip()


LONG = "Words that go on for a while, as an article has them, with much to say and few tags between one word and the next."
#: (html, main text) of pages that say nothing by names: ratio, smoothing and clusters have to find the article.
UNNAMED = [
    # Heading and lead beside the body's element; menu before, links and a copyright line after.
    (
        f"<body><div><a href=/>Home</a> <a href=/n>News</a> <a href=/a>About us</a></div><div><div><h1>A title</h1><p>{LONG} Lead.</p></div><div><p>{LONG}</p><p>Short.</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></div>"
        "<div><span><b><i>(c) Someone</i></b></span><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></div></body>",
        "\n".join(["A title", f"{LONG} Lead.", LONG, "Short.", *[LONG] * 9]),
    ),
    # No element at all around the text.
    (f"<body><p><a href=/>Home</a><p><a href=/a>A</a><p><a href=/b>B</a><p><a href=/c>C</a><h2>Head</h2><p>{LONG}<p>Short.<p>{LONG}<p>{LONG}<p><a href=1>Next</a><p><a href=2>Last</a><p><a>Imprint</a><p><i>(c)</i></body>", "\n".join(["Head", LONG, "Short.", LONG, LONG])),
]


@pytest.mark.parametrize(("html", "want"), UNNAMED)
def test_html_text_without_names_comes_from_the_ratio(html, want, monkeypatch):
    assert html_text.main_text(html) == want
    # Without the ratio, the smoothing or the clusters another text comes out.
    with monkeypatch.context() as m:
        m.setattr(html_text, "content_lines", lambda lines, other, sigma=2.0: ~other)
        assert html_text.main_text(html) != want
    with monkeypatch.context() as m:
        m.setattr(html_text, "threshold", lambda values: float(values.min()))
        assert html_text.main_text(html) != want


def test_html_text_smoothing_decides():
    """A dense line alone among menus is below the threshold only by its neighbours, a short one within the text above it."""
    menu = "".join(f"<div><a href={i}>Item {i}</a></div>" for i in range(9))
    html = f"<body>{menu}<div>{LONG[:70]}</div>{menu}<p>{LONG * 3}<p>{LONG * 3}<p>Short.<p>{LONG * 3}<p>{LONG * 3}{menu}</body>"
    assert html_text.main_text(html) == "\n".join([LONG * 3, LONG * 3, "Short.", LONG * 3, LONG * 3])
    assert html_text.main_text(html, sigma=0.01) != html_text.main_text(html) or html_text.content_lines(*_lines_of(html), 0.01).sum() != html_text.content_lines(*_lines_of(html)).sum()


def _lines_of(html):
    parser = html_text.Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return parser.lines, html_text.marked(parser.lines)


@pytest.mark.parametrize("skipped", sorted(html_text.SKIP - {"head"}))
def test_html_text_after_self_closing_elements(skipped):
    html = f'<body><article><p>{LONG}</p><p><{skipped} class="i"/> words after it</p><p>{LONG}</p></article></body>'
    assert html_text.main_text(html) == f"{LONG}\nwords after it\n{LONG}"


def test_html_text_drops_no_article_text():
    html = f"""<head><title>T</title><body><form id=aspnet><div class="layout has-sidebar"><article><h1>T</h1><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>
    <section class="social-history"><p>{LONG}</p></section><section id="related-work"><p>{LONG}</p></section><div class="alert-level">{LONG}</div>
    <h2>Sources</h2><ul><li><a href=1>A source that is one link</a></li><li><a href=2>Another one</a></li></ul><p><a href=3>A paragraph that is a link</a></p>
    <div class="comment-list"><p>{LONG}</p></div><div class="site-footer">{LONG}</div><div class="cookie-banner">{LONG}</div></article></div></form>"""
    assert html_text.main_text(html) == "\n".join(["T", f"{LONG} x=2 holds.", LONG, LONG, LONG, "Sources", "A source that is one link", "Another one", "A paragraph that is a link"])


def test_html_text_of_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, f"<p>{LONG}", "x", "y")], "page_id long, html string, text string, lines string")
    got = html_text.main_texts(df, out_col="text").first()
    assert (got.text, got.lines) == (LONG, "y") and html_text.main_texts(df.limit(0), out_col="text").count() == 0


def brute_smoothed(values, sigma):
    out = []
    for i in range(len(values)):
        pairs = [(math.exp(-0.5 * ((i - j) / sigma) ** 2), v) for j, v in enumerate(values) if abs(i - j) <= math.ceil(3 * sigma)]
        out.append(sum(w * v for w, v in pairs) / sum(w for w, _ in pairs))
    return out


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_html_text_of_all_pages_equals_a_plain_version(spark):
    """Of the given pages: smoothed ratios above the middle of two clusters, and all lines of the article around them that no name takes away."""
    import pyarrow.parquet as pq

    for html in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        lines, other = _lines_of(html or "")
        if not lines:
            assert html_text.main_text(html or "") == ""
            continue
        ratio = brute_smoothed([0.0 if o else x.own / x.tags for x, o in zip(lines, other, strict=True)], 2.0)
        low, high = min(ratio), max(ratio)
        while True:
            cut = (low + high) / 2
            parts = [[r for r in ratio if (r > cut) == side] for side in (False, True)]
            means = tuple(sum(p) / len(p) if p else old for p, old in zip(parts, (low, high), strict=True))
            if all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for a, b in zip(means, (low, high), strict=True)):
                break
            low, high = means
        seeds = [x for x, r, o in zip(lines, ratio, other, strict=True) if r >= (low + high) / 2 and not o]
        articles = {e for x in seeds for e in x.path if e[1]}
        best = max(articles, key=lambda e: (sum(x.own for x in seeds if e in x.path), e))
        assert html_text.main_text(html) == "\n".join(x.text for x, o in zip(lines, other, strict=True) if best in x.path and not o)


def test_media_round_trip(docs, empty):
    read = media.store_texts(docs.select("doc_id", "text")).select("doc_id", "text", media.media_features("media").alias("f")).collect()
    assert len(read) == len(sample())
    for r in read:
        data = (r.text or "").encode()
        data += b"\0" * (-len(data) % 64 or (0 if data else 64))
        assert (r.f.payload_bytes, r.f.payload_sha256, r.f.tail_crc32) == (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
    assert media.store_texts(empty).select(media.media_features("media")).count() == 0
    clash = docs.select(F.lit("kept").alias("payload"), F.lit("old").alias("media"), "text")
    assert {r.payload for r in media.store_texts(clash).select("payload", media.media_features("media").alias("f")).collect()} == {"kept"}


def test_media_of_a_long_payload_in_parts(monkeypatch):
    payload = random.Random(1).randbytes(64 * 50)
    whole = media.encode_jpeg(payload)
    monkeypatch.setattr(media, "_LANES", 7)
    assert media.encode_jpeg(payload) == whole


def test_thumbnail_hash_against_plain_sums():
    r = random.Random(4)
    for high, wide in ((1, 1), (3, 20), (9, 9), (40, 33)):
        grey = np.array([[r.randrange(256) for _ in range(wide)] for _ in range(high)], np.uint8)
        cell = lambda i, j: [int(grey[y, x]) for y in range(i * high // 8, max(-(-(i + 1) * high // 8), i * high // 8 + 1)) for x in range(j * wide // 9, max(-(-(j + 1) * wide // 9), j * wide // 9 + 1))]
        mean = lambda i, j: sum(cell(i, j)) / len(cell(i, j))
        want = sum((mean(i, j + 1) > mean(i, j)) << (63 - 8 * i - j) for i in range(8) for j in range(8))
        assert media.thumbnail_hash(grey) == want


def test_media_decodes_other_tables_and_intervals():
    """A grey image with several Huffman code lengths, zero runs, ends of blocks and two blocks an interval."""
    r = random.Random(5)
    dc_codes = {0: "00", 1: "01", 2: "100", 3: "101", 4: "110"}
    ac_codes = {0x00: "00", 0x01: "01", 0x12: "100", 0x23: "1010", 0xF0: "1011"}
    table = lambda codes: bytes([sum(len(c) == n for c in codes.values()) for n in range(1, 17)]) + bytes(sorted(codes, key=lambda s: (len(codes[s]), codes[s])))
    raw = lambda v, n: "" if not n else format(v if v > 0 else v + (1 << n) - 1, f"0{n}b")
    want, scan = [], b""
    for interval in range(6):
        bits, before = "", 0
        for _ in range(2):
            block = [0] * 64
            n = r.randrange(5)
            diff = 0 if not n else r.choice([-1, 1]) * r.randrange(1 << n - 1, 1 << n)
            before += diff
            block[0] = before
            bits += dc_codes[n] + raw(diff, n)
            k = 1
            for run, size in r.choices([(0, 1), (1, 2), (2, 3), (15, 0)], k=3):
                k += run
                bits += ac_codes[run << 4 | size]
                if size:
                    block[k] = r.choice([-1, 1]) * r.randrange(1 << size - 1, 1 << size)
                    bits += raw(block[k], size)
                k += 1
            bits += ac_codes[0]
            want.append(block)
        bits += "1" * (-len(bits) % 8)
        scan += bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\0") + (b"\xff" + bytes([0xD0 + interval % 8]) if interval < 5 else b"")
    seg = media._segment
    data = b"\xff\xd8" + seg(0xDB, b"\0" + b"\2" * 64) + seg(0xC0, b"\x08\0\x18\0\x20\1\1\x22\0") + seg(0xC4, b"\0" + table(dc_codes) + b"\x10" + table(ac_codes)) + seg(0xDD, b"\0\2") + seg(0xDA, b"\1\1\0\0\x3f\0") + scan + b"\xff\xd9"
    (image, found, error), = media.decode([data])
    assert error is None and (image.width, image.height) == (32, 24) and found.tolist() == want
    thumbnail = image.thumbnail(found[:, 0])
    assert thumbnail.tolist() == np.clip(np.rint(np.array([b[0] for b in want]).reshape(3, 4) * 2 / 8) + 128, 0, 255).tolist()
    broken = [None, b"", data[:40], data[: len(data) // 2], data.replace(b"\xff\xc0", b"\xff\xc2"), b"\xff\xd8" + bytes(range(200))]
    assert all(x[2] for x in media.decode(broken)) and next(media.decode([*broken, data][::-1]))[2] is None


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_language_is_right_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs.where(~language.held_out()))
    got = language.predict(docs.where(language.held_out() & F.col("lang").isNotNull()), model).collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_rows(spark, docs, empty):
    model = language.train(docs)
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert got[1000].lang_pred == got[1001].lang_pred == got[3001].lang_pred == "und" and got[1000].score == 0
    assert got[3000].lang_pred in ("en", "de") and language.keep_identified(docs, model).columns == docs.columns
    assert {r.lang_pred for r in language.predict(docs, language.train(empty)).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


def test_language_beyond_a_word_of_languages(spark):
    """Seventy languages, each with letters of its own."""
    r = random.Random(6)
    alphabets = {f"l{i:02}": [chr(0x4E00 + 40 * i + k) for k in range(30)] for i in range(70)}
    rows = [(i * 20 + k, " ".join("".join(r.choice(letters) for _ in range(3)) for _ in range(40)), lang) for i, (lang, letters) in enumerate(alphabets.items()) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df)
    assert len(model.languages) == 70 and model.words.shape[1] == 2
    assert all(x.lang == x.lang_pred and x.score > 0.9 for x in language.predict(df, model).collect())


def test_language_against_plain_sets(spark):
    """With a large filter: shares of a text's 4-grams that are in the languages' sets, counted without bits."""
    r = random.Random(7)
    rows = [(i, " ".join("".join(r.choice("abcdeé" if i % 2 else "defghß") for _ in range(r.randrange(2, 7))) for _ in range(r.randrange(1, 30))), "xy"[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    grams = lambda t: (lambda d: [g for g in (d[i : i + 4] for i in range(len(d) - 3)) if g != b"    "])(b"    " + bytes(c if chr(c).isalpha() or c >= 0x80 else 32 for c in t.lower().encode()) + b"    ")
    counts = {la: Counter(g for _, t, x in rows if x == la for g in grams(t)) for la in "xy"}
    share = {la: {g: n / c.total() for g, n in c.items()} for la, c in counts.items()}
    sets = {la: {g for g, s in own.items() if s >= language.MIN_SHARE and s >= 0.3 * max(o.get(g, 0) for o in share.values())} for la, own in share.items()}
    for x in language.predict(df, language.train(df, size=1 << 22)).collect():
        own = grams(x.text)
        found = {la: sum(g in s for g in own) / len(own) for la, s in sets.items()}
        best = max("xy", key=lambda la: (found[la], la == "x"))
        assert abs(found[best] - x.score) < 1e-3 and (x.lang_pred == best or abs(found["x"] - found["y"]) < 1e-3)


def test_texts_of_no_learned_language_go(spark):
    r = random.Random(3)
    words = "the of and to in is that for it was on are with they be at one have this from".split()
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(1, 60))), "en") for i in range(300)]
    noise = [(1000 + i, "".join(r.choice("bcdfghjklmnpqrstvwxzBCDFG") for _ in range(200)), None) for i in range(20)] + [(1100, "Это другой язык, которого никто не учил", None), (1101, "123 -- 456", None), (1102, None, None)]
    df = spark.createDataFrame(rows + noise, "doc_id long, text string, lang string")
    kept = {x.doc_id for x in language.keep_identified(df, language.train(df)).collect()}
    assert kept == set(range(300))


def test_language_ties_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "same words here", "b", 7, 8, 9), (2, "same words here", "a", 7, 8, 9)], "doc_id long, text string, lang string, __lang int, found int, row int")
    got = language.predict(df, language.train(df)).collect()
    assert {x.lang_pred for x in got} == {"a"} and all((x["__lang"], x.found, x.row) == (7, 8, 9) for x in got)


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level > 3 * sizes[s]]
        if not over:
            return capped | {s: weight[s] * level for s in open_}
        capped |= {s: 3.0 * sizes[s] for s in over}


def test_mixing(docs, empty):
    rows = mixing.place(docs, carry=False).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert len(rows) == len(sample())
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r["size"] * len(r.copies)
        largest[r.source] = max(largest[r.source], r["size"])
        assert len(r.copies) <= 3 and all(c.shard is not None and 0 <= c.shard < mixing.SHARDS for c in r.copies if r["size"])
    want = brute_targets(sizes)
    for r in rows:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = mixing.place(docs.repartition(3), carry=False).select("row.doc_id", "size", "copies").collect()
    assert Counter(map(repr, again)) == Counter(repr(x) for x in mixing.place(docs, carry=False).select("row.doc_id", "size", "copies").collect())
    mixed = mixing.mix(docs)
    assert mixed.select("row.*").columns == docs.columns and mixed.count() == sum(len(r.copies) for r in rows)
    # A shard is in one task, in the order of the key; a block is in one shard; a shard's words are its copies'.
    found = mixed.select("row.doc_id", "shard", "key", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")).collect()
    assert len({(r.shard, r.task) for r in found}) == len({r.shard for r in found}) > 8
    for shard in {r.shard for r in found}:
        keys = [r.key for r in sorted(found, key=lambda r: r["at"]) if r.shard == shard]
        assert keys == sorted(keys)
    blocks = {(r.source, c.block): set() for r in rows for c in r.copies}
    for r in rows:
        for c in r.copies:
            blocks[r.source, c.block].add(c.shard)
    assert all(len(x) == 1 for x in blocks.values())
    assert Counter((r.doc_id, r.shard) for r in found) == Counter((r.doc_id, c.shard) for r in rows for c in r.copies)
    assert mixing.place(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mix_is_written_by_shard(spark, docs, tmp_path):
    mixing.write_mix(docs.drop("row"), f"file://{tmp_path}/mix", shards=4)
    back = spark.read.parquet(f"file://{tmp_path}/mix")
    assert {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
    assert back.count() == mixing.mix(docs, shards=4).count() and all(len(list((tmp_path / "mix" / f"shard={i}").glob("*.parquet"))) == 1 for i in range(4))


def test_shards_follow_the_words():
    assert [mixing.shards_for(n, 16, 1000) for n in (0, 1, 16000, 16001, 100000)] == [16, 16, 16, 32, 128]


def test_targets_of_many_sources(spark):
    """Sources that are spread over tasks get the weights and levels that one list gives."""
    r = random.Random(8)
    sizes = {f"host{i}": r.randrange(1, 10 ** r.randrange(1, 6)) for i in range(700)} | {None: 50}
    got = mixing.source_targets(spark.createDataFrame([(str(s), s, n) for s, n in sizes.items()], "skey string, source string, source_size long").repartition(7))
    want = brute_targets(sizes)
    assert all(math.isclose(x.target, want[None if x.skey == "None" else x.skey], rel_tol=1e-9) for x in got.collect()) and got.count() == 701


def test_splitting_tree_deals_each_block_once(spark):
    quotas = spark.createDataFrame([("a", 37), ("b", 5), ("c", 1), ("d", 0)], "skey string, quota long")
    got = mixing.splitting_tree(quotas, 3, 1).collect()
    assert Counter((r.skey, r.block) for r in got) == Counter({("a", i): 1 for i in range(37)} | {("b", i): 1 for i in range(5)} | {("c", 0): 1})
    per_shard = Counter(r.shard for r in got)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1 and len(per_shard) == 8
    assert all(len({r.shard for r in got if r.skey == s}) > 1 for s in "ab")


def test_bpe_equals_the_library(docs, empty):
    library = Tokenizer.from_file(TOKENIZER)
    r = random.Random(2)
    letters = "abz ZÉß  \n\t\r'sdllve019é€漢字😀\u0085 _-.,!?~\x1c\x01́"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(50))) for _ in range(800)]
    texts += ["<|endoftext|>x<|endoftext|>", "a" * 5000, " " * 300, "é" * 500, "''s €'s", *(x[1] or "" for x in sample(30))]
    own = bpe.tokenizer(TOKENIZER)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(text) == want.ids
        assert own.decode(want.ids) == library.decode(want.ids, skip_special_tokens=False)
    for r_ in docs.select("text", bpe.digests(TOKENIZER).alias("d")).collect():
        ids = library.encode(r_.text or "", add_special_tokens=False).ids
        assert (r_.d.n_tokens, r_.d.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r_.d.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.decode_ids(bpe.encode_texts(empty, TOKENIZER), TOKENIZER).count() == 0
    separate = bpe.decode_ids(bpe.encode_texts(docs.select("doc_id", "text"), TOKENIZER), TOKENIZER)
    want = sorted(repr((r.doc_id, r.ids, r.decoded == (r.text or ""))) for r in separate.collect())
    assert sorted(repr(tuple(r)) for r in bpe.encode_checked(docs, TOKENIZER, ["doc_id"]).collect()) == want
    assert bpe.encode_checked(empty, TOKENIZER, ["doc_id", "row"]).count() == 0
    assert bpe.encode_checked(docs.withColumn("ids", F.lit(1)).limit(2), TOKENIZER, ["doc_id", "ids"]).columns == ["doc_id", "ids", "round_trip"]


def test_bpe_with_a_small_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 4)
    monkeypatch.setattr(bpe, "_PIECE", 20)
    own, library = bpe.ByteBpe(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    texts = [x[1] or "" for x in sample(40)][:40]
    assert [ids.tolist() for ids, _ in own.encode_all(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_scores(docs, empty):
    rows = suffix_tree.score(docs, ~suffix_tree.held_out(), min_word=0.005).collect()
    texts, counts = {}, Counter()
    for i, t, *_ in sample():
        words = (t or "").encode().lower().split() + [b""]
        texts.setdefault(i, []).append(words)
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    assert len(rows) == len(sample())
    for r in rows:
        words = texts[r.doc_id][0]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and r.score <= 1e-9
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert suffix_tree.score(empty, ~suffix_tree.held_out()).count() == 0
    unlearned = suffix_tree.score(docs, F.lit(False)).collect()
    assert len(unlearned) == len(sample()) and {(r.score, r.base_score, r.n_known, r.train_tokens) for r in unlearned} == {(0.0, 0.0, 0, 0)}


def test_scores_keep_the_type_of_ids_and_ignore_clashing_columns(spark):
    df = spark.createDataFrame([("a", "one two", 1, 2), ("b", None, 1, 2)], "key string, text string, uid int, words int")
    got = {r.key: r for r in suffix_tree.score(df, F.lit(True), id_col="key").collect()}
    assert got["a"].n_tokens == 3 and got["b"].n_tokens == 1 and got["a"].train_tokens == 4


def brute_suffix_tree(texts, least=2, longer=8):
    """Probabilities of a text's words after all words before them, and the tree's depth: contexts as tuples, no hashes and no table."""
    grams = Counter(tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, min(i + 14, len(t) + 1)))
    total, distinct = sum(map(len, texts)), sum(len(g) == 1 for g in grams)
    back, value = {}, {}

    def prob(before, w, longest):
        for d in range(min(len(before), longest), 0, -1):
            context = before[-d:]
            if context in back:
                return value[context, w] if (context, w) in value else 10 ** back[context] * prob(before, w, d - 1)
        return (grams[(w,)] + 0.5) / (total + 0.5 * (distinct + 1))

    candidates = {g for g, n in grams.items() if len(g) == 1 and n >= least}
    for d in range(1, 13):
        nexts = {}
        for g, n in grams.items():
            if len(g) == d + 1 and n >= 2 and g[:-1] in candidates and (d == 1 or (g[1:-1], g[-1]) in value):
                expected = grams[g[:-1]] * prob(g[:-1], g[-1], d - 1)
                if n * (math.log(n / expected) - 1) + expected >= 4:
                    nexts.setdefault(g[:-1], {})[g[-1]] = n
        new_back, new_value = {}, {}
        for context, found in nexts.items():
            n, kept, types = grams[context], sum(found.values()), len(found) + 1
            above = {w: prob(context, w, d - 1) for w in found}
            gain = sum(k * math.log(k / n / above[w]) for w, k in found.items())
            gain += (n - kept) * math.log((n - kept) / n / max(1 - sum(above.values()), 1e-12)) if n > kept else 0
            if gain > types * math.log(n):
                new_back[context] = math.log10(((n - kept) / max(1 - sum(above.values()), 1e-12) + types) / (n + types))
                new_value |= {(context, w): (k + types * above[w]) / (n + types) for w, k in found.items()}
        if not new_back:
            break
        back |= new_back
        value |= new_value
        candidates = {(*g, w) for g, found in nexts.items() for w, n in found.items() if n >= longer and (*g[1:], w) in new_back}
    return lambda words: [prob(tuple(words[:i]), w, 13) for i, w in enumerate(words)], d


def chain_texts():
    r = random.Random(9)
    rows = []
    for i in range(400):
        words = [r.choice(WORDS)]
        for _ in range(r.randrange(70)):
            code = (WORDS.index(words[-3]) if words[-3] in WORDS else 0) * 7 + len(words[-2]) * 3 + len(words[-1]) if len(words) >= 4 else 0
            words.append(r.choice(WORDS + [f"w{r.randrange(4000)}"] * 6) if len(words) < 4 or r.random() < 0.6 else f"next{code % 5}")
        rows.append((i, " ".join(words)))
    return rows + [(1000 + i, f"rare{i} passage number{i} stands here three times over") for i in range(30) for _ in range(9)]


@pytest.mark.parametrize(("min_word", "tokens"), [(1e-6, 1 << 19), (0.02, 1 << 19), (0.02, 16)])
def test_scores_equal_a_whole_tree_in_memory(spark, monkeypatch, min_word, tokens):
    """Contexts of one word and pairs count from 2 on at any size, longer ones from 8, and as deep as they tell apart; a broadcast part and cut texts change nothing."""
    monkeypatch.setattr(suffix_tree, "_TOKENS", tokens)
    rows = chain_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learned = [t.encode().split() + [b""] for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    brute, depth = brute_suffix_tree(learned)
    assert depth >= 3
    got = suffix_tree.score(df, ~suffix_tree.held_out(), min_word=min_word).collect()
    want = dict(rows)
    assert len(got) == len(rows)
    for x in got:
        assert math.isclose(x.score, sum(math.log10(p) for p in brute(want[x.doc_id].encode().split() + [b""])), rel_tol=1e-9, abs_tol=1e-9)


def test_longer_contexts_read_only_parts_of_texts(spark, monkeypatch):
    """From contexts of three words on, words that are near no candidate aren't read again."""
    written = {}

    def write(df, label, **options):
        out = suffix_tree_write(df, label, **options)
        if label in ("tokens", "spans"):
            written[label] = out.agg(F.sum(F.octet_length("words"))).first()[0] or 0
        return out

    suffix_tree_write = suffix_tree.write_shared
    monkeypatch.setattr(suffix_tree, "write_shared", write)
    rows = chain_texts() + [(2000 + i, " ".join(f"once{i}x{j}" for j in range(200))) for i in range(100)]
    suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).collect()
    assert 0 < written["spans"] < written["tokens"] / 2


def test_probabilities_of_next_words_sum_to_one():
    rows = chain_texts()
    learned = [t.encode().split() + [b""] for _, t in rows]
    brute, _ = brute_suffix_tree(learned)
    words = sorted({w for t in learned for w in t} | {b"never seen"})
    for text in random.Random(1).sample(learned, 15):
        before = text[: len(text) // 2]
        assert math.isclose(sum(brute([*before, w])[-1] for w in words), 1, rel_tol=1e-9)


def test_warc(spark):
    rows = [(1, "http://a/", "x" * 30000), (2, None, "x" * 30000), (3, "http://b/\r\nWARC-Type: fake", None), (4, "u", ""), (None, "u", "no id"), (5, "é", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\né"), (6, "u", "once"), (6, "u", "once")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, sha string").repartition(3)
    got = warc.archive_round_trip(df, segment=700, chunk=300).collect()
    assert len(got) == len(rows) and all(r.valid for r in got)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    for page, _, html in rows:
        data = (html or "").encode()
        for r in by[page]:
            assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
            assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
    kinds = {page: {(r.record_type, r.refers_to) for r in x} for page, x in by.items()}
    assert kinds == {1: {("revisit", 2)}, 2: {("response", None)}, 3: {("revisit", 4)}, 4: {("response", None)}, None: {("response", None)}, 5: {("response", None)}, 6: {("response", None)}}
    assert warc.archive_round_trip(df.limit(0)).count() == 0
    joined = warc.archive_round_trip(df, segment=700, chunk=300, broadcast=0).collect()
    key = lambda r: (str(r.page_id), r.record_type, str(r.refers_to), r.payload_digest)
    assert sorted(map(key, joined)) == sorted(map(key, got))


def test_warc_with_text_ids_and_standard_references(spark, tmp_path):
    df = spark.createDataFrame([("a", "http://a/", "same"), ("b", "http://b/", "same"), ("c", "http://c/", "other" * 9000)], "page_id string, url string, html string")
    path = f"file://{tmp_path}/warc"
    warc.write_warc(df, path)
    back = {r.page_id: r for r in warc.read_warc(spark, path).collect()}
    assert back["a"].refers_to == "b" and back["c"].payload_bytes == 45000 and all(r.valid for r in back.values())
    import gzip

    fields = [f for x in (tmp_path / "warc").glob("*.gz") for f, _ in warc.parse(gzip.decompress(x.read_bytes()))]
    revisit = next(f for f in fields if f["warc-type"] == "revisit")
    response = next(f for f in fields if f.get("page-id") == "b")
    assert (revisit["warc-refers-to"], revisit["warc-refers-to-target-uri"], revisit["warc-refers-to-date"]) == (response["warc-record-id"], "http://b/", response["warc-date"])
    assert sum(f["warc-type"] == "continuation" for f in fields) == 5
    plan = warc.read_warc(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.lower().count("scan binaryfile") == 1


def test_warc_that_is_broken_raises(spark, monkeypatch):
    monkeypatch.setattr(warc, "_record_id", lambda *parts: "<urn:same>")  # records that claim to be one
    with pytest.raises(Exception, match="fails its checks"):
        warc.archive_round_trip(spark.createDataFrame([(1, "u", "x" * 9000), (2, "u", "y" * 9000)], "page_id long, url string, html string").coalesce(1)).collect()


def test_warc_segments_that_miss_a_part_are_not_valid(spark):
    parts = list(warc.segments({"WARC-Type": "response", "WARC-Record-ID": "<urn:x>", "WARC-Date": "d", "WARC-Payload-Digest": "sha1:"}, b"HTTP/1.1 200 OK\r\n\r\n" + b"y" * 90, 40))
    assert len(parts) == 3
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([b"".join(p + b"\r\n\r\n" for p in parts[:2])], pa.binary())], names=["content"])
    records = next(warc._records(iter([batch]))).to_pylist()
    row = {"record_id": "<urn:x>", "first": {k: records[0][k] for k in ("record_type", "page_id", "url", "refers_to", "payload_digest", "segment")}, "total_length": None, "parts": [{"segment": r["segment"], "block": r["block"]} for r in records]}
    kind = pa.struct([("record_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("segment", pa.int32())])
    whole = pa.RecordBatch.from_arrays([pa.array([row["record_id"]]), pa.array([row["first"]], kind), pa.array([None], pa.int64()), pa.array([row["parts"]], pa.list_(pa.struct([("segment", pa.int32()), ("block", pa.binary())])))], names=["record_id", "first", "total_length", "parts"])
    assert next(warc._payloads(iter([whole]))).to_pylist()[0]["valid"] is False


def test_quality(spark, docs, empty):
    r = random.Random(4)
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        text = " ".join(r.choice(WORDS) + ("###" if bad else "") for _ in range(r.randrange(5, 40)))
        rows.append((i, text, "en", "spam" if bad and r.random() < 0.8 else "web", len(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(300)] + [(None, 1), (1, None), (9999, 1)], "doc_id long, quality int")
    got = quality.classify(df, quality.train(df, labels)).collect()
    assert sum(x.keep == (x.doc_id % 4 != 0) for x in got if x.doc_id >= 300) >= 295
    model = quality.train(df, labels)
    assert quality.classify(docs, model).count() == len(sample()) and quality.classify(empty, model).count() == 0
    assert {x.score for x in quality.classify(df, quality.train(df, labels.limit(0))).collect()} == {0.5}


def two_views(seed, n=900, weak=0.55):
    """Documents whose text shows their quality and whose source hardly does."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        bad = r.random() < 0.3
        text = " ".join(r.choice(WORDS) + ("###" if bad and r.random() < 0.5 else "") for _ in range(r.randrange(5, 40)))
        rows.append((i, text, "en", "spam" if r.random() < (weak if bad else 1 - weak) else "web", len(text), int(not bad)))
    return rows


def area(scores, y):
    good, bad = [s for s, v in zip(scores, y, strict=True) if v], [s for s, v in zip(scores, y, strict=True) if not v]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("seed", [1, 2])
def test_co_training_does_no_harm(spark, seed):
    rows = two_views(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality int")
    labels = df.where("doc_id < 300").select("doc_id", "quality")
    held = {r[0]: r[5] for r in rows if r[0] >= 300}

    def of(rounds):
        model = quality.train(df, labels, rounds=rounds)
        got = {r.doc_id: r.score for r in quality.classify(df, model).collect()}
        return area([got[i] for i in held], list(held.values())), model

    before, (after, model) = of(0)[0], of(4)
    assert after >= before - 1e-3 and all(right > pupils for *_, right, pupils, _ in model.exchanged)


def test_a_round_picks_what_brute_force_picks(spark):
    """The most certain of all rows by each teacher, in steps, and the pupil's features of them."""
    rows = two_views(3)
    df = spark.createDataFrame([x[:5] for x in rows], "id long, text string, lang string, source string, n_chars long").repartition(3)
    table = quality._features(df.withColumn("place", F.xxhash64("id", F.lit(7)))).cache()
    got = table.orderBy("place").toPandas()
    x = quality._unpack(got["content"].map(bytes), got["codes"].map(bytes))
    y = np.array([dict((r[0], r[5]) for r in rows)[i] for i in got["id"]], float)
    views = [quality.View.fit(x[v][::2], y[::2], x[v][1::2], y[1::2]) for v in (0, 1)]
    pairs = [(0, 1), (0, 0), (1, 1)]
    found = quality.picker(table.drop("id"), share=0.2, certain=0.6, pseudo=40)(views, pairs)
    for teacher, good in pairs:
        odds = views[teacher].odds(x[teacher]) * (1 if good else -1)
        sure = sorted({math.floor(o * 20) for o in odds if math.floor(o * 20) >= math.log(0.6 / 0.4) * 20}, reverse=True)
        fits = [k for k in sure if (np.floor(odds * 20) >= k).sum() <= 0.2 * len(y)] or sure[:1]
        want = x[1 - teacher][np.floor(odds * 20) >= fits[-1]][:40] if fits else np.zeros((0, 1))
        assert found[teacher, good].shape[0] == want.shape[0] and np.array_equal(found[teacher, good], want)
    assert any(len(f) for f in found.values())
