"""HTML, chat, media, language and licences: planted cases, exact round trips, held-out accuracy; and the pipeline."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from quillstone.llm import bpe, chat, html, langid, licenses, media, mixing, queries, simhash, tokencount

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ARTICLE = "<h1>Ti&eacute;tle</h1><p>First <a href='x'>para</a>graph \n\t of text that is long enough to be read.<p>Second &lt;b&gt; one,<br>broken in two &amp; more words here.</p><ul><li>One item<li>Two items</ul>"
TEXT = "Tiétle First paragraph of text that is long enough to be read. Second <b> one, broken in two & more words here. One item Two items"
NOISE = "<script>var a='</div>';</script><div class='cookie-notice'>We use cookies</div><form>Send <input value=x></form><aside>Aside</aside><div class='ad-slot'>Buy now</div><div id=comments><p>Nice post, really nice, I liked it a lot and more</div><style>p{}</style><!-- note -->"


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title></head><body><header>Site</header><nav><ul><li><a>Home</a></ul></nav><article>{ARTICLE}{NOISE}</article><footer>Foot</footer></body></html>",
    f"<html><body class='has-sidebar'><div id=page><div class='header'>Site</div><div class='post-12 entry-content'>{ARTICLE}{NOISE}</div><div class='col sidebar'><p>Side text that is also long, but not so much</div></div>",
    f"<body><div role=navigation>Menu</div><main><div class=wrap><section>{ARTICLE}</section></div></main>{NOISE}<footer>Foot",
    f"<BODY><TABLE><TR><TD class=menu>Menu<TD>{ARTICLE}</TABLE>{NOISE}",
])
def test_main_text_without_noise(page):
    assert html.extract(page, None) == TEXT


def test_host_paths_decide(spark):
    small = "<body><div class='x'><p>Short teaser that is here.</p></div><div class='y7'><p>The body of the page, which is a little longer.</p></div></body>"
    big = "<body><div class='x'><p>Teaser.</p></div><div class='y3'><p>The body of this page is a good deal longer than its teaser is.</p></div></body>"
    pages = [(i, "http://h.example/%d" % i, big, "t", 1) for i in range(6)] + [(6, "http://H.example:80/6", small, "t", 1), (7, None, big, None, 1), (8, "http://h.example/8", None, "t", 1), (9, "http://h.example/9", "", "t", 1), (0, "http://h.example/0", big, "t", 1)]
    got = html.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string, text string, n_chars int"))
    rows = {r["page_id"]: r for r in got.collect()}
    assert got.count() == 11 and rows[8]["text"] == rows[9]["text"] == "" and all(r["n_chars"] == len(r["text"]) for r in rows.values())
    assert rows[7]["text"].startswith("The body") and "html" not in got.columns
    best = html.path_groups(html.parse(big))[0]
    assert html.step_of(best.nodes[0]) == "div.y#" and best.path == html.vote(big.replace("y3", "y99"))[0] != html.vote(big.replace("y3", "z3"))[0]
    assert html.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<b", ">", "x", "&amp", "<!--", "-->", "<script>", "</script>", "<li>", "</article>", "<article>", "\"", "'", " ", "<td>", "</table>", "<a href=\"q"]), max_size=25))
def test_any_markup_is_parsed(parts):
    html.extract("".join(parts), [{"path": "x", "sides": []}])
    ballot = html.vote("".join(parts))
    assert ballot is None or html.extract("".join(parts), [{"path": ballot[0], "sides": ballot[1]}]) == html.extract("".join(parts), None)


@pytest.mark.parametrize("page, text", [
    ("<p data-x=it's>second one</p><p>third it's here</p>", "second one third it's here"),
    ('<p class=x">Hello', "Hello"),
    ("<p a='1'b=\"2>3\"/c = 4 d=>one</p><p =x>two</p>", "one two"),
    ("<p title=a>b>c</p><!-- x --!>d<!-->e<!--->f</#g>h</>i<? j>k<![CDATA[l]]>m", "b>c defhikm"),
    ('<p>kept</p><p title="never closed>gone</p>', "kept"),
    ("<p>a < b and c <d", "a < b and c"),
])
def test_tags_are_cut_as_the_standard_does(page, text):
    assert html.extract(page, None) == text


def test_split_articles_and_what_stands_beside_them_stay_whole(spark):
    words = lambda w, n: " ".join([w] * n)
    half = lambda c, w: f"<div class='{c}'><p>{words(w, 60)}</p></div>"
    whole = f"<body><div class=wrap>{half('content', 'one')}</div><div class=foot-links>Foot</div></body>"
    split = f"<body><div class=wrap>{half('content', 'two')}<div class=advert>Buy</div>{half('content', 'three')}</div></body>"
    numbered = f"<body><div class=wrap>{half('content-1', 'four')}<div class=ad>Buy</div>{half('content-2', 'five')}</div></body>"
    titled = f"<body><div class=nav>Menu</div><h1>Title here</h1>{half('content', 'six')}<p>Last words.</p><div class=box>Something else</div></body>"
    parted = f"<body><div class=wrap>{half('content', 'seven')}<div class=rest><p>{words('eight', 40)}</p></div></div></body>"
    pages = [(i, f"http://h.example/{i}", whole) for i in range(20)] + [(23, "http://h.example/23", parted), (20, "http://h.example/20", split), (21, "http://h.example/21", numbered), (22, "http://h.example/22", titled)]
    got = {r["page_id"]: r["text"] for r in html.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[0] == words("one", 60) and got[20] == f"{words('two', 60)} {words('three', 60)}" and got[21] == f"{words('four', 60)} {words('five', 60)}"
    assert got[23] == f"{words('seven', 60)} {words('eight', 40)}"
    assert got[22] == f"Title here {words('six', 60)} Last words."


def test_a_host_of_many_templates_and_deep_pages(spark):
    page = lambda t, i: f"<body><div class='t{chr(97 + t)} page'><p>Template {t} text number {i} is the article. It goes on for a good while after that, as articles do.</p></div><div class='s{chr(97 + t)}'><p>Side {'x' * (140 if i == 39 else 1)}</p></div></body>"
    rows = [(t * 40 + i, "http://many.example/x", page(t, i)) for t in range(20) for i in range(40)]
    deep = "<div class=deep>" * 30_000 + "far down</div>" + "<b>" * 30_000 + "<p>x</p>" * 30_000
    docs = spark.createDataFrame(rows + [(5000, "http://deep.example/", deep), (5001, "http://deep.example/", "<p>" + "long text " * 200_000)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_pages(docs).collect()}
    assert all(got[i].startswith(f"Template {i // 40} text number {i % 40} is the article.") and "Side" not in got[i] for i in range(800))
    assert got[5000] == "far down" + " x" * 30_000 and len(got[5001]) == 10 * 200_000 - 1
    pages = docs.where("page_id < 100").withColumn("host", F.lit("many.example"))
    winners = html.host_paths(docs)
    shown = lambda df: {(r["page_id"], str(r["paths"])) for r in df.collect()}
    assert shown(html.with_paths(pages, winners)) == shown(html.with_paths(pages, winners, 0)) and len(shown(html.with_paths(pages, winners))) == 100
    assert {r["host"]: (len(r["paths"]), {len(p["sides"]) for p in r["paths"]}) for r in winners.collect()}["many.example"] == (21, {0, 1})


def test_pages_of_the_test_data(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{MEDIUM}/pages.parquet").collect()}
    import html as entities

    for r in html.op3_main_text(spark, MEDIUM).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", pages[r["page_id"]], re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub(r"</?[bia]\b[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)\b[^>]*>", inner)]
        assert r["text"] == " ".join(b for b in blocks if b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "a|b", ""]), st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "|", ">", "/", "s", "ok", " ", "\n", "<|end|>"]), max_size=8).map("".join)), max_size=6))
def test_template_is_reversible(turns):
    segments = [chat.segment(r, t, not i) for i, (r, t) in enumerate(turns)]
    assert chat.parse("".join("".join(s) for s in segments)) == turns
    for (role, text), (_, body, _) in zip(turns, segments):
        assert chat.unescape(body) == text
        assert chat.unescape(chat.escape(text)) == text and not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_prefix_tree_shares_turns_and_reads_back(spark):
    rows, want = [], {}
    for c in range(60):
        turns = [("system", "same start"), ("user", f"q{c % 3}"), ("assistant", f"a{c % 3}"), *([("user", f"more {c}"), ("assistant", None)] if c % 2 else [])]
        rows += [(c, i, r, t, "x") for i, (r, t) in enumerate(turns)]
        want[c] = "".join(f"{r}\n{t or ''}\n" for r, t in turns)
    rows += [(None, 0, None, "no id", "x"), (None, 0, None, "no id", "x"), (100, 0, "user", "dup", "x"), (100, 0, "user", "dup", "x"), (2**60 + 1, None, "tool", "é\U0001f600</s>", "x")]
    want |= {None: "\nno id\n", 100: "user\ndup\nuser\ndup\n", 2**60 + 1: "tool\né\U0001f600</s>\n"}
    long_turns = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(4000)]
    rows += [(101, i, r, t, "x") for i, (r, t) in enumerate(long_turns)]
    want[101] = "".join(f"{r}\n{t}\n" for r, t in long_turns)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pack string")
    decode = tokencount.counter(tokencount.default_path(), tokencount.default_pattern()).encoding.decode
    for tokens, leaves in ((1 << 17, 4096), (60, 4096), (1 << 17, 3)):
        packs = chat.pack(turns, tokens, leaves)
        back = chat.read_back(packs).collect()
        got = {r["conv_id"]: r for r in back}
        assert set(got) == set(want) and len(back) == len(want) + 1
        for c, text in want.items():
            assert got[c]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        for p in packs.collect():
            assert len(p["leaves"]) <= leaves
            ids = np.array(p["ids"])
            for n in p["nodes"]:
                if n["loss_end"] > n["loss_start"]:
                    assert re.fullmatch(r"(a|turn )\d+", decode(ids[n["loss_start"] : n["loss_end"]].tolist()))
                up = p["nodes"][n["parent"]] if n["parent"] >= 0 else None
                assert n["position"] == sum(a["end"] - a["start"] for a in n["attends"])
                assert (up is None) == (not n["attends"]) and all(a["end"] <= n["start"] for a in n["attends"])
    whole = chat.pack(turns.where("conv_id < 100").coalesce(1)).collect()
    texts = sum(decode(list(p["ids"])).count("same start") for p in whole)
    assert texts <= len(whole)  # a shared turn comes once a pack
    assert chat.pack(spark.createDataFrame([], turns.schema)).count() == 0


def test_media_round_trip(spark):
    texts = [None, "", "a", "é" * 500, "x" * 576, "x" * 577, "\U0010ffff" * 144, "".join(chr(32 + i * 7 % 90) for i in range(20000))]
    stored = media.store(texts)
    for text, data, (samples, lasts) in zip(texts, stored, media.load(stored)):
        raw = (text or "").encode()
        assert samples.tobytes() == raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw)) and lasts == 40_000
    rng = np.random.default_rng(0)
    frames = rng.integers(0, 256, (50, 576), dtype=np.uint8)
    assert np.array_equal(media.decode_frames(media.encode_frames(frames)), frames)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a", "x"), (2, "a", "x")], "doc_id long, text string, feature string")
    rows = media.media_digests(docs).collect()
    assert len(rows) == 10 and len({r["media_sha256"] for r in rows if r["doc_id"] in (2, None)}) == 1 and len({r["media_sha256"] for r in rows if r["doc_id"] in (0, 1)}) == 1
    for r in rows:
        raw = ("a" if r["doc_id"] is None else texts[r["doc_id"]] or "").encode()
        payload = raw + b"\xff" * (r["payload_bytes"] - len(raw))
        assert (r["n_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert media.media_digests(docs.where("false")).count() == 0


def test_shots_are_found(spark):
    dark, light = np.full((10, 576), 20, np.uint8), np.full((15, 576), 200, np.uint8)
    data = media.write_avi(media.encode_frames(np.concatenate([dark, light, dark])))
    clips = media.timed_clips(spark.createDataFrame([(7, bytearray(data)), (8, None)], "media_id long, media binary")).collect()
    assert [(c["first_frame"], c["start_ms"], c["end_ms"], c["mean_grey"]) for c in clips] == [(0, 0, 400, 20), (10, 400, 1000, 200), (25, 1000, 1400, 20)]


def baseline_jpeg(image, step=2, restart=0, colour=False):
    """A baseline JPEG of a grey image by the standard's own tables; with colour, two flat chroma parts at half the luma's sampling."""
    codes = {k: media._codes(bytes.fromhex(a), bytes.fromhex(b)) for k, (a, b) in media.STANDARD_TABLES.items()}
    angle = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (np.sqrt(0.125) if u == 0 else 0.5) for x in range(8)] for u in range(8)])
    bits = []

    def put(code, n):
        bits.extend((code >> i) & 1 for i in reversed(range(n)))

    def number(v):
        size = abs(v).bit_length()
        return (v if v >= 0 else v + (1 << size) - 1), size

    def block(pixels, before, tables):
        c = np.round(angle @ (pixels.astype(float) - 128) @ angle.T / step).astype(int).reshape(-1)[media.ZIGZAG].tolist()
        extra, size = number(c[0] - before)
        put(*tables[0][size]), put(extra, size)
        run = 0
        last = max((i for i in range(1, 64) if c[i]), default=0)
        for v in c[1 : last + 1]:
            if not v:
                run += 1
                continue
            while run > 15:
                put(*tables[1][0xF0])
                run -= 16
            extra, size = number(v)
            put(*tables[1][run << 4 | size]), put(extra, size)
            run = 0
        if last < 63:
            put(*tables[1][0])
        return c[0]

    def flush():
        bits.extend([1] * (-len(bits) % 8))
        data = np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")
        bits.clear()
        return data

    h, w = image.shape
    side = 16 if colour else 8
    padded = np.pad(image, ((0, -h % side), (0, -w % side)), mode="edge")
    out, before, n = b"", [0, 0, 0], 0
    for y in range(0, padded.shape[0], side):
        for x in range(0, padded.shape[1], side):
            if restart and n and n % restart == 0:
                out += flush() + bytes((0xFF, 0xD0 + (n // restart - 1) % 8))
                before = [0, 0, 0]
            for dy in range(0, side, 8):
                for dx in range(0, side, 8):
                    before[0] = block(padded[y + dy : y + dy + 8, x + dx : x + dx + 8], before[0], (codes[0, 0], codes[1, 0]))
            for k in (1, 2) if colour else ():
                before[k] = block(np.full((8, 8), 90 + 40 * k), before[k], (codes[0, 1], codes[1, 1]))
            n += 1
    out += flush()
    part = lambda m, body: bytes((0xFF, m)) + (len(body) + 2).to_bytes(2, "big") + body
    parts = bytes((3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0)) if colour else bytes((1, 1, 0x11, 0))
    scan = bytes((3, 1, 0, 2, 0x11, 3, 0x11, 0, 63, 0)) if colour else bytes((1, 1, 0, 0, 63, 0))
    head = part(0xE0, b"AVI1" + bytes(8)) + part(0xDB, b"\0" + bytes([step] * 64)) + part(0xC0, b"\x08" + h.to_bytes(2, "big") + w.to_bytes(2, "big") + parts)
    return b"\xff\xd8" + head + (part(0xDD, restart.to_bytes(2, "big")) if restart else b"") + part(0xDA, scan) + out + b"\xff\xd9"


def test_ordinary_motion_jpeg_is_read(spark):
    rng = np.random.default_rng(3)
    smooth = np.clip(np.add.outer(np.arange(37) * 3, np.arange(52) * 2) + rng.integers(-9, 9, (37, 52)), 0, 255).astype(np.uint8)
    for restart, colour in ((0, False), (3, False), (0, True), (2, True)):
        got = media.decode_baseline(baseline_jpeg(smooth, 2, restart, colour))
        assert got.shape == smooth.shape and np.abs(got.astype(int) - smooth).max() <= 6
    scenes = [smooth] * 6 + [255 - smooth // 4] * 5
    data = media.write_avi([baseline_jpeg(s, 4, 0, True) for s in scenes])
    clips = media.timed_clips(spark.createDataFrame([(2**60 + 1, bytearray(data)), (None, bytearray(data)), (8, bytearray(media.write_avi([])))], "media_id long, media binary")).collect()
    assert sorted((str(c["media_id"]), c["first_frame"]) for c in clips) == sorted((str(i), f) for i in (2**60 + 1, None) for f in (0, 6))
    with pytest.raises(ValueError):
        media.decode_baseline(b"\xff\xd8\xff\xd9")


def test_the_only_transition_of_a_clip():
    assert media.shots(media.histograms(np.array([[0] * 576, [255] * 576], np.uint8))) == [0, 1]
    assert media.shots(media.histograms(np.array([[7] * 576, [8] * 576], np.uint8))) == [0] == media.shots(media.histograms(np.zeros((1, 576), np.uint8)))


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    got = {r["doc_id"]: r for r in langid.op10_language_id(spark, MEDIUM).collect()}
    held = [(r["lang"], got[r["doc_id"]]["lang_pred"]) for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for d, r in got.items())
    assert sum(a == b for a, b in held) >= 0.98 * len(held) > 100


def test_language_ignores_labels_and_rejects_letterless_texts(spark):
    texts = ["the cat and the dog of the house"] * 8 + ["der Hund und die Katze in dem Haus"] * 8 + [None, "", "12 34 \u00bd !!", "中文"]
    rows = [(i, t, "en" if i < 8 else "de" if i < 16 else None, "clash", 0.5) for i, t in enumerate(texts)] + [(None, "the dog", "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    model = langid.fit(docs)
    got = {r["doc_id"]: r for r in langid.predict(docs.select("doc_id", "text"), model, "doc_id").collect()}
    assert {got[i]["lang_pred"] for i in range(8)} == {"en"} and {got[i]["lang_pred"] for i in range(8, 16)} == {"de"}
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (16, 17, 18)] == [("und", 0.0)] * 3 and got[19]["lang_pred"] != "und"
    kept = langid.reject(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    empty = docs.where("false")
    assert langid.reject(empty).count() == 0 and langid.reject(docs.withColumn("lang", F.lit(None).cast("string"))).count() == 0


def test_pipeline_rejects_unknown_languages_and_gibberish(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rnd = np.random.default_rng(5)
    planted = [
        "今天天气很好，我们去公园散步，然后回家吃饭。" * 20,
        "Сегодня хорошая погода, и мы пошли гулять в парк. " * 20,
        "Dzisiaj jest ładna pogoda i poszliśmy na spacer do parku, a potem wróciliśmy do domu. " * 20,
        "Tänään on kaunis sää ja menimme kävelylle puistoon, minkä jälkeen palasimme kotiin syömään. " * 20,
        "".join(rnd.choice(list("bcdfghjklmnpqrstvwxyz "), 2000)),
        "qzxj wvkq xzzq jqwx " * 80,
        "{ xs[i] = qux(&ptr->bz[j]); if (!xs[i] || j >> 3) goto err_wq; } // #ifdef XQ_Z\n" * 30,
    ]
    rows = [(10**9 + i, t, None, "src1", len(t)) for i, t in enumerate(planted)]
    kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs.union(spark.createDataFrame(rows, docs.schema)), MEDIUM).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()}


def brute_licence(text, templates):
    """(dice, name) of the best window, over every start and length."""
    words = lambda t: re.sub("[^A-Za-z0-9]+", " ", t or "").strip().lower().split(" ")
    grams = lambda w: list(zip(w, w[1:]))
    g, best = grams(words(text)), (0.0, None)
    for name, template in sorted(templates.items()):
        t = grams(words(template))
        kind, step = set(t), max(1, len(t) // licenses.STEPS)
        if not t:
            continue
        for s in [i for i, x in enumerate(g) if x in kind][::step]:
            for f in licenses.LENGTHS:
                u = set(g[s : s + -(-f.numerator * len(t) // f.denominator)])
                dice = 2.0 * len(u & kind) / (len(u) + len(kind))
                if dice >= 0.8 and dice > best[0]:
                    best = dice, name
    return best


def test_licences(spark):
    mit = licenses.TEMPLATES["MIT"]
    readme = "# Tool\n\nIt does things to files of many kinds.\n\n## License\n\n" + mit.replace("subject to", "\n\nsubject to").replace("THE SOFTWARE IS", "\n\nTHE SOFTWARE IS") + "\n\n## More\n\nOther words follow here."
    texts = [None, "", "word", mit, mit.upper().replace(" ", "\n  ", 3), "intro\n\n" + mit.replace("Software", "Program", 1) + "\n\nend", "text\nLicensed under CC BY-NC 4.0.\nmore " + "filler words " * 3000, "Released under the MIT license!", "permission is hereby granted to no one", "Licensed under Apache"]
    texts += [readme, "This project is free. This work is licensed under a Creative Commons Attribution 4.0 International License. Please cite it.", mit + " " + mit, "the software " * 400]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, mit, "x"), (3, mit, "x"), (2**60 + 1, None, "x")], "doc_id long, text string, license string")
    rows = licenses.scan(docs).collect()
    got = {r["doc_id"]: r["license"] for r in rows}
    assert got == {0: None, 1: None, 2: None, 3: "MIT", 4: "MIT", 5: "MIT", 6: "CC-BY-NC-4.0-notice", 7: "MIT-notice", 8: None, 9: None, 10: "MIT", 11: "CC-BY-4.0-notice", 12: "MIT", 13: None, None: "MIT", 2**60 + 1: None}
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] < 100:
            dice, name = brute_licence(texts[r["doc_id"]], licenses.TEMPLATES)
            assert (r["dice"], r["license"]) == (dice, name)
    by = {r["doc_id"]: r for r in rows}
    assert (by[11]["first_word"], by[11]["n_words"], by[11]["n_matches"], by[3]["dice"], by[8]["n_matches"]) == (5, 13, 2, 1.0, 0)
    assert len(rows) == 17 and licenses.scan(docs.where("false")).count() == 0
    assert {r["license"] for r in licenses.scan(docs, {}).collect()} == {r["license"] for r in licenses.scan(docs, {"x": "word"}).collect()} == {None}


def test_recall_of_licences_inside_long_documents(spark):
    rnd, words = np.random.default_rng(6), [f"word{i}" for i in range(500)] + "the of a in this to is and or any for software license work".split()
    filler = lambda n: " ".join(rnd.choice(words, n))
    rows, want = [], {}
    for i, (name, text) in enumerate(sorted(licenses.TEMPLATES.items()) * 4):
        parts = text.split(" ")
        for _ in range(len(parts) // 25):  # one word in 25 is another one, gone or new
            at = int(rnd.integers(len(parts)))
            parts[at : at + 1] = [["other"], [], [parts[at], "extra"]][int(rnd.integers(3))]
        wrapped = " ".join(p + ("\n * " if k % 11 == 10 else "") for k, p in enumerate(parts))
        rows.append((i, f"{filler(int(rnd.integers(0, 900)))} {wrapped} {filler(int(rnd.integers(0, 900)))}"))
        want[i] = name
    rows += [(10_000 + i, filler(800)) for i in range(60)]
    got = {r["doc_id"]: r["license"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] == name for i, name in want.items()) >= 0.95 * len(want) and all(got[10_000 + i] is None for i in range(60))


def test_native_plans_hold_no_python(spark):
    for plan in (licenses.scan(spark.read.parquet(f"{SMALL}/documents.parquet")), queries.queries()["op6_multiset_fingerprints"](spark, SMALL)):
        assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.collect()
    extra = spark.createDataFrame([(10_000, None, "en", "src1", 0), (10_001, "12 !!", "en", "src1", 5), (10_002, rows[0]["text"], rows[0]["lang"], None, 1)], docs.schema)
    docs = docs.union(extra)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "source_mix", "bpe_encode"]
    kept = corpus_pipeline.identify_language(spark, docs, SMALL).cache()
    assert kept.columns == docs.columns and {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()} == {10_000, 10_001}
    prints = [(r["doc_id"], simhash.fingerprint(r["text"])) for r in kept.collect()]
    parent = {d: d for d, _ in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if (x ^ y).bit_count() <= 4:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    single = corpus_pipeline.drop_near_duplicates(spark, kept, SMALL).cache()
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(d for d in parent if root(d) == d) and single.columns == docs.columns
    times = {r["doc_id"]: r["times"] for r in mixing.mix(single).collect()}
    mixed = corpus_pipeline.mix_sources(spark, single, SMALL)
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: t for d, t in times.items() if t} and mixed.columns == docs.columns
    encoded = corpus_pipeline.encode_tokens(spark, mixed, SMALL).collect()
    tok = bpe.Encoder(bpe.tokenizer(bpe.default_path()), None)
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    assert len(encoded) == sum(times.values())
    for r in encoded[:40]:
        assert r["ids_sha256"] == hashlib.sha256(tok.encode([texts[r["doc_id"]]])[0]).hexdigest()
    assert corpus_pipeline.ORACLE_SQL is None
