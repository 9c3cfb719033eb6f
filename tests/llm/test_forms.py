"""Fill-in-middle, page text and collocations against plain versions."""

import hashlib
import html
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aforo.llm import collocations, html_text, infill

DOCS = "doc_id long, text string, lang string, source string, n_chars long, form string, output string, phrase string, f long"


def small(spark, texts):
    """Rows with columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, g, "a", 0, "x", "y", "z", 1) for d, t, g in texts], DOCS)


ODD = [
    (1, "one\ntwo\nthree", "en"), (2, "a\n\n\nb\n", "en"), (2, "a\n\n\nb\n", "en"), (None, "no id\nat all", None), (3, None, "en"),
    (4, "", "en"), (5, "has <S> inside\nof it", "en"), (6, "é\nß→\n\U0001F600 end", "fr"), (7, "<P\n<\n<M", "fr"), (8, "\n", None),
    (9, "line of words, here.\n" * 60_000, "en"), (10, "x" * 1_200_000, "en"), (None, None, None),
] + [(100 + k, "\n".join(f"l{j} ü" for j in range(k)) + "\n" * (k % 2), "de") for k in range(40)]


def plain_fim(doc_id, text, rate=100, first=50, salt="7"):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexes = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexes[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(lines), "plain", None, None, text
    low, high = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    p, m, s = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    if h4 % 100 < first:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate, first, salt", [(100, 50, "7"), (40, 90, "x"), (0, 50, "7")])
def test_fill_in_middle_is_what_the_plain_version_gives(spark, rate, first, salt):
    docs = small(spark, ODD)
    got = infill.restored(infill.fill_in_middle(docs, rate, first, salt)).collect()
    want = Counter((d, *plain_fim(d, t, rate, first, salt), t or "") for d, t, _ in ODD)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got) == want
    for r in got:
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
    assert rate != 100 or {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.restored(infill.fill_in_middle(docs.limit(0))).count() == 0


def test_pieces_are_cut_without_copies():
    table = [infill.Piece(0, 0, 10), infill.Piece(1, 3, 6)]
    assert infill.cut(table, 4) == [infill.Piece(0, 0, 4), infill.Piece(0, 4, 10), infill.Piece(1, 3, 6)]
    assert infill.cut(table, 12)[1:] == [infill.Piece(1, 3, 5), infill.Piece(1, 5, 6)]
    for at in (0, 10, 13):
        assert infill.cut(table, at) == table


PROSE = ("The river rose, slowly at first, and then all at once, until the bridge was gone.",
         "Nobody had expected it; the maps, after all, showed nothing of the kind & no one asked.",
         "Short.", "In the end, as the keeper put it, water goes where it wants, and people follow.")
FRAMES = {
    "classes": '<html><head><title>T</title></head><body><div id="cookieBanner"><p>We use cookies, as all do, to count, and to sell.</p></div>'
               '<div class="site-header"><a href="/">Home of news, views, and more</a></div><ul class="main-menu"><li><a href="/a">A</a></li></ul>'
               '<div class="row"><div class="post-content">{}</div><div class="sidebar"><p>Read also, if you like, this, that, and the other.</p></div></div>'
               '<div id="comments"><div class="comment"><p>I was there, and it was, believe me, far worse, far, far worse than they say, really.</p></div></div>'
               '<div class="footer"><p>All rights, and wrongs, reserved, forever.</p></div></body></html>',
    "elements": "<body><header><h2>Paper</h2><nav><a href=x>x</a></nav></header><main><article>{}<aside><p>Buy, buy, and buy again, now, today.</p></aside>"
                "<form><p>Your mail, please, here, and here.</p><input></form></article>"
                "<section><h2>3 Comments</h2><article><p>First, as ever, and proud, of, it, all.</p></article></section></main><footer>f</footer></body>",
    "nameless": "<table><tr><td><a href=1>One</a><br><a href=2>Two</a><br><a href=3>Three</a></td><td>{}</td></tr></table>",
    "sections": "<div><article><h1>Flood</h1><section>{}</section><section><p>Later, it fell.</p></section></article></div>",
    "unclosed": "<body><ul><li><a href=a>a</a><li><a href=b>b</a><li><a href=c>c</a></ul><div class=text>{}",
    "links": '<div><div class="x">{}</div><div><a href=1>See this one</a> <a href=2>See that one</a> <a href=3>And another one</a></div></div>',
}


@pytest.mark.parametrize("frame", FRAMES)
def test_the_article_and_nothing_else(frame):
    for end in ("</p>", ""):
        body = "".join(f"<p>{html.escape(p).replace('water', '<b>water</b>')}{end}" for p in PROSE)
        before, after = (["Flood"], ["Later, it fell."]) if frame == "sections" else ([], [])
        want = "\n".join([*before, *PROSE, *after])
        assert html_text.main_text(FRAMES[frame].format(body)) == want


def test_blocks_white_space_and_references():
    page = "<article><h1> A\n\ttitle </h1><p>x&nbsp;&lt;b&gt;&#33;<br>y <script>var a='</p>'</script>z<p>one<br><br>two<ul><li>i<li>j</ul><pre>k\n  l</pre></article>"
    assert html_text.main_text(page) == "A title\nx <b>! y z\none\ntwo\ni\nj\nk l"


def test_odd_pages(spark):
    long = "<p>" + "word, " * 200_000
    rows = [(1, "u", None), (2, None, ""), (None, None, "<nav>x</nav>"), (3, "u", "no markup, at all"), (3, "u", "no markup, at all"), (4, "u", long),
            (5, "u", "<div>" * 20_000 + "deep, very deep"), (6, "u", "<"), (7, "u", "<p>cut &am"), (8, "u", "<p title='a>b'>in</p><!-- x"), (9, "u", "a</p></div>b")]
    pages = spark.createDataFrame([(*r, "old", 7) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    got = html_text.extract_text(pages).collect()
    want = ["", "", "", "no markup, at all", "no markup, at all", " ".join(["word,"] * 200_000), "deep, very deep", "<", "cut &am", "in", "ab"]
    assert Counter((r.page_id, r.url, r.text, r.n_chars) for r in got) == Counter((p, u, t, len(t)) for (p, u, _), t in zip(rows, want))
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_pages_of_the_tables(spark, sf):
    """In these tables an article element holds the article; a plain expression reads it."""
    rows = html_text.op12_html_text(spark, sf).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id].html, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*(>|\Z)", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
        assert r.text == "\n".join(p for p in parts if p) and r.url == pages[r.page_id].url


def plain_collocations(texts, least, max_words, share, top):
    counts, n = Counter(), Counter()
    for text, lang in texts:
        lang = "und" if lang is None else lang
        body = re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", body):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for k in range(len(words) - size + 1):
                    counts[lang, tuple(words[k:k + size])] += 1
    frequent = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    out = []
    for (lang, w), a in frequent.items():
        most = max((b for (g, v), b in frequent.items() if g == lang and len(v) > len(w)
                    and any(v[k:k + len(w)] == w for k in range(len(v) - len(w) + 1))), default=0)
        if most and 100 * most >= share * a:
            continue
        score, _, l, r = min((1_000_000 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]])
                             for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    out.sort()
    rank, rows = Counter(), []
    for lang, score, a, phrase, l, r in out:
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return rows


@pytest.mark.parametrize("least, max_words, share, top", [(2, 3, 50, 10_000), (3, 4, 30, 40), (2, 2, 50, 7)])
def test_collocations_are_what_the_plain_version_gives(spark, monkeypatch, least, max_words, share, top):
    monkeypatch.setattr(collocations, "FILTER_BITS", 64)  # full: all longer phrases are counted
    draw = random.Random(least)
    vocabulary = ["a", "B", "é", "É", "cd", "e-f", " ", "中", "x\x00y", "Zz"]
    texts = [("".join(draw.choice(vocabulary) + draw.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "  "]) for _ in range(draw.randint(0, 60))),
              draw.choice(["en", "fr", None, "und"])) for _ in range(60)]
    texts += [(None, "en"), ("", None), ("...", "xx"), ("the cat " * 4000, "en"), (texts[0][0], texts[0][1])]
    docs = small(spark, [(k, t, g) for k, (t, g) in enumerate(texts)]).repartition(3)
    got = collocations.collocations(docs, least, max_words, share, top).collect()
    assert sorted(map(tuple, got)) == sorted(plain_collocations(texts, least, max_words, share, top))
    assert collocations.collocations(docs.limit(0), least, max_words, share, top).count() == 0


def test_filters_and_long_texts_change_nothing(spark, monkeypatch):
    texts = [("big cats sleep. big dogs run, " * 300 + f"word{k} big cats", "en") for k in range(5)] + [("lone words only", "fr")]
    docs = small(spark, [(k, t, g) for k, (t, g) in enumerate(texts)])
    want = sorted(plain_collocations(texts, 2, 3, 50, 100))
    for bits in (64, 1 << 20):
        marks = collocations.phrase_filter(docs.select(F.lit("en").alias("lang"), F.lit("big cats").alias("phrase")), bits)
        assert len(marks.value) == bits // 8 and sum(b.bit_count() for b in marks.value) == 1
        assert sorted(map(tuple, collocations.collocations(docs, 2, 3, 50, 100).collect())) == want


def test_a_long_text_is_cut_where_pieces_end(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 20)
    text = "aaa bbb ccc, ddd eee fff. ggg hhh iii jjj kkk lll mmm nnn ooo; ppp"
    cut = [b.column("text")[0].as_py().decode() for b in collocations._short(iter([pa.record_batch({"lang": ["en"], "text": [text]})]))]
    assert "".join(cut) == text and len(cut) > 1 and all(c[-1] in ".,;" for c in cut[:-1])
