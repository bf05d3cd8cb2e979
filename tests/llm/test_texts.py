"""Jaccard join, suffix dedup, line dedup and template removal against brute force."""

import random
import re

import numpy as np
import pytest

from cratecast.llm import jaccard
from cratecast.llm.html import Page, extracted, host_of
from cratecast.llm.jaccard import joined
from cratecast.llm.linededup import chunk_array, decoded, line_deduped
from cratecast.llm.suffix import repeats
from cratecast.llm.words import text_shingles, word_hashes

from .conftest import union_find

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def words(t):
    return WORD.findall(lowered(t or ""))


def sets_of(texts, n):
    out = []
    for t in texts:
        w = words(t)
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def corpus(seed=5, n=40):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(60)]
    passage = [rng.choice(vocabulary) + "p" for _ in range(60)]
    texts = []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 60, 200]))]
        texts.append(" ".join(w))
        if i % 4 == 0:
            for _ in range(3):
                v = [x if rng.random() > 0.02 else "edit" for x in w]
                texts.append("\n".join(v))
        if i % 5 == 0:
            texts.append(" ".join(w[:20] + passage + w[20:40]))
    return texts + ["", None, "  \t ", "A b", "a B", "É x", "é x", "one", texts[0], texts[0], "x " * 3000]


def documents(texts):
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def test_words_and_shingles_match_plain_python():
    texts = corpus()
    for n in (4, 5):
        assert [len(x) for x in text_shingles(texts, n)] == [len(s) for s in sets_of(texts, n)]
    h, first, a, b = word_hashes([t.encode() for t in ("Ab  c", "", "ab")])
    assert list(first) == [0, 2, 2, 3] and h[0] == h[2] and (list(a), list(b)) == ([0, 4, 0], [2, 5, 2])


@pytest.mark.parametrize("n,percent,small", [(4, 85, False), (5, 80, True)])
def test_jaccard_join_matches_brute_force(frame, monkeypatch, n, percent, small):
    if small:
        monkeypatch.setattr(jaccard, "LEAF", 3)
    texts = corpus()
    s = sets_of(texts, n)
    pairs = [(i, j) for i in range(len(s)) for j in range(i + 1, len(s)) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j])]
    comp = union_find(range(len(s)), pairs)
    got = joined(frame(documents(texts) + [(None, "a null id", None, None, None)], SCHEMA), n, percent, chunk=8 if small else 1024).collect()
    assert len(got) == len(texts) + 1
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == {i: (len(s[i]), comp[i]) for i in comp}


def test_jaccard_leaves_lose_no_short_near_copy(frame):
    rng = random.Random(1)
    texts = []
    for g in range(1200):
        base = ["g%dw%d" % (g, i) for i in range(rng.randrange(13, 18))]
        # the first is too far from the others to settle the group
        texts += [" ".join(base[rng.randrange(3, 5) :])] + [" ".join(base + ["end%d" % i]) for i in range(2)]
    s = sets_of(texts, 5)
    pairs = [(i, j) for g in range(0, len(s), 3) for i, j in ((g, g + 1), (g, g + 2), (g + 1, g + 2)) if 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j])]
    assert len(pairs) > 800
    comp = union_find(range(len(s)), pairs)
    assert {r["doc_id"]: r["component_id"] for r in joined(frame(documents(texts), SCHEMA), 5, 80).collect()} == comp


def test_jaccard_traversal_loses_no_pair():
    rng = np.random.default_rng(0)
    sets = []
    for i in range(60):
        base = np.unique(rng.integers(0, 2**63, rng.integers(1, 400)).astype(np.uint64))
        sets += [base, base[rng.random(len(base)) > 0.06], np.unique(np.concatenate((base, base[:5] + np.uint64(1))))]
    sets = sorted((s for s in sets if len(s)), key=len)
    size, comp = np.array([len(s) for s in sets]), np.arange(len(sets))
    packed = [jaccard.bitmap(s) for s in sets]
    words_ = min(map(len, packed)) // 8
    tree = jaccard.Tree(size, np.stack([jaccard.folded(x, words_) for x in packed]), [jaccard.parity(s) for s in sets], comp)
    found = set(zip(*(x.tolist() for x in jaccard.traverse(tree, tree, True, 85))))
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            c = len(np.intersect1d(sets[i], sets[j]))
            if 100 * c >= 85 * (len(sets[i]) + len(sets[j]) - c):
                assert (i, j) in found


def test_suffix_repeats(frame):
    rng = random.Random(2)
    fresh = lambda n: ["x%d" % rng.randrange(10**9) for _ in range(n)]
    passage, shorter = fresh(70), fresh(45)
    texts = [" ".join(fresh(30) + passage + fresh(10)), " ".join(passage + fresh(80)), "\n".join(fresh(200) + passage).upper(), " ".join(fresh(20) + shorter), " ".join(shorter + fresh(20))]
    whole = " ".join(fresh(90))
    texts += [whole, whole, "", None, "a short text", " ".join(fresh(500))]
    rows = [(r["doc_id"], r["start"], r["n_words"], r["match_doc_id"], r["match_start"]) for r in repeats(frame(documents(texts) + [(6, whole, None, None, None), (None, whole, None, None, None)], SCHEMA)).collect()]
    assert {r[0] for r in rows} == {0, 1, 2, 5, 6}
    starts = {0: 30, 1: 0, 2: 200}
    for d, s in starts.items():
        mine = [r for r in rows if r[0] == d]
        assert mine and all(r[1:3] == (s, 70) and r[4] == starts[r[3]] and r[3] != d for r in mine)
    assert {r for r in rows if r[0] in (5, 6)} == {(5, 0, 90, 6, 0), (6, 0, 90, 5, 0)}
    assert repeats(frame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        repeats(frame([], SCHEMA), min_words=20)


def test_suffix_no_repeated_window_stays_uncovered(frame):
    rng = random.Random(11)
    vocabulary = ["v%d" % i for i in range(500)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = []
    for _ in range(6):
        # texts share 40 words with all, and what is before or after them with one other
        core, tails = draw(40), [draw(30) for _ in range(4)]
        for head in (draw(30) for _ in range(6)):
            for _ in range(2):
                texts.append(" ".join(draw(20) + head[rng.randrange(10, 22) :] + core + rng.choice(tails)[: rng.randrange(12)] + draw(20)))
    texts += ["q " * 300, "q " * 200 + "z"]
    # a passage that begins within a run and goes on after it
    after = draw(20)
    texts[:0] = [" ".join(draw(9) + ["r"] * k + after[:n] + draw(30)) for k, n in ((30, 20), (60, 20), (45, 8), (90, 8), (41, 12))]
    where = {}
    for d, t in enumerate(texts):
        w = words(t)
        for i in range(len(w) - 49):
            where.setdefault(tuple(w[i : i + 50]), []).append((d, i))
    rows = repeats(frame(documents(texts), SCHEMA)).collect()
    assert len(rows) == len(set(rows))
    covered = {}
    for r in rows:
        w, o = words(texts[r["doc_id"]]), words(texts[r["match_doc_id"]])
        assert r["n_words"] >= 50 and w[r["start"] : r["start"] + r["n_words"]] == o[r["match_start"] : r["match_start"] + r["n_words"]]
        covered.setdefault(r["doc_id"], []).append((r["start"], r["start"] + r["n_words"]))
    again = [(d, i) for window, at in where.items() if len(at) > 1 and len(set(window)) > 1 for d, i in at]
    assert len(again) > 50
    assert [x for x in again if not any(a <= x[1] and x[1] + 50 <= b for a, b in covered.get(x[0], []))] == []
    assert {r["match_doc_id"] for r in rows if r["doc_id"] == len(texts) - 2} == {len(texts) - 1}


def test_suffix_one_passage_in_every_document(frame):
    rng = random.Random(4)
    fresh = lambda n: ["y%d" % rng.randrange(10**9) for _ in range(n)]
    passage = fresh(55)
    texts = [" ".join(fresh(rng.randrange(60)) + passage + fresh(rng.randrange(60))) for _ in range(80)]
    rows = repeats(frame(documents(texts), SCHEMA)).collect()
    assert {r["doc_id"] for r in rows} == set(range(80))
    assert all(texts[r["doc_id"]].split()[r["start"] :][:55] == passage and r["n_words"] == 55 for r in rows)


def brute_lines(texts):
    from hashlib import md5

    chunks = []
    for t in texts:
        lines, cur, mine, roll, before, fell = (t.split("\n") if t is not None else []), [], [], -1, 0, False
        for i, x in enumerate(lines):
            h = int(md5(x.encode()).hexdigest()[:8], 16)
            now = (31 * before + h) % 4294967291
            falls = now < roll
            cur.append(x)
            if falls and not fell and i != len(lines) - 2:
                mine.append(cur)
                cur = []
            roll, before, fell = now, h, falls
        chunks.append(mine + ([cur] if cur else []))
    assert all(len(c) > 1 for mine in chunks if len(mine) > 1 for c in mine)
    seen, out = set(), []
    for t, mine in zip(texts, chunks):
        kept, gone = [], 0
        for c in mine:
            if len(c) > 1 and tuple(c) in seen:
                gone += 1
            else:
                kept += c
            seen.add(tuple(c))
        out.append((None if t is None else "\n".join(kept), len(mine), gone))
    return out


def test_line_dedup_matches_plain_python(frame):
    rng = random.Random(7)
    shared = ["line %d of a shared passage" % i for i in range(12)]
    texts = []
    for i in range(50):
        own = [rng.choice(["", " lead", "a\x00b", "own %d" % rng.randrange(10**6)]) for _ in range(rng.randrange(8))]
        texts.append("\n".join(own + (shared if i % 3 == 0 else []) + own[:3]))
    texts += ["", None, "\n", "\n\n", "x\n" * 400, " \n  \n", shared[0]]
    docs = frame(documents(texts), SCHEMA)
    got = {r["doc_id"]: (r["text"], r["n_chunks"], r["n_removed"]) for r in line_deduped(docs).collect()}
    want = brute_lines(texts)
    assert [got[i] for i in range(len(texts))] == want and sum(w[2] for w in want) > 10
    assert all(r[0] == r[1] for r in docs.where("text is not null").select(decoded(chunk_array()), "text").collect())
    clash = line_deduped(docs.selectExpr("doc_id", "text", "1 as n_removed", "'k' as `_at`"))
    assert clash.columns == ["doc_id", "text", "_at", "n_chunks", "n_removed"]
    assert line_deduped(frame([], SCHEMA)).count() == 0
    nulls = line_deduped(frame([(None, "a\nb\nc\nd\ne\nf\ng\nh", None, None, None)] * 2, SCHEMA)).collect()
    assert len(nulls) == 2 and all(r["n_removed"] == 0 for r in nulls)


def test_line_dedup_removes_what_repeats(frame):
    """By a search for repeated lines that does not know the chunks."""
    rng = random.Random(11)
    fresh = lambda n: ["own line %d" % rng.randrange(10**9) for _ in range(n)]
    passage = ["line %d of a shared passage" % i for i in range(40)]
    whole = "\n".join(fresh(9))
    texts = ["\n".join(fresh(rng.randrange(30)) + passage + fresh(rng.randrange(30))) for _ in range(30)] + [whole] * 5
    got = {r["doc_id"]: r["text"] for r in line_deduped(frame(documents(texts), SCHEMA)).collect()}
    lines = lambda i: set(got[i].split("\n"))
    for i, t in enumerate(texts):
        own = set(t.split("\n")) - set(passage)
        assert own <= lines(i) if i <= 30 else got[i] == ""  # lines of one document stay, copies of a text go whole
    assert set(passage) <= lines(0)
    left = [len(set(passage) & lines(i)) for i in range(1, 30)]
    assert max(left) <= 20 and sum(left) <= 29 * 6  # at the passage's ends only


def page(body, head="", host="a.example.org", n=0):
    return (n, f"https://{host}/p/{n}", f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>")


ARTICLE = """<header><a href="/">Site</a></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">Cookies</div>
<article class="post"><header><h1>Big&nbsp;news &amp; more</h1></header><p>One <b>two<br>three</b>.<p class=x>Four&#33; &lt;5<script>if (a<b) "</p>"</script>
<div class="advert">Buy</div><form><input value=1><button>Go</button></form><ul><li>six<li>seven</ul><aside>Side</aside></article>
<section id="comments"><article class="comment">Nice!</article></section><footer>&copy; Site</footer>"""


def test_main_text_of_a_marked_article(frame):
    rows = [page(ARTICLE), (1, None, None), (2, "x", ""), (3, "http://h/", "<p>just <i>te</i>xt <a href='un"), (4, "http://h/", "no markup &eacute;")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in extracted(frame(rows, "page_id long, url string, html string")).collect()}
    text = "Big news & more One two three. Four! <5 six seven"
    assert got == {0: (text, len(text)), 1: ("", 0), 2: ("", 0), 3: ("just text", 9), 4: ("no markup é", 11)}


BODY = "<p>Some words of the story.</p><p>And some more of it.</p>"
STORY = "Some words of the story. And some more of it."


@pytest.mark.parametrize(
    "body,want",
    [
        (f"<div class='content with-sidebar'>{BODY}</div><p>x</p>", f"{STORY} x"),
        (f"<div class='no-sidebar has-comments'>{BODY}</div><p>{'long ' * 99}</p>", f"{STORY} {'long ' * 98}long"),
        (f"<article class='post social'>{BODY}</article><p>{'long ' * 99}</p>", STORY),
        (f"<div class='page notice'><article>{BODY}</article></div>", STORY),
        (f"<div class='header fixed'><article>{BODY}</article></div>", STORY),
        (f"<div class='layout sidebar'><div class='post-content share' itemprop=articleBody>{BODY}<div class='share'>Share</div></div></div>", STORY),
        (f"<div id=page class='widget'><p>One</p>{BODY}<div class=advert>Buy</div></div>", f"One {STORY}"),
        # what readers and other articles say stays out beside a marked article, however long
        (f"<article>{BODY}</article><section id=comments><article class=comment>{'Nice. ' * 99}</article></section>", STORY),
        (f"<main><article>{BODY}</article><div class='related'><article>{'More. ' * 99}</article></div></main>", STORY),
        (f"<div class='cookie-notice'>Cookies</div>{BODY}<div class='sidebar'><article>Other</article></div>", STORY),
    ],
)
def test_a_class_word_does_not_drop_the_article(body, want):
    segments, _ = Page(page(body)[2]).read()
    assert " ".join("".join(t for _, t in segments).split()) == want


def test_templates_recur_on_a_host(frame):
    def body(i):
        return f"<div class=w1><div>Read our terms</div><div>Hello reader</div></div><div><p>Story {i} tells of {i * 7}.</p><p>A quoted line.</p></div>" if i else "<div>Hello reader</div><p>Alone</p>"

    rows = [page(body(i), n=i) for i in range(1, 12)] + [page(body(3), host="b.example.org", n=50)]
    got = {r["page_id"]: r["text"] for r in extracted(frame(rows * 2, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story 3 tells of 21." and got[11] == "Story 11 tells of 77."
    assert got[50] == "Read our terms Hello reader Story 3 tells of 21. A quoted line."
    copies = [page("<div><p>All the same page</p><p>in copies</p></div>", n=i) for i in range(20)]
    assert {r["text"] for r in extracted(frame(copies, "page_id long, url string, html string")).collect()} == {"All the same page in copies"}
    marked = [page(f"<article><p>Shared words.</p><p>Own {i} {i * i}</p><div>Follow us</div></article>", n=i) for i in range(10)]
    assert {r["page_id"]: r["text"] for r in extracted(frame(marked, "page_id long, url string, html string")).collect()}[4] == "Shared words. Own 4 16"
    assert extracted(frame([], "page_id long, url string, html string")).count() == 0


def test_templates_of_a_part_of_a_large_host(frame):
    def body(i):
        return f"<div><p>Story {i} tells of {i * 7} and of {i * i} more things.</p><p>{'A quoted line.' if i % 4 == 0 else 'None.'}</p></div><div>Advert {i % 4}</div>" + ("<ul><li>Of the section</ul>" if i % 5 == 0 else "")

    rows = [page(body(i), n=i) for i in range(300)] + [page(body(i), host="b.example.org", n=1000 + i) for i in range(40, 180)]
    got = {r["page_id"]: r["text"] for r in extracted(frame(rows, "page_id long, url string, html string")).collect()}
    for i in range(300):
        assert got[i] == f"Story {i} tells of {i * 7} and of {i * i} more things." + (" A quoted line." if i % 4 == 0 else "")
    # 35 and 28 of 140 pages
    assert got[1040] == "Story 40 tells of 280 and of 1600 more things. A quoted line. Advert 0 Of the section"


def test_odd_markup_does_not_crash():
    for source in ("<", "<p", "</p></div>", "<!--", "<!-- a -->x", "<script>", "<b><i>x</b>y</i>", "<td>a<td>b", '<p class="a>b">t</p>', "<p a='>" * 200, "<div>" * 3000 + "deep" + "</div>" * 10, "\x00&#0;&#xFFFFFF;&bogus;"):
        segments, hashes = Page(source).read()
        assert isinstance(segments, list) and isinstance(hashes, list)
    assert host_of("HTTP://u:p@Ex.org:80/x?y") == "ex.org" and host_of(None) == "" and host_of("junk") == ""
