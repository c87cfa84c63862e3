"""Web pages and conversations."""

import itertools
import random
import re
import time

import duckdb
import pytest

from genoweave.llm import html_text, quotations, registry

P = html_text.WrapperParams()


def page(i, body, menu="<li><a href=/a>A</a><li><a href=/b>B</a>"):
    return (
        f"<!DOCTYPE html><html><head><title>t{i}</title><style>p{{}}</style><script>if(1<2)x('</p>')</script></head><body><div class='site-head'><h2>My site</h2></div><div id=nav class=topnav><ul>{menu}</ul></div>"
        f"<div class='wrap'><div class='promo box'>Buy {i}!</div><div class=story>{body}</div><div class='comments'><p>first {i}</p></div><form><input name=q><button>Go</button></form></div><div class=bottom>Made by us</div>"
    )


def texts(spark, pages, params=P, partitions=3):
    d = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(pages)], "page_id long, url string, html string").repartition(partitions)
    return [r["text"] for r in sorted(html_text.extract_text(d, params).collect())]


def test_story_without_landmarks(spark):
    pages = [page(i, f"<h1>Title {i}</h1><p>Some &amp; words&nbsp;of {i}<br>more <b>bold</b>ly<p>Second   para\n{i} with <a href=x>link</a>.<ul><li>one{i}<li>two</ul>") for i in range(8)]
    want = [["Title {}", "Some & words of {} more boldly", "Second para {} with link.", "one{}"] for _ in pages]
    assert texts(spark, pages) == ["\n".join(w).replace("{}", str(i)) for i, w in enumerate(want)]  # "two" is on every page


PLAIN = "<div class=x7><div class=q{i}>Our notice to all readers, who read it on each page of ours, again and again.</div><div><h2>Story {i}</h2><p>{a}</p><p>Follow us on paper.</p><div><p>{b}</p></div></div><div><p>One more of our lines.</p><div>tel. 123</div></div></div>"


def test_wrapper_decides_without_landmarks_and_names(spark):
    """Fixed text goes whatever its tag; without the wrapper it would stay."""
    pages = [PLAIN.format(i=i, a=f"What happened {i} " * (3 + i), b=f"More of it {i * i}.") for i in range(9)]
    want = [f"Story {i}\n" + " ".join([f"What happened {i}"] * (3 + i)) + f"\nMore of it {i * i}." for i in range(9)]
    found = texts(spark, pages)
    assert found == want
    assert all(html_text.main_text(h, None) != t for h, t in zip(pages, want))
    assert "Follow us" in html_text.main_text(pages[0], None)
    for other in (texts(spark, pages, partitions=1), texts(spark, pages, partitions=9), texts(spark, pages, html_text.WrapperParams(broadcast_bytes=0, broadcast_rows=0, salts=2)), texts(spark, pages, html_text.WrapperParams(entries=2))):
        assert other == want
    # fewer aligned pages than there are, or lists aligned by their keys, change nothing here
    assert texts(spark, pages, html_text.WrapperParams(tree_pages=2)) == texts(spark, pages, html_text.WrapperParams(cells=0)) == want


def test_copies_are_no_template(spark):
    one = "<html><body><div><p>The very same story, told once.</p></div></body></html>"
    assert texts(spark, [one] * 9) == ["The very same story, told once."] * 9


def test_names_are_hints():
    p = '<html><body><div class="article-share-story"><p>real text</p></div></body></html>'
    assert html_text.main_text(p, None) == "real text"
    p = '<body><div class="share story"><p>real text, and a lot of it</p><div class="ad">buy</div><div class="comments"><p>me too</p></div></div>'
    assert html_text.main_text(p, None) == "real text, and a lot of it"


def test_article_and_tags_left_open():
    p = '<html><body><nav><a>x</a></nav><article><header><h1>H</h1></header><p>a long first paragraph<p>b<div class="ad">no</div><aside>no</aside><p>c &lt;d&gt; &#233;<!-- no --></article><footer>f</footer>'
    assert html_text.main_text(p, None) == "H\na long first paragraph\nb\nc <d> é"
    assert html_text.main_text("", None) == html_text.main_text(None, None) == ""
    assert html_text.main_text("just text", None) == "just text"
    assert html_text.main_text("<div", None) == "" and html_text.main_text("<<<>>>&&", None) == "<<<>>>&&"
    assert html_text.main_text("a < b <p title='x>y'>c</p><p title='x>z<p>d", None) == "a < b\nc\nz\nd"
    assert html_text.main_text("<p>x<script>no</p>", None) == "x" and html_text.main_text("<p>x<style>no</style >y<SCRIPT>no</Script>z", None) == "xyz"


def test_odd_pages_take_linear_time():
    began = time.time()
    assert html_text.main_text("<div>" * 10_000 + "deep" + "</div>" * 10_000 + "tail", None) == "deep\ntail"
    assert html_text.main_text("text " + "<a " * 350_000, None) == "text"
    html_text.main_text("<a href='x" * 100_000 + ">", None)
    html_text.main_text("<p>x</p></q></r>" * 50_000, None)
    html_text.main_text("".join(f"<p>x<h{i % 5 + 1}>y{i}" for i in range(20_000)), None)
    both = html_text.merged([["#", [[str(i * 7 % 11), []] for i in range(3_000)]]], [["#", [[str(i * 5 % 13), []] for i in range(3_000)]]], P)
    assert len(both) == 1 and time.time() - began < 20


def tree_from(r, depth=0):
    return [r.choice("ab") if depth else "#", [tree_from(r, depth + 1) for _ in range(r.randrange(4) if depth < 3 else 0)]]


def most_pairs(a, b):
    """Brute force: tries every way to pair children in order."""
    if a[0] != b[0]:
        return 0
    best = 0
    for n in range(min(len(a[1]), len(b[1])) + 1):
        for x in itertools.combinations(a[1], n):
            for y in itertools.combinations(b[1], n):
                found = [most_pairs(p, q) for p, q in zip(x, y)]
                if all(found):
                    best = max(best, sum(found))
    return 1 + best


def test_tree_matching_finds_most_pairs(monkeypatch):
    r = random.Random(4)
    for _ in range(300):
        a, b = tree_from(r), tree_from(r)
        best = most_pairs(a, b)
        assert html_text.matches(a, b) == best
        paired = [(i, j) for i, j in html_text.by_weight(a[1], b[1]) if i is not None and j is not None]
        assert 1 + sum(most_pairs(a[1][i], b[1][j]) for i, j in paired) == best
        with monkeypatch.context() as m:
            m.setattr(html_text, "SMALL", 0)
            assert html_text.matches(a, b) <= best


def test_tree_matching_aligns_what_agrees():
    x, y = (html_text.tree_of([html_text.parse(s)], P) for s in ("<div><h1>a</h1><p>b</p><hr><table><tr><td>1</table></div>", "<div><p>b</p><ul><li>q</ul><table><tr><td>2</table></div>"))
    assert html_text.matches(x, y) == 6  # root, div, p, table, tr, td
    both = html_text.merged([x], [y], P)[0]
    assert [k[0] for k in both[1][0][1]] == ["h1", "p", "ul", "table"]


def test_pages_as_a_table(spark):
    rows = [(i, f"https://Host.example/{i}", page(i, f"<p>Text number {i} is here.")) for i in range(7)] + [(50, None, "<article>alone"), (51, "http://x.org", None), (51, "http://x.org", ""), (None, "//y.org/q", "<p>z")]
    d = spark.createDataFrame([(*r, "v", 1) for r in rows], "page_id long, url string, html string, host string, wrapper int")
    found = {(r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract_text(d).collect()}
    assert found == {(i, f"Text number {i} is here.", 22) for i in range(7)} | {(50, "alone", 5), (51, "", 0), (None, "z", 1)}
    assert html_text.extract_text(d.limit(0)).count() == 0
    salted = html_text.extract_text(d, html_text.WrapperParams(broadcast_bytes=0, entries=1))
    assert {(r["page_id"], r["text"], r["n_chars"]) for r in salted.collect()} == found


TALK = [
    (1, 0, "user", "Hello there.\nHow are you today?"), (1, 1, "assistant", "> Hello there.\n> how are  YOU today?\n\nFine, thanks."), (1, 2, "user", "Another thing."),
    (1, 3, "assistant", ">> Hello there.\n> Fine, thanks.\nSo be it."), (1, 4, "user", "> nobody said this\nwhat?"), (1, 5, "user", "> So be it.\n>> Hello there.\n> what?\nend"), (1, 5, "user", "> So be it.\nrepeat"),
    (2, 0, "user", None), (2, 1, None, "> Hello there."), (2, None, "user", "late"), (None, 3, "user", "x"), (None, 4, "user", "> x\ny"), (3, 300, "user", "first"), (3, 900, "user", "second\n> second"), (4, 0, "user", ""),
]


@pytest.fixture(scope="module")
def talk(spark):
    return spark.createDataFrame([(*r, 7, "z") for r in TALK], "conv_id long, turn long, role string, text string, c int, hash string")


def test_quotes_find_their_originals(talk):
    found = {(r["conv_id"], r["turn"], r["text"]): (r["reply_to"], r["quoted"], r["n_passages"], r["n_linked"], r["max_level"]) for r in quotations.link_quotes(talk).collect()}
    assert found[1, 1, "Fine, thanks."] == (0, True, 1, 1, 1)
    assert found[1, 3, "So be it."] == (1, True, 2, 2, 2)
    assert found[1, 4, "what?"] == (3, False, 1, 0, 1)
    assert found[1, 5, "end"][:2] == (3, True)
    assert found[2, 1, ""] == (0, False, 1, 0, 1)
    assert found[None, 4, "y"] == (3, True, 1, 1, 1)
    assert found[3, 900, "second"] == (300, False, 1, 0, 1)


def test_quotes_match_their_sql(talk):
    con = duckdb.connect()
    con.register("conversations", talk.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    key = lambda r: [repr(x) for x in r]
    ours = quotations.link_quotes(talk)
    columns = ", ".join(ours.columns)
    theirs = con.execute(f"SELECT {columns} FROM ({registry.OP7_SQL})").fetchall()
    assert sorted((tuple(r) for r in ours.collect()), key=key) == sorted(theirs, key=key)
    assert quotations.link_quotes(talk.limit(0)).count() == 0


def test_a_message_follows_what_it_replies_to(talk):
    rows = [r for r in quotations.link_quotes(talk, quotations.QuoteParams(turns_per_block=2)).collect() if r["conv_id"] == 1]
    place = {r["turn"]: r["position"] for r in rows}
    assert sorted(r["position"] for r in rows) == list(range(7))
    assert all(r["reply_to"] is None or place[r["reply_to"]] < r["position"] for r in rows)
    # 3 answers 1, 4 the one before, 5 quotes 3: 5 comes after 4, in a thread of its own; 2 after 1, and after it the thread of 3
    assert [(r["turn"], r["depth"], r["thread"]) for r in sorted(rows, key=lambda r: r["position"])] == [(0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 2, 1), (4, 3, 1), (5, 3, 2), (5, 3, 2)]


def brute_links(rows):
    """conv, turn, role, position, reply_to, depth, thread, quoted, n_passages, n_linked of (conv, turn, role, text)."""
    norm = lambda x: re.sub(r"[ \t\n\x0b\f\r]+", " ", x).strip(" ").lower()
    last = 2**63 - 1
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(((last if t is None else t), role, text or "") for c, t, role, text in rows if c == conv)
        told = []
        for o, role, text in own:
            passages = []
            for line in text.split("\n"):
                mark = re.match(r"[ \t]*(?:>[ \t]?)+", line)
                level, body = (mark[0].count(">"), line[mark.end() :]) if mark else (0, line)
                if passages and passages[-1][0] == level:
                    passages[-1][1].append(body)
                else:
                    passages.append((level, [body]))
            units = [(level, {u for u in [norm(" ".join(b)), *map(norm, b), *re.sub(r"([.!?]) ", r"\1\n", norm(" ".join(b))).split("\n")] if u}) for level, b in passages]
            told.append((o, role, text, units))
        first = {}
        for o, _, _, units in told:
            for level, us in units:
                if level == 0:
                    for u in us:
                        first[u] = min(first.get(u, o), o)
        turns = sorted({o for o, *_ in told})
        parent, said = {}, {}
        for k, turn in enumerate(turns):
            votes = {}
            for o, _, _, units in told:
                for level, us in units:
                    for u in us:
                        if o == turn and level == 1 and first.get(u, o) < o:
                            votes[first[u]] = votes.get(first[u], 0) + len(u)
            said[turn] = max(votes, key=lambda x: (votes[x], x)) if votes else None
            parent[turn] = said[turn] if votes else turns[k - 1] if k else None
        order, threads = [], 0

        def visit(turn, depth, thread):
            nonlocal threads
            order.append((turn, depth, thread))
            for n, kid in enumerate(t for t in turns if parent[t] == turn):
                if n:
                    threads += 1
                visit(kid, depth + 1, thread if not n else threads)

        visit(turns[0], 0, 0)
        place = {t: (k, d, th) for k, (t, d, th) in enumerate(order)}
        ranked = sorted(told, key=lambda x: (place[x[0]][0], x[1], x[2]))
        for k, (o, role, text, units) in enumerate(ranked):
            links = [any(first.get(u, o) < o for u in us) for level, us in units if level]
            p = parent[o]
            linked = sum(any(any(first.get(u, o) < o for u in us) for x in told if x[0] == o for m, (level, us) in enumerate(x[3]) if level and m == n) for n in range(max(len(x[3]) for x in told if x[0] == o)))
            out.append((conv, None if o == last else o, role, k, p if p != last else None, place[o][1], place[o][2], said[o] is not None, len(links), linked))
    return out


def test_generated_conversations_by_brute_force(spark):
    """Nested, partial and re-wrapped quotations."""
    r = random.Random(8)
    rows = []
    for conv in range(14):
        said = []
        for turn in range(r.randrange(1, 40)):
            parts = []
            for _ in range(r.randrange(3)):
                if said:
                    sentences = r.choice(said)
                    at = r.randrange(len(sentences))
                    words = " ".join(sentences[at : at + r.randrange(1, 4)]).split()
                    width, level = r.randrange(3, 12), r.choice((1, 1, 1, 2, 3))
                    quoted = [" ".join(words[i : i + width]) for i in range(0, len(words), width)]
                    parts += [">" * level + r.choice(("", " ")) + (q.upper() if r.random() < 0.2 else q) for q in quoted]
            mine = [f"{r.choice(['So', 'But', 'Well'])} {' '.join(f'w{r.randrange(50)}' for _ in range(r.randrange(3, 9)))}{r.choice('.!?')}" for _ in range(r.randrange(1, 5))]
            said.append(mine)
            parts.append(r.choice((" ", "\n")).join(mine))
            rows.append((conv, turn * r.choice((1, 1, 1)), r.choice(("user", "assistant")), "\n".join(parts)))
            if r.random() < 0.05:
                rows.append((conv, turn, "user", "once more\n> " + mine[0]))
    rows.append((3, None, "user", "the last"))
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = sorted(brute_links(rows), key=repr)
    assert max(w[6] for w in want) > 3 and sum(w[7] for w in want) > 50
    for params in (quotations.QuoteParams(), quotations.QuoteParams(turns_per_block=3)):
        found = quotations.link_quotes(d, params).drop("max_level", "text").collect()
        assert sorted((tuple(x) for x in found), key=repr) == want


def test_a_long_conversation_in_reply_order(spark):
    """A chain of 1,500 messages with one branch, deeper than any recursion."""
    rows = [(1, i, "user", f"m{i} says this." if i != 1_000 else "> m10 says this.\nback") for i in range(1_500)]
    found = sorted(quotations.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect(), key=lambda x: x["position"])
    assert [x["turn"] for x in found] == list(range(1_500))
    assert found[-1]["depth"] == 11 + 499 and found[999]["depth"] == 999 and found[-1]["thread"] == 1 and found[1_000]["reply_to"] == 10
