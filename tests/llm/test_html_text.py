import random

import numpy as np

from tabspark.llm import html_text as ht


def test_blocks():
    page = """<!DOCTYPE html><html class="has-sidebar"><head><title>T</title><style>p{}</style></head><body class="menu-open"><header><h1>Site</h1></header>
      <nav><ul><li><a href="/a>b">Home</a></ul></nav><!-- <p>no --><div class="ad">Buy</div><article><header><h1>A &amp; b&nbsp;c</h1></header><p>One <b>two<br>three
      <p class="share">Share</p><p>x &lt; y &am &copy 5 &#233;</p><script>var t="</p><p>no";</script><aside>side</aside><div class='comments'><article><p>me too</p></article></div>
      </article><div id="x"><p>open</p></div><form>q</form><footer>f</footer>"""
    assert [t for r, t in ht.blocks(page) if r == ht.CONTENT] == ["A & b c", "One two three", "x < y &am © 5 é"]
    assert [t for r, t in ht.blocks(page) if r == ht.OPEN] == ["open"]
    assert ht.blocks(None) == ht.blocks("") == [] and ht.blocks("a < b <!-- x") == [(ht.OPEN, "a < b")]
    assert ht.blocks("<p " + "a='" * 5000) and ht.blocks("<" * 20000)


def brute(streams, length):
    where = {}
    for k, s in enumerate(streams):
        for i in range(len(s) - length + 1):
            where.setdefault(tuple(s[i : i + length]), set()).add(k)
    out = []
    for s in streams:
        mark = [False] * len(s)
        for i in range(len(s) - length + 1):
            if len(where[tuple(s[i : i + length])]) > 1:
                mark[i : i + length] = [True] * length
        out.append(mark)
    return out


def test_cover_matches_brute_force():
    r = random.Random(3)
    for _ in range(60):
        streams = [np.array([r.randrange(3) for _ in range(r.randint(0, 40))], np.int64) for _ in range(r.randint(1, 6))]
        for length in (1, 3, 5, 8):
            want = brute([s.tolist() for s in streams], length)
            assert [m.tolist() for m in ht.covered(streams, np.empty(0, np.int64), length)] == want
            shared = np.unique(np.concatenate([ht.windows(s, length) for s in streams[::2]] or [np.empty(0, np.int64)]))
            one = [m.tolist() for m in ht.covered(streams[:1], shared, length)]
            assert one == [[len(streams[0]) >= length] * len(streams[0])]


def site(r, n, host):
    words = lambda k: " ".join(f"w{r.randrange(3000)}" for _ in range(k))
    out, want = [], []
    top, low = words(12), words(15)
    for i in range(n):
        body = [words(r.randint(3, 40)) for _ in range(3)]
        out.append((len(out), f"http://{host}/{i}", f"<div>{top}</div>" + "".join(f"<p>{b}</p>" for b in body) + f"<div>{low}</div>", 1))
        want.append("\n".join(body))
    return out, want


def test_repeated_runs_go_and_shards_agree(spark, monkeypatch):
    r = random.Random(4)
    rows, want = site(r, 30, "a.org")
    rows += [(100, "http://b.org/1", "<article><p>same text of an article on two pages of one host</p></article>", 1), (101, "http://b.org/2", "<article><p>same text of an article on two pages of one host</p></article>", 1)]
    rows += [(102, None, None, 1), (None, "http://[bad", "<p>x</p>", 1), (103, "http://c.org/1", rows[0][2], 1), (103, "http://c.org/1", rows[0][2], 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    for shard in (10**6, 300):
        monkeypatch.setattr(ht, "SHARD", shard)
        got = {(x.page_id, x.url): x for x in ht.extract(df).collect()}
        assert [got[i, f"http://a.org/{i}"].text for i in range(30)] == want
        assert got[100, "http://b.org/1"].text == got[101, "http://b.org/2"].text == "same text of an article on two pages of one host"
        assert got[102, None].text == "" and got[None, "http://[bad"].text == "x" and got[103, "http://c.org/1"].n_chars == len(got[103, "http://c.org/1"].text) > len(want[0])
    assert ht.extract(df.limit(0)).count() == 0


def test_articles_inside_layout_containers():
    content = lambda page: [t for r, t in ht.blocks(page) if r == ht.CONTENT]
    body = "<h1 class='entry-header'>Title</h1><p>one</p>"
    for name in ("layout has-sidebar", "no-header", "page with-menu"):
        for open_, close in (("<article>", "</article>"), ("<main>", "</main>"), ("<div role=main>", "</div>")):
            page = f"<div class='{name}'><p>before</p><nav>nav</nav>{open_}{body}{close}<p>after</p></div>"
            assert content(page) == ["Title", "one"] and not [t for r, t in ht.blocks(page) if r == ht.OPEN]
    assert content(f"<body><form id=aspnetForm><div>q</div><article>{body}</article><input></form></body>") == ["Title", "one"]
    assert content(f"<form><div class='has-sidebar'><main>{body}</main></div></form>") == ["Title", "one"]
    assert content(f"<article class='post no-sidebar'><header class='entry-header'>{body}</header></article>") == ["Title", "one"]
    for bad in ("<nav>", "<aside>", "<div class='sidebar'>", "<div id=comments>", "<div hidden>"):
        assert content(f"{bad}<article>{body}</article>") == content(f"<form>{bad}<article>{body}</article>") == []
    assert content(f"<article>{body}<div class='related-posts'><article>teaser</article></div><h2 hidden>no</h2></article>") == ["Title", "one"]
    assert content("<div class='has-sidebar'><p>side</p></div><form>q</form>") == []


def test_empty_svg_and_math():
    texts = lambda page: [t for _, t in ht.blocks(page)]
    assert texts("<p>one <svg class=\"i\"/> two</p><p>three</p><math/><p>four <svg a='>' />five</p>") == ["one two", "three", "four five"]
    assert texts("<p>one <svg class=\"a/\"><text>no</text></svg> two</p><svg><path d='x'/><text>no") == ["one two"]
    assert texts("<p>one</p><script src='a'/>no</script><p>two</p>") == ["one", "two"]


def test_near_copies_keep_their_text(spark, monkeypatch):
    r = random.Random(9)
    some = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    rows, want = site(r, 20, "a.org")
    body = [some(r.randint(20, 60)) for _ in range(5)]
    page = lambda more: "".join(f"<p>{b}</p>" for b in more)
    copies = [body, [*body, "Reprinted 3 May"], ["A note by the editor", *body], [*body[:2], "2024", *body[2:]]]
    for host in ("b.org", "a.org"):  # alone on their host, and among pages that share other runs
        rows += [(200 + len(rows), f"http://{host}/copy{k}", page(c), 1) for k, c in enumerate(copies)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    for shard in (10**6, 300):
        monkeypatch.setattr(ht, "SHARD", shard)
        got = {x.url: x.text for x in ht.extract(df).collect()}
        assert [got[f"http://a.org/{i}"] for i in range(20)] == want
        assert all(got[f"http://{h}/copy{k}"] == "\n".join(c) for h in ("a.org", "b.org") for k, c in enumerate(copies))


def test_cover_counts_other_groups_only():
    one = np.arange(1, 20)
    marks = ht.covered([one, one, np.arange(5, 15)], np.empty(0, np.int64), 8, np.array([7, 7, 3]))
    assert [np.flatnonzero(m).tolist() for m in marks] == [list(range(4, 14)), list(range(4, 14)), list(range(10))]
    assert not ht.covered([one, one], np.empty(0, np.int64), 8, np.array([7, 7]))[0].any()


def test_copies_are_found_behind_an_unlike_least_page(spark):
    """Links of pages by brute force against the copy groups, on hosts whose pages share bands with a least
    page that they are unlike."""
    import itertools

    r = random.Random(3)
    rows, want_links, pages = [], 0, {}
    for host in range(25):
        base = [" ".join(f"t{r.randrange(10**6)}" for _ in range(r.randint(5, 9))) for _ in range(40)]
        for k in range(25):
            mine = list(base)
            for at in r.sample(range(40), r.randint(0, 9)):
                mine[at] = " ".join(f"t{r.randrange(10**6)}" for _ in range(r.randint(5, 9)))
            pages[host, k] = mine
            rows.append((f"http://h{host}.org/{k}", "".join(f"<p>{b}</p>" for b in mine)))
    df = spark.createDataFrame(rows, "url string, html string").selectExpr("url AS page", "url", "html")
    streams = ht._streams(df)
    group = {x.page: x.copies for x in ht._copies(streams).collect()}
    together = 0
    for host in range(25):
        for a, b in itertools.combinations(range(25), 2):
            size = lambda x: sum(len(t.split()) for t in x)
            common = size(set(pages[host, a]) & set(pages[host, b]))
            if 100 * common >= 80 * (size(pages[host, a]) + size(pages[host, b]) - common):
                want_links += 1
                one, two = (f"http://h{host}.org/{k}" for k in (a, b))
                together += group.get(one, one) == group.get(two, two)
    assert want_links > 500 and together >= 0.999 * want_links
