import random
from collections import Counter

from candlewright.llm import template as op


def site(rng, n, words, article="article", extra=True):
    """Pages of one template with the text that is their article."""
    out = []
    for i in range(n):
        say = lambda k: " ".join(rng.choices(words, k=k))
        paragraphs = [say(rng.randrange(5, 40)) for _ in range(rng.randrange(1, 6))]
        title = say(5)
        opened, closed = ("<article>", "</article>") if article == "article" else (f'<div class="{article}">', "</div>")
        body = "".join(f"<p>{'<b>' * (j % 2)}{p.replace('&', '&amp;')}{'</b>' * (j % 2)}</p>\n" for j, p in enumerate(paragraphs))
        inner = '<div class="share">Share this with friends</div><p>Subscribe to our letter today</p>' if extra else ""
        comments = f"<section id='comments'><p>{say(9)}</p></section>" if i % 2 else ""
        html = (
            f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{x:'<p>'}}</style><script>if (a<b) '</p>';</script></head><body>"
            f"<header>Our site</header><nav><ul>{''.join(f'<li><a href=/{k}>{say(1)}</a>' for k in range(i % 4))}</ul></nav><!-- <p>no</p> -->"
            f'<div class="cookie-notice">We use cookies</div>{opened}<h1>{title}</h1>{body}{inner}{comments}{closed}'
            f"<aside><p>{say(12)}</p></aside><form><label>Mail</label><input name=q></form><footer>&copy; {say(4)}</footer>"
        )
        out.append((html + "</body></html>" * (i % 3 > 0), " ".join([title, *paragraphs])))
    return out


WORDS = ["été", "walk", "R&D", "a", "the", "naïve", "<tag>".replace("<", "‹").replace(">", "›"), "x1", "straße", "猫"] + [f"w{i}" for i in range(60)]


def test_articles_of_a_site():
    rng = random.Random(1)
    for kind in ("article", "post"):
        pages = site(rng, 20, WORDS, kind)
        assert op.extract([h for h, _ in pages]) == [t for _, t in pages]


def test_few_pages_keep_their_words():
    rng = random.Random(2)
    pages = site(rng, 1, WORDS, extra=False)
    assert op.extract([pages[0][0]] * 30) == [pages[0][1]] * 30


def test_classes_are_ordered_and_nested():
    pages = [op.read(f"<html><body><h1>t{i}</h1><ul>{'<li>x</li>' * (i + 1)}</ul></body></html>") for i in range(4)]
    valid = op.classes(pages)
    root = next(c for c in valid if ("<", "body", "html") in c)
    assert [r[1] for r in root] == ["html", "body", "h1", "h1", "ul", "ul", "body", "html"]
    nested = op.nest(valid, pages)
    items = next(n for n in nested if n[0][0][1] == "li")
    assert items[1] is not None and nested[items[1]][0] == root and items[2] == 5


def test_page_without_article_mark():
    menu = "<ul>" + "".join(f"<li><a href=/{i}>entry {i}</a></li>" for i in range(5)) + "</ul>"
    assert op.extract([f"<body><div>{menu}</div><div><p>One  story.<br>It goes&nbsp;on</p></div></body>"]) == ["One story. It goes on"]


def test_names_of_what_surrounds():
    around = "".join(f'<div class="{name}"><p>{name} words</p></div>' for name in ("side-bar", "reader-comments", "ad-slot", "site_notice", "main-nav", "share"))
    kept = '<div class="lead-text"><p>Kept words</p></div>'
    assert op.extract([f"<article><h1>Title</h1>{around}{kept}</article>"]) == ["Title Kept words"]


def test_broken_markup():
    assert op.extract(["", "no markup at all", "<", "a < b", "<article><p>open", "<article><p><b>one.<br><p>two <i>three</article>tail<script>x", "<p" * 50, "<!-- x"]) == [
        "", "no markup at all", "<", "a < b", "open", "one. two three", op.extract(["<p" * 50])[0], "",
    ]


def articles(seed, n=64, wrap=("<article>", "</article>"), end="", short="It was."):
    """Pages with one short sentence twice at any place, and the text of each."""
    rng = random.Random(seed)
    common = ["it", "was", "and", "the"] + [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        said = [" ".join(rng.choices(common, k=rng.randrange(5, 40))) for _ in range(rng.randrange(3, 8))]
        for _ in range(2):
            said.insert(rng.randrange(len(said) + 1), short)
        body = f"<h1>title {i}</h1>" + "".join(f"<p>{p}</p>" for p in said)
        out.append((f"<html><body><nav><a href=/>Home</a></nav>{wrap[0]}{body}{end}{wrap[1]}<footer>x</footer></body></html>", " ".join([f"title {i}", *said])))
    return out


def test_short_sentences_of_many_articles_stay():
    pages = articles(4)
    assert op.extract([h for h, _ in pages]) == [t for _, t in pages]


def test_names_around_an_article_say_nothing_about_it():
    for name in ("content-sidebar-wrap", "layout has-sidebar", "post comments-open", "entry ad-free"):
        pages = articles(5, 12, (f'<div class="{name}"><main><article>', "</article></main></div>"))
        assert op.extract([h for h, _ in pages]) == [t for _, t in pages]
        inner = '<article><p>Story.</p><div class="comments"><article><p>I think so</p></article></div></article>'
        assert op.extract([f'<div class="{name}">{inner}</div>']) == ["Story."]


def test_repeated_invitation_goes_whatever_other_pages_are():
    pages = articles(6, end="<p>Subscribe to our letter now</p>")
    odd = ["", "<html><body><div>other layout</div></body></html>", "no markup"]
    for more in (odd[:0], odd[:1], odd):
        got = op.extract([h for h, _ in pages] + more)
        assert got[:64] == [t for _, t in pages]
        assert got[64:] == ["", "other layout", "no markup"][: len(more)]


def test_slots_between_tag_classes_choose_the_text(monkeypatch):
    rng = random.Random(7)
    say = lambda k: " ".join(f"v{rng.randrange(90)}" for _ in range(k))
    pages = [
        (h.replace("@", "<div class=a><ul>" + "".join(f"<li>{say(4)}</li>" for _ in range(5)) + "</ul></div>").replace("%", f"<div class=c><p>{say(6)}</p></div>"), t)
        for h, t in articles(8, wrap=("@<div class=b>", "</div>%"))
    ]
    assert op.extract([h for h, _ in pages]) == [t for _, t in pages]
    monkeypatch.setattr(op, "classes", lambda *_: [])
    assert all(got != t for got, (_, t) in zip(op.extract([h for h, _ in pages]), pages))


def test_copies_of_an_article_are_not_its_template():
    (page, text), *_ = articles(9, 1)
    copies = [page.replace("Home", f"Home {i}") for i in range(40)]
    assert op.extract(copies) == [text] * 40


def test_classes_same_as_brute_force():
    rng = random.Random(10)
    for _ in range(20):
        shapes = ["<i1>".replace("i1", name) for name in ("h1", "ul", "section", "table")]
        pages = [op.read("<body>" + "".join(s + "x" + s.replace("<", "</") for s in shapes[: rng.randrange(2, 5)]) + f"<p>a{rng.randrange(3)}</p></body>") for _ in range(10)]
        roles = {role for page in pages for role, _ in page.tokens}
        vector = {role: tuple(sum(role == other for other, _ in page.tokens) for page in pages) for role in roles}
        often = {role for role in roles if sum(map(bool, vector[role])) >= (op.WORD_PAGES if role[0] == "b" else 5)}
        want = Counter(vector[role] for role in often)
        got = op.classes(pages)
        assert all(len({vector[role] for role in c}) == 1 for c in got)
        assert all(want[vector[c[0]]] == len(c) for c in got) and {r for c in got for r in c} <= often
        for c in got:
            for page in pages:
                order = [role for role, _ in page.tokens if role in set(c)]
                assert order == c * (len(order) // len(c))


def test_query_on_edge_cases(spark):
    rng = random.Random(3)
    pages = site(rng, 150, WORDS)
    rows = [(i, "http://hot.example/%d" % i, h) for i, (h, _) in enumerate(pages)]
    rows += [(900, None, pages[0][0]), (None, "x", pages[1][0]), (901, "http://one.example", None), (3, rows[3][1], rows[3][2]), (902, "https://ONE.example/b?c", "<article>" + "long " * 50_000 + "</article>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", op.F.lit(1)).withColumn("text", op.F.lit("x"))
    found = op.main_texts(frame).collect()
    want = {i: t for i, (_, t) in enumerate(pages)} | {900: pages[0][1], None: pages[1][1], 901: "", 902: ("long " * 50_000).strip()}
    assert len(found) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    texts = {r["page_id"]: r["text"] for r in found}
    same = {i for i in want if texts[i] == want[i]}
    lonely = {900, None}  # one-page groups cannot know that the invitation belongs to the template
    assert same >= set(want) - lonely
    assert all(texts[i].startswith(want[i]) for i in lonely)
    assert op.main_texts(frame.limit(0)).count() == 0
