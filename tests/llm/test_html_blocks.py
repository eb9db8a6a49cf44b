import random

import pytest

from cuewright.llm import html_text
from cuewright.llm.html_text import Block, main_text

LONG = ("This is a long paragraph of the article that has all the words which are in a text like this, and it is about what they have said to us in the past years of work, "
        "so that it can be seen as the content of the page and of nothing else.")
P = f"<p>{LONG}</p>"
NAV, FOOT = '<nav><a href="/">Home</a> <a href="/b">About</a></nav>', "<footer>Imprint and contact</footer>"


@pytest.mark.parametrize("wrapper", [
    '<article data-title="The hidden valley">%s</article>', '<article aria-label="a hidden place">%s</article>', '<article data-class="sidebar">%s</article>', '<article data-id="menu">%s</article>',
    '<main title="style=display:none explained">%s</main>', '<div class="layout has-sidebar"><article>%s</article></div>', '<div class="container no-sidebar"><article>%s</article></div>',
    '<div class="post-content comments-open"><article>%s</article></div>', '<div class="entry-content share-on">%s</div>', '<div class="reply-guide">%s</div>', '<section class="search-theory"><article>%s</article></section>',
    '<form action="/x"><div>%s</div></form>', "<form><article>%s</article></form>", '<div class="sidebar"><article>%s</article></div>', '<div id="comments"><main>%s</main></div>', "<div data-x='a\" class=\"menu\"'>%s</div>",
    '<article class=story aria-hidden="false">%s</article>', '<div class="postContent">%s</div>', '<div class="tagsoup">%s</div>'])
def test_wrappers_do_not_hide_the_text(wrapper):
    assert main_text(f"<html><body>{NAV}{wrapper % P}{FOOT}</body></html>") == LONG


@pytest.mark.parametrize("wrapper", [
    '<div class="comments">%s</div>', '<div id="sidebar-left">%s</div>', '<div class="widget-area">%s</div>', '<div class="cookieBanner">%s</div>', '<div class="related-posts">%s</div>', '<section class="comments"><article>%s</article></section>',
    "<aside><article>%s</article></aside>", '<article class="comment">%s</article>', "<form>%s</form>", '<div hidden>%s</div>', '<div style="color:red; display: none">%s</div>', '<div role="navigation">%s</div>',
    '<div aria-hidden="true">%s</div>', '<div class="ad-300x250">%s</div>', '<div class="site-footer">%s</div>', "<div class='box promo'>%s</div>"])
def test_boilerplate_beside_an_article_stays_out(wrapper):
    other = wrapper % f"<p>{LONG.replace('article', 'notice')}</p>"
    assert main_text(f"<body>{NAV}<article>{P}</article>{other}{FOOT}</body>") == LONG
    assert main_text(f"<body>{other}{NAV}<div>{P}</div>{FOOT}</body>") == LONG


def test_lists_of_links_in_an_article_stay():
    page = f'<body>{NAV}<article><h1>A title</h1>{P}<ul><li><a href="/s">One source of this</a></li><li><a href="/t">Two</a></li></ul>{P}</article>{FOOT}</body>'
    assert main_text(page) == "\n\n".join(["A title", LONG, "One source of this", "Two", LONG])
    assert main_text(f"<body><div class='cookie-notice'>{P}</div>{NAV}</body>") == ""


def naive(found):
    """The second pass, block by block: each ambiguous one looks left and right for the nearest that speaks."""
    clean = any(b.article and not (b.boilerplate or b.named or b.formed) for b in found)
    free = any(not (b.boilerplate or b.named or b.formed) and html_text._first_pass(b) in ("good", "near") for b in found)
    bad = [b.boilerplate or (b.named and (clean or (free and b.talk))) or (b.formed and (clean if b.article else free or clean)) for b in found]
    first = ["bad" if x else html_text._first_pass(b) for x, b in zip(bad, found, strict=True)]
    good, article = "good" in first, any(b.article for b in found)
    for i, b in enumerate(found):
        first[i] = {"near": "good" if b.article or not (good and article) else "ambiguous", "poor": "bad" if good or article else "ambiguous"}.get(first[i], first[i])
    speak = [j for j in range(len(found)) if first[j] != "ambiguous" and not bad[j]]
    out = []
    for i, b in enumerate(found):
        label = first[i]
        if label == "ambiguous":
            sides = [(min(js, key=lambda j: abs(i - j)) if js else None) for js in ([j for j in speak if j < i], [j for j in speak if j > i])]
            near = sorted((abs(i - j), first[j]) for j in sides if j is not None and found[j].article == b.article)
            if not speak:
                label = "good" if b.article or not article else "bad"
            elif not near or len(near) == 2 and near[0][0] == near[1][0] and near[0][1] != near[1][1]:
                label = "good" if b.article else "bad"
            else:
                label = near[0][1]
        out.append(label)
    return out


def test_labels_equal_brute_force():
    rng = random.Random(4)
    for _ in range(3000):
        found = []
        for _ in range(rng.randint(0, 14)):
            text = rng.choice((LONG, LONG[:90], "A few words", "Read more", "xyz " * 40, "xyz", "© 2020 them"))
            found.append(Block(text, rng.choice((0, 0, 0, len(text), len(text) // 3)), rng.random() < 0.5, rng.random() < 0.15, rng.random() < 0.15, rng.random() < 0.3, rng.random() < 0.1, rng.random() < 0.15))
        want = naive(found)
        assert [b.label for b in html_text.classify(found)] == want
